r"""Personal data: base spans by pattern and check, more spans by candidate gradient boosting.

Base spans per kind are leftmost non-overlapping matches that pass their check:

* email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+``
* ip: four runs of digits joined by points, each at most 255
* card: digits with single blanks or hyphens between, 16 to 19 of them, Luhn sum right
* phone ``\+[0-9][\x20().0-9-]+[0-9]``, 8 to 15 digits

The method adds spans. High-recall generators propose overlapping candidates (disguised addresses, addresses
without a known ending, IPv6, digit groups with other separators, shorter cards, national numbers; of a run of digit
groups every sub-span of 7 to 19 digits); boosted trees score each on format and context features; a threshold per kind, calibrated for precision on examples kept out
of training, selects; of selected spans that overlap, the better score stays, and none overlaps a base span.
The trees are trained here on composed examples, as no table labels personal data.

Defined cases: null and empty texts have no span. Spans are code points, end exclusive. Every search is linear in
the text, however long. Repeated rows are treated alike, one by one; an empty table gives no rows; only the id
and text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import functools
import itertools
import random
import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.boosting import Forest, train
from geoloom.llm.common import pieces, small_batches, texts

KINDS = ("email", "ip", "card", "phone")
#: Share of the selected candidates of a kind, in calibration, that must be right.
PRECISION = 0.995
#: Examples that are composed for training and calibration.
EXAMPLES = 6000
CONTEXT = 28

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

Span = tuple[int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        if k % 2:
            v = v * 2 - 9 * (v > 4)
        total += v
    return total % 10 == 0


def _octets(text: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in text.split("."))


def emails(text: str) -> list[Span]:
    """Each match holds one @ right after its local part, so the search walks from one @ to the next."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        following = at + 1
        if start < at and (m := _DOMAIN.match(text, at)):
            out.append((start, m.end()))
            done = following = m.end()
        else:
            done = at + 1  # the local part of a later match cannot hold this @
        at = text.find("@", following)
    return out


def base_spans(text: str) -> dict[str, list[Span]]:
    cards = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                cards.append(m.span())
    phones = [m.span() for m in _PHONE.finditer(text) if 8 <= sum(map(str.isdigit, m.group())) <= 15] if "+" in text else []
    return {"email": emails(text), "ip": [m.span() for m in _IP.finditer(text) if _octets(m.group())], "card": cards, "phone": phones}


# Candidates. Each pattern starts with a rare literal or sits behind a cheap test, and none can back-track over a whole text.
_AT = r"(?:\(at\)|\[at\]|\{at\}|<at>)"
_DOT = r"(?:\(dot\)|\[dot\]|\{dot\}|<dot>|\.)"
_DISGUISED = re.compile(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}} ?{_AT} ?[A-Za-z0-9-]{{1,63}}(?: ?{_DOT} ?[A-Za-z0-9-]{{1,63}})+", re.I)
_SPOKEN = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} at [A-Za-z0-9-]{1,63}(?: dot [A-Za-z0-9-]{1,63}){1,4}", re.I)
_SPACED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} {0,2}@ {0,2}[A-Za-z0-9-]{1,63}(?: ?\. ?[A-Za-z0-9-]{2,24}){0,4}")
_MARKED_AT = re.compile(r"[(\[{<]at[)\]}>]", re.I)
_COLONS = re.compile(r":[0-9A-Fa-f]{0,4}:")
_IPV6 = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}|:)(?::[0-9A-Fa-f]{0,4}){2,7}(?![0-9A-Za-z:])")
#: What may stand between the digit groups of a run; a longer gap ends it.
_SEPARATORS, GAP = " ()./ –‑-", 40
_RUN = re.compile(rf"[0-9]+(?:[{re.escape(_SEPARATORS)}]{{1,{GAP}}}[0-9]+)*")
_GROUP = re.compile(r"[0-9]+")
_LEAST_DIGITS, _MOST_DIGITS = 7, 19
#: Candidates that are scored at a time.
SCORED = 4096


def candidates(text: str) -> Iterator[tuple[str, int, int]]:
    """High recall; spans may overlap and a digit group is proposed for several kinds."""
    if "@" in text:
        yield from (("email", *m.span()) for m in _SPACED.finditer(text))
    if _MARKED_AT.search(text):
        yield from (("email", *m.span()) for m in _DISGUISED.finditer(text))
    if " dot " in text.lower():
        yield from (("email", *m.span()) for m in _SPOKEN.finditer(text))
    if _COLONS.search(text):
        yield from (("ip", *m.span()) for m in _IPV6.finditer(text))
    for m in _RUN.finditer(text):
        if m.end() - m.start() >= _LEAST_DIGITS:
            yield from _numbers(text, *m.span())


def _numbers(text: str, start: int, end: int) -> Iterator[tuple[str, int, int]]:
    """Sub-spans of a run from a group's start to a group's end; the digits of one bound how many a group starts."""
    groups = [g.span() for g in _GROUP.finditer(text, start, end)]
    open_end = text[end : end + 1].isascii() and text[end : end + 1].isalpha()
    last = len(groups) - open_end
    for i in range(last):
        first = groups[i][0]
        if i == 0:
            head = first - (text[first - 1 : first] == "(")
            head -= text[head - 1 : head] == "+"
            if not _free_before(text, head):
                head = first
            if not _free_before(text, head):
                continue
        else:
            head = first - (text[first - 1] == "(")
        n = points = 0
        for j in range(i, last):
            n += groups[j][1] - groups[j][0]
            if j > i:
                points += text.count(".", groups[j - 1][1], groups[j][0])
            if n > _MOST_DIGITS:
                break
            stop = groups[j][1]
            if points == 3 and n <= 12:
                yield ("ip", head, stop)
            if 13 <= n:
                yield ("card", head, stop)
            if _LEAST_DIGITS <= n <= 15:
                yield ("phone", head, stop)


def _free_before(text: str, at: int) -> bool:
    before = text[at - 1] if at else " "
    return not (before == "." or before.isascii() and before.isalnum())


_CUES = {"email": ("mail", "write", "contact", "kontakt", "correo", "courriel", "@"), "ip": ("ip", "host", "server", "address", "login", "client"), "card": ("card", "visa", "karte", "carte", "tarjeta", "pay"), "phone": ("phone", "tel", "call", "fax", "mobil", "ruf", "llam", "appel")}
_PART, _HEX_LETTER, _GAP = re.compile(r"[A-Za-z0-9-]+"), re.compile(r"[a-fA-F]"), re.compile(r"(?<=[0-9])[^0-9]+(?=[0-9])")
_DATE = re.compile(r"(?<![0-9])(?:(?:19|20)[0-9]{2}[-./][0-9]{1,2}[-./][0-9]{1,2}|[0-9]{1,2}[-./][0-9]{1,2}[-./](?:19|20)[0-9]{2})(?![0-9])")
_MEASURE = re.compile(r" ?(?:%|eur|usd|kg|km|cm|mm|m\b|s\b)")
_ENDINGS = frozenset("com org net edu gov io de fr es eu uk info co".split())


@functools.lru_cache(4096)
def _before(before: str) -> tuple[float, ...]:
    left = before.rstrip(_SEPARATORS)
    digit = "0" <= left[-1:] <= "9"
    return (
        *(float(any(cue in before for cue in _CUES[k])) for k in KINDS), float(before[-1:].isalnum()), float(any(cue in before for cue in ("order", "no.", "nr", "isbn", "id", "version", "date", "token", "ref", "$", "eur"))),
        float(digit), len(before) - len(left), float(digit and before[-1:] in (".", "-", "/")),
    )


@functools.lru_cache(4096)
def _after(after: str) -> tuple[float, ...]:
    right = after.lstrip(_SEPARATORS)
    digit = "0" <= right[:1] <= "9"
    return (
        *(float(any(cue in after for cue in _CUES[k])) for k in KINDS), float(after[:1].isalnum()), float(bool(_MEASURE.match(after))),
        float(digit), len(after) - len(right), float(digit and after[:1] in (".", "-", "/")),
    )


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    body, at = text[start:end], KINDS.index(kind)
    before, after = _before(text[max(0, start - CONTEXT) : start].lower()), _after(text[end : end + CONTEXT].lower())
    runs = _GROUP.findall(body)
    joined = "".join(runs)
    groups = [len(g) for g in runs]
    parts = _PART.findall(body)
    year = any(len(g) == 4 and g[:2] in ("19", "20") for g in runs)
    separators = {c for c in body if not c.isalnum()}
    octets = [int(g) for g in runs if len(g) < 6]
    gaps = _GAP.findall(body)
    low = body.lower()
    return [
        *(float(k == at) for k in range(len(KINDS))),
        len(body), len(joined), len(groups), max(groups, default=0), min(groups, default=0), groups[0] if groups else 0, groups[-1] if groups else 0,
        float(len(joined) > 11 and luhn(joined)), float(joined[:1] or -1), float(joined[:2] in ("34", "37")), len(set(joined)), float(body[:1] == "+"), float(body[:2] == "00" or body[:1] == "0"),
        body.count("."), body.count("-"), body.count(" "), body.count("("), body.count("/"), body.count(":"), len(separators), float(year), float(max(octets, default=0)), float(bool(_MARKED_AT.search(body))), float(" dot " in low or "dot)" in low or "dot]" in low),
        float(bool(parts) and parts[-1].lower() in _ENDINGS), float(bool(parts) and len(parts[-1])), float("::" in body), len(_HEX_LETTER.findall(body)) / max(1, len(body)), len(set(groups)),
        *before, *after[len(KINDS) :], after[at],
        body.count("(") - body.count(")"), len(set(gaps)), max(map(len, gaps), default=0), float(bool(_DATE.search(body))), float(len(set(gaps)) < 2 and groups in ([4] * 4, [4, 6, 5], [len(joined)])),
    ]


def _compose(rng: random.Random) -> tuple[str, str, int, int, int]:
    """An example: text, kind, start, end and whether it is personal data."""
    word = lambda: "".join(rng.choice(("an", "the", "er", "on", "re", "la", "en", "ti", "es", "or")) for _ in range(rng.randint(1, 4)))
    number = lambda n: "".join(str(rng.randint(0, 9)) for _ in range(n))

    def other_word() -> str:
        while (found := word()) in _ENDINGS:
            pass
        return found

    def card(n: int, right: bool) -> str:
        head = rng.choice("3456" if rng.random() < 0.7 else "123456789") + number(n - 2)
        last = next(str(d) for d in range(10) if luhn(head + str(d)))
        return head + (last if right else str((int(last) + rng.randint(1, 9)) % 10))

    kind, good = rng.choice(KINDS), rng.random() < 0.5
    if kind == "email":
        at, dot = rng.choice(((" (at) ", "."), ("(at)", "."), ("[at]", "[dot]"), (" [at] ", " [dot] "), (" at ", " dot "), (" @ ", "."), ("{at}", "."))) if good else (" at ", " dot ") if rng.random() < 0.4 else ("@", "")
        body = f"{word()}{rng.choice(('', '.', '_'))}{word()}{at}{word()}{dot}{rng.choice(sorted(_ENDINGS)) if good else other_word() if dot else ''}"
    elif kind == "ip":
        if good:
            body = ":".join(f"{rng.randint(0, 65535):x}" for _ in range(8)) if rng.random() < 0.6 else f"{rng.randint(4096, 65535):x}:{rng.randint(0, 65535):x}::{rng.randint(0, 65535):x}"
        else:
            body = rng.choice((f"{rng.randint(0, 23):02}:{rng.randint(0, 59):02}:{rng.randint(0, 59):02}", f"{rng.randint(256, 999)}.{number(3)}.{number(2)}.{number(3)}", f"{rng.randint(0, 9)}.{rng.randint(300, 900)}.{rng.randint(0, 9)}.{rng.randint(256, 4000)}"))
    elif kind == "card":
        n = rng.choice((13, 14, 15, 15, 16, 16, 16))
        digits = card(n, good)
        sep = rng.choice((".", "/", " ", "–", "  ")) if good and n == 16 else rng.choice(("", "", " ", "-", "."))
        body = sep.join((digits[:4], digits[4:10], digits[10:])) if n == 15 else sep.join(digits[i : i + 4] for i in range(0, n, 4))
        if good and n < 15:
            body = digits
    elif good:
        body = rng.choice((f"({number(3)}) {number(3)}-{number(4)}", f"0{number(2)} {number(4)} {number(4)}", f"00{rng.randint(11, 99)} {number(3)} {number(3)} {number(3)}", f"{rng.randint(200, 999)}-{rng.randint(200, 999)}-{number(4)}", f"0{number(3)}/{number(7)}", f"{rng.randint(200, 999)}.{rng.randint(200, 999)}.{number(4)}"))
    else:
        body = rng.choice((f"{rng.randint(1900, 2030)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}", f"{rng.randint(1, 28):02}.{rng.randint(1, 12):02}.{rng.randint(1900, 2030)}", number(rng.randint(7, 15)), f"{number(3)} {number(3)} {number(3)}", f"{number(3)}.{number(3)}.{number(3)}", f"{rng.randint(1, 9)}.{number(3)}.{number(3)}", f"978-{number(1)}-{number(4)}-{number(4)}-{number(1)}", f"{rng.randint(1900, 2030)}-{rng.randint(1900, 2030)}", f"{rng.randint(1, 28):02}/{rng.randint(1, 12):02}/{rng.randint(1900, 2030)}"))
    cue = rng.choice(_CUES[kind][:-1]) + rng.choice((": ", " ", " ")) if rng.random() < (0.45 if good else 0.15) else rng.choice(("order ", "id ", "no. ", "isbn ", "")) if not good and rng.random() < 0.4 else ""
    left = " ".join(word() for _ in range(rng.randint(0, 6))) + " " + cue
    return f"{left}{body} {' '.join(word() for _ in range(rng.randint(0, 6)))}", kind, len(left), len(left) + len(body), int(good)


def _case(rng: random.Random) -> tuple[str, dict[tuple[str, int, int], int]]:
    """A text and its candidates, with 1 for personal data: an example, often two numbers side by side or a row of numbers, and every other span proposed in it."""
    text, kind, start, end, good = _compose(rng)
    known = {(kind, start, end): good}
    draw = rng.random()
    if kind in ("card", "phone") and draw < 0.5:
        gap, form = rng.choice((" ", " ", " ", "  ", " / ", " - ", " – ")), rng.choice((" ", "-", "", None))
        alike = draw < 0.25 and good
        for _ in range(rng.choice((1, 1, 2, 4))):
            while True:
                other = _compose(rng)
                body = other[0][other[2] : other[3]]
                if other[1] in ("card", "phone") and (not alike or other[1] == kind and other[4]):
                    break
            digits = re.sub("[^0-9]", "", body)
            if alike and form is not None and other[1] == "card" and len(digits) == 16:
                body = form.join(digits[i : i + 4] for i in range(0, 16, 4))
            known[other[1], end + len(gap), end + len(gap) + len(body)] = other[4]
            text, end = text[:end] + gap + body + text[end:], end + len(gap) + len(body)
    elif kind == "phone" and not good and draw < 0.7:
        gap, size = rng.choice((" ", " ", "  ", " - ", "/")), rng.choice((0, 0, 1, 2, 3, 4, 5, 8))
        row = gap.join(str(rng.randint(0, 10 ** (size or rng.randint(1, 8)) - 1)) for _ in range(rng.randint(3, 14)))
        text, known = text[:start] + row + text[end:], {}
    elif kind == "phone" and not good and draw < 0.9:
        for _ in range(12):  # dates and the like whose digits together pass for a card's
            row = rng.choice((" ", "  ", " - ", "-", "/")).join(text[start:end] if k == 0 else f"{rng.randint(1900, 2030)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}" for k in range(rng.randint(2, 3)))
            if any(c[0] == "card" and luhn(re.sub("[^0-9]", "", row[c[1] : c[2]])) for c in candidates(row)):
                break
        text, known = text[:start] + row + text[end:], {}
    for c in candidates(text):
        known.setdefault(c, 0)
    return text, known


@dataclass
class Selector:
    forest: Forest
    thresholds: dict[str, float]

    def added(self, text: str, base: dict[str, list[Span]]) -> list[tuple[str, int, int]]:
        taken = _disjoint(sorted(s for spans in base.values() for s in spans))
        free = (c for c in dict.fromkeys(candidates(text)) if not _touches(taken, c[1], c[2]))
        scored: list[tuple[float, tuple[str, int, int]]] = []
        while some := list(itertools.islice(free, SCORED)):
            p = self.forest.probability(np.array([features(text, *c) for c in some]))
            scored += [(score, c) for score, c in zip(p.tolist(), some, strict=True) if score >= self.thresholds[c[0]]]
        return [c for _, c in _best(scored)]


def _best(scored: list[tuple[float, tuple[str, int, int]]]) -> list[tuple[float, tuple[str, int, int]]]:
    """Of candidates that overlap the one with the better score, of equal ones the first and longest."""
    out: list[tuple[float, tuple[str, int, int]]] = []
    used: list[Span] = []
    for score, c in sorted(scored, key=lambda x: (-x[0], x[1][1], -x[1][2], x[1][0])):
        if not _touches(used, c[1], c[2]):
            out.append((score, c))
            insort(used, c[1:])
    return out


def _disjoint(spans: list[Span]) -> list[Span]:
    """Sorted spans with those that overlap made one."""
    out: list[Span] = []
    for start, end in spans:
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _touches(spans: list[Span], start: int, end: int) -> bool:
    """Whether a span of a sorted list without overlaps overlaps [start, end)."""
    at = bisect_left(spans, (end, 0))
    return at > 0 and spans[at - 1][1] > start


@functools.cache
def selector(examples: int = EXAMPLES, seed: int = 11) -> Selector:
    rng = random.Random(seed)
    cases = [_case(rng) for _ in range(examples)]
    bounds = np.cumsum([0, *(len(known) for _, known in cases)])
    rows = [(at, text, *c, good) for at, (text, known) in enumerate(cases) for c, good in known.items()]
    x = np.array([features(*r[1:5]) for r in rows])
    y = np.array([r[5] for r in rows], float)
    fit = np.array([r[0] for r in rows]) % 3 > 0
    forest = train(x[fit], y[fit], trees=60, depth=5)
    p = forest.probability(x)
    won: dict[str, list[tuple[float, int]]] = {kind: [] for kind in KINDS}
    for at, (_, known) in enumerate(cases):
        if at % 3 == 0:
            first = bounds[at]
            for score, c in _best(list(zip(p[first : first + len(known)].tolist(), known, strict=True))):
                won[c[0]].append((score, known[c]))
    thresholds = {}
    for kind in KINDS:
        s, good = (np.array([w[k] for w in won[kind]], float) for k in range(2))
        usable = [c for c in np.unique(s) if c >= 0.5 and good[s >= c].mean() >= PRECISION]
        thresholds[kind] = float(min(usable, default=1.1))
    return Selector(forest, thresholds)


def find(text: str, model: Selector) -> tuple[dict[str, list[Span]], list[tuple[str, int, int]]]:
    """Base spans by kind, and the spans that the model adds."""
    base = base_spans(text)
    return base, model.added(text, base)


def detect(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, base and added: arrays of (kind, start, end) by kind and start. One row per document."""
    spark = docs.sparkSession
    small_batches(spark)
    shipped = spark.sparkContext.broadcast(selector())  # its size is fixed by the number of trees
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    order = KINDS.index

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 8 << 20):
            bases, more = [], []
            for text in texts(batch.column(1)):
                base, added = find(text, shipped.value)
                bases.append([{"kind": k, "start": s, "end": e} for k in KINDS for s, e in base[k]])
                more.append([{"kind": k, "start": s, "end": e} for k, s, e in sorted(added, key=lambda c: (order(c[0]), c[1]))])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bases, pa.list_(item)), pa.array(more, pa.list_(item))], names=["doc_id", "base", "added"])

    spans = "array<struct<kind:string,start:long,end:long>>"
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, base {spans}, added {spans}")


def redact(text: str, model: Selector) -> str:
    """The text with each span, of either sort, replaced by its kind in angle brackets; of nested spans the first goes."""
    base, added = find(text, model)
    spans = sorted([*((s, e, k) for k, v in base.items() for s, e in v), *((s, e, k) for k, s, e in added)])
    out, done = [], 0
    for s, e, k in spans:
        if s >= done:
            out += [text[done:s], f"<{k}>"]
            done = e
    return "".join([*out, text[done:]])
