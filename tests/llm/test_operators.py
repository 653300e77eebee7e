"""Every operator over nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, against brute force."""

import hashlib
import random
import re
import subprocess
import sys
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from geoloom.llm import bpe, decontaminate, exact_dedup, jaccard_join, langid, pii, quality, sharding, suffix_dedup, warc
from geoloom.llm.common import fresh_dir
from geoloom.llm.queries import tokenizer_path
from geoloom.llm.run_length_index import RunLengthIndex

rng = random.Random(5)
WORDS = [f"w{rng.randint(0, 400)}" for _ in range(600)]
prose = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
BASE, PASSAGE = prose(120), prose(60)
NEAR = " ".join(w if k % 60 else "changed" for k, w in enumerate(BASE.split()))
ROWS = [
    (1, None), (2, ""), (3, "  \n "), (4, BASE), (5, BASE.upper()), (6, NEAR), (7, f"{prose(40)} {PASSAGE} {prose(30)}"), (8, f"{prose(20)} {PASSAGE}"), (9, "one two three"), (10, "One TWO three"),
    (11, "Was " * 700), (12, prose(4000)), (None, BASE), (13, "é" * 150 + "Ünïcode ∑ text " * 9), (4, BASE), (14, "a" * 5000), (15, "12 345"), (16, prose(90)),
]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    """With columns whose names operators use themselves."""
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    rows = [(i, t, "en", None, 0, True, "x") for i, t in ROWS]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, row long, kept boolean, norm string").coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


def sha(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_dedup(docs, keep):
    got = exact_dedup.exact_dedup(docs, keep=keep).collect()
    norm = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    groups = Counter(norm(t) for _, t in ROWS)
    assert len(got) == len(ROWS)
    assert sum(r["kept"] for r in got) == len(groups)
    assert Counter((r["doc_id"], r["group_size"], r["text_sha256"]) for r in got) == Counter((i, groups[norm(t)], sha(norm(t).encode())) for i, t in ROWS)
    pick = max if keep == "largest" else min
    assert all(r["keep_id"] == pick(i for i, t in ROWS if i is not None and sha(norm(t).encode()) == r["text_sha256"]) for r in got)


def test_suffix_dedup_matches_brute_force(docs):
    seen = Counter()
    raws = [(i, (t or "").encode()) for i, t in ROWS]
    for _, b in raws:
        seen.update(b[k : k + 200] for k in range(len(b) - 199))
    want = Counter()
    for i, b in raws:
        mark = np.zeros(len(b) + 1, int)
        for k in range(len(b) - 199):
            if seen[b[k : k + 200]] > 1:
                mark[k] += 1
                mark[k + 200] -= 1
        gone = np.cumsum(mark)[: len(b)] > 0
        want[i, len(b), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), bytes(np.frombuffer(b, np.uint8)[~gone])] += 1
    for hot in (400, 1):
        got = suffix_dedup.suffix_dedup(docs, hot_pieces=hot).collect()
        assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in got) == want


def test_run_length_index_matches_brute_force():
    for _ in range(60):
        texts = [bytes(rng.choice(b"ab\x00") for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 6))]
        places = [(t, k) for t in range(len(texts)) for k in range(len(texts[t]))]

        def shared(p, q):
            a, b = texts[p[0]][p[1] :], texts[q[0]][q[1] :]
            return next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

        index = RunLengthIndex(texts)
        want = [max((shared(p, q) for q in places if q != p), default=0) for p in places]
        assert index.matching_statistics().tolist() == want and index.lengths.sum() == len(want)
        for least in (1, 3, 7):
            first, last = index.long_matches(least)
            assert {k for a, b in zip(first.tolist(), last.tolist(), strict=True) for k in range(a, b + 1)} == {k for k, n in enumerate(want) if n >= least}
    assert len(RunLengthIndex([b"some text that comes again and again"] * 200).heads) < 600


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def joined(rows):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    least = {i: i for i, _ in sets}
    while True:
        before = dict(least)
        for i, a in sets:
            for j, b in sets:
                if a and b and 9 * len(a & b) >= 4 * (len(a) + len(b)):
                    least[i] = least[j] = min(least[i], least[j])
        if before == least:
            return least


def degrees(rows):
    """By place, how many other rows each is linked with."""
    sets = [shingles(t) if i is not None else set() for i, t in rows]
    return [sum(bool(a) and k != j and 9 * len(a & b) >= 4 * (len(a) + len(b)) for j, b in enumerate(sets)) for k, a in enumerate(sets)]


@pytest.mark.parametrize("block_rows", [1000, 2])
def test_jaccard_join_matches_brute_force(spark, docs, block_rows):
    got = jaccard_join.jaccard_join(docs, block_rows=block_rows).collect()
    least = joined(ROWS)
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["n_links"]) for r in got) == Counter((i, len(shingles(t)), least.get(i), d) for (i, t), d in zip(ROWS, degrees(ROWS), strict=True))


def test_jaccard_join_of_hot_blocks_matches_brute_force(spark):
    """Families of near copies of several sizes, some linked by chains only, copies among them, and a passage that all share."""
    own = random.Random(11)
    rows, start = [], prose(30)
    for family in range(6):
        base = (start + " " + prose(20 + 15 * family)).split()
        for _ in range(14):
            words = [w if own.random() > 0.02 else f"x{own.randint(0, 9)}" for w in base]
            rows.append(" ".join(words[: len(words) - own.randint(0, 8)]))
    rows += own.choices(rows, k=12)
    own.shuffle(rows)
    rows = [(k, t) for k, t in enumerate(rows)]
    path = fresh_dir(spark, "test")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(path)
    want, least = degrees(rows), joined(rows)
    assert max(want) > 10 and len(set(least.values())) > 5
    for block_rows in (1000, 7):
        got = {r["doc_id"]: r for r in jaccard_join.jaccard_join(spark.read.parquet(path), block_rows=block_rows).collect()}
        assert [(got[k]["component_id"], got[k]["n_links"]) for k, _ in rows] == [(least[k], want[k]) for k, _ in rows]


def test_rtree_yields_every_link_once():
    sets = [np.unique(np.array([rng.getrandbits(64) for _ in range(rng.choice([1, 3, 20, 60, 90, 130]))], np.uint64)) for _ in range(60)]
    sets += [np.unique(np.concatenate([s[: max(1, len(s) - 3)], np.array([rng.getrandbits(64)], np.uint64)])) for s in sets]
    found = [(i, j) for a, b in jaccard_join.candidates([np.frombuffer(jaccard_join.count_vector(s), np.uint8) for s in sets], np.array([len(s) for s in sets])) for i, j in zip(a.tolist(), b.tolist(), strict=True)]
    once = {frozenset(p) for p in found}
    assert len(once) == len(found) and all(len(p) == 2 for p in once)
    linked = {frozenset((i, j)) for i, a in enumerate(sets) for j, b in enumerate(sets) if i < j and 9 * len(np.intersect1d(a, b)) >= 4 * (len(a) + len(b))}
    assert len(linked) > 30 and linked <= once and len(once) < 300


def test_pii_base_spans_are_those_of_the_patterns():
    alphabet = "ab1.9@-+ ()4%"
    email, ip, card, phone = (re.compile(p) for p in (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"))
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["4111 1111-1111 1111 x 4111111111111112", "1.2.3.4.5.6.7.8", "999.1.1.1", "a@b a@b.c@d.e", "+49 (30) 1234-567", "", "0" * 6000]
    for text in texts:
        digits = lambda m: re.sub("[^0-9]", "", m.group())
        want = {
            "email": [m.span() for m in email.finditer(text)],
            "ip": [m.span() for m in ip.finditer(text) if all(len(x.lstrip("0")) < 4 and int(x) <= 255 for x in m.group().split("."))],
            "card": [m.span() for m in card.finditer(text) if 16 <= len(digits(m)) <= 19 and pii.luhn(digits(m))],
            "phone": [m.span() for m in phone.finditer(text) if 8 <= len(digits(m)) <= 15],
        }
        assert pii.base_spans(text) == want


def test_pii_adds_disguised_spans_and_leaves_clean_text_alone(docs):
    model = pii.selector()
    assert pii.redact("call (415) 555-1234 or joe.x [at] mail [dot] com, host 10.0.0.1", model) == "call <phone> or <email>, host <ip>"
    for clean in ("on 2020-10-12 we met", "isbn 978-3-1234-4567-1", "at 12:30:45", "the 2086184495729368 files", "cost 1.234.567 eur", prose(300)):
        assert pii.redact(clean, model) == clean
    assert all(not r["base"] and not r["added"] for r in pii.detect(docs).collect())


def test_pii_touches_no_base_span_and_recalls_composed_data():
    model = pii.selector()
    ips = ".".join(["10.0.0.1"] * 12)
    base, added = pii.find(f"x@{ips}.com 415-555-1234", model)
    assert not any(s < e2 and s2 < e for _, s, e in added for spans in base.values() for s2, e2 in spans)
    own, found, many = random.Random(77), Counter(), Counter()
    while min(many.values(), default=0) < 100:
        text, kind, start, end, good = pii._compose(own)
        if good:
            base, added = pii.find(text, model)
            many[kind] += 1
            found[kind] += any(s <= start + 1 and end <= e for s, e in (*((s, e) for spans in base.values() for s, e in spans), *(c[1:] for c in added)))
    print({kind: found[kind] / many[kind] for kind in many})
    assert all(found[kind] >= 0.9 * many[kind] for kind in many)


def test_pii_finds_numbers_side_by_side():
    model = pii.selector()
    for text, want in (
        ("x 4465758382889437 4465758382889437 y", "x <card> <card> y"),
        ("a 7536784127813050 4845168114407329 b", "a <card> <card> b"),
        ("(415) 555-1234 (212) 555-9876", "<phone> <phone>"),
        ("call 415-555-1234 212-555-9876 now", "call <phone> <phone> now"),
        ("on 2020-10-12 2021-10-14 we met", "on 2020-10-12 2021-10-14 we met"),
        ("1990 1991 1992 1993 1994 1995", "1990 1991 1992 1993 1994 1995"),
    ):
        assert pii.redact(text, model) == want
    long = " ".join(["4465758382889437"] * 300)
    assert pii.redact(long, model) == " ".join(["<card>"] * 300)
    spans = {c[1:] for c in pii.candidates("12 345 6789 12345 x")}
    assert spans == {(0, 11), (0, 17), (3, 11), (3, 17), (7, 17)}


def test_bpe_equals_the_library(spark, docs):
    from tokenizers import Tokenizer

    path = tokenizer_path(spark)
    library = Tokenizer.from_file(path)
    alphabet = "abcdeABC's 'll 're 't12\n\t\x1c\x85\xa0 éÉ́ßİΣς漢字½²_-—!?🙂<|endoftext|>"
    mine = bpe.Encoder(bpe.Tokenizer(path), None)
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) + rng.choice(["", "", "<|endoftext|>x"])
        ids = library.encode(text, add_special_tokens=False).ids
        assert mine.encode(text) == ids
        assert mine.tokenizer.decode(ids) == library.decode(ids, skip_special_tokens=False)
    want = Counter((i, tuple(e := library.encode(t or "", add_special_tokens=False).ids), library.decode(e, skip_special_tokens=False)) for i, t in ROWS)
    assert Counter((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in bpe.encode(docs, path).collect()) == want


def test_lexicon_is_exact_and_shares_suffixes(tmp_path):
    words = sorted({f"{a}{b}ing" for a in "abcdef" for b in "xyz"} | {"é", "in"})
    path = tmp_path / "l.bin"
    path.write_bytes(bpe.compile_lexicon({w: (k, k + 1) for k, w in enumerate(words)}))
    lexicon = bpe.Lexicon(str(path))
    assert [np.frombuffer(lexicon.lookup(w.encode()), np.int32).tolist() for w in words] == [[k, k + 1] for k in range(len(words))]
    assert lexicon.lookup(b"ax") is None and lexicon.lookup(b"") is None and lexicon.lookup(b"axingg") is None
    assert len(lexicon.first) < 20  # states of 20 words of 5 letters


UNITS = decontaminate.UNITS


def plain_template(text):
    """(typed token, value, whether a title or unit word) of each token, by the rules as written."""
    out, before = [], "end"
    for token in re.findall(r"[0-9]+(?:[.,][0-9]+)*|[^\W\d_]+|[.!?\n]", text or ""):
        low = token.lower()
        if token in ".!?\n":
            before = "end"
            continue
        if token[0].isdigit():
            kind = "number"
        elif low in UNITS:
            kind = "unit" if before == "number" else "word"
        elif token[0].isupper() and token[1:] == low[1:]:
            kind = "name" if before != "end" else "word"
        else:
            kind = "word"
        out.append((low if kind == "word" else f"<{kind}>", low, "unit" if low in UNITS else "name" if token[0].isupper() and token[1:] == low[1:] else None))
        before = "number" if kind == "number" else "other"
    return out


def plain_matches(text, items, window=13, least=6):
    """Ids of the items found and the number of windows, by trying every alignment that has an equal window."""
    doc, found, n = plain_template(text), set(), 0
    typed_doc, places = [t[0] for t in doc], {}
    for item_id, item_text in items:
        item = plain_template(item_text)
        size = min(window, len(item))
        if size and size not in places:
            places[size] = {}
            for i in range(len(doc) - size + 1):
                places[size].setdefault(tuple(typed_doc[i : i + size]), []).append(i)
        typed = [t[0] for t in item]
        diagonals = {i - j for j in range(len(item) - size + 1) for i in places[size].get(tuple(typed[j : j + size]), ())} if size else set()
        if size and item[0][2] and typed[0][0] != "<":
            diagonals |= set(places[size].get((f"<{item[0][2]}>", *typed[1:size]), ()))
        for diagonal in diagonals:
            equal = []
            for j, (own, _, odd) in enumerate(item):
                i = j + diagonal
                as_slot = j == 0 and own[0] != "<" and odd is not None and 0 <= i < len(doc) and doc[i][0] == f"<{odd}>"
                equal.append(0 <= i < len(doc) and (doc[i][0] == own or as_slot))
            at = 0
            while at < len(item):
                end = at
                while end < len(item) and equal[end]:
                    end += 1
                if end - at >= size:
                    pairs = {(item[j][1], doc[j + diagonal][1]) for j in range(at, end) if doc[j + diagonal][0][0] == "<"}
                    same = all(a == b for a, b in pairs)
                    if same or len({a for a, _ in pairs}) == len(pairs) == len({b for _, b in pairs}):
                        for start in range(at, end - size + 1):
                            part = range(start, start + size)
                            alike = all(item[j][1] == doc[j + diagonal][1] for j in part)
                            if alike or sum(doc[j + diagonal][0][0] != "<" for j in part) >= least:
                                n += 1
                                found.add(item_id)
                at = max(end, at + 1)
    return sorted(i for i in found if i is not None), n


ITEM = "In spring Anna walked 12 km to the old mill and then sold 30 baskets of red apples to the miller."
SUMS = "12 + 34 = 46 and 5 * 7 = 35 and 81 / 9 = 9 so 18 - 4 = 14 or 3 * 3 = 9 then 2 + 2 = 4"
NAMES = "the list has Anna Bert Carl Dora Emil Fritz Gerda Hans Ida Jan Karl Lena Max"
SHORT, QUESTION = "Compute 12 + 30.", "Which river flows through the old town of the northern duchy"
PERIODIC = "ha " * 40


def test_decontaminate_matches_brute_force(spark):
    other = ITEM.replace("12", "7").replace("30", "44").replace("Anna", "Bert").replace("km", "miles")
    items = [(1, ITEM), (2, None), (3, "too short"), (1, ITEM), (4, SUMS), (5, NAMES), (6, SHORT), (7, QUESTION), (None, "an item that has no id at all but very many plain words in it"), (8, PERIODIC), (9, ""), (10, "Miles of road")]
    texts = [
        f"{prose(20)}. {ITEM} {prose(9)}", f"{prose(5)}.\n{other}", prose(80), None, "", ITEM.upper(), ITEM.replace("30", "12"), ITEM.replace("Anna", "Bert"), f"{ITEM} {other}", "it is too short", "Too short!",
        f"some words before, {SUMS} and some after", f"so {NAMES} and others", f"words without an end {SHORT}", f"An end. {SHORT} {SHORT}", "Compute 15 + 31.", f"words without an end {QUESTION} and", f"An end. {QUESTION}?",
        SUMS.replace("12", "13").replace("5 *", "6 *"), "an item that has no id at all but very many plain words in it", PERIODIC, PERIODIC * 3, "some 7 miles of road", "Miles of road", ITEM[:60], ITEM[30:], f"{ITEM[:70]} and {ITEM[40:]}", prose(3000) + ITEM,
    ]
    swap = random.Random(3)
    for _ in range(30):
        texts.append(re.sub(r"12|30|Anna|km|red|mill\b", lambda m: swap.choice([m[0], "12", "30", "44", "Anna", "Bert", "km", "days", "red"]), f"{prose(3)} {ITEM}"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame([(k, t, True, 5) for k, t in enumerate(texts)], "doc_id long, text string, contaminated boolean, found int")
    path = fresh_dir(spark, "test")
    frame.write.parquet(path)
    frame = spark.read.parquet(path)
    marked = decontaminate.mark(frame, bench, ["doc_id", "contaminated", "found"])
    assert marked.columns == ["doc_id", "found", "contaminated", "n_windows", "items"]
    got = {r["doc_id"]: r for r in marked.collect()}
    for k, text in enumerate(texts):
        want, n = plain_matches(text, items)
        assert (got[k]["contaminated"], got[k]["n_windows"], got[k]["items"]) == (n > 0, n, want), text
    flags = [got[k]["contaminated"] for k in range(9)]
    assert flags == [True, True, False, False, False, True, False, True, True]  # a copy, other parameters, three others, upper case, slots that contradict each other
    assert all(got[k]["contaminated"] for k in (9, 11, 12, 13, 14, 16, 17)) and not got[15]["contaminated"]
    assert decontaminate.mark(frame, bench.where("false"), ["doc_id"]).where("contaminated").count() == 0
    assert decontaminate.mark(frame.where("false"), bench, ["doc_id"]).count() == 0


def test_decontaminate_recalls_other_parameters(spark):
    """Questions of the given benchmark with a number, a name and a unit put in, and the same with others."""
    own = random.Random(4)
    rows = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()
    items, texts = [], []
    for r in rows:
        words = r["text"].split()
        at = own.randint(2, len(words) - 3)
        shape = lambda name, n, unit: " ".join([*words[:at], name, "has", n, unit, *words[at:]])  # noqa: E731, B023
        items.append((r["item_id"], shape("Anna", "12", "km")))
        texts.append((r["item_id"], f"{prose(30)}. {shape(own.choice(['Bert', 'Carla']), str(own.randint(13, 999)), own.choice(['miles', 'kg']))} {prose(20)}"))
    texts += [(-k, prose(200)) for k in range(1, 101)]
    bench, frame = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(texts, "doc_id long, text string")
    got = {r["doc_id"]: r["items"] for r in decontaminate.mark(frame, bench, ["doc_id"]).collect()}
    assert sum(i in got[i] for i, _ in items) >= 0.9 * len(items)
    assert not any(got[-k] for k in range(1, 101))


def test_warc_round_trip(spark):
    pages = [(3, "u", "<p>a</p>"), (1, None, "<p>a</p>"), (2, "u v", None), (4, "u", ""), (None, "u", "<p>a</p>"), (5, "u", "é" * 2000000), (1, "u", "<p>a</p>")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    index = warc.write(frame, fresh_dir(spark, "test"))
    got = warc.read(index).collect()
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"]) for r in got) == Counter((i, len((h or "").encode()), warc.digest((h or "").encode())) for i, _, h in pages)
    assert sorted((r["page_id"] or -1, r["refers_to"]) for r in got if r["record_type"] == "revisit") == [(-1, 1), (1, 1), (3, 1), (4, 2)]
    one = next(r for r in index.collect() if r["page_id"] == 5)
    assert warc.Bundle(one["bundle"]).record(one["frame"], one["at"]).payload.decode() == "é" * 2000000
    assert warc.archive(spark, frame.where("false")).count() == 0


def test_sharding_keeps_every_row(spark, docs):
    store = sharding.Store(spark, fresh_dir(spark, "store"), target_bytes=60_000, least_bytes=1000, fan_in=2, arrival_bytes=4000)
    for _ in range(5):
        store.append(docs)
    version, many = store.version(), len(store.shards())
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != "4000"
    store.compact()
    assert store.version() > version and len(store.shards()) < many
    assert not store.runs(store.shards())
    want = Counter({k: 5 * v for k, v in Counter(map(tuple, docs.collect())).items()})
    assert Counter(map(tuple, store.read().collect())) == Counter(map(tuple, store.read(store.version() - 1).collect())) == want
    shards = {s.shard_id: s for s in store.shards()}
    placed = store.placement().collect()
    assert Counter(r["doc_id"] for r in placed) == Counter({i: 5 * n for i, n in Counter(i for i, _ in ROWS).items()})
    assert Counter(r["shard_id"] for r in placed) == Counter({k: s.rows for k, s in shards.items()})
    assert all((r["tier"], r["shard_bytes"]) == (store.tier(shards[r["shard_id"]].bytes), shards[r["shard_id"]].bytes) for r in placed)
    with pytest.raises(RuntimeError, match="another writer"):
        store.commit(store.manifest(), store.version())
    with pytest.raises(ValueError):
        store.append(docs.withColumn("_metadata", docs["text"]))
    assert sharding.shard(docs.where("false")).count() == 0


def test_languages_and_rejection(spark, docs):
    make = {"aa": "bado keli", "bb": "ström fjäll", "cc": "quix zorp"}
    rows = [(k, " ".join(rng.choice(make[lang].split()) + rng.choice(["ik", "um"]) for _ in range(30)), lang) for k, lang in enumerate(list(make) * 60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit_languages(frame, frame["doc_id"] % 4 != 2)
    got = langid.identify(frame, model, ["doc_id", "lang"]).where("doc_id % 4 = 2").collect()
    assert all(r["lang"] == r["lang_pred"] and 0 <= r["score"] <= 1 and not r["rejected"] for r in got)
    odd = {r["doc_id"]: r for r in langid.identify(docs, model, ["doc_id"]).collect()}
    assert all(odd[i]["lang_pred"] == "und" and odd[i]["score"] == 0 and odd[i]["rejected"] for i in (1, 2, 3, 15))
    none = langid.fit_languages(frame.where("false"), frame["doc_id"] >= 0)
    assert none is None and langid.identify(docs, none, ["doc_id"]).where("lang_pred <> 'und'").count() == 0


def test_unlearned_languages_are_rejected_and_short_texts_stay():
    own = random.Random(9)
    ends = {"aa": ("ik", "um", "ado", "eli"), "bb": ("ström", "fjä", "ång", "ö"), "cc": ("qui", "zor", "xan", "pty"), "dd": ("the", "wer", "ing", "oug")}
    word = lambda lang: "".join(own.choice(ends[lang]) for _ in range(own.randint(1, 3)))
    text = lambda lang, n: " ".join(word(lang) for _ in range(n))
    model = langid.train([(text(lang, own.randint(3, 150)), lang) for lang in ends for _ in range(200)])
    odd = lambda letters, n: " ".join("".join(own.choice(letters) for _ in range(own.randint(2, 9))) for _ in range(n))
    rejected = lambda found: langid.predict(model, pa.array(found))[2]
    for letters in ("abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмнопрстуфхцч", "ABCDEFGHabcdefgh0123456789+/"):
        assert np.mean(rejected([odd(letters, 60) for _ in range(100)])) > 0.95
    for n in (3, 10, 100):
        assert np.mean(rejected([text(lang, n) for lang in ends for _ in range(100)])) < 0.03
    assert langid.train([("only one", "aa")] * 9).thresholds.max() == -np.inf


def test_quality_learns_and_scores_everything(spark, docs):
    rows = [(k, prose(60) + "." if k % 3 else "spam!! " * 50) for k in range(240)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 > 0), 0) for k in range(240)] + [(0, None, None)], "doc_id long, quality int, toxic int")
    forest = quality.fit_quality(frame, labels, labels["doc_id"] % 5 != 0)
    held = quality.score(frame, forest).where("doc_id % 5 = 0").collect()
    assert all(r["predicted"] == int(r["doc_id"] % 3 > 0) for r in held)
    assert quality.score(docs, forest).where("score between 0 and 1").count() == len(ROWS)
    assert {r["score"] for r in quality.score(docs, quality.fit_quality(frame, labels.where("false"), labels["doc_id"] >= 0)).collect()} == {0.5}


def test_empty_tables(spark, docs):
    none = docs.where("false")
    assert exact_dedup.exact_dedup(none).count() == suffix_dedup.suffix_dedup(none).count() == jaccard_join.jaccard_join(none).count() == pii.detect(none).count() == 0
    assert bpe.encode(none, tokenizer_path(spark)).count() == 0
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.score(none, quality.fit_quality(none, labels, labels["doc_id"] >= 0)).count() == 0
    assert langid.identify(none, langid.fit_languages(none, none["doc_id"] >= 0), ["doc_id"]).count() == 0


def test_long_texts_in_parts_have_the_same_pieces(monkeypatch):
    """Texts beyond PART are cut into overlapping parts; their windows and anchors are those of the whole text."""
    text = prose(6000)
    batch = pa.RecordBatch.from_arrays([pa.array([5, 6]), pa.array([text, text[:30_000]])], names=["row", "text"])

    def windows():
        out = {}
        for found in suffix_dedup._anchors(200, 48, False)(iter([batch])):
            for row, at, many, times, h, *_ in zip(*(c.to_pylist() for c in found.columns), strict=True):
                assert times == 1
                out.update({(row, k): h for k in range(at, at + many)})
        return out

    whole = windows()
    monkeypatch.setattr(suffix_dedup, "PART", 1 << 12)
    assert windows() == whole and len(whole) > 50_000


def test_multi_megabyte_texts(spark):
    big = " ".join(f"w{k % 9973}x{k % 31}" for k in range(500_000))
    path = fresh_dir(spark, "test")
    spark.createDataFrame([(1, big), (2, big + " more"), (3, "small text with a few words in it"), (4, None)], "doc_id long, text string").repartition(1).write.parquet(path)
    frame = spark.read.parquet(path)
    joined_ = {r["doc_id"]: r for r in jaccard_join.jaccard_join(frame).collect()}
    assert joined_[2]["component_id"] == 1 and joined_[1]["n_links"] == 1 and joined_[3]["component_id"] == 3
    assert {r["doc_id"]: r["n_removed"] > 4_000_000 for r in suffix_dedup.suffix_dedup(frame).collect()} == {1: True, 2: True, 3: False, 4: False}
    assert {r["doc_id"]: len(r["ids"]) > 900_000 for r in bpe.encode(frame, tokenizer_path(spark)).collect()} == {1: True, 2: True, 3: False, 4: False}
    assert sum(r["kept"] for r in exact_dedup.exact_dedup(frame).collect()) == 4


def test_the_index_takes_a_bounded_share_of_memory():
    drawn = np.random.default_rng(4)
    base = [bytes(drawn.integers(97, 123, 300, dtype=np.uint8)) for _ in range(175)]
    texts = [t for b in base for t in (b, b[:200] + b"xx", b[50:])] * 4
    tracemalloc.start()
    try:
        first, _ = RunLengthIndex(texts).long_matches(200)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(first) and peak < 70 * sum(map(len, texts))


def test_workers_of_suffix_dedup_hold_nothing_after_a_task():
    """In a process of its own, as the tests' one has memory to reuse."""
    code = """
import re
import numpy as np, pyarrow as pa
from geoloom.llm import suffix_dedup
used = lambda: int(re.search(r"RssAnon:\\s+(\\d+)", open("/proc/self/status").read())[1]) >> 10
drawn = np.random.default_rng(4)
texts = [bytes(drawn.integers(97, 123, 352, dtype=np.uint8)) for _ in range(1500)] * 4
table = pa.RecordBatch.from_pydict({"h": [k % 1500 for k in range(6000)], "row": list(range(6000)), "at": [0] * 6000, "single": [True] * 6000, "body": texts})
rows = pa.RecordBatch.from_pydict({"row": list(range(6000)), "text": [t.decode() for t in texts]})
for work, batch in ((suffix_dedup._index(200), table), (suffix_dedup._anchors(200, 48, False), rows)):
    before = used()
    found = sum(b.num_rows for b in work(iter([batch])))
    assert found, work
    assert used() - before < 40, (work, before, used())
"""
    subprocess.run([sys.executable, "-c", code], check=True)


def test_a_task_of_suffix_dedup_has_one_worker(docs):
    def workers(node) -> int:
        """Python nodes on one path, each a worker of the same task, down to a shuffle for a join."""
        if "Join" in node.nodeName():
            return 0
        return (node.nodeName() == "MapInArrow") + max((workers(node.children().apply(k)) for k in range(node.children().size())), default=0)

    assert workers(suffix_dedup.suffix_dedup(docs)._jdf.queryExecution().sparkPlan()) == 1


def test_cutting_takes_a_bounded_share_of_memory():
    raw = np.random.default_rng(4).integers(97, 123, 1 << 20, dtype=np.uint8)
    starts = np.arange(0, len(raw) + 1, 1 << 11)
    suffix_dedup._powers.clear()
    tracemalloc.start()
    try:
        found = suffix_dedup.cut(raw, starts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(found) == 6 and len(found[0]) and peak < 70 * len(raw)
