"""Every registered query over the smallest tables: its columns and digests against plain code, and held-out quality."""

import hashlib
import re
import zlib

import pytest

import corpus_pipeline
from geoloom.llm import pii
from geoloom.llm.queries import QUERIES, tokenizer_path
from tests.llm.test_operators import joined, plain_matches

SF = "/root/testdata/sf0.001"
TRAINED = "/root/testdata/sf0.01"
COLUMNS = {
    "op1_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256", "op2_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans", "op3_warc": "page_id payload_bytes payload_digest record_type refers_to",
    "op4_decontaminate": "doc_id contaminated n_windows items", "op5_quality": "doc_id held_out score predicted", "op6_exact_dedup": "doc_id keep_id group_size kept text_sha256", "op7_sharding": "doc_id shard_id",
    "op8_bpe": "doc_id n_tokens ids_sha256 decoded_sha256", "op9_langid": "doc_id held_out lang_pred score", "op10_jaccard_join": "doc_id n_shingles component_id n_links",
}


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op5_quality", "op9_langid"}))
def test_query(spark, texts, name):
    out = QUERIES[name](spark, SF)
    assert out.columns[: len(COLUMNS[name].split())] == COLUMNS[name].split()
    rows = out.collect()
    if name != "op3_warc":
        assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    got = {r[0]: r for r in rows}
    if name == "op1_suffix_dedup":
        raws, seen = {i: t.encode() for i, t in texts.items()}, set()
        twice = set()
        for raw in raws.values():
            for k in range(len(raw) - 199):
                h = hash(raw[k : k + 200])
                (twice if h in seen else seen).add(h)
        for i, raw in raws.items():
            gone = bytearray(len(raw))
            for k in range(len(raw) - 199):
                if hash(raw[k : k + 200]) in twice:
                    gone[k : k + 200] = b"\x01" * 200
            spans = len(re.findall(b"\x01+", gone))
            kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
            assert tuple(got[i])[1:5] == (len(raw), sum(gone), spans, sha(kept))
    if name == "op2_pii":
        for i, text in texts.items():
            base = pii.base_spans(text)
            assert tuple(got[i])[1:5] == tuple(len(base[k]) for k in pii.KINDS)
            assert got[i]["base_sha256"] == sha(",".join(f"{k}:{s}:{e}" for k in pii.KINDS for s, e in base[k]))
            spans = [x.split(":") for x in got[i]["spans"].split(",") if x]
            assert spans == sorted(spans, key=lambda x: (pii.KINDS.index(x[0]), int(x[1]), int(x[2]))) and {(k, s, e) for k in base for s, e in base[k]} <= {(k, int(s), int(e)) for k, s, e in spans}
    if name == "op4_decontaminate":
        items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
        for i, text in texts.items():
            found, n = plain_matches(text, items)
            assert tuple(got[i])[1:4] == (n > 0, n, found)
    if name == "op8_bpe":
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(tokenizer_path(spark))
        for i, text in texts.items():
            ids = library.encode(text, add_special_tokens=False).ids
            assert tuple(got[i])[1:4] == (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


def test_quality_on_held_out_documents(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op5_quality"](spark, TRAINED).collect()}
    known = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{TRAINED}/labels.parquet").collect() if r["quality"] is not None}
    assert all(r["held_out"] == (fold(i, 5) == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for i, r in rows.items())
    held = [i for i in known if i in rows and rows[i]["held_out"]]
    right = sum(rows[i]["predicted"] == known[i] for i in held) / len(held)
    pairs = [(rows[i]["score"], rows[j]["score"]) for i in held if known[i] for j in held if not known[j]]
    area = sum((a > b) + 0.5 * (a == b) for a, b in pairs) / len(pairs)
    print(f"quality: {len(held)} held out, {right:.3f} right, area {area:.3f}")
    assert right >= 0.85 and area >= 0.9


def test_languages_of_held_out_documents(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op9_langid"](spark, TRAINED).collect()}
    known = {r["doc_id"]: (r["lang"], r["text"]) for r in spark.read.parquet(f"{TRAINED}/documents.parquet").collect()}
    assert rows.keys() == known.keys() and all(r["held_out"] == (fold(i, 4) == 2) for i, r in rows.items())
    held = [i for i, (lang, text) in known.items() if rows[i]["held_out"] and lang and text and any(map(str.isalpha, text))]
    right = sum(rows[i]["lang_pred"] == known[i][0] for i in held) / len(held)
    print(f"languages: {len(held)} held out, {right:.3f} right, {sum(rows[i]['rejected'] for i in held)} rejected")
    assert right >= 0.98 and sum(rows[i]["rejected"] for i in held) <= 0.02 * len(held)


def test_pipeline_matches_brute_force_behind_the_learned_stage(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    left = [(r["doc_id"], r["text"]) for r in corpus_pipeline.language_id(spark, docs, SF).collect()]
    first = {}
    for i, text in sorted(left):
        first.setdefault(re.sub("[A-Z]", lambda m: m[0].lower(), text), (i, text))
    left = list(first.values())
    least = joined(left)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = [(i, t) for i, t in left if least[i] == i and not plain_matches(t, items)[1]]
    library = Tokenizer.from_file(tokenizer_path(spark))
    want = {}
    for i, text in left:
        ids = library.encode(text, add_special_tokens=False).ids
        want[i] = (ids, len(ids), sha(library.decode(ids, skip_special_tokens=False)))
    assert {r["doc_id"]: (list(r["ids"]), r["n_tokens"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, SF).collect()} == want and len(want) > 50


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_of_no_documents(spark, stage):
    none = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    assert dict(corpus_pipeline.STAGES)[stage](spark, none, SF).count() == 0
