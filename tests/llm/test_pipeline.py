"""The pipeline, stage by stage, against brute force, and its handling of odd rows."""

import re

import corpus_pipeline
from tests.llm.test_operators import joined, plain_matches

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    odd = spark.createDataFrame([(None, None, None, None, None), (900001, "", "en", "s", 0), (900002, "zwölf", None, None, 5), (0, "1 2 3", "en", "s", 5)], docs.schema)
    rows = docs.union(odd).union(docs.limit(3))
    kept = [(r["doc_id"], r["text"]) for r in rows.collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "exact_dedup", "near_dedup", "decontamination", "bpe"]

    def run(name, frame):
        path = corpus_pipeline.fresh_dir(spark, "test")
        stages[name](spark, frame, SF).write.parquet(path)
        out = spark.read.parquet(path)
        assert name == "bpe" or out.columns == names
        return out

    frame = run("language_id", rows)
    left = [(r["doc_id"], r["text"]) for r in frame.collect()]
    letters = [(i, t) for i, t in kept if t and any(map(str.isalpha, t))]
    assert set(left) <= set(letters) and len(left) >= 0.98 * len(letters)

    frame = run("exact_dedup", frame)
    best = {}
    for i, t in left:
        key = re.sub("[A-Z]", lambda m: m[0].lower(), t)
        best[key] = min(best.get(key, (i, t)), (i, t), key=lambda r: r[0])
    left = [(r["doc_id"], r["text"]) for r in frame.collect()]
    assert sorted(left) == sorted(best.values())

    frame = run("near_dedup", frame)
    least = joined(left)
    left = [(i, t) for i, t in left if least[i] == i]
    assert sorted((r["doc_id"], r["text"]) for r in frame.collect()) == sorted(left)

    frame = run("decontamination", frame)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = [(i, t) for i, t in left if not plain_matches(t, items)[1]]
    assert not any(x and x in t for _, t in want for _, x in items)
    assert sorted((r["doc_id"], r["text"]) for r in frame.collect()) == sorted(want)
    assert run("bpe", frame).count() == len(want)
