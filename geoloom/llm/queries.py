"""One query for each operator of this subpackage, over its whole table with production parameters, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm import bpe, decontaminate, exact_dedup, jaccard_join, langid, pii, quality, sharding, suffix_dedup, warc
from geoloom.llm.common import id_fold, table

#: Where the public tokenizer files are found; another place can be set in the session.
TOKENIZER_SETTING, TOKENIZER = "geoloom.tokenizer.path", "word_bpe_49k.json"


def tokenizer_path(spark: SparkSession) -> str:
    if named := spark.conf.get(TOKENIZER_SETTING, None):
        return named
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_<kind> counts base spans, as base_sha256 digests them; spans lists all, those the model adds among them by kind and start."""
    out = pii.detect(table(spark, sf_dir, "documents"))
    rank = lambda s: F.array_position(F.array(*map(F.lit, pii.KINDS)), s["kind"])
    line = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    ordered = F.transform(F.array_sort(F.transform(F.concat("base", "added"), lambda s: F.struct(rank(s).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select("doc_id", *map(count, pii.KINDS), F.sha2(line(F.col("base")).cast("binary"), 256).alias("base_sha256"), line(ordered).alias("spans"), F.size("added").cast("long").alias("n_added"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(spark, table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.mark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    forest = quality.fit_quality(docs, labels, id_fold("doc_id", 5) != 0)
    return quality.score(docs, forest).select("doc_id", (id_fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), keep="largest").drop("row_id")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode(table(spark, sf_dir, "documents"), tokenizer_path(spark))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), digest(F.concat_ws(" ", F.col("ids").cast("array<string>"))).alias("ids_sha256"), digest(F.col("decoded")).alias("decoded_sha256"))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit_languages(docs, id_fold("doc_id", 4) != 2)
    return langid.identify(docs, model, ["doc_id"]).select("doc_id", (id_fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents")).drop("row_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_suffix_dedup, op2_pii, op3_warc, op4_decontaminate, op5_quality, op6_exact_dedup, op7_sharding, op8_bpe, op9_langid, op10_jaccard_join)
}

_ASCII = f"'{exact_dedup.UPPER}', '{exact_dedup.LOWER}'"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

ORACLE_SQL: dict[str, str] = {
    "op3_warc": f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        d AS (SELECT page_id, html, strlen(html) AS payload_bytes, sha1(html) AS hex, min(page_id) OVER (PARTITION BY html) AS first_id FROM p)
        SELECT page_id, payload_bytes,
               array_to_string(list_transform(range(32), lambda k: substr('{_BASE32}',
                   1 + ((('0x' || substr(hex, 1 + 5 * (k // 4)::INT, 5))::INT >> (15 - 5 * (k % 4))::INT) & 31), 1)), '') AS payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
        FROM d""",
    "op6_exact_dedup": f"""
        WITH d AS (SELECT doc_id, translate(coalesce(text, ''), {_ASCII}) AS norm FROM documents),
        g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM d JOIN g USING (norm)""",
    "op10_jaccard_join": f"""
        WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), {_ASCII}), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(ws) - 3, 2)), lambda i: array_to_string(ws[i:i + 4], ' '))) AS shingle FROM w WHERE len(ws) > 0),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        r AS (SELECT shingle FROM s GROUP BY shingle HAVING count(*) > 1),
        o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_have
              FROM (SELECT * FROM s SEMI JOIN r USING (shingle)) a JOIN (SELECT * FROM s SEMI JOIN r USING (shingle)) b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * both_have >= 80 * (x.n + y.n - both_have)),
        c AS (SELECT doc_id, doc_id AS reached FROM w UNION SELECT c.doc_id, l.b FROM c JOIN l ON c.reached = l.a),
        k AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
        SELECT w.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(c.reached) AS component_id, coalesce(max(k.n_links), 0) AS n_links
        FROM w JOIN c ON c.doc_id = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN k ON k.a = w.doc_id GROUP BY w.doc_id""",
}
