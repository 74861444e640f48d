"""One query for each operator, over its whole table, with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollmill.functions.session import shared_dir, table
from rollmill.llm import centroids, decontam, fingerprints, licenses, lm, manifest, neardup, packing, quality, rules, sql, tokens, toxicity, warc


def fold(of: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(of))


def tokenizer(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_lm_scores(spark: SparkSession, d: str) -> DataFrame:
    return lm.score_texts(table(spark, d, "documents"), fold(7) == 2)


def op2_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return tokens.token_counts(table(spark, d, "documents"), tokenizer(), 4096)


def op3_near_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, d, "documents"), 4, 80)


def op4_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "documents"))


def op5_quality(spark: SparkSession, d: str) -> DataFrame:
    docs, held = table(spark, d, "documents").select("doc_id", "text"), F.coalesce(fold(4) == 2, F.lit(False))
    model = quality.train(docs, table(spark, d, "labels").where(~held))
    out = quality.score_quality(docs, model)
    return out.select("doc_id", held.alias("held_out"), "expected_grade", "tail_probability", (F.col("tail_probability") >= quality.SELECT_AT).alias("selected"))


def op6_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs, held = table(spark, d, "documents").select("doc_id", "text"), F.coalesce(fold(4) == 2, F.lit(False))
    field = toxicity.train(docs, table(spark, d, "labels").where(~held))
    out = toxicity.score_toxicity(docs, field, spans=True)
    return out.select("doc_id", held.alias("held_out"), F.col("toxic_score").alias("score"), (F.col("toxic_score") >= toxicity.PREDICT_AT).cast("int").alias("predicted"), F.size("toxic_spans").alias("n_spans"), F.col("toxic_spans").alias("spans"))


def op7_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return fingerprints.with_edits(table(spark, d, "documents"))


def near_groups_by_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return fingerprints.near_groups(table(spark, d, "documents"))


def op8_licenses(spark: SparkSession, d: str) -> DataFrame:
    """The table has no paths: source, then a thousand ids to a folder, stand for them."""
    docs = table(spark, d, "documents")
    path = F.concat_ws("/", "source", F.floor(F.col("doc_id") / 1000).cast("string"), F.col("doc_id").cast("string"))
    return licenses.scan_licenses(docs.select("doc_id", path.alias("path"), "text"))


def op9_warc(spark: SparkSession, d: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_archives(table(spark, d, "pages"), folder)
    return warc.read_archives(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontam.contamination(table(spark, d, "documents"), table(spark, d, "benchmark"), 10)


def op11_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return rules.judged(docs, rules.ngram_weights(docs, table(spark, d, "labels").where("quality > 0")))


def op12_centroids(spark: SparkSession, d: str) -> DataFrame:
    found = centroids.cluster(table(spark, d, "embeddings"), F.sha2(F.concat(F.lit("3:"), F.col("vec_id").cast("string")).cast("binary"), 256))
    return centroids.with_inertia(found).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_manifest(spark: SparkSession, d: str) -> DataFrame:
    return manifest.manifest(table(spark, d, "documents"), F.coalesce(fold(3) == 0, F.lit(False)), manifest.lower_ascii(F.col("text")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_lm_scores, op2_token_counts, op3_near_duplicates, op4_packing, op5_quality, op6_toxicity, op7_fingerprints, op8_licenses, op9_warc, op10_decontamination, op11_quality_rules, op12_centroids, op13_manifest, near_groups_by_fingerprints)}


#: SQL for those operators of which it can express the result and DuckDB can run it on whole tables.
ORACLE_SQL = {
    "op9_warc": """
        with p as (
            select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages
        ), f as (
            select *, case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest) end as first_id from p
        )
        select page_id, payload_bytes, payload_digest,
            case when first_id < page_id then 'revisit' else 'response' end as record_type,
            case when first_id < page_id then first_id end as refers_to
        from f
    """,
    "op11_quality_rules": sql.rules(rules.BUCKETS, rules.PRIOR, rules.LEAST_RATIO, rules.UNIT, rules.PAIR, rules.LEAST_WORDS, rules.MOST_REPEATED),
    "op12_centroids": sql.k_means(8, 10, 64),
    "op13_manifest": sql.merkle(manifest.FAN, 7, 3),
}
