"""From documents to packed training bins: each stage keeps or changes what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rollmill.functions.session import shared_dir, table
from rollmill.llm import decontam, neardup, packing, quality, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a toxicity score below the threshold; the field is fitted on labelled documents of the raw table.

    A null, empty or blank text has no toxic words and stays; rows without an id and repeated rows are judged by their texts.
    """
    field = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, field)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the graded model selects; it is fitted on labelled documents of the raw table.

    A null, empty or blank text is judged as one without words; rows without an id and repeated rows are judged by their texts.
    """
    model = quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.selected(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the first by doc_id, nulls last, then by text. Texts without words all stay."""
    return neardup.one_of_each(docs, 5, 80)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the spans they share with test items, and without those that are mostly such spans."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token of every document in one bin; a text without words has one row and no bin."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", cut_benchmark),
    ("packing", pack_bins),
]

#: Trained models and best-fit packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each written as Parquet in the shared folder and read again."""
    import uuid

    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
