"""A bounded sample of labelled documents, on which the classifiers are fitted."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Labelled documents of each class that a classifier is fitted on, at most.
PER_CLASS = 4000
#: Bytes of their texts in each class, at most: the documents of the smallest hashes are taken until the next one would go beyond.
CLASS_BYTES = 6 << 20
#: Classes at most: with PER_CLASS the bound of the sample's size.
CLASSES = 16


def labelled_sample(docs: DataFrame, labels: DataFrame, grade: Column, per_class: int = PER_CLASS, class_bytes: int = CLASS_BYTES) -> tuple[pa.Table, dict[int, int]]:
    """(grade, text) of the labelled documents with the smallest hashes in each class, and each class's label count.

    labels has one row for a document or several (the largest grade counts); rows without a doc_id, grade or document
    are left out; of several documents of one id each counts. The sample is at most CLASSES * per_class documents and CLASSES * class_bytes
    bytes of text, whatever the tables' sizes; a class of which the first text is larger has that one.
    """
    graded = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), grade.cast("int").alias("grade"))
    graded = graded.where("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.max("grade").alias("grade"))
    totals = {r.grade: r.n for r in graded.groupBy("grade").agg(F.count("*").alias("n")).orderBy("grade").limit(CLASSES + 1).collect()}
    if len(totals) > CLASSES:
        raise ValueError(f"more than {CLASSES} classes")
    chosen = None
    for g in totals:
        some = graded.where(F.col("grade") == g).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = some if chosen is None else chosen.unionAll(some)
    if chosen is None:
        return pa.table({"grade": pa.array([], pa.int32()), "text": pa.array([], pa.string())}), totals
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = own.join(F.broadcast(chosen), "doc_id")  # CLASSES * PER_CLASS rows of 12 bytes at most
    found = found.select("grade", "text", F.xxhash64("doc_id").alias("first"), F.xxhash64("doc_id", "text").alias("at"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"))
    # at most per_class rows of a class, so these windows are bounded
    order = Window.partitionBy("grade").orderBy("first", "at")
    found = found.withColumns({"n": F.row_number().over(order), "upto": F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))})
    return found.where((F.col("n") == 1) | ((F.col("upto") <= class_bytes) & (F.col("n") <= per_class))).select("grade", "text", "at").toArrow().sort_by("at"), totals
