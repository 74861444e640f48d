"""Document fingerprints: MinHash by universal hash permutations over word shingles, and groups by joins of signature bands.

A permutation maps a 64-bit shingle hash x to the high 16 bits of the smallest ``a * x + b`` (mod 2**64, a odd). The
fingerprint is the values of 128 of them, as hex digits; the likeness of two is the share of equal values, corrected
for values that are equal by chance.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmill.functions.session import checkpointed, ship, small_side
from rollmill.llm.neardup import near_duplicates
from rollmill.llm.order import CELL, next_cells
from rollmill.llm.text import U64, mix, pieces, shingle_hashes

PERMUTATIONS = 128
WIDTH = 5
#: Shingles that are permuted at once: the temporary array has PERMUTATIONS times as many values.
CHUNK = 256
_FACTOR = mix(np.arange(1, PERMUTATIONS + 1, dtype=U64)) | U64(1)
_TERM = mix(np.arange(1, PERMUTATIONS + 1, dtype=U64) << U64(20))
_EMPTY = np.zeros(PERMUTATIONS, np.uint16)


def minhash(shingles: np.ndarray) -> np.ndarray:
    """128 values of 16 bits; no shingles give zeros."""
    if not len(shingles):
        return _EMPTY
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, U64)
    for a in range(0, len(shingles), CHUNK):
        part = _FACTOR[:, None] * shingles[None, a : a + CHUNK]
        part += _TERM[:, None]
        np.minimum(low, part.min(1), out=low)
    return (mix(low) >> U64(48)).astype(np.uint16)


def likeness(x: np.ndarray, y: np.ndarray) -> float:
    """0 to 1; of equal fingerprints 1. Chance gives 1 of 2**16 values."""
    same = float((x == y).mean())
    return max(0.0, (same - 2.0**-16) / (1 - 2.0**-16))


def signatures(texts: list[str | None], width: int = WIDTH) -> list[np.ndarray]:
    return [minhash(s) for p in pieces(pa.array(texts, pa.large_string())) for s in shingle_hashes(p.hashes(), p.first, width)]


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, fingerprint) of each row of docs (doc_id, text): 512 hex digits; zeros for a null, empty or blank text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [minhash(s).tobytes().hex() for p in pieces(batch.column(1)) for s in shingle_hashes(p.hashes(), p.first, width)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.string())], ["doc_id", "fingerprint"])

    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id bigint, fingerprint string")


def edited(text: str, following: str) -> str:
    """``text`` with its last third of characters replaced by the first as many, or all, of ``following``."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def with_edits(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Each document against its edited text and the next document, by descending doc_id (after the last: the first).

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next). A null text counts as
    empty; equal ids follow each other by descending text; a single document is followed by itself; rows without an id
    come last. Each text is moved once, to the cell of its id; the first text of each cell also to the cell above.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by cell, and in it by descending id with the first text of the cell below at the end."""
        ids, texts, marks = [], [], []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            texts += batch.column(1).to_pylist()
            marks += batch.column(2).to_pylist()
            if len(ids) > GROUP_ROWS:
                yield from out(ids, texts, marks)
                ids, texts, marks = ids[-1:], texts[-1:], marks[-1:]
        yield from out(ids, texts, marks)

    def out(ids: list, texts: list[str], marks: list[bool]) -> Iterator[pa.RecordBatch]:
        whole = signatures(texts, width)
        rows = [k for k in range(len(ids) - 1) if not marks[k]]
        new = [edited(texts[k], texts[k + 1]) for k in rows]
        after = signatures(new, width)
        columns = [
            pa.array([ids[k] for k in rows], pa.int64()),
            pa.array([len(texts[k]) for k in rows], pa.int64()),
            pa.array([hashlib.sha256(x.encode()).hexdigest() for x in new], pa.string()),
            pa.array([whole[k].tobytes().hex() for k in rows], pa.string()),
            pa.array([x.tobytes().hex() for x in after], pa.string()),
            pa.array([likeness(whole[k], x) for k, x in zip(rows, after, strict=True)], pa.float64()),
            pa.array([likeness(whole[k], whole[k + 1]) for k in rows], pa.float64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    ship(docs.sparkSession)
    id_ = F.col("doc_id").cast("bigint")
    own = docs.select(F.coalesce(id_, F.lit(-(1 << 63))).alias("at"), id_.isNotNull().alias("named"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("cell", F.floor(F.col("at") / CELL))
    heads = own.groupBy("cell").agg(F.max(F.struct("at", "named")).alias("head")).select("cell", "head.*")
    heads = checkpointed(next_cells(heads.select("cell")).join(heads, "cell"))
    # the first row of each cell, again, behind the last of the cell above
    again = own.drop("cell").join(small_side(heads, heads.count(), 48), ["at", "named"]).groupBy("at", "named", "above").agg(F.max("text").alias("text"))
    again = again.select("at", "named", "text", F.col("above").alias("cell"), F.lit(True).alias("again"))
    rows = own.withColumn("again", F.lit(False)).unionByName(again).repartition("cell")
    rows = rows.sortWithinPartitions(F.col("cell"), F.col("again"), F.col("at").desc(), F.col("named").desc(), F.col("text").desc())
    schema = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return rows.select(F.when(F.col("named"), F.col("at")).alias("doc_id"), "text", "again").mapInArrow(run, schema)


#: Rows whose texts a task holds at once in with_edits.
GROUP_ROWS = 256


def near_groups(docs: DataFrame, width: int = WIDTH, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row of docs (doc_id, text): near duplicates by bands of the fingerprints' values.

    Bands of four values are joined, candidates are estimated from their fingerprints, and links are verified by the Jaccard similarity
    of full shingle sets, in components and blocks as neardup does; its docstring tells how nulls, ties and repeated rows are treated.
    """
    return near_duplicates(docs, width, percent, minhash, _by_chance)


def _by_chance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.full(np.shape(a), PERMUTATIONS * 2.0**-16)
