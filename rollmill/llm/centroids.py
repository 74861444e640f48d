"""k-means over integer vectors, with a filter on rotated coordinates before exact distances.

Each vector is stored once with its leading coordinates after a rotation (principal axes of a bounded sample) and the length of what
the rest of the coordinates hold. The squared distance of two vectors is at least that of their leading coordinates plus the
squared difference of their rests, so centroids whose bound lies above an exact distance can't be nearest; those that remain are compared
in integers. The rotation changes what is compared, never the result.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmill.functions.session import checkpointed, shared_dir, ship
from rollmill.llm.text import unused

#: Leading coordinates that are stored.
LEAD = 16
#: Vectors that the axes are taken from, at most: those of the smallest seed hashes.
SAMPLE = 2048
#: Whole numbers below it in size have distances that 64 bits hold (to 64 * 2 ** 56 and beyond); larger ones are computed as Python's integers.
WIDE = 1 << 27
#: Bounds are taken to be off by at most this part of the vectors' squared lengths; doubles are off by far less.
SLACK = 1e-9
#: Sums are sent in two parts, so that no vector's components are too large for them.
PART = 1 << 40


@dataclass
class Axes:
    middle: np.ndarray
    turn: np.ndarray

    def rotated(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leading coordinates, and the length of the rest."""
        y = (x - self.middle) @ self.turn
        return np.ascontiguousarray(y[:, :LEAD]), np.sqrt((y[:, LEAD:] ** 2).sum(1))


def integers(x: np.ndarray) -> np.ndarray:
    """floor(1024 * x), exactly; as 64-bit integers where they and their distances fit."""
    y = np.floor(1024 * x)
    return y.astype(np.int64) if not y.size or np.abs(y).max() < WIDE else np.array([int(v) for v in y.ravel()], object).reshape(y.shape)


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def usable(column: Column, dims: int) -> Column:
    """A vector of ``dims`` components, each a finite number."""
    return F.coalesce((F.size(column) == dims) & F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def exact(rows: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Squared distances in integers, of rows to one centroid or to one each."""
    if rows.dtype == object or centre.dtype == object:
        rows, centre = rows.astype(object), centre.astype(object)
    d = rows - centre
    return (d * d).sum(1)


def nearest(rows: np.ndarray, lead: np.ndarray, rest: np.ndarray, centres: np.ndarray, c_lead: np.ndarray, c_rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest centroid of each row, the smallest number of several, its squared distance, and how many distances were worked out in full."""
    low = np.stack([((lead - c_lead[j]) ** 2).sum(1) + (rest - c_rest[j]) ** 2 for j in range(len(centres))], 1)
    size = (lead**2).sum(1) + rest**2
    c_size = (c_lead**2).sum(1) + c_rest**2
    low -= SLACK * (size[:, None] + c_size[None, :] + 1)
    best = low.argmin(1)
    far = exact(rows, centres[best])
    done = len(rows)
    guess = best.copy()
    for j in range(len(centres)):
        at = np.flatnonzero((guess != j) & (low[:, j] <= far.astype(np.float64) * (1 + SLACK)))
        if not len(at):
            continue
        d = exact(rows[at], centres[j])
        done += len(at)
        nearer = (d < far[at]) | ((d == far[at]) & (j < best[at]))
        best[at[nearer]], far[at[nearer]] = j, d[nearer]
    return best, far, done


@dataclass
class Clusters:
    centres: list[list[int]]
    vectors: DataFrame  # the kept rows: key columns, cluster, distance


def _stored(vectors: DataFrame, axes: Axes, dims: int, keys: list[str]) -> DataFrame:
    spark = vectors.sparkSession
    sent = spark.sparkContext.broadcast(axes)
    names = [*keys, "v"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lead, rest = sent.value.rotated(integers(matrix(batch.column(len(keys)), dims)).astype(np.float64))
            flat = pa.FixedSizeListArray.from_arrays(pa.array(lead.ravel()), lead.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, flat, pa.array(rest)], [*names, "lead", "rest"])

    folder = f"{shared_dir(spark)}/vectors-{uuid.uuid4().hex}"
    schema = vectors.withColumn("lead", F.array().cast("array<double>")).withColumn("rest", F.lit(0.0)).schema
    vectors.mapInArrow(run, schema).write.parquet(folder)
    return spark.read.parquet(folder)


def cluster(vectors: DataFrame, seed: Column, k: int = 8, rounds: int = 10, dims: int = 64, column: str = "embedding", keys: tuple[str, ...] = ("vec_id",)) -> Clusters:
    """k-means of floor(1024 * x) from the k vectors of the smallest ``seed`` values (nulls last; equal ones by the vector).

    Rows with a null vector, another number of components, or a component that is null or not finite are left out. In a round each vector goes to
    its nearest centroid (of several, the smallest number), and a centroid that has vectors to the floor of their mean. Fewer than k vectors make
    as many centroids; none give no rows. Repeated rows, and rows of one id, count each for themselves. A distance beyond 64 bits is
    null. Rounds move only a row for each component of each centroid from a task.
    """
    spark = vectors.sparkSession
    ship(spark)
    names = [unused(["v", "lead", "rest", "cluster", "distance"], x) for x in keys]
    kind = "array<float>" if vectors.schema[column].dataType.simpleString() == "array<float>" else "array<double>"
    own = vectors.where(usable(F.col(column), dims)).select(*[F.col(x).alias(y) for x, y in zip(keys, names, strict=True)], F.col(column).cast(kind).alias("v"), seed.alias("seed"))
    first = own.orderBy(F.col("seed").asc_nulls_last(), "v").select("v").limit(SAMPLE).toArrow().column("v").combine_chunks()
    if not len(first):
        return Clusters([], own.select(*[F.col(y).alias(x) for x, y in zip(keys, names, strict=True)], F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance")).limit(0))
    some = integers(matrix(first, dims))
    centres = some[:k]
    floats = some.astype(np.float64)
    middle = floats.mean(0)
    _, turn = np.linalg.eigh(np.cov((floats - middle).T, bias=True))
    axes = Axes(middle, turn[:, ::-1])
    rows = _stored(own.drop("seed"), axes, dims, names)
    totals = "cluster int, place int, n bigint, high decimal(38,0), low bigint"

    def assign(batch: pa.RecordBatch, sent) -> tuple[np.ndarray, np.ndarray, np.ndarray]:  # noqa: ANN001
        c, c_lead, c_rest = sent.value
        x = integers(matrix(batch.column("v"), dims))
        lead = matrix(batch.column("lead"), c_lead.shape[1])
        best, far, _ = nearest(x, lead, batch.column("rest").to_numpy(), c, c_lead, c_rest)
        return x, best, far

    def sums(sent):  # noqa: ANN001, ANN202
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n = len(sent.value[0])
            count, total = np.zeros(n, np.int64), np.zeros((n, dims), object)
            for batch in batches:
                x, best, _ = assign(batch, sent)
                for j in np.unique(best):
                    count[j] += int((best == j).sum())
                    total[j] += x[best == j].sum(0).astype(object)
            used = np.flatnonzero(count)
            flat = [int(t) for j in used for t in total[j]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(used, dims), pa.int32()), pa.array(np.tile(np.arange(dims), len(used)), pa.int32()), pa.array(np.repeat(count[used], dims)), pa.array([Decimal(t // PART) for t in flat], pa.decimal128(38, 0)), pa.array([t % PART for t in flat], pa.int64())],
                ["cluster", "place", "n", "high", "low"],
            )

        return run

    def sent_now():  # noqa: ANN202
        return spark.sparkContext.broadcast((centres, *axes.rotated(centres.astype(np.float64))))

    for _ in range(rounds):
        found = rows.select("v", "lead", "rest").mapInArrow(sums(sent_now()), totals).groupBy("cluster", "place")
        found = found.agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low")).collect()  # k * dims rows
        moved = [[int(v) for v in c] for c in centres]
        for r in found:
            moved[r.cluster][r.place] = (int(r.high) * PART + int(r.low)) // r.n
        if moved == [[int(v) for v in c] for c in centres]:
            break  # every further round would end here too
        wide = max(abs(v) for c in moved for v in c) >= WIDE
        centres = np.array(moved, object if wide else np.int64)

    last = sent_now()
    names_out = [*names, "cluster", "distance"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, best, far = assign(batch, last)
            fits = [int(d) if d < 1 << 63 else None for d in far] if far.dtype == object else far
            yield pa.RecordBatch.from_arrays([*[batch.column(x) for x in names], pa.array(best, pa.int32()), pa.array(fits, pa.int64())], names_out)

    schema = rows.select(*names, F.lit(0).cast("int").alias("cluster"), F.lit(None).cast("bigint").alias("distance")).schema
    out = checkpointed(rows.mapInArrow(run, schema))
    return Clusters([[int(v) for v in c] for c in centres], out.select(*[F.col(y).alias(x) for x, y in zip(keys, names, strict=True)], "cluster", "distance"))


def with_inertia(found: Clusters) -> DataFrame:
    """The rows with cluster_inertia, inertia and centroid_sha256: distances summed over a cluster and over all, and the digest of a cluster's centroid.

    A sum beyond 64 bits, or of a distance that is, is null.
    """
    spark = found.vectors.sparkSession
    part = found.vectors.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n"), F.count("distance").alias("m")).collect()  # a row for each centroid
    fits = lambda rows: total if all(r.n == r.m for r in rows) and (total := sum(int(r.s) for r in rows)) < 1 << 63 else None
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centres]
    table = spark.createDataFrame([(r.cluster, fits([r]), fits(part), shas[r.cluster]) for r in part], "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.vectors.join(F.broadcast(table), "cluster")  # a row for each centroid
