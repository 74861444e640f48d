"""Best-fit packing of documents into token bins, under conflicts between sources and duplicate clusters.

Pieces are dealt to shards of bounded size by a hash; in each shard they are placed by falling length. Open bins are
ordered by what is left in them, and each carries bitmaps: its duplicate clusters, and one for each place that a source may
take. The search starts at the successor of the piece's length and goes on to the tightest bin without a conflict.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmill.functions.session import checkpointed, ship
from rollmill.llm.text import U64, mix, pieces

CAPACITY = 4096
PER_SOURCE = 4
SHARD_PIECES = 4096
#: Equal rows that are numbered in one list.
COPIES = 1 << 16


def best_fit(lengths: list[int], sources: list, clusters: list, capacity: int, per_source: int) -> list[int]:
    """The bin of each piece. Pieces must come by falling length; equal input gives equal bins.

    No bin holds two pieces of one cluster (None: no cluster) or more than ``per_source`` of one source.
    """
    bit: dict = {}
    open_: list[tuple[int, int]] = []
    cluster_maps: list[int] = []
    source_maps: list[list[int]] = []  # source_maps[b][k]: sources with more than k pieces in bin b
    out = []
    for length, source, cluster in zip(lengths, sources, clusters, strict=True):
        s = 1 << bit.setdefault(("s", source), len(bit))
        c = 0 if cluster is None else 1 << bit.setdefault(("c", cluster), len(bit))
        for k in range(bisect_left(open_, (length, -1)), len(open_)):
            left, b = open_[k]
            if not (cluster_maps[b] & c or source_maps[b][-1] & s):
                del open_[k]
                break
        else:
            left, b = capacity, len(cluster_maps)
            cluster_maps.append(0)
            source_maps.append([0] * per_source)
        cluster_maps[b] |= c
        planes = source_maps[b]
        planes[next(k for k in range(per_source) if not planes[k] & s)] |= s
        if left > length:
            insort(open_, (left - length, b))
        out.append(b)
    return out


def _measured(docs: DataFrame, size: str | None, cluster: str | None) -> DataFrame:
    """(doc_id, source, n, cluster) of each row: its words, and the hash of their sequence in lower case, which marks copies; or the columns given for them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, clusters = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for piece in pieces(batch.column(4)):
                words, count = piece.hashes(), piece.count
                place = np.arange(len(words)) - np.repeat(piece.first[:-1], count)
                whole = np.zeros(len(words) + 1, U64)
                np.cumsum(mix(words ^ mix(place.astype(U64))), out=whole[1:])
                sizes.append(count)
                clusters.append(mix(whole[piece.first[1:]] - whole[piece.first[:-1]] + count.astype(U64)).view(np.int64))
            n = batch.column(2) if size else pa.array(np.concatenate(sizes))
            c = batch.column(3) if cluster else pa.array(np.concatenate(clusters))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), n, c], ["doc_id", "source", "n", "cluster"])

    given = [F.greatest(F.coalesce(F.col(size).cast("bigint"), F.lit(0)), F.lit(0)) if size else F.lit(0).cast("bigint"), F.col(cluster).cast("bigint") if cluster else F.lit(None).cast("bigint")]
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), given[0].alias("n"), given[1].alias("cluster"), *([] if size and cluster else [F.col("text").cast("string").alias("text")]))
    return own if size and cluster else own.mapInArrow(run, "doc_id bigint, source string, n bigint, cluster bigint")


def _numbered(rows: DataFrame) -> DataFrame:
    """rows with ``copy``, from 0, among rows that are equal in all columns: counted and dealt out again, as equal rows can't be told apart."""
    counted = checkpointed(rows.groupBy(*rows.columns).agg(F.count("*").alias("copies")))
    last = F.col("copies") - 1
    blocks = counted.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(last / COPIES))))
    return blocks.withColumn("copy", F.explode(F.sequence(F.col("block") * COPIES, F.least(last, F.col("block") * COPIES + (COPIES - 1))))).drop("copies", "block")


def pack(docs: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE, shard_pieces: int = SHARD_PIECES, size: str | None = None, cluster: str | None = None) -> DataFrame:
    """(doc_id, piece, first_token, n_tokens, source, bin_id, bin_tokens): every token of docs (doc_id, text, source) in one bin.

    Tokens are words between ASCII white space, or as many as the column ``size`` says (a null or negative one is 0); texts are read once. A longer
    document than ``capacity`` is cut into full pieces, each a bin of its own that is named after the row, and a rest. Documents whose words are
    equal but for case (A-Z), or those of one value in the column ``cluster`` (null: none), are a duplicate cluster. A null
    source is a source of its own; a null doc_id is a row like others. A null, empty or blank text has one row with 0 tokens and no bin.
    Repeated rows, and rows of one id with other texts, are placed each for itself; ties by doc_id, piece, cluster, source; an empty
    table gives no rows; other columns aren't read. Shards and names come from the rows alone: bins don't depend on partitions.
    """

    def run(keys: tuple, blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(blocks)).sort_by([("n_tokens", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("cluster", "ascending"), ("source", "ascending")])
        lengths = rows.column("n_tokens").to_pylist()
        bins = best_fit(lengths, rows.column("source").to_pylist(), rows.column("cluster").to_pylist(), capacity, per_source)
        filled = [0] * (max(bins) + 1)
        for b, n in zip(bins, lengths, strict=True):
            filled[b] += n
        shard = keys[0].as_py()
        named = rows.select(["doc_id", "piece", "first_token", "n_tokens", "source"]).append_column("bin_id", pa.array([f"{shard:08d}-{b:06d}" for b in bins], pa.string()))
        yield from named.append_column("bin_tokens", pa.array([filled[b] for b in bins], pa.int64())).to_batches()

    ship(docs.sparkSession)
    own = _numbered(_measured(docs, size, cluster))
    last = F.greatest(F.ceil(F.col("n") / capacity) - 1, F.lit(0))
    cut = own.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    first = F.col("piece") * F.lit(capacity).cast("bigint")
    same = F.xxhash64("n", F.coalesce("source", F.lit("")), F.col("source").isNull(), F.coalesce("cluster", F.lit(0)), F.col("cluster").isNull())
    cut = cut.select(same.alias("same"), "copy", "doc_id", "piece", first.alias("first_token"), F.least(F.lit(capacity).cast("bigint"), F.col("n") - first).alias("n_tokens"), "source", "cluster")
    shards = max(1, -(-own.count() // shard_pieces))
    # one shard for about shard_pieces rows, whatever their ids: copies of a row have other numbers
    row = [F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNull(), F.col("same"), F.col("copy")]
    dealt = cut.where(F.col("n_tokens").between(1, capacity - 1)).withColumn("shard", F.pmod(F.xxhash64(*row, F.lit(7)), F.lit(shards))).drop("same", "copy")
    schema = "doc_id bigint, piece bigint, first_token bigint, n_tokens bigint, source string, bin_id string, bin_tokens bigint"
    packed = dealt.groupBy("shard").applyInArrow(run, schema)
    alone = cut.where(~F.col("n_tokens").between(1, capacity - 1))
    name = F.when(F.col("n_tokens") > 0, F.concat_ws("-", F.lit("full"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.lower(F.hex("same")), "copy", "piece"))
    return packed.unionAll(alone.select("doc_id", "piece", "first_token", "n_tokens", "source", name.alias("bin_id"), F.col("n_tokens").alias("bin_tokens")))
