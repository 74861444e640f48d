"""Files that are one JSON array of objects each, however large: scanned in blocks side by side, never held as a whole.

A file is cut at closing braces, and a block is scanned without knowing what came before it: for a start outside and inside of a string it tells where it
ends, and at which depths braces close. A row for each block is then put in order, which gives every block its start; the second scan cuts out
the members. A task holds one piece and the member that it is in.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollmill.functions.session import BROADCAST_BYTES, checkpointed, ship

_STRING = re.compile(r'"(?:[^"\\]|\\.)*"', re.DOTALL)
_REST = re.compile(r'(?:[^"\\]|\\.)*"', re.DOTALL)  # of a string that has begun
#: A block's start, as a broadcast row.
START_BYTES = 512


def scanned(piece: str, inside: bool) -> tuple[bool, int]:
    """Whether a piece ends inside a string, and its opening braces outside of strings, for one that starts inside of a string or not."""
    if inside:
        m = _REST.match(piece)
        if m is None:
            return True, 0
        piece = piece[m.end() :]
    plain = _STRING.sub("", piece)
    at = plain.find('"')
    return at >= 0, (plain if at < 0 else plain[:at]).count("{")


def _blocks(batches: Iterator[pa.RecordBatch], more: int = 0) -> Iterator[tuple[tuple, list[str]]]:
    """(file, block and ``more`` further columns) with pieces of it, in order; the pieces of a block may come in several lists."""
    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
        begin = 0
        for k in range(1, batch.num_rows + 1):
            if k == batch.num_rows or columns[0][k] != columns[0][begin] or columns[1][k] != columns[1][begin]:
                yield tuple(c[begin] for c in columns[: 2 + more]), columns[-1][begin:k]
                begin = k


_OUTLOOK = "file string, block bigint, inside boolean, ends_inside boolean, change bigint, closes array<struct<depth: bigint, n: bigint>>"
_SCHEMA = pa.schema([("file", pa.string()), ("block", pa.int64()), ("inside", pa.bool_()), ("ends_inside", pa.bool_()), ("change", pa.int64()), ("closes", pa.list_(pa.struct([("depth", pa.int64()), ("n", pa.int64())])))])


def _outlook(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each block and start: where it ends, its change of depth, and how often a brace closes at each depth that is met."""
    now, states = None, []

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(
            [{"file": now[0], "block": now[1], "inside": bool(k), "ends_inside": inside, "change": depth, "closes": [{"depth": d, "n": n} for d, n in sorted(closes.items())]} for k, (inside, depth, closes) in enumerate(states)], _SCHEMA
        )

    for at, pieces in _blocks(batches):
        if at != now:
            if now is not None:
                yield rows()
            now, states = at, [(False, 0, Counter()), (True, 0, Counter())]
        for k, (inside, depth, closes) in enumerate(states):
            for piece in pieces:
                inside, opened = scanned(piece, inside)
                depth += opened
                if not inside:
                    depth -= 1
                    closes[depth] += 1
            states[k] = (inside, depth, closes)
    if now is not None:
        yield rows()


def _starts(outlook: DataFrame) -> DataFrame:
    """(file, block, inside, depth, member) where each block starts, and one row with a null block for the end of each file."""
    pick = lambda x, inside: F.when(inside, x["within"]).otherwise(x["outside"])
    side = F.struct("ends_inside", "change", "closes")
    blocks = outlook.groupBy("file", "block").agg(F.first(F.when(F.col("inside"), side), True).alias("within"), F.first(F.when(~F.col("inside"), side), True).alias("outside"))
    listed = blocks.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("block", "within", "outside")), lambda a, b: F.when(a["block"] < b["block"], -1).when(a["block"] > b["block"], 1).otherwise(0)).alias("all"))
    start = F.struct(F.lit(False).alias("inside"), F.lit(0).cast("bigint").alias("depth"), F.lit(0).cast("bigint").alias("member"))

    def after(a: Column, x: Column) -> Column:
        seen = pick(x, a["inside"])
        ended = F.aggregate(F.filter(seen["closes"], lambda c: c["depth"] == -a["depth"]), F.lit(0).cast("bigint"), lambda n, c: n + c["n"])
        return F.struct(seen["ends_inside"].alias("inside"), (a["depth"] + seen["change"]).alias("depth"), (a["member"] + ended).alias("member"))

    path = F.aggregate("all", F.array(start), lambda done, x: F.concat(done, F.array(after(F.element_at(done, -1), x))))
    placed = listed.select("file", F.transform("all", lambda x: x["block"]).alias("blocks"), path.alias("path"))
    return placed.select("file", "blocks", F.posexplode("path").alias("k", "s")).select("file", F.get("blocks", F.col("k")).alias("block"), "s.*")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, name, member, block, whole, text): the part of each member that is in a block; whole ones are all there."""
    now, out = None, []

    def part(whole: bool) -> None:
        out.append({"file": now[0], "name": now[2], "member": member, "block": now[1], "whole": whole, "text": "".join(held)})

    def rows() -> Iterator[pa.RecordBatch]:
        if out:
            yield pa.RecordBatch.from_pylist(out, _PART)
            out.clear()

    for at, pieces in _blocks(batches, 4):
        if at != now:
            if now is not None and held:
                part(False)
            now, (inside, depth, member) = at, at[3:]
            began, held = depth == 0 and not inside, []
        for piece in pieces:
            inside, opened = scanned(piece, inside)
            depth += opened
            if not inside and depth == 0:
                if piece.strip().strip(",[] \n\r\t"):
                    raise ValueError(f"{now[2]}: a member of the array is no object")
                continue  # behind the last member
            held += [piece, "}"]
            if not inside:
                depth -= 1
                if depth == 0:
                    part(began)
                    member, began, held = member + 1, True, []
        yield from rows()
    if now is not None and held:
        part(False)
    yield from rows()


_PART = pa.schema([("file", pa.string()), ("name", pa.string()), ("member", pa.int64()), ("block", pa.int64()), ("whole", pa.bool_()), ("text", pa.string())])


def member_texts(spark: SparkSession, path: str) -> DataFrame:
    """(raw_file, source_index, text) of every member of the arrays in files, which are objects; text is the member's JSON.

    An empty array, or an empty file, has no members. A file that ends inside of a member, and a member that is no object, are errors. What a task
    holds grows with a member, not with its file.
    """
    ship(spark)
    text = spark.read.option("lineSep", "}").text(path)
    meta = F.col("_metadata")
    pieces = text.select(meta["file_path"].alias("file"), meta["file_block_start"].alias("block"), meta["file_name"].alias("name"), F.col("value").alias("piece"))
    starts = checkpointed(_starts(pieces.select("file", "block", "piece").mapInArrow(_outlook, _OUTLOOK)))
    if not starts.where("block is null and (inside or depth <> -1)").isEmpty():
        raise ValueError(f"{path}: not whole arrays")
    if starts.count() * START_BYTES > BROADCAST_BYTES:
        raise ValueError(f"{path}: too many blocks; read fewer files, or larger blocks (spark.sql.files.maxPartitionBytes)")
    known = F.broadcast(starts.where("block is not null"))  # START_BYTES for each block: checked above
    cut = pieces.join(known, ["file", "block"]).select("file", "block", "name", "inside", "depth", "member", "piece")
    parts = cut.mapInArrow(_cut, "file string, name string, member bigint, block bigint, whole boolean, text string")
    split = parts.where("not whole").groupBy("file", "name", "member").agg(F.array_sort(F.collect_list(F.struct("block", "text"))).alias("all"))  # one member's parts
    every = parts.where("whole").select("name", "member", "text").unionAll(split.select("name", "member", F.array_join(F.transform("all", lambda x: x["text"]), "")))
    return every.select(F.col("name").alias("raw_file"), F.col("member").alias("source_index"), F.regexp_replace("text", r"^[\s,\[]+", "").alias("text"))
