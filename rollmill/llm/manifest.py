"""Merkle manifest of a table: a digest for each row, a tree for each group, one root, and what proves a row against it.

Leaves are numbered in their group; a node is labelled by the interval [lo, hi) of leaf numbers that it covers. A level's runs are
``FAN`` nodes whose intervals lie in one bucket of the next level, so no group of rows is larger than FAN, however large a tree is.
Ancestors are attached from the root down by joins on (tree, bucket) of nodes whose interval contains the node's; the parts of a parent's
interval outside a node's own are its siblings.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmill.functions.ranks import ranked
from rollmill.functions.session import checkpointed, ship, small_side

FAN = 8
#: Fields of a leaf, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _sha(x: Column) -> Column:
    return F.sha2(x.cast("binary"), 256)


def leaf_digest(**changed: Column) -> Column:
    """The digest of a row: of each field its bytes' count, a colon and its value, or - for a null."""

    def field(name: str) -> Column:
        x = changed.get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-"))

    return _sha(F.concat(*[field(name) for name in FIELDS]))


def _spread(nodes: DataFrame, level: int) -> DataFrame:
    """The next level's nodes: every run of FAN neighbours with the digest of its digests. nodes: tree, n, lo, hi, digest."""
    run = F.floor(F.col("lo") / F.lit(FAN ** (level + 1)).cast("bigint")).cast("bigint")
    kids = F.sort_array(F.collect_list(F.struct("lo", "hi", "digest")))  # FAN at most
    up = nodes.withColumn("bucket", run).groupBy("tree", "n", "bucket").agg(kids.alias("kids"))
    return up.select("tree", "n", "bucket", F.array_min("kids.lo").alias("lo"), F.array_max("kids.hi").alias("hi"), _sha(F.array_join("kids.digest", "")).alias("digest"), "kids")


def build(leaves: DataFrame) -> list[DataFrame]:
    """The levels above leaves (tree, n, lo, hi, digest), n being the leaves of the tree; a tree goes on to a level while it has several nodes."""
    levels, nodes, level = [], leaves, 0
    most = leaves.agg(F.max("n").alias("n")).first().n or 0
    while FAN**level < most:
        nodes = checkpointed(_spread(nodes.where(F.col("n") > FAN**level), level))
        levels.append(nodes)
        level += 1
    return levels


def roots(leaves: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(tree, digest) of every tree."""
    out = leaves.where("n = 1").select("tree", "digest")
    for k, nodes in enumerate(levels, 1):
        out = out.unionAll(nodes.where((F.col("n") > FAN ** (k - 1)) & (F.col("n") <= FAN**k)).select("tree", "digest"))
    return out


def attach(leaves: DataFrame, levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """leaves, all columns, with ``top`` (what tops has for their tree) and ``path``: the siblings to the left and right of each ancestor-or-self, leaf first.

    tops: tree, top, path (the way on from a tree's root).
    """
    nothing = F.array().cast("array<struct<left:string,right:string>>")

    def joined(nodes: DataFrame, level: int, above: DataFrame | None) -> DataFrame:
        ends = nodes.where((F.col("n") <= FAN**level) & (F.col("n") > (FAN ** (level - 1) if level else 0))).join(tops, "tree").withColumn("path", F.coalesce("path", nothing))
        if above is None:
            return ends
        upper = above.select(F.col("tree").alias("t"), F.col("bucket").alias("b"), F.col("lo").alias("from"), F.col("hi").alias("to"), F.col("kids").alias("run"), F.col("top"), F.col("path").alias("on"))
        bucket = F.floor(F.col("lo") / F.lit(FAN ** (level + 1)).cast("bigint")).cast("bigint")
        inside = (F.col("tree") == F.col("t")) & (bucket == F.col("b")) & (F.col("from") <= F.col("lo")) & (F.col("hi") <= F.col("to"))
        beside = F.struct(
            F.array_join(F.transform(F.filter("run", lambda x: x["hi"] <= F.col("lo")), lambda x: x["digest"]), "").alias("left"),
            F.array_join(F.transform(F.filter("run", lambda x: x["lo"] >= F.col("hi")), lambda x: x["digest"]), "").alias("right"),
        )
        rest = nodes.where(F.col("n") > FAN**level).join(upper, inside)
        return rest.withColumn("path", F.concat(F.array(beside), F.col("on"))).drop("t", "b", "from", "to", "run", "on").select(ends.columns).unionAll(ends)

    above = None
    for level in range(len(levels), 0, -1):
        above = joined(levels[level - 1], level, above)
    return joined(leaves, 0, above)


def proof_digest(path: Column) -> Column:
    """The digest of all siblings on a path, level by level."""
    return _sha(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf leads to with these siblings."""
    return F.aggregate(path, leaf, lambda h, p: _sha(F.concat(p["left"], h, p["right"])))


def manifest(docs: DataFrame, tampered: Column, altered: Column) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for each row of docs (doc_id, source, lang, n_chars, text).

    Where ``tampered`` holds, folded_root starts from the leaf of the row with ``altered`` as its text; verified says whether it is the root.
    A null field is a field of its own kind, other than an empty one; a null lang is the first group and a null doc_id the first in its group;
    rows of one id follow each other by their leaves; repeated rows are leaves of their own with the same digest. A tree of one leaf is
    that leaf, and a table of one row has an empty proof. An empty table has no rows. Other columns, whatever their names, aren't read.
    """
    spark = docs.sparkSession
    ship(spark)
    own = docs.select(*FIELDS)
    slim = own.select(F.col("doc_id").alias("id"), F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("tree"), leaf_digest().alias("digest"), F.when(tampered, leaf_digest(text=altered)).alias("other"))
    slim = ranked(checkpointed(slim), [F.col("tree"), F.col("id"), F.col("digest")], ["tree"], "lo")
    sizes = checkpointed(slim.groupBy("tree").agg(F.count("*").alias("n")))
    size = sizes.agg(F.count("*").alias("n"), F.max(F.octet_length("tree")).alias("longest")).first()
    leaves = checkpointed(slim.join(small_side(sizes, size.n, 64 + (size.longest or 0)), "tree").withColumn("hi", F.col("lo") + 1))
    levels = build(leaves)
    subroots = ranked(checkpointed(roots(leaves, levels)), [F.col("tree")], name="lo")
    above = checkpointed(subroots.select(F.col("tree").alias("group"), F.lit("").alias("tree"), F.lit(size.n).cast("bigint").alias("n"), "lo", (F.col("lo") + 1).alias("hi"), "digest"))
    over = build(above)
    found = roots(above, over).first()
    root = found.digest if found else None
    start = spark.createDataFrame([("", root, [])], "tree string, top string, path array<struct<left:string,right:string>>")
    tops = attach(above, over, start).select(F.col("group").alias("tree"), F.col("digest").alias("top"), "path")
    out = attach(leaves, levels, checkpointed(tops))
    out = out.withColumn("folded", fold(F.coalesce("other", "digest"), F.col("path")))
    return out.select(
        F.col("id").alias("doc_id"), F.col("digest").alias("leaf"), F.col("top").alias("subroot"), F.lit(root).alias("root"),
        proof_digest(F.col("path")).alias("proof_sha256"), F.col("folded").alias("folded_root"), (F.col("folded") == F.lit(root)).alias("verified"),
    )


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
