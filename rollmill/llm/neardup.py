"""Near-duplicate documents by HyperMinHash: compressed registers, banding, corrected estimates, exact checks.

1. Each text gives its set of word shingles and a sketch of 128 registers of 16 bits: 6 bits for the leading
   zeros of a bucket's smallest hash, 10 for the mantissa bits that follow.
2. Texts with the same set, told by its size and two independent 64-bit sums, fall into one class; from here on classes stand for documents.
3. Bands of four registers are joined; the four registers themselves are the key. Sets of up to 32 shingles, whose few registers make few
   bands, are joined exactly: by the smallest hashes of which two such sets of the threshold's similarity must share one. In each
   band group every class is compared with the group's smallest class. Two larger sets of similarity 0.8 share no band with probability under 1e-7.
4. A candidate survives the size bound and, for larger sets, a Jaccard estimate, corrected for register collisions, within five
   standard deviations of the threshold; then both texts are read and their full sets compared.
5. Groups that the links so far leave in several components are compared in blocks, all members of other components than the largest
   against each other and against those of the largest. First sketches only are sent: members that the estimate lets through with a member of
   another component stay. Their sets follow; the sets' sizes in common are counted in the block, and the best link of each two components
   goes on to the exact check. Blocks are dealt over tasks, so no group is gathered anywhere.
6. Components of all links, by distributed star contraction.

Sets are held as 64-bit hashes of shingles (see text.py). Rows are told apart by id and text, by a null-safe id and a 64-bit hash of
the text: ids may be null or stand for several texts, and no numbered copy of the texts has to be written.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmill.functions.session import checkpointed, release, ship, small_side
from rollmill.llm.components import components
from rollmill.llm.text import U64, mix, pieces, shingle_hashes

BUCKET_BITS = 7
REGISTERS = 1 << BUCKET_BITS
MANTISSA_BITS = 10
REST_BITS = 53
BAND = 4
#: Rows of one key, from which on a join broadcasts the key.
HOT = 1000
#: Members of a block in step 5.
BLOCK = 256
#: Sets of up to so many shingles are joined by their smallest hashes.
SMALL = 32
#: Pairs of which a task holds the sets at once.
PAIRS = 256


def registers(shingles: np.ndarray) -> np.ndarray:
    """The sketch of a sorted set of 64-bit hashes; 0 marks an empty bucket."""
    out = np.zeros(REGISTERS, np.uint16)
    if not len(shingles):
        return out
    bucket = (shingles >> U64(64 - BUCKET_BITS)).astype(np.int64)
    lowest = np.flatnonzero(np.diff(bucket, prepend=-1))  # sorted: each bucket's first is its smallest
    rest = (shingles[lowest] << U64(BUCKET_BITS)) >> U64(64 - REST_BITS)
    exponent = np.frexp(rest.astype(np.float64))[1]
    zeros = np.where(rest == 0, REST_BITS, REST_BITS - exponent)
    shift = np.maximum(exponent - 1 - MANTISSA_BITS, 0).astype(U64)
    lift = np.maximum(MANTISSA_BITS - exponent + 1, 0).astype(U64)
    mantissa = ((rest >> shift) << lift) & U64((1 << MANTISSA_BITS) - 1)
    out[bucket[lowest]] = ((zeros << MANTISSA_BITS) | mantissa.astype(np.int64)) + 1
    return out


def expected_collisions(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers that disjoint sets of these sizes share by chance (closed form of the HyperMinHash paper)."""
    ratio = np.maximum(a, b) / np.maximum(1, np.minimum(a, b))
    return 0.169919487159739 * 2.0 ** (BUCKET_BITS - MANTISSA_BITS) * 4 * ratio / (1 + ratio) ** 2


Sketch = Callable[[np.ndarray], np.ndarray]
Chance = Callable[[np.ndarray, np.ndarray], np.ndarray]


def estimate(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray, chance: Chance = expected_collisions) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates of sketches (rows of x and y, sets of a and b members), and the registers that carry them."""
    used = ((x != 0) | (y != 0)).sum(-1)
    same = ((x == y) & (x != 0)).sum(-1)
    return np.clip((same - chance(a, b)) / np.maximum(used, 1), 0, 1), used


def plausible(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int, chance: Chance = expected_collisions) -> np.ndarray:
    """Whether a pair may reach the threshold: exact on sizes, for sets beyond SMALL also five standard deviations on the estimate."""
    at, used = estimate(x, y, a, b, chance)
    t = percent / 100
    near = (at >= t - 5 * np.sqrt(t * (1 - t) / np.maximum(used, 1))) | (np.minimum(a, b) <= SMALL)
    return near & (100 * np.minimum(a, b) >= percent * np.maximum(a, b))


def smallest(shingles: np.ndarray, percent: int) -> np.ndarray:
    """Of a sorted small set the first members, so many that two sets of the threshold's similarity share one; none of a large set.

    A set that may be as similar to one of SMALL members has them too.
    """
    n = len(shingles)
    return shingles[: n - -(-percent * n // 100) + 1 if percent * n <= 100 * SMALL else 0]


def _key(doc_id: Column, text: Column) -> Column:
    """With the id it tells rows of different ids or texts apart."""
    return F.xxhash64(doc_id.isNull(), text.isNull(), text)


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, key, text) of each row."""
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.select("doc_id", _key(F.col("doc_id"), F.col("text")).alias("key"), "text")


def sketches(docs: DataFrame, width: int, percent: int = 80, sketch: Sketch = registers) -> DataFrame:
    """(doc_id, key, n_shingles, set_hash, check, sketch, few) of each document."""

    def sums(s: np.ndarray) -> tuple[int, int]:
        both = np.array([s.sum(dtype=U64) ^ (U64(len(s)) << U64(40)), mix(s ^ U64(0xA24BAED4963EE407)).sum(dtype=U64) + U64(len(s))], U64)
        one, two = mix(both).view(np.int64).tolist() if len(s) else (0, 0)
        return one, two

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, rows, few = [], [], [], []
            for piece in pieces(batch.column(2)):
                for s in shingle_hashes(piece.hashes(), piece.first, width):
                    sizes.append(len(s))
                    keys.append(sums(s))
                    rows.append(sketch(s).tobytes())
                    few.append(smallest(s, percent).tobytes())
            one, two = zip(*keys, strict=True) if keys else ((), ())
            columns = [batch.column(0), batch.column(1), *(pa.array(x, pa.int64()) for x in (sizes, one, two)), *(pa.array(x, pa.binary()) for x in (rows, few))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "n_shingles", "set_hash", "check", "sketch", "few"])

    ship(docs.sparkSession)
    return _keyed(docs).mapInArrow(run, "doc_id bigint, key bigint, n_shingles bigint, set_hash bigint, check bigint, sketch binary, few binary")


def _bands(classes: DataFrame) -> DataFrame:
    """(band, id): for each larger class its bands that have a register filled, by their registers and number; for each small one its few hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, n = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 3))
            sketch = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(batch.num_rows, -1)
            key = np.ascontiguousarray(sketch).view(U64)  # four registers
            full = (key != 0) & (n > SMALL)[:, None]
            key = mix(key ^ mix(np.arange(1, key.shape[1] + 1, dtype=U64)))
            few = batch.column(2).to_pylist()
            band = np.concatenate([key[full], mix(np.frombuffer(b"".join(few), U64) ^ U64(0xD1342543DE82EF95))])
            who = np.concatenate([np.repeat(ids, full.sum(1)), np.repeat(ids, [len(x) // 8 for x in few])])
            yield pa.RecordBatch.from_arrays([pa.array(band.view(np.int64)), pa.array(who)], ["band", "id"])

    return classes.select("id", "sketch", "few", "n").mapInArrow(run, "band bigint, id bigint")


def _estimated(pairs: DataFrame, classes: DataFrame, percent: int, chance: Chance) -> DataFrame:
    """The pairs (u, v) of classes that are plausible."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, REGISTERS) for k in ("x", "y"))
            a, b = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("a", "b"))
            yield batch.select(["u", "v"]).filter(pa.array(plausible(x, y, a, b, percent, chance)))

    own = classes.select("id", "n", "sketch")
    return (
        pairs.join(own.toDF("u", "a", "x"), "u").join(own.toDF("v", "b", "y"), "v")
        .where(f"100 * least(a, b) >= {percent} * greatest(a, b)")
        .select("u", "v", "a", "b", "x", "y")
        .mapInArrow(run, "u bigint, v bigint")
    )


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold. Only the texts of classes in a pair are moved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, PAIRS) for whole in batches for at in range(0, whole.num_rows, PAIRS)):
            sides = []
            for k in ("x", "y"):
                # equal neighbours (a hub's many links) are cut into shingles once
                coded = batch.column(k).dictionary_encode()
                sets = [s for piece in pieces(coded.dictionary) for s in shingle_hashes(piece.hashes(), piece.first, width)]
                sides.append([sets[i] for i in coded.indices.to_pylist()])
            keep = []
            for p, q in zip(*sides, strict=True):
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    ends = pairs.select(F.col("u").alias("id")).unionAll(pairs.select(F.col("v").alias("id"))).distinct()
    texts = _of_class(checkpointed(_texts(ends, classes, docs)))
    return (
        pairs.join(texts.toDF("u", "x"), "u").join(texts.toDF("v", "y"), "v")
        .select("u", "v", "x", "y")
        .mapInArrow(run, "u bigint, v bigint")
    )


def _rows_of(wanted: DataFrame, docs: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of ``wanted`` (doc_id, key, others) and the text of each row of that id and text; ``wanted`` is checkpointed."""
    own = _keyed(docs).toDF("own_id", "own_key", "text")
    side = small_side(wanted, wanted.count(), 56)
    return own.join(side, (F.col("own_key") == F.col("key")) & F.col("own_id").eqNullSafe(F.col("doc_id"))).select(*columns, "text")


def _texts(ids: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(id, text) of the rows that stand for their classes: the smallest id and one text of it, or a text without an id."""
    return _rows_of(checkpointed(ids.join(classes.select("id", "doc_id", "key"), "id")), docs, ["id"])


def _of_class(texts: DataFrame) -> DataFrame:
    """(id, text), one of each class: a row may be repeated."""
    again = texts.groupBy("id").agg(F.count("*").alias("rows")).where("rows > 1").select("id")
    if again.isEmpty():
        return texts
    again = checkpointed(again)
    return texts.join(again, "id", "left_anti").unionAll(texts.join(again, "id").groupBy("id").agg(F.min("text").alias("text")))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, sketch: Sketch = registers, chance: Chance = expected_collisions) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs`` (doc_id, text).

    Two documents are linked when ``100 * shared >= percent * union`` holds for their sets of distinct runs of
    ``width`` lower-cased (A-Z) words, split at ASCII white space. A text of fewer words has one run, all its words; a null,
    empty or blank text has none, is linked with nothing and stands alone. component_id is the smallest doc_id that
    links reach; kept marks the component's rows of that doc_id. Rows without an id are compared as others are; a component of
    such rows only has a null component_id, and kept marks all of them. Repeated rows share their component, rows of one
    doc_id with other texts need not; an empty table gives no rows; columns other than these two are not read. ``sketch`` makes REGISTERS
    16-bit values of a set, and ``chance`` tells how many of them disjoint sets of two sizes share.
    """
    out = _labelled(docs, width, percent, sketch, chance).select("doc_id", "n_shingles", "component_id")
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row of ``docs`` (doc_id, text, others) for each component of near_duplicates, and every row of a text without words.

    It is the component's first row by doc_id, nulls last, then by text. Of rows that have both the same one stays.
    """
    rows = checkpointed(_labelled(docs, width, percent).select("doc_id", "key", "component_id", "root"))
    first = rows.where("root is not null and doc_id <=> component_id").groupBy("root", "doc_id", "key").agg(F.count("*").alias("rows"))
    first = checkpointed(first)
    tied = checkpointed(first.groupBy("root").agg(F.count("*").alias("texts")).where("texts > 1").select("root"))
    chosen = first
    if not tied.isEmpty():
        texts = _rows_of(checkpointed(first.join(tied, "root").select("root", "doc_id", "key")), docs, ["root", "doc_id"])
        low = texts.groupBy("root").agg(F.min("doc_id").alias("doc_id"), F.min("text").alias("text"))
        low = low.select("root", _key(F.col("doc_id"), F.col("text")).alias("key"))
        chosen = first.join(tied, "root", "left_anti").unionByName(first.join(low, ["root", "key"]))
    alone = rows.where("root is null").select("doc_id", "key").distinct().withColumn("rows", F.lit(1))
    chosen = checkpointed(chosen.select("doc_id", "key", "rows").unionAll(alone).toDF("own_id", "own_key", "rows"))
    again = chosen.where("rows > 1")

    def of(some: DataFrame) -> DataFrame:
        side = small_side(some, some.count(), 48)
        match = (F.col("row_key") == F.col("own_key")) & F.col("row_id").eqNullSafe(F.col("own_id"))
        return own.join(side, match, "left_semi")

    id_ = F.col("doc_id").cast("bigint")
    own = docs.withColumns({"row_id": id_, "row_key": _key(id_, F.col("text").cast("string"))})
    out = of(chosen.where("rows = 1"))
    if not again.isEmpty():
        out = out.unionByName(of(again).dropDuplicates(["row_id", "row_key"]))
    return out.select(docs.columns)


def _labelled(docs: DataFrame, width: int, percent: int, sketch: Sketch = registers, chance: Chance = expected_collisions) -> DataFrame:
    """(doc_id, key, n_shingles, component_id, root) of each row; root numbers the components and is null where a text has no words."""
    rows = checkpointed(sketches(docs, width, percent, sketch))
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key"))  # nulls last
    classes = (
        rows.where("n_shingles > 0").groupBy("set_hash", "check")
        .agg(least.alias("least"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"), F.first("few").alias("few"), F.count("*").alias("rows"))
    )
    # a class's number stands for both hashes; the checkpoint fixes it
    classes = checkpointed(classes.select(F.monotonically_increasing_id().alias("id"), "set_hash", "check", "least.doc_id", "least.key", "n", "sketch", "few", "rows"))
    bands = checkpointed(_bands(classes))
    groups = bands.groupBy("band").agg(F.min("id").alias("lead"), F.count("*").alias("members")).where("members > 1")
    groups = checkpointed(groups)
    in_groups = bands.join(groups, "band")
    pairs = in_groups.where("id <> lead").select(F.col("lead").alias("u"), F.col("id").alias("v")).distinct()
    links = checkpointed(_verified(checkpointed(_estimated(pairs, classes, percent, chance)), classes, docs, width, percent))
    roots = components(links)
    release(docs.sparkSession)

    member = in_groups.where("members > 2").join(roots.withColumnRenamed("node", "id"), "id", "left").select("band", "id", "lead", F.coalesce("root", "id").alias("root"))
    across = checkpointed(_across(member, classes, docs, width, percent, chance))
    if not across.isEmpty():
        more = _verified(across, classes, docs, width, percent)
        roots = components(links.unionAll(more))

    total = rows.count()
    label = classes.select("id", "doc_id", "set_hash", "check", "rows").join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    low = label.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("size"))
    label = _with_hot(label.drop("id", "doc_id"), low, ["root"], "size", total).select("set_hash", "check", "component_id", "root", "rows")
    out = _with_hot(rows.where("n_shingles > 0").select("doc_id", "key", "n_shingles", "set_hash", "check"), label, ["set_hash", "check"], "rows", total)
    alone = rows.where("n_shingles = 0").select("doc_id", "key", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(None).cast("bigint").alias("root"))
    return out.select("doc_id", "key", "n_shingles", "component_id", "root").unionAll(alone)


def _with_hot(rows: DataFrame, one: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """rows joined to the one row of ``one`` for each key, which tells in ``size`` how many rows have the key.

    Keys of many rows are broadcast, so that no task gets all rows of one. Of ``total`` rows at most a million keys have so many.
    """
    one = checkpointed(one)
    many = F.col(size) > max(HOT, total // 1_000_000)
    hot = one.where(many)
    return rows.join(small_side(hot, hot.count(), 64), keys).unionByName(rows.join(small_side(hot.select(keys), hot.count(), 64), keys, "left_anti").join(one.where(~many), keys))


def _grams(texts: DataFrame, width: int) -> DataFrame:
    """(id, grams): the sets of classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [s.tobytes() for p in pieces(batch.column(1)) for s in shingle_hashes(p.hashes(), p.first, width)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], ["id", "grams"])

    return texts.select("id", "text").mapInArrow(run, "id bigint, grams binary")


def shared(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, columns: int = 4096) -> np.ndarray:
    """Members that the sets i[k] and j[k] share: pair by pair, or by products of membership matrices when pairs are many."""
    if len(i) <= 4 * len(sets):
        return np.array([len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i.tolist(), j.tolist(), strict=True)], np.int64)
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, value, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    on = count[value] > 1
    rows, value = rows[on], np.unique(value[on], return_inverse=True)[1]
    order = np.argsort(value, kind="stable")
    rows, value = rows[order], value[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, int(value[-1]) + 1 if len(value) else 0, columns):
        a, b = np.searchsorted(value, [low, low + columns])
        part = np.zeros((len(sets), columns), np.float32)
        part[rows[a:b], value[a:b] - low] = 1
        out += part @ part.T
    return out[i, j].astype(np.int64)


def _blocks(member: DataFrame) -> DataFrame:
    """(zone, id, root, block, low, high): the members to compare, with their block and the blocks that it meets.

    All groups of one smallest component make a zone: a class goes there once, however many bands it shares. In a zone of more than a
    block the members of its largest component have the first blocks and meet only those of the others.
    """
    split = member.groupBy("band").agg(F.min("root").alias("zone"), F.max("root").alias("top")).where("zone <> top").select("band", "zone")
    dealt = checkpointed(member.join(split, "band").select("zone", "id", "root").distinct())
    large = dealt.groupBy("zone", "root").agg(F.count("*").alias("n")).groupBy("zone")
    large = large.agg(F.sum("n").alias("all"), F.max_by("root", F.struct("n", "root")).alias("major"), F.max("n").alias("most")).where(F.col("all") > BLOCK)
    count = lambda n: F.ceil(n / BLOCK).cast("int")
    large = checkpointed(large.select("zone", "major", count(F.col("most")).alias("a"), count(F.col("all") - F.col("most")).alias("b")))
    dealt = dealt.join(small_side(large, large.count(), 32), "zone", "left")
    inside = F.coalesce(F.col("root") == F.col("major"), F.lit(False))
    a, b = F.coalesce("a", F.lit(0)), F.coalesce("b", F.lit(1))
    at = F.xxhash64("id", "zone")
    block = F.when(inside, F.pmod(at, a)).otherwise(a + F.pmod(at, b)).cast("int")
    return dealt.select("zone", "id", "root", block.alias("block"), F.when(inside, a).otherwise(F.lit(0)).alias("low"), (a + b - 1).alias("high"))


def _across(member: DataFrame, classes: DataFrame, docs: DataFrame, width: int, percent: int, chance: Chance) -> DataFrame:
    """Links (u, v) across components that share a band group, to be verified: block against block, the best for each two components of a block pair."""

    def candidates(keys: tuple, blocks: Iterator[pa.RecordBatch]) -> tuple:
        rows = pa.Table.from_batches(list(blocks)).combine_chunks()  # at most two blocks of members
        who, root, n, block = (rows.column(k).to_numpy() for k in ("id", "root", "n", "block"))
        sketch = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint16).reshape(-1, REGISTERS)
        one, two = (np.flatnonzero(block == keys[k].as_py()) for k in (1, 2))
        left, right = [], []
        for i in one.tolist():
            j = two[(root[two] != root[i]) & ((who[two] > who[i]) if keys[1] == keys[2] else True)]
            j = j[plausible(sketch[i], sketch[j], n[i], n[j], percent, chance)]
            left.append(np.full(len(j), i))
            right.append(j)
        return rows, who, root, n, *(np.concatenate(x or [np.zeros(0)]).astype(np.int64) for x in (left, right))

    def likely(keys: tuple, blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, *_, i, j = candidates(keys, blocks)
        yield from rows.take(pa.array(np.unique(np.concatenate([i, j])))).to_batches()

    def best(keys: tuple, blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, who, root, n, i, j = candidates(keys, blocks)
        if len(i):
            both = shared([np.frombuffer(g.as_py(), U64) for g in rows.column("grams")], i, j)
            margin = 100 * both - percent * (n[i] + n[j] - both)
            a, b = np.minimum(root[i], root[j]), np.maximum(root[i], root[j])
            order = np.lexsort((-margin, b, a))
            top = order[(np.diff(a[order], prepend=a[order[0]] - 1) != 0) | (np.diff(b[order], prepend=0) != 0)]
            top = top[margin[top] >= 0]
            i, j = i[top], j[top]
        yield pa.RecordBatch.from_arrays([pa.array(f(who[i], who[j]), pa.int64()) for f in (np.minimum, np.maximum)], ["u", "v"])

    dealt = _blocks(member).join(classes.select("id", "n", "sketch"), "id")
    dealt = dealt.withColumn("other", F.explode(F.sequence("low", "high")))
    dealt = dealt.select("zone", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "id", "root", "n", "sketch")
    dealt = checkpointed(dealt.groupBy("zone", "i", "j").applyInArrow(likely, dealt.schema))
    if dealt.isEmpty():
        return dealt.select(F.col("id").alias("u"), F.col("id").alias("v"))
    sets = _grams(_of_class(checkpointed(_texts(dealt.select("id").distinct(), classes, docs))), width)
    return dealt.join(sets, "id").groupBy("zone", "i", "j").applyInArrow(best, "u bigint, v bigint").distinct()
