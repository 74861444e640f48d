"""Quality rules of documents by DataFrame functions alone: counts of a text, and a hashed n-gram log-likelihood ratio.

Two multinomials over ``BUCKETS`` hashed n-grams (words and pairs of neighbouring words, as they are written) are counted over
whole tables: one over the trusted documents, one over all. A document's ratio is the sum of its n-grams' log ratios divided by their
number; documents below a fixed ratio go. Log ratios are whole numbers of 1e-6, so that sums don't depend on order.

Everything runs inside rows but the counts of buckets, which are added up in each task before the one small shuffle there is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmill.functions.session import checkpointed, ship, small_side
from rollmill.llm.text import unused

BUCKETS = 1 << 16
#: Occurrences that each bucket is given beforehand in the raw corpus; in the trusted documents as many by their share of all n-grams.
PRIOR = 64
#: Documents below this mean log ratio (natural logarithm, a n-gram) go.
LEAST_RATIO = -0.09
#: Log ratios are kept as whole numbers of 1 / UNIT.
UNIT = 1_000_000
#: Odd, below 2**31: a pair's code is PAIR times the first word's CRC-32, and the second's.
PAIR = 1_000_003
LEAST_WORDS, MOST_REPEATED = 50, 50

#: Words of a text up to which places are packed into hashes.
SHORT = 1 << 16

SPACE, WORD = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE, -1), "")


def _let(value: Column, body) -> Column:  # noqa: ANN001
    """body(value) with value worked out once."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """Words inside runs of three words that a text has twice or more.

    Runs are compared as 64-bit hashes: two different runs of a text of n words pass for one with a probability of n * n / 2**65.
    """
    def runs(w: Column) -> Column:
        return F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))  # the last two are of fewer words, and like no other

    def total(places: Column) -> Column:
        """Every place covers three words, less those that the place before it covers too."""
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("n"))
        return F.aggregate(places, start, lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")))["n"]

    def by_code(r: Column) -> Column:
        """Places of runs that come again: the last bits of a code are the place, the others the hash's; neighbours are compared by whole hashes."""
        low = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.ceil(F.log2(F.size(r) + F.lit(1.0))).cast("int")) - F.lit(1).cast("bigint")

        def again(s: Column, m: Column) -> Column:
            def whole(x: Column) -> Column:
                return F.get(r, x.bitwiseAND(m).cast("int"))

            def like(x: Column, k: Column) -> Column:
                y = F.get(s, k)
                near = x.bitwiseXOR(y)
                return (near <= m) & (near > 0) & (whole(x) == whole(y))

            same = F.filter(s, lambda x, k: like(x, k - 1) | like(x, k + 1))
            return F.sort_array(F.transform(same, lambda x: x.bitwiseAND(m).cast("int")))

        return _let(low, lambda m: _let(F.sort_array(F.transform(r, lambda h, i: h.bitwiseAND(F.bitwise_not(m)).bitwiseOR(i.cast("bigint")))), lambda s: again(s, m)))

    def by_pair(r: Column) -> Column:
        """The same from pairs of hash and place, for texts of so many words that shortened hashes would meet."""

        def again(s: Column) -> Column:
            same = F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]))
            return F.sort_array(F.transform(same, lambda x: x["i"]))

        return _let(F.sort_array(F.transform(r, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), again)

    def covered(r: Column) -> Column:
        return total(F.when(F.size(r) <= SHORT, by_code(r)).otherwise(by_pair(r)))

    none = F.lit(0).cast("bigint")
    some = _let(words, lambda w: _let(runs(w), lambda r: F.when(F.size(F.array_distinct(r)) == F.size(r), none).otherwise(covered(r))))
    return F.when(F.size(words) < 4, none).otherwise(some)


def _codes(words: Column) -> Column:
    return F.transform(words, lambda w: F.crc32(w.cast("binary")))


def _pair(codes: Column, x: Column, i: Column) -> Column:
    """The bucket of a word and the next one; the last word's next is the end of the text."""
    return (x * F.lit(PAIR) + F.coalesce(F.get(codes, i + 1), F.lit(0).cast("bigint"))).bitwiseAND(F.lit(BUCKETS - 1))


def buckets(words: Column) -> Column:
    """A bucket for each word and for each pair of neighbours."""
    return _let(_codes(words), lambda c: F.concat(F.transform(c, lambda x: x.bitwiseAND(F.lit(BUCKETS - 1))), F.transform(c, lambda x, i: _pair(c, x, i))))


def text_counts(text: Column) -> dict[str, Column]:
    """Code points in words, symbols, and lines with a word that are equal to an earlier line of the text; a null text counts as empty."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))
    return {
        "word_chars": F.length(F.regexp_replace(text, SPACE + "+", "")).cast("bigint"),
        "n_symbols": (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("bigint"),
        "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint"),
    }


def _split(docs: DataFrame, keys: list[str], more: dict[str, Column]) -> DataFrame:
    return docs.select(*keys, *[c.alias(n) for n, c in more.items()], _words(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("words"))


def ngram_weights(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """(bucket, weight) for every bucket of docs (doc_id, text): 1e6 times the log ratio of its share in trusted documents to its share in all.

    trusted has a doc_id for each trusted document: nulls count for nothing and repeated ids once. Every row of docs is counted, copies and
    rows of one id each for itself; null and empty texts have no n-grams. Without a trusted n-gram all weights are 0; no n-grams, no rows.
    """
    ship(docs.sparkSession)
    ids = checkpointed(trusted.select(F.col("doc_id").cast("bigint").alias("doc_id")).where("doc_id is not null").distinct().withColumn("trust", F.lit(1)))
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(small_side(ids, ids.count(), 32), "doc_id", "left")
    own = _split(own, ["trust"], {}).select("trust", buckets(F.col("words")).alias("all"))
    counts = own.select("trust", F.explode_outer("all").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"), F.count("trust").alias("t"))
    counts = checkpointed(counts.where("bucket is not null"))
    both = counts.agg(F.sum("n").alias("n"), F.sum("t").alias("t")).first()
    scale = both.n / both.t if both.t else 0.0
    ratio = F.log((F.col("t") * F.lit(scale) + F.lit(float(PRIOR))) / (F.col("n") + F.lit(float(PRIOR))))
    return counts.select("bucket", (F.round(ratio * UNIT) if both.t else F.lit(0)).cast("bigint").alias("weight"))


def judged(docs: DataFrame, weights: DataFrame, keys: tuple[str, ...] = ("doc_id",), least: float = LEAST_RATIO) -> DataFrame:
    """For each row of docs (text and keys): keys, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, log_ratio, kept.

    A text fails the base with fewer than 50 words, or with more than half of its words in runs of three that come again; what passes is
    kept with a mean log ratio of ``least`` or more. A null, empty or blank text has no words and fails. Rows of one id, and repeated rows, are
    judged each for itself; an empty table gives no rows; keys are of types that can be grouped, those named like a result are left out. A
    text's words are held in one task, as about ten times its bytes; n-grams without a weight weigh nothing.
    """
    ship(docs.sparkSession)
    own = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "log_ratio", "kept"]
    names = [k for k in keys if k.lower() not in own]
    row, at, weight, total = (unused([*names, *own], c) for c in ("row", "bucket", "weight", "total"))
    rows = _split(docs, names, text_counts(F.col("text"))).withColumn(row, F.monotonically_increasing_id())  # only keeps rows apart
    counts = [F.size("words").cast("bigint").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", repeated_words(F.col("words")).alias("n_repeat_words")]
    rows = rows.select(row, *names, *counts, buckets(F.col("words")).alias(at))
    rows = rows.select(*[c for c in rows.columns if c != at], F.explode_outer(at).alias(at))
    weights = weights.select(F.col("bucket").alias(at), F.col("weight").alias(weight))
    found = rows.join(F.broadcast(weights), at, "left")  # BUCKETS rows of 16 bytes at most
    found = found.groupBy(row, *names, *own[:5]).agg(F.sum(weight).alias(total))
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    total_ = F.coalesce(F.col(total), F.lit(0))
    grams = F.col("n_words") * 2
    out = found.select(*names, *own[:5], failed.alias("base_failed"), F.when(grams > 0, total_ / (grams * UNIT)).otherwise(0.0).alias("log_ratio"), (~failed & (total_ >= grams * round(least * UNIT))).alias("kept"))
    return out
