"""Puzzle tasks out of seeds, and their scorers: everything is an expression of the seed, so a table of seeds is a table of puzzles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmill.functions.binding import bound
from rollmill.operators.sampling import allocate

# Steps of seeds between tasks, bands and chunks, and how far into a curriculum a band goes.
TASK_STEP, BAND_STEP, CHUNK_STEP = 1_000_003, 100_003, 10_007
#: Tasks, in the order of their numbers.
TASKS = ["sum_chain", "linear_equation", "sum_grid"]
#: Seeds of a chunk's rows: chunks of fewer rows have none in common.
PLACE_STEP = 1 << 20
BAND_SHARE = {"easy": 0.2, "medium": 0.6, "hard": 1.0}


def chunk_seed(seed: int, task: Column, band: Column, chunk: Column) -> Column:
    return F.lit(seed).cast("bigint") + task * TASK_STEP + band * BAND_STEP + chunk * CHUNK_STEP


def curriculum_level(share: Column, levels: int) -> Column:
    """The level of a share of the way, half to even."""
    return F.bround(share * (levels - 1), 0).cast("bigint")


def chunks(counts: DataFrame, size: int, seed: int) -> DataFrame:
    """(task, band, chunk, rows, seed) of counts (task, band, n; numbers), in chunks of ``size`` rows."""
    part = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / size)))
    rows = counts.where("n > 0").withColumn("chunk", part).withColumn("rows", F.least(F.lit(size).cast("bigint"), F.col("n") - F.col("chunk") * size))
    return rows.select("task", "band", "chunk", "rows", chunk_seed(seed, F.col("task"), F.col("band"), F.col("chunk")).alias("seed"))


def chunked_counts(total: int, tasks: Sequence[float], bands: Sequence[float]) -> dict[tuple[int, int], int]:
    """Rows of each task and band by largest remainders."""
    out = {}
    for t, share in enumerate(allocate(total, tasks)):
        for b, n in enumerate(allocate(share, bands) if share else []):
            out[t, b] = n
    return out


def digit(seed: Column, k: int, least: int, most: int) -> Column:
    """A number between two bounds, by the hash of the seed."""
    wide = F.conv(F.substring(F.sha2(F.concat_ws("/", seed.cast("string"), F.lit(str(k))), 256), 1, 8), 16, 10).cast("bigint")
    return wide % (most - least + 1) + least


def sum_chain(seed: Column, level: Column) -> tuple[Column, Column]:
    """A chain of two to six summands, longer at higher levels: question and answer."""
    terms = F.slice(F.array(*(digit(seed, k, 1, 99) for k in range(6))), 1, F.greatest(F.lit(2), F.least(F.lit(6), level.cast("int") + 2)))
    return F.concat(F.lit("What is "), F.array_join(F.transform(terms, lambda x: x.cast("string")), " + "), F.lit("?")), F.aggregate(terms, F.lit(0).cast("bigint"), lambda a, x: a + x).cast("string")


def linear_equation(seed: Column, level: Column) -> tuple[Column, Column]:
    a, x, b = digit(seed, 0, 2, 9), digit(seed, 1, 1, 20) * (level + 1), digit(seed, 2, 1, 50)
    return F.concat(F.lit("Solve for x: "), a.cast("string"), F.lit("x + "), b.cast("string"), F.lit(" = "), (a * x + b).cast("string")), x.cast("string")


def sum_grid(seed: Column) -> Column:
    """A square of three rows whose last row and column are sums, as struct<puzzle, numbers, square>: 0 stands for a cell to fill.

    Two cells of the inner square and one sum are left open.
    """
    zero = F.lit(0).cast("bigint")

    def grid(inner: Column) -> Column:
        a, b, c, d = (inner[k] for k in range(4))
        square = F.array(F.array(a, b, a + b), F.array(c, d, c + d), F.array(a + c, b + d, a + b + c + d))
        puzzle = F.array(F.array(a, zero, a + b), F.array(zero, d, c + d), F.array(a + c, b + d, zero))
        return F.struct(puzzle.alias("puzzle"), F.array_sort(F.array(b, c, a + b + c + d)).alias("numbers"), square.alias("square"))

    return bound(F.array(*(digit(seed, k, 1, 9) for k in range(4))), grid)


def integer_matrix(text: Column, size: Column) -> Column:
    """A square of integers out of JSON, or of the lines of a text that have as many integers; null for others."""
    exact = text.rlike(r"^\s*\[(\s*\[\s*-?\d+(\s*,\s*-?\d+)*\s*\]\s*,?)+\s*\]\s*$")
    parsed = F.when(exact, F.from_json(text, "array<array<bigint>>"))
    cells = lambda line: F.filter(F.split(F.replace(F.regexp_replace(F.regexp_replace(F.trim(line), r"^\|+", ""), r"\|+$", ""), F.lit(","), F.lit(" ")), r"\s+"), lambda v: v != "")
    lines = F.filter(F.transform(F.split(text, r"\r\n|\r|\n"), cells), lambda r: (F.size(r) == size) & F.forall(r, lambda v: v.rlike(r"^-?\d{1,18}$")))
    number = lambda r: F.transform(r, lambda v: v.cast("bigint"))
    from_lines = bound(lines, lambda found: F.when(F.size(found) == size, F.transform(found, number)))
    square = lambda m: F.coalesce((F.size(m) == size) & F.forall(m, lambda r: F.size(r) == size), F.lit(False))
    return bound(parsed, lambda m: F.when(square(m), m).otherwise(from_lines))


def _total(row: Column) -> Column:
    return F.aggregate(row, F.lit(0).cast("bigint"), lambda a, x: a + x)


def score_grid(puzzle: Column, numbers: Column, answer: Column) -> Column:
    """struct<score, reason> of an answer (text) to a square puzzle: given cells, the numbers to use, sums of rows and of columns, in this order.

    The last cell is only bound by the numbers.
    """
    given = F.struct(puzzle.alias("puzzle"), numbers.alias("numbers"), answer.alias("answer"))
    with_matrix = lambda x: F.struct(x["puzzle"].alias("puzzle"), x["numbers"].alias("numbers"), integer_matrix(x["answer"], F.size(x["puzzle"])).alias("matrix"))
    return bound(given, lambda x: bound(with_matrix(x), lambda y: _grid_verdict(y["puzzle"], y["numbers"], y["matrix"])))


def _grid_verdict(puzzle: Column, numbers: Column, m: Column) -> Column:
    n = F.size(puzzle)
    well = F.coalesce((n > 0) & F.forall(puzzle, lambda r: F.size(r) == n), F.lit(False))
    pairs = F.arrays_zip(F.flatten(puzzle).alias("p"), F.flatten(m).alias("m"))
    fixed = F.forall(pairs, lambda x: (x["p"] == 0) | (x["p"] == x["m"]))
    filled = F.array_sort(F.transform(F.filter(pairs, lambda x: x["p"] == 0), lambda x: x["m"]))
    upper = F.slice(m, 1, n - 1)
    rows = F.forall(upper, lambda r: _total(F.slice(r, 1, n - 1)) == F.element_at(r, -1))
    columns = F.forall(F.sequence(F.lit(1), n - 1), lambda k: _total(F.transform(upper, lambda r: F.element_at(r, k))) == F.element_at(F.element_at(m, -1), k))

    def out(score: float | None, reason: str | None) -> Column:
        return F.struct(F.lit(score).cast("double").alias("score"), F.lit(reason).cast("string").alias("reason"))

    return (
        F.when(puzzle.isNull() | numbers.isNull(), out(None, "missing_metadata")).when(~well, out(None, "invalid_puzzle")).when(m.isNull(), out(None, "matrix_unavailable"))
        .when(~fixed, out(0.0, "fixed_cell_mismatch")).when(filled != F.array_sort(numbers), out(0.0, "number_multiset_mismatch"))
        .when((n > 1) & ~rows, out(0.0, "row_sum_mismatch")).when((n > 1) & ~columns, out(0.0, "column_sum_mismatch")).otherwise(out(1.0, None))
    )


def task_rows(rows: DataFrame) -> DataFrame:
    """rows (task, seed, band) with level, question, answer and, for squares, metadata (JSON: the puzzle and its numbers); an unknown task has nulls."""
    share = F.lit(1.0)
    for band, s in BAND_SHARE.items():
        share = F.when(F.col("band") == band, s).otherwise(share)
    rows = rows.withColumn("level", curriculum_level(share, 5))
    grid = sum_grid(F.col("seed"))
    ask = bound(grid, lambda g: F.concat(F.lit("Fill the zeros of "), F.to_json(g["puzzle"]), F.lit(" with "), F.to_json(g["numbers"]), F.lit(" so that the last row and column are sums.")))
    made = {"sum_chain": sum_chain(F.col("seed"), F.col("level")), "linear_equation": linear_equation(F.col("seed"), F.col("level")), "sum_grid": (ask, F.to_json(grid["square"]))}

    def pick(k: int) -> Column:
        out = F.lit(None).cast("string")
        for task in TASKS:
            out = F.when(F.col("task") == task, made[task][k]).otherwise(out)
        return out

    metadata = F.when(F.col("task") == "sum_grid", bound(grid, lambda g: F.to_json(F.struct(g["puzzle"].alias("puzzle"), g["numbers"].alias("numbers")))))
    return rows.withColumns({"question": pick(0), "answer": pick(1), "metadata": metadata})


def puzzle_rows(seeds: DataFrame) -> DataFrame:
    """seeds (seed, band) as puzzles: task, level, question, answer. The task is the seed's remainder."""
    return task_rows(seeds.withColumn("task", F.get(F.array(*map(F.lit, TASKS)), F.pmod("seed", F.lit(len(TASKS))).cast("int")))).drop("metadata")


def native_score(task: Column, answer: Column, metadata: Column, said: Column) -> Column:
    """A task's own score of a text: squares by their rules, numbers by their value; null for an unknown task."""
    number = lambda x: F.regexp_replace(x, r"^\s*(?:x\s*=\s*)?|\s+$", "").try_cast("decimal(38,9)")
    same = F.coalesce(number(said) == number(answer), F.lit(False)).cast("double")
    return F.when(task == "sum_grid", F.coalesce(score_grid(metadata["puzzle"], metadata["numbers"], said)["score"], F.lit(0.0))).when(task.isin(TASKS), same)
