"""Order of rows by an integer id, without a global sort in one task.

Ids are cut into cells of ``CELL`` consecutive ids, so that rows are moved by cell and not one by one. Cells are dealt to ranges of
about ``RANGE_CELLS`` cells by sampling those there are, however the ids are spread: windows run inside ranges, and one row for each
range crosses a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollmill.functions.session import checkpointed

CELL = 512
RANGE_CELLS = 1 << 18


def _ranged(cells: DataFrame) -> DataFrame:
    """cells with ``range``, which grows with the cell; written, since another sample would draw other ranges."""
    cells = checkpointed(cells)
    ranges = cells.count() // RANGE_CELLS + 1
    return checkpointed(cells.repartitionByRange(ranges, "cell").withColumn("range", F.spark_partition_id()))


def running_cells(cells: DataFrame) -> DataFrame:
    """cells (cell bigint unique, weight bigint) with ``before``, the weight of all smaller cells."""
    cells = _ranged(cells)
    inside = Window.partitionBy("range").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = cells.groupBy("range").agg(F.sum("weight").alias("all")).select("range", F.coalesce(F.sum("all").over(across), F.lit(0)).alias("base"))
    cells = cells.withColumn("within", F.coalesce(F.sum("weight").over(inside), F.lit(0)))
    return cells.join(ranges, "range").select("cell", "weight", (F.col("base") + F.col("within")).alias("before"))


def next_cells(cells: DataFrame) -> DataFrame:
    """cells (cell bigint unique) with ``above``, the next larger cell there is; the largest has the smallest."""
    cells = _ranged(cells.select("cell"))
    ranges = cells.groupBy("range").agg(F.min("cell").alias("low"))
    across = Window.orderBy("range")
    whole = across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranges = ranges.select("range", F.coalesce(F.lead("low").over(across), F.min("low").over(whole)).alias("beyond"))
    inside = Window.partitionBy("range").orderBy("cell")
    return cells.withColumn("up", F.lead("cell").over(inside)).join(ranges, "range").select("cell", F.coalesce("up", "beyond").alias("above"))
