"""Values that are worked out once for a row, however often an expression names them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once for a row: what is named several times is otherwise written out, planned and often worked out as many times."""
    return F.transform(F.array(value), body)[0]
