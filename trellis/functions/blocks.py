"""Row-block arithmetic for splitting a matrix over ``size`` workers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_chunk(nrows: int, size: int) -> int:
    """Rows per block: ``ceil(nrows / size)``."""
    if size <= 0:
        raise ValueError("size must be positive")
    return (nrows + size - 1) // size


def row_block(i: Column | str, nrows: int, size: int) -> Column:
    """M10 as a column: the block that row ``i`` belongs to."""
    i = F.col(i) if isinstance(i, str) else i
    return F.call_function("div", i.cast("bigint"), F.lit(max(row_chunk(nrows, size), 1)).cast("bigint"))
