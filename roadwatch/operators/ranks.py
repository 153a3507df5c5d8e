"""Rows of a key in time order, with hot keys cut by rank.

A key's rows are numbered in the order of time; a key of more than ``hot_rows`` rows
is cut into buckets of that many numbers. Unlike time buckets these hold no more
rows where rows are dense, or all of one time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..sources.stored import stored
from .running import bucket_of

HOT_ROWS = 1 << 20  # rows of a key that one task takes as a whole


def ranked(rows: DataFrame, key: str, order: Sequence[str], hot_rows: int = HOT_ROWS) -> tuple[DataFrame, bool]:
    """Add ``__at``, ascending in ``order`` within a key, ``__bucket`` and ``__hot``; and whether any key is hot.

    ``key`` is one column; a struct holds several, with nulls equal.
    """
    hot = stored(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows).select(key), "hot-keys")
    any_hot = not hot.isEmpty()
    cold = rows.join(hot, key, "left_anti") if any_hot else rows
    backwards = Window.partitionBy(key).orderBy(*[F.desc(c) for c in order])
    placed = cold.withColumns({"__at": -F.row_number().over(backwards).cast("long"),
                               "__bucket": F.lit(0).cast("long"), "__hot": F.lit(False)})
    if not any_hot:
        return placed, False
    # Ranges of the time order, so that the numbers of their rows ascend with it; stored, so that they stay.
    numbered = stored(rows.join(hot, key, "left_semi").repartitionByRange(*order).sortWithinPartitions(*order)
                      .withColumn("__at", F.monotonically_increasing_id()), "hot-rows")
    return placed.unionByName(numbered.withColumns(
        {"__bucket": bucket_of(F.col("__at"), hot_rows), "__hot": F.lit(True)})), True
