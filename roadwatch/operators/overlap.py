"""Time buckets with an overlap, for operators that look a bounded time around a row.

Each row goes to its own bucket and, when a neighbour's rows may look at it, to
that neighbour as well (``own`` is false there). A window over (key, bucket)
then sees all it needs, and a hot key is spread over as many tasks as it has
buckets, with one shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def overlap_buckets(df: DataFrame, time_us: str, width: int, *, before: int = 0,
                    after: int = 0) -> DataFrame:
    """``before`` / ``after``: how far back / ahead a row looks, in microseconds."""
    if max(before, after) > width:
        raise ValueError("a bucket must be at least as wide as the look-around")
    time = F.col(time_us)
    own = time - F.pmod(time, F.lit(width))
    first = F.when(time <= own + after, own - width).otherwise(own) if after else own
    last = F.when(time >= own + width - before, own + width).otherwise(own) if before else own
    return (df.withColumn("bucket", F.explode(F.sequence(first, last, F.lit(width).cast("long"))))
            .withColumn("own", F.col("bucket") == own))
