"""Count windows: tumbling and sliding, per key or over all rows.

Row numbers come from the bucketed running count, so neither a hot key nor the
keyless form is ordered in one task.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from .running import Agg, count_rows, running


def _numbered(df: DataFrame, keys: Sequence[str], order: str, width: int | None) -> DataFrame:
    return running(df, keys, order, {"__rn": count_rows()}, width=width)


def count_tumbling(df: DataFrame, keys: Sequence[str], order: str, size: int,
                   aggs: Mapping[str, Agg], *, width: int | None = None) -> DataFrame:
    """Every ``size`` rows of a key make a window; an unfilled last one does not fire."""
    rows = _numbered(df.withColumns({f"__v_{n}": a.column for n, a in aggs.items()}),
                     keys, order, width)
    numbered = rows.withColumn("window_no", F.floor((F.col("__rn") - 1) / size))
    return (
        numbered.groupBy(*keys, "window_no")
        .agg(F.count(F.lit(1)).alias("__n"),
             *[a.fold(f"__v_{n}").alias(n) for n, a in aggs.items()])
        .where(F.col("__n") == size).drop("__n")
    )


def count_sliding(df: DataFrame, keys: Sequence[str], order: str, size: int, slide: int,
                  aggs: Mapping[str, Agg], *, width: int | None = None) -> DataFrame:
    """Every ``slide`` rows a window over the last ``size`` rows (or fewer) fires.

    Rows are first folded into panes of gcd(size, slide); only panes are copied
    to the windows they belong to. ``fired_at`` is the row count at the firing.
    """
    pane = math.gcd(size, slide)
    values = {n: f"__v_{n}" for n in aggs}
    rows = _numbered(df.withColumns({values[n]: a.column for n, a in aggs.items()}),
                     keys, order, width)

    def folded() -> list:
        return [aggs[n].fold(c).alias(c) for n, c in values.items()]

    panes = (rows.withColumn("__pane", F.floor((F.col("__rn") - 1) / pane))
             .groupBy(*keys, "__pane").agg(F.max("__rn").alias("__top"), *folded()))
    first_fire = F.ceil((F.col("__pane") + 1) * pane / slide) * slide
    last_fire = F.floor((F.col("__pane") * pane + size) / slide) * slide
    fires = panes.where(first_fire <= last_fire).withColumn(
        "fired_at", F.explode(F.sequence(first_fire, last_fire, F.lit(slide).cast("long"))))
    return (
        fires.groupBy(*keys, "fired_at").agg(F.max("__top").alias("__top"), *folded())
        .where(F.col("__top") == F.col("fired_at"))
        .select(*keys, "fired_at",
                *[aggs[n].result(F.col(c)).alias(n) for n, c in values.items()])
    )
