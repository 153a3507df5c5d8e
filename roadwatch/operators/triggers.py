"""Window triggers and evictors."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.times import duration_micros, micros, millis
from .running import count_rows, running
from .windows import with_window


def window_text(count: Column) -> Column:
    """start:countend, with the bounds in epoch milliseconds."""
    return F.concat(millis(F.col("window_start")).cast("string"), F.lit(":"),
                    count.cast("string"), millis(F.col("window_end")).cast("string"))


def fire_on_marker(df: DataFrame, keys: Sequence[str], time: str, order: str, size: str,
                   marker: Column, *, width: int | None = None) -> DataFrame:
    """A window fires at every marker row, keeping its rows, and once at its end.

    ``fired_by`` is the arrival number of the marker row, null for the firing
    at the window's end.
    """
    group = [*keys, "window_start", "window_end"]
    rows = with_window(df, time, size).withColumn("__marker", marker)
    early = (running(rows, group, order, {"count": count_rows()}, width=width)
             .where("__marker").select(*group, F.col(order).alias("fired_by"), "count"))
    final = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("count")).select(
        *group, F.lit(None).cast("long").alias("fired_by"), "count")
    return early.unionByName(final).withColumn("text", window_text(F.col("count")))


def evict_older(df: DataFrame, keys: Sequence[str], time: str, size: str, keep: str) -> DataFrame:
    """Per key and window keep the rows newer than the window's last time minus ``keep``.

    The last times are taken with map-side combine and joined back, so that the
    rows are shuffled once at most and AQE can split a hot window.
    """
    group = [*keys, "window_start", "window_end"]
    rows = with_window(df, time, size).withColumn("__t", micros(F.col(time)))
    last = rows.groupBy(*[F.col(c).alias(f"__{c}") for c in group]).agg(F.max("__t").alias("__last"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in group])
    return (rows.join(last, same).where(F.col("__t") > F.col("__last") - duration_micros(keep))
            .drop("__t", "__last", *[f"__{c}" for c in group]))
