"""Session windows without sorting raw rows.

Rows of one key whose times fall into the same cell of one gap's width are less
than one gap apart, so they are always in one session. Cells are therefore
aggregated first (with map-side combine) and only the cells are put in order. A
key has at most span / gap cells, however many rows it has.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.times import duration_micros, from_micros, micros
from ..sources.stored import stored
from .running import Agg, bucket_of, count_rows, highest, running

# Cells per bucket when the sessions of all rows together are ordered.
CELLS_PER_BUCKET = 4096


def sessions(df: DataFrame, time: str, gap: str, keys: Sequence[str],
             aggs: Mapping[str, Agg]) -> DataFrame:
    """Sessions per key, or of all rows together when ``keys`` is empty.

    Rows exactly one gap apart belong together. ``session_end`` is the last
    row's time plus the gap.
    """
    keys, gap_us = list(keys), duration_micros(gap)
    value_names = {name: f"__v_{name}" for name in aggs}
    timed = df.withColumns({
        "__t": micros(F.col(time)),
        **{value_names[n]: a.column for n, a in aggs.items()},
    }).withColumn("__cell", bucket_of(F.col("__t"), gap_us))

    def folded() -> list:
        return [aggs[n].fold(c).alias(c) for n, c in value_names.items()]

    cells = timed.groupBy(*keys, "__cell").agg(
        F.min("__t").alias("__first"), F.max("__t").alias("__last"), *folded())

    if keys:
        in_order = Window.partitionBy(*keys).orderBy("__cell")
        seen = cells.withColumn("__before", F.lag("__last").over(in_order))
    else:
        # The steps below read the cells several times, the raw rows only here.
        cells = stored(cells, "session-cells")
        seen = running(cells, [], "__cell", {"__before": highest(F.col("__last"))},
                       width=CELLS_PER_BUCKET * gap_us, inclusive=False)
    opens = F.col("__before").isNull() | (F.col("__first") - F.col("__before") > gap_us)
    flagged = seen.withColumn("__opens", opens)
    if keys:
        numbered = flagged.withColumn("__session", F.sum(F.col("__opens").cast("long")).over(
            in_order.rowsBetween(Window.unboundedPreceding, 0)))
    else:
        numbered = running(flagged, [], "__cell", {"__session": count_rows(F.col("__opens"))},
                           width=CELLS_PER_BUCKET * gap_us)

    merged = numbered.groupBy(*keys, "__session").agg(
        F.min("__first").alias("__first"), F.max("__last").alias("__last"), *folded())
    return merged.select(
        *keys, from_micros(F.col("__first")).alias("session_start"),
        from_micros(F.col("__last") + gap_us).alias("session_end"),
        *[aggs[n].result(F.col(c)).alias(n) for n, c in value_names.items()])


def intervals(df: DataFrame, time_us: Column, gap_us: int, aggs: Mapping[str, Agg]) -> DataFrame:
    """Rows folded into cells of one gap: first, last, and a partial ``v_<name>`` per aggregate."""
    rows = df.select(time_us.cast("long").alias("t"), *[a.column.alias(f"v_{n}") for n, a in aggs.items()])
    return (rows.where("t IS NOT NULL").groupBy(bucket_of(F.col("t"), gap_us).alias("cell"))
            .agg(F.min("t").alias("first"), F.max("t").alias("last"),
                 *[a.fold(f"v_{n}").alias(f"v_{n}") for n, a in aggs.items()]).drop("cell"))


def merged_intervals(parts: DataFrame, gap_us: int, aggs: Mapping[str, Agg]) -> DataFrame:
    """Intervals at most one gap apart, over all rows together, made one."""
    width = CELLS_PER_BUCKET * gap_us
    parts = stored(parts, "session-parts")
    seen = running(parts, [], "first", {"__reach": highest(F.col("last"))}, width=width, inclusive=False)
    opens = F.col("__reach").isNull() | (F.col("first") - F.col("__reach") > gap_us)
    # Stored, so that intervals of one beginning keep their order.
    flagged = stored(seen.withColumn("__opens", opens).drop("__reach"), "session-opens")
    numbered = running(flagged, [], "first", {"__session": count_rows(F.col("__opens"))}, width=width)
    # Where two begin at once, the one that opens counts for both.
    numbered = numbered.withColumn("__session", F.max("__session").over(Window.partitionBy("first")))
    return stored(numbered.groupBy("__session").agg(
        F.min("first").alias("first"), F.max("last").alias("last"),
        *[a.fold(f"v_{n}").alias(f"v_{n}") for n, a in aggs.items()]).drop("__session"), "session-merged")
