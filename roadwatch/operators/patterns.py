"""Detection on one key's rows in order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.times import duration_micros, micros
from ..sources.stored import stored
from .ranks import HOT_ROWS, ranked
from .running import highest, running


def too_close(df: DataFrame, keys: Sequence[str], time: str, order: str, within: str, *,
              width: int | None = None) -> DataFrame:
    """Rows less than ``within`` away from the highest earlier time of their key.

    ``previous_us`` is that earlier time; a key's first row never matches.
    """
    timed = df.withColumn("time_us", micros(F.col(time)))
    seen = running(timed, keys, order, {"previous_us": highest(F.col("time_us"))},
                   width=width, inclusive=False)
    return seen.where(F.abs(F.col("time_us") - F.col("previous_us")) < duration_micros(within))


def three_in_a_row(df: DataFrame, keys: Sequence[str], time: str, order: str, within: str,
                   carry: Sequence[str], *, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Each row with the next two of its key, the span being below ``within``.

    Matches may overlap. ``df`` holds only the rows that satisfy the pattern's
    condition; the rows between them do not matter. ``sequences`` has patterns of
    other steps. A key of more than ``hot_rows`` rows is cut by rank; every bucket
    gets the first two rows behind it, as ``running`` carries its value. Rows
    without a time take no part.
    """
    span = duration_micros(within)
    # The keys as one value: null keys are equal in it, and joins keep the windows' partitioning.
    timed = df.where(F.col(time).isNotNull()).withColumns(
        {"time_us": micros(F.col(time)), "__key": F.struct(*keys)})
    cut, any_hot = ranked(timed, "__key", ["time_us", order], hot_rows)

    inside = Window.partitionBy("__key", "__bucket").orderBy(F.desc("time_us"), F.desc(order))
    sighting = F.struct("time_us", *carry)
    second, third = F.lag(sighting, 1).over(inside), F.lag(sighting, 2).over(inside)
    matched = cut.withColumns({"second": second, "third": third})
    if any_hot:
        # At most two rows of each bucket of a hot key: what a bucket before it may need.
        first = Window.partitionBy("__key", "__bucket").orderBy("__at")
        heads = cut.where("__hot").withColumn("__rn", F.row_number().over(first)).where("__rn <= 2")
        ahead = Window.partitionBy("__key").orderBy("__bucket", "__rn")
        behind = stored(heads.withColumns({"__next": F.lead(sighting, 1).over(ahead),
                                           "__after": F.lead(sighting, 2).over(ahead)})
                        .groupBy("__key", "__bucket")
                        .agg(F.max_by(F.struct("__next", "__after"), "__rn").alias("__behind")), "pattern-behind")
        matched = matched.join(behind, ["__key", "__bucket"], "left").withColumns({
            "third": F.coalesce("third", F.when(F.col("second").isNotNull(), F.col("__behind.__next"))
                                .otherwise(F.col("__behind.__after"))),
            "second": F.coalesce("second", "__behind.__next")})
    return (
        matched.where(F.col("third.time_us") - F.col("time_us") < span)
        .select(*keys, sighting.alias("first"), "second", "third")
    )
