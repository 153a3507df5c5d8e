"""Joins: windowed, co-grouped, dimension, as-known and interval."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.times import duration_micros, micros
from .running import bucket_of, latest, running
from .windows import with_window


def lookup(facts: DataFrame, dimension: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join to a dimension with at most one row per key.

    No broadcast is forced. Pass a table or a ``stored`` result as dimension, so
    that its size on disk decides: a small one is broadcast and the facts are
    not shuffled; for a large one AQE splits the partitions of hot fact keys.
    """
    return facts.join(dimension, list(keys), "left")


def latest_per_key(updates: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """A stream of upserts reduced to the last row of each key."""
    rest = [c for c in updates.columns if c not in keys]
    return (updates.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("__row"))
            .select(*keys, "__row.*"))


def as_known(events: DataFrame, updates: DataFrame, keys: Sequence[str], order: str,
             payload: Sequence[str], *, width: int | None = None) -> DataFrame:
    """Each event with the last update of its key that arrived before it.

    ``order`` is one arrival numbering over both inputs.
    """
    tagged = events.withColumn("__is_update", F.lit(False)).unionByName(
        updates.select(*keys, order, *payload).withColumn("__is_update", F.lit(True)),
        allowMissingColumns=True)
    return as_known_tagged(tagged, keys, order, F.col("__is_update"),
                           {c: F.col(c) for c in payload}, width=width).drop("__is_update")


def as_known_tagged(rows: DataFrame, keys: Sequence[str], order: str, is_update: Column,
                    payload: Mapping[str, Column], *, width: int | None = None) -> DataFrame:
    """``as_known`` for events and updates that come in one table, which is read as one."""
    known = F.struct(*[c.alias(name) for name, c in payload.items()])
    state = running(rows, keys, order, {"__known": latest(F.when(is_update, known))}, width=width)
    return (state.where(~is_update).drop(*payload).select("*", "__known.*").drop("__known"))


def window_join(left: DataFrame, right: DataFrame, keys: Sequence[str], time: str, size: str,
                slide: str | None = None, copies: str = "copies") -> DataFrame:
    """Inner join of rows with the same key in the same window.

    Both inputs carry ``time``; their other columns must differ in name. Equal
    right rows of a key and window are folded into one, and ``copies`` says how
    often the pair occurs, so a hot group does not write all its pairs out.
    Select only the columns that matter on the right.
    """
    group = [*keys, "window_start", "window_end"]
    values = [c for c in right.columns if c not in (*keys, time)]
    return (with_window(left, time, size, slide).drop(time)
            .join(window_counts(right, keys, values, time, size, copies, slide), group))


def window_counts(df: DataFrame, keys: Sequence[str], values: Sequence[str], time: str,
                  size: str, count: str, slide: str | None = None) -> DataFrame:
    """Rows per key, window and distinct value: a hot group shrinks before any join."""
    return (with_window(df, time, size, slide)
            .groupBy(*keys, "window_start", "window_end", *values)
            .agg(F.count(F.lit(1)).alias(count)))


def cogroup_product(left: DataFrame, right: DataFrame, keys: Sequence[str], left_value: str,
                    right_value: str, time: str, size: str) -> DataFrame:
    """Every pairing of both sides of a key and window, as distinct pairs with ``copies``.

    Like ``window_join``, with equal rows counted on both sides.
    """
    group = [*keys, "window_start", "window_end"]
    pairs = window_counts(left, keys, [left_value], time, size, "__l").join(
        window_counts(right, keys, [right_value], time, size, "__r"), group)
    return pairs.withColumn("copies", F.col("__l") * F.col("__r")).drop("__l", "__r")


def cogroup_sizes(left: DataFrame, right: DataFrame, keys: Sequence[str], time: str,
                  size: str) -> DataFrame:
    """Row counts of both sides per key and window, one-sided groups included."""
    group = [*keys, "window_start", "window_end"]
    both = (with_window(left, time, size).select(*group, F.lit(1).alias("__l"), F.lit(0).alias("__r"))
            .unionByName(with_window(right, time, size)
                         .select(*group, F.lit(0).alias("__l"), F.lit(1).alias("__r"))))
    return both.groupBy(*group).agg(F.sum("__l").alias("left_rows"), F.sum("__r").alias("right_rows"))


def interval_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str,
                  right_time: str, before: str, after: str) -> DataFrame:
    """Pairs of one key with ``right_time`` in [left - before, left + after].

    Time buckets join the key, so a row meets only rows of two buckets instead
    of its whole key; each right row is in one bucket, so no pair is repeated.
    """
    low, high = duration_micros(before), duration_micros(after)
    width = max(low + high, 1)

    def bucket(time: Column) -> Column:
        return bucket_of(time, width)

    at = micros(F.col(left_time))
    reach = left.withColumn("__l", at).withColumn(
        "__bucket", F.explode(F.array_distinct(F.array(
            bucket(F.col("__l") - low), bucket(F.col("__l") + high)))))
    near = right.withColumn("__r", micros(F.col(right_time))).withColumn(
        "__bucket", bucket(F.col("__r")))
    return (
        reach.join(near, [*keys, "__bucket"])
        .where(F.col("__r").between(F.col("__l") - low, F.col("__l") + high))
        .drop("__bucket", "__l", "__r")
    )
