"""Ordered running aggregates that never put one key into one task.

A plain ``Window.partitionBy(key).orderBy(arrival)`` sorts a whole key in one
task, and with no key the whole table. Here the arrival order is cut into
buckets of ``width`` positions:

1. every (key, bucket) is aggregated, with map-side combine;
2. a window over those few rows gives each bucket what came before it;
3. that value enters its bucket as one extra leading row, and a window over
   (key, bucket) finishes inside the bucket.

``order`` must be a unique whole number, so a bucket holds at most ``width``
rows whatever the skew. With keys a bucket need only fit a task: it is wide, the
first aggregate folds most rows, and only keys with more rows than that are cut.
Without a key there are about as many buckets as a bucket has rows.

A stream goes on where the batch before it ended: ``running_from`` takes what
every key held then and returns what it holds now.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

MIN_WIDTH = 1024
KEYED_WIDTH = 1 << 20  # positions of the order that one task takes of a key
BEFORE_ALL = -(1 << 62)  # the bucket of what came before the input


@dataclass(frozen=True)
class Agg:
    """An aggregate that can be taken in parts. Build it with the helpers below."""

    kind: str
    column: Column
    function: Callable[[str], Column] | None = None

    def fold(self, name: str) -> Column:
        """Combine values of a group in any order."""
        if self.function:
            return self.function(name)
        if self.kind in ("sum", "count"):
            return F.sum(name)
        return {"max": F.max, "min": F.min}[self.kind](name)

    def partial(self, name: str, order: str) -> Column:
        """Combine the rows of one bucket."""
        if self.kind in ("last", "first"):
            pick = F.max_by if self.kind == "last" else F.min_by
            return pick(F.col(name), F.when(F.col(name).isNotNull(), F.col(order)))
        if self.kind == "text":
            listed = F.array_sort(F.collect_list(F.struct(F.col(order), F.col(name).alias("v"))))
            return F.array_join(F.transform(listed, lambda e: e["v"]), "")
        return self.fold(name)

    def over(self, name: str, window) -> Column:
        """Combine values along an ordered window."""
        if self.kind == "last":
            return F.last(name, ignorenulls=True).over(window)
        if self.kind == "first":
            return F.first(name, ignorenulls=True).over(window)
        if self.kind == "text":
            return F.array_join(F.collect_list(name).over(window), "")
        return self.fold(name).over(window)

    def result(self, value: Column) -> Column:
        return F.coalesce(value, F.lit(0)) if self.kind == "count" else value


def total(column: Column) -> Agg:
    return Agg("sum", column)


def count_rows(condition: Column | None = None) -> Agg:
    one = F.lit(1) if condition is None else F.when(condition, 1).otherwise(0)
    return Agg("count", one.cast("long"))


def highest(column: Column) -> Agg:
    return Agg("max", column)


def lowest(column: Column) -> Agg:
    return Agg("min", column)


def latest(column: Column) -> Agg:
    """The last non-null value in arrival order."""
    return Agg("last", column)


def earliest(column: Column) -> Agg:
    """The first non-null value in arrival order."""
    return Agg("first", column)


def folded(column: Column, function: Callable[[str], Column]) -> Agg:
    """Any Spark aggregate that may be taken of its own results, such as ``F.bit_or``,
    ``F.bit_xor``, ``F.bool_and`` or ``F.product``."""
    return Agg("fold", column, function)


def text_of(column: Column) -> Agg:
    """All values so far as one text, in arrival order."""
    return Agg("text", column)


def bucket_width(df: DataFrame, order: str) -> int:
    """A width that makes about as many buckets as a bucket has rows.

    One aggregate over one column; pass ``width`` where the size is known.
    """
    low, high, rows = df.agg(F.min(order), F.max(order), F.count(order)).first()
    return MIN_WIDTH if not rows else max(MIN_WIDTH, (high - low + 1) // math.isqrt(rows))


def bucket_of(order: Column, width: int) -> Column:
    return order - F.pmod(order, F.lit(width))


def running(df: DataFrame, keys: Sequence[str], order: str, aggs: Mapping[str, Agg], *,
            width: int | None = None, inclusive: bool = True) -> DataFrame:
    """Add to each row the aggregates of its key up to it in ``order``.

    ``inclusive=False`` leaves the row itself out (the state before the row).
    """
    return _running(df, keys, order, aggs, width, inclusive, None)[0]


def running_from(df: DataFrame, keys: Sequence[str], order: str, aggs: Mapping[str, Agg],
                 before: DataFrame | None, *, width: int | None = None,
                 inclusive: bool = True) -> tuple[DataFrame, DataFrame]:
    """``running`` that goes on from ``before``, and what each key holds after it.

    ``before`` is the second result of the call for the earlier rows, None at
    first. ``text_of`` and ``earliest`` are not carried over.
    """
    if any(agg.kind in ("text", "first") for agg in aggs.values()):
        raise ValueError("text_of() and earliest() cannot go on from a stored state")
    rows, per_bucket = _running(df, keys, order, aggs, width, inclusive, before)
    return rows, per_bucket.groupBy(*keys).agg(*[
        agg.partial(f"__{n}", "__bucket").alias(n) for n, agg in aggs.items()])


def _running(df: DataFrame, keys: Sequence[str], order: str, aggs: Mapping[str, Agg],
             width: int | None, inclusive: bool,
             before: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The rows with their aggregates, and the aggregates of each key's buckets."""
    width = width or (KEYED_WIDTH if keys else bucket_width(df, order))
    keys, names = list(keys), {name: f"__{name}" for name in aggs}
    rows = df.withColumns({
        "__bucket": bucket_of(F.col(order).cast("long"), width),
        **{names[name]: agg.column for name, agg in aggs.items()},
    })

    per_bucket = rows.groupBy(*keys, "__bucket").agg(
        *[agg.partial(names[n], order).alias(names[n]) for n, agg in aggs.items()])
    if before is not None:
        per_bucket = per_bucket.unionByName(before.select(
            *keys, F.lit(BEFORE_ALL).alias("__bucket"), *[F.col(n).alias(c) for n, c in names.items()]))
    earlier = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_bucket.select(
        *keys, "__bucket",
        *[agg.over(names[n], earlier).alias(names[n]) for n, agg in aggs.items()],
    ).where(" or ".join(f"`{c}` is not null" for c in names.values())).where(
        F.col("__bucket") != BEFORE_ALL)

    both = (rows.withColumn("__seq", F.lit(1))
            .unionByName(carried.withColumn("__seq", F.lit(0)), allowMissingColumns=True))
    within = (Window.partitionBy(*keys, "__bucket").orderBy("__seq", order)
              .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1))
    result = (
        both.withColumns({n: agg.result(agg.over(names[n], within)) for n, agg in aggs.items()})
        .where("__seq = 1")
        .drop("__seq", "__bucket", *names.values())
    )
    return result, per_bucket
