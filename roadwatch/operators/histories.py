"""List state: the text of all values so far, or of those not yet expired."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.times import duration_micros, micros
from .overlap import overlap_buckets
from .running import running, text_of


def running_concat(df: DataFrame, keys: Sequence[str], order: str, value: str,
                   out: str = "joined", *, width: int | None = None) -> DataFrame:
    """All values of the key so far, joined in order.

    Each row's text is by definition as long as its key's history, so the result
    is quadratic in a key's length; with expiry use ``ttl_concat``.
    """
    return running(df, keys, order, {out: text_of(F.col(value))}, width=width)


def ttl_concat(df: DataFrame, keys: Sequence[str], time: str, order: str, value: str, ttl: str,
               out: str = "joined") -> DataFrame:
    """The key's values that are younger than ``ttl`` when the row arrives, joined.

    Each row's text holds all that is alive, so choose ``ttl`` by the hottest
    key's rate: the work is what the result's size demands.
    """
    span = duration_micros(ttl)
    spread = overlap_buckets(df.withColumn("__t", micros(F.col(time))), "__t", span, before=span)
    alive = (Window.partitionBy(*keys, "bucket").orderBy("__t")
             .rangeBetween(-(span - 1), Window.currentRow))
    listed = F.collect_list(F.struct(F.col("__t").alias("t"), F.col(order).alias("o"),
                                     F.col(value).alias("v"))).over(alive)
    return (
        spread.withColumn("__list", listed).where("own")
        # Rows of the same instant that arrive later are not in the state yet.
        .withColumn("__list", F.filter("__list", lambda e: (e["t"] < F.col("__t"))
                                       | (e["o"] <= F.col(order))))
        .withColumn(out, F.array_join(F.transform(F.array_sort("__list"), lambda e: e["v"]), ""))
        .drop("__list", "__t", "bucket", "own")
    )
