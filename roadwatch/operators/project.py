"""Row-wise operators: no shuffle, all inside code generation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def expand_rows(df: DataFrame, count: str, out: str, *, key: str, seed: int = 0) -> DataFrame:
    """Repeat each row ``count`` times (never for a count of zero or less).

    ``out`` gets a repeatable pseudo-random number in ``[0, count)`` that
    depends on the row's key, the copy's position and the seed.
    """
    copies = df.select("*", F.posexplode(F.array_repeat(F.lit(True), F.col(count))).alias("__i", "__t"))
    small = F.pmod(F.col(key).cast("long"), F.lit(1 << 31))  # no product of it overflows
    mixed = small * 7919 + F.col("__i").cast("long") * 104729 + F.lit(seed)
    return copies.withColumn(out, F.pmod(mixed, F.col(count).cast("long"))).drop("__i", "__t")


def pair_with_one(df: DataFrame, name: str = "f0", one: str = "f1") -> DataFrame:
    """Wrap each row as (row, 1)."""
    return df.select(F.struct("*").alias(name), F.lit(1).alias(one))


def keyed_upper(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.select(F.col(key).cast("int").alias("key"), F.upper(value).alias("value"))


def composite_key(*parts: str) -> Column:
    """The printed form of a several-column key; group by the columns themselves."""
    return F.concat_ws("_", *parts)
