"""Keyed reduces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .running import Agg, highest, running


def word_count(words: DataFrame, word: str = "word") -> DataFrame:
    """Total per word; on a stream in update mode the running total."""
    return words.groupBy(word).agg(F.count(F.lit(1)).alias("total"))


def row_with_max(df: DataFrame, keys: Sequence[str], measure: str, order: str) -> DataFrame:
    """The whole row with the highest measure; of equal ones the later."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(measure, order))
    return df.groupBy(*keys).agg(best.alias("__row")).select(*keys, "__row.*")


def running_row_with_max(df: DataFrame, keys: Sequence[str], measure: str, order: str,
                         payload: Sequence[str], *, width: int | None = None) -> DataFrame:
    """For each row, the best row of its key so far, as ``best_<column>``."""
    candidate = F.struct(measure, order, *[c for c in payload if c not in (measure, order)])
    rows = running(df, keys, order, {"__best": highest(candidate)}, width=width)
    wanted = dict.fromkeys([measure, order, *payload])
    return rows.select(*df.columns, *[F.col(f"__best.{c}").alias(f"best_{c}") for c in wanted])


def running_values(df: DataFrame, keys: Sequence[str], order: str, aggs: dict[str, Agg], *,
                   width: int | None = None) -> DataFrame:
    """Keyed reduce that reports after every row."""
    return running(df, keys, order, aggs, width=width)
