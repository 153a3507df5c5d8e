"""Side outputs: one pass labels each row, filters pick the outputs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

# What the two sides of the connected map append and add.
SIDE_A_TEXT = "coonected_acc"
SIDE_A_ADD = 18
SIDE_B_TEXT = "coonected_bcc"
SIDE_B_ADD = 20
# What joined and co-grouped keys append.
JOIN_TEXT = "_join_"
COGROUP_TEXT = "_cogroup"


def route(df: DataFrame, rules: Mapping[str, Column], main: str = "main",
          column: str = "route") -> DataFrame:
    """Label each row with the first rule that holds, else ``main``."""
    label = F.lit(main)
    for name, condition in reversed(list(rules.items())):
        label = F.when(condition, name).otherwise(label)
    return df.withColumn(column, label)


def output(routed: DataFrame, name: str, column: str = "route") -> DataFrame:
    return routed.where(F.col(column) == name).drop(column)


def letter_rules(text: str) -> dict[str, Column]:
    lowered = F.lower(text)
    return {"a": lowered.contains("a"), "b": lowered.contains("b")}


def divisible_by_seven(count: str) -> dict[str, Column]:
    return {"by_seven": F.col(count) % 7 == 0}


def co_map(side_a: DataFrame, side_b: DataFrame, text: str = "character",
           num: str = "num") -> DataFrame:
    """Two inputs mapped differently into one output."""
    def mapped(side: DataFrame, suffix: str, add: int) -> DataFrame:
        return side.withColumns({text: F.concat(F.col(text), F.lit(suffix)),
                                 num: F.col(num) + add})
    return mapped(side_a, SIDE_A_TEXT, SIDE_A_ADD).unionByName(
        mapped(side_b, SIDE_B_TEXT, SIDE_B_ADD))


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union that keeps duplicates."""
    for other in others:
        first = first.unionByName(other)
    return first
