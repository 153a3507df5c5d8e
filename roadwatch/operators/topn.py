"""Top-N per group.

Spark turns ``row_number() <= n`` into a limit per group that runs before the
shuffle as well, so a hot group sends n rows per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_n(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int,
          rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group; ``order`` must end in a tie breaker."""
    placed = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn(rank, placed).where(F.col(rank) <= n)
