"""Intermediate results as tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import run_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back.

    What follows does not compute it again, a lost executor loses nothing, and
    Catalyst knows the size on disk: a join then broadcasts the table only if it
    is below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise.
    """
    path = run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
