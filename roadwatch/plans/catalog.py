"""Registry of queries and of the SQL that states the same result.

Every query reads whole tables. Window lengths are hours and days, because the
given events are spread over a month.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Build
    sql: str | None


UTC = ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")

REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Build], Build]:
    """Register the function under its own name."""
    def add(build: Build) -> Build:
        def in_utc(spark: SparkSession, folder: str) -> DataFrame:
            if spark.conf.get("spark.sql.session.timeZone") not in UTC:  # build_session sets it
                spark.conf.set("spark.sql.session.timeZone", "UTC")
            return build(spark, folder)
        REGISTRY[build.__name__] = Query(in_utc, sql)
        return build
    return add
