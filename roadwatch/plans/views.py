"""The record types of the jobs, taken from the given tables.

Each view is a projection or an aggregate of a whole table. ``source`` is a
batch or a streaming DataFrame of ``events``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.times import duration_micros, from_micros, micros
from ..sources.files import table

MONITORS = 20
AREAS = 8


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events")


def sightings(source: DataFrame) -> DataFrame:
    """Camera records, with ``arrival`` as their order of arrival."""
    monitor = F.lpad(F.pmod("event_id", F.lit(MONITORS)).cast("string"), 4, "0")
    return source.select(
        F.lpad(F.pmod("user_id", F.lit(AREAS)).cast("string"), 2, "0").alias("area_id"),
        F.col("event_type").alias("road_id"),
        monitor.alias("monitor_id"), monitor.alias("camera_id"),
        F.col("ts").alias("action_time"),
        F.col("user_id").cast("string").alias("car"),
        F.col("value").alias("speed"),
        F.col("event_id").alias("arrival"),
    )


def speed_limits(source: DataFrame) -> DataFrame:
    """A limit for each monitor seen, except on the roads without a posted limit."""
    number = F.col("monitor_id").cast("int")
    return (sightings(source).select("area_id", "road_id", "monitor_id").distinct()
            .where(F.col("road_id") != "signup")
            .withColumn("speed_limit", (30 + 10 * F.pmod(number, F.lit(5))).cast("double")))


def behaviour(source: DataFrame) -> DataFrame:
    return source.select(
        F.col("user_id").alias("guid"), F.col("event_type").alias("event_id"), "ts",
        F.floor("value").cast("int").alias("act_time"), F.col("event_id").alias("arrival"))


def counted(source: DataFrame) -> DataFrame:
    return source.select(
        F.col("user_id").alias("id"), F.col("event_type").alias("event_id"),
        F.pmod(F.floor("value").cast("int"), F.lit(10)).alias("cnt"),
        "ts", F.col("event_id").alias("arrival"))


def out_of_order(source: DataFrame) -> DataFrame:
    """Behaviour events whose event time lags their arrival by up to six hours."""
    lag = F.pmod(F.pmod("arrival", F.lit(37)) * 7919, F.lit(37)) * duration_micros("10 minutes")
    return behaviour(source).withColumn("event_time", from_micros(micros(F.col("ts")) - lag))


def persons(spark: SparkSession, folder: str) -> DataFrame:
    gender = F.when(F.pmod("c_custkey", F.lit(2)) == 0, "f").otherwise("m")
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), gender.alias("gender"),
        F.col("c_mktsegment").alias("city"))


def profile_updates(spark: SparkSession, folder: str) -> DataFrame:
    """Upserts of user profiles: later orders replace earlier ones.

    Only customers with an order in state ``P`` have a profile.
    """
    return (table(spark, folder, "orders").where("o_orderstatus = 'P'")
            .select(F.col("o_custkey").alias("id"), F.col("o_orderdate").alias("age"),
                    F.col("o_orderpriority").alias("city"), F.col("o_orderkey").alias("version")))


def characters(spark: SparkSession, folder: str) -> DataFrame:
    """Words of customers with a number, the input of the side outputs."""
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("character"),
        F.col("c_nationkey").alias("num"))
