"""The user's own functions over groups, and look-ups by key, beside the SQL of the same result."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import sql_parts as S
from . import views
from .catalog import query
from ..operators import cogroups, user_aggregates
from ..session import run_dir
from ..sources.files import replayed, table
from ..sources.lookup import KeyedLookup
from ..streaming.run import to_table

ERROR = 0.01
GAMMA = (1 + ERROR) / (1 - ERROR)


def _behaviour(spark: SparkSession, folder: str) -> DataFrame:
    return views.behaviour(views.events(spark, folder))


@query(f"""WITH {S.BEHAVIOUR}, {S.sliding('behaviour', 'ts', '12 HOUR', 2)}
SELECT event_id, window_start, window_end, CAST(sum(act_time) AS DOUBLE) / count(*) AS average
FROM spread GROUP BY ALL""")
def aggregate_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """An average from its own parts, per kind of event and sliding window."""
    return user_aggregates.windowed(_behaviour(spark, folder), ["event_id"], "ts", "24 hours", "12 hours",
                                    user_aggregates.AverageOfPairs(), "act_time")


def _bucket(quantile: float) -> str:
    """The sketch's number for the value of that rank: monotone, so it is the bucket of the true quantile."""
    value = f"list_sort(list(value))[CAST(floor({quantile} * (count(*) - 1)) AS BIGINT) + 1]"
    return f"round(2 * pow({GAMMA!r}, ceil(ln({value}) / {math.log(GAMMA)!r})) / ({GAMMA!r} + 1), 6)"


@query(f"""SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 12 HOUR AS session_end, count(*) AS n,
       {_bucket(0.5)} AS q50, {_bucket(0.9)} AS q90
FROM (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session
      FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)
                                <= INTERVAL 12 HOUR THEN 0 ELSE 1 END AS opens FROM events))
GROUP BY user_id, session""")
def aggregate_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    """Median and ninth decile of a session's values from a mergeable sketch, within one per cent."""
    found = user_aggregates.in_sessions(views.events(spark, folder), ["user_id"], "ts", "12 hours",
                                        user_aggregates.Quantiles([0.5, 0.9], ERROR), "value")
    return found.withColumns({q: F.round(q, 6) for q in ("q50", "q90")})


@query(f"""WITH {S.BEHAVIOUR}, both_sides AS (
  SELECT guid, event_id, arrival, act_time, ts, time_bucket(INTERVAL 3 DAY, ts) AS window_start
  FROM behaviour WHERE event_id IN ('view', 'click')),
runs AS (
  SELECT *, count(*) FILTER (event_id = 'view') OVER (
      PARTITION BY guid, window_start ORDER BY ts, arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS run
  FROM both_sides)
SELECT guid, window_start, window_start + INTERVAL 3 DAY AS window_end,
       max(arrival) FILTER (event_id = 'view') AS view, count(*) FILTER (event_id = 'click') AS clicks,
       arg_max(act_time, (ts, arrival)) FILTER (event_id = 'click') AS last_act_time
FROM runs GROUP BY guid, window_start, coalesce(run, 0)""")
def cogroup_aligned(spark: SparkSession, folder: str) -> DataFrame:
    """Along a user's views and clicks of three days: the clicks between each view and the one before it."""
    rows = _behaviour(spark, folder).select("guid", "ts", "event_id", "arrival", "act_time")
    left = rows.where("event_id = 'view'").select("guid", "ts", "arrival")
    right = rows.where("event_id = 'click'").select("guid", "ts", "arrival", "act_time")
    return cogroups.window_cogroup(left, right, ["guid"], "ts", "3 days", cogroups.aligned("arrival", "arrival", "act_time"),
                                   "view long, clicks long, last_act_time int")


@query("""SELECT e.event_id, e.user_id, c.c_mktsegment AS segment, c.c_nationkey AS nation
FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id""")
def stream_keyed_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Customers of each micro-batch asked for by key; a second batch asks for new ones only."""
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"))

    def load(conditions):  # the table stands in for a database
        return customers if conditions is None else customers.where(" OR ".join(conditions) or "false")
    lookup = KeyedLookup(load, ["user_id"], run_dir(spark, "lookup"), "1 day")
    events = replayed(spark, table(spark, folder, "events"), "event_id", "lookup").select("event_id", "user_id")
    written = to_table(events, "keyed-lookup", per_batch=lambda batch: batch.join(lookup.get(batch), "user_id", "left"))
    return written.select("event_id", "user_id", "segment", "nation")
