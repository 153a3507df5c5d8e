"""Sequences of events, beside SQL that states them as joins of the events with themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import sql_parts as S
from . import views
from .catalog import query
from ..operators import sequences
from ..operators.sequences import Pattern
from ..sources.files import replayed, table
from ..streaming import patterns
from ..streaming.run import to_table, without_zone

#: A view, the very next event a click, then a purchase with no error before it.
CHECKOUT = (Pattern.begin("look", "event_id = 'view'").next("choose", "event_id = 'click'")
            .not_followed_by("event_id = 'error'").followed_by("buy", "event_id = 'purchase'").within("5 days"))
#: An error, one or two more, and every purchase behind them.
RETRIES = (Pattern.begin("fail", "event_id = 'error'").followed_by("again", "event_id = 'error'").times(1, 2)
           .followed_by_any("buy", "event_id = 'purchase'").within("4 days"))
#: A view and a large click that no purchase follows in time.
ABANDONED = (Pattern.begin("look", "event_id = 'view'")
             .followed_by("choose", "event_id = 'click' AND act_time >= 20")
             .not_followed_by("event_id = 'purchase'").within("2 days"))

_NUMBERED = S.BEHAVIOUR + """, numbered AS (
  SELECT guid, event_id AS kind, arrival, ts, row_number() OVER (PARTITION BY guid ORDER BY ts, arrival) AS rn
  FROM behaviour)"""


def _behaviour(spark: SparkSession, folder: str) -> DataFrame:
    return views.behaviour(views.events(spark, folder))


@query(f"""WITH {_NUMBERED}, pairs AS (
  SELECT a.guid, a.arrival AS look, a.ts AS began, b.arrival AS choose, b.rn,
         (SELECT min(c.rn) FROM numbered c WHERE c.guid = b.guid AND c.rn > b.rn AND c.kind = 'purchase') AS buy_rn
  FROM numbered a JOIN numbered b ON b.guid = a.guid AND b.rn = a.rn + 1
  WHERE a.kind = 'view' AND b.kind = 'click')
SELECT p.guid, look, choose, c.arrival AS buy
FROM pairs p JOIN numbered c ON c.guid = p.guid AND c.rn = p.buy_rn
WHERE c.ts - began < INTERVAL 5 DAY AND NOT EXISTS (
  SELECT 1 FROM numbered e WHERE e.guid = p.guid AND e.kind = 'error' AND e.rn > p.rn AND e.rn < p.buy_rn)""")
def pattern_checkout(spark: SparkSession, folder: str) -> DataFrame:
    found = sequences.match(_behaviour(spark, folder), CHECKOUT, ["guid"], "ts", "arrival", ["arrival"])
    return found.select("guid", *[F.col(f"{s}.arrival").alias(s) for s in ("look", "choose", "buy")])


@query(f"""WITH {_NUMBERED}, errors AS (
  SELECT *, lead(arrival, 1) OVER w AS a1, lead(rn, 1) OVER w AS r1, lead(ts, 1) OVER w AS t1,
         lead(arrival, 2) OVER w AS a2, lead(rn, 2) OVER w AS r2, lead(ts, 2) OVER w AS t2
  FROM numbered WHERE kind = 'error' WINDOW w AS (PARTITION BY guid ORDER BY rn)),
retries AS (
  SELECT guid, arrival AS fail, ts AS began, CAST(a1 AS VARCHAR) AS again, r1 AS last FROM errors WHERE a1 IS NOT NULL
  UNION ALL
  SELECT guid, arrival, ts, a1 || ',' || a2, r2 FROM errors WHERE a2 IS NOT NULL)
SELECT r.guid, r.fail, r.again, p.arrival AS buy
FROM retries r JOIN numbered p ON p.guid = r.guid AND p.kind = 'purchase' AND p.rn > r.last
  AND p.ts - r.began < INTERVAL 4 DAY""")
def pattern_retries(spark: SparkSession, folder: str) -> DataFrame:
    found = sequences.match(_behaviour(spark, folder), RETRIES, ["guid"], "ts", "arrival", ["arrival"])
    return found.select("guid", F.col("fail.arrival").alias("fail"),
                        F.array_join(F.col("again.arrival").cast("array<string>"), ",").alias("again"),
                        F.col("buy.arrival").alias("buy"))


@query(f"""WITH RECURSIVE {_NUMBERED}, ended AS (
  SELECT a.guid, a.rn, a.arrival AS look, a.ts AS began, min(b.rn) AS last
  FROM numbered a JOIN numbered b ON b.guid = a.guid AND b.kind IN ('click', 'purchase') AND b.rn > a.rn
  WHERE a.kind = 'view' GROUP BY ALL),
matches AS (
  SELECT e.guid, look, b.arrival AS buy, e.rn, e.last AS last_rn
  FROM ended e JOIN numbered b ON b.guid = e.guid AND b.rn = e.last
  WHERE b.kind = 'click' AND b.ts - began < INTERVAL 3 DAY),
firsts AS (SELECT guid, rn, last_rn, look, buy, row_number() OVER (PARTITION BY guid ORDER BY last_rn, rn) AS no FROM matches),
taken AS (
  SELECT guid, no, last_rn, look, buy, true AS kept FROM firsts WHERE no = 1
  UNION ALL
  SELECT f.guid, f.no, CASE WHEN f.rn > t.last_rn THEN f.last_rn ELSE t.last_rn END, f.look, f.buy, f.rn > t.last_rn
  FROM taken t JOIN firsts f ON f.guid = t.guid AND f.no = t.no + 1)
SELECT guid, look, buy AS choose FROM taken WHERE kept""")
def pattern_visits(spark: SparkSession, folder: str) -> DataFrame:
    """Views with a click before any purchase; matches of one user do not overlap."""
    pattern = (Pattern.begin("look", "event_id = 'view'").not_followed_by("event_id = 'purchase'")
               .followed_by("choose", "event_id = 'click'").within("3 days").skip("past_last"))
    found = sequences.match(_behaviour(spark, folder), pattern, ["guid"], "ts", "arrival", ["arrival"])
    return found.select("guid", F.col("look.arrival").alias("look"), F.col("choose.arrival").alias("choose"))


@query(f"""WITH {S.OUT_OF_ORDER}, numbered AS (
  SELECT *, row_number() OVER (PARTITION BY guid ORDER BY event_time, arrival) AS rn FROM disordered),
chosen AS (
  SELECT a.guid, a.arrival AS look, a.event_time AS began, min(b.rn) AS rn
  FROM numbered a JOIN numbered b ON b.guid = a.guid AND b.rn > a.rn AND b.event_id = 'click' AND b.act_time >= 20
  WHERE a.event_id = 'view' GROUP BY ALL)
SELECT c.guid, c.look, b.arrival AS choose
FROM chosen c JOIN numbered b ON b.guid = c.guid AND b.rn = c.rn
WHERE b.event_time - began < INTERVAL 2 DAY AND NOT EXISTS (
    SELECT 1 FROM numbered p WHERE p.guid = c.guid AND p.event_id = 'purchase' AND p.rn > c.rn
      AND p.event_time - began < INTERVAL 2 DAY)
  AND began + INTERVAL 2 DAY < (SELECT max(event_time) - INTERVAL 7 HOUR FROM disordered)""")
def stream_pattern(spark: SparkSession, folder: str) -> DataFrame:
    """Events up to six hours late; a match is given when its two days have passed without a purchase."""
    events = replayed(spark, table(spark, folder, "events"), "event_id", "pattern")
    found = patterns.match(views.out_of_order(events), ABANDONED, ["guid"], "event_time", "arrival", "7 hours",
                           ["arrival"])
    written = without_zone(to_table(found, "pattern")).drop("batch_id")
    return written.select("guid", F.col("look.arrival").alias("look"), F.col("choose.arrival").alias("choose"))
