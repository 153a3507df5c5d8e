"""Streaming queries: a table is replayed in arrival order, cut into several
micro-batches, and the rows the stream wrote are the result. In append mode a
window is written once the watermark has passed its end, which the SQL states as
a condition; where it matters which rows came in earlier batches, the SQL uses
the same cuts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import sql_parts as S
from . import traffic, views
from .catalog import query
from .queries import AMOUNTS, CHARACTERS, RUN, profiles, speed_limits
from ..functions.parse import tokenise
from ..functions.times import duration_micros, from_micros, micros, time_text
from ..operators import aggs, joins, route, triggers, windows
from ..operators.running import count_rows, highest
from ..sources.files import replayed, table
from ..streaming import carried, jobs
from ..streaming.carried import carried_table
from ..streaming.run import final_rows, finish, start, to_table, with_event_time, without_zone

DELAY = "1 hour"
PASSED = "(SELECT max(ts) - INTERVAL 1 HOUR FROM events)"


SEEN = "(SELECT max(event_time) - INTERVAL 1 HOUR FROM disordered)"


def _replayed(spark: SparkSession, folder: str, name: str, order: str) -> DataFrame:
    return replayed(spark, table(spark, folder, name), order, name)


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return _replayed(spark, folder, "events", "event_id")


def _result(written: DataFrame) -> DataFrame:
    return without_zone(written).drop("batch_id")


@query("""SELECT word, count(*) AS total
FROM (SELECT unnest(string_split(rtrim(text, ' '), ' ')) AS word FROM documents
      WHERE text = '' OR rtrim(text, ' ') <> '')
GROUP BY word""")
def stream_word_count(spark: SparkSession, folder: str) -> DataFrame:
    documents = replayed(spark, table(spark, folder, "documents"), "doc_id", "documents", F.octet_length("text"))
    words = tokenise(documents, "text", " ")
    return final_rows(to_table(aggs.word_count(words), "word-count", "update"), ["word"])


@query(f"""WITH {S.SIGHTINGS}, {S.sliding('sightings', 'action_time', '1 HOUR', 6)}
SELECT window_start, window_end, area_id, road_id, monitor_id,
       round(avg(speed), 9) AS avg_speed, count(*) AS car_count
FROM spread WHERE window_end <= {PASSED} GROUP BY ALL""")
def stream_avg_speed(spark: SparkSession, folder: str) -> DataFrame:
    averages = jobs.average_speed(views.sightings(_events(spark, folder)), "6 hours", "1 hour", DELAY)
    return _result(to_table(averages, "avg-speed")).withColumn("avg_speed", F.round("avg_speed", 9))


@query("""SELECT user_id, time_bucket(INTERVAL 6 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR AS window_end, count(*) AS n
FROM events GROUP BY ALL""")
def stream_tumbling_count(spark: SparkSession, folder: str) -> DataFrame:
    """Update mode: every window's newest count, open windows included."""
    counts = windows.windowed(with_event_time(_events(spark, folder), "ts", DELAY), "ts", "6 hours",
                              None, ["user_id"], {"n": count_rows()})
    written = to_table(counts, "tumbling", "update")
    return without_zone(final_rows(written, ["user_id", "window_start", "window_end"]))


@query(f"""SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 6 HOUR AS session_end, count(*) AS n,
       max(value) AS most
FROM (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session
      FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)
                                <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens FROM events))
GROUP BY user_id, session HAVING max(ts) + INTERVAL 6 HOUR <= {PASSED}""")
def stream_session_keyed(spark: SparkSession, folder: str) -> DataFrame:
    found = jobs.session_windows(_events(spark, folder), "ts", "6 hours", DELAY, ["user_id"],
                                 {"n": count_rows(), "most": highest(F.col("value"))})
    return _result(to_table(found, "sessions"))


@query(f"""WITH {S.SIGHTINGS}, {S.LIMITS}, {S.SPEEDING}
SELECT car, monitor_id, road_id, speed AS real_speed, lim AS limit_speed, action_time, arrival
FROM speeding""")
def stream_overspeed(spark: SparkSession, folder: str) -> DataFrame:
    limits = speed_limits(spark, folder)
    fast = traffic.speeding_records(views.sightings(_events(spark, folder)), limits, "arrival")
    return _result(to_table(fast, "overspeed"))


@query("""SELECT e.event_id, e.user_id AS id, e.event_type AS event, p.age, p.city
FROM events e LEFT JOIN (
  SELECT o_custkey AS id, o_orderdate AS age, o_orderpriority AS city,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn
  FROM orders WHERE o_orderstatus = 'P') p ON p.id = e.user_id AND rn = 1""")
def stream_broadcast_enrich(spark: SparkSession, folder: str) -> DataFrame:
    events = _events(spark, folder).select(
        "event_id", F.col("user_id").alias("id"), F.col("event_type").alias("event"))
    return _result(to_table(joins.lookup(events, profiles(spark, folder), ["id"]), "enrich"))


@query(f"""WITH {S.SIGHTINGS}, {S.sliding('sightings', 'action_time', '12 HOUR', 2)}, counts AS (
  SELECT window_start, window_end, area_id || '_' || road_id || '_' || monitor_id AS monitor,
         count(*) FILTER (speed >= 120) AS high_count,
         count(*) FILTER (speed >= 90 AND speed < 120) AS middle_count,
         count(*) FILTER (speed >= 60 AND speed < 90) AS normal_count,
         count(*) FILTER (speed < 60) AS low_count
  FROM spread WHERE window_end <= {PASSED} GROUP BY ALL)
SELECT * EXCLUDE (rn), CAST(rn AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY high_count DESC, middle_count DESC,
    normal_count DESC, low_count DESC, monitor) AS rn FROM counts) WHERE rn <= 5""")
def stream_top5_monitors(spark: SparkSession, folder: str) -> DataFrame:
    counts = jobs.band_counts(views.sightings(_events(spark, folder)), "24 hours", "12 hours", DELAY)
    return _result(to_table(counts, "top5", per_batch=traffic.busiest))


@query(f"""WITH {S.BEHAVIOUR}
SELECT l.guid, l.arrival AS left_arrival, r.arrival AS right_arrival, l.act_time + r.act_time AS num
FROM behaviour l JOIN behaviour r ON l.guid = r.guid
  AND time_bucket(INTERVAL 6 HOUR, l.ts) = time_bucket(INTERVAL 6 HOUR, r.ts)
WHERE l.event_id = 'view' AND r.event_id = 'click'""")
def stream_window_join(spark: SparkSession, folder: str) -> DataFrame:
    left = views.behaviour(_events(spark, folder)).where("event_id = 'view'").select(
        "guid", "ts", F.col("act_time").alias("l_num"), F.col("arrival").alias("left_arrival"))
    right = views.behaviour(_events(spark, folder)).where("event_id = 'click'").select(
        "guid", "ts", F.col("act_time").alias("r_num"), F.col("arrival").alias("right_arrival"))
    pairs = jobs.window_join(left, right, ["guid"], "ts", "6 hours", DELAY)
    return _result(to_table(pairs, "window-join")).select(
        "guid", "left_arrival", "right_arrival", (F.col("l_num") + F.col("r_num")).alias("num"))


@query(f"WITH {CHARACTERS} SELECT * FROM characters")
def stream_route(spark: SparkSession, folder: str) -> DataFrame:
    """Three side outputs written from one stream, then read together."""
    rows = _replayed(spark, folder, "customer", "c_custkey").select(
        F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("character"),
        F.col("c_nationkey").alias("num"))
    names, out = ["a", "b", "main"], jobs.new_folder(rows, "route")
    writer = jobs.route_writer(
        lambda batch: route.route(batch, route.letter_rules("character")), out, names)
    finish(start(rows, writer, f"{out}/checkpoint"))
    parts = [spark.read.parquet(f"{out}/{n}").drop("batch_id").withColumn("route", F.lit(n))
             for n in names]
    return route.union_all(*parts)


# --- keyed state ------------------------------------------------------------

@query(f"""WITH {AMOUNTS}
SELECT CAST((rn - 1) // 3 AS BIGINT) AS window_no, key, CAST(sum(n) AS BIGINT) AS total
FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY event_id) AS rn FROM amounts)
GROUP BY 1, 2 HAVING count(*) = 3""")
def stream_count_window(spark: SparkSession, folder: str) -> DataFrame:
    amounts = _events(spark, folder).select(
        "event_id", F.col("event_type").alias("key"), F.floor("value").cast("long").alias("n"))
    return _result(carried_table(amounts, "count-window", carried.count_windows("key", "event_id", "n", 3)))


@query("""SELECT o_orderkey AS arrival, o_custkey AS key,
       string_agg(o_orderstatus, '') OVER (PARTITION BY o_custkey ORDER BY o_orderkey
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS joined
FROM orders""")
def stream_running_concat(spark: SparkSession, folder: str) -> DataFrame:
    orders = _replayed(spark, folder, "orders", "o_orderkey")
    texts = jobs.text_so_far(orders, "o_custkey", "o_orderkey", "o_orderstatus")
    return _result(to_table(texts, "concat")).withColumnsRenamed(
        {"o_custkey": "key", "o_orderkey": "arrival"})


@query(f"""WITH {S.BEHAVIOUR}, numbered AS (
  SELECT *, row_number() OVER (PARTITION BY guid, event_id ORDER BY arrival) AS of_kind FROM behaviour)
SELECT guid AS key, arrival, CAST(sum(act_time) {RUN} AS BIGINT) AS total,
       CAST(sum(act_time) {RUN} AS DOUBLE) / count(*) {RUN} AS average, of_kind,
       CAST(count(*) FILTER (of_kind = 1) {RUN} AS INTEGER) AS kinds,
       string_agg(act_time, ',') OVER (PARTITION BY guid ORDER BY arrival
         ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS last_three
FROM numbered""")
def stream_state_kinds(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.behaviour(_events(spark, folder)).select(
        F.col("guid").alias("key"), "arrival", F.col("event_id").alias("kind"),
        F.col("act_time").cast("long").alias("n"))
    return _result(carried_table(rows, "state-kinds", carried.state_kinds("key", "arrival", "kind", "n")))


@query(f"""WITH {S.OUT_OF_ORDER}, seen AS (
  SELECT CAST(guid AS VARCHAR) AS car, arrival, event_time,
         max(event_time) OVER (PARTITION BY guid ORDER BY arrival
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous
  FROM disordered)
SELECT car, arrival, strftime(previous, '%Y-%m-%d %H:%M:%S') AS previous_time,
       strftime(event_time, '%Y-%m-%d %H:%M:%S') AS this_time
FROM seen WHERE abs(epoch_us(event_time) - epoch_us(previous)) < 3600000000""")
def stream_cloned_plate(spark: SparkSession, folder: str) -> DataFrame:
    shifted = views.out_of_order(_events(spark, folder)).select(
        F.col("guid").cast("string").alias("car"), "arrival", F.col("event_time").alias("action_time"))
    return _result(carried_table(shifted, "cloned-plate", jobs.cloned_plates("1 hour"))).select(
        "car", "arrival", time_text(from_micros(F.col("previous_us"))).alias("previous_time"),
        time_text(from_micros(F.col("time_us"))).alias("this_time"))


@query(f"""WITH {S.BEHAVIOUR}, {S.CUTS}
SELECT e.arrival, e.guid, max(u.arrival) AS known_since, arg_max(u.act_time, u.arrival) AS known_act_time
FROM behaviour e, cuts LEFT JOIN behaviour u
  ON u.event_id = 'signup' AND u.guid = e.guid AND u.arrival // cuts.width <= e.arrival // cuts.width
WHERE e.event_id <> 'signup' GROUP BY e.arrival, e.guid""")
def stream_changing_profiles(spark: SparkSession, folder: str) -> DataFrame:
    """Signups update a user's profile while the stream runs; other events see the newest one."""
    rows = views.behaviour(_events(spark, folder)).select("guid", "arrival", "event_id", "act_time")
    step = carried.upserted_dimension(
        F.col("event_id") == "signup", ["guid"], "arrival",
        {"known_since": F.col("arrival"), "known_act_time": F.col("act_time")})
    return _result(carried_table(rows, "profiles", step)).drop("event_id", "act_time")


@query(f"""WITH {S.SIGHTINGS}, {S.LIMITS}, {S.OUT_OF_ORDER}, late_sightings AS (
  SELECT s.* REPLACE (d.event_time AS action_time) FROM sightings s JOIN disordered d USING (arrival)),
speeding AS (
  SELECT * FROM (
    SELECT s.*, coalesce(l.speed_limit, 60.0::DOUBLE) AS lim
    FROM late_sightings s LEFT JOIN limits l USING (area_id, road_id, monitor_id)) x
  WHERE speed > lim * 1.2::DOUBLE), runs AS (
  SELECT car, arrival AS first_arrival, action_time AS t1, monitor_id AS m1,
         lead(arrival, 1) OVER w AS second_arrival, lead(action_time, 1) OVER w AS t2,
         lead(monitor_id, 1) OVER w AS m2,
         lead(arrival, 2) OVER w AS third_arrival, lead(action_time, 2) OVER w AS t3,
         lead(monitor_id, 2) OVER w AS m3
  FROM speeding WINDOW w AS (PARTITION BY car ORDER BY action_time, arrival))
SELECT car, first_arrival, second_arrival, third_arrival, '{traffic.DANGER_TEXT}' AS violation,
       car || '{traffic.DANGER_LABELS['first']}' || m1 || (epoch_us(t1) // 1000)
       || '{traffic.DANGER_LABELS['second']}' || m2 || (epoch_us(t2) // 1000)
       || '{traffic.DANGER_LABELS['third']}' || m3 || (epoch_us(t3) // 1000) AS detail
FROM runs WHERE t3 - t1 < INTERVAL 1 DAY
  AND t3 < (SELECT max(event_time) - INTERVAL 7 HOUR FROM disordered)""")
def stream_danger_driver(spark: SparkSession, folder: str) -> DataFrame:
    """Sightings up to six hours late; the delay lets all of them take part."""
    limits, events = speed_limits(spark, folder), _events(spark, folder)
    lag = F.pmod(F.pmod("arrival", F.lit(37)) * 7919, F.lit(37)) * duration_micros("10 minutes")
    late = views.sightings(events).withColumn("action_time", from_micros(micros(F.col("action_time")) - lag))
    runs = jobs.danger_drivers(late, limits, "1 day", "7 hours")
    return _result(to_table(runs, "danger"))


@query(f"""WITH {S.SEEN_BEFORE}, w AS (
  SELECT *, time_bucket(INTERVAL 1 DAY, event_time) AS window_start FROM arrived
  WHERE seen IS NULL OR time_bucket(INTERVAL 1 DAY, event_time) + INTERVAL 1 DAY > seen - INTERVAL 1 HOUR),
fires AS (
  SELECT a.guid, a.window_start, a.arrival AS fired_by, count(*) AS count
  FROM w a JOIN w b ON a.guid = b.guid AND a.window_start = b.window_start AND b.arrival <= a.arrival
  WHERE a.event_id = 'error' GROUP BY ALL
  UNION ALL SELECT guid, window_start, NULL, count(*) FROM w GROUP BY ALL)
SELECT guid, window_start, window_start + INTERVAL 1 DAY AS window_end, fired_by, count,
       epoch_ms(window_start) || ':' || count || epoch_ms(window_start + INTERVAL 1 DAY) AS text
FROM fires WHERE fired_by IS NOT NULL OR window_start + INTERVAL 1 DAY <= {SEEN}""")
def stream_marker_trigger(spark: SparkSession, folder: str) -> DataFrame:
    """Rows come up to six hours late; those whose window has passed are left out."""
    fired = jobs.fire_on_marker(views.out_of_order(_events(spark, folder)), "event_time", "1 day",
                                F.col("event_id") == "error", DELAY)
    return _result(to_table(fired, "marker")).withColumn("text", triggers.window_text(F.col("count")))


@query(f"""WITH {S.SEEN_BEFORE}, {S.sliding('arrived', 'event_time', '12 HOUR', 2)}
SELECT guid, window_start, window_end, event_id, act_time, arrival, CAST(rn AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY guid, window_start ORDER BY act_time DESC, arrival) AS rn
  FROM spread WHERE window_end <= {SEEN} AND (seen IS NULL OR window_end > seen - INTERVAL 1 HOUR))
WHERE rn <= 2""")
def stream_top2_per_window(spark: SparkSession, folder: str) -> DataFrame:
    """Rows come up to six hours late; those whose window has passed are left out."""
    best = jobs.top_per_window(views.out_of_order(_events(spark, folder)), "event_time", "24 hours",
                               "12 hours", 2, DELAY)
    return _result(to_table(best, "top2"))


@query(f"""WITH {S.SEEN_BEFORE}
SELECT guid, event_id, arrival, time_bucket(INTERVAL 1 HOUR, event_time) AS window_start,
       coalesce(time_bucket(INTERVAL 1 HOUR, event_time) + INTERVAL 3 HOUR <= seen - INTERVAL 1 HOUR,
                false) AS is_late
FROM arrived""")
def stream_late_split(spark: SparkSession, folder: str) -> DataFrame:
    """Late rows to their own output: each row against what the batches before it have seen."""
    rows = views.out_of_order(_events(spark, folder))
    out = jobs.new_folder(rows, "late-split")
    writer = jobs.late_splitter("event_time", "1 hour", delay="1 hour", lateness="2 hours", folder=out)
    finish(start(rows, writer, f"{out}/checkpoint"))
    parts = [spark.read.parquet(f"{out}/{name}").withColumn("is_late", F.lit(name == "late"))
             for name in ("main", "late")]
    return _result(route.union_all(*parts)).select("guid", "event_id", "arrival", "window_start", "is_late")
