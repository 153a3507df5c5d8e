"""The batch queries, each beside the SQL that defines its result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import sql_parts as S
from . import traffic, views
from .catalog import query
from .. import schemas
from ..functions.parse import accepted, parse_delimited, rejected, tokenise
from ..functions.times import millis, time_text
from ..operators import (
    aggs, count_windows, histories, joins, late, process, project, route, sessions, topn,
    triggers, windows,
)
from ..operators.running import count_rows, highest, total
from ..sources.files import table
from ..sources.kafka import as_lines
from ..sources.stored import stored


def speed_limits(spark: SparkSession, folder: str) -> DataFrame:
    return stored(views.speed_limits(views.events(spark, folder)), "limits")


def profiles(spark: SparkSession, folder: str) -> DataFrame:
    latest = joins.latest_per_key(views.profile_updates(spark, folder), ["id"], "version")
    return stored(latest.drop("version"), "profiles")


def _sightings(spark: SparkSession, folder: str) -> DataFrame:
    return views.sightings(views.events(spark, folder))


def _behaviour(spark: SparkSession, folder: str) -> DataFrame:
    return views.behaviour(views.events(spark, folder))


# --- parsing and projection -------------------------------------------------

def sighting_lines(spark: SparkSession, folder: str) -> DataFrame:
    """TAB lines of all sightings. Errors of value below 5 lack the last fields,
    signups above 100 have a speed that is no number."""
    rows = _sightings(spark, folder).withColumn("action_time", millis(F.col("action_time")))
    broken = rows.withColumns({
        "speed": F.when((F.col("road_id") == "signup") & (F.col("speed") > 100), "n/a")
        .otherwise(F.col("speed").cast("string")),
        "short": (F.col("road_id") == "error") & (F.col("speed") < 5),
    })
    names = schemas.SIGHTING.fieldNames()
    full = F.concat_ws("\t", *names)
    return broken.select(F.when(F.col("short"), F.concat_ws("\t", *names[:5]))
                         .otherwise(full).alias("value"), "arrival")


BAD_LINE = """((road_id = 'signup' AND speed > 100) OR (road_id = 'error' AND speed < 5))"""


@query(f"""WITH {S.SIGHTINGS}
SELECT area_id, road_id, monitor_id, camera_id, epoch_us(action_time) // 1000 AS action_time, car, speed,
       arrival
FROM sightings WHERE NOT {BAD_LINE}""")
def parse_sighting(spark: SparkSession, folder: str) -> DataFrame:
    return accepted(parse_delimited(sighting_lines(spark, folder), schemas.SIGHTING, "\t"), "value")


@query(f"""WITH {S.SIGHTINGS}
SELECT arrival, CASE WHEN road_id = 'error' THEN 5 ELSE 7 END AS fields
FROM sightings WHERE {BAD_LINE}""")
def parse_rejects(spark: SparkSession, folder: str) -> DataFrame:
    parsed = parse_delimited(sighting_lines(spark, folder), schemas.SIGHTING, "\t")
    return rejected(parsed, "arrival", F.size(F.split("value", "\t")).alias("fields"))


@query(f"""WITH {S.BEHAVIOUR}
SELECT guid, event_id, epoch_us(ts) // 1000 AS timestamp, act_time FROM behaviour""")
def parse_event(spark: SparkSession, folder: str) -> DataFrame:
    rows = _behaviour(spark, folder).withColumn("timestamp", millis(F.col("ts")))
    lines = as_lines(rows, schemas.BEHAVIOUR_EVENT.fieldNames(), ",")
    return accepted(parse_delimited(lines, schemas.BEHAVIOUR_EVENT, ","), "value")


@query("""SELECT CAST(user_id AS VARCHAR) AS user, event_type AS page,
       epoch_ms(date_trunc('second', ts)) AS event_ms
FROM events""")
def parse_click(spark: SparkSession, folder: str) -> DataFrame:
    """Lines that carry seconds, brought to milliseconds."""
    rows = views.events(spark, folder).select(
        F.col("user_id").alias("user"), F.col("event_type").alias("page"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("seconds"))
    lines = as_lines(rows, schemas.CLICK.fieldNames(), ",")
    clicks = accepted(parse_delimited(lines, schemas.CLICK, ","), "value")
    return clicks.select("user", "page", F.unix_millis(F.timestamp_seconds("seconds")).alias("event_ms"))


@query("""SELECT event_type || ',' || user_id || ',' || event_id AS value FROM events""")
def format_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The text records a Kafka sink gets."""
    return as_lines(views.events(spark, folder), ["event_type", "user_id", "event_id"], ",")


@query("""SELECT CAST(user_id AS VARCHAR) AS key, event_type AS value FROM events""")
def process_pair(spark: SparkSession, folder: str) -> DataFrame:
    """Lines split into a pair."""
    lines = as_lines(views.events(spark, folder), ["user_id", "event_type"], ",")
    parts = F.split("value", ",")
    return lines.select(F.try_element_at(parts, F.lit(1)).alias("key"),
                        F.try_element_at(parts, F.lit(2)).alias("value"))


@query("""SELECT doc_id, strip_accents(text) AS plain FROM documents""")
def process_plain_text(spark: SparkSession, folder: str) -> DataFrame:
    """A process function with set-up: every partition opens the letter table once."""
    return process.without_accents(table(spark, folder, "documents"), "doc_id", "text")


@query("""SELECT CAST(user_id AS VARCHAR) AS id, event_type AS event FROM events""")
def parse_user_event(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.events(spark, folder).select(F.col("user_id").alias("id"), F.col("event_type").alias("event"))
    lines = as_lines(rows, schemas.USER_EVENT.fieldNames(), ",")
    return accepted(parse_delimited(lines, schemas.USER_EVENT, ","), "value")


@query(f"""WITH {S.BEHAVIOUR} SELECT arrival, guid, event_id, act_time, 1 AS f1 FROM behaviour""")
def nested_pair(spark: SparkSession, folder: str) -> DataFrame:
    pairs = project.pair_with_one(_behaviour(spark, folder))
    return pairs.select("f0.arrival", "f0.guid", "f0.event_id", "f0.act_time", "f1")


@query("""SELECT word, count(*) AS total
FROM (SELECT unnest(string_split(rtrim(text, ' '), ' ')) AS word FROM documents
      WHERE text = '' OR rtrim(text, ' ') <> '')
GROUP BY word""")
def word_count(spark: SparkSession, folder: str) -> DataFrame:
    return aggs.word_count(tokenise(table(spark, folder, "documents"), "text", " "))


@query(f"""WITH {S.COUNTED}
SELECT id, event_id, arrival, CAST((id % 2147483648 * 7919 + i * 104729 + 11) % cnt AS BIGINT) AS cnt
FROM (SELECT *, unnest(generate_series(0, cnt - 1)) AS i FROM counted WHERE cnt > 0)""")
def expand_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.counted(views.events(spark, folder))
    return (project.expand_rows(rows, "cnt", "drawn", key="id", seed=11)
            .select("id", "event_id", "arrival", F.col("drawn").alias("cnt")))


@query("""SELECT CAST(user_id AS INTEGER) AS key, upper(event_type) AS value FROM events""")
def keyed_upper(spark: SparkSession, folder: str) -> DataFrame:
    return project.keyed_upper(views.events(spark, folder), "user_id", "event_type")


# --- side outputs, co-map, union --------------------------------------------

CHARACTERS = """characters AS (
  SELECT c_custkey AS key, c_mktsegment AS character, c_nationkey AS num,
         CASE WHEN lower(c_mktsegment) LIKE '%a%' THEN 'a'
              WHEN lower(c_mktsegment) LIKE '%b%' THEN 'b' ELSE 'main' END AS route
  FROM customer)"""


def _routed(spark: SparkSession, folder: str) -> DataFrame:
    return route.route(views.characters(spark, folder), route.letter_rules("character"))


@query(f"WITH {CHARACTERS} SELECT * FROM characters")
def route_side_output(spark: SparkSession, folder: str) -> DataFrame:
    return _routed(spark, folder)


@query(f"""WITH {CHARACTERS}
SELECT key, character || '{route.SIDE_A_TEXT}' AS character, num + {route.SIDE_A_ADD} AS num
FROM characters WHERE route = 'a'
UNION ALL
SELECT key, character || '{route.SIDE_B_TEXT}', num + {route.SIDE_B_ADD} FROM characters WHERE route = 'b'""")
def co_map(spark: SparkSession, folder: str) -> DataFrame:
    routed = _routed(spark, folder)
    return route.co_map(route.output(routed, "a"), route.output(routed, "b"))


@query(f"""WITH {CHARACTERS}
SELECT key, character, num FROM characters WHERE route = 'a'
UNION ALL SELECT key, character, num FROM characters WHERE route = 'b'
UNION ALL SELECT key, character, num FROM characters WHERE route = 'b'""")
def union_all(spark: SparkSession, folder: str) -> DataFrame:
    routed = _routed(spark, folder)
    side_b = route.output(routed, "b")
    return route.union_all(route.output(routed, "a"), side_b, side_b)


# --- joins ------------------------------------------------------------------

def persons_seen(spark: SparkSession, folder: str) -> DataFrame:
    """A person enters the stream at each signup."""
    signups = (views.events(spark, folder).where("event_type = 'signup'")
               .select(F.col("user_id").alias("id"), "ts"))
    return joins.lookup(signups, views.persons(spark, folder), ["id"]).where("gender is not null")


def joined_persons(spark: SparkSession, folder: str) -> DataFrame:
    left = views.counted(views.events(spark, folder))
    return joins.window_join(left, persons_seen(spark, folder), ["id"], "ts", "1 hour").drop("window_end")


@query(f"""WITH {S.JOINED} SELECT * FROM joined""")
def event_person_join(spark: SparkSession, folder: str) -> DataFrame:
    return joined_persons(spark, folder)


@query(f"""WITH {S.JOINED}
SELECT arrival, copies, cnt, CASE WHEN cnt % 7 = 0 THEN 'by_seven' ELSE 'main' END AS route
FROM joined""")
def route_mod7(spark: SparkSession, folder: str) -> DataFrame:
    routed = route.route(joined_persons(spark, folder), route.divisible_by_seven("cnt"))
    return routed.select("arrival", "copies", "cnt", "route")


@query(f"""WITH {S.COUNTED}
SELECT event_id, cnt, arrival, id FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY cnt DESC, arrival DESC) AS rn
  FROM counted WHERE cnt % 7 <> 0) WHERE rn = 1""")
def argmax_row(spark: SparkSession, folder: str) -> DataFrame:
    routed = route.route(views.counted(views.events(spark, folder)), route.divisible_by_seven("cnt"))
    main = route.output(routed, "main").select("event_id", "cnt", "arrival", "id")
    return aggs.row_with_max(main, ["event_id"], "cnt", "arrival")


@query(f"""WITH {S.COUNTED}
SELECT c.arrival, c.event_id, c.cnt,
       max(c.cnt) OVER w AS best_cnt,
       arg_max(c.arrival, (c.cnt, c.arrival)) OVER w AS best_arrival,
       arg_max(c.id, (c.cnt, c.arrival)) OVER w AS best_id
FROM counted c
WINDOW w AS (PARTITION BY event_id ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def running_argmax(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.counted(views.events(spark, folder)).select("arrival", "event_id", "cnt", "id")
    best = aggs.running_row_with_max(rows, ["event_id"], "cnt", "arrival", ["id"])
    return best.drop("id")


@query(f"""WITH {S.BEHAVIOUR}, l AS (
  SELECT guid, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, act_time FROM behaviour
  WHERE event_id IN ('view', 'click')), r AS (
  SELECT guid, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, act_time FROM behaviour
  WHERE event_id = 'click')
SELECT l.guid || CAST(r.guid AS VARCHAR) || '{route.JOIN_TEXT}' AS character, l.act_time + r.act_time AS num,
       window_start, count(*) AS copies
FROM l JOIN r USING (guid, window_start) GROUP BY ALL""")
def window_join(spark: SparkSession, folder: str) -> DataFrame:
    """Key texts joined and numbers added; ``copies`` counts equal results."""
    rows = _behaviour(spark, folder)
    left = rows.where("event_id in ('view', 'click')").select(
        "guid", "ts", F.col("act_time").alias("l_num"))
    right = rows.where("event_id = 'click'").select(
        "guid", "ts", F.col("act_time").alias("r_num"))
    pairs = joins.cogroup_product(left, right, ["guid"], "l_num", "r_num", "ts", "1 hour")
    return (pairs.groupBy(F.concat("guid", "guid", F.lit(route.JOIN_TEXT)).alias("character"),
                          (F.col("l_num") + F.col("r_num")).alias("num"), "window_start")
            .agg(F.sum("copies").alias("copies")))


MONITOR_CNT = f"""WITH {S.COUNTED}, cars AS (
  SELECT lpad(CAST(arrival % 20 AS VARCHAR), 4, '0') AS monitor, event_id, cnt,
         time_bucket(INTERVAL 1 DAY, ts) AS window_start FROM counted)"""


def _monitor_counts(spark: SparkSession, folder: str, kinds: list[str], name: str) -> DataFrame:
    rows = views.counted(views.events(spark, folder))
    monitor = F.lpad(F.pmod("arrival", F.lit(views.MONITORS)).cast("string"), 4, "0")
    return rows.where(F.col("event_id").isin(kinds)).select(
        monitor.alias("monitor"), F.col("cnt").alias(name), "ts")


@query(f"""{MONITOR_CNT}
SELECT monitor || monitor || '{route.COGROUP_TEXT}' AS character, window_start, l.cnt + r.cnt AS num, count(*) AS copies
FROM (SELECT * FROM cars WHERE event_id IN ('view', 'error')) l
JOIN (SELECT * FROM cars WHERE event_id = 'error') r USING (monitor, window_start)
GROUP BY ALL""")
def cogroup_product(spark: SparkSession, folder: str) -> DataFrame:
    """Pairings of both sides, equal results counted in ``copies``."""
    left = _monitor_counts(spark, folder, ["view", "error"], "l_cnt")
    right = _monitor_counts(spark, folder, ["error"], "r_cnt")
    pairs = joins.cogroup_product(left, right, ["monitor"], "l_cnt", "r_cnt", "ts", "1 day")
    return (pairs.groupBy(F.concat("monitor", "monitor", F.lit(route.COGROUP_TEXT)).alias("character"), "window_start",
                          (F.col("l_cnt") + F.col("r_cnt")).alias("num"))
            .agg(F.sum("copies").alias("copies")))


@query(f"""{MONITOR_CNT}
SELECT monitor, window_start, coalesce(l.n, 0) AS left_rows, coalesce(r.n, 0) AS right_rows
FROM (SELECT monitor, window_start, count(*) AS n FROM cars WHERE event_id IN ('view', 'error') GROUP BY ALL) l
FULL JOIN (SELECT monitor, window_start, count(*) AS n FROM cars WHERE event_id = 'purchase' GROUP BY ALL) r
USING (monitor, window_start)""")
def cogroup_sizes(spark: SparkSession, folder: str) -> DataFrame:
    left = _monitor_counts(spark, folder, ["view", "error"], "cnt")
    right = _monitor_counts(spark, folder, ["purchase"], "cnt")
    return joins.cogroup_sizes(left, right, ["monitor"], "ts", "1 day").drop("window_end")


@query("""SELECT e.event_id, e.user_id AS id, e.event_type AS event, p.age, p.city
FROM events e LEFT JOIN (
  SELECT o_custkey AS id, o_orderdate AS age, o_orderpriority AS city,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn
  FROM orders WHERE o_orderstatus = 'P') p ON p.id = e.user_id AND rn = 1""")
def broadcast_enrich(spark: SparkSession, folder: str) -> DataFrame:
    events = views.events(spark, folder).select(
        "event_id", F.col("user_id").alias("id"), F.col("event_type").alias("event"))
    return joins.lookup(events, profiles(spark, folder), ["id"])


@query(f"""WITH {S.BEHAVIOUR}
SELECT e.arrival, e.guid, u.arrival AS known_since, u.act_time AS known_act_time
FROM behaviour e ASOF LEFT JOIN (SELECT * FROM behaviour WHERE event_id = 'signup') u
  ON e.guid = u.guid AND e.arrival >= u.arrival
WHERE e.event_id <> 'signup'""")
def asof_enrich(spark: SparkSession, folder: str) -> DataFrame:
    rows = _behaviour(spark, folder)
    known = joins.as_known_tagged(
        rows.select("guid", "arrival", "event_id", "act_time"), ["guid"], "arrival",
        F.col("event_id") == "signup",
        {"known_since": F.col("arrival"), "known_act_time": F.col("act_time")})
    return known.drop("event_id", "act_time")


@query(f"""WITH {S.BEHAVIOUR}
SELECT c.guid, c.arrival AS click, p.arrival AS purchase
FROM behaviour c JOIN behaviour p ON c.guid = p.guid
 AND p.ts BETWEEN c.ts - INTERVAL 30 MINUTE AND c.ts + INTERVAL 2 HOUR
WHERE c.event_id = 'click' AND p.event_id = 'purchase'""")
def interval_join(spark: SparkSession, folder: str) -> DataFrame:
    rows = _behaviour(spark, folder)
    clicks = rows.where("event_id = 'click'").select(
        "guid", F.col("ts").alias("click_ts"), F.col("arrival").alias("click"))
    buys = rows.where("event_id = 'purchase'").select(
        "guid", F.col("ts").alias("buy_ts"), F.col("arrival").alias("purchase"))
    pairs = joins.interval_join(clicks, buys, ["guid"], "click_ts", "buy_ts", "30 minutes", "2 hours")
    return pairs.select("guid", "click", "purchase")


# --- running aggregates and keyed state -------------------------------------

RUN = "OVER (PARTITION BY guid ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


@query(f"""WITH {S.BEHAVIOUR}
SELECT arrival, guid, CAST(sum(act_time) {RUN} AS BIGINT) AS running_sum FROM behaviour""")
def running_sum(spark: SparkSession, folder: str) -> DataFrame:
    rows = _behaviour(spark, folder).select("arrival", "guid", F.col("act_time").cast("long").alias("n"))
    return aggs.running_values(rows, ["guid"], "arrival", {"running_sum": total(F.col("n"))}).drop("n")


@query(f"""WITH {S.BEHAVIOUR}
SELECT arrival, guid, CAST(sum(act_time) {RUN} AS DOUBLE) / count(*) {RUN} AS running_avg FROM behaviour""")
def running_avg(spark: SparkSession, folder: str) -> DataFrame:
    rows = _behaviour(spark, folder).select("arrival", "guid", F.col("act_time").cast("long").alias("n"))
    state = aggs.running_values(rows, ["guid"], "arrival",
                                {"s": total(F.col("n")), "c": count_rows()})
    return state.select("arrival", "guid", (F.col("s") / F.col("c")).alias("running_avg"))


@query("""SELECT o_orderkey, o_custkey,
       string_agg(o_orderstatus, '') OVER (PARTITION BY o_custkey ORDER BY o_orderkey
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS joined
FROM orders""")
def running_concat(spark: SparkSession, folder: str) -> DataFrame:
    """The states of a customer's orders so far; a customer has few orders."""
    rows = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return histories.running_concat(rows, ["o_custkey"], "o_orderkey", "o_orderstatus").drop("o_orderstatus")


@query(f"""WITH {S.BEHAVIOUR}
SELECT a.arrival, a.guid, string_agg(b.event_id, '' ORDER BY b.arrival) AS joined
FROM behaviour a JOIN behaviour b
  ON a.guid = b.guid AND b.arrival <= a.arrival AND b.ts > a.ts - INTERVAL 1 DAY
GROUP BY a.arrival, a.guid""")
def ttl_concat(spark: SparkSession, folder: str) -> DataFrame:
    rows = _behaviour(spark, folder).select("arrival", "guid", "ts", "event_id")
    return (histories.ttl_concat(rows, ["guid"], "ts", "arrival", "event_id", "1 day")
            .select("arrival", "guid", "joined"))


# --- time windows -----------------------------------------------------------

@query(f"""WITH {S.SIGHTINGS}, {S.sliding('sightings', 'action_time', '1 HOUR', 6)}
SELECT window_start, window_end, area_id, road_id, monitor_id,
       round(avg(speed), 9) AS avg_speed, count(*) AS car_count
FROM spread GROUP BY ALL""")
def monitor_avg_speed(spark: SparkSession, folder: str) -> DataFrame:
    result = traffic.average_speed(_sightings(spark, folder), "6 hours", "1 hour")
    return result.withColumn("avg_speed", F.round("avg_speed", 9))


@query(f"""WITH {S.SIGHTINGS}
SELECT area_id || '_' || road_id || '_' || monitor_id AS monitor,
       strftime(time_bucket(INTERVAL 6 HOUR, action_time), '%Y-%m-%d %H:%M:%S') AS start_time,
       strftime(time_bucket(INTERVAL 6 HOUR, action_time) + INTERVAL 6 HOUR, '%Y-%m-%d %H:%M:%S') AS end_time,
       count(*) AS car_count
FROM sightings GROUP BY ALL""")
def format_window(spark: SparkSession, folder: str) -> DataFrame:
    counts = traffic.average_speed(_sightings(spark, folder), "6 hours", None)
    return counts.select(project.composite_key(*traffic.MONITOR).alias("monitor"),
                         time_text(F.col("window_start")).alias("start_time"),
                         time_text(F.col("window_end")).alias("end_time"), "car_count")


@query("""SELECT user_id, time_bucket(INTERVAL 6 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR AS window_end, count(*) AS n
FROM events GROUP BY ALL""")
def tumbling_count(spark: SparkSession, folder: str) -> DataFrame:
    return windows.windowed(views.events(spark, folder), "ts", "6 hours", None, ["user_id"],
                            {"n": count_rows()})


@query("""SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS window_start,
       time_bucket(INTERVAL 30 MINUTE, ts) + INTERVAL 30 MINUTE AS window_end, count(*) AS n
FROM events GROUP BY ALL""")
def tumbling_all(spark: SparkSession, folder: str) -> DataFrame:
    return windows.windowed(views.events(spark, folder), "ts", "30 minutes", None, [],
                            {"n": count_rows()})


@query(f"""WITH {S.sliding('events', 'ts', '10 MINUTE', 3)}
SELECT window_start, window_end, count(*) AS n FROM spread GROUP BY ALL""")
def sliding_all(spark: SparkSession, folder: str) -> DataFrame:
    return windows.windowed(views.events(spark, folder), "ts", "30 minutes", "10 minutes", [],
                            {"n": count_rows()})


@query(f"""WITH {S.OUT_OF_ORDER}
SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS window_start,
       time_bucket(INTERVAL 30 MINUTE, ts) + INTERVAL 30 MINUTE AS window_end, count(*) AS n,
       CAST(count(*) FILTER (event_time < ts - INTERVAL 3 HOUR) AS BIGINT) AS stale
FROM disordered GROUP BY ALL""")
def tumbling_arrival(spark: SparkSession, folder: str) -> DataFrame:
    """Windows by arrival time over all rows, and how many rows came three hours late."""
    stale = F.col("event_time") < F.col("ts") - F.expr("INTERVAL 3 HOURS")
    return windows.windowed(views.out_of_order(views.events(spark, folder)), "ts", "30 minutes", None,
                            [], {"n": count_rows(), "stale": count_rows(stale)})


@query(f"""WITH {S.OUT_OF_ORDER}, {S.sliding('disordered', 'ts', '6 HOUR', 2)}
SELECT guid, window_start, window_end, count(*) AS n FROM spread GROUP BY ALL""")
def sliding_count(spark: SparkSession, folder: str) -> DataFrame:
    """Windows by arrival time, whatever the event time says."""
    return windows.windowed(views.out_of_order(views.events(spark, folder)), "ts", "12 hours",
                            "6 hours", ["guid"], {"n": count_rows()})


@query(f"""WITH {S.OUT_OF_ORDER}, {S.sliding('disordered', 'event_time', '8 HOUR', 3)}
SELECT guid, window_start, window_end, CAST(sum(act_time) AS DOUBLE) / count(*) AS avg_act_time
FROM spread GROUP BY guid, window_start, window_end""")
def sliding_avg(spark: SparkSession, folder: str) -> DataFrame:
    return windows.windowed(views.out_of_order(views.events(spark, folder)), "event_time",
                            "24 hours", "8 hours", ["guid"],
                            {"s": total(F.col("act_time")), "c": count_rows()}).select(
        "guid", "window_start", "window_end", (F.col("s") / F.col("c")).alias("avg_act_time"))


@query(f"""WITH {S.BEHAVIOUR}, {S.sliding('behaviour', 'ts', '12 HOUR', 2)}
SELECT guid, window_start, window_end, event_id, act_time, arrival, CAST(rn AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY guid, window_start ORDER BY act_time DESC, arrival) AS rn
  FROM spread) WHERE rn <= 2""")
def top2_per_window(spark: SparkSession, folder: str) -> DataFrame:
    rows = windows.with_window(_behaviour(spark, folder), "ts", "24 hours", "12 hours").drop("ts")
    return topn.top_n(rows, ["guid", "window_start", "window_end"],
                      [F.desc("act_time"), F.col("arrival")], 2)


def _session_sql(keys: str, gap: str, source: str = "events") -> str:
    part = f"PARTITION BY {keys} " if keys else ""
    lead = f"{keys}, " if keys else ""
    return f"""SELECT {lead}min(ts) AS session_start, max(ts) + INTERVAL {gap} AS session_end,
       count(*) AS n, round(sum(value), 2) AS total
FROM (SELECT *, sum(opens) OVER ({part}ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session
      FROM (SELECT *, CASE WHEN ts - lag(ts) OVER ({part}ORDER BY ts, event_id) <= INTERVAL {gap}
                           THEN 0 ELSE 1 END AS opens FROM {source}))
GROUP BY {lead}session"""


def _sessions(spark: SparkSession, folder: str, gap: str, keys: list[str]) -> DataFrame:
    found = sessions.sessions(views.events(spark, folder), "ts", gap, keys,
                              {"n": count_rows(), "total": total(F.col("value"))})
    return found.withColumn("total", F.round("total", 2))


@query(_session_sql("", "10 MINUTE"))
def session_all(spark: SparkSession, folder: str) -> DataFrame:
    return _sessions(spark, folder, "10 minutes", [])


@query(_session_sql("user_id", "6 HOUR"))
def session_keyed(spark: SparkSession, folder: str) -> DataFrame:
    return _sessions(spark, folder, "6 hours", ["user_id"])


@query(f"""WITH {S.OUT_OF_ORDER}
SELECT min(event_time) AS session_start, max(event_time) + INTERVAL 5 MINUTE AS session_end,
       count(*) AS n, max(act_time) AS most
FROM (SELECT *, sum(opens) OVER (ORDER BY event_time, arrival ROWS UNBOUNDED PRECEDING) AS session
      FROM (SELECT *, CASE WHEN event_time - lag(event_time) OVER (ORDER BY event_time, arrival)
                                <= INTERVAL 5 MINUTE THEN 0 ELSE 1 END AS opens FROM disordered))
GROUP BY session""")
def session_disordered(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions by event time over rows that arrive out of order."""
    return sessions.sessions(views.out_of_order(views.events(spark, folder)), "event_time", "5 minutes",
                             [], {"n": count_rows(), "most": highest(F.col("act_time"))})


# --- count windows ----------------------------------------------------------

def _amounts(spark: SparkSession, folder: str) -> DataFrame:
    return views.events(spark, folder).select(
        "event_id", F.col("event_type").alias("key"), F.floor("value").cast("long").alias("n"))


AMOUNTS = "amounts AS (SELECT event_id, event_type AS key, CAST(floor(value) AS BIGINT) AS n FROM events)"


@query(f"""WITH {AMOUNTS}
SELECT CAST((rn - 1) // 3 AS BIGINT) AS window_no, key, CAST(sum(n) AS BIGINT) AS total
FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY event_id) AS rn FROM amounts)
GROUP BY 1, 2 HAVING count(*) = 3""")
def count_window_sum(spark: SparkSession, folder: str) -> DataFrame:
    return count_windows.count_tumbling(_amounts(spark, folder), ["key"], "event_id", 3,
                                        {"total": total(F.col("n"))})


@query(f"""WITH {AMOUNTS}
SELECT CAST((rn - 1) // 10 AS BIGINT) AS window_no, CAST(sum(n) AS BIGINT) AS total, max(n) AS most
FROM (SELECT *, row_number() OVER (ORDER BY event_id) AS rn FROM amounts)
GROUP BY 1 HAVING count(*) = 10""")
def count_window_all(spark: SparkSession, folder: str) -> DataFrame:
    return count_windows.count_tumbling(_amounts(spark, folder), [], "event_id", 10,
                                        {"total": total(F.col("n")), "most": highest(F.col("n"))})


@query(f"""WITH {AMOUNTS}
SELECT fired_at, n_rows, total FROM (
  SELECT row_number() OVER (ORDER BY event_id) AS fired_at,
         count(*) OVER last_ten AS n_rows, CAST(sum(n) OVER last_ten AS BIGINT) AS total
  FROM amounts WINDOW last_ten AS (ORDER BY event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
WHERE fired_at % 2 = 0""")
def count_sliding_all(spark: SparkSession, folder: str) -> DataFrame:
    return count_windows.count_sliding(_amounts(spark, folder), [], "event_id", 10, 2,
                                       {"n_rows": count_rows(), "total": total(F.col("n"))})


# --- lateness, triggers, eviction -------------------------------------------

def _marked(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.out_of_order(views.events(spark, folder))
    return late.mark_late(rows, "event_time", "arrival", "1 hour", delay="1 hour", lateness="2 hours")


@query(f"""WITH {S.LATE}
SELECT guid, window_start, window_end, count(*) AS f1, arg_min(event_id, arrival) AS first_event_id,
       min(arrival) AS first_arrival
FROM marked WHERE NOT is_late GROUP BY guid, window_start, window_end""")
def late_main(spark: SparkSession, folder: str) -> DataFrame:
    first = F.min_by(F.struct("event_id", "arrival"), F.col("arrival")).alias("first")
    kept = late.on_time(_marked(spark, folder)).withColumn("one", F.lit(1).cast("long"))
    return (kept.groupBy("guid", "window_start", "window_end").agg(F.sum("one").alias("f1"), first)
            .select("guid", "window_start", "window_end", "f1",
                    F.col("first.event_id").alias("first_event_id"),
                    F.col("first.arrival").alias("first_arrival")))


@query(f"""WITH {S.LATE}
SELECT guid, event_id, arrival, event_time, window_start, window_end FROM marked WHERE is_late""")
def late_side(spark: SparkSession, folder: str) -> DataFrame:
    return late.late_side(_marked(spark, folder)).drop("ts", "act_time")


@query(f"""WITH {S.LATE}, kept AS (
  SELECT *, count(*) OVER (PARTITION BY guid, window_start ORDER BY arrival) AS so_far
  FROM marked WHERE NOT is_late)
SELECT guid, arrival, window_start, window_end, so_far FROM kept WHERE is_refire""")
def late_refires(spark: SparkSession, folder: str) -> DataFrame:
    return (late.refires(_marked(spark, folder), ["guid"], "arrival")
            .select("guid", "arrival", "window_start", "window_end", "so_far"))


MARKER = f"""WITH {S.BEHAVIOUR}, w AS (
  SELECT *, time_bucket(INTERVAL 1 DAY, ts) AS window_start FROM behaviour), fires AS (
  SELECT a.guid, a.window_start, a.arrival AS fired_by, count(*) AS count
  FROM w a JOIN w b ON a.guid = b.guid AND a.window_start = b.window_start AND b.arrival <= a.arrival
  WHERE a.event_id = 'error' GROUP BY ALL
  UNION ALL SELECT guid, window_start, NULL, count(*) FROM w GROUP BY ALL)"""


@query(f"""{MARKER}
SELECT guid, window_start, window_start + INTERVAL 1 DAY AS window_end, fired_by, count,
       epoch_ms(window_start) || ':' || count || epoch_ms(window_start + INTERVAL 1 DAY) AS text
FROM fires""")
def trigger_on_marker(spark: SparkSession, folder: str) -> DataFrame:
    return triggers.fire_on_marker(_behaviour(spark, folder), ["guid"], "ts", "arrival", "1 day",
                                   F.col("event_id") == "error")


@query(f"""WITH {S.BEHAVIOUR}, w AS (
  SELECT *, time_bucket(INTERVAL 1 DAY, ts) AS window_start FROM behaviour), m AS (
  SELECT guid, window_start, max(ts) AS newest FROM w GROUP BY ALL)
SELECT guid, window_start, count(*) AS n, CAST(sum(act_time) AS BIGINT) AS total
FROM w JOIN m USING (guid, window_start) WHERE ts > newest - INTERVAL 6 HOUR GROUP BY ALL""")
def evict_time(spark: SparkSession, folder: str) -> DataFrame:
    kept = triggers.evict_older(_behaviour(spark, folder), ["guid"], "ts", "1 day", "6 hours")
    return kept.groupBy("guid", "window_start").agg(
        F.count(F.lit(1)).alias("n"), F.sum("act_time").alias("total"))


# --- traffic jobs -----------------------------------------------------------

@query(f"""WITH {S.SIGHTINGS}, {S.LIMITS}, {S.SPEEDING}
SELECT car, monitor_id, road_id, speed AS real_speed, lim AS limit_speed, action_time, arrival
FROM speeding""")
def overspeed(spark: SparkSession, folder: str) -> DataFrame:
    return traffic.speeding_records(_sightings(spark, folder), speed_limits(spark, folder), "arrival")


@query(f"""WITH {S.SIGHTINGS}, {S.sliding('sightings', 'action_time', '12 HOUR', 2)}, counts AS (
  SELECT window_start, window_end, area_id || '_' || road_id || '_' || monitor_id AS monitor,
         count(*) FILTER (speed >= 120) AS high_count,
         count(*) FILTER (speed >= 90 AND speed < 120) AS middle_count,
         count(*) FILTER (speed >= 60 AND speed < 90) AS normal_count,
         count(*) FILTER (speed < 60) AS low_count
  FROM spread GROUP BY ALL)
SELECT * EXCLUDE (rn), CAST(rn AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY high_count DESC, middle_count DESC,
    normal_count DESC, low_count DESC, monitor) AS rn FROM counts) WHERE rn <= 5""")
def top5_monitors(spark: SparkSession, folder: str) -> DataFrame:
    return traffic.busiest(traffic.band_counts(_sightings(spark, folder), "24 hours", "12 hours"))


@query(f"""WITH {S.OUT_OF_ORDER}, seen AS (
  SELECT CAST(guid AS VARCHAR) AS car, arrival, event_time,
         max(event_time) OVER (PARTITION BY guid ORDER BY arrival
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous
  FROM disordered)
SELECT car, arrival, '{traffic.CLONED_PLATE_TEXT}' AS violation,
       '{traffic.CLONED_PLATE_DETAIL[0]}' || car || '{traffic.CLONED_PLATE_DETAIL[1]}'
       || strftime(previous, '%Y-%m-%d %H:%M:%S') || '{traffic.CLONED_PLATE_DETAIL[2]}' || strftime(event_time, '%Y-%m-%d %H:%M:%S') AS detail
FROM seen WHERE abs(epoch_us(event_time) - epoch_us(previous)) < 3600000000""")
def cloned_plate(spark: SparkSession, folder: str) -> DataFrame:
    shifted = views.out_of_order(views.events(spark, folder)).select(
        F.col("guid").cast("string").alias("car"), "arrival", F.col("event_time").alias("action_time"))
    return traffic.cloned_plates(shifted, "1 hour")


@query(f"""WITH {S.SIGHTINGS}, {S.LIMITS}, {S.SPEEDING}, runs AS (
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
FROM runs WHERE t3 - t1 < INTERVAL 1 DAY""")
def danger_driver(spark: SparkSession, folder: str) -> DataFrame:
    return traffic.danger_drivers(_sightings(spark, folder), speed_limits(spark, folder), "1 day")
