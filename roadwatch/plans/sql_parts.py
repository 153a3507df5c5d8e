"""SQL of the record views, shared by the queries' SQL statements."""

SIGHTINGS = """sightings AS (
  SELECT lpad(CAST(user_id % 8 AS VARCHAR), 2, '0') AS area_id, event_type AS road_id,
         lpad(CAST(event_id % 20 AS VARCHAR), 4, '0') AS monitor_id,
         lpad(CAST(event_id % 20 AS VARCHAR), 4, '0') AS camera_id,
         ts AS action_time, CAST(user_id AS VARCHAR) AS car, value AS speed,
         event_id AS arrival
  FROM events)"""

LIMITS = """limits AS (
  SELECT DISTINCT area_id, road_id, monitor_id,
         CAST(30 + 10 * (CAST(monitor_id AS INTEGER) % 5) AS DOUBLE) AS speed_limit
  FROM sightings WHERE road_id <> 'signup')"""

SPEEDING = """speeding AS (
  SELECT * FROM (
    SELECT s.*, coalesce(l.speed_limit, 60.0::DOUBLE) AS lim
    FROM sightings s LEFT JOIN limits l USING (area_id, road_id, monitor_id)) x
  WHERE speed > lim * 1.2::DOUBLE)"""

BEHAVIOUR = """behaviour AS (
  SELECT user_id AS guid, event_type AS event_id, ts,
         CAST(floor(value) AS INTEGER) AS act_time, event_id AS arrival
  FROM events)"""

OUT_OF_ORDER = BEHAVIOUR + """, disordered AS (
  SELECT *, ts - ((arrival * 7919) % 37) * INTERVAL 10 MINUTE AS event_time FROM behaviour)"""

# The cuts of a replayed table, see sources.files.replayed.
CUTS = """cuts AS (SELECT max(event_id) // greatest(6, max(event_id) // 1000000) + 1 AS width FROM events)"""

# What the earlier cuts' highest time was, per cut.
SEEN_BEFORE = OUT_OF_ORDER + ", " + CUTS + """, seen_before AS (
  SELECT cut, max(highest) OVER (ORDER BY cut ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
  FROM (SELECT arrival // width AS cut, max(event_time) AS highest FROM disordered, cuts GROUP BY ALL)),
arrived AS (
  SELECT d.*, s.seen FROM disordered d, cuts JOIN seen_before s ON s.cut = d.arrival // cuts.width)"""

COUNTED = """counted AS (
  SELECT user_id AS id, event_type AS event_id, CAST(floor(value) AS INTEGER) % 10 AS cnt,
         ts, event_id AS arrival
  FROM events)"""

PERSONS_SEEN = """persons_seen AS (
  SELECT user_id AS id, CASE WHEN c_custkey % 2 = 0 THEN 'f' ELSE 'm' END AS gender,
         c_mktsegment AS city, ts
  FROM events JOIN customer ON user_id = c_custkey WHERE event_type = 'signup')"""

JOINED = COUNTED + ", " + PERSONS_SEEN + """, joined AS (
  SELECT c.id, c.event_id, c.cnt, p.gender, p.city, c.arrival,
         time_bucket(INTERVAL 1 HOUR, c.ts) AS window_start, count(*) AS copies
  FROM counted c JOIN persons_seen p
    ON c.id = p.id AND time_bucket(INTERVAL 1 HOUR, c.ts) = time_bucket(INTERVAL 1 HOUR, p.ts)
  GROUP BY ALL)"""

LATE = OUT_OF_ORDER + """, watermarked AS (
  SELECT *, time_bucket(INTERVAL 1 HOUR, event_time) AS window_start,
         time_bucket(INTERVAL 1 HOUR, event_time) + INTERVAL 1 HOUR AS window_end,
         max(event_time) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
           - INTERVAL 1 HOUR AS wm
  FROM disordered), marked AS (
  SELECT *, coalesce(window_end + INTERVAL 2 HOUR <= wm, false) AS is_late,
         coalesce(window_end <= wm AND window_end + INTERVAL 2 HOUR > wm, false) AS is_refire
  FROM watermarked)"""


def sliding(source: str, time: str, slide: str, windows: int) -> str:
    """Each row once per sliding window it lies in: ``windows`` = size / slide."""
    return f"""spread AS (
  SELECT s.*, time_bucket(INTERVAL {slide}, {time}) - k * INTERVAL {slide} AS window_start,
         time_bucket(INTERVAL {slide}, {time}) + ({windows} - k) * INTERVAL {slide} AS window_end
  FROM {source} s, (SELECT unnest(generate_series(0, {windows - 1})) AS k) g)"""
