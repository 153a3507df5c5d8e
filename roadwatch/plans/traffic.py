"""The traffic jobs: average speed, speeding, busiest monitors, cloned plates,
dangerous driving. Each takes sightings and serves batch and, where it has no
ordered step, streams as well."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.parse import accepted, parse_delimited
from ..functions.times import from_micros, millis, time_text
from ..operators.joins import lookup
from ..operators.patterns import three_in_a_row, too_close
from ..operators.project import composite_key
from ..operators.running import Agg, count_rows, total
from ..operators.topn import top_n
from ..operators.windows import windowed
from ..schemas import SIGHTING, SPEEDING_RECORD

# Rules and texts of the jobs.
DEFAULT_LIMIT = 60.0
TOLERANCE = 1.2
HIGH_SPEED = 120
MIDDLE_SPEED = 90
NORMAL_SPEED = 60
TOP_MONITORS = 5
CLONED_PLATE_WITHIN = "10 seconds"
DANGER_WITHIN = "5 minutes"
WINDOW_SIZE = "5 minutes"
WINDOW_SLIDE = "1 minute"
CLONED_PLATE_TEXT = "涉嫌套牌"
CLONED_PLATE_DETAIL = ["车辆", "通过上一次卡扣时间", "本次通过时间"]
DANGER_TEXT = "涉嫌危险驾驶"
DANGER_LABELS = {"first": " first:", "second": " second:", "third": " third:"}

MONITOR = ["area_id", "road_id", "monitor_id"]


def sightings_from_lines(lines: DataFrame) -> DataFrame:
    """TAB lines, as a topic or file holds them, to sightings with a real time."""
    parsed = parse_delimited(lines, SIGHTING, "\t")
    return accepted(parsed, "value").withColumn("action_time", F.timestamp_millis("action_time"))


def average_speed(sightings: DataFrame, size: str = WINDOW_SIZE, slide: str = WINDOW_SLIDE,
                  time: str = "action_time") -> DataFrame:
    """Average speed and number of cars per monitor and sliding window."""
    sums = windowed(sightings, time, size, slide, MONITOR,
                    {"speed_sum": total(F.col("speed")), "car_count": count_rows()})
    return sums.select("window_start", "window_end", *MONITOR,
                       (F.col("speed_sum") / F.col("car_count")).alias("avg_speed"), "car_count")


def with_limit(sightings: DataFrame, limits: DataFrame) -> DataFrame:
    """Each sighting with its monitor's limit, or the default one."""
    return lookup(sightings, limits, MONITOR).withColumn(
        "speed_limit", F.coalesce("speed_limit", F.lit(DEFAULT_LIMIT)))


def speeding(sightings: DataFrame, limits: DataFrame) -> DataFrame:
    return with_limit(sightings, limits).where(
        F.col("speed") > F.col("speed_limit") * TOLERANCE)


def speeding_records(sightings: DataFrame, limits: DataFrame, *extra: str) -> DataFrame:
    return speeding(sightings, limits).select(
        "car", "monitor_id", "road_id", F.col("speed").alias("real_speed"),
        F.col("speed_limit").alias("limit_speed"), "action_time", *extra)


def sink_record(records: DataFrame, *extra: str) -> DataFrame:
    """Speeding records as their table has them: six columns, the time in epoch milliseconds.

    ``extra`` are columns that the caller's table has besides, such as a key.
    """
    typed = [F.col(f.name).cast(f.dataType).alias(f.name)
             for f in SPEEDING_RECORD.fields if f.name != "action_time"]
    return records.select(*typed, millis(F.col("action_time")).alias("action_time"), *extra)


def speed_bands(speed: Column) -> dict[str, Agg]:
    """How many cars per band, highest band first."""
    band = (F.when(speed >= HIGH_SPEED, "high_count").when(speed >= MIDDLE_SPEED, "middle_count")
            .when(speed >= NORMAL_SPEED, "normal_count").otherwise("low_count"))
    return {name: count_rows(band == name) for name in BANDS}


BANDS = ["high_count", "middle_count", "normal_count", "low_count"]


def band_counts(sightings: DataFrame, size: str = WINDOW_SIZE, slide: str = WINDOW_SLIDE,
                time: str = "action_time") -> DataFrame:
    return windowed(sightings, time, size, slide, MONITOR, speed_bands(F.col("speed")))


def busiest(counts: DataFrame, n: int = TOP_MONITORS) -> DataFrame:
    """The monitors of each window with the most fast cars."""
    keyed = counts.select("window_start", "window_end", composite_key(*MONITOR).alias("monitor"),
                          *BANDS)
    return top_n(keyed, ["window_start", "window_end"],
                 [*[F.desc(b) for b in BANDS], F.col("monitor")], n)


def cloned_plates(sightings: DataFrame, within: str = CLONED_PLATE_WITHIN, *,
                  width: int | None = None) -> DataFrame:
    """Sightings too close in time to the latest one of the same plate."""
    hits = too_close(sightings, ["car"], "action_time", "arrival", within, width=width)
    previous, now = (time_text(from_micros(F.col(c))) for c in ("previous_us", "time_us"))
    of_car, earlier, this_time = map(F.lit, CLONED_PLATE_DETAIL)
    detail = F.concat(of_car, "car", earlier, previous, this_time, now)
    return hits.select("car", "arrival", F.lit(CLONED_PLATE_TEXT).alias("violation"),
                       detail.alias("detail"))


def danger_detail() -> Column:
    parts: list = [F.col("car")]
    for place, label in DANGER_LABELS.items():
        parts += [F.lit(label), F.col(f"{place}.monitor_id"),
                  F.floor(F.col(f"{place}.time_us") / 1000).cast("string")]
    return F.concat(*parts)


def danger_drivers(sightings: DataFrame, limits: DataFrame, within: str = DANGER_WITHIN) -> DataFrame:
    """Cars seen speeding three times within ``within``."""
    runs = three_in_a_row(speeding(sightings, limits), ["car"], "action_time", "arrival",
                          within, ["arrival", "monitor_id"])
    return runs.select(
        "car", F.col("first.arrival").alias("first_arrival"),
        F.col("second.arrival").alias("second_arrival"),
        F.col("third.arrival").alias("third_arrival"),
        F.lit(DANGER_TEXT).alias("violation"), danger_detail().alias("detail"))
