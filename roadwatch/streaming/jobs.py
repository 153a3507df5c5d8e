"""The streaming form of the jobs. Each takes and returns a DataFrame, or runs
a writer per micro-batch where one stream feeds several outputs."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField

from ..functions.times import duration_micros, micros, millis
from ..operators.running import Agg
from ..operators.windows import with_window
from ..plans import traffic
from ..session import run_dir
from ..sources.jdbc import RefreshedTable
from .carried import Step, close_to_highest
from .processors import EvictingTrigger, MarkerTrigger, TextSoFar, ThreeInARow, TopOfWindow, keyed
from .run import Writer, batch_writer, fan_out, with_event_time


def average_speed(sightings: DataFrame, size: str, slide: str, delay: str) -> DataFrame:
    return traffic.average_speed(with_event_time(sightings, "action_time", delay), size, slide)


def band_counts(sightings: DataFrame, size: str, slide: str, delay: str) -> DataFrame:
    """In append mode a window's monitors all come in one batch, ready for ``busiest``."""
    return traffic.band_counts(with_event_time(sightings, "action_time", delay), size, slide)


def session_windows(events: DataFrame, time: str, gap: str, delay: str, keys: Sequence[str],
                    aggs: Mapping[str, Agg]) -> DataFrame:
    """Sessions per key in append mode. Streams need a key besides the window."""
    values = {name: f"__v_{name}" for name in aggs}
    rows = with_event_time(events, time, delay).withColumns(
        {values[n]: a.column for n, a in aggs.items()})
    grouped = rows.groupBy(*keys, F.session_window(time, gap).alias("__s")).agg(
        *[aggs[n].fold(c).alias(c) for n, c in values.items()])
    return grouped.select(*keys, F.col("__s.start").alias("session_start"),
                          F.col("__s.end").alias("session_end"),
                          *[aggs[n].result(F.col(c)).alias(n) for n, c in values.items()])


def arrival_counts(events: DataFrame, size: str, slide: str | None = None) -> DataFrame:
    """Processing-time windows: counted by the time the micro-batch runs."""
    now = events.withColumn("__now", F.current_timestamp())
    window = F.window("__now", size, slide) if slide else F.window("__now", size)
    return now.groupBy(window.alias("__w")).agg(F.count(F.lit(1)).alias("n")).select(
        F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"), "n")


def window_join(left: DataFrame, right: DataFrame, keys: Sequence[str], time: str, size: str,
                delay: str) -> DataFrame:
    """Stream-stream join on key and window; the window bounds the join state."""
    def side(df: DataFrame) -> DataFrame:
        return with_event_time(df, time, delay).withColumn("__w", F.window(time, size)).drop(time)
    joined = side(left).join(side(right), [*keys, "__w"])
    return joined.withColumns({"window_start": F.col("__w.start"),
                               "window_end": F.col("__w.end")}).drop("__w")


def window_join_counts(left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str], time: str,
                       size: str, delay: str, copies: str = "copies") -> DataFrame:
    """``window_join`` with equal right rows of a key and window folded into one, and how many they were.

    The right side is counted first and joins when its window has ended, so neither state nor
    output holds the pairs of a hot group one by one. Columns besides the keys must differ in name.
    """
    window = F.window(time, size).alias("__w")
    rows = with_event_time(left, time, delay).withColumn("__w", F.window(time, size)).drop(time)
    counted = (with_event_time(right, time, delay).groupBy(window, *keys, *values)
               .agg(F.count(F.lit(1)).alias(copies)))
    joined = rows.join(counted, [*keys, "__w"])
    return joined.withColumns({"window_start": F.col("__w.start"), "window_end": F.col("__w.end")}).drop("__w")


def speeding_with_refresh(limits: RefreshedTable, write: Writer) -> Writer:
    """Each micro-batch against the limits that are valid when it runs."""
    def run(batch: DataFrame, batch_id: int) -> None:
        write(traffic.speeding_records(batch, limits.get(), "arrival"), batch_id)
    return run


def _field(df: DataFrame, name: str) -> StructField:
    return StructField(name, df.schema[name].dataType)


def text_so_far(rows: DataFrame, key: str, order: str, value: str, out: str = "joined",
                ttl_ms: int | None = None) -> DataFrame:
    """Texts per key; with ``ttl_ms`` each is forgotten that long after it came."""
    processor = TextSoFar([_field(rows, key)], _field(rows, order), value, out, ttl_ms)
    return keyed(rows.select(key, order, value), [key], processor,
                 "processingTime" if ttl_ms else "none", "update" if ttl_ms else "append")


def cloned_plates(within: str) -> Step:
    """For ``carried``: sightings too close in time to the latest one of the same plate."""
    return close_to_highest(["car"], "action_time", "arrival", within)


def danger_drivers(sightings: DataFrame, limits: DataFrame, within: str, delay: str) -> DataFrame:
    fast = traffic.speeding(with_event_time(sightings, "action_time", delay), limits)
    shaped = fast.select("car", "action_time", "arrival", "monitor_id",
                         micros(F.col("action_time")).alias("time_us"))
    carry = [_field(shaped, "arrival"), _field(shaped, "monitor_id")]
    processor = ThreeInARow([_field(shaped, "car")], "time_us", carry, duration_micros(within))
    flat = keyed(shaped, ["car"], processor, "eventTime")
    runs = flat.select("car", *[
        F.struct(*[F.col(f"{place}_{c}").alias(c) for c in ("time_us", "arrival", "monitor_id")])
        .alias(place) for place in ("first", "second", "third")])
    return runs.select("car", F.col("first.arrival").alias("first_arrival"),
                       F.col("second.arrival").alias("second_arrival"),
                       F.col("third.arrival").alias("third_arrival"),
                       F.lit(traffic.DANGER_TEXT).alias("violation"),
                       traffic.danger_detail().alias("detail"))


def _window_keyed(events: DataFrame, time: str, size: str, slide: str | None, delay: str) -> DataFrame:
    """Rows with their windows, behind a watermark that keeps all rows of open windows."""
    lag = f"{duration_micros(delay) + duration_micros(size)} microseconds"
    rows = with_window(with_event_time(events, time, lag), time, size, slide)
    return rows.withColumn("window_start_ms", millis(F.col("window_start")))


def _window_bounds(df: DataFrame, size: str) -> DataFrame:
    size_ms = duration_micros(size) // 1000
    return df.withColumns({
        "window_start": F.timestamp_millis("window_start_ms"),
        "window_end": F.timestamp_millis(F.col("window_start_ms") + size_ms),
    }).drop("window_start_ms")


def fire_on_marker(events: DataFrame, time: str, size: str, marker: Column, delay: str,
                   key: str = "guid", order: str = "arrival") -> DataFrame:
    rows = _window_keyed(events, time, size, None, delay).withColumn("is_marker", marker)
    processor = MarkerTrigger([_field(rows, key)], _field(rows, order), "is_marker")
    fired = keyed(rows.select(key, "window_start_ms", order, "is_marker", time),
                  [key, "window_start_ms"], processor, "eventTime")
    return _window_bounds(fired, size)


def fire_on_marker_evicting(events: DataFrame, time: str, size: str, keep: str, marker: Column, delay: str,
                            value: str, key: str = "guid", order: str = "arrival") -> DataFrame:
    """Like ``fire_on_marker``, over the window's rows newer than its newest so far minus ``keep``."""
    rows = _window_keyed(events, time, size, None, delay).withColumns(
        {"is_marker": marker, "time_us": micros(F.col(time)), "evict_value": F.col(value).cast("long")})
    processor = EvictingTrigger([_field(rows, key)], _field(rows, order), "is_marker", "time_us", "evict_value",
                                duration_micros(keep))
    fired = keyed(rows.select(key, "window_start_ms", order, "is_marker", "time_us", "evict_value", time),
                  [key, "window_start_ms"], processor, "eventTime")
    return _window_bounds(fired, size)


def top_per_window(events: DataFrame, time: str, size: str, slide: str, n: int, delay: str,
                   key: str = "guid", measure: str = "act_time", order: str = "arrival",
                   carry: Sequence[str] = ("event_id",)) -> DataFrame:
    rows = _window_keyed(events, time, size, slide, delay)
    processor = TopOfWindow([_field(rows, key)], _field(rows, measure), _field(rows, order),
                            [_field(rows, c) for c in carry], n)
    best = keyed(rows.select(key, "window_start_ms", measure, order, *carry, time),
                 [key, "window_start_ms"], processor, "eventTime")
    return _window_bounds(best, size)


def route_writer(rules: Callable[[DataFrame], DataFrame], folder: str, names: Sequence[str],
                 column: str = "route") -> Writer:
    """Side outputs, one folder each."""
    def split(batch: DataFrame) -> dict[str, DataFrame]:
        routed = rules(batch)
        return {n: routed.where(F.col(column) == n).drop(column) for n in names}
    return fan_out({n: batch_writer(f"{folder}/{n}") for n in names}, split)


def late_splitter(time: str, size: str, *, delay: str, lateness: str, folder: str) -> Writer:
    """Late rows aside, rows without a time to ``no_time``, the others to the main output,
    exactly once each.

    It works on the stream before any watermark, since rows behind Spark's
    watermark are gone. A row is late against the highest time of the earlier
    batches. That time is kept per batch; a batch that runs again reads the
    state its predecessor left and so splits the same way.
    """
    def highest_before(batch: DataFrame, batch_id: int) -> int | None:
        if batch_id == 0:
            return None
        spark = batch.sparkSession
        return spark.read.schema("highest long").parquet(
            f"{folder}/highest/batch_id={batch_id - 1}").first()[0]

    def write(batch: DataFrame, batch_id: int) -> None:
        before = highest_before(batch, batch_id)
        batch.persist()
        try:
            rows = with_window(batch, time, size)
            limit = None if before is None else before - duration_micros(delay)
            late = F.lit(False) if limit is None else (
                micros(F.col("window_end")) + duration_micros(lateness) <= F.lit(limit))
            parts = {"late": rows.where(late), "main": rows.where(~late),
                     "no_time": batch.where(F.col(time).isNull())}
            for name, part in parts.items():
                part.write.mode("overwrite").parquet(
                    f"{folder}/{name}/batch_id={batch_id}")
            highest = batch.agg(F.max(micros(F.col(time))).alias("highest")).select(
                F.greatest("highest", F.lit(before).cast("long")).alias("highest"))
            highest.write.mode("overwrite").parquet(f"{folder}/highest/batch_id={batch_id}")
        finally:
            batch.unpersist()
    return write


def new_folder(stream: DataFrame, name: str) -> str:
    return run_dir(stream.sparkSession, name)
