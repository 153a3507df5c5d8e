"""Streams replayed file by file: one file is one micro-batch."""

import datetime as dt
import os
import time

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from roadwatch import schemas
from roadwatch.functions.parse import accepted, parse_delimited
from roadwatch.operators import late, route, sessions, topn, triggers, windows
from roadwatch.operators.running import count_rows, highest
from roadwatch.plans import traffic, views
from roadwatch.session import run_dir
from roadwatch.sources import console, files, jdbc
from roadwatch.sources.files import stream_folder, stream_lines
from roadwatch.sources.files import replayed
from roadwatch.streaming import carried, jobs
from roadwatch.streaming.carried import carried_table, carried_writer
from roadwatch.streaming.run import (
    batch_writer, fan_out, final_rows, finish, start, to_table, with_event_time,
)

EPOCH = dt.datetime(2024, 1, 1)
EVENT = "guid long, event_id string, ts timestamp_ntz, act_time int, arrival long"

# Batches of (guid, event, second).
BATCHES = [
    [(1, "a", 1), (1, "ex", 5)], [(1, "a", 12)], [(1, "a", 6)], [(1, "a", 14)],
    [(1, "late", 7)], [(1, "z", 60)],
]


class Replay:
    """A folder that gets one text file per micro-batch."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.files, self.arrival = spark, str(folder), 0, 0
        os.makedirs(self.folder, exist_ok=True)

    def add(self, *batches):
        for batch in batches:
            path = f"{self.folder}/{self.files:04d}.csv"
            with open(path, "w") as out:
                for guid, event, second in batch:
                    at = (EPOCH + dt.timedelta(seconds=second)).isoformat()
                    out.write(f"{guid},{event},{at},{second % 10},{self.arrival}\n")
                    self.arrival += 1
            os.utime(path, (1_700_000_000 + self.files * 10,) * 2)
            self.files += 1
        return self

    def stream(self, per_batch=1):
        return stream_folder(self.spark, self.folder, EVENT, "csv", per_batch)

    def table(self):
        return self.spark.read.schema(EVENT).csv(self.folder)


@pytest.fixture
def replay(spark, tmp_path):
    return Replay(spark, tmp_path / "in")


def second(value):
    return int((value - EPOCH).total_seconds())


def test_text_source_parses_and_rejects(spark, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    (folder / "a.txt").write_text("u,p,5\nbroken\nu,q,6\n")
    parsed = parse_delimited(stream_lines(spark, str(folder)), schemas.CLICK, ",")
    rows = to_table(accepted(parsed, "value"), "text")
    assert sorted(r["page"] for r in rows.collect()) == ["p", "q"]


def test_empty_input_gives_an_empty_table(replay):
    counts = to_table(replay.stream(), "empty", per_batch=lambda b: b.groupBy("guid").count())
    assert counts.columns == ["guid", "count", "batch_id"] and counts.count() == 0


def test_watermarked_windows_keep_rows_within_the_delay(replay):
    stream = with_event_time(replay.add(*BATCHES).stream(), "ts", "0 seconds")
    counts = windows.windowed(stream, "ts", "10 seconds", None, ["guid"], {"n": count_rows()})
    written = to_table(counts, "watermark")
    # Row :06 came one batch after :12 and still counts; :07 came later and is dropped.
    assert sorted((second(r["window_start"]), r["n"]) for r in written.collect()) == [(0, 3), (10, 2)]


def test_lateness_as_a_longer_delay_refires_in_update_mode(replay):
    stream = with_event_time(replay.add(*BATCHES).stream(), "ts", "10 seconds")
    counts = windows.windowed(stream, "ts", "10 seconds", None, ["guid"], {"n": count_rows()})
    written = to_table(counts, "lateness", "update")
    first = [r["n"] for r in written.orderBy("batch_id").collect() if second(r["window_start"]) == 0]
    assert first == [2, 3, 4], "the window is reported again for each late row"
    final = final_rows(written, ["guid", "window_start", "window_end"])
    assert sorted(r["n"] for r in final.collect()) == [1, 2, 4]


def test_restart_from_the_checkpoint(spark, replay):
    def run(folder):
        stream = with_event_time(replay.stream(), "ts", "0 seconds")
        return to_table(windows.windowed(stream, "ts", "10 seconds", None, ["guid"],
                                         {"n": count_rows()}), "restart", folder=folder)

    folder = run_dir(spark, "restart")
    replay.add([(1, "a", 1), (2, "a", 2)])
    run(folder)
    replay.add([(1, "a", 3)], [(1, "z", 60)])
    assert sorted((r["guid"], r["n"]) for r in run(folder).collect()) == [(1, 2), (2, 1)]


def late_output(replay, folder, **how):
    writer = jobs.late_splitter("ts", "10 seconds", delay="0 seconds", lateness="3 seconds", folder=folder)
    finish(start(replay.stream(**how), writer, f"{folder}/checkpoint"))
    read = replay.spark.read
    return (sorted(r["arrival"] for r in read.parquet(f"{folder}/main").collect()),
            sorted(r["arrival"] for r in read.parquet(f"{folder}/late").collect()))


def test_late_split_one_row_per_batch_is_the_batch_definition(spark, replay):
    rows = [(1, "a", s) for s in (1, 12, 6, 13, 7, 30, 9, 31, 19, 24)]
    replay.add(*[[r] for r in rows])
    main, aside = late_output(replay, run_dir(spark, "late"))
    marked = late.mark_late(replay.table(), "ts", "arrival", "10 seconds", delay="0 seconds",
                            lateness="3 seconds", width=3)
    assert aside == sorted(r["arrival"] for r in late.late_side(marked).collect()) == [4, 6, 8]
    assert main == sorted(set(range(len(rows))) - set(aside))


def test_late_split_after_a_restart_and_a_replayed_batch(spark, replay):
    folder = run_dir(spark, "late")
    replay.add(*BATCHES[:4])
    late_output(replay, folder)
    replay.add(*BATCHES[4:])
    main, aside = late_output(replay, folder)
    assert sorted(main + aside) == list(range(7)) and aside == [5]
    # The last batch again, as after a crash between its writes and its commit.
    writer = jobs.late_splitter("ts", "10 seconds", delay="0 seconds", lateness="3 seconds", folder=folder)
    again = replay.table().where("arrival = 5")
    writer(again, 4)
    writer(again, 4)
    assert sorted(r["arrival"] for r in spark.read.parquet(f"{folder}/late").collect()) == [5]


def test_routes_to_several_sinks(spark, replay):
    replay.add([(1, "apple", 1), (1, "bob", 2)], [(1, "xyz", 3), (1, "Abba", 4)])
    folder = run_dir(spark, "routes")
    writer = jobs.route_writer(lambda b: route.route(b, route.letter_rules("event_id")), folder,
                               ["a", "b", "main"])
    finish(start(replay.stream(), writer, f"{folder}/checkpoint"))
    found = {n: sorted(r["event_id"] for r in spark.read.parquet(f"{folder}/{n}").collect())
             for n in ("a", "b", "main")}
    assert found == {"a": ["Abba", "apple"], "b": ["bob"], "main": ["xyz"]}


def test_fan_out_releases_the_batch_when_a_sink_fails(spark):
    batch = spark.range(3)

    def broken(rows, batch_id):
        raise RuntimeError("sink down")

    with pytest.raises(RuntimeError):
        fan_out({"x": broken}, lambda b: {"x": b})(batch, 0)
    assert not batch.is_cached


def test_sessions(replay):
    replay.add([(1, "a", 0), (2, "a", 0)], [(1, "a", 30)], [(1, "a", 61)], [(2, "z", 300)])
    found = to_table(jobs.session_windows(
        replay.stream(), "ts", "30 seconds", "0 seconds", ["guid"],
        {"n": count_rows(), "most": highest(F.col("arrival"))}), "sessions")
    assert sorted((r["guid"], second(r["session_start"]), r["n"], r["most"]) for r in found.collect()) == [
        (1, 0, 2, 2), (1, 61, 1, 3), (2, 0, 1, 1)]


def test_window_join(replay, spark, tmp_path):
    replay.add([(1, "a", 1), (2, "a", 3)], [(1, "a", 12)], [(1, "z", 60)])
    other = Replay(spark, tmp_path / "other").add([(1, "b", 4), (1, "b", 5)], [(1, "b", 21)], [(1, "z", 90)])
    left = replay.stream().select("guid", "ts", F.col("arrival").alias("l"))
    right = other.stream().select("guid", "ts", F.col("arrival").alias("r"))
    found = to_table(jobs.window_join(left, right, ["guid"], "ts", "10 seconds", "0 seconds"), "join")
    assert sorted((r["l"], r["r"], second(r["window_start"])) for r in found.collect()) == [
        (0, 0, 0), (0, 1, 0)]


def test_processing_time_windows(replay):
    replay.add([(1, "a", 1)], [(1, "a", 500)])
    written = to_table(jobs.arrival_counts(replay.stream(), "1 day", None), "arrival", "update")
    assert final_rows(written, ["window_start", "window_end"]).agg(F.sum("n")).first()[0] == 2


# --- keyed state ------------------------------------------------------------

def test_count_window_across_batches_and_restart(spark, replay):
    def run(folder):
        amounts = replay.stream().select(F.col("event_id").alias("key"), F.col("arrival").alias("event_id"),
                                         F.col("act_time").cast("long").alias("n"))
        return carried_table(amounts, "count", carried.count_windows("key", "event_id", "n", 3), folder)

    folder = run_dir(spark, "count")
    replay.add([(1, "a", 1), (1, "a", 2)], [(1, "b", 9)])
    assert run(folder).count() == 0
    replay.add([(1, "a", 3), (1, "a", 4)], [(1, "b", 1), (1, "b", 1)])
    assert sorted((r["key"], r["window_no"], r["total"]) for r in run(folder).collect()) == [
        ("a", 0, 6), ("b", 0, 11)]


def test_text_so_far(replay):
    replay.add([(1, "x", 1), (2, "p", 1)], [(1, "y", 2), (1, "z", 3)])
    found = to_table(jobs.text_so_far(replay.stream(), "guid", "arrival", "event_id"), "text")
    assert {r["arrival"]: r["joined"] for r in found.collect()} == {0: "x", 1: "p", 2: "xy", 3: "xyz"}


def test_state_kinds(replay):
    replay.add([(1, "a", 10), (1, "b", 20)], [(1, "a", 3)], [(1, "a", 4)])
    rows = replay.stream().select(F.col("guid").alias("key"), "arrival", F.col("event_id").alias("kind"),
                                  F.second("ts").cast("long").alias("n"))
    step = carried.state_kinds("key", "arrival", "kind", "n")
    found = {r["arrival"]: r for r in carried_table(rows, "kinds", step).collect()}
    assert [found[i]["total"] for i in range(4)] == [10, 30, 33, 37]
    assert found[1]["average"] == 15.0, "the average of 10 and 20"
    assert [found[i]["of_kind"] for i in range(4)] == [1, 1, 2, 3]
    assert [found[i]["kinds"] for i in range(4)] == [1, 2, 2, 2]
    assert found[3]["last_three"] == "20,3,4"


def test_texts_expire(spark, replay):
    """Processing-time expiry: what came more than the time to live ago is gone."""
    folder = run_dir(spark, "ttl")
    texts = jobs.text_so_far(replay.stream(), "guid", "arrival", "event_id", ttl_ms=4000)
    query = start(texts, batch_writer(f"{folder}/out"), f"{folder}/checkpoint", "update",
                  processingTime="100 milliseconds")
    try:
        def wait_for(arrival):
            for _ in range(300):
                if os.path.isdir(f"{folder}/out"):
                    rows = spark.read.schema("guid long, arrival long, joined string").parquet(f"{folder}/out")
                    hit = rows.where(F.col("arrival") == arrival).collect()
                    if hit:
                        return hit[0]["joined"]
                assert query.isActive, query.exception()
                time.sleep(0.1)
            raise TimeoutError

        replay.add([(1, "old", 1)])
        assert wait_for(0) == "old"
        time.sleep(5)
        replay.add([(1, "new", 2)])
        assert wait_for(1) == "new"
    finally:
        query.stop()


def test_cloned_plates_equal_the_batch_form(replay):
    replay.add([(1, "a", 0), (1, "a", 10), (2, "a", 3)], [(1, "a", 5), (2, "a", 12)], [(1, "a", 19)])
    def shape(df):
        return df.select(F.col("guid").cast("string").alias("car"), "arrival", F.col("ts").alias("action_time"))
    streamed = carried_table(shape(replay.stream()), "plates", jobs.cloned_plates("10 seconds"))
    batch = traffic.cloned_plates(shape(replay.table()), "10 seconds", width=2)
    assert (sorted(r["arrival"] for r in streamed.collect())
            == sorted(r["arrival"] for r in batch.collect()) == [3, 4, 5])


def sightings(df):
    return df.select(F.lit("01").alias("area_id"), F.lit("r").alias("road_id"),
                     F.lit("0001").alias("monitor_id"), F.col("ts").alias("action_time"),
                     F.col("guid").cast("string").alias("car"),
                     F.when(F.col("event_id") == "slow", 10.0).otherwise(200.0).alias("speed"), "arrival")


def test_danger_drivers_in_event_time_order_across_batches(spark, replay):
    replay.add([(1, "fast", 10), (1, "slow", 11)], [(1, "fast", 5), (2, "fast", 6)],
               [(1, "fast", 14), (2, "fast", 16), (1, "fast", 8)], [(1, "fast", 18), (2, "fast", 17)],
               [(3, "slow", 200)])
    none = spark.createDataFrame([], schemas.SPEED_LIMIT)
    streamed = to_table(jobs.danger_drivers(sightings(replay.stream()), none, "10 seconds", "20 seconds"),
                        "danger")
    batch = traffic.danger_drivers(sightings(replay.table()), none, "10 seconds")
    columns = ["car", "first_arrival", "second_arrival", "third_arrival", "detail"]
    got = sorted(tuple(r[c] for c in columns) for r in streamed.collect())
    assert got == sorted(tuple(r[c] for c in columns) for r in batch.collect())
    assert [g[:4] for g in got] == [("1", 0, 4, 7), ("1", 2, 6, 0), ("1", 6, 0, 4)]


def test_marker_trigger(replay):
    replay.add([(1, "a", 1), (1, "ex", 5), (1, "a", 6)], [(1, "ex", 8), (2, "a", 9)], [(3, "z", 60)])
    fired = to_table(jobs.fire_on_marker(replay.stream(), "ts", "10 seconds",
                                         F.col("event_id") == "ex", "0 seconds"), "marker")
    assert sorted((r["guid"], -1 if r["fired_by"] is None else r["fired_by"], r["count"])
                  for r in fired.collect()) == [(1, -1, 4), (1, 1, 2), (1, 3, 4), (2, -1, 1)]


def test_top_two_per_window(replay):
    replay.add([(1, "a", 1), (1, "b", 4)], [(1, "c", 4), (1, "d", 3), (2, "e", 2)], [(3, "z", 60)])
    best = to_table(jobs.top_per_window(replay.stream(), "ts", "10 seconds", "10 seconds", 2, "0 seconds"),
                    "top2")
    assert sorted((r["guid"], r["rank"], r["event_id"]) for r in best.collect()) == [
        (1, 1, "b"), (1, 2, "c"), (2, 1, "e")]


def test_busiest_monitors_per_finished_window(replay):
    replay.add([(1, "fast", 1), (1, "slow", 2)], [(1, "slow", 61)], [(1, "slow", 500)])
    counts = jobs.band_counts(sightings(replay.stream()), "1 minute", "1 minute", "0 seconds")
    found = to_table(counts, "busiest", per_batch=traffic.busiest)
    assert sorted((second(r["window_start"]), r["high_count"], r["low_count"], r["rank"])
                  for r in found.collect()) == [(0, 1, 1, 1), (60, 0, 1, 1)]


def test_jobs_from_text_lines(spark, tmp_path):
    """The jobs as they run on a topic's lines; a bad line is left out."""
    folder = tmp_path / "lines"
    folder.mkdir()
    base = 1_704_067_200_000
    rows = [f"01\tr\t0001\tc\t{base + s * 1000}\tcar\t{v}" for s, v in ((1, 80), (4, 100), (70, 60))]
    (folder / "a.txt").write_text("\n".join([*rows, "bad line", f"01\tr\t0001\tc\t{base + 900_000}\tz\t1"]))
    lines = stream_lines(spark, str(folder))
    averages = to_table(jobs.average_speed(traffic.sightings_from_lines(lines), "5 minutes", "1 minute",
                                           "5 seconds"), "lines")
    got = {second(r["window_start"]): (r["avg_speed"], r["car_count"]) for r in averages.collect()}
    assert got == {-240: (90.0, 2), -180: (80.0, 3), -120: (80.0, 3), -60: (80.0, 3), 0: (80.0, 3),
                   60: (60.0, 1)}


def test_limits_are_read_again_while_the_stream_runs(spark, replay):
    """The limit table is a file here; a database would be read the same way."""
    loads, now = [], [0.0]

    def load():
        loads.append(1)
        now[0] += 15  # each load and its batch take a while
        limit = 60.0 if len(loads) == 1 else 300.0
        return spark.createDataFrame([("01", "r", "0001", limit)], schemas.SPEED_LIMIT)

    def clock():
        now[0] += 10
        return now[0]

    folder = run_dir(spark, "refresh")
    limits = jdbc.RefreshedTable(load, folder, max_age_seconds=30, clock=clock)
    replay.add([(1, "fast", 1)], [(1, "fast", 2)], [(1, "fast", 3)], [(1, "fast", 4)])
    writer = jobs.speeding_with_refresh(limits, batch_writer(f"{folder}/out"))
    finish(start(sightings(replay.stream()), writer, f"{folder}/checkpoint"))
    found = sorted(r["arrival"] for r in spark.read.parquet(f"{folder}/out").collect())
    assert len(loads) == 2 and found == [0, 1], "the third batch sees the new limit"


def test_print_sink_shows_every_row(replay, spark):
    replay.add([(1, "a", i % 50) for i in range(45)])
    shown = []
    writer = console.print_stream(replay.stream(), prefix="row: ", show=shown.append)
    finish(writer.option("checkpointLocation", run_dir(spark, "console")).trigger(availableNow=True).start())
    assert len(shown) == 45 and shown[0].startswith("row: 1,a,")


def test_executors_print_every_row(replay, spark, monkeypatch, tmp_path):
    folder = str(tmp_path)

    def written(rows):
        import uuid
        with open(f"{folder}/{uuid.uuid4()}.lines", "w") as file:
            file.writelines(r["line"] + "\n" for r in rows)

    monkeypatch.setattr(console, "_print_lines", written, raising=False)
    replay.add([(1, "a", i % 50) for i in range(45)])
    writer = console.print_stream(replay.stream(), prefix="row: ")
    finish(writer.option("checkpointLocation", run_dir(spark, "console")).trigger(availableNow=True).start())
    lines = [line for path in tmp_path.glob("*.lines") for line in path.read_text().splitlines()]
    assert len(lines) == 45 and lines[0].startswith("row: 1,a,")


def test_a_run_is_waited_for_without_bound():
    class Query:
        waited = None

        def awaitTermination(self, seconds="none"):
            self.waited = seconds
            return False

        def stop(self):
            pass

    query = Query()
    finish(query)
    assert query.waited == "none"
    with pytest.raises(TimeoutError):
        finish(query, 1)


def test_replayed_table_comes_in_order_and_in_cuts(spark):
    rows = spark.range(100).withColumnRenamed("id", "at")
    written = to_table(replayed(spark, rows, "at", "numbers"), "replayed")
    cuts = {r["batch_id"]: (r["low"], r["high"]) for r in written.groupBy("batch_id").agg(
        F.min("at").alias("low"), F.max("at").alias("high")).collect()}
    assert [cuts[i] for i in sorted(cuts)] == [(0, 16), (17, 33), (34, 50), (51, 67), (68, 84), (85, 99)]


def test_a_closing_row_gives_the_last_results_too(spark):
    """With it the append-mode streams give what the tables give, open windows and sessions included."""
    events = views.events(spark, "/root/testdata/sf0.001")
    stream = replayed(spark, files.closing(events, "event_id", "ts", "2 days"), "event_id", "closed")
    averages = to_table(jobs.average_speed(views.sightings(stream), "6 hours", "1 hour", "1 hour"), "closed-avg")
    wanted = traffic.average_speed(views.sightings(events), "6 hours", "1 hour")
    columns = ["area_id", "road_id", "monitor_id", "car_count"]
    assert sorted(averages.select(*columns).collect()) == sorted(wanted.select(*columns).collect())
    found = to_table(jobs.session_windows(stream, "ts", "6 hours", "1 hour", ["user_id"], {"n": count_rows()}), "closed-sessions")
    known = sessions.sessions(events, "ts", "6 hours", ["user_id"], {"n": count_rows()})
    assert sorted(found.select("user_id", "n").collect()) == sorted(known.select("user_id", "n").collect())
    assert files.closing(events.limit(0), "event_id", "ts", "2 days").count() == 0


def test_a_store_that_keeps_its_own_times(spark, monkeypatch):
    """Then the cuts are written one after another."""
    monkeypatch.setattr(files, "_timed", lambda spark, path: False)
    rows = spark.range(40).withColumnRenamed("id", "at")
    written = to_table(replayed(spark, rows, "at", "numbers"), "replayed")
    cuts = {r["batch_id"]: r["low"] for r in written.groupBy("batch_id").agg(F.min("at").alias("low")).collect()}
    assert [cuts[i] for i in sorted(cuts)] == [0, 7, 14, 21, 28, 35] and written.count() == 40


# Rows behind the watermark whose window is still open.
BEHIND = [[(1, "a", 11), (1, "ex", 14)], [(1, "b", 15)], [(1, "c", 13)], [(1, "ex", 12)], [(2, "z", 60)]]


def test_open_windows_keep_rows_behind_the_watermark(replay):
    replay.add(*BEHIND)
    fired = to_table(jobs.fire_on_marker(replay.stream(), "ts", "10 seconds",
                                         F.col("event_id") == "ex", "0 seconds"), "marker")
    assert sorted((-1 if r["fired_by"] is None else r["fired_by"], r["count"]) for r in fired.collect()) == [
        (-1, 5), (1, 2), (4, 5)]
    best = to_table(jobs.top_per_window(replay.stream(), "ts", "10 seconds", "10 seconds", 9, "0 seconds"),
                    "top")
    assert sorted(r["arrival"] for r in best.collect()) == [0, 1, 2, 3, 4]
    counted = windows.windowed(with_event_time(replay.stream(), "ts", "0 seconds"), "ts", "10 seconds", None,
                               ["guid"], {"n": count_rows()})
    assert [r["n"] for r in to_table(counted, "built-in").collect()] == [5]


@settings(max_examples=3, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from([1, 1, 2]), st.sampled_from(["a", "ex"]),
                                   st.integers(0, 60)), min_size=1, max_size=4), min_size=2, max_size=4))
def test_stateful_windows_equal_the_batch_form(spark, tmp_path_factory, batches):
    """Over any cuts: rows whose window has passed are left out, all others count."""
    kept, seen = [], -1
    for batch in batches:
        kept.append([r for r in batch if r[2] // 10 * 10 + 10 > seen - 5])
        seen = max([seen, *[r[2] for r in batch]])
    kept = [b for b in kept if b]
    replay = Replay(spark, tmp_path_factory.mktemp("any")).add(*kept, [(9, "end", 500)])
    table = replay.table().where("guid <> 9")
    marker = F.col("event_id") == "ex"
    fired = to_table(jobs.fire_on_marker(replay.stream(), "ts", "10 seconds", marker, "5 seconds"), "any")
    batch = triggers.fire_on_marker(table, ["guid"], "ts", "arrival", "10 seconds", marker)
    columns = ["guid", "window_start", "fired_by", "count"]
    assert sorted(map(str, fired.where("guid <> 9").withColumn("window_start", F.col("window_start").cast(
        "timestamp_ntz")).select(columns).collect())) == sorted(map(str, batch.select(columns).collect()))
    best = to_table(jobs.top_per_window(replay.stream(), "ts", "10 seconds", "10 seconds", 2, "5 seconds"), "any")
    rows = windows.with_window(table, "ts", "10 seconds")
    wanted = topn.top_n(rows, ["guid", "window_start"], [F.desc("act_time"), F.col("arrival")], 2)
    assert sorted((r["arrival"], r["rank"]) for r in best.where("guid <> 9").collect()) == sorted(
        (r["arrival"], r["rank"]) for r in wanted.collect())


def test_nulls_do_not_end_a_stream(spark, replay):
    replay.add([(1, "a", 1), (1, "b", 2)], [(1, "c", 3)])
    value = F.when(F.col("arrival") != 1, F.col("event_id"))
    number = F.when(F.col("arrival") != 1, F.col("act_time").cast("long"))
    rows = replay.stream().withColumns({"text": value, "n": number})
    joined = to_table(jobs.text_so_far(rows, "guid", "arrival", "text"), "null-text")
    assert {r["arrival"]: r["joined"] for r in joined.collect()} == {0: "a", 1: "a", 2: "ac"}
    kinds = carried_table(rows, "null-kinds", carried.state_kinds("guid", "arrival", "text", "n")).collect()
    assert {r["arrival"]: (r["total"], r["average"], r["kinds"], r["last_three"]) for r in kinds} == {
        0: (1, 1.0, 1, "1"), 1: (1, 1.0, 2, "1"), 2: (4, 2.0, 3, "1,3")}
    counts = carried_table(rows, "null-count", carried.count_windows("guid", "arrival", "n", 3)).collect()
    assert [(r["window_no"], r["total"]) for r in counts] == [(0, 4)]


def test_a_repeated_batch_gives_the_same(spark, replay):
    folder = run_dir(spark, "again")
    step = carried.count_windows("guid", "arrival", "act_time", 2)
    write = carried_writer(step, folder)
    replay.add([(1, "a", 1), (1, "a", 2), (1, "a", 3)], [(1, "a", 4)])
    rows = replay.table()
    write(rows.where("arrival < 3"), 0)
    for _ in range(2):
        write(rows.where("arrival = 3"), 1)
    found = spark.read.parquet(f"{folder}/out").collect()
    assert sorted((r["batch_id"], r["window_no"], r["total"]) for r in found) == [(0, 0, 3), (1, 1, 7)]


def test_a_dimension_that_changes_while_the_stream_runs(replay):
    replay.add([(1, "up", 1), (1, "see", 2), (2, "see", 3)], [(1, "see", 4)],
               [(1, "see", 5), (1, "up", 6), (1, "up", 7)], [(2, "up", 8)], [(2, "see", 9), (1, "see", 9)])
    step = carried.upserted_dimension(F.col("event_id") == "up", ["guid"], "arrival",
                                      {"since": F.col("arrival")})
    rows = carried_table(replay.stream().select("guid", "event_id", "arrival"), "changing", step)
    # Events of a batch see that batch's last update.
    assert {r["arrival"]: r["since"] for r in rows.collect()} == {1: 0, 2: None, 3: 0, 4: 6, 8: 7, 9: 6}


def test_rows_without_a_time_have_their_own_output(spark, replay):
    folder = run_dir(spark, "no-time")
    replay.add([(1, "a", 1), (1, "gone", 2)])
    rows = replay.stream().withColumn("ts", F.when(F.col("event_id") != "gone", F.col("ts")))
    writer = jobs.late_splitter("ts", "10 seconds", delay="0 seconds", lateness="3 seconds", folder=folder)
    finish(start(rows, writer, f"{folder}/checkpoint"))
    found = {n: spark.read.parquet(f"{folder}/{n}").count() for n in ("main", "late", "no_time")}
    assert found == {"main": 1, "late": 0, "no_time": 1}


def test_dangerous_drivers_leave_no_state_behind(spark, replay):
    replay.add([(1, "fast", 10), (2, "fast", 11)], [(3, "slow", 400)], [(3, "slow", 500)], [(3, "slow", 600)])
    none = spark.createDataFrame([], schemas.SPEED_LIMIT)
    folder = run_dir(spark, "forgets")
    stream = jobs.danger_drivers(sightings(replay.stream()), none, "10 seconds", "1 second")
    query = start(stream, batch_writer(f"{folder}/out"), f"{folder}/checkpoint")
    finish(query)
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == 0
