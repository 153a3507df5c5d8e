"""Streams that meet, state by touched keys, windows without a key: against plain models and the batch forms."""

import glob
import os
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from roadwatch.operators import count_windows, sessions as batch_sessions
from roadwatch.operators.running import count_rows, highest, total
from roadwatch.session import run_dir
from roadwatch.sources.files import replayed
from roadwatch.streaming import carried, connected, jobs
from roadwatch.streaming.carried import carried_table, carried_writer
from roadwatch.streaming.run import start, to_table


def timed(df, column="second", out="time"):
    return df.withColumn(out, F.timestamp_seconds(column).cast("timestamp_ntz")).drop(column)


def cut_stream(spark, rows, schema, name):
    """Rows of (arrival, cut, ...) as a stream of one cut per batch."""
    return replayed(spark, spark.createDataFrame(rows, schema), "arrival", name)


# --- interval join ----------------------------------------------------------

def test_interval_join_drops_state_that_can_meet_nothing(spark):
    left = [(i, i % 3 if i % 7 else None, i * 10) for i in range(300)]
    right = [(i, i % 3 if i % 5 else None, i * 10 + 4) for i in range(300)]

    def side(rows, name):
        df = cut_stream(spark, rows, "arrival long, key int, second long", f"join-{name}")
        return timed(df, out=f"{name}_time").withColumnsRenamed({"arrival": f"{name}_no"})
    pairs = connected.interval_join(side(left, "l"), side(right, "r"), ["key"], "l_time", "r_time",
                                    "20 seconds", "40 seconds", "5 seconds")
    folder, seen = run_dir(spark, "interval"), []
    query = start(pairs, lambda df, n: seen.extend(df.collect()), f"{folder}/checkpoint")
    query.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert sorted((r["l_no"], r["r_no"]) for r in seen) == sorted(
        (a, b) for a, k, s in left for b, m, t in right if k is not None and k == m and s - 20 <= t <= s + 40)
    assert max(held) < 250 and held[-1] < 60, "of 600 rows only those near the watermark stay"


def test_a_hot_window_is_joined_by_counts(spark):
    """Fifty equal right rows meet each left row as one."""
    left = [(i, 1, s) for i, s in enumerate([1, 5, 25, 70])]
    right = [(i, 1, 2 + i % 5, 7) for i in range(50)] + [(50, 1, 26, 8), (51, 2, 3, 7), (52, 9, 500, 0)]
    a = timed(cut_stream(spark, left + [(4, 9, 500)], "arrival long, key int, second long", "counts-l")).withColumnRenamed("arrival", "l_no")
    b = timed(cut_stream(spark, right, "arrival long, key int, second long, v int", "counts-r")).drop("arrival")
    found = to_table(jobs.window_join_counts(a, b, ["key"], ["v"], "time", "20 seconds", "0 seconds"), "counts")
    assert sorted((r["l_no"], r["v"], r["copies"]) for r in found.collect()) == [(0, 7, 50), (1, 7, 50), (2, 8, 1)]


# --- two inputs -------------------------------------------------------------

def settled_model(orders, payments, order_wait, payment_wait, until):
    """Event by event, by time."""
    result = []
    for key in {o[1] for o in orders} | {p[1] for p in payments}:
        marks = []
        for no, k, t in orders:
            if k == key:
                marks += [(t, 1, no), (t + order_wait, 0, no)]
        for no, k, t in payments:
            if k == key:
                marks += [(t, 2, no), (t + payment_wait, 0, ~no)]
        open_orders, open_payments = [], []
        for t, what, no in sorted(marks):
            if t >= until:
                break
            if what == 0 and no >= 0 and no in open_orders:
                open_orders.remove(no)
                result.append((key, "unpaid", no, None))
            elif what == 0 and no < 0 and ~no in open_payments:
                open_payments.remove(~no)
                result.append((key, "no order", None, ~no))
            elif what == 1:
                result += [(key, "early", no, p) for p in open_payments]
                open_payments = []
                open_orders.append(no)
            elif what == 2:
                result += [(key, "paid", o, no) for o in open_orders]
                if not open_orders:
                    open_payments.append(no)
                open_orders = []
    return sorted(result, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_two_inputs_on_one_state(spark, seed):
    rng = random.Random(seed)
    times = rng.sample(range(0, 3000), 240)
    both = [(i, rng.choice([None, 1, 2, 3]), t) for i, t in enumerate(times)]
    orders, payments = both[:110], both[110:]
    ends = [(1000 + i, 9, 20_000 + i) for i in range(4)]

    def side(rows, name):
        rng.shuffle(rows)
        rows = [(i, k, t, no) for i, (no, k, t) in enumerate(rows)] + [(len(rows) + i, k, t, no) for i, (no, k, t) in enumerate(ends)]
        df = cut_stream(spark, rows, f"arrival long, key int, second long, {name} long", f"two-{name}")
        return timed(df, out=f"{name}_at").drop("arrival")
    found = connected.settled(side(list(orders), "o"), side(list(payments), "p"), "key", "o", "p", "o_at", "p_at",
                              "60 seconds", "25 seconds", "3100 seconds")
    rows = sorted(((r["key"], r["kind"], r["o"], r["p"]) for r in to_table(found, "two").collect() if r["key"] != 9), key=str)
    assert rows == settled_model(orders, payments, 60, 25, 10_000)
    assert {r[1] for r in rows} == {"paid", "unpaid", "early", "no order"}


# --- state by touched keys --------------------------------------------------

def test_a_batch_reads_and_writes_its_own_buckets(spark, monkeypatch):
    folder, read = run_dir(spark, "touched"), []
    real = carried.State._read

    def watched(self, name, wanted):
        df = real(self, name, wanted)
        read.append((name, len(df.inputFiles())))
        return df
    monkeypatch.setattr(carried.State, "_read", watched)
    write = carried_writer(carried.count_windows("key", "arrival", "n", 3), folder, buckets=32)
    many = spark.range(5000).select(F.col("id").alias("arrival"), (F.col("id") % 1000).alias("key"), F.lit(1).alias("n"))
    few = spark.createDataFrame([(10_000 + i, i, 1) for i in range(3)], "arrival long, key long, n int")
    write(many, 0)
    read.clear()
    for _ in range(2):  # the repeated batch reads and leaves the same
        write(few, 1)
    assert read and all(files <= 3 for _, files in read)
    assert len(glob.glob(f"{folder}/state/counts/1/state_bucket=*")) <= 3
    write(few.withColumn("arrival", F.col("arrival") + 10), 2)
    write(many.withColumn("arrival", F.col("arrival") + 20_000), 3)
    rows = spark.read.parquet(f"{folder}/out").groupBy("key").agg(F.count("*").alias("n"), F.sum("total").alias("t"))
    assert {r["key"]: (r["n"], r["t"]) for r in rows.collect()} == {
        k: ((10 + 2 * (k < 3)) // 3, (10 + 2 * (k < 3)) // 3 * 3) for k in range(1000)}
    assert not os.path.exists(f"{folder}/state/record-1"), "what no batch can read is gone"
    assert not glob.glob(f"{folder}/state/counts/1/state_bucket=*")


def kinds_model(batches):
    """Rows are (arrival, key, kind, value); a later batch knows the last two values of a key."""
    found, state = {}, {}
    for batch in batches:
        for held in state.values():
            held["values"] = held["values"][-2:]
        for arrival, key, kind, value in batch:
            held = state.setdefault(key, {"total": None, "n": 0, "kinds": {}, "values": []})
            held["kinds"][kind] = held["kinds"].get(kind, 0) + 1
            if value is not None:
                held["total"], held["n"] = (held["total"] or 0) + value, held["n"] + 1
                held["values"] = [*held["values"], value][-3:]
            found[arrival] = (held["total"], held["total"] / held["n"] if held["n"] else None, held["kinds"][kind],
                              len(held["kinds"]), ",".join(map(str, held["values"])))
    return found


def kinds_written(spark, folder):
    return {r["arrival"]: (r["total"], r["average"], r["of_kind"], r["kinds"], r["last_three"])
            for r in spark.read.parquet(f"{folder}/out").collect()}


KINDS_ROW = "arrival long, key long, kind string, n long"


def test_state_is_not_written_again_with_every_batch(spark):
    folder, wrote, batches = run_dir(spark, "runs"), [], []
    write = carried_writer(carried.state_kinds("key", "arrival", "kind", "n"), folder, buckets=1)
    for b in range(9):  # the first eight have keys of their own, the last one has all
        keys = range(160) if b == 8 else range(20 * b, 20 * b + 20)
        batches.append([(1000 * b + k, k, "ab"[b == 8], k) for k in keys])
        for _ in range(1 + (b in (3, 4))):  # a batch that runs again does the same
            write(spark.createDataFrame(batches[-1], KINDS_ROW), b)
        wrote.append(sum(pq.read_metadata(f).num_rows
                         for f in glob.glob(f"{folder}/state/*/{b}/*/*.parquet")))
        assert len(glob.glob(f"{folder}/state/so_far/*/state_bucket=0")) <= 8
    assert wrote == [20, 20, 20, 80, 20, 20, 20, 80, 160]
    assert kinds_written(spark, folder) == kinds_model(batches)


def test_a_large_batch_of_state_kinds_goes_part_by_part(spark, monkeypatch):
    monkeypatch.setattr(carried, "KEYED_WIDTH", 20)
    rng, folder = random.Random(5), run_dir(spark, "parts")
    rows = [(i * 70_000, rng.choice([1, 1, 2, None]), rng.choice(["a", "b", "c", None]),
             rng.choice([None, *range(9)])) for i in range(75)]
    batches = [rows[:55], rows[55:60], rows[60:]]
    write = carried_writer(carried.state_kinds("key", "arrival", "kind", "n"), folder, buckets=4)
    for b, batch in enumerate(batches):
        write(spark.createDataFrame(batch, KINDS_ROW), b)
    assert kinds_written(spark, folder) == kinds_model(batches)


def test_rules_that_change_while_the_stream_runs(spark):
    rows = [  # arrival, area, key, threshold of a rule
        (0, 1, 7, None), (1, 1, 7, None), (2, 1, None, 3), (3, 1, 7, None), (4, 1, 8, None), (5, 2, 9, None),
        (6, 1, None, 5), (7, 1, 7, None), (8, 1, 8, None), (9, 1, None, 2), (10, 1, 8, None), (11, 2, None, 1)]
    stream = cut_stream(spark, [(a, ar, k, t) for a, ar, k, t in rows], "arrival long, area int, key int, threshold int", "rules")
    step = carried.changing_rules(F.col("threshold").isNotNull(), "area", "key", "arrival", "threshold")
    found = {(r["kind"], r["area"], r["key"], r["arrival"], r["count"], r["threshold"])
             for r in carried_table(stream, "rules", step).collect()}
    # Two rows a batch: the rule of 2 holds for 3, that of 6 for 7, that of 9 for 8 too, 11's meets key 9's count.
    assert found == {("reached", 1, 7, 3, 3, 3), ("rule", 1, 7, None, 4, 2), ("reached", 1, 8, 8, 2, 2),
                     ("rule", 2, 9, None, 1, 1)}


# --- windows without a key --------------------------------------------------

def some_rows(n, seed):
    rng = random.Random(seed)
    return [(i, rng.choice([0, 3, 40]) + i * 7, rng.choice([None, 1, 2, 30])) for i in range(n)]


@pytest.mark.parametrize("size,slide", [(10, 4), (4, 10), (6, 2), (5, 5)])
def test_count_windows_without_a_key_after_a_restart(spark, size, slide):
    rows = spark.createDataFrame(some_rows(83, size), "arrival long, second long, n long")
    aggs = {"rows": count_rows(), "sum": total(F.col("n")), "most": highest(F.col("n"))}
    for step, wanted in ((carried.count_sliding("arrival", size, slide, aggs),
                          count_windows.count_sliding(rows, [], "arrival", size, slide, aggs)),
                         (carried.count_windows(None, "arrival", "n", size),
                          count_windows.count_tumbling(rows, [], "arrival", size, {"total": total(F.col("n"))}))):
        folder = run_dir(spark, "count-all")
        write = carried_writer(step, folder)
        for batch, (low, high) in enumerate([(0, 5), (5, 6), (6, 6), (6, 40), (40, 83)]):
            for _ in range(2 if batch == 3 else 1):
                write(rows.where(f"arrival >= {low} and arrival < {high}"), batch)
                step = step if batch != 3 else step
        got = spark.read.parquet(f"{folder}/out").drop("batch_id").select(wanted.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, wanted.collect()))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sessions_without_a_key_over_disordered_cuts(spark, seed):
    rng = random.Random(seed)
    rows = some_rows(120, seed)
    shuffled = [(i, s - rng.randint(0, 60), n) for i, s, n in rows] + [(120, None, 5)]
    df = timed(spark.createDataFrame(shuffled, "arrival long, second long, n long"))
    aggs = {"rows": count_rows(), "most": highest(F.col("n"))}
    wanted = batch_sessions.sessions(df.where("time is not null"), "time", "9 seconds", [], aggs)
    stream = replayed(spark, df, "arrival", "sessions")
    got = carried_table(stream, "sessions", carried.sessions("time", "9 seconds", "110 seconds", aggs), close=True)
    shown = lambda d: sorted((r["session_start"], r["session_end"], r["rows"], r["most"] or 0)
                             for r in d.withColumns({c: F.col(c).cast("timestamp") for c in ("session_start", "session_end")}).collect())
    assert shown(got) == shown(wanted)


def test_sessions_by_the_time_of_the_batch(spark):
    """A clock that stands in: batches at 0, 3, 20 and 21 seconds."""
    clock = iter([0, 3_000_000, 20_000_000, 21_000_000])
    step = carried.sessions("time", "5 seconds", "0 seconds", {"rows": count_rows()}, clock=lambda: next(clock))
    stream = replayed(spark, spark.createDataFrame([(i * 3, i) for i in range(4)], "arrival long, n long"), "arrival", "clock")
    stream = stream.withColumn("time", F.current_timestamp())
    got = carried_table(stream, "clock", step, close=True)
    assert sorted((r["rows"], r["session_start"].second, r["session_end"].second) for r in got.collect()) == [(2, 0, 8), (2, 20, 26)]


def test_late_rows_open_no_session_again(spark):
    rows = [(0, 10), (1, 100), (2, 11), (3, 98), (4, 200), (5, 300)]
    df = timed(spark.createDataFrame(rows, "arrival long, second long"))
    step = carried.sessions("time", "5 seconds", "3 seconds", {"rows": count_rows()})
    got = carried_table(replayed(spark, df, "arrival", "late"), "late", step, close=True)
    assert sorted((r["session_start"].timestamp() % 1000, r["rows"]) for r in got.collect()) == [
        (10, 1), (98, 2), (200, 1), (300, 1)], "11 came when its session had ended; 98 found 100 open"


# --- evictor with a trigger -------------------------------------------------

def test_an_evicting_trigger(spark):
    rows = [(0, 1, 1, "a", 1), (1, 1, 9, "ex", 2), (2, 1, 4, "a", 4), (3, 1, 15, "ex", None), (4, 1, 16, "ex", 8),
            (5, 2, 3, "a", 5), (6, 3, 60, "z", 0), (7, 3, 61, "z", 0)]
    df = spark.createDataFrame(rows, "arrival long, guid long, second long, event_id string, act_time int")
    df = timed(df.withColumn("second", F.col("second") + 1_700_000_000))
    stream = replayed(spark, df, "arrival", "evict")
    fired = jobs.fire_on_marker_evicting(stream, "time", "20 seconds", "7 seconds", F.col("event_id") == "ex", "20 seconds",
                                         "act_time")
    got = sorted((r["guid"], r["fired_by"] or 99, r["count"], r["total"]) for r in to_table(fired, "evict").collect())
    assert got == [(1, 1, 1, 2), (1, 3, 2, 2), (1, 4, 2, 8), (1, 99, 2, 8), (2, 99, 1, 5)]
