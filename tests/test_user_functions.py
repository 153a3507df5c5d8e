"""The user's own aggregates, co-groups and look-ups against plain models."""

import math
import random
import sys
from collections import defaultdict

import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark import cloudpickle
from pyspark.sql import functions as F

from roadwatch.operators import cogroups, sessions, user_aggregates as ua, windows
from roadwatch.operators.running import count_rows, total
from roadwatch.session import run_dir
from roadwatch.sources import lookup

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers do not see the tests' folder
FEW = settings(max_examples=80, deadline=None)


def made(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows = [(i, rng.choice([None, "a", "b", "c"]), rng.choice([None, 1, 2]), rng.randint(0, 500),
             rng.choice([None, rng.randint(1, 90)])) for i in range(n)]
    df = spark.createDataFrame(rows, "arrival long, kind string, car int, second long, n int")
    return rows, df.withColumn("ts", F.timestamp_seconds("second").cast("timestamp_ntz")).repartition(5)


class Longest(ua.Aggregate):
    """The two largest values and how many rows had one: neither a sum nor a single maximum."""

    result_type = "top array<int>, rows long"

    def create(self):
        return [], 0

    def add(self, state, n, car):
        return state if n is None else (sorted([*state[0], n])[-2:], state[1] + 1)

    def merge(self, one, other):
        return sorted(one[0] + other[0])[-2:], one[1] + other[1]

    def result(self, state):
        return state


@pytest.mark.parametrize("at_once", [50_000, 1])
def test_groups(spark, monkeypatch, at_once):
    monkeypatch.setattr(ua, "STATES_AT_ONCE", at_once)
    rows, df = made(spark)
    for keys in (["kind", "car"], ["kind"], []):
        wanted = defaultdict(list)
        for r in rows:
            key = tuple(r[1 if k == "kind" else 2] for k in keys)
            wanted[key] += [r[4]] if r[4] is not None else []
        got = {tuple(r)[:len(keys)]: (r["top"], r["rows"]) for r in ua.aggregated(df, keys, Longest(), "n", "car").collect()}
        assert got == {k: (sorted(v)[-2:], len(v)) for k, v in wanted.items()}


def test_no_rows_and_four_functions(spark):
    _, df = made(spark)
    count = ua.user_function(lambda: 0, lambda s, v: s + 1, lambda a, b: a + b, lambda s: (s,), "rows long")
    assert ua.aggregated(df.limit(0), ["kind"], count, "n").collect() == []
    assert ua.aggregated(df, [], count, "n").collect()[0]["rows"] == 400


def test_windows_and_sessions_equal_the_built_in_ones(spark):
    _, df = made(spark)
    pairs = ua.windowed(df, ["kind"], "ts", "60 seconds", "20 seconds", ua.AverageOfPairs(), "n")
    built = windows.windowed(df, "ts", "60 seconds", "20 seconds", ["kind"],
                             {"s": total(F.col("n")), "c": count_rows(F.col("n").isNotNull())})
    built = built.select("kind", "window_start", "window_end", (F.col("s") / F.nullif("c", F.lit(0))).alias("average"))
    assert sorted(map(str, pairs.collect())) == sorted(map(str, built.collect()))
    per = ua.in_sessions(df, ["kind", "car"], "ts", "9 seconds", Longest(), "n", "car").select(
        "kind", "car", "session_start", "session_end", "rows")
    known = sessions.sessions(df, "ts", "9 seconds", ["kind", "car"], {"rows": count_rows(F.col("n").isNotNull())})
    assert sorted(map(str, per.collect())) == sorted(map(str, known.select(*per.columns).collect()))


@FEW
@given(st.lists(st.one_of(st.floats(1e-5, 1e6), st.just(0.0), st.none()), max_size=200), st.integers(0, 200))
def test_the_sketch_is_within_its_error(values, cut):
    sketch = ua.Quantiles([0, 0.25, 0.5, 0.99, 1], 0.02)
    parts = [sketch.add_all(sketch.create(), [pa.array(v, pa.float64())]) for v in (values[:cut], values[cut:])]
    n, *found = sketch.result(sketch.merge(*parts))
    known = sorted(v for v in values if v is not None)
    assert n == len(known)
    for q, answer in zip(sketch.quantiles, found):
        if known:
            true = known[math.floor(q * (n - 1))]
            assert abs(answer - true) <= 0.02 * true * (1 + 1e-9)
        else:
            assert answer is None


@FEW
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.text("ab", max_size=2)))))
def test_codes_tell_keys_apart(rows):
    columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())]
    codes = ua._codes(columns).tolist()
    assert len(set(zip(codes, rows))) == len(set(codes)) == len(set(rows))


# --- co-groups --------------------------------------------------------------

def sizes(key, left, right):
    yield sum(1 for _ in left), sum(r["n"] or 0 for r in right)


def test_both_groups_with_one_sided_ones(spark):
    rows, df = made(spark)
    left, right = df.where("second % 3 = 0 and coalesce(kind, 'z') <> 'b'"), df.where("second % 3 = 1 and coalesce(kind, 'z') <> 'c'")
    got = {(r["kind"], r["car"]): (r["l"], r["r"]) for r in cogroups.cogroup(
        left.select("kind", "car", "arrival"), right.select("kind", "car", "arrival", "n"), ["kind", "car"],
        "arrival", sizes, "l long, r long").collect()}
    wanted = defaultdict(lambda: [0, 0])
    for _, kind, car, second, n in rows:
        if second % 3 == 0 and kind != "b":
            wanted[kind, car][0] += 1
        if second % 3 == 1 and kind != "c":
            wanted[kind, car][1] += n or 0
    assert got == {k: tuple(v) for k, v in wanted.items()}


def test_a_function_that_reads_little_or_nothing(spark):
    _, df = made(spark)
    side = df.select("kind", "arrival")

    def first(key, left, right):
        yield next(right)["arrival"], next(left)["arrival"]
    got = cogroups.cogroup(side, side, ["kind"], "arrival", first, "r long, l long").collect()
    lowest = {r["kind"]: r["a"] for r in side.groupBy("kind").agg(F.min("arrival").alias("a")).collect()}
    assert {r["kind"]: (r["r"], r["l"]) for r in got} == {k: (a, a) for k, a in lowest.items()}
    assert cogroups.cogroup(side, side, ["kind"], "arrival", lambda k, l, r: iter(()), "x int").collect() == []
    assert cogroups.cogroup(side.limit(0), side.limit(0), ["kind"], "arrival", first, "r long, l long").collect() == []


def test_going_along_both_sides_holds_next_to_nothing():
    """A group of 200,000 rows: the function follows both sides, and what waits stays small."""
    n, most = 200_000, 0
    stream = iter([(("k",), i % 2, {"t": i, "v": i}) for i in range(n)])
    group = cogroups._Sides(stream, next(stream))
    run = cogroups.aligned("t", "t", "v")(group.key, group.side(0), group.side(1))
    rows = 0
    for _ in run:
        rows += 1
        most = max(most, *map(len, group._held))
    assert rows == n // 2 + 1 and most <= 2 and group.drain() is None


# --- look-up by key ---------------------------------------------------------

class Table:
    """Stands in for a database: answers predicates and counts the keys asked for."""

    def __init__(self, spark):
        self.rows = spark.createDataFrame([(i, f"it's {i}", i * i) for i in range(50)], "id int, name string, square int")
        self.asked, self.scans = [], 0

    def load(self, conditions):
        if conditions is None:
            self.scans += 1
            return self.rows
        self.asked.append([c.count(",") + 1 if " IN " in c else c.count(" OR ") + 1 for c in conditions if c != "1 = 0"])
        return self.rows.where(" OR ".join(conditions))


def test_only_new_and_old_keys_are_asked_for(spark, monkeypatch):
    monkeypatch.setattr(lookup, "KEYS_PER_PREDICATE", 4)
    table, now = Table(spark), [1000.0]
    monkeypatch.setattr(lookup.predicates, "__defaults__", (4,))
    cache = lookup.KeyedLookup(table.load, ["id"], run_dir(spark, "cache"), "60 seconds", most_keys=20, clock=lambda: now[0])

    def squares(*ids):
        batch = spark.createDataFrame([(i,) for i in ids], "id int")
        return {r["id"]: r["square"] for r in cache.get(batch).collect()}
    assert squares(1, 2, 2, 3, 99, None) == {1: 1, 2: 4, 3: 9} and table.asked == [[4]]
    assert squares(3, 2, 99) == {3: 9, 2: 4} and table.asked == [[4]], "known, the key without a row too"
    now[0] += 30
    assert squares(*range(2, 9)) == {i: i * i for i in range(2, 9)} and table.asked[1:] == [[4, 1]]
    now[0] += 31  # the first answers are too old, the second are not
    assert squares(1, 8) == {1: 1, 8: 64} and table.asked[2:] == [[1]]
    assert squares(*range(50)) == {i: i * i for i in range(50)} and table.scans == 1, "too many for predicates"
    assert squares() == {} and squares(None) == {}


def test_keys_of_two_columns_and_their_text(spark):
    table = Table(spark)
    cache = lookup.KeyedLookup(table.load, ["name", "id"], run_dir(spark, "cache"), "1 day")
    batch = spark.createDataFrame([("it's 3", 3), ("it's 4", 3)], "name string, id int")
    assert [r["square"] for r in cache.get(batch).collect()] == [9] and table.asked == [[2]]
    with pytest.raises(TypeError):
        lookup.literal(object())
