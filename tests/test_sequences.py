"""Event patterns against a plain search over all choices of rows."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from roadwatch.operators import sequences
from roadwatch.operators.sequences import Pattern
from roadwatch.sources.files import replayed
from roadwatch.streaming import patterns
from roadwatch.streaming.run import to_table

BASE = Pattern.begin("a", "kind = 'a'")
PATTERNS = {
    "strict": BASE.next("b", "kind = 'b'").followed_by("c", "kind = 'c'").within("9 seconds"),
    "relaxed": BASE.followed_by("b", "kind = 'b'").followed_by("c", "kind IN ('c', 'd')").within("12 seconds"),
    "any": BASE.followed_by_any("b", "kind = 'b'").followed_by("c", "kind = 'c'").within("12 seconds"),
    "two any": BASE.followed_by_any("b", "kind = 'b'").followed_by_any("c", "kind = 'c'").within("10 seconds"),
    "times": BASE.followed_by("b", "kind = 'b'").times(1, 3).followed_by("c", "kind = 'c'").within("14 seconds"),
    "in a row": BASE.followed_by("b", "kind IN ('b', 'c')").times(2, consecutive=True).within("14 seconds"),
    "optional": BASE.next("b", "kind = 'b'").optional().followed_by("c", "kind = 'c'").within("9 seconds"),
    "not between": BASE.not_followed_by("kind = 'd'").followed_by("c", "kind = 'c'").within("9 seconds"),
    "not between any": BASE.not_followed_by("kind = 'd'").followed_by_any("c", "kind = 'c'").within("12 seconds"),
    "not next": BASE.not_next("kind = 'b'").followed_by("c", "kind = 'c'").within("9 seconds"),
    "not at the end": BASE.followed_by("b", "kind = 'b'").not_followed_by("kind = 'c'").within("7 seconds"),
    "same kind": BASE.followed_by("b", "kind = 'a'").followed_by("c", "kind = 'a'").within("10 seconds"),
}
KINDS = {"a": {"a"}, "b": {"b"}, "c": {"c"}}
ACCEPTS = {  # per pattern and condition number, the kinds it takes
    "relaxed": [{"a"}, {"b"}, {"c", "d"}], "in a row": [{"a"}, {"b", "c"}], "same kind": [{"a"}] * 3,
    "not between": [{"a"}, {"d"}, {"c"}], "not between any": [{"a"}, {"d"}, {"c"}],
    "not next": [{"a"}, {"b"}, {"c"}],
}


def brute(rows, name, pattern):
    """Every increasing choice of rows that satisfies the pattern's own words."""
    accepts = ACCEPTS.get(name, [{"a"}, {"b"}, {"c"}])
    rows = sorted(r for r in rows if r[0] is not None)
    fits = lambda i, c: rows[i][2] in accepts[c]
    found = set()

    def first(after, condition):
        return next((j for j in range(after + 1, len(rows)) if fits(j, condition)), None)

    def extend(held, elements):
        if not elements:
            found.add((tuple(held), line.counts))
            return
        e, last = elements[0], held[-1]
        if e.how == "never":
            bad = [j for j in range(last + 1, len(rows)) if fits(j, e.condition)
                   and rows[j][0] - rows[held[0]][0] < pattern.span_us / 1e6]
            if not bad:
                extend(held, elements[1:])
            return
        if e.how == "next":
            choices = [last + 1] if last + 1 < len(rows) and fits(last + 1, e.condition) else []
        elif e.how == "any":
            choices = [j for j in range(last + 1, len(rows)) if fits(j, e.condition)]
        else:
            choices = [j for j in [first(last, e.condition)] if j is not None]
        if e.guard is not None and e.guarded == "next":
            if last + 1 < len(rows) and fits(last + 1, e.guard):
                choices = []
        elif e.guard is not None:
            choices = [j for j in choices if not any(fits(k, e.guard) for k in range(last + 1, j))]
        for j in choices:
            if rows[j][0] - rows[held[0]][0] < pattern.span_us / 1e6:
                extend([*held, j], elements[1:])

    for line in pattern.lines():
        for i in range(len(rows)):
            if fits(i, line.elements[0].condition):
                extend([i], line.elements[1:])
    if pattern.skipping != "none":
        best = {}
        for held, counts in found:
            key = (held[-1], len(held))
            if held[0] not in best or key < best[held[0]][0]:
                best[held[0]] = (key, (held, counts))
        found = {m for _, m in best.values()}
    if pattern.skipping == "past_last":
        taken, end = set(), -1
        for held, counts in sorted(found, key=lambda m: (m[0][-1], m[0][0])):
            if held[0] > end:
                taken.add((held, counts))
                end = held[-1]
        found = taken
    result = []
    for held, counts in found:
        at, steps = 0, []
        for n in counts:
            steps.append(tuple(rows[i][1] for i in held[at:at + n]))
            at += n
        result.append(tuple(steps))
    return sorted(result)


def made(seed, n=90):
    rng = random.Random(seed)
    rows = []
    for arrival in range(n):
        time = None if rng.random() < 0.03 else rng.randint(0, 60)
        rows.append((arrival, rng.choice([None, 1, 2, 3]), time, rng.choice("aabbccd")))
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, "arrival long, car int, second int, kind string")
    return df.withColumn("time", F.timestamp_seconds("second").cast("timestamp_ntz")).drop("second")


def flat(matches, pattern):
    found = {}
    for r in matches:
        steps = tuple((r[s.name]["arrival"],) if s.single else tuple(e["arrival"] for e in r[s.name])
                      for s in pattern.steps)
        found.setdefault(r["car"], []).append(steps)
    return {car: sorted(v) for car, v in found.items()}


def wanted(rows, name, pattern):
    result = {}
    for car in {r[1] for r in rows}:
        mine = brute([(t, a, k) for a, c, t, k in rows if c == car], name, pattern)
        if mine:
            result[car] = mine
    return result


@pytest.mark.parametrize("hot_rows", [1 << 20, 7], ids=["whole", "cut"])
@pytest.mark.parametrize("name", PATTERNS)
def test_patterns_by_brute_force(spark, name, hot_rows):
    rows, pattern = made(3), PATTERNS[name]
    df = frame(spark, rows).repartition(3)
    got = sequences.match(df, pattern, ["car"], "time", "arrival", ["arrival"], hot_rows=hot_rows)
    assert flat(got.collect(), pattern) == wanted(rows, name, pattern)


@pytest.mark.parametrize("hot_rows", [1 << 20, 7], ids=["whole", "cut"])
@pytest.mark.parametrize("skip", ["to_next", "past_last"])
@pytest.mark.parametrize("name", ["relaxed", "two any", "times"])
def test_skip_strategies(spark, name, skip, hot_rows):
    rows, pattern = made(5), PATTERNS[name].skip(skip)
    got = sequences.match(frame(spark, rows), pattern, ["car"], "time", "arrival", ["arrival"], hot_rows=hot_rows)
    assert flat(got.collect(), pattern) == wanted(rows, name, pattern)


def test_a_burst_at_one_time_is_cut(spark):
    """One key, one time: rank cuts it, time could not."""
    rows = [(i, 1, 5, "ab"[i % 2]) for i in range(60)]
    pattern = BASE.next("b", "kind = 'b'").within("1 second")
    got = sequences.match(frame(spark, rows), pattern, ["car"], "time", "arrival", ["arrival"], hot_rows=8)
    assert len(flat(got.collect(), pattern)[1]) == 30


def test_no_rows_and_bad_patterns(spark):
    assert sequences.match(frame(spark, []), PATTERNS["any"], ["car"], "time", "arrival").collect() == []
    for bad in (lambda: BASE.followed_by("a", "kind = 'b'"), lambda: BASE.times(0).lines(),
                lambda: BASE.not_next("kind = 'b'").lines(), lambda: BASE.not_followed_by("kind = 'b'").lines(),
                lambda: BASE.skip("some"), lambda: BASE.times(3, 2)):
        with pytest.raises(ValueError):
            bad()


@pytest.mark.parametrize("name", PATTERNS)
def test_streamed_patterns(spark, name):
    """Rows come in the order of arrival, far out of order in time."""
    rows, pattern = made(8), PATTERNS[name]
    last = [(1000 + i, car, 400 + i, "x") for i, car in enumerate([None, 1, 2, 3, None, 1, 2, 3])]
    stream = replayed(spark, frame(spark, rows + last), "arrival", "patterns")
    found = to_table(patterns.match(stream, pattern, ["car"], "time", "arrival", "61 seconds", ["arrival"]), "patterns")
    assert flat(found.collect(), pattern) == wanted(rows, name, pattern)
