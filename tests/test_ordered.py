"""Ordered operators against short plain-Python models, with buckets so narrow
that results cross many of them."""

import datetime as dt
from collections import defaultdict

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
import pytest

from roadwatch.operators import (
    aggs, count_windows, histories, joins, late, patterns, sessions, triggers,
)
from roadwatch.operators.running import (
    KEYED_WIDTH, bucket_width, count_rows, earliest, folded, highest, latest, lowest, running,
    running_from, text_of, total,
)

EPOCH = dt.datetime(2024, 1, 1)
FEW = settings(max_examples=6, deadline=None)

# (key, seconds, number): a few keys, one of them hot, times with ties.
ROWS = st.lists(
    st.tuples(st.sampled_from(["hot", "hot", "hot", "a", None]), st.integers(0, 120),
              st.one_of(st.none(), st.integers(-5, 9))),
    min_size=1, max_size=60)


def frame(spark, rows, gaps=1):
    data = [(k, EPOCH + dt.timedelta(seconds=s), v, i * gaps) for i, (k, s, v) in enumerate(rows)]
    return spark.createDataFrame(data, "key string, ts timestamp_ntz, n long, arrival long")


def by_key(rows):
    groups = defaultdict(list)
    for i, (k, s, v) in enumerate(rows):
        groups[k].append((i, s, v))
    return groups


@FEW
@given(ROWS, st.integers(1, 9), st.booleans())
def test_running(spark, rows, width, inclusive):
    found = running(frame(spark, rows), ["key"], "arrival", {
        "s": total(F.col("n")), "c": count_rows(), "hi": highest(F.col("n")),
        "lo": lowest(F.col("n")), "last": latest(F.col("n")),
        "text": text_of(F.col("n").cast("string")),
    }, width=width, inclusive=inclusive)
    got = {r["arrival"]: tuple(r[c] for c in ("s", "c", "hi", "lo", "last", "text"))
           for r in found.collect()}
    want = {}
    for group in by_key(rows).values():
        for at, (i, _, _) in enumerate(group):
            seen = group[: at + 1 if inclusive else at]
            known = [v for _, _, v in seen if v is not None]
            want[i] = (sum(known) if known else None, len(seen), max(known, default=None),
                       min(known, default=None), known[-1] if known else None,
                       "".join(map(str, known)))
    assert got == want


def test_running_keeps_all_columns_and_sparse_order(spark):
    df = frame(spark, [("a", 1, 1), ("b", 2, 2), ("a", 3, 3)], gaps=10**12)
    found = running(df, [], "arrival", {"c": count_rows()})
    assert found.columns == [*df.columns, "c"]
    assert sorted(r["c"] for r in found.collect()) == [1, 2, 3]
    assert bucket_width(df, "arrival") == 2 * 10**12 + 1
    assert bucket_width(df.limit(0), "arrival") == 1024


def test_keyed_buckets_are_wide_and_need_no_look_at_the_data(spark):
    df = frame(spark, [("a", 1, 1), ("a", 2, 2)])
    assert KEYED_WIDTH == 1 << 20
    found = running(df, ["key"], "arrival", {"first": earliest(F.col("n")),
                                             "bits": folded(F.col("n"), F.bit_or)})
    assert sorted((r["first"], r["bits"]) for r in found.collect()) == [(1, 1), (1, 3)]


@FEW
@given(ROWS, st.integers(0, 60), st.integers(1, 9), st.booleans())
def test_running_goes_on_from_a_stored_state(spark, rows, cut, width, inclusive):
    aggregates = {"s": total(F.col("n")), "c": count_rows(), "hi": highest(F.col("n")),
                  "last": latest(F.col("n"))}
    df = frame(spark, rows)
    whole = running(df, ["key"], "arrival", aggregates, width=width, inclusive=inclusive)
    one, state = running_from(df.where(F.col("arrival") < cut), ["key"], "arrival", aggregates, None,
                              width=width, inclusive=inclusive)
    two, state = running_from(df.where(F.col("arrival") >= cut), ["key"], "arrival", aggregates, state,
                              width=width, inclusive=inclusive)
    order = ["arrival", "s", "c", "hi", "last"]
    assert sorted(map(str, one.unionByName(two).select(order).collect())) == sorted(
        map(str, whole.select(order).collect()))
    ends = {r["key"]: (r["s"], r["c"], r["hi"]) for r in state.collect()}
    want = {k: (sum(v) if v else None, len(g), max(v, default=None)) for k, g in by_key(rows).items()
            for v in [[v for _, _, v in g if v is not None]]}
    assert ends == want


def test_texts_do_not_go_on(spark):
    with pytest.raises(ValueError):
        running_from(frame(spark, [("a", 1, 1)]), ["key"], "arrival", {"t": text_of(F.col("n"))}, None)


@FEW
@given(ROWS, st.integers(1, 5), st.integers(1, 7), st.booleans())
def test_count_tumbling(spark, rows, size, width, keyed):
    keys = ["key"] if keyed else []
    found = count_windows.count_tumbling(frame(spark, rows), keys, "arrival", size,
                                         {"s": total(F.coalesce("n", F.lit(0)))}, width=width)
    groups = by_key(rows) if keyed else {None: [(i, s, v) for i, (_, s, v) in enumerate(rows)]}
    want = sorted((str(k), w, sum(v or 0 for _, _, v in g[w * size:(w + 1) * size]))
                  for k, g in groups.items() for w in range(len(g) // size))
    assert sorted((str(r["key"]) if keyed else "None", r["window_no"], r["s"])
                  for r in found.collect()) == want


@FEW
@given(ROWS, st.integers(1, 7), st.integers(1, 7), st.integers(1, 7))
def test_count_sliding(spark, rows, size, slide, width):
    found = count_windows.count_sliding(
        frame(spark, rows), ["key"], "arrival", size, slide,
        {"c": count_rows(), "s": total(F.coalesce("n", F.lit(0)))}, width=width)
    want = sorted((str(k), f, len(g[max(0, f - size):f]), sum(v or 0 for _, _, v in g[max(0, f - size):f]))
                  for k, g in by_key(rows).items() for f in range(slide, len(g) + 1, slide))
    assert sorted((str(r["key"]), r["fired_at"], r["c"], r["s"]) for r in found.collect()) == want


def model_sessions(times, gap):
    found, start, last, n = [], None, None, 0
    for t in sorted(times):
        if last is None or t - last > gap:
            if last is not None:
                found.append((start, last + gap, n))
            start, n = t, 0
        last, n = t, n + 1
    return [*found, (start, last + gap, n)]


@FEW
@given(ROWS, st.integers(1, 20), st.booleans())
def test_sessions(spark, rows, gap, keyed):
    found = sessions.sessions(frame(spark, rows), "ts", f"{gap} seconds", ["key"] if keyed else [],
                              {"c": count_rows()})
    groups = by_key(rows) if keyed else {None: [(i, s, v) for i, (_, s, v) in enumerate(rows)]}
    want = sorted((str(k), *w) for k, g in groups.items()
                  for w in model_sessions([s for _, s, _ in g], gap))
    seconds = [(str(r["key"]) if keyed else "None", (r["session_start"] - EPOCH).total_seconds(),
                (r["session_end"] - EPOCH).total_seconds(), r["c"]) for r in found.collect()]
    assert sorted(seconds) == want


def test_session_gap_edge(spark):
    rows = [("a", 0, 1), ("a", 30, 1), ("a", 61, 1)]
    found = sessions.sessions(frame(spark, rows), "ts", "30 seconds", ["key"], {"c": count_rows()})
    assert sorted(r["c"] for r in found.collect()) == [1, 2]


@FEW
@given(ROWS, st.integers(0, 15), st.integers(0, 20), st.integers(1, 7))
def test_late(spark, rows, delay, lateness, width):
    size = 10
    marked = late.mark_late(frame(spark, rows), "ts", "arrival", f"{size} seconds",
                            delay=f"{delay} seconds", lateness=f"{lateness} seconds", width=width)
    aside = {r["arrival"] for r in late.late_side(marked).collect()}
    main = {r["arrival"] for r in late.on_time(marked).collect()}
    again = {r["arrival"]: r["so_far"] for r in
             late.refires(marked, ["key"], "arrival", width=width).collect()}
    highest_time, want_late, want_again, counts = None, set(), {}, defaultdict(int)
    for i, (k, s, _) in enumerate(rows):
        end = s // size * size + size
        mark = None if highest_time is None else highest_time - delay
        if mark is not None and end + lateness <= mark:
            want_late.add(i)
        else:
            counts[k, end] += 1
            if mark is not None and end <= mark:
                want_again[i] = counts[k, end]
        highest_time = s if highest_time is None else max(highest_time, s)
    assert aside == want_late and main == set(range(len(rows))) - want_late
    assert again == want_again


@FEW
@given(ROWS, st.integers(1, 30), st.integers(1, 7))
def test_too_close(spark, rows, within, width):
    found = patterns.too_close(frame(spark, rows), ["key"], "ts", "arrival", f"{within} seconds",
                               width=width)
    want = set()
    for group in by_key(rows).values():
        top = None
        for i, s, _ in group:
            if top is not None and abs(s - top) < within:
                want.add(i)
            top = s if top is None else max(top, s)
    assert {r["arrival"] for r in found.collect()} == want


@FEW
@given(ROWS, st.integers(1, 30), st.integers(1, 20))
def test_three_in_a_row(spark, rows, within, hot_rows):
    found = patterns.three_in_a_row(frame(spark, rows), ["key"], "ts", "arrival",
                                    f"{within} seconds", ["arrival"], hot_rows=hot_rows)
    want = set()
    for group in by_key(rows).values():
        order = sorted((s, i) for i, s, _ in group)
        want |= {(a[1], b[1], c[1]) for a, b, c in zip(order, order[1:], order[2:])
                 if c[0] - a[0] < within}
    assert {(r["first"]["arrival"], r["second"]["arrival"], r["third"]["arrival"])
            for r in found.collect()} == want


def test_three_in_a_row_edges(spark):
    exact = frame(spark, [("a", 0, 1), ("a", 5, 1), ("a", 10, 1)])
    assert patterns.three_in_a_row(exact, ["key"], "ts", "arrival", "10 seconds", ["arrival"]).count() == 0
    assert patterns.three_in_a_row(exact, ["key"], "ts", "arrival", "11 seconds", ["arrival"]).count() == 1


def test_too_close_edges(spark):
    rows = [("a", 0, 1), ("a", 10, 1), ("a", 10, 1), ("a", 1, 1)]
    found = patterns.too_close(frame(spark, rows), ["key"], "ts", "arrival", "10 seconds", width=2)
    assert sorted(r["arrival"] for r in found.collect()) == [2, 3]


@FEW
@given(ROWS, st.integers(1, 30))
def test_ttl_concat(spark, rows, ttl):
    # Arrival order is time order, as for processing time; ties stay in arrival order.
    rows = sorted(rows, key=lambda r: r[1])
    df = frame(spark, rows).withColumn("v", F.concat(F.col("arrival").cast("string"), F.lit(";")))
    found = histories.ttl_concat(df, ["key"], "ts", "arrival", "v", f"{ttl} seconds")
    want = {}
    for group in by_key(rows).values():
        for at, (i, s, _) in enumerate(group):
            want[i] = "".join(f"{j};" for j, t, _ in group[: at + 1] if t > s - ttl)
    assert {r["arrival"]: r["joined"] for r in found.collect()} == want


@FEW
@given(ROWS, ROWS, st.integers(0, 20), st.integers(0, 20))
def test_interval_join(spark, left, right, before, after):
    pairs = joins.interval_join(
        frame(spark, left).select("key", F.col("ts").alias("lt"), F.col("arrival").alias("l")),
        frame(spark, right).select("key", F.col("ts").alias("rt"), F.col("arrival").alias("r")),
        ["key"], "lt", "rt", f"{before} seconds", f"{after} seconds")
    want = sorted((i, j) for i, (k, s, _) in enumerate(left) for j, (q, t, _) in enumerate(right)
                  if k is not None and k == q and s - before <= t <= s + after)
    assert sorted((r["l"], r["r"]) for r in pairs.collect()) == want


@FEW
@given(ROWS, st.integers(1, 7))
def test_as_known(spark, rows, width):
    df = frame(spark, rows)
    updates = df.where("n >= 4").select("key", "arrival", F.col("n").alias("known"))
    events = df.where("n < 4 or n is null").select("key", "arrival")
    found = joins.as_known(events, updates, ["key"], "arrival", ["known"], width=width)
    want = {}
    for group in by_key(rows).values():
        known = None
        for i, _, v in group:
            if v is not None and v >= 4:
                known = v
            else:
                want[i] = known
    assert {r["arrival"]: r["known"] for r in found.collect()} == want


@FEW
@given(ROWS, st.integers(1, 7))
def test_marker_trigger(spark, rows, width):
    found = triggers.fire_on_marker(frame(spark, rows), ["key"], "ts", "arrival", "10 seconds",
                                    F.coalesce(F.col("n") == 0, F.lit(False)), width=width)
    want, counts = [], defaultdict(int)
    for i, (k, s, v) in enumerate(rows):
        counts[k, s // 10] += 1
        if v == 0:
            want.append((str(k), s // 10, i, counts[k, s // 10]))
    want += [(str(k), w, -1, n) for (k, w), n in counts.items()]
    got = [(str(r["key"]), (r["window_start"] - EPOCH).total_seconds() // 10,
            -1 if r["fired_by"] is None else r["fired_by"], r["count"]) for r in found.collect()]
    assert sorted(got) == sorted(want)


@FEW
@given(ROWS, st.integers(1, 10))
def test_evict(spark, rows, keep):
    kept = triggers.evict_older(frame(spark, rows), ["key"], "ts", "10 seconds", f"{keep} seconds")
    newest = defaultdict(int)
    for k, s, _ in rows:
        newest[k, s // 10] = max(newest[k, s // 10], s)
    want = {i for i, (k, s, _) in enumerate(rows) if s > newest[k, s // 10] - keep}
    assert {r["arrival"] for r in kept.collect()} == want


@FEW
@given(ROWS, st.integers(1, 7))
def test_running_row_with_max(spark, rows, width):
    rows = [(k, s, v or 0) for k, s, v in rows]
    df = frame(spark, rows).select("arrival", "key", "n")
    found = aggs.running_row_with_max(df, ["key"], "n", "arrival", ["n"], width=width)
    want, last = {}, {}
    for group in by_key(rows).values():
        best = None
        for i, _, v in group:
            best = (v, i) if best is None or v >= best[0] else best
            want[i] = best
        last[rows[group[0][0]][0]] = best
    assert {r["arrival"]: (r["best_n"], r["best_arrival"]) for r in found.collect()} == want
    final = aggs.row_with_max(df, ["key"], "n", "arrival")
    assert {r["key"]: (r["n"], r["arrival"]) for r in final.collect()} == last
