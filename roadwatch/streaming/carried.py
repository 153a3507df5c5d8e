"""State of streams as stored tables, worked on with the batch operators.

Each micro-batch takes what the batch before it left, and leaves its own. A state
table that has the step's key columns is cut into buckets by their hash, and a
batch reads and writes only the buckets that its own keys fall into: the work
follows the batch, not the keys ever seen. A small record per batch says which
batch wrote each bucket last, so a batch that runs again reads the same and writes
the same; what no later batch can read is deleted. No key is held by one task or
one Python list: the operators cut hot keys as they do on tables.

Where rows are only ever replaced by newer ones (``Step.newest``), a batch does not
write its buckets again: it adds a run with the rows of its own keys. Of each size
``RUNS - 1`` runs of a bucket stand beside each other and the next takes them in, so
a row is written again log(batches) times and a bucket has as many runs.

``buckets`` is fixed for a stream's life. A batch of m keys reads at most m
buckets; choose so many that a bucket holds some ten thousand keys.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from ..functions.times import duration_micros, from_micros, micros
from ..operators.joins import latest_per_key, lookup
from ..operators.running import KEYED_WIDTH, Agg, count_rows, highest, running_from
from ..operators.sessions import intervals, merged_intervals
from ..operators.windows import with_window
from ..session import names_in, read_text, remove_folder, run_dir, write_text
from .run import Writer, finish, start

BUCKETS = 16
WHOLE = -1  # the bucket of a table that is not cut
RUNS = 4  # runs of one size become one of the next


class State:
    """The tables that the batch before has left."""

    def __init__(self, spark: SparkSession, folder: str, record: dict, touched: set[int]):
        self._spark, self._folder, self._record, self._touched = spark, folder, record, touched

    def _read(self, name: str, wanted: Callable[[int], bool]) -> DataFrame:
        table = self._record[name]
        schema = StructType.fromJson(json.loads(table["schema"]))
        return _read_runs(self._spark, self._folder, name, schema, {
            bucket: runs for bucket, runs in table["buckets"].items() if wanted(int(bucket))})

    def __getitem__(self, name: str) -> DataFrame:
        """What the table holds of the batch's buckets; all of a table without the key.

        Tables under ``Step.newest`` may hold older rows beside the newest.
        """
        return self._read(name, lambda bucket: bucket == WHOLE or bucket in self._touched)

    def whole(self, name: str) -> DataFrame:
        """Every key's rows, for the rare batch that concerns keys it does not have."""
        return self._read(name, lambda bucket: True)


Run = Callable[[DataFrame, State | None], tuple]  # rows, state after by name, what to unpersist


@dataclass(frozen=True)
class Step:
    """``run(batch, state before it)`` gives the batch's rows and the state after it.

    For tables that are cut, the state after holds the keys of the batch's buckets and
    no others. ``close`` gives what is still open when the input has ended for good.
    ``newest`` names cut tables whose rows never go, only get newer: the columns that tell
    a row and the one that is higher in a newer row. The state after has just the new rows.
    What ``run`` gives besides it has persisted, and the writer lets it go.
    """

    run: Run
    key: Sequence[str] = ()
    close: Callable[[State], DataFrame] | None = None
    newest: Mapping[str, tuple[Sequence[str], str]] = field(default_factory=dict)

    def cuts(self, columns: Sequence[str]) -> bool:
        return bool(self.key) and set(self.key) <= set(columns)


def _bucket_path(folder: str, name: str, batch: int, bucket: int) -> str:
    return f"{folder}/state/{name}/{batch}/state_bucket={bucket}"


def _read_runs(spark: SparkSession, folder: str, name: str, schema: StructType,
               runs: Mapping[str, Sequence[tuple[int, int]]]) -> DataFrame:
    paths = [_bucket_path(folder, name, batch, int(bucket)) for bucket in sorted(runs) for batch, _ in runs[bucket]]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _taken_in(runs: Sequence[tuple[int, int]]) -> tuple[list, list, int]:
    """Of a bucket's runs, as (batch, size): those that stay, those the next run takes in, and its size."""
    stay, size = list(runs), 0
    while len(stay) >= RUNS - 1 and all(s == size for _, s in stay[1 - RUNS:]):
        stay, size = stay[:1 - RUNS], size + 1
    return stay, list(runs[len(stay):]), size


def _record_path(folder: str, batch_id: int) -> str:
    return f"{folder}/state/record-{batch_id}"


def _read_record(spark: SparkSession, folder: str, batch_id: int) -> dict | None:
    text = read_text(spark, _record_path(folder, batch_id))
    return None if text is None else json.loads(text)


def carried_writer(step: Step, folder: str, buckets: int = BUCKETS) -> Writer:
    """Run ``step`` on every batch; its rows go to ``out``, its state to ``state``."""
    bucket = F.pmod(F.xxhash64(*step.key), F.lit(buckets)).cast("int") if step.key else F.lit(WHOLE)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        persisted = []
        try:
            # At most as many numbers as there are buckets.
            touched = {r[0] for r in batch.select(bucket).distinct().collect()} if step.key else set()
            before = _read_record(spark, folder, batch_id - 1) if batch_id else {}
            rows, after, *persisted = step.run(batch, State(spark, folder, before, touched) if batch_id else None)
            rows.write.mode("overwrite").parquet(f"{folder}/out/batch_id={batch_id}")
            record = {}
            for name, table in after.items():
                cut = step.cuts(table.columns)
                path = f"{folder}/state/{name}/{batch_id}"
                held = before.get(name, {"buckets": {}})["buckets"]
                runs = {str(b): _taken_in(held.get(str(b), [])) for b in touched} if name in step.newest else {}
                if any(old for _, old, _ in runs.values()):
                    older = _read_runs(spark, folder, name, table.schema, {b: old for b, (_, old, _) in runs.items()})
                    table = latest_per_key(table.unionByName(older), *step.newest[name]).select(table.columns)
                (table.withColumn("state_bucket", bucket if cut else F.lit(WHOLE)).repartition("state_bucket")
                 .write.mode("overwrite").partitionBy("state_bucket").parquet(path))
                kept = {b: v for b, v in held.items() if cut and int(b) not in touched}
                written = {}
                for b in (n.removeprefix("state_bucket=") for n in names_in(spark, path, "state_bucket=*")):
                    stay, _, size = runs.get(b, ([], [], 0))
                    written[b] = [*stay, (batch_id, size)]
                record[name] = {"schema": table.schema.json(), "buckets": kept | written}
            write_text(spark, _record_path(folder, batch_id), json.dumps(record))
        finally:
            for df in (batch, *persisted):
                df.unpersist()
        if batch_id > 1:  # the batch before this one cannot run again
            _forget(spark, folder, batch_id - 2, before)
    return write


def _forget(spark: SparkSession, folder: str, batch_id: int, later: dict) -> None:
    """Delete what a batch left and the one after it replaced."""
    record = _read_record(spark, folder, batch_id)
    if record is None:  # an earlier run of the batch after it has done it
        return
    for name, table in record.items():
        held = later.get(name, {"buckets": {}})["buckets"]
        for bucket, runs in table["buckets"].items():
            for batch in {b for b, _ in runs} - {b for b, _ in held.get(bucket, [])}:
                remove_folder(spark, _bucket_path(folder, name, batch, int(bucket)))
    remove_folder(spark, _record_path(folder, batch_id))


def carried_table(stream: DataFrame, name: str, step: Step, folder: str | None = None,
                  buckets: int = BUCKETS, close: bool = False) -> DataFrame:
    """Run over all present input; the rows written, with their ``batch_id``.

    Pass the ``folder`` of an earlier run to go on from where it ended. ``close`` says
    that nothing more will come: what is still open is written too.
    """
    spark, own = stream.sparkSession, folder is None
    folder = folder or run_dir(spark, name)
    finish(start(stream, carried_writer(step, folder, buckets), f"{folder}/checkpoint"))
    left = [int(n.removeprefix("record-")) for n in names_in(spark, f"{folder}/state", "record-*")]
    if close and step.close and left:
        last = State(spark, folder, _read_record(spark, folder, max(left)), set())
        step.close(last).write.mode("overwrite").parquet(f"{folder}/out/batch_id={max(left) + 1}")
    if own:
        remove_folder(spark, f"{folder}/checkpoint")
        remove_folder(spark, f"{folder}/state")
    try:
        return spark.read.parquet(f"{folder}/out")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        none = spark.createDataFrame([], stream.schema)
        return step.run(none, None)[0].withColumn("batch_id", F.lit(0))


def count_windows(key: str | None, order: str, value: str, size: int) -> Step:
    """Every ``size`` rows of a key, or of all rows, make a window with the sum of ``value``; nulls count as rows."""
    keys = [key] if key else []

    def step(batch: DataFrame, before: State | None) -> tuple[DataFrame, dict]:
        rows, counts = running_from(batch, keys, order, {"rows": count_rows()}, before and before["counts"])
        windows = rows.select(*keys, F.floor((F.col("rows") - 1) / size).alias("window_no"),
                              F.lit(1).cast("long").alias("n"), F.col(value).cast("long").alias("total"))
        if before:
            windows = windows.unionByName(before["open"])
        windows = windows.groupBy(*keys, "window_no").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        return (windows.where(F.col("n") == size).drop("n"),
                {"counts": counts, "open": windows.where(F.col("n") < size)})
    return Step(step, keys)


def count_sliding(order: str, size: int, slide: int, aggs: Mapping[str, Agg]) -> Step:
    """Every ``slide`` rows of the whole stream, a window over the last ``size`` rows or fewer.

    Rows fold into panes of gcd(size, slide); the panes of the last ``size`` rows stay
    open. ``fired_at`` is the row count at the firing.
    """
    pane = math.gcd(size, slide)
    values = {n: f"v_{n}" for n in aggs}

    def folded() -> list[Column]:
        return [aggs[n].fold(c).alias(c) for n, c in values.items()]

    def step(batch: DataFrame, before: State | None) -> tuple[DataFrame, dict]:
        rows, seen = running_from(batch.withColumns({values[n]: a.column for n, a in aggs.items()}), [], order,
                                  {"rows": count_rows()}, before and before["seen"])
        # One row: how many rows the stream had before this batch.
        earlier = (before["seen"].first()["rows"] or 0) if before else 0
        panes = rows.select(F.floor((F.col("rows") - 1) / pane).alias("pane"), F.lit(1).cast("long").alias("n"),
                            *values.values())
        if before:
            panes = panes.unionByName(before["panes"])
        panes = panes.groupBy("pane").agg(F.sum("n").alias("n"), *folded())
        now = earlier + batch.count()
        first = F.ceil(F.greatest((F.col("pane") + 1) * pane, F.lit(earlier + 1)) / slide) * slide
        last = F.floor(F.least(F.col("pane") * pane + size, F.lit(now)) / slide) * slide
        fires = panes.where(first <= last).withColumn(
            "fired_at", F.explode(F.sequence(first, last, F.lit(slide).cast("long"))))
        fired = fires.groupBy("fired_at").agg(*folded()).select(
            "fired_at", *[aggs[n].result(F.col(c)).alias(n) for n, c in values.items()])
        return fired, {"seen": seen, "panes": panes.where(F.col("pane") * pane + size > now)}
    return Step(step)


def sessions(time: str, gap: str, delay: str, aggs: Mapping[str, Agg],
             clock: Callable[[], int] | None = None) -> Step:
    """Sessions of all rows together, closed when the watermark passes their end.

    Open sessions are kept as intervals with their partial aggregates. A batch's rows
    fold into cells of one gap before they meet them. Rows exactly one gap apart belong
    together. A row whose session, after merging, has ended before the watermark of the
    batches before it is late and dropped; rows without a time are in no session. With
    ``clock`` (microseconds) the time is that of the batch and ``time`` is not read.
    """
    gap_us, delay_us = duration_micros(gap), 0 if clock else duration_micros(delay)

    def shown(found: DataFrame) -> DataFrame:
        return found.select(from_micros(F.col("first")).alias("session_start"),
                            from_micros(F.col("last") + gap_us).alias("session_end"),
                            *[a.result(F.col(f"v_{n}")).alias(n) for n, a in aggs.items()])

    def step(batch: DataFrame, before: State | None) -> tuple[DataFrame, dict]:
        now = F.lit(clock()) if clock else micros(F.col(time))
        parts = intervals(batch, now, gap_us, aggs)
        seen = batch.agg(F.max(now).alias("highest"))
        # One number: the highest time of the batches before.
        earlier = before["seen"].first()["highest"] if before else None
        if before:
            parts = parts.unionByName(before["open"])
        seen = seen.select(F.greatest("highest", F.lit(earlier).cast("long")).alias("highest"))
        highest_now = seen.first()["highest"]
        merged = merged_intervals(parts, gap_us, aggs)
        ends = F.col("last") + gap_us
        if earlier is not None:
            merged = merged.where(ends > earlier - delay_us)
        passed = ends <= (F.lit(None) if highest_now is None else F.lit(highest_now - delay_us))
        done = F.coalesce(passed, F.lit(False))
        return shown(merged.where(done)), {"open": merged.where(~done), "seen": seen}
    return Step(step, close=lambda state: shown(state["open"]))


def late_refires(key: str, time: str, order: str, size: str, delay: str, lateness: str) -> Step:
    """Each row that comes when its window has ended, but within ``lateness``, fires the window again: its count.

    A window has ended for a batch when the highest time of the batches before it, minus
    ``delay``, has reached its end. Rows beyond ``lateness`` are dropped and windows
    beyond it forgotten; rows without a time are in no window.
    """
    lateness_us, delay_us = duration_micros(lateness), duration_micros(delay)
    window = [key, "window_start", "window_end"]

    def step(batch: DataFrame, before: State | None) -> tuple[DataFrame, dict]:
        # One number: the highest time of the batches before.
        earlier = before["seen"].first()["highest"] if before else None
        limit = None if earlier is None else earlier - delay_us
        rows = with_window(batch.where(F.col(time).isNotNull()), time, size).select(*window, order)
        end = micros(F.col("window_end"))
        if limit is not None:
            rows = rows.where(end + lateness_us > limit)
        counted, counts = running_from(rows, window, order, {"so_far": count_rows()}, before and before["counts"])
        seen = batch.agg(F.max(micros(F.col(time))).alias("highest")).select(
            F.greatest("highest", F.lit(earlier).cast("long")).alias("highest"))
        kept = counts if limit is None else counts.where(end + lateness_us > limit)
        again = F.lit(False) if limit is None else end <= limit
        return counted.where(again), {"counts": kept, "seen": seen}
    return Step(step, [key])


def close_to_highest(keys: Sequence[str], time: str, order: str, within: str) -> Step:
    """Rows less than ``within`` away from the highest earlier time of their key."""
    def step(batch: DataFrame, before: State | None) -> tuple[DataFrame, dict]:
        timed = batch.withColumn("time_us", micros(F.col(time)))
        rows, seen = running_from(timed, keys, order, {"previous_us": highest(F.col("time_us"))},
                                  before and before["seen"], inclusive=False)
        near = F.abs(F.col("time_us") - F.col("previous_us")) < duration_micros(within)
        return rows.where(near), {"seen": seen}
    return Step(step, keys)


def state_kinds(key: str, order: str, kind: str, value: str) -> Step:
    """Value, map, list, reducing and aggregating state over one key's rows.

    Per row: the running sum (reducing), the running average (aggregating), how
    many rows of its kind came so far (map), how many kinds (contains) and the
    last three values (list). A null value is none: it is left out of the sum,
    the average and the list.
    """
    so_far = ["rows", "total", "values", "kinds", "recent"]  # of the key, up to a row
    kept = "struct<rows:bigint,total:bigint,values:bigint,kinds:bigint,recent:array<bigint>>"

    def last(values: Column, n: int) -> Column:
        return F.slice(values, F.greatest(F.size(values) - (n - 1), F.lit(1)), n)

    def folded(batch: DataFrame, known: DataFrame | None) -> DataFrame:
        """The rows behind what is known of their keys: one shuffle, and windows inside a key."""
        rows = batch.select(key, kind, order, F.col(value).cast("long").alias("__v"), F.lit(1).alias("__row"),
                            F.lit(None).cast(kept).alias("__known"), F.lit(None).cast("long").alias("__of_kind"))
        if known is not None:
            rows = rows.unionByName(known.select(
                key, kind, F.lit(0).alias("__row"), F.struct(*so_far).cast(kept).alias("__known"),
                F.col("of_kind").alias("__of_kind")), allowMissingColumns=True)
        rows = rows.repartition(key).withColumn("__has", F.col("__v").isNotNull())
        of_kind = Window.partitionBy(key, kind).orderBy("__row", order).rowsBetween(Window.unboundedPreceding, 0)
        rows = rows.withColumn("of_kind", F.coalesce(F.max("__of_kind").over(of_kind), F.lit(0))
                               + F.sum("__row").over(of_kind))
        valued = Window.partitionBy(key, "__has").orderBy("__row", order, "of_kind")
        rows = rows.withColumn("__own", F.when(F.col("__has"), F.array_compact(F.array(
            F.lag("__v", 2).over(valued), F.lag("__v", 1).over(valued), F.col("__v")))))
        ordered = (Window.partitionBy(key).orderBy("__row", order, "of_kind")
                   .rowsBetween(Window.unboundedPreceding, 0))
        new = F.when((F.col("__row") == 1) & (F.col("of_kind") == 1), 1).otherwise(0)
        rows = rows.select(
            key, kind, order, "of_kind", "__row", F.max("__known").over(ordered).alias("__known"),
            F.sum("__row").over(ordered).alias("__rows"), F.sum("__v").over(ordered).alias("__total"),
            F.count("__v").over(ordered).alias("__values"), F.sum(new).over(ordered).alias("__kinds"),
            F.last("__own", ignorenulls=True).over(ordered).alias("__own")).where("__row = 1")

        def since(name: str) -> Column:
            return F.coalesce(F.col(f"__known.{name}"), F.lit(0)) + F.col(f"__{name}")
        none = F.array().cast("array<long>")
        return rows.select(
            key, kind, order, "of_kind", since("rows").alias("rows"),
            F.coalesce(F.col("__known.total") + F.col("__total"), "__known.total", "__total").alias("total"),
            since("values").alias("values"), since("kinds").alias("kinds"),
            last(F.concat(F.coalesce("__known.recent", none), F.coalesce("__own", none)), 3).alias("recent"))

    def newest(rows: DataFrame, recent: int) -> DataFrame:
        """Of each kind of the rows' keys the last row, and what the key held at it."""
        ended = rows.groupBy(key, kind).agg(F.max_by(F.struct("of_kind", *so_far), "rows").alias("__last"))
        return ended.select(key, kind, "__last.*").withColumn("recent", last(F.col("recent"), recent))

    def step(batch: DataFrame, before: State | None) -> tuple:
        known = None
        if before:
            mine = batch.select(F.col(key).alias("__key")).distinct()
            state = before["so_far"]
            known = state.join(mine, F.col(key).eqNullSafe(F.col("__key")), "left_semi")
        # A task takes a key's rows as a whole, so a larger batch goes part by part along the order.
        parts = math.ceil(batch.count() / KEYED_WIDTH)
        ends = [] if parts < 2 else sorted({int(e) for e in batch.approxQuantile(
            order, [i / parts for i in range(1, parts)], 0.1 / parts)})
        part = F.lit(0)
        for end in ends:
            part = part + F.when(F.col(order) > end, 1).otherwise(0)
        done = []
        for i in range(len(ends) + 1):
            done.append(folded(batch.where(part == i) if ends else batch, known).persist())
            if ends:
                then = newest(done[-1], 3)
                known = then if known is None else known.unionByName(then)
        rows, after = done[0], newest(done[0], 2)
        for more in done[1:]:
            rows, after = rows.unionByName(more), after.unionByName(newest(more, 2))
        return rows.select(
            key, order, "total", (F.col("total") / F.when(F.col("values") > 0, F.col("values"))).alias("average"),
            "of_kind", F.col("kinds").cast("int").alias("kinds"),
            F.array_join(F.transform("recent", lambda v: v.cast("string")), ",").alias("last_three"),
        ), {"so_far": after}, *done
    return Step(step, [key], newest={"so_far": ([key, kind], "rows")})


def upserted_dimension(is_update: Column, keys: Sequence[str], order: str,
                       payload: Mapping[str, Column]) -> Step:
    """Events with the dimension as it is when their micro-batch runs.

    The stream carries updates and events. A batch's updates come first: the last
    one of each key replaces what the table held, then the batch's events see it.
    """
    def step(batch: DataFrame, before: State | None) -> tuple[DataFrame, dict]:
        news = batch.where(is_update).select(
            *keys, F.col(order).alias("__version"), *[c.alias(n) for n, c in payload.items()])
        known = news if before is None else news.unionByName(before["dimension"])
        table = latest_per_key(known, keys, "__version").select(news.columns)
        events = batch.where(~is_update).drop(*[n for n in payload if n in batch.columns])
        return lookup(events, table.drop("__version"), keys), {"dimension": table}
    return Step(step, keys)


def changing_rules(is_rule: Column, area: str, key: str, order: str, threshold: str) -> Step:
    """Counts per key against its area's threshold, which rows of the stream set anew while it runs.

    A batch's rules come first: the last of each area holds from then on, under its
    order number as version. Then its events are counted. A key is told once when its
    count reaches the threshold in force (``reached``, with the event that did it), and
    when a new rule puts its count at or over the threshold that it was below before
    (``rule``, without an event). Keys of areas without a rule are counted all the same.
    """
    def step(batch: DataFrame, before: State | None) -> tuple[DataFrame, dict]:
        news = batch.where(is_rule).select(area, F.col(threshold).cast("long").alias("threshold"),
                                           F.col(order).alias("version"))
        known = news.unionByName(before["rules"]) if before else news
        rules = latest_per_key(known, [area], "version").select(area, "threshold", "version")
        events = batch.where(~is_rule).select(area, key, order)
        rows, counts = running_from(events, [area, key], order, {"count": count_rows()}, before and before["counts"])
        reached = lookup(rows, rules, [area]).where(F.col("count") == F.col("threshold")).select(
            F.lit("reached").alias("kind"), area, key, F.col(order).alias("arrival"), "count", "threshold", "version")
        if before is None or batch.where(is_rule).isEmpty():
            return reached, {"rules": rules, "counts": counts}
        # A new rule concerns keys that the batch may not have: this batch reads all counts, of its areas.
        old = before["rules"].select(area, F.col("threshold").alias("old"))
        changed = rules.join(news.select(area).distinct(), area, "left_semi").join(old, area, "left")
        over = before.whole("counts").join(changed, area).where(
            (F.col("count") >= F.col("threshold")) & ~F.coalesce(F.col("count") >= F.col("old"), F.lit(False)))
        told = over.select(F.lit("rule").alias("kind"), area, key, F.lit(None).cast("long").alias("arrival"),
                           "count", "threshold", "version")
        return reached.unionByName(told), {"rules": rules, "counts": counts}
    return Step(step, [key])
