"""Aggregates in the user's own parts: create, add, merge, result.

Every task folds its rows into one state per key, in Arrow batches; states, not
rows, are shuffled and merged by key. A hot key sends one state per task. The same
parts serve groups, time windows and sessions. Spark's own aggregates stay the
better choice wherever they can say the same.
"""

from __future__ import annotations

import math
import pickle
import sys
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, StructField, StructType

from ..functions.times import duration_micros, from_micros, micros
from .running import bucket_of
from .windows import with_window

cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATES_AT_ONCE = 50_000  # keys a task holds before it passes their states on
ROWS_AT_ONCE = 4096
STATE = "agg_state"


class Aggregate:
    """The parts of an aggregate. A state is any value that pickles; its size is the user's to bound."""

    #: Names and types of the result, as DDL.
    result_type = ""

    def create(self):
        raise NotImplementedError

    def add(self, state, *values):
        """The state with one row's values."""
        raise NotImplementedError

    def add_all(self, state, columns: list[pa.Array]):
        """The state with many rows; override where columns can be taken at once."""
        for values in zip(*(c.to_pylist() for c in columns)):
            state = self.add(state, *values)
        return state

    def add_groups(self, states: list, columns: list[pa.Array], cuts: list[int]) -> list:
        """Many states, each with its rows: those from its cut to the next. Override where groups are small."""
        return [self.add_all(state, [c.slice(low, high - low) for c in columns])
                for state, low, high in zip(states, cuts, cuts[1:])]

    def merge(self, one, other):
        raise NotImplementedError

    def result(self, state) -> tuple:
        raise NotImplementedError


def _codes(columns: list[pa.Array]) -> np.ndarray:
    """One number per row, equal where all columns are, nulls included."""
    codes = np.zeros(len(columns[0]) if columns else 0, np.int64)
    for column in columns:
        coded = column.dictionary_encode(null_encoding="encode")
        codes = np.unique(codes * (len(coded.dictionary) + 1) + coded.indices.to_numpy(), return_inverse=True)[1]
    return codes


def _arrow(schema: StructType) -> pa.Schema:
    return to_arrow_schema(schema)


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS_AT_ONCE:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _folding(aggregate: Aggregate, n_keys: int, schema: pa.Schema):
    def run(batches):
        states: dict[tuple, object] = {}

        def shown():
            return _batches(((*key, pickle.dumps(state, 5)) for key, state in states.items()), schema)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, values = batch.columns[:n_keys], batch.columns[n_keys:]
            codes = _codes(keys) if keys else np.zeros(batch.num_rows, np.int64)
            order = np.argsort(codes, kind="stable")
            cuts = [0, *(np.flatnonzero(np.diff(codes[order])) + 1).tolist(), batch.num_rows]
            firsts = pa.array(order[cuts[:-1]])
            found = list(zip(*(c.take(firsts).to_pylist() for c in keys))) if keys else [()]
            before = [states[key] if key in states else aggregate.create() for key in found]
            placed = [v.take(pa.array(order)) for v in values]
            states.update(zip(found, aggregate.add_groups(before, placed, cuts)))
            if len(states) > STATES_AT_ONCE:
                yield from shown()
                states = {}
        yield from shown()
    return run


def _merging(aggregate: Aggregate, n_keys: int, schema: pa.Schema, finish: bool):
    def rows(batches):
        now, state = None, None
        for batch in batches:
            for *key, packed in zip(*(c.to_pylist() for c in batch.columns)):
                other = pickle.loads(packed)
                if key == now:
                    state = aggregate.merge(state, other)
                    continue
                if now is not None:
                    yield (*now, *(aggregate.result(state) if finish else (pickle.dumps(state, 5),)))
                now, state = key, other
        if now is not None:
            yield (*now, *(aggregate.result(state) if finish else (pickle.dumps(state, 5),)))

    def run(batches):
        return _batches(rows(batches), schema)
    return run


def folded(df: DataFrame, keys: Sequence[str], aggregate: Aggregate, *columns: str) -> DataFrame:
    """The keys and a state in ``agg_state``, one row per key and task or so."""
    used = df.select(*keys, *columns)
    schema = StructType([*used.schema.fields[:len(keys)], StructField(STATE, BinaryType())])
    return used.mapInArrow(_folding(aggregate, len(keys), _arrow(schema)), schema)


def merged(states: DataFrame, keys: Sequence[str], aggregate: Aggregate, finish: bool = True) -> DataFrame:
    """States merged by key: their results, or again states."""
    used = states.select(*keys, STATE)
    result = StructType.fromDDL(aggregate.result_type) if finish else [used.schema[STATE]]
    schema = StructType([*used.schema.fields[:len(keys)], *result])
    # Without keys there is one state a task, and one group.
    placed = used.repartition(*keys).sortWithinPartitions(*keys) if keys else used.coalesce(1)
    return placed.mapInArrow(_merging(aggregate, len(keys), _arrow(schema), finish), schema)


def aggregated(df: DataFrame, keys: Sequence[str], aggregate: Aggregate, *columns: str) -> DataFrame:
    """The aggregate of ``columns`` per key. Null keys are one key; no rows give no group."""
    return merged(folded(df, keys, aggregate, *columns), keys, aggregate)


def windowed(df: DataFrame, keys: Sequence[str], time: str, size: str, slide: str | None,
             aggregate: Aggregate, *columns: str) -> DataFrame:
    """Per key and time window; rows fold into their windows before anything is shuffled."""
    return aggregated(with_window(df, time, size, slide), [*keys, "window_start", "window_end"], aggregate, *columns)


def in_sessions(df: DataFrame, keys: Sequence[str], time: str, gap: str, aggregate: Aggregate,
                *columns: str) -> DataFrame:
    """Per key and session: rows fold into cells of one gap, cells into sessions."""
    keys, gap_us = list(keys), duration_micros(gap)
    timed = df.where(F.col(time).isNotNull()).withColumn("agg_t", micros(F.col(time))).withColumn(
        "agg_cell", bucket_of(F.col("agg_t"), gap_us))
    cells = timed.groupBy(*keys, "agg_cell").agg(F.min("agg_t").alias("agg_first"), F.max("agg_t").alias("agg_last"))
    order = Window.partitionBy(*keys).orderBy("agg_cell")
    opens = F.coalesce(F.col("agg_first") - F.lag("agg_last").over(order) > gap_us, F.lit(True))
    numbered = cells.withColumn("agg_opens", opens.cast("int")).withColumn(
        "agg_session", F.sum("agg_opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = Window.partitionBy(*keys, "agg_session")
    placed = numbered.select(*[F.col(k).alias(f"agg_{k}") for k in keys], F.col("agg_cell").alias("agg_of"),
                             F.min("agg_first").over(whole).alias("agg_start"),
                             F.max("agg_last").over(whole).alias("agg_end"))
    states = folded(timed, [*keys, "agg_cell"], aggregate, *columns)
    same = F.col("agg_cell") == F.col("agg_of")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"agg_{k}"))
    joined = states.join(placed, same).select(
        *keys, from_micros(F.col("agg_start")).alias("session_start"),
        from_micros(F.col("agg_end") + gap_us).alias("session_end"), STATE)
    return merged(joined, [*keys, "session_start", "session_end"], aggregate)


class AverageOfPairs(Aggregate):
    """(count, sum) pairs; nulls count for nothing."""

    result_type = "average double"

    def create(self):
        return 0, 0

    def add(self, state, value):
        return state if value is None else (state[0] + 1, state[1] + value)

    def merge(self, one, other):
        return one[0] + other[0], one[1] + other[1]

    def result(self, state):
        count, total = state
        return (total / count if count else None,)


class Quantiles(Aggregate):
    """A sketch of positive numbers in buckets of growing width, after Masson, Rim and Lee (2019).

    A quantile lies within ``error`` of the true one, as a share of it. States merge by
    adding counts and hold at most one number per bucket: some two thousand from a
    millionth to a million at one per cent. Numbers up to zero share a bucket; nulls count
    for nothing.
    """

    def __init__(self, quantiles: Sequence[float], error: float = 0.01):
        self.quantiles, self.gamma = list(quantiles), (1 + error) / (1 - error)
        self.result_type = "n long, " + ", ".join(f"q{round(q * 100)} double" for q in quantiles)

    def create(self):
        return Counter()

    def _buckets(self, values: np.ndarray) -> np.ndarray:
        buckets = np.full(len(values), -(1 << 40), np.int64)
        above = values > 0
        buckets[above] = np.ceil(np.log(values[above]) / math.log(self.gamma)).astype(np.int64)
        return buckets

    def add_all(self, state, columns):
        buckets = self._buckets(columns[0].drop_null().to_numpy(zero_copy_only=False).astype(float))
        state.update(dict(zip(*(x.tolist() for x in np.unique(buckets, return_counts=True)))))
        return state

    def add_groups(self, states, columns, cuts):
        present = columns[0].is_valid().to_numpy(zero_copy_only=False)
        buckets = self._buckets(columns[0].drop_null().to_numpy(zero_copy_only=False).astype(float)).tolist()
        places = np.concatenate([[0], np.cumsum(present)])[cuts].tolist()
        for state, low, high in zip(states, places, places[1:]):
            for bucket in buckets[low:high]:
                state[bucket] += 1
        return states

    def merge(self, one, other):
        one.update(other)
        return one

    def result(self, state):
        n, found, buckets = sum(state.values()), [], sorted(state)
        for q in self.quantiles:
            rank, seen, answer = math.floor(q * (n - 1)), 0, None
            for bucket in buckets:
                seen += state[bucket]
                if seen > rank:
                    answer = 0.0 if bucket < -(1 << 39) else 2 * self.gamma ** bucket / (self.gamma + 1)
                    break
            found.append(answer)
        return (n, *found)


def user_function(make: Callable, add: Callable, merge: Callable, result: Callable, result_type: str) -> Aggregate:
    """An aggregate from four functions."""
    made = Aggregate()
    made.create, made.add, made.merge, made.result, made.result_type = make, add, merge, result, result_type
    return made
