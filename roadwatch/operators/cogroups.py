"""Co-groups: a function over both full sides of a key, which stream through a task.

Both inputs are shuffled and sorted as one, by key and then by a common order, and
the function gets two iterators that draw from that one stream. What one of them
passes over waits for the other, so a function that goes along both sides in order
holds next to nothing, however large the group; one that reads a whole side first
holds the other. A group is one task's work by what the function asks for; where a
join or an aggregate can say the same, ``joins`` spreads the group.
"""

from __future__ import annotations

import sys
from collections import deque
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from .user_aggregates import _arrow, _batches
from .windows import with_window

cloudpickle.register_pickle_by_value(sys.modules[__name__])

Function = Callable[[tuple, Iterator[dict], Iterator[dict]], Iterator[tuple]]


class _Sides:
    """Two iterators over one stream of (key, side, row) as long as the key stays."""

    def __init__(self, stream: Iterator[tuple], first: tuple):
        self._stream, self.key = stream, first[0]
        self.following, self.ended = None, False
        self._held: tuple[deque, deque] = deque(), deque()
        self._held[first[1]].append(first[2])

    def _draw(self) -> bool:
        """Take one more row of the group in; False at its end."""
        if self.ended:
            return False
        row = next(self._stream, None)
        if row is None or row[0] != self.key:
            self.following, self.ended = row, True
            return False
        self._held[row[1]].append(row[2])
        return True

    def side(self, number: int) -> Iterator[dict]:
        held = self._held[number]
        while held or self._draw():
            if held:
                yield held.popleft()

    def drain(self) -> tuple | None:
        """The first row of the next group."""
        while self._draw():
            for held in self._held:
                held.clear()
        return self.following


def _grouped(function: Function, n_keys: int, schema: pa.Schema):
    def stream(batches):
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for *key, _, side, left, right in zip(*columns):
                yield tuple(key), side, right if side else left

    def rows(batches):
        source = stream(batches)
        first = next(source, None)
        while first is not None:
            group = _Sides(source, first)
            for row in function(group.key, group.side(0), group.side(1)):
                yield (*group.key, *row)
            first = group.drain()

    def run(batches):
        return _batches(rows(batches), schema)
    return run


def cogroup(left: DataFrame, right: DataFrame, keys: Sequence[str], order: str, function: Function,
            output: str) -> DataFrame:
    """``function(key, left rows, right rows)`` per key of either side; it yields rows of ``output`` (DDL).

    Rows come as dictionaries of their columns, in ``order``, which both sides have with
    one type; of equal ones the left side first. Null keys are one key, one-sided groups
    have an empty other side, and the result has the keys before the output. Two empty
    inputs give no row.
    """
    def side(df: DataFrame, number: int) -> DataFrame:
        mine = [c for c in df.columns if c not in keys]
        other = right if number == 0 else left
        rest = StructType([f for f in other.schema.fields if f.name not in keys])
        held, empty = F.struct(*mine), F.lit(None).cast(rest)
        return df.select(*keys, F.col(order).alias("cogroup_order"), F.lit(number).alias("cogroup_side"),
                         *([held.alias("l"), empty.alias("r")] if number == 0 else [empty.alias("l"), held.alias("r")]))
    both = side(left, 0).unionByName(side(right, 1))
    placed = both.repartition(*keys).sortWithinPartitions(*keys, "cogroup_order", "cogroup_side")
    schema = StructType([*both.schema.fields[:len(keys)], *StructType.fromDDL(output).fields])
    return placed.mapInArrow(_grouped(function, len(keys), _arrow(schema)), schema)


def window_cogroup(left: DataFrame, right: DataFrame, keys: Sequence[str], time: str, size: str,
                   function: Function, output: str, slide: str | None = None) -> DataFrame:
    """``cogroup`` per key and time window, both sides in the order of time."""
    group = [*keys, "window_start", "window_end"]
    return cogroup(with_window(left, time, size, slide), with_window(right, time, size, slide), group, time,
                   function, output)


def aligned(each: str, counted: str, value: str) -> Function:
    """Along both sides: per left row its ``each``, how many right rows came since the left row before it,
    and the last of their ``value``; right rows behind the last left row come as one more row."""
    def run(key: tuple, left: Iterator[dict], right: Iterator[dict]) -> Iterator[tuple]:
        row = next(right, None)
        for here in left:
            n, last = 0, None
            while row is not None and row[counted] < here[counted]:
                n, last = n + 1, row[value]
                row = next(right, None)
            yield here[each], n, last
        n, last = 0, None
        while row is not None:
            n, last = n + 1, row[value]
            row = next(right, None)
        if n:
            yield None, n, last
    return run
