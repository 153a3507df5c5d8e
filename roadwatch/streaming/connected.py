"""Two streams that meet: within an interval of time, or in the state of one key."""

from __future__ import annotations

import heapq
import sys
from collections import deque
from collections.abc import Iterator, Mapping, Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.times import duration_micros, micros
from .processors import _I, _L, _Processor, _schema, _unpacked, keyed, packed
from .run import with_event_time

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def interval_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str,
                  before: str, after: str, delay: str) -> DataFrame:
    """Pairs of one key with ``right_time`` in [left - before, left + after].

    Both sides have a watermark and the condition bounds the distance of their times, so
    Spark drops a row from the state once no row of the other side can still meet it.
    Columns besides the keys must differ in name; null keys meet nothing.
    """
    names = {k: f"__right_{k}" for k in keys}
    a = with_event_time(left, left_time, delay)
    b = with_event_time(right, right_time, delay).withColumnsRenamed(names)

    def span(duration: str):
        return F.expr(f"INTERVAL '{duration_micros(duration) / 1e6:.6f}' SECOND")
    near = (F.col(right_time) >= F.col(left_time) - span(before)) & (
        F.col(right_time) <= F.col(left_time) + span(after))
    for key, name in names.items():
        near = near & (F.col(key) == F.col(name))
    return a.join(b, near).drop(*names.values())


class TwoInputs(_Processor):
    """Rows of two inputs on the state of one key, in the order of time.

    Subclasses say what a row of either side does, and what a time that was asked for
    does; they keep what they must in ``lists`` and call ``wake``. Rows wait until the
    watermark has passed them and are then taken by time, left before right, so the
    result does not depend on how the streams were cut. All methods yield output rows
    without the key.
    """

    #: Names of the state's lists, each with the fields of its rows.
    lists: Mapping[str, StructType] = {}

    def __init__(self, keys: Sequence[StructField], left: Sequence[StructField], right: Sequence[StructField],
                 output: Sequence[StructField]):
        fields = [*left, *[f for f in right if f.name not in {l.name for l in left}]]
        self.sides = ([f.name for f in left], [f.name for f in right])
        self._row = StructType([StructField("time_us", _L), StructField("side", _I), *fields])
        self.carried = [f.name for f in fields]
        self.columns = [*self._row.fieldNames(), "absent"]
        self.output = StructType([*keys, *output])

    def on_left(self, time_us: int, row: dict) -> Iterator[tuple]:
        raise NotImplementedError

    def on_right(self, time_us: int, row: dict) -> Iterator[tuple]:
        raise NotImplementedError

    def on_time(self, time_us: int) -> Iterator[tuple]:
        raise NotImplementedError

    def wake(self, time_us: int) -> None:
        """Call ``on_time`` when time has reached this, before any row of that time or a later one."""
        if time_us not in self._known:
            self._known.add(time_us)
            heapq.heappush(self._asked, time_us)

    def on_rows(self, key, held, rows, now):
        new = _unpacked(rows, 2)
        held.setdefault("waiting", []).extend(new)
        first = max(min(r[0] for r in new) // 1000 + 1, now + 1)
        held["timer"] = min(first, held.get("timer", first))
        return ()

    def on_timer(self, key, held, now):
        names = self._row.fieldNames()
        waiting = sorted(held.pop("waiting", []),
                         key=lambda r: (r[0], r[1], tuple((v is not None, v) for v in r[2:])))
        due = deque(r for r in waiting if r[0] // 1000 + 1 <= now)
        later = waiting[len(due):]
        self._asked = held.pop("asked", [])
        self._known = set(self._asked)
        self.held = {name: held.pop(name, []) for name in self.lists}
        while True:
            at = self._asked[0] if self._asked and self._asked[0] // 1000 + 1 <= now else None
            if at is not None and (not due or at <= due[0][0]):
                self._known.remove(heapq.heappop(self._asked))
                for row in self.on_time(at):
                    yield (*key, *row)
            elif due:
                values = dict(zip(names, due.popleft()))
                time_us, side = values.pop("time_us"), values.pop("side")
                row = {n: values[n] for n in self.sides[side]}
                for found in (self.on_right if side else self.on_left)(time_us, row):
                    yield (*key, *found)
            else:
                break
        left = {"waiting": later, "asked": sorted(self._asked), **self.held}
        held.update({name: rows for name, rows in left.items() if rows})
        times = [r[0] for r in later] + self._asked
        if times:
            held["timer"] = max(min(times) // 1000 + 1, now + 1)


def co_process(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str,
               delay: str, processor: TwoInputs) -> DataFrame:
    """Both inputs through one processor per key; rows without a time are left out."""
    def side(df: DataFrame, time: str, number: int) -> DataFrame:
        timed = with_event_time(df, time, delay).where(F.col(time).isNotNull())
        return timed.select(*keys, F.col(time).alias("event_time"), micros(F.col(time)).alias("time_us"),
                            F.lit(number).alias("side"), *[F.col(c) for c in processor.sides[number]])
    both = side(left, left_time, 0).unionByName(side(right, right_time, 1), allowMissingColumns=True)
    return keyed(packed(both, processor.carried), list(keys), processor, "eventTime")


class Settlement(TwoInputs):
    """Orders and payments of one customer, matched with a time limit on both sides.

    A payment settles all orders that wait for one. An order waits ``order_us``, then it
    is unpaid. A payment that settles nothing waits ``payment_us`` for the next order,
    which it is early for, and has no order after that.
    """

    def __init__(self, keys: Sequence[StructField], order: StructField, payment: StructField, order_us: int,
                 payment_us: int):
        self.order, self.payment, self.limits = order.name, payment.name, (order_us, payment_us)
        self.lists = {"orders": StructType([StructField("time_us", _L), order]),
                      "payments": StructType([StructField("time_us", _L), payment])}
        text = _schema(("kind", StringType())).fields
        super().__init__(keys, [order], [payment], [*text, order, payment])

    def on_left(self, time_us: int, row: dict) -> Iterator[tuple]:
        number = row[self.order]
        for _, payment in self.held["payments"]:
            yield "early", number, payment
        self.held["payments"] = []
        self.held["orders"].append((time_us, number))
        self.wake(time_us + self.limits[0])

    def on_right(self, time_us: int, row: dict) -> Iterator[tuple]:
        number = row[self.payment]
        for _, order in self.held["orders"]:
            yield "paid", order, number
        if not self.held["orders"]:
            self.held["payments"].append((time_us, number))
            self.wake(time_us + self.limits[1])
        self.held["orders"] = []

    def on_time(self, time_us: int) -> Iterator[tuple]:
        late = [r for r in self.held["orders"] if r[0] + self.limits[0] <= time_us]
        alone = [r for r in self.held["payments"] if r[0] + self.limits[1] <= time_us]
        self.held["orders"] = self.held["orders"][len(late):]
        self.held["payments"] = self.held["payments"][len(alone):]
        for _, order in late:
            yield "unpaid", order, None
        for _, payment in alone:
            yield "no order", None, payment


def settled(orders: DataFrame, payments: DataFrame, key: str, order: str, payment: str, order_time: str,
            payment_time: str, order_wait: str, payment_wait: str, delay: str) -> DataFrame:
    """``Settlement`` of two streams: key, kind (paid, unpaid, early, no order), order, payment."""
    def field(df: DataFrame, name: str) -> StructField:
        return StructField(name, df.schema[name].dataType)
    processor = Settlement([field(orders, key)], field(orders, order), field(payments, payment),
                           duration_micros(order_wait), duration_micros(payment_wait))
    return co_process(orders, payments, [key], order_time, payment_time, delay, processor)
