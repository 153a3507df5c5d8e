"""Keyed state for what Spark's built-in streaming operators do not have.

All work inside ``transformWithStateInPandas`` with state in RocksDB. Keys are cut into
buckets by their hash, and the states of a bucket's keys are one value: a call and a few
messages to the state store per key and batch cost a thousand times a row's work. So they
are paid once per bucket and batch, and a batch reads and writes the buckets of its own
keys. Processors say what becomes of one key's rows. Names and types of the columns are
the caller's; a null value is nothing that came. Where state can live in a table,
``carried`` is the better place: it cuts hot keys.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import (
    BinaryType, BooleanType, DoubleType, FloatType, IntegerType, LongType, NumericType, StringType, StructField,
    StructType)

# Workers get the processors themselves, so they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _schema(*fields) -> StructType:
    return StructType([StructField(n, t) for n, t in fields])


_L, _S, _I = LongType(), StringType(), IntegerType()


KEY_BUCKETS = 1024
ROWS_AT_ONCE = 10_000


def _plain(value):
    """A pandas or numpy value as state takes it."""
    if value is None or value is pd.NA or value is pd.NaT or (isinstance(value, float) and np.isnan(value)):
        return None
    return value.item() if hasattr(value, "item") else value


def _column(values: pd.Series) -> list:
    if values.dtype.kind in "iub":
        return values.tolist()
    return [_plain(v) for v in values.tolist()]


def _rows(frame: pd.DataFrame, names: Sequence[str]) -> list[tuple]:
    return list(zip(*[_column(frame[n]) for n in names]))


def packed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Stand-ins for nulls, and which they are in a column ``absent``: a frame would turn whole
    numbers next to nulls into floats."""
    absent = F.concat(F.lit(""), *[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    return df.withColumns({"absent": absent, **{c: _filled(df, c) for c in columns}})


def _unpacked(rows: list[tuple], before: int) -> list[tuple]:
    """The rows of a packed frame: ``before`` columns without nulls, then the packed ones, then ``absent``."""
    return [(*r[:before], *[None if gone == "1" else v for v, gone in zip(r[before:-1], r[-1])]) for r in rows]


def _in_order(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda r: (r[0] is None, r[0]))


class _Processor:
    """What becomes of one key's rows.

    ``held`` is what the key's state holds, any values by name; the key is forgotten when it is
    empty. ``on_timer`` is called when the time of the stream has reached ``held["timer"]``, in
    milliseconds, and finds it taken out. ``now`` is that time.
    """

    #: The columns of the rows, besides the keys.
    columns: list[str]
    output: StructType

    def on_rows(self, key: tuple, held: dict, rows: list[tuple], now: int) -> Iterable[tuple]:
        raise NotImplementedError

    def on_timer(self, key: tuple, held: dict, now: int) -> Iterable[tuple]:
        return ()


class _Bucket(StatefulProcessor):
    """A processor for all keys of a bucket. One timer stands at the earliest of the keys' timers."""

    def __init__(self, processor: _Processor, keys: Sequence[str], time_mode: str):
        self.processor, self.keys, self.time_mode = processor, list(keys), time_mode

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("keys", _schema(("held", BinaryType()), ("timer", _L)))

    def close(self) -> None:
        pass

    def _now(self, timers) -> int:
        if self.time_mode == "none":
            return 0
        return (timers.getCurrentWatermarkInMs() if self.time_mode == "eventTime"
                else timers.getCurrentProcessingTimeInMs())

    def _read(self) -> tuple[dict, int | None]:
        found = self.state.get() if self.state.exists() else None
        return (pickle.loads(found[0]), found[1]) if found else ({}, None)

    def _write(self, held: dict, timer: int | None) -> None:
        """Leave the keys' states; ``timer`` is the bucket's timer as it stands."""
        earliest = min((h["timer"] for h in held.values() if "timer" in h), default=None)
        if earliest != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if earliest is not None:
                self.handle.registerTimer(earliest)
        if held:
            self.state.update((pickle.dumps(held, 5), earliest))
        else:
            self.state.clear()

    def _frames(self, rows: list[tuple]) -> Iterator[pd.DataFrame]:
        names = self.processor.output.fieldNames()
        for at in range(0, len(rows), ROWS_AT_ONCE):
            columns = zip(*rows[at:at + ROWS_AT_ONCE])
            yield pd.DataFrame({n: pd.Series(c, dtype=object) for n, c in zip(names, columns)})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        (held, timer), now, came, out = self._read(), self._now(timerValues), {}, []
        n = len(self.keys)
        for frame in rows:
            for row in _rows(frame, [*self.keys, *self.processor.columns]):
                came.setdefault(row[:n], []).append(row[n:])
        for one, new in came.items():
            state = held.setdefault(one, {})
            out += self.processor.on_rows(one, state, new, now)
            if not state:
                del held[one]
        self._write(held, timer)
        yield from self._frames(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        (held, _), now, out = self._read(), self._now(timerValues), []
        for one in [k for k, h in held.items() if h.get("timer", now + 1) <= now]:
            del held[one]["timer"]
            out += self.processor.on_timer(one, held[one], now)
            if not held[one]:
                del held[one]
        self._write(held, None)
        yield from self._frames(out)


class TextSoFar(_Processor):
    """All texts of the key up to each row, joined; nulls add nothing. With ``ttl_ms`` each is forgotten
    that long after it came."""

    def __init__(self, keys: Sequence[StructField], order: StructField, value: str, out: str = "joined",
                 ttl_ms: int | None = None):
        self.columns, self.ttl_ms = [order.name, value], ttl_ms
        self.output = StructType([*keys, order, StructField(out, _S)])

    def on_rows(self, key, held, rows, now):
        if self.ttl_ms:
            yield from self._expiring(key, held, rows, now)
            return
        joined = held.get("text", "")
        for order, value in _in_order(rows):
            if value is not None:
                joined += value
            yield (*key, order, joined)
        if joined:
            held["text"] = joined

    def _expiring(self, key, held, rows, now):
        texts = [t for t in held.get("texts", []) if t[0] > now]
        joined = "".join(v for _, v in texts)
        for order, value in _in_order(rows):
            if value is not None:
                joined += value
                texts.append((now + self.ttl_ms, value))
            yield (*key, order, joined)
        held.clear()
        if texts:
            held.update(texts=texts, timer=texts[-1][0])

    def on_timer(self, key, held, now):
        held.clear()  # it stands where the last text goes
        return ()


class ThreeInARow(_Processor):
    """Three rows of a key in event-time order within ``within_us``, overlaps allowed.

    Rows wait until the watermark has passed them; a key's timer stands at its
    earliest waiting row, or where the last rows can match nothing any more. A key
    without rows that can still match keeps no state.
    """

    def __init__(self, keys: Sequence[StructField], time_us: str, carry: Sequence[StructField],
                 within_us: int):
        self.within_us = within_us
        row = [StructField(time_us, _L), *carry]
        self.columns = [f.name for f in row]
        self.output = StructType([*keys, *[
            StructField(f"{place}_{f.name}", f.dataType) for place in ("first", "second", "third")
            for f in row]])

    @staticmethod
    def _after_ms(time_us: int) -> int:
        return time_us // 1000 + 1

    def on_rows(self, key, held, rows, now):
        new = [(int(r[0]), *r[1:]) for r in rows if r[0] is not None]
        if new:
            waiting = held.setdefault("waiting", [])
            waiting += new
            held["timer"] = max(self._after_ms(min(r[0] for r in waiting)), now + 1)
        return ()

    def on_timer(self, key, held, now):
        waiting = sorted(held.pop("waiting", []))
        due = [r for r in waiting if self._after_ms(r[0]) <= now]
        later, run = waiting[len(due):], held.pop("last_two", [])
        for row in due:
            run.append(row)
            if len(run) == 3:
                if row[0] - run[0][0] < self.within_us:
                    yield (*key, *run[0], *run[1], *run[2])
                run.pop(0)
        # What comes later has a time behind the watermark.
        run = [r for r in run if r[0] + self.within_us > now * 1000]
        if run:
            held["last_two"] = run
            held["timer"] = max((run[-1][0] + self.within_us) // 1000 + 1, now + 1)
        if later:
            held["waiting"] = later
            held["timer"] = max(self._after_ms(later[0][0]), now + 1)


class _OpenWindow(_Processor):
    """A key's window, the last column of the key, that stays open until the watermark of the rows has
    passed its end.

    The stream's own watermark lags by the window's size besides the delay, so
    that Spark hands over every row of a window that is still open. It has
    reached the window's start when the rows' watermark has reached its end.
    """

    def on_rows(self, key, held, rows, now):
        if now >= key[-1]:
            return
        held["timer"] = key[-1]
        yield from self.on_open(key, held, rows)

    def on_open(self, key: tuple, held: dict, rows: list[tuple]) -> Iterable[tuple]:
        raise NotImplementedError


class MarkerTrigger(_OpenWindow):
    """Per key and window: fires with the count at each marker row and at the window's end."""

    def __init__(self, keys: Sequence[StructField], order: StructField, marker: str):
        self.columns = [order.name, marker]
        self.output = StructType([*keys, StructField("window_start_ms", _L),
                                  StructField("fired_by", order.dataType), StructField("count", _L)])

    def on_open(self, key, held, rows):
        count = held.get("count", 0)
        for order, marker in _in_order(rows):
            count += 1
            if marker:
                yield (*key, order, count)
        held["count"] = count

    def on_timer(self, key, held, now):
        yield (*key, None, held.pop("count"))


class EvictingTrigger(_OpenWindow):
    """Per key and window: fires at each marker row and at the window's end over the rows that are
    newer than the newest one so far minus ``keep_us``: their count and the sum of a value.

    Rows are taken in the order they came. What is evicted before a firing stays evicted,
    so state holds the rows of ``keep_us`` and no others.
    """

    def __init__(self, keys: Sequence[StructField], order: StructField, marker: str, time_us: str, value: str,
                 keep_us: int):
        self.columns, self.keep_us = [order.name, marker, time_us, value], keep_us
        self.output = StructType([*keys, StructField("window_start_ms", _L), StructField("fired_by", order.dataType),
                                  StructField("count", _L), StructField("total", _L)])

    def _evicted(self, rows: list[tuple]) -> list[tuple]:
        newest = max(t for t, _ in rows)
        return [r for r in rows if r[0] > newest - self.keep_us]

    def _fired(self, key, by, rows: list[tuple]) -> tuple:
        values = [v for _, v in rows if v is not None]
        return (*key, by, len(rows), int(sum(values)) if values else None)

    def on_open(self, key, held, rows):
        kept = held.get("kept", [])
        for order, marker, time_us, value in _in_order(rows):
            kept.append((int(time_us), value))
            if marker:
                kept = self._evicted(kept)
                yield self._fired(key, order, kept)
        held["kept"] = self._evicted(kept)

    def on_timer(self, key, held, now):
        yield self._fired(key, None, held.pop("kept"))


class TopOfWindow(_OpenWindow):
    """Per key and window the ``n`` rows with the highest measure, at the window's end.

    State never holds more than ``n`` rows. Of equal rows the earlier one wins; a
    null measure comes last.
    """

    def __init__(self, keys: Sequence[StructField], measure: StructField, order: StructField,
                 carry: Sequence[StructField], n: int):
        self.n = n
        row = [measure, order, *carry]
        self.columns = [f.name for f in row]
        self.output = StructType([*keys, StructField("window_start_ms", _L), *row, StructField("rank", _I)])

    def on_open(self, key, held, rows):
        best = held.get("best", []) + rows
        held["best"] = sorted(best, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))[: self.n]
        return ()

    def on_timer(self, key, held, now):
        for rank, row in enumerate(held.pop("best"), 1):
            yield (*key, *row, rank)


def _filled(stream: DataFrame, key: str) -> Column:
    """A stand-in for null that any type has."""
    kind = stream.schema[key].dataType
    if isinstance(kind, NumericType):
        return F.coalesce(key, F.lit(0).cast(kind))
    if isinstance(kind, BooleanType):
        return F.coalesce(key, F.lit(False))
    empty = "" if isinstance(kind, (StringType, BinaryType)) else "1970-01-01 00:00:00"
    return F.coalesce(key, F.lit(empty).cast(kind))


def _told(stream: DataFrame, key: str) -> tuple[Column, Column]:
    """A key without nulls and NaN, which differs from itself, and which of them it was."""
    kind, told = stream.schema[key].dataType, F.when(F.col(key).isNull(), "1")
    if isinstance(kind, (FloatType, DoubleType)):
        # A sum, since 0.0 and -0.0 are one key.
        return ((F.nanvl(_filled(stream, key), F.lit(0).cast(kind)) + F.lit(0).cast(kind)).cast(kind),
                told.when(F.isnan(key), "2").otherwise("0"))
    return _filled(stream, key), told.otherwise("0")


def keyed(stream: DataFrame, keys: list[str], processor: _Processor, time_mode: str = "none",
          output_mode: str = "append") -> DataFrame:
    """Apply a processor per key. ``time_mode``: none, processingTime or eventTime.

    Null keys are one key, NaN is another: they go in under a stand-in, and a first key column
    says which they are.
    """
    parts = {k: _told(stream, k) for k in keys}
    told = stream.withColumns({**{k: filled for k, (filled, _) in parts.items()},
                               "nulls": F.concat(*[which for _, which in parts.values()])})
    bucket = F.pmod(F.xxhash64("nulls", *keys), F.lit(KEY_BUCKETS)).cast("int")
    processor.output = StructType([StructField("nulls", _S), *processor.output.fields])
    found = told.withColumn("key_bucket", bucket).groupBy("key_bucket").transformWithStateInPandas(
        statefulProcessor=_Bucket(processor, ["nulls", *keys], time_mode), outputStructType=processor.output,
        outputMode=output_mode, timeMode=time_mode)

    def shown(key: str, place: int) -> Column:
        which, value = F.substring("nulls", place, 1), F.when(F.substring("nulls", place, 1) == "0", F.col(key))
        kind = stream.schema[key].dataType
        return value.when(which == "2", F.lit("NaN").cast(kind)) if isinstance(kind, (FloatType, DoubleType)) else value
    return found.withColumns({k: shown(k, i) for i, k in enumerate(keys, 1)}).drop("nulls")
