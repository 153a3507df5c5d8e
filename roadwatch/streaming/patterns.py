"""Sequences of events on streams: the automaton of ``operators.sequences``, row by row.

Rows of a key wait until the watermark has passed them, so they are taken in the
order of time whatever micro-batch brought them. Partial matches share the rows
they hold: state keeps each row once and partial matches as lists of its number.
What can no longer end in time is dropped, and a key without anything open keeps
no state.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from ..functions.times import micros
from ..operators.sequences import Line, Pattern
from .processors import _L, _Processor, _unpacked, keyed, packed
from .run import with_event_time

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Sequences(_Processor):
    """All matches of a pattern within ``within_us``; per match and step a list of its rows."""

    def __init__(self, keys: Sequence[StructField], carry: Sequence[StructField], order: StructField,
                 steps: Sequence[str], lines: Sequence[Line], within_us: int):
        self.lines = [(line.counts, [(e.condition, e.how, e.guard, e.guarded) for e in line.elements])
                      for line in lines]
        self.within_us = within_us
        self.carry = [f.name for f in carry]
        self.columns = ["time_us", "order_no", "fits", *self.carry, "absent"]
        found = ArrayType(StructType([StructField("time_us", _L), *carry]))
        self.output = StructType([*keys, *[StructField(s, found) for s in steps]])

    def on_rows(self, key, held, rows, now):
        new = _unpacked(rows, 3)
        held.setdefault("waiting", []).extend(new)
        first = max(min(r[0] for r in new) // 1000 + 1, now + 1)
        held["timer"] = min(first, held.get("timer", first))
        return ()

    def _advance(self, partial, fits: int, number: int):
        """What becomes of a partial match at a row: the partial matches it leaves."""
        line, at, fresh, held = partial
        condition, how, guard, guarded = self.lines[line][1][at]
        matches = fits >> condition & 1
        if how == "next":
            return [(line, at + 1, True, [*held, number])] if fresh and matches else []
        if guard is not None and fits >> guard & 1:
            if guarded == "next" and fresh:
                return []
            if guarded == "between" and not matches:
                return []
        if how == "never":
            return [] if matches else [(line, at, False, held)]
        left = [(line, at + 1, True, [*held, number])] if matches else []
        if not matches or (how == "any" and not (guard is not None and guarded == "between" and fits >> guard & 1)):
            left.append((line, at, False, held))
        return left

    def on_timer(self, key, held, now):
        number = held.pop("next_no", 0)
        waiting = sorted(held.pop("waiting", []), key=lambda r: r[:2])
        due = [r for r in waiting if r[0] // 1000 + 1 <= now]
        later = waiting[len(due):]
        rows, partials = held.pop("rows", {}), held.pop("open", [])
        out = []

        def emit(line, held):
            counts, at, result = self.lines[line][0], 0, []
            for count in counts:
                result.append([dict(zip(["time_us", *self.carry], rows[n])) for n in held[at:at + count]])
                at += count
            out.append((*key, *result))

        def too_old(partials, time_us):
            """Those that still can end by then; a negation that has held till the end is a match."""
            for line, at, fresh, held in partials:
                if time_us - rows[held[0]][0] < self.within_us:
                    yield line, at, fresh, held
                elif self.lines[line][1][at][1] == "never":
                    emit(line, held)

        for time_us, _, fits, *carried in due:
            left = []
            rows[number] = (time_us, *carried)
            candidates = list(too_old(partials, time_us))
            for partial in candidates:
                left += self._advance(partial, fits, number)
            for line, (_, elements) in enumerate(self.lines):
                if fits >> elements[0][0] & 1:
                    left.append((line, 1, True, [number]))
            partials = []
            for line, at, fresh, taken in left:
                if at == len(self.lines[line][1]):
                    emit(line, taken)
                else:
                    partials.append((line, at, fresh, taken))
            number += 1
        # What comes later has a time behind the watermark.
        partials = list(too_old(partials, now * 1000))
        used = {n for *_, taken in partials for n in taken}
        left = {"waiting": later, "open": partials, "rows": {n: rows[n] for n in sorted(used)}}
        held.update({name: what for name, what in left.items() if what})
        ends = [(rows[taken[0]][0] + self.within_us) // 1000 + 1 for *_, taken in partials]
        wake = min([r[0] // 1000 + 1 for r in later] + ends, default=None)
        if wake is not None:
            held.update(next_no=number, timer=max(wake, now + 1))
        return out


def match(events: DataFrame, pattern: Pattern, keys: Sequence[str], time: str, order: str, delay: str,
          carry: Sequence[str] = ()) -> DataFrame:
    """The stream form of ``operators.sequences.match``, in append mode.

    A match is given once the watermark has passed its last row; for a pattern that
    ends in a negation, its time. Per step an array of structs, for single steps one
    struct. The pattern needs ``within``; of the skip strategies only ``none`` does
    not wait for other matches, so it is the one a stream takes.
    """
    if pattern.span_us is None or pattern.skipping != "none":
        raise ValueError("on a stream a pattern needs within() and takes all matches")
    if set(carry) & set(keys):
        raise ValueError("the keys come with every match; carry is for other columns")
    fits = sum((F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(pattern.columns())),
               F.lit(0)).cast("long")
    timed = with_event_time(events, time, delay).where(F.col(time).isNotNull())
    rows = timed.select(*keys, F.col(time), micros(F.col(time)).alias("time_us"), F.col(order).alias("order_no"),
                        fits.alias("fits"), *[F.col(c) for c in carry])
    fields = {f.name: f for f in rows.schema.fields}
    steps = [s.name for s in pattern.steps]
    processor = Sequences([StructField(k, fields[k].dataType) for k in keys],
                          [StructField(c, fields[c].dataType) for c in carry], fields["order_no"], steps,
                          pattern.lines(), pattern.span_us)
    found = keyed(packed(rows, carry), list(keys), processor, "eventTime")
    return found.select(*keys, *[(F.col(s.name)[0] if s.single else F.col(s.name)).alias(s.name)
                                 for s in pattern.steps])
