"""Sequences of events: a small pattern language, and its matches in a table.

A pattern names steps with a condition each, and says how a step follows the one
before it::

    (Pattern.begin("look", "event = 'view'")
     .next("choose", "event = 'click'")                   # the very next row
     .followed_by("fail", "event = 'error'").times(1, 3)  # the next row that fits
     .not_followed_by("event = 'signup'")                 # none of these in between
     .followed_by_any("buy", "event = 'purchase'")        # each row that fits
     .within("1 day"))

It compiles to an automaton: one line of elements for every number of repeats that
``times`` and ``optional`` allow. Conditions look at one row, so all partial
matches that wait for an element advance on the same row, and what follows a row
is the same for every match that reaches it. On a table a line is therefore worked
out from its end: the chain of an element's row is the row and the chain of the
nearest later row that fits the next element. One window order serves all
elements, shared ends of lines are worked out once, and no match is held while
rows pass. ``followed_by_any`` cuts a line in two; the parts meet in a join on key
and time bucket.

Keys of more than ``hot_rows`` rows are cut by rank in the time order; a bucket
gets the nearest fitting row behind it from the heads of the later buckets.
``streaming.patterns`` runs the same lines row by row.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, replace
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.times import duration_micros, micros
from ..sources.stored import stored
from .ranks import HOT_ROWS, ranked
from .running import highest, running

SKIPS = ("none", "to_next", "past_last")


@dataclass(frozen=True)
class Step:
    name: str
    condition: int
    how: str
    least: int = 1
    most: int = 1
    consecutive: bool = False
    guard: int | None = None  # a condition that must not hold before this step
    guarded: str = "between"  # on no row between, or not on the next row

    @property
    def single(self) -> bool:
        return self.least == self.most == 1


@dataclass(frozen=True)
class Element:
    """One row of a line: its condition, how it follows, and what must not come before it."""

    condition: int
    how: str
    guard: int | None = None
    guarded: str = "between"


@dataclass(frozen=True)
class Line:
    counts: tuple[int, ...]  # rows of each step
    elements: tuple[Element, ...]


@dataclass(frozen=True)
class Pattern:
    """Steps in order. Every method returns a new pattern."""

    steps: tuple[Step, ...]
    conditions: tuple[str | Column, ...]
    span: str | None = None
    skipping: str = "none"
    pending: tuple[int, str] | None = None  # a negation that waits for its next step, or ends the pattern

    @staticmethod
    def begin(name: str, condition: str | Column) -> Pattern:
        return Pattern((Step(name, 0, "begin"),), (condition,))

    def _then(self, name: str, condition: str | Column, how: str) -> Pattern:
        if name in [s.name for s in self.steps]:
            raise ValueError(f"two steps are named {name}")
        guard, guarded = self.pending or (None, "between")
        if guard is not None and how == "next":
            raise ValueError("next() leaves no room for a negation")
        step = Step(name, len(self.conditions), how, guard=guard, guarded=guarded)
        return replace(self, steps=(*self.steps, step), conditions=(*self.conditions, condition), pending=None)

    def next(self, name: str, condition: str | Column) -> Pattern:
        return self._then(name, condition, "next")

    def followed_by(self, name: str, condition: str | Column) -> Pattern:
        return self._then(name, condition, "followed_by")

    def followed_by_any(self, name: str, condition: str | Column) -> Pattern:
        return self._then(name, condition, "any")

    def _not(self, condition: str | Column, kind: str) -> Pattern:
        if self.pending:
            raise ValueError("one negation at a time")
        return replace(self, conditions=(*self.conditions, condition), pending=(len(self.conditions), kind))

    def not_next(self, condition: str | Column) -> Pattern:
        """The very next row is not such a row."""
        return self._not(condition, "next")

    def not_followed_by(self, condition: str | Column) -> Pattern:
        """No such row before the next step; at the end, none within the pattern's time."""
        return self._not(condition, "between")

    def times(self, least: int, most: int | None = None, consecutive: bool = False) -> Pattern:
        """The last step, that many times; ``consecutive`` ones in adjacent rows."""
        if least < 0 or (most or least) < max(least, 1):
            raise ValueError("times() takes 0 <= least <= most")
        last = replace(self.steps[-1], least=least, most=most or least, consecutive=consecutive)
        return replace(self, steps=(*self.steps[:-1], last))

    def optional(self) -> Pattern:
        return replace(self, steps=(*self.steps[:-1], replace(self.steps[-1], least=0)))

    def within(self, span: str) -> Pattern:
        """The first and last row are less than this apart."""
        return replace(self, span=span)

    def skip(self, strategy: str) -> Pattern:
        """``none``: all matches. ``to_next``: of those that begin at one row the first to end.
        ``past_last``: by their ends, each that begins behind the end of the one taken before it."""
        if strategy not in SKIPS:
            raise ValueError(f"skip strategies are {SKIPS}")
        return replace(self, skipping=strategy)

    def columns(self) -> list[Column]:
        """The conditions, false where they are null."""
        return [F.coalesce(F.expr(c) if isinstance(c, str) else c, F.lit(False)) for c in self.conditions]

    @property
    def span_us(self) -> int | None:
        return duration_micros(self.span) if self.span else None

    def lines(self) -> list[Line]:
        """Every sequence of elements that the steps allow."""
        if self.pending and (self.pending[1] == "next" or not self.span):
            raise ValueError("a pattern ends in a negation only by not_followed_by() and within()")
        if self.steps[0].least == 0:
            raise ValueError("the first step is not optional")
        lines = []
        for counts in product(*[range(s.least, s.most + 1) for s in self.steps]):
            elements: list[Element] = []
            for step, count in zip(self.steps, counts):
                for i in range(count):
                    elements.append(Element(step.condition, step.how, step.guard, step.guarded) if i == 0 else
                                    Element(step.condition, "next" if step.consecutive else "followed_by"))
            if self.pending:
                elements.append(Element(self.pending[0], "never"))
            lines.append(Line(counts, tuple(elements)))
        return lines


_INSIDE = ("__key", "__bucket")


def _cut(df: DataFrame, pattern: Pattern, keys: Sequence[str], time: str, order: str, carry: Sequence[str],
         hot_rows: int) -> tuple[DataFrame, bool]:
    """Only what matching needs: key, bucket, place in the time order, the row to report, conditions."""
    # The keys as one value: null keys are equal in it.
    rows = df.where(F.col(time).isNotNull()).select(
        F.struct(*keys).alias("__key"), micros(F.col(time)).alias("__time"), F.col(order).alias("__order"),
        F.struct(micros(F.col(time)).alias("time_us"), *[F.col(c) for c in carry]).alias("__row"),
        *[c.alias(f"__c{i}") for i, c in enumerate(pattern.columns())])
    return ranked(rows, "__key", ["__time", "__order"], hot_rows)


def _ahead(df: DataFrame, values: Mapping[str, Column], any_hot: bool) -> DataFrame:
    """Add, under each name, the value of the nearest later row of the key that has one."""
    held = df.withColumns({f"{n}__": v for n, v in values.items()})
    # In the order that the rows were numbered in, so that they need not be sorted again.
    inside = (Window.partitionBy(*_INSIDE).orderBy(F.desc("__time"), F.desc("__order"))
              .rowsBetween(Window.unboundedPreceding, -1))
    found = held.withColumns({n: F.last(f"{n}__", ignorenulls=True).over(inside) for n in values})
    found = found.drop(*[f"{n}__" for n in values])
    if not any_hot:
        return found
    heads = stored(held.where("__hot").groupBy(*_INSIDE).agg(*[
        F.min_by(f"{n}__", F.when(F.col(f"{n}__").isNotNull(), F.col("__at"))).alias(f"{n}__") for n in values]),
        "sequence-heads")
    later = Window.partitionBy("__key").orderBy(F.desc("__bucket")).rowsBetween(Window.unboundedPreceding, -1)
    behind = heads.select(*_INSIDE, *[F.last(f"{n}__", ignorenulls=True).over(later).alias(f"{n}__") for n in values])
    # One row per bucket of a hot key.
    return found.join(stored(behind, "sequence-behind"), list(_INSIDE), "left").withColumns(
        {n: F.coalesce(n, f"{n}__") for n in values}).drop(*[f"{n}__" for n in values])


@dataclass(frozen=True)
class _Part:
    """Elements that follow each other in one way only, and what comes behind the last of them."""

    elements: tuple[Element, ...]
    tail: Element | None

    def rest(self) -> _Part:
        return _Part(self.elements[1:], self.tail)


def _parts(line: Line) -> list[_Part]:
    """A line cut before each ``any`` element."""
    elements = list(line.elements)
    ends = elements.pop() if elements[-1].how == "never" else None
    cuts = [0, *[i for i, e in enumerate(elements) if e.how == "any"], len(elements)]
    parts = [elements[a:b] for a, b in zip(cuts, cuts[1:])]
    tails = [following[0] for following in parts[1:]] + [ends]
    return [_Part(tuple(part), tail) for part, tail in zip(parts, tails)]


def _chains(df: DataFrame, parts: set[_Part], span: int | None, any_hot: bool) -> tuple[DataFrame, dict[_Part, str]]:
    """Add a column per part: at each row that fits its first element, the rows of the whole part.

    A chain has its rows, the place and time of the last, and ``stop``: the place of the
    first later row that its tail's negation forbids, or the time of it if the tail ends the line.
    """
    needed: set[_Part] = set()
    for part in parts:
        while part.elements:
            needed.add(part)
            part = part.rest()
    names = {part: f"__p{i}" for i, part in enumerate(sorted(needed, key=lambda p: (len(p.elements), repr(p))))}
    one = {"row": F.col("__row"), "at": F.col("__at")}

    for length in sorted({len(p.elements) for p in needed}):
        level = [p for p in names if len(p.elements) == length]
        asked: dict[str, Column] = {}
        for part in level:
            following = part.elements[1] if length > 1 else part.tail
            name = names[part]
            if following is None:
                continue
            fits = F.col(f"__c{following.condition}")
            if length > 1:
                chain = F.col(names[part.rest()])
                step = F.struct(fits.alias("fits"), chain.alias("chain"))
                stops = fits if following.guard is None or following.guarded == "next" else (
                    fits | F.col(f"__c{following.guard}"))
                asked[f"{name}_next"] = step if following.how == "next" else F.when(stops, step)
            elif following.how == "never":
                asked[f"{name}_stop"] = F.when(fits, F.col("__time"))
            elif following.guard is not None and following.guarded == "between":
                asked[f"{name}_stop"] = F.when(F.col(f"__c{following.guard}"), F.col("__at"))
            if following.guard is not None and following.guarded == "next":
                asked[f"{name}_bad"] = F.col(f"__c{following.guard}")
        if asked:
            df = _ahead(df, asked, any_hot)
        made = {}
        for part in level:
            name = names[part]
            fits = F.col(f"__c{part.elements[0].condition}")
            if f"{name}_bad" in asked:
                fits = fits & ~F.coalesce(f"{name}_bad", F.lit(False))
            if length == 1:
                stop = F.col(f"{name}_stop") if f"{name}_stop" in asked else F.lit(None)
                chain = F.struct(F.array(F.struct(*[c.alias(n) for n, c in one.items()])).alias("rows"),
                                 F.col("__time").alias("first_time"), F.col("__at").alias("last_at"),
                                 F.col("__time").alias("last_time"), stop.cast("long").alias("stop"))
            else:
                step = F.col(f"{name}_next")
                rest = step["chain"]
                fits = fits & F.coalesce(step["fits"], F.lit(False)) & rest.isNotNull()
                if span is not None:  # no longer chain can end in time
                    fits = fits & (rest["last_time"] - F.col("__time") < span)
                chain = F.struct(F.concat(F.array(F.struct(*[c.alias(n) for n, c in one.items()])), rest["rows"]).alias("rows"),
                                 F.col("__time").alias("first_time"), rest["last_at"].alias("last_at"),
                                 rest["last_time"].alias("last_time"), rest["stop"].alias("stop"))
            made[name] = F.when(fits, chain)
        df = df.withColumns(made).drop(*asked)
    return df, names


def _joined(left: DataFrame, right: DataFrame, tail: Element, span: int | None) -> DataFrame:
    """Each part with every later one that may follow it."""
    width = span or 1
    here = F.floor(F.col("last_time") / width) if span else F.lit(0)
    near = left.withColumn("__near", F.explode(F.array(here, here + 1)) if span else here)
    other = right.select(F.col("__key"), *[F.col(c).alias(f"r_{c}") for c in right.columns if c != "__key"]).withColumn(
        "__near", F.floor(F.col("r_first_time") / width) if span else F.lit(0))
    pairs = near.join(other, ["__key", "__near"]).where(F.col("r_start") > F.col("last_at"))
    if span:
        pairs = pairs.where(F.col("r_last_time") - F.col("first_time") < span)
    if tail.guard is not None and tail.guarded == "between":
        pairs = pairs.where(F.col("stop").isNull() | (F.col("r_start") <= F.col("stop")))
    return pairs.select("__key", "start", F.concat("rows", "r_rows").alias("rows"), "first_time",
                        F.col("r_last_at").alias("last_at"), F.col("r_last_time").alias("last_time"),
                        F.col("r_stop").alias("stop"))


def match(df: DataFrame, pattern: Pattern, keys: Sequence[str], time: str, order: str, carry: Sequence[str] = (),
          *, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The pattern's matches: the keys, and per step a struct of ``time_us`` and ``carry``.

    A step that may repeat or be left out has an array of them. Rows of a key are
    taken by ``time``, then ``order``, which tells rows of one time apart; rows
    without a time take no part, a null condition does not hold, and null keys are
    one key. An empty table has no match.
    """
    span = pattern.span_us
    lines = pattern.lines()
    cut, any_hot = _cut(df, pattern, keys, time, order, carry, hot_rows)
    all_parts = {part for line in lines for part in _parts(line)}
    chained, names = _chains(cut, all_parts, span, any_hot)
    if len(all_parts) > 1:
        chained = stored(chained.where(" or ".join(f"{names[p]} is not null" for p in all_parts)).select(
            "__key", "__at", *[names[p] for p in all_parts]), "sequence-chains")

    def of(part: _Part) -> DataFrame:
        name = names[part]
        return chained.where(F.col(name).isNotNull()).select("__key", F.col("__at").alias("start"), f"{name}.*")

    found = None
    for line in lines:
        parts = _parts(line)
        matches = of(parts[0])
        for before, part in zip(parts, parts[1:]):
            matches = _joined(matches, of(part), before.tail, span)
        if span is not None:
            matches = matches.where(F.col("last_time") - F.col("first_time") < span)
        if parts[-1].tail is not None:
            matches = matches.where(F.col("stop").isNull() | (F.col("stop") - F.col("first_time") >= span))
        at, columns = 0, []
        for step, count in zip(pattern.steps, line.counts):
            rows = F.transform(F.slice("rows", at + 1, count), lambda r: r["row"])
            columns.append((rows[0] if step.single else rows).alias(step.name))
            at += count
        matches = matches.select("__key", "start", "last_at", F.lit(at).alias("size"), *columns)
        found = matches if found is None else found.unionByName(matches)
    steps = [step.name for step in pattern.steps]
    return _skipped(found, pattern.skipping, steps).select("__key.*", *steps)


def _skipped(matches: DataFrame, strategy: str, steps: Sequence[str]) -> DataFrame:
    if strategy == "none":
        return matches
    # Of one beginning the first to end; one row per key and beginning from here on.
    first = F.min_by(F.struct("last_at", *steps), F.struct("last_at", "size"))
    matches = (matches.groupBy("__key", "start").agg(first.alias("__m"))
               .select("__key", "start", "__m.*"))
    if strategy == "to_next":
        return matches
    # Matches that no earlier one reaches begin a new run of overlapping ones; runs are independent.
    matches = stored(matches, "sequence-firsts")
    seen = running(matches, ["__key"], "start", {"__reach": highest(F.col("last_at"))}, inclusive=False)
    opens = seen.withColumn("__opens", F.when(F.coalesce(F.col("start") > F.col("__reach"), F.lit(True)), F.col("start")))
    runs = running(opens, ["__key"], "start", {"__run": highest(F.col("__opens"))})
    narrow = runs.select("__key", "__run", "last_at", "start")
    taken = (narrow.repartition("__key", "__run").sortWithinPartitions("__key", "__run", "last_at", "start")
             .mapInArrow(_taken, narrow.schema).select("__key", "start"))
    return matches.join(taken, ["__key", "start"], "left_semi")


def _taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """By their ends: each match that begins behind the end of the one taken before it."""
    run, end = None, None
    for batch in batches:
        kept = []
        for i, (key, number, last_at, start) in enumerate(zip(*(c.to_pylist() for c in batch.columns))):
            if (key, number) != run or start > end:
                run, end = (key, number), last_at
                kept.append(i)
        yield batch.take(pa.array(kept, pa.int64()))
