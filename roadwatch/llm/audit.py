"""How quality filters interact, in every order they could be applied.

Flags of the filters that look at one text come from one scan. Whether a text
repeats an earlier one is settled in two steps. First a counting Bloom filter:
each task sketches its texts' fingerprints, sketches are merged by segment, and a
text with a counter of one has no equal. Only what is left moves with its text
and is compared in full. Flags then fold into counts per combination of flags,
and every figure of the audit is a sum of those counts.

The sketch grows with the input and is cut into segments; a segment is merged and
asked by one task, and no task holds more than one. Copies of a text are folded
before every shuffle: fingerprints per task, texts by map-side combine.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..sources.stored import stored
from .common import named, ship, small_table, whole_text
from .quality_rules import words_of

ship(__name__)

FILTERS = "ABCDE"
REPEAT = 1 << FILTERS.index("E")
SEGMENT_TEXTS = 1 << 17
COUNTERS_PER_TEXT, PROBES = 16, 4
SKETCH_AT_ONCE = 1 << 20  # fingerprints that a task sketches together


def failures(text: Column) -> Column:
    """One bit per filter A to D; the text has no nulls."""
    words, chars = F.size(words_of(text)), F.length(text)
    distinct = F.size(F.array_distinct(words_of(text)))
    conditions = [words < 100, 100 * distinct < 80 * words,
                  100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * chars, text.rlike(r"[#$%&*|]")]
    found = F.lit(0)
    for place, failed in enumerate(conditions):
        found = found.bitwiseOR(F.when(failed, F.lit(1 << place)).otherwise(F.lit(0)))
    return found


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def segment_of(prints: np.ndarray, segments: int) -> np.ndarray:
    return (_mixed(prints) % np.uint64(segments)).astype(np.int64)


def probes(prints: np.ndarray, counters: int) -> np.ndarray:
    """Each fingerprint's places in its segment, one row each."""
    first = _mixed(prints ^ np.uint64(0x9E3779B97F4A7C15))
    step = _mixed(prints ^ np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)
    return np.stack([((first + np.uint64(i) * step) >> np.uint64(16)) % np.uint64(counters)
                     for i in range(PROBES)], axis=1).astype(np.int64)


def _fingerprints(batches):
    """The task's fingerprints, many at a time."""
    held, n = [], 0
    for batch in batches:
        held.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
        n += len(held[-1])
        if n >= SKETCH_AT_ONCE:
            yield np.concatenate(held)
            held, n = [], 0
    if n:
        yield np.concatenate(held)


def _by_segment(segment: np.ndarray):
    order = np.argsort(segment, kind="stable")
    found, firsts = np.unique(segment[order], return_index=True)
    return [(int(s), order[a:b]) for s, a, b in zip(found, firsts, [*firsts[1:], len(order)])]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()),
         pa.array(columns[2], pa.binary()), pa.array(columns[3], pa.binary())],
        names=["segment", "kind", "places", "counts"])


ROWS = "segment long, kind int, places binary, counts binary"
SKETCH, MERGED, ASKED = 0, 1, 2


def _sketches(segments: int, counters: int):
    """Counters of the task's texts, those that are not zero; two stands for two and more."""
    def run(batches):
        for prints in _fingerprints(batches):
            different, times = np.unique(prints, return_counts=True)
            rows = []
            for segment, mine in _by_segment(segment_of(different, segments)):
                places = probes(different[mine], counters)
                held, at = np.unique(places.ravel(), return_inverse=True)
                count = np.bincount(at, weights=np.repeat(np.minimum(times[mine], 2), PROBES))
                rows.append((segment, SKETCH, held.astype("<u4").tobytes(),
                             np.minimum(count, 2).astype(np.uint8).tobytes()))
            yield _batch(rows)
    return run


def _merge(counters: int):
    """A segment's sketches added up: one bit per counter that is two or more."""
    def run(batches):
        now, sums = None, None

        def merged():
            return _batch([(now, MERGED, np.packbits(sums >= 2).tobytes(), b"")])
        for batch in batches:
            for segment, _, places, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if segment != now:
                    if now is not None:
                        yield merged()
                    now, sums = segment, np.zeros(counters, np.uint8)
                at = np.frombuffer(places, "<u4")
                sums[at] = np.minimum(sums[at] + np.frombuffer(counts, np.uint8), 2)
        if now is not None:
            yield merged()
    return run


def _questions(segments: int):
    def run(batches):
        for prints in _fingerprints(batches):
            different = np.unique(prints)
            yield _batch([(segment, ASKED, different[mine].astype("<u8").tobytes(), b"")
                          for segment, mine in _by_segment(segment_of(different, segments))])
    return run


def _answers(counters: int):
    """The fingerprints all of whose counters are two or more."""
    def run(batches):
        now, repeated = None, None
        for batch in batches:
            for segment, kind, places, _ in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == MERGED:
                    now = segment
                    repeated = np.unpackbits(np.frombuffer(places, np.uint8), count=counters).astype(bool)
                    continue
                assert segment == now
                asked = np.frombuffer(places, "<u8")
                maybe = asked[repeated[probes(asked, counters)].all(axis=1)]
                if len(maybe):
                    yield pa.RecordBatch.from_arrays([pa.array(maybe.view(np.int64))], names=["print"])
    return run


def possible_repeats(prints: DataFrame, texts: int, segment_texts: int = SEGMENT_TEXTS) -> DataFrame:
    """Of a table with one column of fingerprints, those that may occur twice, each once.

    A fingerprint that occurs twice is always among them.
    """
    segments = -(-texts // segment_texts) or 1
    counters = COUNTERS_PER_TEXT * min(segment_texts, max(texts, 1))
    sketches = prints.mapInArrow(_sketches(segments, counters), ROWS)
    merged = stored(sketches.repartition("segment").sortWithinPartitions("segment")
                    .mapInArrow(_merge(counters), ROWS), "audit-sketch")
    asked = merged.unionByName(prints.mapInArrow(_questions(segments), ROWS))
    maybe = (asked.repartition("segment").sortWithinPartitions("segment", "kind")
             .mapInArrow(_answers(counters), "print long"))
    return stored(maybe.distinct(), "audit-possible")


def _first_ids(docs: DataFrame, possible: DataFrame) -> DataFrame:
    """print, contents, first_id: the smallest id of each text that may have an equal.

    ``contents`` is null but for fingerprints that stand for more than one text.
    """
    same = docs.join(possible, "print", "left_semi").groupBy("print", "text").agg(F.min("doc_id").alias("first_id"))
    # Of a fingerprint's texts: their number, the only one's first id.
    firsts = stored(same.select("print", "first_id", "text"), "audit-firsts")
    unsure = stored(firsts.groupBy("print").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("print"),
                    "audit-unsure")
    if unsure.isEmpty():
        return firsts.select("print", F.lit(None).cast("string").alias("contents"), "first_id")
    marked = firsts.join(unsure.withColumn("unsure", F.lit(True)), "print", "left")
    return marked.select("print", F.when(F.col("unsure"), F.col("text")).alias("contents"), "first_id")


def flag_counts(docs: DataFrame, labels: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text",
                part: str = "lang", identify: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """Documents per part, combination of failed filters and label: part, mask, good, toxic, n."""
    rows = docs.select(named(doc_id).cast("long").alias("doc_id"),
                       F.coalesce(named(part).cast("string"), F.lit("")).alias("part"),
                       whole_text(text).alias("text"))
    rows = rows.withColumn("print", identify(F.col("text")))
    light = stored(rows.select("doc_id", "part", "print", failures(F.col("text")).alias("mask")), "audit-flags")
    possible = possible_repeats(light.select("print"), light.count())
    firsts = stored(_first_ids(rows.select("doc_id", "print", "text"), possible), "audit-first-ids")

    unsure = firsts.where("contents IS NOT NULL").select("print").distinct()
    if unsure.isEmpty():
        light = light.withColumn("contents", F.lit(None).cast("string"))
    else:  # fingerprints of two texts: those documents are told apart by their texts
        kept = light.join(unsure, "print", "left_anti").withColumn("contents", F.lit(None).cast("string"))
        doubtful = rows.join(unsure, "print", "left_semi").select(
            "doc_id", "part", "print", failures(F.col("text")).alias("mask"), F.col("text").alias("contents"))
        light = kept.unionByName(doubtful)
    if labels is None:
        light = light.withColumns({"good": F.lit(False), "toxic": F.lit(False)})
    else:
        known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
            F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
            F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")).where("doc_id IS NOT NULL")
        known = stored(known, "audit-labels")
        light = light.join(known, "doc_id", "left").withColumns({
            c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})

    group = ["part", "mask", "good", "toxic"]
    of_all = light.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    # Repeats, by text: copies fold before anything is joined. A row repeats if its id is above the first.
    same = ["print", "contents", *group]
    copies = (light.join(possible, "print", "left_semi").groupBy(*same, "doc_id").agg(F.count(F.lit(1)).alias("n"))
              .groupBy(*same).agg(F.sum("n").alias("n"), F.min_by(F.struct("doc_id", "n"), "doc_id").alias("least")))
    key = copies.select(F.col("print").alias("p"), F.col("contents").alias("c"), *group, "n", "least")
    joined = key.join(firsts, (F.col("p") == F.col("print")) & F.col("c").eqNullSafe(F.col("contents")))
    first_rows = F.when(F.col("first_id").isNull(), F.col("n")).when(
        F.col("least.doc_id") == F.col("first_id"), F.col("least.n")).otherwise(0)
    repeats = joined.groupBy(*group).agg(F.sum(F.col("n") - first_rows).alias("n")).where("n > 0")
    flagged = repeats.select("part", F.col("mask").bitwiseOR(F.lit(REPEAT)).alias("mask"), "good", "toxic", "n")
    plain = of_all.unionByName(repeats.withColumn("n", -F.col("n")))
    return plain.unionByName(flagged).groupBy(*group).agg(F.sum("n").cast("long").alias("n"))


def _steps(filters: str) -> list[tuple[str, int, int, int]]:
    """(order, step, the filter's bit, bits of the filters before it)."""
    rows = []
    for order in permutations(filters):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << filters.index(name)
            rows.append(("".join(order), step, bit, before))
            before |= bit
    return rows


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from counts per combination.

    Zeros are included; parts are those of ``counts``.
    """
    steps = _steps(filters)
    orders = len({order for order, *_ in steps})
    pairs = sorted({(bit, before) for _, _, bit, before in steps})
    case = F.explode(F.array(*[F.struct(F.lit(b).alias("bit"), F.lit(o).alias("before")) for b, o in pairs]))
    spread = counts.withColumn("case", case).select("*", "case.bit", "case.before")
    mask, bit, before, n = (F.col(c) for c in ("mask", "bit", "before", "n"))
    fails, early = mask.bitwiseAND(bit) != 0, mask.bitwiseAND(before) != 0
    removed = fails & ~early

    def count(condition: Column, amount: Column = n) -> Column:
        return F.sum(F.when(condition, amount).otherwise(0)).cast("long")
    # A document that fails m filters is removed by each of them in one order of m.
    share = F.expr(f"n * ({orders} div greatest(bit_count(mask), 1))")
    found = spread.groupBy("part", "bit", "before").agg(
        count(~fails & ~early).alias("kept"), count(removed).alias("removed"),
        count(fails & early).alias("redundant"), count(mask == bit).alias("unique_fails"),
        count(removed & F.col("good")).alias("good_lost"), count(removed & F.col("toxic")).alias("toxic_lost"),
        count(fails, share).alias("shapley"))
    listed = small_table(counts.sparkSession, steps, "filter_order string, step int, bit int, before int")
    # As many rows as the filters have orders and places.
    return found.join(F.broadcast(listed), ["bit", "before"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
        "toxic_lost", "shapley")


def interactions(docs: DataFrame, labels: DataFrame | None = None, **columns) -> DataFrame:
    """The whole audit of documents: see ``flag_counts`` and ``audit``.

    A null text is empty, a null part the empty string. A document repeats if a
    smaller id has the same text; a null id is larger than all others, and rows of
    the same id do not repeat each other. Labels that repeat an id count if any of
    them does. An empty table gives an empty result; other columns are ignored.
    """
    return audit(flag_counts(docs, labels, **columns))
