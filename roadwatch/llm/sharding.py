"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns several points of a ring; a document belongs to the next point
clockwise. A shard takes no more than its bound: what overflows goes on to the
next shard clockwise, and so on. The bounds add up to the number of documents,
so row counts are at most one apart, and a document leaves its own shard only
when that is full.

The ring has 2^64 places. Only the number of documents between two points matters
for the rest. The driver sees that histogram, cut at sectors of the ring (one
number per point and sector, whatever the input), and returns per arc which ranks
go to which shard; ranks come from counts of slices of the ring, so no arc is
ordered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.stored import stored
from .common import named, small_table

SECTORS = 1 << 16  # equal parts of the ring, for histograms and look-ups
POINTS = 64  # points of a shard on the ring
SLICE_ROWS = 100_000  # documents that are ordered together, about
SEED = 7


@dataclass(frozen=True)
class Run:
    """Ranks ``low`` up to ``high`` of an arc go to ``shard``, from its slot ``slot`` on."""

    arc: int
    low: int
    high: int
    shard: int
    slot: int


def ring_points(spark, shards: int, points: int) -> list[tuple[int, int]]:
    """(place on the ring, shard) in ring order; a place that two shards drew belongs to the one with
    the smaller second hash."""
    made = spark.range(shards * points).select(
        F.expr(f"CAST(id div {points} AS INT)").alias("shard"), F.expr(f"id % {points}").alias("i"))
    placed = made.select(F.xxhash64(F.lit(SEED), "shard", "i").alias("place"), "shard",
                         F.xxhash64("i", "shard").alias("second"))
    owner = placed.groupBy("place").agg(F.min_by("shard", F.struct("second", "shard")).alias("shard"))
    return sorted((r["place"], r["shard"]) for r in owner.collect())


def clockwise(points: list[tuple[int, int]], arc: int, shards: int) -> Iterator[int]:
    """The shards that an arc meets, each once; those without a point come last, in order."""
    seen = set()
    for i in range(len(points)):
        shard = points[(arc + i) % len(points)][1]
        if shard not in seen:
            seen.add(shard)
            yield shard
    yield from (s for s in range(shards) if s not in seen)


def bounded_runs(points: list[tuple[int, int]], counts: list[int], shards: int) -> list[Run]:
    """Each arc's ranks to shards under the bounds.

    First every arc goes to its own shard, in ring order as long as there is
    room; then what is left goes to the second shard clockwise, and so on.
    """
    total = sum(counts)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used, runs = [0] * shards, []
    waiting = [(arc, 0, n, clockwise(points, arc, shards)) for arc, n in enumerate(counts) if n]
    while waiting:
        left = []
        for arc, low, high, order in waiting:
            shard = next(order)
            taken = min(high - low, room[shard])
            if taken:
                runs.append(Run(arc, low, low + taken, shard, used[shard]))
                room[shard] -= taken
                used[shard] += taken
            if low + taken < high:  # only an arc that overflows looks any further
                left.append((arc, low + taken, high, order))
        waiting = left
    return runs


def ring_key(doc_id: str) -> Column:
    """A null id takes its place on the ring like any other value."""
    return F.xxhash64(F.coalesce(named(doc_id).cast("string"), F.lit("null")))


def place(docs: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text",
          points: int = POINTS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the text's UTF-8 bytes plus 1 (a null text has none). Ranks
    within an arc follow the key's hash, the id, size and checksum; rows that
    repeat all of these are interchangeable. Null ids share one place of the
    ring and overflow like the rest. An empty table gives an empty result; other
    columns are ignored. The law is ``rows``: counts are at most one apart, so
    the shard depends on the other rows too and ``grown_shard`` is null.
    """
    spark = docs.sparkSession
    ring = ring_points(spark, shards, points)
    # One row per sector, with its points and the arc behind them.
    sectors = small_table(spark, _sectors(ring), "low int, high int, ends array<struct<at: long, arc: int>>, then int")
    sectors = sectors.select(F.explode(F.sequence("low", "high")).alias("position"), "ends", "then")
    bytes_of = named(text).cast("binary")
    rows = docs.select(
        named(doc_id).alias("doc_id"),
        (F.coalesce(F.octet_length(named(text)), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(bytes_of, F.lit("").cast("binary"))).alias("text_crc32"),
        ring_key(doc_id).alias("key"))
    rows = rows.withColumns({"position": _sector(F.col("key")), "salt": F.monotonically_increasing_id()})
    reached = F.filter("ends", lambda end: end["at"] >= F.col("key"))
    rows = rows.join(F.broadcast(sectors), "position").withColumn(
        "arc", F.coalesce(F.get(reached, F.lit(0))["arc"], F.col("then"))).drop("ends", "then")
    rows = stored(rows, "shard-rows")

    counts, crowded = [0] * len(ring), 0
    for r in rows.groupBy("position", "arc").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[r["arc"]] += r["n"]
        crowded = max(crowded, r["n"])
    runs = bounded_runs(ring, counts, shards)

    # One slice per sector, or more where equal ids crowd one.
    finer = 1 + crowded // SLICE_ROWS
    rows = rows.withColumn("slice", F.col("position").cast("long") * finer + F.pmod(
        F.xxhash64("doc_id", "size", "text_crc32", "salt"), F.lit(finer)))
    before = Window.partitionBy("arc").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (rows.groupBy("arc", "slice").agg(F.count(F.lit(1)).alias("n"))
              .select("arc", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    inside = Window.partitionBy("arc", "slice").orderBy("key", "doc_id", "size", "text_crc32")
    ranked = (rows.withColumn("inside", F.row_number().over(inside))
              .join(firsts, ["arc", "slice"])
              .withColumn("rank", F.col("first") + F.col("inside") - 1))

    by_arc: dict[int, list] = {}
    for run in runs:
        by_arc.setdefault(run.arc, []).append((run.low, run.high, run.shard, run.slot))
    # One row per arc: shards x points rows, whatever the input.
    routes = small_table(
        spark, [(arc, [dict(zip(("low", "high", "shard", "slot"), r)) for r in of])
                for arc, of in by_arc.items()],
        "arc int, runs array<struct<low: long, high: long, shard: int, slot: long>>")
    mine = F.filter("runs", lambda r: (r["low"] <= F.col("rank")) & (F.col("rank") < r["high"]))[0]
    return (ranked.join(F.broadcast(routes), "arc").withColumn("run", mine)
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
                    F.col("run.shard").alias("shard"),
                    (F.col("run.slot") + F.col("rank") - F.col("run.low")).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))


def _sector(key: Column) -> Column:
    """The ring's sector of a place, in ring order."""
    return (F.shiftright(key, 48) + SECTORS // 2).cast("int")


def _sectors(ring: list[tuple[int, int]]) -> list[tuple]:
    """(first sector, last sector, their points as (place, arc), the arc of what lies behind those).

    Arc i ends at point i; sectors without a point come together.
    """
    inside: dict[int, list] = {}
    for arc, (place, _) in enumerate(ring):
        inside.setdefault((place >> 48) + SECTORS // 2, []).append({"at": place, "arc": arc})
    rows, then, high = [], 0, SECTORS - 1  # behind the last point comes the first
    for sector in sorted(inside, reverse=True):
        if sector < high:
            rows.append((sector + 1, high, [], then))
        rows.append((sector, sector, inside[sector], then))
        then, high = inside[sector][0]["arc"], sector - 1
    return rows + ([(0, high, [], then)] if high >= 0 else [])
