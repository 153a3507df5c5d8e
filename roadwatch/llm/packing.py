"""Variable-capacity best-fit packing of documents into training sequences.

Several sequence lengths are permitted, each at a cost per sequence. Pieces are
placed in order of falling length, each into the open bin it fills best. When no
open bin has room, a new one of the size that costs least per token is opened;
at the end every bin is downsized to the cheapest size that holds its contents.
Which sizes may be opened is itself chosen: the packing is worked out for every
smallest preferred size, and the cheapest plan as a whole is taken.

Best fit treats pieces of one length alike, so it needs only how many pieces
have which length. That histogram has at most as many entries as the largest
size; the plan made from it says, per length, which ranks go to which bins. The
documents themselves are then ranked and placed by Spark, each on its own.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.stored import stored
from . import token_ids
from .common import named, small_table, whole_text

SIZES = {512: 530.0, 1024: 1040.0, 2048: 2060.0, 4096: 4106.0}  # tokens, cost of a sequence
SLICE_ROWS = 1_000  # pieces of one length that are ranked together, about


@dataclass
class Open:
    """Bins ``first`` up to ``last`` with equal contents: ``used`` of ``size``."""

    first: int
    last: int
    size: int
    used: int


@dataclass(frozen=True)
class Placed:
    """Ranks ``low`` up to ``high`` of a length: ``per_bin`` in each bin from ``bin`` on, the first
    at ``offset``."""

    length: int
    low: int
    high: int
    bin: int
    per_bin: int
    offset: int


def best_fit(counts: Mapping[int, int], sizes: list[int]) -> tuple[list[Placed], list[Open]]:
    """Falling lengths, each piece to the open bin with the least room that holds it.

    A bin that took a piece has less room than before, so the next equal piece
    goes to the same bin until it is full: whole ranges of bins are filled at
    once. ``sizes`` are the sizes to open, the preferred one first.
    """
    placed, done, groups, next_bin = [], [], {}, 0
    rooms: list[int] = []  # the rooms that have open bins, rising

    def put(group: Open) -> None:
        room = group.size - group.used
        if not room:
            done.append(group)
            return
        if room not in groups:
            groups[room] = []
            insort(rooms, room)
        groups[room].append(group)

    for length in sorted(counts, reverse=True):
        low, total = 0, counts[length]
        while low < total:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                group = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[at]
            else:
                size = next(s for s in sizes if s >= length)
                bins = -(-(total - low) // (size // length))
                group, next_bin = Open(next_bin, next_bin + bins, size, 0), next_bin + bins
                room = size
            per_bin = room // length
            bins = min(group.last - group.first, -(-(total - low) // per_bin))
            taken = min(bins * per_bin, total - low)
            placed.append(Placed(length, low, low + taken, group.first, per_bin, group.used))
            full = taken // per_bin
            if full:
                put(Open(group.first, group.first + full, group.size, group.used + per_bin * length))
            if taken % per_bin:
                put(Open(group.first + full, group.first + full + 1, group.size,
                         group.used + taken % per_bin * length))
            if group.first + bins < group.last:
                put(Open(group.first + bins, group.last, group.size, group.used))
            low += taken
    return placed, done + [g for room in rooms for g in groups[room]]


def downsized(used: int, costs: Mapping[int, float]) -> int:
    return min((s for s in costs if s >= used), key=lambda s: (costs[s], s))


def plan(counts: Mapping[int, int], costs: Mapping[int, float] = SIZES):
    """The cheapest of the packings, with its bins' final sizes."""
    by_value = sorted(costs, key=lambda s: (costs[s] / s, -s))
    best = None
    for at in range(len(by_value)):
        # Preferred sizes first; a piece that none of them holds opens the smallest that does.
        order = by_value[at:] + sorted(by_value[:at])
        placed, bins = best_fit(counts, order)
        sized = [Open(b.first, b.last, downsized(b.used, costs), b.used) for b in bins]
        cost = sum((b.last - b.first) * costs[b.size] for b in sized)
        if best is None or cost < best[0]:
            best = cost, placed, sized
    return best


def _at_final_bins(placed: list[Placed], bins: list[Open]) -> list[tuple]:
    """The placements, cut where the bins' final contents differ, with the final size."""
    bins = sorted(bins, key=lambda b: b.first)
    firsts, out = [b.first for b in bins], []
    for p in placed:
        low, at = p.low, p.bin
        while low < p.high:
            group = bins[bisect_right(firsts, at) - 1]
            high = min(p.high, low + (group.last - at) * p.per_bin)
            out.append((p.length, (low, high, at, p.per_bin, p.offset, group.size)))
            low, at = high, group.last
    return out


def word_tokens(text: str = "text") -> Column:
    """A document's length: its words and one end token."""
    words = F.regexp_count(whole_text(text), F.lit(r"[^\x20\x09-\x0D]+"))
    return (words + 1).cast("long")


def pack(docs: DataFrame, length: Column, costs: Mapping[int, float] = SIZES,
         doc_id: str = "doc_id", ids: str | None = None) -> DataFrame:
    """One row per piece: doc_id, n_tokens, piece, start, length, bin, bin_size, bin_offset.

    With ``ids``, a column of the documents' ``n_tokens`` ids, each piece has its own
    in a column ``ids`` as well; ``sequences`` puts a bin's together. A document longer than the largest size is cut into pieces of that size and
    a rest; ``start`` is the piece's first token in its document. A null length
    counts as 0; documents of no tokens have no piece. Repeated rows and null
    ids are packed each. An empty table gives an empty result; other columns are
    ignored.
    """
    spark, largest = docs.sparkSession, max(costs)
    n = F.coalesce(length, F.lit(0)).cast("long")
    held = [named(ids).alias("all_ids")] if ids else []
    rows = docs.select(named(doc_id).alias("doc_id"), n.alias("n_tokens"), *held).where("n_tokens > 0")
    rows = rows.withColumn("piece", F.explode(F.sequence(
        F.lit(0), F.expr(f"CAST((n_tokens - 1) div {largest} AS INT)"))))
    own = [F.slice("all_ids", F.col("piece") * largest + 1, F.lit(largest)).alias("ids")] if ids else []
    rows = stored(rows.select(
        "doc_id", "n_tokens", "piece", *own, (F.col("piece").cast("long") * largest).alias("start"),
        F.least(F.lit(largest), F.expr(f"n_tokens - piece * {largest}L")).cast("int").alias("length"),
        F.monotonically_increasing_id().alias("salt")), "packing-pieces")
    # At most one count per token of the largest size.
    counts = {r["length"]: r["n"] for r in
              rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    _, placed, bins = plan(counts, costs) if counts else (0, [], [])

    routes: dict[int, list] = {}
    for of, run in _at_final_bins(placed, bins):
        routes.setdefault(of, []).append(run)
    names = ("low", "high", "bin", "per_bin", "offset", "size")
    # One row per length: at most the largest size, whatever the input.
    table = small_table(
        spark, [(of, 1 + counts[of] // SLICE_ROWS, [dict(zip(names, r)) for r in runs])
                for of, runs in routes.items()],
        "length int, slices long, runs array<struct<low: long, high: long, bin: long, per_bin: long, "
        "offset: long, size: int>>")

    # A length's pieces are ranked in slices, so a common length is not one task.
    sliced = rows.join(F.broadcast(table.select("length", "slices")), "length").withColumn(
        "slice", F.pmod(F.xxhash64("doc_id", "piece", "salt"), F.col("slices"))).drop("slices")
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (sliced.groupBy("length", "slice").agg(F.count(F.lit(1)).alias("n"))
              .select("length", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    inside = Window.partitionBy("length", "slice").orderBy("doc_id", "piece", "salt")
    ranked = (sliced.withColumn("inside", F.row_number().over(inside))
              .join(firsts, ["length", "slice"])
              .withColumn("rank", F.col("first") + F.col("inside") - 1))
    mine = F.filter("runs", lambda r: (r["low"] <= F.col("rank")) & (F.col("rank") < r["high"]))[0]
    behind = F.col("rank") - F.col("run.low")
    return (ranked.join(F.broadcast(table), "length").withColumn("run", mine).select(
        "doc_id", "n_tokens", "piece", "start", F.col("length").cast("long").alias("length"),
        (F.col("run.bin") + F.floor(behind / F.col("run.per_bin"))).alias("bin"),
        F.col("run.size").alias("bin_size"),
        (F.col("run.offset") + F.pmod(behind, F.col("run.per_bin")) * F.col("length")).alias("bin_offset"),
        *(["ids"] if ids else [])))


def pack_tokens(docs: DataFrame, tokenizer_path: str, costs: Mapping[int, float] = SIZES,
                doc_id: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """``pack`` of the documents' token ids, an end id behind each: with the ids, or only their places."""
    coded = token_ids.tokenised(docs, tokenizer_path, doc_id=doc_id, text=text, lengths_only=not with_ids)
    return pack(coded, F.col("n_tokens"), costs, ids="ids" if with_ids else None)


def sequences(packed: DataFrame) -> DataFrame:
    """The bins as training sequences: bin, bin_size, ids, and the document and start of each piece, in order.

    A bin holds at most its size, so no group is large.
    """
    piece = F.struct("bin_offset", "ids", "doc_id", "start")
    held = packed.groupBy("bin", "bin_size").agg(F.array_sort(F.collect_list(piece)).alias("p"))
    return held.select("bin", "bin_size", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"),
                       F.col("p.start").alias("starts"))
