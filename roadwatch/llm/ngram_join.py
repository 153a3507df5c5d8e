"""Similarity join on word shingles with a MinHash LSH forest.

Texts with equal shingle sets are folded first. A text's signature gives it a path in
each of ``TREES`` prefix tries, ``DEPTH`` labels deep. The tries are one sorted list of
(tree, path): neighbours in it have the longest common prefix any two paths have, so
one pass over the sorted list tells at which depth each text meets the next.

Matching begins at the full depth and shortens the prefix by one label as long as too
few links are found. What share is found is measured on all verified links: a link of
similarity s shares a prefix of depth d in some tree with probability
1 - (1 - s^d)^trees, so each stands for one over that many. The prefix is not shortened
below the depth at which links at the bound have the probability ``RECALL``.

Texts that meet, directly or over others, form a candidate set. Where a shorter prefix
joins sets, all pairs between them are verified exactly, by the sizes of the shingle
sets and of their intersections; pairs within a set have been before. Large sets are
cut into blocks and each two blocks are verified together, so no task holds more than
two blocks, and a task reports counts and a spanning forest, never pairs.
"""

from __future__ import annotations

from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ..sources.stored import stored
from .common import free_name, named, ship, worker_cache
from .components import components
from .decontaminate import words_of

ship(__name__)

WORDS, SIMILARITY = 5, 0.8
TREES, DEPTH = 32, 9
LABEL_BITS = 6  # of a path; the whole path is one number
RECALL = 0.999  # of links at the bound, at the shortest prefix
TARGET = 0.9999  # of all links; as soon as it is reached the prefix is long enough
BLOCK = 512  # texts
MOST_WORDS = 400_000  # words a worker remembers


def prefix_depth(similarity: float = SIMILARITY, recall: float = RECALL, trees: int = TREES,
                 depth: int = DEPTH) -> int:
    """The longest prefix that a pair at the bound shares in some tree with the recall."""
    while depth > 1 and 1 - (1 - similarity ** depth) ** trees < recall:
        depth -= 1
    return depth


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """The set of the text's word runs as sorted 64-bit hashes.

    Words are lower case without ASCII punctuation. A text of fewer than five
    words has itself as its only run, one without words has none.
    """
    cache = worker_cache("shingles")
    known = cache.setdefault("word hashes", _Hashes())
    if len(known) > MOST_WORDS:
        known.clear()
    words = words_of(text or "")
    codes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    if not len(codes):
        return codes
    width = min(WORDS, len(codes))
    runs = np.zeros(len(codes) - width + 1, np.uint64)
    for i in range(width):
        runs = runs * np.uint64(0x9E3779B97F4A7C15) + codes[i:i + len(runs)]
    return np.unique(_mixed(runs))


def _permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(23)
    return (rng.integers(0, 1 << 32, count, dtype=np.uint32),
            rng.integers(0, 1 << 31, count, dtype=np.uint32) * np.uint32(2) + np.uint32(1))


def signature(runs: np.ndarray, masks: np.ndarray, factors: np.ndarray) -> np.ndarray:
    low = np.full(len(masks), 0xFFFFFFFF, np.uint32)
    short = (runs >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(short), 1024):
        mixed = (short[i:i + 1024, None] ^ masks) * factors
        mixed ^= mixed >> np.uint32(15)
        np.minimum(low, mixed.min(axis=0), out=low)
    return low


def paths_of(labels: np.ndarray) -> np.ndarray:
    """Per tree the labels as one number that sorts as they do: the first label has the highest bits."""
    short = (_mixed(labels.astype(np.uint64)) >> np.uint64(64 - LABEL_BITS)).astype(np.int64)
    path = np.zeros(len(labels), np.int64)
    for level in range(labels.shape[1]):
        path = (path << LABEL_BITS) | short[:, level]
    return path


def common_depth(one: np.ndarray, other: np.ndarray, depth: int) -> np.ndarray:
    """How many labels two paths share from the front."""
    apart = one ^ other
    return sum((apart >> LABEL_BITS * (depth - d) == 0).astype(np.int32) for d in range(1, depth + 1))


def _forest(depth: int, trees: int):
    masks, factors = _permutations(trees * depth)

    def run(batches):
        for batch in batches:
            keys, sizes, paths = [], [], []
            for text in batch.column(2):
                runs = shingles(text.as_py())
                if not len(runs):
                    keys.append(None)
                    sizes.append(0)
                    paths.append(None)
                    continue
                keys.append(blake2b(runs.tobytes(), digest_size=16).digest())
                sizes.append(len(runs))
                paths.append(paths_of(signature(runs, masks, factors).reshape(trees, depth)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys, pa.binary()),
                 pa.array(sizes, pa.int32()), pa.array(paths, pa.list_(pa.int64()))],
                names=["doc_id", "handle", "key", "size", "paths"])
    return run


_MEETING = "part int, place int, tree int, path long, key binary, other binary, depth int"


def _neighbours(depth: int, floor: int):
    """Of a sorted part of the list: each entry that shares a prefix of at least ``floor`` labels with the
    one before it, beside the first entry of the run with that prefix (place 1); and the part's first and
    last entry (places 0 and 2)."""
    def rows(place, trees, paths, keys, others, depths):
        n = len(keys)
        part = TaskContext.get().partitionId()
        return pa.RecordBatch.from_arrays(
            [pa.array([part] * n, pa.int32()), pa.array([place] * n, pa.int32()), pa.array(trees, pa.int32()),
             pa.array(paths, pa.int64()), pa.array(keys, pa.binary()), pa.array(others, pa.binary()),
             pa.array(depths, pa.int32())], names=["part", "place", "tree", "path", "key", "other", "depth"])

    def run(batches):
        last, heads = None, [None] * (depth + 1)  # of the run at each depth, its first entry
        for batch in batches:
            if not batch.num_rows:
                continue
            trees, paths = (batch.column(i).to_numpy() for i in (0, 1))
            keys = batch.column(2).cast(pa.binary())
            if last is None:
                yield rows(0, trees[:1], paths[:1], [keys[0].as_py()], [None], [None])
                last = -1, 0, None
            before = np.append(last[0], trees[:-1]), np.append(last[1], paths[:-1])
            shared = np.where(trees == before[0], common_depth(paths, before[1], depth), 0)
            for d in range(floor, depth + 1):
                # Where the run of this depth begins that each entry is in; 0 stands for one begun earlier.
                begins = np.maximum.accumulate(np.where(shared < d, np.arange(1, len(keys) + 1), 0))
                near = np.flatnonzero(shared == d)
                if len(near):
                    held = pa.concat_arrays([pa.array([heads[d]], pa.binary()), keys])
                    yield rows(1, trees[near], paths[near], held.take(pa.array(begins[near])),
                               keys.take(pa.array(near)), shared[near])
                if begins[-1]:
                    heads[d] = keys[int(begins[-1]) - 1].as_py()
            last = trees[-1], paths[-1], keys[len(keys) - 1].as_py()
        if last is not None:
            yield rows(2, [last[0]], [last[1]], [last[2]], [None], [None])
    return run


def meetings(texts: DataFrame, depth: int = DEPTH, floor: int = 1) -> DataFrame:
    """u, v, depth: what meets in the sorted tries and the depth of the common prefix, ``floor`` at least.

    At any depth the texts with one prefix are a run of neighbours, and meet its first. The list is cut by ranges, so a
    prefix that very many texts share is spread over tasks; entries at the cuts are compared afterwards.
    """
    listed = texts.select("key", F.posexplode("paths").alias("tree", "path")).select("tree", "path", "key")
    found = stored(listed.repartitionByRange("tree", "path", "key").sortWithinPartitions("tree", "path", "key")
                   .mapInArrow(_neighbours(depth, floor), _MEETING), "join-neighbours")
    # Two rows per part of the list.
    cuts = found.where("place <> 1")
    following = Window.orderBy("part", "place")
    ahead = F.lead(F.struct("part", "tree", "path", "key")).over(following)
    apart = F.col("path").bitwiseXOR(F.col("ahead.path"))
    shared = sum((F.when(F.shiftright(apart, LABEL_BITS * (depth - d)) == 0, 1).otherwise(0)
                  for d in range(1, depth + 1)), F.lit(0))
    across = (cuts.withColumn("ahead", ahead).where("place = 2 AND ahead.tree = tree")
              .select("key", F.col("ahead.key").alias("other"), shared.cast("int").alias("depth")).where(F.col("depth") >= floor))
    pairs = found.where("place = 1").select("key", "other", "depth").unionByName(across)
    return stored(pairs.groupBy(F.col("key").alias("u"), F.col("other").alias("v")).agg(
        F.max("depth").alias("depth")), "join-meetings")


def _runs_of(batches):
    for batch in batches:
        keys, runs = [], []
        for text in batch.column(0):
            found = shingles(text.as_py())
            keys.append(blake2b(found.tobytes(), digest_size=16).digest())
            runs.append(found.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(runs, pa.binary())],
                                         names=["key", "runs"])


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """The size of the intersection of each two sets."""
    n, sizes = len(sets), np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(n), sizes)
    _, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[place] > 1
    _, column = np.unique(place[shared], return_inverse=True)
    row, common = owner[shared], np.zeros((n, n), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width = 4096
    bounds = np.searchsorted(column, np.arange(0, (column[-1] if len(column) else -1) + width + 1, width))
    for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
        held = np.zeros((n, width), np.float32)
        held[row[a:b], column[a:b] - i * width] = 1
        common += held @ held.T
    return common.astype(np.float64)


def similar(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """Which pairs of sets have at least that Jaccard similarity; exact."""
    return _links(sets, similarity)[0]


def _links(sets: list[np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs are similar, and how similar all are."""
    sizes, common = np.array([len(s) for s in sets], np.float64), overlaps(sets)
    union = sizes[:, None] + sizes - common
    linked = common >= similarity * union - 1e-9
    np.fill_diagonal(linked, False)
    return linked, common / union


def _verify(similarity: float):
    def result(rows):
        keys, copies, sides, olds, sets = zip(*rows)
        linked, how = _links(list(sets), similarity)
        sides = np.array(sides)
        if sides.any():  # two blocks: pairs within one block belong to another task
            linked &= sides[:, None] != sides
        _, old = np.unique(np.array(olds, object).astype(bytes), return_inverse=True)
        linked &= old[:, None] != old  # the others were verified when their set came about
        found = np.flatnonzero(linked.any(axis=1))
        if not len(found):
            return
        links = linked @ np.array(copies, np.int64)
        root = np.arange(len(keys))
        while True:  # the smallest position that each text reaches
            lower = np.minimum(root, np.where(linked, root, len(keys)).min(axis=1))
            lower = lower[lower]
            if (lower == root).all():
                break
            root = lower
        yield _found([keys[i] for i in found], [keys[root[i]] for i in found], links[found], [None] * len(found))
        percent, n = np.unique((how[np.triu(linked)] * 100 + 1e-7).astype(int), return_counts=True)
        yield _found([None] * len(n), [None] * len(n), n, percent)

    def _found(u, v, links, percent):
        return pa.RecordBatch.from_arrays(
            [pa.array(u, pa.binary()), pa.array(v, pa.binary()), pa.array(links, pa.int64()),
             pa.array(percent, pa.int32())], names=["u", "v", "links", "percent"])

    def run(batches):
        unit, rows = None, []
        for batch in batches:
            for number, key, copies, side, old, runs in zip(*(c.to_pylist() for c in batch.columns)):
                if number != unit:
                    if len(rows) > 1:
                        yield from result(rows)
                    unit, rows = number, []
                rows.append((key, copies, side, old.hex(), np.frombuffer(runs, np.uint64)))
        if len(rows) > 1:
            yield from result(rows)
    return run


def _units(members: DataFrame) -> DataFrame:
    """Each text once per pair of blocks of its candidate set that its block is in.

    ``members`` has root, key, copies, and old: the set a text was in before. Old sets of a
    block and more have blocks of their own, which need not meet each other again; smaller
    ones share blocks.
    """
    olds = members.groupBy("root", "old").agg(F.count(F.lit(1)).alias("n"))
    small = olds.where(F.col("n") < BLOCK).groupBy("root").agg(F.sum("n").alias("n_small"))
    shared = F.pmod(F.xxhash64("old"), F.ceil(F.col("n_small") / BLOCK)).cast("int")
    own = F.pmod(F.xxhash64("key"), F.ceil(F.col("n") / BLOCK)).cast("int")
    big = F.col("n") >= BLOCK
    placed = stored(members.join(olds, ["root", "old"]).join(small, "root", "left").select(
        "root", "key", "copies", "old", F.struct(
            F.when(big, F.col("old")).otherwise(F.lit("").cast("binary")).alias("of"),
            F.when(big, own).otherwise(shared).alias("no")).alias("block")), "join-placed")
    blocks = placed.select("root", "block").distinct()
    pairs = blocks.select("root", F.col("block").alias("one")).join(
        blocks.select("root", F.col("block").alias("two")), "root").where(
        (F.col("one") < F.col("two")) | ((F.col("one") == F.col("two")) & (F.length("one.of") == 0)))
    # Blocks of one old set have met.
    pairs = pairs.where((F.length("one.of") == 0) | (F.col("one.of") != F.col("two.of")))
    unit = F.struct("root", "one", "two")
    sides = pairs.select("root", F.explode(F.when(F.col("one") == F.col("two"), F.array(
        F.struct(F.col("one").alias("block"), F.lit(0).alias("side")))).otherwise(F.array(
            F.struct(F.col("one").alias("block"), F.lit(0).alias("side")),
            F.struct(F.col("two").alias("block"), F.lit(1).alias("side"))))).alias("s"), unit.alias("unit"))
    return placed.join(sides.select("root", "s.block", "s.side", "unit"), ["root", "block"]).select(
        "unit", "key", "copies", "side", "old")


def _grown(sets: DataFrame | None, pairs: DataFrame) -> tuple[DataFrame | None, DataFrame | None]:
    """(members of sets that ``pairs`` make or join, all sets after it): key, old, root."""
    if sets is not None:
        names = sets.select("key", "root")
        for side in ("u", "v"):
            pairs = pairs.join(names.withColumnsRenamed({"key": side, "root": f"{side}_root"}), side, "left").withColumn(
                side, F.coalesce(f"{side}_root", side)).drop(f"{side}_root")
    pairs = stored(pairs.where("u <> v").distinct(), "join-pairs")
    if pairs.isEmpty():
        return None, sets
    joined = components(pairs, "join-near")
    if sets is None:
        members = joined.select(F.col("node").alias("key"), F.col("node").alias("old"), "root")
        members = stored(members, "join-members")
        return members, members
    moved = sets.select("key", F.col("root").alias("old")).join(joined.withColumnRenamed("node", "old"), "old")
    new = joined.join(sets.select(F.col("root").alias("node")).distinct(), "node", "left_anti").select(
        F.col("node").alias("key"), F.col("node").alias("old"), "root")
    members = stored(moved.select("key", "old", "root").unionByName(new), "join-members")
    kept = sets.join(members.select("key"), "key", "left_anti")
    return members, stored(kept.unionByName(members), "join-sets")


def found_share(percents: dict[int, int], depth: int, trees: int = TREES) -> float | None:
    """The share of all links that a prefix of this depth finds, from the similarities of those it found."""
    if not percents:
        return None
    total = sum(n / (1 - (1 - (p / 100) ** depth) ** trees) for p, n in percents.items())
    return sum(percents.values()) / total


def _verified(texts: DataFrame, rows: DataFrame, similarity: float, target: float = TARGET) -> DataFrame:
    """u, v, links: per text and level how many links it has, and a spanning forest of them."""
    floor = prefix_depth(similarity)
    met = meetings(texts, DEPTH, floor)
    nodes = stored(met.select(F.explode(F.array("u", "v")).alias("key")).distinct().join(
        texts.select("key", "copies", "doc_id", "handle"), "key"), "join-nodes")
    chosen = nodes.select(F.col("doc_id").alias("own"), F.col("handle").alias("mine"))
    again = rows.join(chosen, F.col("doc_id").eqNullSafe(F.col("own")) & (F.col("handle") == F.col("mine")),
                      "left_semi").select("text")
    runs = stored(again.mapInArrow(_runs_of, "key binary, runs binary").dropDuplicates(["key"]), "join-runs")
    sets, parts, percents = None, [], {}
    for depth in range(DEPTH, floor - 1, -1):
        members, sets = _grown(sets, met.where(F.col("depth") == depth).select("u", "v"))
        if members is not None:
            work = (_units(members.join(nodes.select("key", "copies"), "key")).join(runs, "key")
                    .select("unit", "key", "copies", "side", "old", "runs"))
            part = stored(work.repartition("unit").sortWithinPartitions("unit", "key").mapInArrow(
                _verify(similarity), "u binary, v binary, links long, percent int"), "join-links")
            parts.append(part.where("u IS NOT NULL").select("u", "v", "links"))
            # One row per percent.
            for r in part.where("percent IS NOT NULL").groupBy("percent").agg(F.sum("links").alias("n")).collect():
                percents[r["percent"]] = percents.get(r["percent"], 0) + r["n"]
        share = found_share(percents, depth)
        if share is not None and share >= target:
            break
    none = met.select("u", "v", F.lit(0).cast("long").alias("links")).limit(0)
    return reduce(DataFrame.unionByName, parts, none)


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
            similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, handle, class_id, n_links, kept.

    ``n_links`` counts the other documents whose shingle sets are similar to its
    own, copies included; classes are connected by links. ``class_id`` is the
    smallest id in the class; that document, or all rows that repeat it, is
    ``kept``. A null text and a text without words are linked to nothing and are
    classes of their own; so are such rows with a null id, whose class is null. A
    null id never names a class that has another. Empty tables give empty
    results; other columns are ignored. ``handle`` is the text's xxhash64.
    """
    rows = docs.select(named(doc_id).cast("long").alias("doc_id"),
                       F.xxhash64(named(text)).alias("handle"), named(text).alias("text"))
    signed = stored(rows.mapInArrow(
        _forest(DEPTH, TREES), "doc_id long, handle long, key binary, size int, paths array<long>"), "join-signed")

    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "handle"))
    texts = stored(signed.where("key IS NOT NULL").groupBy("key").agg(
        F.count(F.lit(1)).alias("copies"), first.alias("first"),
        F.first("paths").alias("paths")).select(
        "key", "copies", F.col("first.doc_id").alias("doc_id"),
        F.col("first.handle").alias("handle"), "paths"), "join-texts")

    links = _verified(texts, rows, similarity)

    linked = links.groupBy(F.col("u").alias("key")).agg(F.sum("links").alias("links"))
    roots = components(links.select("u", "v"), "join-classes").select(
        F.col("node").alias("key"), F.col("root").alias("class"))
    known = (texts.select("key", "copies", "doc_id", "handle")
             .join(linked, "key", "left").join(roots, "key", "left")
             .withColumn("class", F.coalesce("class", "key")))
    known = stored(known, "join-known")
    heads = stored(known.groupBy("class").agg(first.alias("head")), "join-heads")
    of_text = stored(known.join(heads, "class").select(
        "key", F.col("head.doc_id").alias("class_id"), F.col("head.handle").alias("class_handle"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "join-of-text")
    joined = signed.select("doc_id", "handle", "key").join(of_text, "key", "left")
    alone = F.col("key").isNull()
    return joined.select(
        "doc_id", "handle",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        (alone | (F.col("doc_id").eqNullSafe(F.col("class_id"))
                  & (F.col("handle") == F.col("class_handle")))).alias("kept"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each class, with all its columns, whatever their names and types.

    The document with the class's smallest id stays, and rows that repeat its id
    and text stay with it. Null texts and texts without words all stay. Of tied
    ids, documents with the smaller text hash stay. An empty table stays empty.
    """
    own, handle = free_name(docs, "__id"), free_name(docs, "__handle")
    dropped = stored(classes(docs, doc_id, text).where("NOT kept").select(
        F.col("doc_id").alias(own), F.col("handle").alias(handle)).distinct(), "join-dropped")
    same = named(doc_id).cast("long").eqNullSafe(F.col(own)) & (F.xxhash64(named(text)) == F.col(handle))
    return docs.join(dropped, same, "left_anti")
