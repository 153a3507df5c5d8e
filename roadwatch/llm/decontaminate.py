"""Benchmark passages in documents, allowing for edits.

Texts are words: lower case, ASCII punctuation gone. A document holds an item if
some stretch of its words is within ``MOST_EDITS`` word edits per item word. The
search, per batch of documents:

1. Gate. k edits change at most 2k of an item's word pairs, so a stretch that can
   match holds many of them close together. Only regions where they are dense enough,
   and enough of one item's, are searched further; the rest cannot match any item.
2. Embedding. The CGK random walk copies the word at its place and stays or moves on
   as a random bit of that word says. Walks that read the same text fall into step
   again behind an edit, so few edits leave walks that agree at many steps: edit
   distance becomes Hamming distance. Items are walked over their whole length, from
   several anchors, forwards and backwards, by independent walks; so is the window at
   every word of a region, as far as an item reaches.
3. Bit sampling. A key is a few sampled steps of one walk. A window and an item with
   one equal key, of any walk, direction and repeat, are a candidate. How many repeats
   of how many steps that takes is measured on the items themselves: edited copies at
   the bound, with edits at the head, the tail, in the middle and anywhere, have to be
   found with the target recall; then the repeats are doubled.
4. Each candidate (region, item) is verified by exact edit distance of the item
   to its best stretch of the region.

Items of fewer than ``LEAST_WORDS`` words may have no edit; their copies are found
by equal word runs.
"""

from __future__ import annotations

import math
import re
import uuid
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import map_rows, named, ship, worker_cache

ship(__name__)

MOST_EDITS = 0.2  # edits per item word
LEAST_WORDS = 5  # shorter items may have no edit
WALKS = 4  # in each direction
SAMPLED = (6, 4, 3, 2, 1)  # steps of a key; fewer if repeats do not reach the recall
RECALL, MOST_REPEATS = 0.999, 8
BANDS = (3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256)  # steps that keys are drawn from
TRIED_ITEMS = 48  # items, of all lengths, whose edited copies are tried
STARTS_AT_ONCE = 20_000
ITEMS_AT_ONCE = 20_000
GROUP_CHARS = 1 << 20

_TABLE = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))
# Scripts written without blanks: each character is a word.
_UNSPACED = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff"
                       "\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff])")
_MARK = b"\x01"  # between documents; no word of a text holds it


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(_TABLE).split()


def _spaced(text: str) -> bytes:
    """The text's words between blanks, and its characters in scripts without blanks."""
    if not text.isascii():
        text = _UNSPACED.sub(r" \1 ", text)
    return text.lower().encode("utf-8", "replace").translate(_TABLE)


def most_edits(words: int, share: float = MOST_EDITS) -> int:
    return int(share * words + 1e-9)


def edit_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """(edits, end) of the stretch of ``text`` nearest to ``item``; of equal ones the first."""
    steps = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for i, word in enumerate(item):
        down = row + 1
        best = down.copy()
        best[1:] = np.minimum(best[1:], row[:-1] + (text != word))
        best[0] = i + 1
        row = np.minimum.accumulate(best - steps) + steps
    end = int(row.argmin())
    return int(row[end]), end


class Searcher:
    """Finds a block of items in texts. Built from the items' words; ``plan``, the sampled steps, is
    measured where it is not given."""

    def __init__(self, items: list[tuple[int, str]], share: float = MOST_EDITS,
                 plan: list[dict[int, np.ndarray]] | None = None):
        self.share = share
        self.ids, texts, short = [], [], {}
        for item_id, text in items:
            words = _spaced(text or "").split()
            if len(words) >= LEAST_WORDS:
                self.ids.append(item_id)
                texts.append(words)
            elif words:
                short.setdefault(tuple(words), []).append(item_id)
        self.vocabulary: dict[bytes, int] = {}
        # By length: the short items' word runs as sorted numbers, and their ids.
        self.short_words: dict[bytes, int] = {_MARK: -2}
        runs: dict[int, list] = {}
        for words, ids in short.items():
            for word in words:
                self.short_words.setdefault(word, len(self.short_words) - 1)
            runs.setdefault(len(words), []).append((words, ids))
        self.short = {}
        for length, members in runs.items():
            keys = self._runs(np.array([self.short_words[w] for words, _ in members for w in words]), length)[::length]
            order = np.argsort(keys)
            self.short[length] = keys[order], [members[i] for i in order]
        self.items = [np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words])
                      for words in texts]
        if not self.items:
            return
        size = len(self.vocabulary)
        self.codes = {**self.vocabulary, _MARK: -2}
        pairs = [x[:-1].astype(np.int64) * size + x[1:] for x in self.items]
        # By distinct pair: the items that have it and how often, between two bounds.
        both, self.pair_times = np.unique(np.stack([
            np.concatenate(pairs), np.repeat(np.arange(len(pairs)), [len(p) for p in pairs])]),
            axis=1, return_counts=True)
        self.pair_items = both[1]
        self.pairs, first = np.unique(both[0], return_index=True)
        self.pair_bounds = np.append(first, len(self.pair_items))
        self.pairs_needed = np.array([max(1, len(x) - 1 - 2 * most_edits(len(x), self.share)) for x in self.items])
        # Pairs are counted over as many words as the shortest item may stretch to.
        shortest = min(map(len, self.items))
        self.span = shortest + most_edits(shortest, share) - 1
        self.dense = min(self._dense(len(x)) for x in self.items)
        self.longest = max(len(x) + most_edits(len(x), share) for x in self.items)

        # Walks move at most one word a step, and on average half a one.
        self.steps = 2 * max(map(len, self.items)) + 2
        rng = np.random.default_rng(11)
        self.bits = rng.integers(0, 1 << 63, (2 * WALKS, -(-self.steps // 64), size + 1), dtype=np.uint64) * np.uint64(2) + (
            rng.integers(0, 2, (2 * WALKS, -(-self.steps // 64), size + 1), dtype=np.uint64))
        self.plan = self._measured() if plan is None else plan
        self.keys = self._index(self.items, self.plan)

    def _anchors(self, length: int, forward: bool) -> list[int]:
        places = sorted({0, length // 4, length // 2})
        return places if forward else [length - 1 - p for p in places]

    def _index(self, items: list[np.ndarray], plan) -> dict:
        """By (walk, band, repeat): the items' keys, sorted, and the items they are of."""
        joined, firsts = _joined(items, self.steps, len(self.vocabulary))
        found: dict = {}
        for forward in (True, False):
            places = [(i, first + anchor, first + len(x) - 1 if forward else first)
                      for i, (x, first) in enumerate(zip(items, firsts)) for anchor in self._anchors(len(x), forward)]
            members, starts, ends = np.array(places).T
            for low in range(0, len(starts), STARTS_AT_ONCE):
                part = slice(low, low + STARTS_AT_ONCE)
                for walk in range(WALKS) if forward else range(WALKS, 2 * WALKS):
                    trail, at = self._walk(joined, starts[part], walk)
                    inside = (at <= ends[part]) if forward else (at >= ends[part])
                    valid = inside.sum(axis=0)  # steps before the walk leaves its item
                    for (band, repeat), key in self._sampled(trail, plan).items():
                        # The longest band that fits, and one of about half its length.
                        fits = (valid >= band) & ((valid < band * 1.6) | ((valid >= 2 * band) & (valid < band * 3.2)))
                        if fits.any():
                            found.setdefault((walk, band, repeat), []).append((key[fits], members[part][fits]))
        index = {}
        for name, parts in found.items():
            keys, owners = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(keys, kind="stable")
            index[name] = keys[order], owners[order]
        return index

    def _measured(self) -> list[dict[int, np.ndarray]]:
        """Sampled steps per band, one dictionary a repeat: so many that edited copies are found."""
        by_length = sorted(range(len(self.items)), key=lambda i: len(self.items[i]))
        tried = [by_length[i] for i in np.linspace(0, len(by_length) - 1, min(TRIED_ITEMS, len(by_length))).astype(int)]
        copies = [(i, copy) for i in tried for copy in self._copies(self.items[i], i)]
        regions = [copy for _, copy in copies]
        wanted = np.arange(len(copies)) * len(self.items) + np.array([i for i, _ in copies])
        rng, plan, found = np.random.default_rng(17), [], np.empty(0, np.int64)

        def drawn(sampled: int) -> dict[int, np.ndarray]:
            return {band: np.sort(rng.choice(band, min(sampled, band - 1), replace=False))
                    for band in BANDS if band <= self.steps}
        for sampled in SAMPLED:
            for _ in range(MOST_REPEATS):
                fresh = drawn(sampled)
                plan.append(fresh)
                found = np.union1d(found, self._candidates(regions, self._index(self.items, [fresh]), [fresh]))
                if np.isin(wanted, found).mean() >= RECALL:
                    return plan + [drawn(sampled) for _ in plan]
        return plan

    def _copies(self, item: np.ndarray, seed: int):
        """The item with as many edits as it may have, clustered and spread, among other words."""
        rng, edits = np.random.default_rng(seed), most_edits(len(item), self.share)
        size = len(self.vocabulary)

        def words(n):
            return rng.integers(0, size + 1, n)
        last = len(item) - edits
        for first in (0, last, last // 2, None):
            for kind in ("cut", "replaced", "inserted"):
                if first is None:
                    at, parts, done = np.sort(rng.choice(len(item), edits, replace=False)), [], 0
                    for place in at:
                        parts += [item[done:place], words(int(kind != "cut"))]
                        done = place + (kind != "inserted")
                    changed = np.concatenate([*parts, item[done:]])
                else:
                    behind = item[first + (edits if kind != "inserted" else 0):]
                    changed = np.concatenate([item[:first], words(edits if kind != "cut" else 0), behind])
                yield np.concatenate([words(6), changed, words(6)])

    def _dense(self, length: int) -> int:
        edits = most_edits(length, self.share)
        needed, span = length - 1 - 2 * edits, length + edits - 1
        return max(1, math.ceil(needed / math.ceil(span / self.span)))

    def _runs(self, codes: np.ndarray, length: int) -> np.ndarray:
        """The run of ``length`` words at each place as one number; equal runs have equal numbers."""
        places = max(0, len(codes) - length + 1)
        keys = np.zeros(places, np.int64)
        for i in range(length):
            keys = keys * 0x01000193 + codes[i:i + places]
        return keys

    def _short_hits(self, words: list[bytes]) -> dict[tuple[int, int], tuple[int, int]]:
        """The first copy of each short item in each document."""
        if not self.short:
            return {}
        codes = np.fromiter(map(self.short_words.get, words, repeat(-1)), np.int64, len(words))
        limits = np.concatenate([[-1], np.flatnonzero(codes == -2)])
        found = {}
        for length, (known, members) in self.short.items():
            keys = self._runs(codes, length)
            inside = np.ones(len(keys), bool)
            for i in range(length):
                inside &= codes[i:i + len(keys)] >= 0
            maybe = np.flatnonzero(inside)
            low = np.searchsorted(known, keys[maybe], "left")
            high = np.searchsorted(known, keys[maybe], "right")
            for at, a, b in zip(maybe[high > low].tolist(), low[high > low].tolist(), high[high > low].tolist()):
                doc = int(np.searchsorted(limits, at)) - 1
                for wanted, ids in members[a:b]:
                    if tuple(words[at:at + length]) == wanted:
                        for item in ids:
                            found.setdefault((doc, item), (0, at + length - int(limits[doc]) - 1))
        return found

    def _walk(self, words: np.ndarray, starts: np.ndarray, walk: int) -> tuple[np.ndarray, np.ndarray]:
        """The embedding of the windows at ``starts`` and where each step reads, one row a step."""
        at = starts.copy()
        trail, places = (np.empty((self.steps, len(starts)), np.int64) for _ in range(2))
        way = 1 if walk < WALKS else -1
        for step in range(self.steps):
            places[step] = at
            trail[step] = words[at]
            at += way * ((self.bits[walk, step // 64][trail[step]] >> np.uint64(step % 64)) & np.uint64(1)).astype(np.int64)
        return trail, places

    def _sampled(self, trail: np.ndarray, plan) -> dict[tuple[int, int], np.ndarray]:
        """By band and repeat, the sampled steps as one number."""
        keys = {}
        for repeat, bands in enumerate(plan):
            for band, steps in bands.items():
                key = np.zeros(trail.shape[1], np.int64)
                for step in steps:
                    key = key * 0x01000193 + trail[step]
                    key ^= key >> 29
                keys[band, repeat] = key
        return keys

    def search(self, texts: list[str]) -> list[tuple[int, int, int, int]]:
        """(text, item id, first word after the stretch, edits) for each item a text holds."""
        words = b" \x01 ".join(map(_spaced, texts)).split()
        found = self._short_hits(words)
        for hit, value in self._long_hits(words).items():
            found[hit] = min(found.get(hit, value), value)
        return [(doc, item, end, edits) for (doc, item), (edits, end) in sorted(found.items())]

    def _long_hits(self, words: list[bytes]) -> dict[tuple[int, int], tuple[int, int]]:
        if not self.items:
            return {}
        size = len(self.vocabulary)
        codes = np.fromiter(map(self.codes.get, words, repeat(-1)), np.int64, len(words))
        if len(codes) < 2:
            return {}
        maybe = np.flatnonzero((codes[:-1] >= 0) & (codes[1:] >= 0))
        pair = codes[maybe] * size + codes[maybe + 1]
        place = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        hits = maybe[self.pairs[place] == pair]
        if not len(hits):
            return {}
        # Hits with enough hits in the span that begins at them.
        crowd = np.searchsorted(hits, hits + self.span) - np.arange(len(hits))
        dense = hits[crowd >= self.dense]
        if not len(dense):
            return {}
        document = np.concatenate([[0], np.cumsum(codes == -2)])
        limits = np.concatenate([[-1], np.flatnonzero(codes == -2), [len(codes)]])
        regions = []
        for at in dense.tolist():
            doc = int(document[at])
            low = max(at - self.longest, int(limits[doc]) + 1)
            high = min(at + self.span + self.longest, int(limits[doc + 1]))
            if regions and regions[-1][0] == doc and low <= regions[-1][2]:
                regions[-1][2] = max(high, regions[-1][2])
            else:
                regions.append([doc, low, high])
        regions = np.array(regions)
        possible = self._enough_pairs(regions, hits, place[self.pairs[place] == pair])
        kept = np.unique(possible // len(self.items))
        if not len(kept):
            return {}
        other = len(self.vocabulary)  # any word that no item has
        parts = [np.where(codes[low:high] < 0, other, codes[low:high]) for _, low, high in regions[kept]]
        candidates = self._candidates(parts, self.keys, self.plan)
        candidates = kept[candidates // len(self.items)] * len(self.items) + candidates % len(self.items)
        found: dict[tuple[int, int], tuple[int, int]] = {}
        for region, item in zip(*np.divmod(np.intersect1d(candidates, possible), len(self.items))):
            doc, low, high = regions[region].tolist()
            wanted = self.items[item]
            edits, end = edit_distance(wanted, codes[low:high])
            if edits <= most_edits(len(wanted), self.share):
                hit = (edits, low + end - int(limits[doc]) - 1)
                key = doc, self.ids[item]
                found[key] = min(found.get(key, hit), hit)
        return found

    def _enough_pairs(self, regions: np.ndarray, hits: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        """region x item, as one number, where the region has as many of the item's pairs as a match needs."""
        low, high = np.searchsorted(hits, regions[:, 1]), np.searchsorted(hits, regions[:, 2])
        counts = high - low
        at = _ranges(low, counts)
        held = np.unique(np.repeat(np.arange(len(regions)), counts) * len(self.pairs) + pairs[at])
        region, pair = np.divmod(held, len(self.pairs))
        counts = np.diff(self.pair_bounds)[pair]
        at = _ranges(self.pair_bounds[pair], counts)
        keys = np.repeat(region, counts) * len(self.items) + self.pair_items[at]
        keys, inverse = np.unique(keys, return_inverse=True)
        shared = np.bincount(inverse, weights=self.pair_times[at])
        return keys[shared >= self.pairs_needed[keys % len(self.items)]]

    def _candidates(self, regions: list[np.ndarray], index: dict, plan) -> np.ndarray:
        """region x item, as one number, where some window's key equals one of the item's."""
        other = len(self.vocabulary)
        found = [np.empty(0, np.int64)]
        joined, firsts = _joined(regions, self.steps, other)
        owner = np.repeat(np.arange(len(regions)), [len(r) for r in regions])
        starts = _ranges(firsts, np.array([len(r) for r in regions]))
        known = joined[starts] < other  # an item's walk begins at a word of its own
        starts, owner = starts[known], owner[known]
        for low in range(0, len(starts), STARTS_AT_ONCE):
            part = slice(low, low + STARTS_AT_ONCE)
            for walk in range(2 * WALKS):
                trail, _ = self._walk(joined, starts[part], walk)
                for (band, repeat), mine in self._sampled(trail, plan).items():
                    if (walk, band, repeat) not in index:
                        continue
                    keys, members = index[walk, band, repeat]
                    a, b = np.searchsorted(keys, mine, "left"), np.searchsorted(keys, mine, "right")
                    hit = np.flatnonzero(b > a)
                    if len(hit):
                        counts = b[hit] - a[hit]
                        found.append(np.unique(np.repeat(owner[part][hit], counts) * len(self.items)
                                               + members[_ranges(a[hit], counts)]))
        return np.unique(np.concatenate(found))


def _ranges(firsts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each range, one after the other."""
    return np.repeat(firsts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


def _joined(parts: list[np.ndarray], gap: int, filler: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The parts in one array, ``gap`` fillers before and behind each, and where each begins."""
    pieces, firsts, at = [np.full(gap, filler)], [], gap
    for part in parts:
        firsts.append(at)
        pieces += [part, np.full(gap, filler)]
        at += len(part) + gap
    return np.concatenate(pieces), np.array(firsts)


def find(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
         item_id: str = "item_id", item_text: str = "text", share: float = MOST_EDITS) -> DataFrame:
    """One row per document and item it holds: doc_id, item_id, end_word, edits.

    ``end_word`` is the number of the document's words up to the end of the
    nearest stretch. Null texts hold nothing and are held by nothing; items of
    fewer than five words are found as they are; repeated rows are searched each
    and repeated items reported each. Empty tables give an empty result.
    """
    rows = docs.select(named(doc_id).cast("long").alias("doc_id"), named(text).alias("text")).where(
        "text IS NOT NULL")
    parts = [rows.mapInArrow(_search(block, share), "doc_id long, item_id long, end_word long, edits int")
             for block in _blocks(items, item_id, item_text)]
    return reduce(DataFrame.unionByName, parts)


def _blocks(items: DataFrame, item_id: str, item_text: str):
    """The query set in blocks of a stated size, each to be searched against all documents."""
    listed = items.select(named(item_id).cast("long").alias("i"), named(item_text).alias("t")).where(
        "t IS NOT NULL")
    blocks = -(-max(1, listed.count()) // ITEMS_AT_ONCE)
    for block in range(blocks):
        yield [(r["i"], r["t"]) for r in listed.where(
            F.pmod(F.xxhash64("t"), F.lit(blocks)) == block).orderBy("i", "t").collect()]


def _groups(texts: list[str | None]):
    """Ranges of texts with about ``GROUP_CHARS`` characters."""
    low, chars = 0, 0
    for i, text in enumerate(texts):
        chars += len(text or "")
        if chars >= GROUP_CHARS or i + 1 == len(texts):
            yield low, i + 1
            low, chars = i + 1, 0


def _searcher(items: list[tuple[int, str]], share: float):
    """What gives a task its searcher: measured once, here, and built once in every worker."""
    plan = getattr(Searcher(items, share), "plan", None)
    name = "searcher", uuid.uuid4().hex

    def make() -> Searcher:
        cache = worker_cache("decontamination")
        if name not in cache:
            for old in [k for k in cache if k[0] == "searcher"]:  # one block's at a time
                del cache[old]
            cache[name] = Searcher(items, share, plan)
        return cache[name]
    return make


def _search(items: list[tuple[int, str]], share: float):
    make = _searcher(items, share)

    def run(batches):
        searcher = make()
        for batch in batches:
            texts, doc_ids = batch.column(1).to_pylist(), batch.column(0).to_pylist()
            for low, high in _groups(texts):
                hits = searcher.search(texts[low:high])
                if hits:
                    yield pa.RecordBatch.from_arrays([
                        pa.array([doc_ids[low + h[0]] for h in hits], pa.int64()),
                        pa.array([h[1] for h in hits], pa.int64()),
                        pa.array([h[2] for h in hits], pa.int64()),
                        pa.array([h[3] for h in hits], pa.int32())],
                        names=["doc_id", "item_id", "end_word", "edits"])
    return run


def _without(items: list[tuple[int, str]], share: float, names: list[str], text: str):
    at, make = names.index(text), _searcher(items, share)

    def run(batches):
        searcher = make()
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            clean = np.ones(len(texts), bool)
            for low, high in _groups(texts):
                clean[[low + h[0] for h in searcher.search(texts[low:high])]] = False
            yield batch.filter(pa.array(clean))
    return run


def keep_clean(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
               item_text: str = "text", share: float = MOST_EDITS) -> DataFrame:
    """The rows that hold no item, with all their columns, without a shuffle.

    Rows with a null text hold none. An empty table of items leaves all rows.
    """
    for block in _blocks(items, item_id, item_text):
        docs = map_rows(docs, _without(block, share, docs.columns, text))
    return docs
