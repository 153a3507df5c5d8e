"""Language-model scores by deleted interpolation.

The probability of a token after the one before it is a mixture of three
estimates: the pair's relative frequency, the token's, and a uniform one. The
weights depend on how often the context was seen (by powers of two). They are
fitted by expectation-maximisation: a part of the training documents is deleted,
counts come from the rest, and the deleted tokens are what the weights must
explain. Scores then use the counts of all training documents.

Counting and looking up are one shuffle. Documents are read in batches; a batch
sends its distinct words and pairs, as sorted 64-bit hashes in one block per hash
range, and gets the corpus counts back in the same order. A frequent pair is one
number per batch, so nothing is hot; all counts cover all documents. Blocks are
delta-coded and compressed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..sources.stored import stored
from .common import named, remainder, ship

ship(__name__)

FOLDS, HELD_OUT, DELETED = 7, 2, 6
BATCH_TOKENS = 2_000_000
PART_BYTES = 12_000_000  # text bytes whose hashes make one range
CHUNK_TOKENS = 1 << 18  # tokens that are scored together
PAIR_BITS = 56  # of a pair's hash; a word's has 64
BINS = 8  # per power of two, of the estimates that weights are fitted on
ROUNDS = 60
END = np.uint64(0x5BD1E9955BD1E995)  # the end token's hash

WORD, PAIR, DOCS, COUNTS, TOTALS = range(5)

_BLOCK = pa.schema([("kind", pa.int32()), ("batch", pa.int64()), ("part", pa.int32()),
                    ("n", pa.int64()), ("a", pa.binary()), ("b", pa.binary())])
BLOCK_SCHEMA = "kind int, batch long, part int, n long, a binary, b binary"


@dataclass(frozen=True)
class Weights:
    """By bucket of the context's count: shares of pair, word and uniform estimate."""

    table: np.ndarray


def _packed(*arrays: np.ndarray) -> bytes:
    """Numbers by byte plane, compressed."""
    planes = [a.view(np.uint8).reshape(len(a), -1).T.tobytes() for a in arrays]
    raw = b"".join(planes)
    return len(raw).to_bytes(8, "little") + (pa.compress(raw, "zstd", asbytes=True) if raw else b"")


def _unpacked(blob: bytes, n: int, *kinds) -> list[np.ndarray]:
    size = int.from_bytes(blob[:8], "little")
    raw = pa.decompress(blob[8:], size, "zstd", asbytes=True) if size else b""
    out, at = [], 0
    for kind in map(np.dtype, kinds):
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += n * kind.itemsize
    return out


def _delta(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=np.uint64(0))


def _undelta(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _ranges(keys: np.ndarray, parts: int, bits: int) -> list[tuple[int, int, int]]:
    """(hash range, first, end) of sorted keys, for the ranges that have any: no more than keys."""
    used = min(bits, 64 - parts.bit_length())  # of a key's bits: as many as multiply without overflow
    of = ((keys >> np.uint64(bits - used)) * np.uint64(parts)) >> np.uint64(used)
    found, firsts = np.unique(of, return_index=True)
    return list(zip(found.tolist(), firsts.tolist(), [*firsts[1:].tolist(), len(keys)]))


class _Index(dict):
    def __missing__(self, word):
        place = self[word] = len(self)
        return place


def _row(kind, batch, part, n, a, b=b""):
    return pa.RecordBatch.from_arrays(
        [pa.array([v], t) for v, t in zip((kind, batch, part, n, a, b), _BLOCK.types)], schema=_BLOCK)


def _word_hashes(words) -> np.ndarray:
    import xxhash
    return np.fromiter((xxhash.xxh64_intdigest(w, 3) for w in words), np.uint64, len(words))


def _grams(hashes: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Each token's pair with the token before it; the first follows an end."""
    before = np.concatenate([[END], hashes[tokens[:-1]]])
    mixed = _mixed(before * np.uint64(0x9E3779B97F4A7C15) + hashes[tokens])
    return mixed >> np.uint64(64 - PAIR_BITS)


def _by_frequency(hashes: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words in order of falling powers of two of their counts, then of their hashes: small places
    for frequent words, small steps between hashes."""
    power = np.frexp(np.bincount(tokens, minlength=len(hashes)).astype(np.float64))[1]
    order = np.lexsort((hashes, -power))
    place = np.empty(len(order), np.uint32)
    place[order] = np.arange(len(order), dtype=np.uint32)
    return hashes[order], place[tokens]


def _encode(parts: int):
    def blocks(batch, doc_ids, folds, lengths, index, tokens):
        hashes = _word_hashes([w for w in index if w is not None])
        hashes = np.concatenate([[END], hashes])  # the end token has place 0
        hashes, tokens = _by_frequency(hashes, np.concatenate(tokens))
        lengths, folds = np.array(lengths, np.int32), np.array(folds, np.int32)
        fold = np.repeat(folds, lengths)
        trained, kept = fold != HELD_OUT, (fold != HELD_OUT) & (fold != DELETED)
        head = np.array([len(hashes), len(tokens), len(lengths)], np.int64).tobytes()
        ids = np.array([d or 0 for d in doc_ids], np.int64)
        nulls = np.array([d is None for d in doc_ids], np.uint8)
        yield _row(DOCS, batch, -1, len(tokens), head + _packed(_delta(hashes), tokens),
                   _packed(ids, nulls, folds, lengths))
        for kind, bits in ((WORD, 64), (PAIR, PAIR_BITS)):
            grams = hashes[tokens] if kind == WORD else _grams(hashes, tokens)
            keys, codes = np.unique(grams, return_inverse=True)
            del grams
            every = np.bincount(codes[trained], minlength=len(keys)).astype(np.uint32)
            some = np.bincount(codes[kept], minlength=len(keys)).astype(np.uint32)
            for p, low, high in _ranges(keys, parts, bits):
                yield _row(kind, batch, p, high - low, _packed(_delta(keys[low:high])),
                           _packed(every[low:high], some[low:high]))

    def run(batches):
        def fresh():
            index = _Index()
            index[None] = 0
            return [], [], [], index, []
        # Deleted documents have batches of their own, with odd numbers: the weights need only those.
        states, held, number = [fresh(), fresh()], [0, 0], TaskContext.get().partitionId() << 24
        for batch in batches:
            for doc_id, fold, text in zip(*(c.to_pylist() for c in batch.columns)):
                of = int(fold == DELETED)
                doc_ids, folds, lengths, index, tokens = states[of]
                words = text.encode("utf-8", "replace").lower().split()
                codes = np.zeros(len(words) + 1, np.uint32)
                codes[:-1] = np.fromiter(map(index.__getitem__, words), np.uint32, len(words))
                doc_ids.append(doc_id)
                folds.append(fold)
                lengths.append(len(codes))
                tokens.append(codes)
                held[of] += len(codes)
                if held[of] >= BATCH_TOKENS:
                    yield from blocks(2 * number + of, *states[of])
                    states[of], held[of], number = fresh(), 0, number + 1
        for of in (0, 1):
            if held[of]:
                yield from blocks(2 * number + of, *states[of])
                number += 1
    return run


def _rows_of(batch):
    return zip(*(c.to_pylist() for c in batch.columns))


def _count(batches):
    """Blocks of one hash range and kind to corpus counts, and back to their batches."""
    def answers(kind, part, blocks):
        keys = [_undelta(_unpacked(a, n, np.uint64)[0]) for _, n, a, _ in blocks]
        counts = [_unpacked(b, n, np.uint32, np.uint32) for _, n, _, b in blocks]
        known, place = np.unique(np.concatenate(keys), return_inverse=True)
        del keys
        every, some = (np.bincount(place, weights=np.concatenate([c[i] for c in counts]).astype(float),
                                   minlength=len(known)).astype(np.uint64) for i in (0, 1))
        at = 0
        for batch, n, _, _ in blocks:
            mine = place[at:at + n]
            yield _row(COUNTS, batch, 2 * part + kind, n, _packed(every[mine]),
                       _packed(some[mine]) if batch % 2 else b"")
            at += n
        if kind == WORD:
            sums = [every.sum(), (every > 0).sum(), some.sum(), (some > 0).sum()]
            yield _row(TOTALS, 0, part, 0, np.array(sums, np.int64).tobytes())

    now, blocks = None, []
    for batch in batches:
        for kind, number, part, n, a, b in _rows_of(batch):
            if kind == DOCS:
                yield _row(kind, number, part, n, a, b)
                continue
            if (kind, part) != now:
                if blocks:
                    yield from answers(*now, blocks)
                now, blocks = (kind, part), []
            blocks.append((number, n, a, b))
    if blocks:
        yield from answers(*now, blocks)


def _per_batch(work, deleted: bool):
    """Run ``work`` over the batches' tokens, some documents at a time.

    It gets the documents and, per token, its place and its predecessor's and
    its pair's place, and the counts by place.
    """
    def whole(rows):
        head, body, info, answers = None, None, None, {}
        for kind, part, n, a, b in rows:
            if kind == DOCS:
                head, body, info = np.frombuffer(a[:24], np.int64), a[24:], b
            else:
                answers[part] = _unpacked(b if deleted else a, n, np.uint64)[0].astype(np.float64)
        words, n, docs = (int(x) for x in head)
        size = int.from_bytes(body[:8], "little")
        raw = pa.decompress(body[8:], size, "zstd", asbytes=True)
        planes = np.frombuffer(raw, np.uint8, words * 8).reshape(8, words)
        hashes = _undelta(np.ascontiguousarray(planes.T).reshape(-1).view(np.uint64))
        planes = np.frombuffer(raw, np.uint8, n * 4, words * 8).reshape(4, n)
        tokens = np.ascontiguousarray(planes.T).reshape(-1).view(np.uint32)
        del raw, planes
        info = _unpacked(info, docs, np.int64, np.uint8, np.int32, np.int32)
        of_pairs = np.concatenate([answers[p] for p in sorted(answers) if p % 2 == PAIR])
        of_words = np.empty(words)
        of_words[np.argsort(hashes)] = np.concatenate([answers[p] for p in sorted(answers) if p % 2 == WORD])
        pair = np.unique(_grams(hashes, tokens), return_inverse=True)[1].astype(np.uint32)
        end = np.uint32(np.flatnonzero(hashes == END)[0])
        lengths = info[3]
        ends = np.cumsum(lengths, dtype=np.int64)
        first = 0
        while first < docs:
            start = ends[first] - lengths[first]
            last = max(first + 1, int(np.searchsorted(ends, start + CHUNK_TOKENS)))
            stop = ends[last - 1]
            mine = tokens[start:stop]
            before = np.concatenate([[end if start == 0 else tokens[start - 1]], mine[:-1]])
            yield work([x[first:last] for x in info], of_words[mine], of_words[before],
                       of_pairs[pair[start:stop]])
            first = last

    def run(batches):
        now, rows = None, []
        for batch in batches:
            for kind, number, part, n, a, b in _rows_of(batch):
                if number != now:
                    if rows:
                        yield from whole(rows)
                    now, rows = number, []
                rows.append((kind, part, n, a, b))
        if rows:
            yield from whole(rows)
    return run


def bucket(count: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else one more than the power of two below its count."""
    return np.frexp(count)[1].astype(np.int64)


def _of_pair(pair: np.ndarray, context: np.ndarray) -> np.ndarray:
    return np.divide(pair, context, out=np.zeros(len(pair)), where=context > 0)


def _bin(p: np.ndarray) -> np.ndarray:
    """Eighths of powers of two; -1 for zero."""
    out = np.full(len(p), -1, np.int64)
    seen = p > 0
    out[seen] = np.floor(-np.log2(p[seen]) * BINS).astype(np.int64)
    return out


def _deleted_events(total: float):
    def work(info, word, context, pair):
        cells, times = np.unique(np.stack([
            bucket(context), _bin(_of_pair(pair, context)), _bin(word / max(total, 1.0))]),
            axis=1, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (*cells, times)],
                                          names=["of", "p2", "p1", "times"])
    return work


def fit_weights(cells: list[tuple[int, int, int, int]], vocabulary: int) -> Weights:
    """Expectation-maximisation per bucket; rare buckets lean on all together."""
    even = np.array([1 / 3, 1 / 3, 1 / 3])
    if not cells:
        table = np.tile(even, (66, 1))
        table[0] = 0, 0.5, 0.5
        return Weights(table)
    of, b2, b1, times = (np.array(c) for c in zip(*cells))
    value = lambda b: np.where(b < 0, 0.0, 2.0 ** (-(b + 0.5) / BINS))
    p = np.stack([value(b2), value(b1), np.full(len(of), 1 / (vocabulary + 1))], axis=1)

    def em(mine, start, prior):
        weights = start.copy()
        for _ in range(ROUNDS):
            part = p[mine] * weights
            part = part / part.sum(axis=1, keepdims=True) * times[mine, None]
            weights = part.sum(axis=0) + prior
            weights = weights / weights.sum()
        return weights

    pooled = em(np.flatnonzero(of > 0), even, 0) if (of > 0).any() else even
    table = np.tile(pooled, (66, 1))
    for b in range(66):
        mine = np.flatnonzero(of == b)
        lean = pooled if b else np.array([0, 0.5, 0.5])
        table[b] = em(mine, np.maximum(lean, 1e-3), 10 * lean) if len(mine) else lean
    table = np.maximum(table, [0, 1e-4, 1e-4])
    table[0, 0] = 0
    return Weights(table / table.sum(axis=1, keepdims=True))


def _scores(weights: Weights, total: int, vocabulary: int):
    def work(info, word, context, pair):
        ids, nulls, folds, lengths = info
        shares = weights.table[bucket(context)]
        p = (shares[:, 0] * _of_pair(pair, context) + shares[:, 1] * (word / max(total, 1))
             + shares[:, 2] / (vocabulary + 1))
        base = np.log10((word + 1) / (total + (vocabulary + 1)))
        firsts = np.cumsum(lengths) - lengths
        total_of = lambda x: np.add.reduceat(x, firsts)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64(), mask=nulls.astype(bool)), pa.array(folds == HELD_OUT),
             pa.array(lengths.astype(np.int64)), pa.array(total_of((word > 0).astype(np.int64))),
             pa.array(np.full(len(ids), total, np.int64)),
             pa.array(total_of(base)), pa.array(total_of(np.log10(p)))],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return work


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learnt from documents whose crc32 of the id, modulo 7, is not 2 (a null id
    counts as an empty text); of these, remainder 6 is deleted while the weights
    are fitted. A null text is an empty one: its only token is the end. Repeated
    rows count and are scored each. An empty table gives an empty result; without
    training documents every token has the uniform probability 1. Other columns
    are ignored.
    """
    text_of = F.coalesce(named(text), F.lit(""))
    rows = docs.select(named(doc_id).cast("long").alias("doc_id"),
                       remainder(doc_id, FOLDS).alias("fold"), text_of.alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(8, -(-size // PART_BYTES))
    sent = rows.mapInArrow(_encode(parts), BLOCK_SCHEMA)
    spread = F.when(F.col("kind") == DOCS, F.col("batch")).otherwise(F.col("part") * 2 + F.col("kind"))
    # As many tasks, and files, as hash ranges, whatever the number of shuffle partitions.
    answered = stored(
        sent.withColumn("to", spread).repartition(parts, "to").sortWithinPartitions("kind", "part", "batch")
        .drop("to").mapInArrow(_count, BLOCK_SCHEMA), "lm-answers")
    totals = [0, 0, 0, 0]
    for row in answered.where(F.col("kind") == TOTALS).select("a").collect():  # one per hash range
        totals = [x + int(y) for x, y in zip(totals, np.frombuffer(row["a"], np.int64))]
    total, vocabulary, kept_total, kept_vocabulary = totals

    def batches(rows: DataFrame) -> DataFrame:
        return rows.repartition(parts, "batch").sortWithinPartitions("batch", "kind", "part")

    held = answered.where(F.col("kind") != TOTALS)
    events = batches(held.where("batch % 2 = 1")).mapInArrow(
        _per_batch(_deleted_events(float(kept_total)), True), "of long, p2 long, p1 long, times long")
    # Cells of a grid of fixed size.
    cells = [tuple(r) for r in events.groupBy("of", "p2", "p1").agg(
        F.sum("times").alias("times")).collect()]
    weights = fit_weights(sorted(cells), kept_vocabulary)
    return batches(held).mapInArrow(_per_batch(_scores(weights, total, vocabulary), False), (
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double"))
