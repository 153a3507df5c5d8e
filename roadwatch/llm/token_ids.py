"""Texts to token ids, and ids in Simple-8b files.

A file row is a segment: some documents in id order, their lengths, and the ids
of all of them as Simple-8b words with block offsets (``simple8b``). Segments
are written by Spark's Parquet writer, so a task that is lost or repeated leaves
one copy. Documents are laid out by ranges of the id: the files, and the rows in
them, are in ascending order; null ids come first.
"""

from __future__ import annotations

import string
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import named, ship, whole_text, worker_cache
from .simple8b import decode, encode

ship(__name__)

SEGMENT_IDS = 1 << 18
GROUP_CHARS = 1 << 22  # characters that are tokenised together
MOST_PIECES = 500_000  # pieces a worker remembers, besides those of the group at hand

SEGMENT_SCHEMA = (
    "part int, segment int, part_start long, n_ids long, doc_ids array<long>, "
    "lengths array<long>, block_ends array<int>, words binary, escapes binary")


def _byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it is printable,
    else the next one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(0x100) if b not in shown]
    return [chr(0x100 + hidden.index(b)) if b in hidden else chr(b) for b in range(0x100)]


def _letters(word: str) -> bool:
    """Letters that every version of the splitting rule knows as such."""
    return word.isalpha() and (word.isascii() or max(word) < "\u0250")


class Encoder:
    """Ids of whole texts, each as little-endian unsigned 32-bit bytes.

    The vocabulary's splitting rule never lets a token run across a single blank
    or line feed between two characters that are no white space. So a text's
    ids are those of its pieces between such places, and pieces repeat: each is
    encoded once and remembered. A piece keeps the white space before it, a
    blank or a line feed. A text with other white space next to a blank or line
    feed is encoded as a whole. Pieces are cut, told apart and put together by
    Arrow and numpy; Python sees each different piece of a group once. A vocabulary
    that is not byte-level encodes all texts as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.by_pieces = self.tokenizer.normalizer is None and str(self.tokenizer.pre_tokenizer).startswith(
            "ByteLevel(add_prefix_space=False")
        self.bytes = dict(enumerate(_byte_characters()))
        self.line_feed = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.tails: dict[str, list[int]] = {}  # punctuation behind a word
        # By number: each known piece, where its ids lie and how many, -1 if it is not safe on its own, and
        # in how many groups it was.
        self.pieces = pa.array([], pa.large_string())
        self.ids = array("I")
        self.firsts, self.lengths, self.groups = (np.empty(0, np.int32) for _ in range(3))

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _word(self, before: str, letters: str) -> list[int]:
        """Letters with at most a blank before them are one unit of the splitting rule, which they need not pass."""
        if not letters.isascii():
            letters = letters.encode().decode("latin-1").translate(self.bytes)
        return [t.id for t in self.model.tokenize(before + letters)]

    def _tail(self, tail: str) -> list[int]:
        if tail not in self.tails:
            self.tails[tail] = self.tokenizer.encode(tail, add_special_tokens=False).ids
        return self.tails[tail]

    def _between_line_feeds(self, joined: str) -> list[np.ndarray]:
        coded = self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0]
        ids = np.array(coded.ids, dtype="<u4")
        return np.split(ids, np.flatnonzero(ids == self.line_feed[0]))[1:]

    def _ids_of(self, fresh: list[str]) -> list[list[int] | None]:
        """The ids of new pieces, None for those that are not safe on their own: words with ASCII punctuation
        behind them one by one, others together, with line feeds between them."""
        found: list[list[int] | None] = []
        rest, blank, tokenize = [], self.bytes[0x20], self.model.tokenize
        for i, piece in enumerate(fresh):
            word = piece.rstrip(string.punctuation)
            if word.isalpha() and word.isascii():
                ids = [t.id for t in tokenize(blank + word)]
            elif _letters(word):
                ids = self._word(blank, word)
            elif word[:1] == "\n" and _letters(word[1:]):
                ids = self.line_feed + self._word("", word[1:])
            else:
                rest.append(i)
                ids = word = None
            found.append(ids if word is None or len(word) == len(piece) else ids + self._tail(piece[len(word):]))
        behind_blank = [i for i in rest if fresh[i] and fresh[i] == fresh[i].strip()]
        if behind_blank:
            coded = self._between_line_feeds("\n " + "\n ".join([fresh[i] for i in behind_blank]))
            for i, ids in zip(behind_blank, coded):
                found[i] = ids[1:].tolist()
        behind_feed = [i for i in rest if fresh[i][:1] == "\n" and fresh[i][1:] and fresh[i][1:] == fresh[i].strip()]
        if behind_feed:
            for i, ids in zip(behind_feed, self._between_line_feeds("".join([fresh[i] for i in behind_feed]))):
                found[i] = ids.tolist()
        return found

    def _learn(self, fresh: pa.Array) -> None:
        found = self._ids_of(fresh.to_pylist())
        lengths = np.array([-1 if ids is None else len(ids) for ids in found], np.int32)
        held = np.maximum(lengths, 0)
        first = len(self.ids)
        self.ids.extend(chain.from_iterable(ids for ids in found if ids))
        self.pieces = pa.concat_arrays([self.pieces, fresh])
        self.firsts = np.append(self.firsts, (first + np.cumsum(held) - held).astype(np.int32))
        self.lengths = np.append(self.lengths, lengths)
        self.groups = np.append(self.groups, np.zeros(len(found), np.int32))

    def _forget(self) -> None:
        """Keep the half that came in the most groups."""
        kept = np.sort(np.argsort(-self.groups, kind="stable")[:MOST_PIECES // 2])
        self.lengths, firsts = self.lengths[kept], self.firsts[kept]
        held = np.maximum(self.lengths, 0)
        starts = (np.cumsum(held) - held).astype(np.int32)
        self.ids = array("I", np.frombuffer(self.ids, np.uint32)[_ranges(firsts, held)].tobytes())
        self.firsts, self.groups = starts, self.groups[kept] // 2
        self.pieces = self.pieces.take(pa.array(kept))
        self.tails.clear()

    def encode(self, texts: list[str]) -> list[bytes]:
        if not texts or not self.by_pieces:
            return self.whole(texts)
        # A text's first word has nothing before it: it is encoded behind a line feed, which goes.
        behind = pc.replace_substring(pa.array(["\n" + t for t in texts], pa.large_string()), "\n", " \n")
        split = pc.split_pattern(behind, " ")
        coded = split.values.dictionary_encode()
        names = coded.dictionary
        if len(self.pieces) + len(names) > MOST_PIECES:
            self._forget()
        numbers = pc.fill_null(pc.index_in(names, self.pieces), -1).to_numpy().astype(np.int32)
        fresh = np.flatnonzero(numbers < 0)
        numbers[fresh] = len(self.pieces) + np.arange(len(fresh), dtype=np.int32)
        self._learn(names.take(pa.array(fresh)))
        self.groups[numbers] += 1
        # The blank before the first line feed makes an empty first piece, which counts as none.
        bounds, at = split.offsets.to_numpy(), coded.indices.to_numpy()
        lengths = self.lengths[numbers][at]
        lengths[bounds[:-1]] = 0
        unsafe = np.minimum.reduceat(lengths, bounds[:-1]) < 0
        np.maximum(lengths, 0, out=lengths)
        ids = np.frombuffer(self.ids, np.uint32)[_ranges(self.firsts[numbers][at], lengths)]
        cuts = np.concatenate([[0], np.cumsum(np.add.reduceat(lengths, bounds[:-1], dtype=np.int64))])
        skip = len(self.line_feed)
        out = [ids[a + skip:b].tobytes() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
        rest = np.flatnonzero(unsafe).tolist()
        for i, coded in zip(rest, self.whole([texts[i] for i in rest])):
            out[i] = coded
        # Other operators' tasks may run in this worker next.
        del behind, split, names, at, lengths, ids
        pa.default_memory_pool().release_unused()
        return out


def _ranges(firsts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each range, one after the other."""
    ends = np.cumsum(counts, dtype=np.int32)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(firsts - ends + counts, counts) + np.arange(total, dtype=np.int32)


def encoder(path: str) -> Encoder:
    cache = worker_cache("token ids")
    if ("encoder", path) not in cache:
        cache["encoder", path] = Encoder(path)
    return cache["encoder", path]


def groups_of_texts(texts: list[str], most: int | None = None) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``most`` characters, ``GROUP_CHARS`` if not given."""
    most = most or GROUP_CHARS
    first, chars = 0, 0
    for i, text in enumerate(texts):
        chars += len(text)
        if chars >= most:
            yield first, i + 1
            first, chars = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def _segments(tokenizer_path: str, end_id: int):
    end = np.array([end_id], dtype="<u4").tobytes()

    def row(part, number, start, ids, lengths, joined):
        values = np.frombuffer(joined, dtype="<u4")
        words, ends, escapes = encode(values)
        return {"part": part, "segment": number, "part_start": start, "n_ids": len(values),
                "doc_ids": ids, "lengths": lengths, "block_ends": ends.tolist(),
                "words": words.astype("<u8").tobytes(), "escapes": escapes.astype("<u8").tobytes()}

    def as_batch(rows):
        return pa.RecordBatch.from_pylist(rows, schema=pa.schema([
            ("part", pa.int32()), ("segment", pa.int32()), ("part_start", pa.int64()),
            ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
            ("lengths", pa.list_(pa.int64())), ("block_ends", pa.list_(pa.int32())),
            ("words", pa.binary()), ("escapes", pa.binary())]))

    def run(batches):
        tokens, part = encoder(tokenizer_path), TaskContext.get().partitionId()
        number, start = 0, 0
        ids, lengths, held, held_ids = [], [], [], 0
        for batch in batches:
            texts, doc_ids = batch.column(1).to_pylist(), batch.column(0).to_pylist()
            for low, high in groups_of_texts(texts):
                for doc_id, coded in zip(doc_ids[low:high], tokens.encode(texts[low:high])):
                    ids.append(doc_id)
                    lengths.append(len(coded) // 4 + 1)
                    held += (coded, end)
                    held_ids += lengths[-1]
                    if held_ids >= SEGMENT_IDS:
                        yield as_batch([row(part, number, start, ids, lengths, b"".join(held))])
                        number, start = number + 1, start + held_ids
                        ids, lengths, held, held_ids = [], [], [], 0
        if ids:
            yield as_batch([row(part, number, start, ids, lengths, b"".join(held))])
    return run


def write_ids(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0,
              doc_id: str = "doc_id", text: str = "text") -> None:
    """Tokenise whole texts and write their ids, each document closed by ``end_id``.

    A null text is an empty one and has the end id only. Repeated ids and rows
    are written each, next to each other, in the order of their texts' hashes.
    An empty table writes no segment. Other columns are ignored.
    """
    rows = docs.select(named(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    ordered = (rows.repartitionByRange(F.col("doc_id"), F.xxhash64("text"))
               .sortWithinPartitions(F.col("doc_id"), F.xxhash64("text")))
    (ordered.mapInArrow(_segments(tokenizer_path, end_id), SEGMENT_SCHEMA)
     .write.option("compression", "zstd").parquet(path))


def _decoded(row: dict) -> np.ndarray:
    return decode(np.frombuffer(row["words"], "<u8"), np.array(row["block_ends"]),
                  np.frombuffer(row["escapes"], "<u8"), row["n_ids"]).astype("<u4")


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SEGMENT_SCHEMA).parquet(path)


def _per_document(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            ids, at, out = _decoded(row), 0, []
            for doc_id, length in zip(row["doc_ids"], row["lengths"]):
                checksum = zlib.crc32(ids[at:at + length].tobytes())
                out.append((doc_id, row["part"], row["part_start"] + at, length, checksum))
                at += length
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (
                    pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "part", "at", "n_tokens", "ids_crc32"])


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    segments = read_segments(spark, path)
    # One number per file part: as many rows as the writing job had tasks.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
             .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    found = segments.mapInArrow(
        _per_document, "doc_id long, part int, at long, n_tokens long, ids_crc32 long")
    return found.join(bases, "part").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def _ids(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            ids, at = _decoded(row), 0
            for doc_id, length in zip(row["doc_ids"], row["lengths"]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id], pa.int64()),
                     pa.array([ids[at:at + length].astype(np.int64)], pa.list_(pa.int64()))],
                    names=["doc_id", "ids"])
                at += length


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The documents' ids as lists, the end id included."""
    return read_segments(spark, path).mapInArrow(_ids, "doc_id long, ids array<long>")


def _with_ids(tokenizer_path: str, end_id: int, lengths_only: bool):
    def run(batches):
        tokens = encoder(tokenizer_path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            # Where ids go on, other stages run beside: smaller groups hold less.
            for low, high in groups_of_texts(texts, None if lengths_only else GROUP_CHARS // 4):
                coded = tokens.encode(texts[low:high])
                counts = np.array([len(c) // 4 + 1 for c in coded], np.int64)
                columns = [batch.column(0).slice(low, high - low), pa.array(counts)]
                if not lengths_only:
                    end = np.array([end_id], "<u4").tobytes()
                    ids = np.frombuffer(b"".join(chain.from_iterable((c, end) for c in coded)), "<u4").astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(
                        pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(ids)))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids"][:len(columns)])
    return run


def tokenised(docs: DataFrame, tokenizer_path: str, end_id: int = 0, doc_id: str = "doc_id", text: str = "text",
              lengths_only: bool = False) -> DataFrame:
    """One row per document: doc_id, n_tokens and, unless only lengths are asked for, ids.

    The end id is counted and comes last; a null text is an empty one. Repeated rows
    have a row each, an empty table gives an empty result, other columns are ignored.
    """
    rows = docs.select(named(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    schema = "doc_id long, n_tokens long" + ("" if lengths_only else ", ids array<int>")
    return rows.mapInArrow(_with_ids(tokenizer_path, end_id, lengths_only), schema)
