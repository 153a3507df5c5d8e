"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Letters are lower-cased, everything else is a blank, and all runs of one to
three characters are hashed into ``DIMENSIONS`` features. Document frequencies
count all documents one may learn from. Weights are fitted on a bounded sample
(``PER_LANGUAGE`` documents of each language, by hash of id and text) with
follow-the-regularised-leader under an elastic net, which leaves most weights
zero; a fifth of the sample is kept aside to calibrate the temperature.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..sources.stored import stored
from .common import free_name, map_rows, named, remainder, ship, worker_cache

ship(__name__)

DIMENSIONS = 1 << 15
PER_LANGUAGE = 800  # documents of a language that weights are fitted on, at most
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.01
UNKNOWN = "und"


@dataclass(frozen=True)
class Model:
    languages: list[str]
    idf: np.ndarray  # by feature
    weights: np.ndarray  # feature x language
    bias: np.ndarray
    temperature: float


def _letters() -> np.ndarray:
    """Code point to lower-case letter, or to a blank."""
    cache = worker_cache("language")
    if "letters" not in cache:
        table = np.full(0x110000, 32, np.uint32)
        for code in range(0x110000):
            char = chr(code)
            if char.isalpha():
                table[code] = ord(char.lower()[0])
        cache["letters"] = table
    return cache["letters"]


def features(text: str | None) -> np.ndarray | None:
    """How often each feature occurs; None without any letter."""
    codes = _letters()[np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32)]
    if not len(codes) or (codes == 32).all():
        return None
    codes = np.concatenate([[np.uint32(32)], codes, [np.uint32(32)]])
    blank = codes == 32
    codes = codes[np.concatenate([[True], ~(blank[1:] & blank[:-1])])]
    two = codes[:-1] * np.uint32(0x01000193) + codes[1:]
    three = two[:-1] * np.uint32(0x01000193) + codes[2:]
    runs = np.concatenate([codes, two + np.uint32(0x51ED270B), three + np.uint32(0x2545F491)])
    runs ^= runs >> np.uint32(15)
    runs *= np.uint32(0x9E3779B1)
    return np.bincount(runs >> np.uint32(32 - 15), minlength=DIMENSIONS)


def _frequencies(batches):
    total, docs = np.zeros(DIMENSIONS, np.int64), 0
    for batch in batches:
        for text in batch.column(0):
            counts = features(text.as_py())
            if counts is not None:
                total += counts > 0
                docs += 1
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(found, DIMENSIONS), pa.int32()), pa.array(np.append(total[found], docs), pa.int64())],
        names=["feature", "n"])


def _sparse(batches):
    for batch in batches:
        out = []
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            counts = features(text.as_py())
            if counts is not None:
                at = np.flatnonzero(counts)
                out.append((lang, at.astype("<u2").tobytes(),
                            np.minimum(counts[at], 65535).astype("<u2").tobytes()))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.binary(), pa.binary()))],
                names=["lang", "at", "counts"])


def _vector(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = (1.0 + np.log(counts)) * idf[at]
    return values / max(np.sqrt((values ** 2).sum()), 1e-12)


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _ftrl(examples, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Per-coordinate follow-the-regularised-leader; the last row is the bias, not penalised."""
    z, n = (np.zeros((DIMENSIONS + 1, classes)) for _ in range(2))
    penalty = np.full((DIMENSIONS + 1, 1), L1)
    penalty[-1] = 0

    def solve(zs, ns, l1):
        shrunk = np.sign(zs) * np.maximum(np.abs(zs) - l1, 0)
        return -shrunk / ((BETA + np.sqrt(ns)) / ALPHA + L2)

    order = np.random.default_rng(5)
    for _ in range(EPOCHS):
        for i in order.permutation(len(examples)):
            at, values, label = examples[i]
            zs, ns = z[at], n[at]
            weights = solve(zs, ns, penalty[at])
            error = _softmax(values @ weights)
            error[label] -= 1
            gradient = values[:, None] * error
            squares = gradient ** 2
            step = (np.sqrt(ns + squares) - np.sqrt(ns)) / ALPHA
            z[at] = zs + gradient - step * weights
            n[at] = ns + squares
    weights = solve(z, n, penalty)
    return weights[:-1], weights[-1]


def _temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature under which the kept-aside labels are likeliest."""
    if not len(labels):
        return 1.0

    def loss(t):
        return -np.log(np.maximum(_softmax(scores / t)[np.arange(len(labels)), labels], 1e-12)).mean()
    return float(min(np.geomspace(0.02, 20, 121), key=loss))


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
        per_language: int = PER_LANGUAGE) -> Model:
    """Learn from labelled documents whose id is not held out.

    Documents without label, text or letter teach nothing. Without any label the
    model knows no language.
    """
    spark = docs.sparkSession
    known = docs.select(named(doc_id).alias("id"), named(lang).cast("string").alias("lang"),
                        named(text).alias("text")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder("id", 3) != 1))
    seen = known.select("text").mapInArrow(_frequencies, "feature int, n long")
    # One number per feature, whatever the input.
    counts = {r["feature"]: r["n"] for r in
              seen.groupBy("feature").agg(F.sum("n").alias("n")).collect()}
    total = counts.get(DIMENSIONS, 0)
    frequency = np.zeros(DIMENSIONS)
    for feature, number in counts.items():
        if feature < DIMENSIONS:
            frequency[feature] = number
    idf = np.log((1 + total) / (1 + frequency)) + 1

    key = F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("")), "lang", "handle")
    known = known.withColumn("handle", F.xxhash64("text"))
    # Rows that repeat id and text take one place, and null ids are ids as any other.
    labelled = known.select("id", "lang", "handle").distinct().withColumn("key", key)
    # Of a common language only keys in a small share of the hash range come into question.
    common = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    # Stored, so that their size decides whether they are sent to every executor.
    near = labelled.join(stored(common, "lang-common"), "lang").where(
        F.pmod("key", F.lit(1 << 30)).cast("double") * F.col("n") < float(3 * per_language << 30))
    places = Window.partitionBy("lang").orderBy(F.pmod("key", F.lit(1 << 30)), "id", "handle")
    # per_language documents of each language, whatever the input.
    chosen = (near.withColumn("place", F.row_number().over(places)).where(f"place <= {per_language}")
              .select(F.col("id").alias("__id"), F.col("lang").alias("__lang"),
                      F.col("handle").alias("__handle")))
    same = F.col("id").eqNullSafe(F.col("__id")) & (F.col("lang") == F.col("__lang")) & (
        F.col("handle") == F.col("__handle"))
    sample = (known.join(stored(chosen, "lang-chosen"), same, "left_semi")
              .groupBy("id", "lang", "handle").agg(F.min("text").alias("text")).select("lang", "text"))
    rows = sample.mapInArrow(_sparse, "lang string, at binary, counts binary").collect()
    languages = sorted({r["lang"] for r in rows})
    examples = []
    for r in sorted(rows, key=lambda r: (r["lang"], bytes(r["at"]), bytes(r["counts"]))):
        at = np.frombuffer(r["at"], "<u2").astype(np.int64)
        values = _vector(at, np.frombuffer(r["counts"], "<u2").astype(float), idf)
        examples.append((np.append(at, DIMENSIONS), np.append(values, 1.0),
                         languages.index(r["lang"])))
    if not languages:
        return Model([], idf, np.zeros((DIMENSIONS, 0)), np.zeros(0), 1.0)
    aside = [i % 5 == 4 for i in range(len(examples))]
    weights, bias = _ftrl([e for e, a in zip(examples, aside) if not a], len(languages))
    kept = [e for e, a in zip(examples, aside) if a]
    scores = np.array([e[1][:-1] @ weights[e[0][:-1]] + bias for e in kept])
    temperature = _temperature(scores, np.array([e[2] for e in kept], int))
    return Model(languages, idf.astype(np.float32), weights.astype(np.float32), bias, temperature)


def predict(docs: DataFrame, model: Model, text: str = "text",
            names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """All rows and columns of ``docs`` with the language and its score, under ``names``.

    ``und`` with score 0 where the text is null or has no letter, or no language
    is known; of equally likely languages the first by name. Columns of these
    names are replaced.
    """
    kept = [c for c in docs.columns if c.lower() not in names]
    rows = docs.select(*[named(c) for c in kept])
    at = rows.columns.index(text)
    languages, idf, weights = model.languages, model.idf, model.weights
    bias, temperature = model.bias, model.temperature

    def one(text):
        counts = features(text) if languages else None
        if counts is None:
            return UNKNOWN, 0.0
        at = np.flatnonzero(counts)
        scores = _vector(at, counts[at], idf) @ weights[at] + bias
        chances = _softmax(scores / temperature)
        best = int(chances.argmax())
        return languages[best], float(chances[best])

    def run(batches):
        for batch in batches:
            found = [one(t.as_py()) for t in batch.column(at)]
            best, scores = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(best, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names, *names])
    return map_rows(rows, run, f"`{names[0]}` string, `{names[1]}` double")


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    model = fit(docs, doc_id, text, lang)
    rows = docs.select(named(doc_id).alias("doc_id"), named(text).alias("text"))
    return (predict(rows, model).withColumn("held_out", remainder("doc_id", 3) == 1)
            .select("doc_id", "held_out", "lang_pred", "score"))


def keep_known(docs: DataFrame, least_score: float = 0.5) -> DataFrame:
    """The documents whose language is recognised, with their columns.

    Rejected are those without letters and those where the best language is less
    likely than ``least_score``. Where no label can be learnt from, only
    documents without letters go.
    """
    model = fit(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    names = free_name(docs, "__lang"), free_name(docs, "__score")
    sure = (F.col(names[0]) != UNKNOWN) & (F.col(names[1]) >= least_score)
    return predict(docs, model, names=names).where(sure).drop(*names)
