"""Centroid clustering with Orchard's search.

Every centroid keeps all centroids in the order of their distance from it. A
vector starts at some centroid and walks that list; when it meets a closer
centroid it goes over to that one's list from the front. Centroids once compared
are marked and skipped. The walk ends where the list's next centroid is strictly
beyond twice the vector's present distance: by the triangle inequality nothing
behind it is closer, and a tie can still be met, of which the smaller number wins.

All vectors of an Arrow batch walk in step, one comparison each at a time. Sums
of a round leave a task as one row per centroid. Coordinates are whole numbers,
so sums, distances and the result do not depend on order or partitioning. Only
the centroids, ``k`` rows of ``dims`` numbers, pass through the driver.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..sources.stored import stored
from .common import named, ship, small_table

ship(__name__)

DIMS, CENTROIDS, ROUNDS, SEED, SCALE = 64, 40, 5, 2, 256
LIMIT = 1 << 26  # coordinates beyond are taken as this, so that squared distances fit 64 bits
STEP_ROWS = 4096  # vectors that walk together


@dataclass
class Lists:
    """The centroids and, per centroid, all of them by distance from it, with four times its square."""

    points: np.ndarray
    order: np.ndarray
    reach: np.ndarray

    @staticmethod
    def of(points: np.ndarray) -> Lists:
        points = points.astype(np.int64)
        apart = np.stack([((points - p) ** 2).sum(axis=1) for p in points])
        order = np.argsort(apart, axis=1, kind="stable")
        return Lists(points, order, np.take_along_axis(apart, order, axis=1))


def nearest(vectors: np.ndarray, lists: Lists) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, squared distance, comparisons made) per vector."""
    k, n = len(lists.points), len(vectors)
    number = np.zeros(n, np.int64)
    distance = np.zeros(n, np.int64)
    compared = 0
    for low in range(0, n, STEP_ROWS):
        part = vectors[low:low + STEP_ROWS]
        number[low:low + STEP_ROWS], distance[low:low + STEP_ROWS], made = _walk(part, lists, k)
        compared += made
    return number, distance, compared


def _squared(vectors: np.ndarray, points: np.ndarray) -> np.ndarray:
    apart = vectors - points
    return np.einsum("ij,ij->i", apart, apart)


def _walk(vectors: np.ndarray, lists: Lists, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    small = max(np.abs(vectors).max(initial=0), np.abs(lists.points).max(initial=0)) < 1 << 21
    kind = np.float64 if small else np.int64  # sums of squares below 2^53 are exact in both
    vectors, points = vectors.astype(kind), lists.points.astype(kind)
    reach = lists.reach.astype(kind)
    rows = np.arange(len(vectors))
    best = np.zeros(len(vectors), np.int64)
    squared = _squared(vectors, points[best])
    compared, visited = len(vectors), np.zeros((len(vectors), k), bool)
    visited[:, 0] = True
    place = np.zeros(len(vectors), np.int64)
    while len(rows):
        at = best[rows]
        near = lists.order[at, place[rows]]
        # D(c, c') > 2 d, with the squares: beyond that nothing is as close.
        going = reach[at, place[rows]] <= 4 * squared[rows]
        rows, near = rows[going], near[going]
        place[rows] += 1
        fresh = ~visited[rows, near]
        meet, other = rows[fresh], near[fresh]
        if len(meet):
            visited[meet, other] = True
            found = _squared(vectors[meet], points[other])
            compared += len(meet)
            closer = (found < squared[meet]) | ((found == squared[meet]) & (other < best[meet]))
            jump = meet[closer]
            best[jump], squared[jump], place[jump] = other[closer], found[closer], 0
        rows = rows[place[rows] < k]
    return best, squared.astype(np.int64), compared


def whole_vectors(column: pa.Array, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that count, their coordinates): lists of ``dims`` finite numbers, floor(scale * x)."""
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == dims)
    if not len(rows):
        return rows, np.empty((0, dims), np.int64)
    values = column.take(pa.array(rows)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    values = values.reshape(-1, dims)  # a null component has become nan
    finite = np.isfinite(values).all(axis=1)
    coded = np.floor(values[finite] * scale)
    return rows[finite], np.clip(coded, -LIMIT, LIMIT).astype(np.int64)


def _sums(points: np.ndarray, dims: int, scale: int):
    def run(batches):
        lists, k = Lists.of(points), len(points)
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            _, vectors = whole_vectors(batch.column(0), dims, scale)
            if not len(vectors):
                continue
            number, _, _ = nearest(vectors, lists)
            order = np.argsort(number, kind="stable")
            mine, firsts = np.unique(number[order], return_index=True)
            sums[mine] += np.add.reduceat(vectors[order], firsts, axis=0)
            counts += np.bincount(number, minlength=k)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(counts[used]), pa.array(list(sums[used]), pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"])
    return run


def _assigned(points: np.ndarray, dims: int, scale: int):
    def run(batches):
        lists = Lists.of(points)
        for batch in batches:
            rows, vectors = whole_vectors(batch.column(1), dims, scale)
            number, distance, _ = nearest(vectors, lists)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), pa.array(number.astype(np.int32)), pa.array(distance)],
                names=["vec_id", "cluster", "distance"])
    return run


def _counts(vector: Column, dims: int) -> Column:
    """Exactly ``dims`` components, none null or non-finite."""
    return (F.size(vector) == dims) & F.forall(vector, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))


def first_centroids(rows: DataFrame, k: int, dims: int, seed: int, scale: int) -> np.ndarray:
    """The vectors with the smallest hashes of their ids, in that order; of equal ids the smaller vector first."""
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    chosen = (rows.where(_counts(F.col("vector"), dims)).select(named.alias("name"), "vector")
              .orderBy("name", "vector").limit(k).collect())  # k rows
    coded = np.floor(np.array([r["vector"] for r in chosen], np.float64).reshape(-1, dims) * scale)
    return np.clip(coded, -LIMIT, LIMIT).astype(np.int64)


def _moved(points: np.ndarray, sums: DataFrame, dims: int) -> np.ndarray:
    """The centroids after a round: the exact floor of each mean; one without vectors stays."""
    # Decimals: a sum over all rows may pass 64 bits. One row per centroid comes back.
    total = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(dims)]
    moved = points.copy()
    for row in sums.groupBy("cluster").agg(F.sum("n").alias("n"), *total).collect():
        moved[row["cluster"]] = [int(row[f"s{i}"]) // row["n"] for i in range(dims)]
    return moved


def cluster(rows: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, vec_id: str = "vec_id",
            vector: str = "embedding", dims: int = DIMS, seed: int = SEED, scale: int = SCALE) -> DataFrame:
    """One row per vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Vectors with another number of components, or a null or non-finite one, and
    null vectors are left out. Coordinates are floor(scale * x); beyond 2^26 either
    way they are taken as that. Repeated rows count each; repeated ids order by
    their vectors where centroids are drawn, a null id is named ``null`` there.
    Fewer vectors than ``k`` give as many centroids. An empty table gives an empty
    result; other columns are ignored.
    """
    spark = rows.sparkSession
    kept = rows.select(named(vec_id).cast("long").alias("vec_id"), named(vector).alias("vector"))
    points = first_centroids(kept, k, dims, seed, scale)
    if not len(points):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, "
                                         "inertia long, centroid_sha256 string")
    for _ in range(rounds):
        sums = kept.select("vector").mapInArrow(
            _sums(points, dims, scale), "cluster int, n long, sums array<long>")
        points = _moved(points, sums, dims)
    assigned = stored(kept.mapInArrow(
        _assigned(points, dims, scale), "vec_id long, cluster int, distance long"), "centroid-assigned")
    of_cluster = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    names = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points.tolist()]
    inertia = sum(of_cluster.values())
    # One row per centroid, whatever the input.
    known = small_table(spark, [(c, of_cluster[c], inertia, names[c]) for c in sorted(of_cluster)],
                        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
