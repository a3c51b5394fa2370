"""Clustering around centroids, exact, with bounds that spare most distances (ns-bounds).

Each vector keeps, for every centroid, the distance of its last evaluation and the round of it. The centroids of all
rounds are kept, so in a later round the stored distance is loosened by the norm of the centroid's total
displacement since then, as the crow flies; the sum of the way it went round by round would be looser.
A vector whose loosened upper bound to its own centroid lies below all loosened lower bounds stays where it is.
Where a bound fails, its distance is evaluated anew, in whole numbers, so every assignment and every tie is
exact. Sums of the clusters change by the vectors that moved only. Vectors and bounds are one table, written once
a round in place of the last; a task holds one Arrow batch and the centroids, whatever the size of a cluster.

Components are whole numbers, floor(64 * x). Rows are left out whose vector is null or has another number of components
or a null or non-finite one. Equal vectors are each a row, ties go to the smaller number, a cluster without vectors keeps its
centroid. A row without an id is clustered like others, but starts no cluster while rows with ids can; of rows with the same
id the smaller vector starts one first. With fewer rows than clusters there are as many clusters as rows, with
none the result is empty. The one thing that is refused, with an error that says so, is a component of 2^20 or
more in size: its distance does not fit the result. Other columns are never read.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm.tables import Rounds, in_batches, table

COMPONENTS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
#: Components of this size or more are refused.
WIDEST = 1 << 26
#: Up to this size the products of whole numbers are exact in floating point.
FLOAT_EXACT = 1 << 20
#: Roots and their sums are off by far less than this share; bounds are loosened by it.
ROUNDING = 1e-9


def quantised(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id`` and the whole numbers ``v`` of all vectors that count."""
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            column = batch.column(1)
            fit = np.flatnonzero(np.asarray(pc.fill_null(pc.equal(pc.list_value_length(column), components), False)))
            column = column.take(pa.array(fit))
            x = np.asarray(column.flatten().cast(pa.float64()).fill_null(np.nan)).reshape(-1, components)
            kept = np.isfinite(x).all(axis=1)
            x = x[kept] * SCALE
            if x.size and np.abs(x).max() >= WIDEST:
                raise ValueError(f"a component of {WIDEST // SCALE} or more in size: its distances do not fit whole numbers of 64 bits")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(fit[kept])), lists(np.floor(x).astype(np.int32))], names=["vec_id", "v"])

    return in_batches(vectors.select("vec_id", "embedding"), run, f"vec_id {kind}, v array<int>")


def lists(rows: np.ndarray) -> pa.ListArray:
    n, width = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(rows.ravel()))


def matrix(column: pa.Array, dtype) -> np.ndarray:
    flat = column.flatten()
    return np.asarray(flat).astype(dtype).reshape(len(column), -1) if len(column) else np.zeros((0, 1), dtype)


def first_centroids(kept: DataFrame, clusters: int = CLUSTERS) -> np.ndarray:
    """The vectors whose ids have the smallest seeded hashes."""
    key = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    rows = kept.select(key.alias("key"), "v").orderBy(F.asc_nulls_last("key"), "v").limit(clusters).collect()
    return np.array([r["v"] for r in rows], np.int64)


def all_distances(v: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of every vector to every centroid."""
    widest = max(np.abs(v).max(initial=0), np.abs(centroids).max(initial=0))
    if widest < FLOAT_EXACT:
        v, centroids = v.astype(np.float64), centroids.astype(np.float64)
    out = (v * v).sum(axis=1)[:, None] - 2 * (v @ centroids.T) + (centroids * centroids).sum(axis=1)[None, :]
    return out.astype(np.int64)


def distances(v: np.ndarray, centroids: np.ndarray, row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Squared distances of the given rows to the given centroids, pair by pair."""
    out = np.empty(len(row), np.int64)
    for lo in range(0, len(row), 1 << 14):
        pair = slice(lo, lo + (1 << 14))
        gap = v[row[pair]] - centroids[at[pair]]
        out[pair] = np.einsum("ij,ij->i", gap, gap)
    return out


def displaced(history: list[np.ndarray]) -> np.ndarray:
    """How far each centroid now lies from where it was in each round."""
    now = history[-1]
    return np.sqrt(np.stack([((now - then) ** 2).sum(axis=1) for then in history]).astype(np.float64))


def reassigned(v: np.ndarray, cluster: np.ndarray, squared: np.ndarray, seen: np.ndarray, history: list[np.ndarray]) -> int:
    """Assign vectors to the newest centroids; changes ``cluster``, ``squared`` and ``seen`` in place.

    ``squared`` holds the squared distances of the rounds in ``seen``. Returns the number of distances evaluated.
    """
    newest, centroids = len(history) - 1, history[-1]
    moved, every = displaced(history), np.arange(len(centroids))
    rows = np.arange(len(v))

    def failing(rows: np.ndarray) -> np.ndarray:
        """For each row, the other centroids that may be as near as its own."""
        stored, way = np.sqrt(squared[rows].astype(np.float64)), moved[seen[rows], every]
        own = cluster[rows]
        line = np.arange(len(rows))
        upper = (stored[line, own] + way[line, own]) * (1 + ROUNDING)
        lower = stored - way - ROUNDING * (stored + way)
        out = lower <= upper[:, None]
        out[line, own] = False
        return out

    def evaluated(row: np.ndarray, at: np.ndarray) -> int:
        stale = seen[row, at] < newest
        row, at = row[stale], at[stale]
        squared[row, at] = distances(v, centroids, row, at)
        seen[row, at] = newest
        return len(row)

    doubtful = rows[failing(rows).any(axis=1)]
    count = evaluated(doubtful, cluster[doubtful])
    open_ = failing(doubtful)
    row, at = np.nonzero(open_)
    count += evaluated(doubtful[row], at)
    # a centroid that did not fail is farther than the vector's own, so it cannot be the nearest
    near = np.where(open_, squared[doubtful], np.iinfo(np.int64).max)
    near[np.arange(len(doubtful)), cluster[doubtful]] = squared[doubtful, cluster[doubtful]]
    cluster[doubtful] = near.argmin(axis=1)
    return count


STATE = "v array<int>, was int, cluster int, squared array<long>, seen array<tinyint>"


def assigned_first(kept: DataFrame, centroids: np.ndarray) -> DataFrame:
    """All distances to the first centroids."""

    def run(batches):
        for batch in batches:
            v = matrix(batch.column(1), np.int64)
            squared = all_distances(v, centroids) if len(v) else np.zeros((0, len(centroids)), np.int64)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.nulls(len(v), pa.int32()), pa.array(squared.argmin(axis=1).astype(np.int32)),
                lists(squared), lists(np.zeros(squared.shape, np.int8))],
                names=["vec_id", "v", "was", "cluster", "squared", "seen"])

    return in_batches(kept, run, f"vec_id {kept.schema['vec_id'].dataType.simpleString()}, {STATE}")


def assigned_again(state: DataFrame, history: list[np.ndarray]) -> DataFrame:
    """The state after assigning all vectors to the newest centroids."""
    names = state.columns

    def run(batches):
        for batch in batches:
            v, was = matrix(batch.column(1), np.int64), np.asarray(batch.column(3)).copy()
            cluster, squared, seen = was.copy(), matrix(batch.column(4), np.int64), matrix(batch.column(5), np.int8)
            if len(v):
                reassigned(v, cluster, squared, seen, history)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(was), pa.array(cluster), lists(squared), lists(seen)], names=names)

    return in_batches(state, run, state.schema)


def moved_sums(state: DataFrame, clusters: int, components: int) -> tuple[np.ndarray, np.ndarray]:
    """By how much the last assignment changed each cluster's number of vectors and their sums."""
    change = F.array(F.struct(F.col("cluster").alias("c"), F.lit(1).alias("sign")), F.struct(F.col("was").alias("c"), F.lit(-1).alias("sign")))
    rows = (state.where("NOT cluster <=> was").select("v", F.explode(change).alias("t")).where("t.c IS NOT NULL")
            .groupBy("t.c").agg(F.sum("t.sign").alias("n"), *(F.sum(F.col("v")[i] * F.col("t.sign").cast("long")).alias(f"s{i}") for i in range(components)))
            .collect())
    numbers, sums = np.zeros(clusters, np.int64), np.zeros((clusters, components), np.int64)
    for r in rows:  # one a cluster
        numbers[r["c"]], sums[r["c"]] = r["n"], [r[f"s{i}"] for i in range(components)]
    return numbers, sums


def clustered(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, components: int = COMPONENTS) -> tuple[DataFrame, np.ndarray]:
    """``vec_id``, ``cluster`` and squared ``distance`` of every vector that counts, and the final centroids."""
    state = Rounds("vectors")
    state.put(quantised(vectors, components))
    if rounds > 127:
        raise ValueError("rounds are told apart by one byte: 127 at most")
    history = [first_centroids(state.frame, clusters)]
    if not len(history[0]):
        return state.frame.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), history[0]
    numbers, sums = np.zeros(clusters, np.int64), np.zeros((clusters, components), np.int64)
    state.put(assigned_first(state.frame, history[0]))
    for _ in range(rounds):
        change = moved_sums(state.frame, clusters, components)
        numbers, sums = numbers + change[0], sums + change[1]
        n = numbers[:len(history[0]), None]
        history.append(np.where(n > 0, sums[:len(n)] // np.maximum(n, 1), history[-1]))
        state.put(assigned_again(state.frame, history))

    def run(batches):
        for batch in batches:
            v, cluster = matrix(batch.column(1), np.int64), np.asarray(batch.column(2))
            exact = distances(v, history[-1], np.arange(len(v)), cluster)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(exact)], names=["vec_id", "cluster", "distance"])

    kind = state.frame.schema["vec_id"].dataType.simpleString()
    out = in_batches(state.frame.select("vec_id", "v", "cluster"), run, f"vec_id {kind}, cluster int, distance long")
    return state.put(out), history[-1]


def op13_centroids_ns(spark: SparkSession, folder: str) -> DataFrame:
    found, centroids = clustered(table(spark, folder, "embeddings"))
    inertia = {r["cluster"]: r["inertia"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    about = [(k, inertia.get(k, 0), sum(inertia.values()), sha256(",".join(map(str, c)).encode()).hexdigest())
             for k, c in enumerate(centroids.tolist())]
    facts = spark.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # one row a cluster
    return found.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
