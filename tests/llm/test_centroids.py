import random
from hashlib import sha256

import numpy as np
import pytest

from millrace.llm import centroids
from millrace.llm.centroids import clustered, displaced, op13_centroids_ns, reassigned
from tests.llm.conftest import SF

VECTORS = "vec_id long, embedding array<double>, cluster string, row int"


def plain(rows, clusters=16, rounds=3, width=64):
    """Lloyd's rounds with Python's whole numbers."""
    kept = [(r["vec_id"], [int(np.floor(64 * float(x))) for x in r["embedding"]]) for r in rows
            if r["embedding"] is not None and len(r["embedding"]) == width and all(x is not None and np.isfinite(x) for x in r["embedding"])]
    key = lambda t: (t[0] is None, sha256(f"1:{t[0]}".encode()).hexdigest() if t[0] is not None else "", t[1])
    centres = [v for _, v in sorted(kept, key=key)[:clusters]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    nearest = lambda v: min((far(v, c), k) for k, c in enumerate(centres))
    for _ in range(rounds):
        at = [nearest(v)[1] for _, v in kept]
        for k in range(len(centres)):
            own = [v for (_, v), a in zip(kept, at) if a == k]
            if own:
                centres[k] = [sum(c) // len(own) for c in zip(*own)]
    last = [(i, *nearest(v)) for i, v in kept]
    total = {k: sum(d for _, d, a in last if a == k) for k in range(len(centres))}
    return [(i, k, d, total[k], sum(total.values()), sha256(",".join(map(str, centres[k])).encode()).hexdigest()) for i, d, k in last]


def odd_vectors():
    rng = random.Random(4)
    middle = [[rng.uniform(-2, 2) for _ in range(64)] for _ in range(9)]
    rows = [(i, [x + rng.gauss(0, 0.4) for x in rng.choice(middle)], "c", i) for i in range(400)]
    rows += [(i + 1000, rows[7][1], None, None) for i in range(150)] + [rows[3], rows[3]]
    rows += [(None, rows[9][1], "", 0), (7, [0.0] * 64, "", 0), (2000, None, "", 0), (2001, [], "", 0), (2002, [1.0] * 63, "", 0),
             (2003, [None] + [1.0] * 63, "", 0), (2004, [float("nan")] * 64, "", 0), (2005, [float("inf")] + [0.0] * 63, "", 0),
             (2006, [-0.001] * 64, "", 0), (2007, [1e4] * 64, "", 0), (2008, [-9e5] * 64, "", 0)]
    return rows


@pytest.fixture(scope="module")
def vectors(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("vectors"))
    spark.createDataFrame(odd_vectors(), VECTORS).repartition(5).write.parquet(f"{folder}/embeddings.parquet")
    return folder


@pytest.mark.parametrize("folder", ["vectors", SF])
def test_equals_plain_rounds(spark, request, read, same, folder):
    folder = folder if "/" in folder else request.getfixturevalue(folder)
    same([tuple(r) for r in op13_centroids_ns(spark, folder).collect()], plain(read(folder, "embeddings")))


def test_bounds_spare_distances_and_miss_nothing():
    rng = np.random.default_rng(3)
    v = (rng.integers(0, 6, (5000, 1)) * 300 + rng.normal(0, 20, (5000, 8))).astype(np.int64)
    history = [v[rng.choice(5000, 10, replace=False)]]
    squared = centroids.all_distances(v, history[0])
    cluster, seen = squared.argmin(axis=1), np.zeros(squared.shape, np.int8)
    evaluated = []
    for _ in range(6):
        history.append(np.stack([v[cluster == k].sum(axis=0) // max((cluster == k).sum(), 1) if (cluster == k).any() else history[-1][k] for k in range(10)]))
        evaluated.append(reassigned(v, cluster, squared, seen, history))
        assert (cluster == centroids.all_distances(v, history[-1]).argmin(axis=1)).all()
    assert evaluated[-1] < 0.2 * v.shape[0] * 10


def test_displacement_is_measured_straight():
    there_and_back = [np.array([[0, 0]]), np.array([[30, 40]]), np.array([[0, 0]])]
    assert displaced(there_and_back).tolist() == [[0.0], [50.0], [0.0]]


def test_ties_go_to_the_smaller_number_and_empty_clusters_stay(spark):
    rows = [(i, [float(i % 2)] * 2) for i in range(12)]
    found, centres = clustered(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), clusters=5, rounds=2, components=2)
    assert len(centres) == 5 and {tuple(c) for c in centres.tolist()} == {(0, 0), (64, 64)}
    first = {tuple(c): k for k, c in reversed([*enumerate(centres.tolist())])}
    assert all(r["cluster"] == first[(64 * (r["vec_id"] % 2),) * 2] and r["distance"] == 0 for r in found.collect())


def test_wide_numbers_stay_exact():
    v = np.array([[2 ** 26 - 1, -(2 ** 26) + 1], [2 ** 25, 5]], np.int64)
    assert centroids.all_distances(v, v).tolist() == [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, y)) for y in v] for x in v]


def test_other_sizes_and_no_rows(spark, tmp_path):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    none.write.parquet(f"{tmp_path}/embeddings.parquet")
    assert op13_centroids_ns(spark, str(tmp_path)).count() == 0
    few = spark.createDataFrame([(1, [0.5, 1.0]), (2, [3.0, 4.0])], "vec_id int, embedding array<float>")
    found, centres = clustered(few, components=2)
    assert len(centres) == 2 and sorted(r["distance"] for r in found.collect()) == [0, 0]
    with pytest.raises(Exception, match="do not fit"):
        clustered(spark.createDataFrame([(1, [2.0 ** 20, 0.0])], "vec_id long, embedding array<double>"), components=2)
