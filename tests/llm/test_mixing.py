import re
from collections import Counter, defaultdict

import pytest

from millrace.llm.mixing import mix_documents, op4_mix_waterfill, plan, ranked, water_filled
from tests.llm.conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def filled(sizes, weights, epochs, budget):
    """Clamp and share again until no source is above its cap."""
    held = set()
    while True:
        left = budget - sum(epochs * sizes[s] for s in held)
        weight = sum(weights[s] for s in sizes if s not in held)
        share = {s: left * weights[s] / weight for s in sizes if s not in held} if weight else {}
        over = {s for s, t in share.items() if t > epochs * sizes[s]}
        if not over:
            return {s: epochs * sizes[s] if s in held else share[s] for s in sizes}
        held |= over


@pytest.mark.parametrize("folder", ["odd", SF])
def test_targets_and_words_taken(spark, request, read, folder):
    folder = folder if "/" in folder else request.getfixturevalue(folder)
    docs = read(folder)
    sizes = defaultdict(int)
    largest = defaultdict(int)
    for d in docs:
        n = len(WORD.findall(d["text"] or ""))
        sizes[d["source"]] += n
        largest[d["source"]] = max(largest[d["source"]], n)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = filled(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, 3, sum(sizes.values()))
    sources = Counter((d["doc_id"], len(WORD.findall(d["text"] or "")), sizes[d["source"]], round(targets[d["source"]], 6)) for d in docs)
    out = [r.asDict() for r in op4_mix_waterfill(spark, folder).collect()]
    assert Counter((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6)) for r in out) == sources
    taken = defaultdict(int)
    for r in out:
        assert r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        taken[round(r["target"], 6), r["source_size"]] += r["taken"]
    for s in sizes:
        # repeated rows share one place: the fixture has three of its largest text
        assert abs(taken[round(targets[s], 6), sizes[s]] - targets[s]) <= 1.5 * largest[s] + 1
    again = [r.asDict() for r in op4_mix_waterfill(spark, folder).collect()]
    assert sorted(map(repr, out)) == sorted(map(repr, again))


def test_clamped_sources(spark):
    rows = spark.createDataFrame([("a", 10, 5.0), ("b", 1000, 2.0), ("c", 1, 5.0), (None, 500, 1.0)], "source string, source_size long, weight double")
    got = {r["source"]: r["target"] for r in water_filled(rows, 3).collect()}
    want = filled({"a": 10, "b": 1000, "c": 1, None: 500}, {"a": 5, "b": 2, "c": 5, None: 1}, 3, 1511)
    assert got["a"] == 30 and got["c"] == 3 and all(abs(got[s] - want[s]) < 1e-6 for s in want)
    capped = {r["source"]: r["target"] for r in water_filled(rows, 3, budget=10_000).collect()}
    assert capped == {"a": 30, "b": 3000, "c": 3, None: 1500}


def test_rank_is_code_point_order(spark):
    names = ["é", "Z", "a", "", None, "zz", "\U0001F600", "ﬀ"] + [f"s{i}" for i in range(100)]
    rows = spark.createDataFrame([(n,) for n in names], "source string")
    want = {n: k for k, n in enumerate(sorted(names, key=lambda n: (n is None, n or "")))}
    assert {r["source"]: r["rank"] for r in ranked(rows).collect()} == want


def test_rows_of_the_mix(spark, odd, bare):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    out = mix_documents(docs)
    assert out.columns == docs.columns
    times = Counter(r["doc_id"] for r in out.collect())
    want = Counter()
    for r in op4_mix_waterfill(spark, odd).collect():
        if r["size"]:
            want[r["doc_id"]] += r["taken"] // r["size"]
    assert {k: v for k, v in times.items() if k is not None and want[k]} == {k: v for k, v in want.items() if k is not None and v}
    assert op4_mix_waterfill(spark, bare).count() == 0 == mix_documents(spark.read.parquet(f"{bare}/documents.parquet")).count()
    assert plan(spark.createDataFrame([("a", 0, 5)], "source string, size long, place long")).first()["target"] == 0
