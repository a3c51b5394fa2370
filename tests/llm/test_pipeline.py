"""The pipeline against a plain computation of all its stages."""

import re
from collections import defaultdict
from itertools import pairwise

import numpy as np
import xxhash

import corpus_pipeline as cp
from millrace.llm import quality
from millrace.llm.mixing import CELL_BITS, EPOCHS, SEED, WEIGHTS
from millrace.llm.words import BASE, BYTE_VALUE
from tests.llm import test_decontamination, test_jaccard_join, test_mixing, test_quality
from tests.llm.conftest import SF

FULL = (1 << 64) - 1
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def mix(x):
    x &= FULL
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & FULL
    x = (x ^ x >> 27) * 0x94D049BB133111EB & FULL
    return x ^ x >> 31


def word_hash(word):
    raw = sum(int(BYTE_VALUE[b or 255]) * pow(int(BASE), i, 1 << 64) for i, b in enumerate(word))
    return mix(raw + len(word) * 0xD6E8FEB86659FD93)


def score(text, ratio):
    hashes = [word_hash(w) for w in WORD.findall(text.encode())]
    grams = [mix(h) for h in hashes] + [mix(mix(a) * int(BASE) + b) for a, b in pairwise(hashes)]
    return sum(int(ratio[g >> 48]) for g in grams) / max(len(grams), 1) / quality.FIXED_POINT


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def spark_hash(*values):
    """Spark's 64-bit hash of an int, longs and texts, one after the other; null changes nothing."""
    seed = 42
    for v in values:
        if v is not None:
            data = v.encode() if isinstance(v, str) else v[0].to_bytes(v[1], "little", signed=True)
            seed = xxhash.xxh64_intdigest(data, seed)
    return seed


def mixed(docs):
    size = {id(d): len(WORD.findall((d["text"] or "").encode())) for d in docs}
    sums = defaultdict(int)
    for d in docs:
        sums[d["source"]] += size[id(d)]
    order = sorted(sums, key=lambda s: (s is None, s or ""))
    weights = {s: WEIGHTS[k % len(WEIGHTS)] for k, s in enumerate(order)}
    targets = test_mixing.filled(sums, weights, EPOCHS, sum(sums.values()))
    for source in order:
        rows = sorted((spark_hash((SEED, 4), None if d["doc_id"] is None else (d["doc_id"], 8), d["text"]) >> 2, i) for i, d in enumerate(docs) if d["source"] == source)
        whole = int(targets[source] // sums[source]) if sums[source] else 0
        rest = targets[source] - whole * sums[source]
        done, more = 0, []
        for place, i in rows:
            n = size[id(docs[i])]
            if done + n > rest and done + n - rest > rest - done:
                # nothing past the crossing, but for what has no words in its cell before it
                break
            done += n
            more.append(i)
            if done > rest:
                break
        for place, i in rows:
            for _ in range(whole + (i in more)):
                yield docs[i]


def sharded(docs, shards):
    groups = defaultdict(int)
    key = lambda d: signed(spark_hash(d["text"]))
    for d in docs:
        groups[key(d)] += len((d["text"] or "").encode()) + 1
    left, free, alone = sum(groups.values()), shards, []
    for k in sorted(groups, key=lambda k: (-groups[k], k)):
        if free < 2 or groups[k] * free < left:
            break
        alone.append(k)
        left, free = left - groups[k], free - 1
    rest = sorted(k for k in groups if k not in alone)
    low, high = -(-left // free), left

    def walk(capacity):
        home, used, number = {}, 0, len(alone)
        for k in rest:
            if used + groups[k] > capacity:
                number, used = number + 1, 0
            used += groups[k]
            home[k] = number
        return home

    fits = lambda c: max((groups[k] for k in rest), default=0) <= c and max(walk(c).values(), default=0) < shards
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    home = {k: n for n, k in enumerate(alone)} | walk(low)
    for d in docs:
        yield d | {"shard": home[key(d)]}


def test_pipeline_equals_a_plain_computation(spark, read):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    ratio, threshold = quality.fit(frame, spark.read.parquet(f"{SF}/labels.parquet"))
    docs = [d for d in read(SF) if not test_quality.counts(d["text"])[-1] and score(d["text"], ratio) >= threshold]
    assert 0.5 * frame.count() < len(docs) < frame.count()
    root, sets = test_jaccard_join.groups([d["text"] for d in docs], cp.NEAR)
    first = {}
    for d, r in zip(docs, root):
        if r not in first or d["doc_id"] < first[r]["doc_id"]:
            first[r] = d
    docs = [d for d in docs if any(d is f for f in first.values())]
    hit = [e[5] for e in test_decontamination.expected(docs, read(SF, "benchmark"))]
    assert any(hit)
    docs = list(sharded(list(mixed([d for d, h in zip(docs, hit) if not h])), cp.SHARDS))
    got = [r.asDict() for r in cp.run(spark, SF).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, docs))


def test_stages_keep_the_columns_and_bear_odd_rows(spark, odd, bare):
    assert [n for n, _ in cp.STAGES] == ["quality_rules", "near_duplicates", "benchmark_decontamination", "source_mixing", "sharding"]
    for folder in (odd, bare):
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        for name, stage in cp.STAGES:
            out = stage(spark, docs, folder)
            assert out.columns == docs.columns + ["shard"] * (name == "sharding")
            docs = spark.createDataFrame(out.collect(), out.schema) if name != "sharding" else out
        assert cp.run(spark, folder).count() == docs.count()


def test_clean_rows_come_through_unchanged(spark, read):
    every = {repr(d) for d in read(SF)}
    out = [r.asDict() for r in cp.run(spark, SF).drop("shard").collect()]
    assert out and all(repr(d) in every for d in out)
    assert np.unique([d["doc_id"] for d in out]).size > 0.4 * len(every) and CELL_BITS


def test_tables_on_the_way_are_removed(spark):
    import os

    from millrace.llm.tables import finished, saved
    from millrace.session import work_path

    folder = os.path.dirname(work_path(spark, "x")).removeprefix("file:")
    before = set(os.listdir(folder))

    def inner():
        return finished(spark, lambda: saved(spark.range(5), "deep").where("id > 1"), "middle")

    out = finished(spark, lambda: inner().unionAll(saved(spark.range(2), "side")), "result")
    left = set(os.listdir(folder)) - before
    assert out.count() == 5 and len(left) == 1 and left.pop().startswith("result-")
    before = set(os.listdir(folder))
    assert cp.run(spark, SF).count() > 0
    assert {n.rsplit("-", 1)[0] for n in set(os.listdir(folder)) - before} == {n for n, _ in cp.STAGES}
