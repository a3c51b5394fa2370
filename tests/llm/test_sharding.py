import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.llm.sharding import _Ranges, cut_keys, op1_shard_minimax, shard_documents
from tests.llm.conftest import SF


def least_capacity(sizes, shards):
    """The smallest capacity for which a greedy walk over the groups needs no more than the shards."""
    def needs(capacity):
        count, used = 1, 0
        for s in sizes:
            if used + s > capacity:
                count, used = count + 1, 0
            used += s
        return count

    capacity = max([*sizes, -(-sum(sizes) // shards)])
    while needs(capacity) > shards:
        capacity += 1
    return capacity


@pytest.mark.parametrize("folder", ["odd", SF])
def test_rows_and_slots(spark, request, read, folder):
    folder = folder if "/" in folder else request.getfixturevalue(folder)
    out = [r.asDict() for r in op1_shard_minimax(spark, folder).collect()]
    docs = read(folder)
    assert len(out) == len(docs)
    want = sorted(((d["doc_id"], len((d["text"] or "").encode()) + 1, None if d["text"] is None else zlib.crc32(d["text"].encode()))
                   for d in docs), key=repr)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in out), key=repr) == want
    homes = defaultdict(set)
    slots = defaultdict(list)
    for r in out:
        homes[r["text_crc32"]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < 8
    assert all(len(h) == 1 for h in homes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("shards", [1, 2, 3, 8, 40])
def test_capacity_is_the_least(spark, shards):
    rows = spark.range(0, 3000).select(F.xxhash64("id").alias("key"), (F.pow(F.pmod(F.hash("id"), F.lit(100)), 2) + 1).cast("long").alias("size"))
    groups = sorted((r["key"], r["size"]) for r in rows.collect())
    alone, firsts = cut_keys(rows, shards)
    assert not alone and firsts == sorted(firsts)
    sums = defaultdict(int)
    for key, size in groups:
        sums[sum(key >= f for f in firsts)] += size
    assert max(sums.values()) == least_capacity([s for _, s in groups], shards)


def test_large_groups_take_a_shard(spark):
    rows = spark.createDataFrame([(1, 1000), (2, 600)] + [(k, 1) for k in range(10, 310)], "key long, size long")
    alone, firsts = cut_keys(rows, 5)
    assert alone == [1, 2] and len(firsts) == 2
    rest = sorted(range(10, 310))
    cuts = [rest.index(f) for f in firsts]
    assert cuts == [100, 200]


def test_walks_bound_the_cuts():
    ranges = _Ranges([(0, 4, 10, False), (16, 4, 5, True), (32, 4, 7, False)])
    assert ranges.capacity(2, True) <= ranges.capacity(2, False)
    assert _Ranges([]).doubtful(3) == []


def test_empty_and_pipeline_form(spark, bare, odd):
    assert op1_shard_minimax(spark, bare).count() == 0
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    out = shard_documents(docs, 4)
    assert out.columns == [*docs.columns, "shard"] and out.drop("shard").exceptAll(docs).isEmpty() and out.count() == docs.count()


def test_a_column_of_that_name_stays(spark):
    docs = spark.createDataFrame([(1, "a", "mine", 0), (2, "b", "mine", 1)], "doc_id long, text string, Shard string, shard_ int")
    out = shard_documents(docs, 2)
    assert out.columns == [*docs.columns, "shard__"] and {r["Shard"] for r in out.collect()} == {"mine"}
