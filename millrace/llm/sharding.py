"""Shards of near equal bytes: a minimax partition of ordered groups that are never split.

Documents of equal text form a group (its key is a 64-bit hash of the text; two texts of one key simply stay
together). A group larger than the mean share of what is left takes a shard of its own, largest first. The
others are ordered by key and cut into contiguous runs: the smallest capacity for which a greedy walk needs no
more than the given number of shards is found by binary search, and the cuts are where the walk at that
capacity cuts.

The walk needs prefix sums only. The driver holds them for a bounded number of key ranges and refines, job by
job, just those ranges in which a cut may lie; the groups themselves stay in the cluster.

Defined results: a null text has size 1 and no checksum, and all null texts are one group; an empty text
has size 1. A repeated row counts each time it comes. An empty table gives an empty result. Rows whose id
is null are dealt like any other. Columns of the input beyond id and text are kept by ``shard_documents`` and
never read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from millrace.llm.tables import documents, saved

#: Bits of the key that name a range at first, and further bits at each refinement.
FIRST_BITS, MORE_BITS = 12, 8
#: Cells that the rows of a shard are numbered in.
CELLS = 4096
LAW = "bytes"


def text_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def group_key(text: Column) -> Column:
    return F.xxhash64(text)


class _Ranges:
    """Neighbouring key ranges (low key, free bits, bytes, whether it is a single group) and walks over them."""

    def __init__(self, rows: list[tuple[int, int, int, bool]]):
        self.rows = sorted(rows)
        self.sums = [0]
        for row in self.rows:
            self.sums.append(self.sums[-1] + row[2])

    def walk(self, capacity: int, shards: int, divisible: bool) -> list[int]:
        """Bytes before each cut of the greedy walk; the last one is the total if ``shards`` are enough.

        With ``divisible`` a cut may fall inside a range of several groups, so no cut of the groups lies
        later. Without it no range is cut, so none lies earlier.
        """
        cuts, done = [], 0
        for _ in range(shards):
            to = bisect_right(self.sums, done + capacity) - 1
            if to < len(self.rows) and divisible and not self.rows[to][3]:
                done += capacity
            else:
                done = max(done, self.sums[to])
            cuts.append(done)
        return cuts

    def capacity(self, shards: int, divisible: bool) -> int:
        """The smallest capacity for which the walk needs no more than the given shards."""
        total = self.sums[-1]
        low, high = -(-total // shards), total
        while low < high:
            middle = (low + high) // 2
            if self.walk(middle, shards, divisible)[-1] < total:
                low = middle + 1
            else:
                high = middle
        return low

    def doubtful(self, shards: int) -> list[int]:
        """Ranges of several groups that a cut may fall into."""
        early = self.walk(self.capacity(shards, True), shards, False)[:-1]
        late = self.walk(self.capacity(shards, False), shards, True)[:-1]
        found = set()
        for a, b in zip(early, late):
            first, last = bisect_right(self.sums, a) - 1, min(bisect_right(self.sums, b), len(self.rows))
            found.update(i for i in range(first, last) if not self.rows[i][3] and self.sums[i] < b)
        return sorted(found)


def _range_sums(groups: DataFrame, bits: int) -> list[tuple[int, int, int, bool]]:
    """One row for each range of keys that differ in their last ``bits`` bits only."""
    low = F.shiftleft(F.shiftright("key", bits), bits)
    out = groups.groupBy(low.alias("low")).agg(
        F.sum("size").alias("size"), F.min("key").alias("a"), F.max("key").alias("b")).collect()
    return [(r["low"], bits, r["size"], r["a"] == r["b"]) for r in out]


def cut_keys(rows: DataFrame, shards: int) -> tuple[list[int], list[int]]:
    """Keys that get a shard of their own, and the first keys of the further shards of the others.

    ``rows`` has columns ``key`` and ``size``. What comes to the driver is bounded by ``shards`` groups, 2^12
    ranges, and 2^8 parts of each range that a cut may fall into.
    """
    groups = saved(rows.groupBy("key").agg(F.sum("size").alias("size")), "groups")
    left, free, alone = groups.agg(F.sum("size")).first()[0] or 0, shards, []
    for r in groups.orderBy(F.desc("size"), "key").limit(shards).collect():
        if free < 2 or r["size"] * free < left:
            break
        alone.append(r["key"])
        left, free = left - r["size"], free - 1
    rest = groups.where(~F.col("key").isin(alone)) if alone else groups

    state = _Ranges(_range_sums(rest, 64 - FIRST_BITS))
    while doubtful := state.doubtful(free):
        by_bits = defaultdict(list)
        for i in doubtful:
            by_bits[state.rows[i][1]].append(state.rows[i][0] >> state.rows[i][1])
        finer = [row for i, row in enumerate(state.rows) if i not in set(doubtful)]
        for bits, prefixes in by_bits.items():
            inside = rest.where(F.shiftright("key", bits).isin(prefixes))
            finer += _range_sums(inside, max(0, bits - MORE_BITS))
        state = _Ranges(finer)
    places = {done: k for k, done in enumerate(state.sums)}
    cuts = [places[done] for done in state.walk(state.capacity(free, False), free, False)[:-1]]
    return alone, [state.rows[at][0] for at in cuts if at < len(state.rows)]


def shard_of(key: Column, alone: list[int], firsts: list[int]) -> Column:
    """The shard of a key: the single groups come first, then the runs in order of their keys."""
    shard = F.lit(len(alone))
    for first in firsts:
        shard = shard + (key >= F.lit(first)).cast("int")
    for number, own in enumerate(alone):
        shard = F.when(key == F.lit(own), F.lit(number)).otherwise(shard)
    return shard.cast("int")


def numbered(rows: DataFrame) -> DataFrame:
    """Adds ``slot``: the place of a row within its shard, without gaps, from 0.

    Rows are counted per shard and cell (a hash of id and key, ``CELLS`` of them), the counts before a cell are
    added up over that bounded table, and rows are numbered within their cell only.
    """
    rows = rows.withColumn("cell", F.pmod(F.xxhash64("doc_id", "key"), F.lit(CELLS)).cast("int"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = (rows.groupBy("shard", "cell").agg(F.count("*").alias("n"))
             .select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    own = Window.partitionBy("shard", "cell").orderBy("doc_id", "key")
    # at most CELLS rows of three numbers for each shard
    return (rows.withColumn("place", F.row_number().over(own)).join(F.broadcast(cells), ["shard", "cell"])
            .withColumn("slot", F.col("before") + F.col("place") - 1).drop("before", "place", "cell"))


def shard_documents(docs: DataFrame, shards: int = 8, text: str = "text", name: str = "shard") -> DataFrame:
    """The rows of ``docs`` with their shard; rows are not moved.

    A column of that name stays as it is: the shard's gets underscores until its name is free.
    """
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    key = group_key(F.col(text))
    alone, firsts = cut_keys(docs.select(key.alias("key"), text_size(F.col(text)).alias("size")), shards)
    return docs.withColumn(name, shard_of(key, alone, firsts))


def op1_shard_minimax(spark: SparkSession, folder: str, shards: int = 8) -> DataFrame:
    docs = documents(spark, folder)
    text = F.col("text")
    rows = saved(docs.select("doc_id", group_key(text).alias("key"), text_size(text).alias("size"),
                             F.crc32(F.encode(text, "UTF-8")).alias("text_crc32")), "sizes")
    alone, firsts = cut_keys(rows, shards)
    dealt = numbered(rows.withColumn("shard", shard_of(F.col("key"), alone, firsts)))
    return dealt.select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
                        F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard"))
