"""Benchmark decontamination with a distributed positional inverted index.

The index holds, for each block of documents, the postings of its words: every word's places in the block. One
row of the index table is one block, so the lists that have to be intersected lie together, and blocks are
searched in parallel without a shuffle. Words that no test item has are left out by a bit table of fixed size.

A test item is read as windows of ten words. For each window the lists of its words are shifted by the word's
place in the window and intersected, from the word that is rarest in the corpus on; what is left are the exact
places of the phrase. With a slack, a window is also found where each of its words lies at most that many places
off, seen from its rarest one: a proximity match. Equal windows are searched once. What a block gives is joined to ranges
and names as arrays; single hits are listed only if asked for. Items are searched in chunks of a bounded number of
words, each against all blocks.

Defined results: null and empty texts have no words, no hits, and are not contaminated; an item without words
has no window, one of fewer than ten words is one window. Places never cross documents. Repeated documents
are each searched; repeated items each count. An item without an id is called ``null``. An empty table of
documents gives an empty result, an empty table of items no hits. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.llm.tables import documents, in_batches, made_path, saved, table
from millrace.llm.words import ALNUM, BASE, BitTable, Words, bit_table, lowered, mixed, steps

WINDOW = 10
#: Bytes of text in a block; a longer document is a block of its own.
BLOCK_BYTES = 1 << 19
#: Words of test items that are searched at once; a longer item is a chunk of its own.
CHUNK_WORDS = 400_000
#: How far words of a window may be off in a proximity match of the query.
SLACK = 2

FOLDED = lowered(ALNUM)
HIT = "struct<item:string,item_at:int,doc_at:int,length:int>"


def word_filter(items: DataFrame) -> np.ndarray:
    """Table of the words of all items."""

    def hashes(batch):
        return np.concatenate([Words(data, offsets, FOLDED).hashes() for _, _, data, offsets in steps(batch.column(0))] or [np.zeros(0, np.uint64)])

    return bit_table(items.select("text"), hashes)


def build_index(docs: DataFrame, known: np.ndarray) -> DataFrame:
    """One row for each block: document ids, their numbers of words, and the postings by word.

    ``terms`` is sorted; the places of term i are the next ``counts[i]`` of ``places``, in order. A place is the
    number of the word in the block.
    """
    sent = docs.sparkSession.sparkContext.broadcast(known)
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, block = BitTable(sent.value), 0
        for batch in batches:
            for lo, hi, data, offsets in steps(batch.column(1), BLOCK_BYTES):
                words = Words(data, offsets, FOLDED)
                hashes = words.hashes()
                at = np.flatnonzero(wanted(hashes))
                order = np.argsort(hashes[at], kind="stable")
                terms, counts = np.unique(hashes[at], return_counts=True)
                yield pa.RecordBatch.from_arrays([
                    pa.array([f"{TaskContext.get().partitionId()}-{block}"]),
                    pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), batch.column(0).slice(lo, hi - lo)),
                    pa.array([words.counts.astype(np.int64)]), pa.array([terms.view(np.int64)]),
                    pa.array([counts.astype(np.int32)]), pa.array([at[order].astype(np.int32)]),
                ], names=["block", "ids", "n_words", "terms", "counts", "places"])
                block += 1

    schema = (f"block string, ids array<{kind.simpleString()}>, n_words array<long>, terms array<long>, "
              "counts array<int>, places array<int>")
    out = saved(in_batches(docs.select("doc_id", "text"), run, schema), "postings")
    sent.destroy()
    return out


def frequencies(index: DataFrame) -> DataFrame:
    """How often each indexed word is in the corpus."""
    pairs = F.explode(F.arrays_zip("terms", "counts")).alias("t")
    return index.select(pairs).groupBy(F.col("t.terms").alias("term")).agg(F.sum("t.counts").alias("frequency"))


class Items:
    """Windows of a chunk of test items."""

    def __init__(self, names: list[str], texts: list[str | None], window: int = WINDOW):
        found = [(Words(data, offsets, FOLDED), lo) for lo, _, data, offsets in steps(pa.array(texts, pa.string()))]
        self.names = names
        self.hashes = np.concatenate([w.hashes() for w, _ in found] or [np.zeros(0, np.uint64)])
        counts = np.concatenate([w.counts for w, _ in found] or [np.zeros(0, np.int64)])
        first = np.concatenate([[0], np.cumsum(counts)])
        number = np.where(counts >= window, counts - window + 1, (counts > 0).astype(np.int64))
        item = np.repeat(np.arange(len(counts)), number)
        at = np.arange(len(item)) - np.repeat(np.cumsum(number) - number, number)
        start, length = first[item] + at, np.minimum(counts[item], window)
        # equal windows are one, with all the items and places it stands for
        key = length.astype(np.uint64)
        for k in range(window):
            inside = k < length
            key[inside] = mixed(key[inside] * BASE + self.hashes[start[inside] + k])
        _, one, same = np.unique(key, return_index=True, return_inverse=True)
        self.start, self.length = start[one], length[one]
        order = np.argsort(same, kind="stable")
        self.edges = np.searchsorted(same[order], np.arange(len(one) + 1))
        self.item, self.at = item[order], at[order]
        self.distinct, self.name = np.unique(np.array(names, dtype=object).astype(str), return_inverse=True) if names else (np.zeros(0, str), np.zeros(0, np.int64))

    def anchored(self, frequency: dict[int, int]) -> None:
        """Fixes the rarest word of each window; a word that the corpus lacks is rarest of all."""
        self.frequency = np.array([frequency.get(int(h), 0) for h in self.hashes.view(np.int64)], np.int64)
        self.anchor = np.array([s + int(np.argmin(self.frequency[s:s + n])) for s, n in zip(self.start, self.length)], np.int64)


def intersected(items: Items, terms: np.ndarray, edges: np.ndarray, places: np.ndarray, first: np.ndarray,
                slack: int) -> tuple[np.ndarray, np.ndarray]:
    """Window numbers and the block places they start at."""
    slot = np.searchsorted(terms, items.hashes)
    there = (slot < len(terms)) & (terms[np.minimum(slot, max(len(terms) - 1, 0))] == items.hashes) if len(terms) else np.zeros(len(slot), bool)
    windows, found = [], []
    for w in np.flatnonzero(there[items.anchor] & (items.frequency[items.anchor] > 0)):
        s, n, a = items.start[w], items.length[w], items.anchor[w]
        own = np.arange(s, s + n)
        if not there[own].all():
            continue
        anchors = places[edges[slot[a]]:edges[slot[a] + 1]].astype(np.int64)
        text = np.searchsorted(first, anchors, side="right") - 1
        low, high = first[text], first[text + 1] - 1
        if not slack:
            fits = (anchors - (a - s) >= low) & (anchors - (a - s) + n - 1 <= high)
            anchors, low, high = anchors[fits], low[fits], high[fits]
        for j in own[np.argsort(items.frequency[own], kind="stable")]:
            if not len(anchors):
                break
            if j == a:
                continue
            others = places[edges[slot[j]]:edges[slot[j] + 1]]
            goal = anchors + (j - a)
            near = np.searchsorted(others, np.maximum(goal - slack, low))
            match = near < len(others)
            match[match] = others[near[match]] <= np.minimum(goal + slack, high)[match]
            anchors, low, high = anchors[match], low[match], high[match]
        if len(anchors):
            windows.append(np.full(len(anchors), w))
            found.append(np.maximum(anchors - (a - s), low))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(windows), np.concatenate(found)


def listed(edges_of: np.ndarray, groups: int, values: pa.Array) -> pa.ListArray:
    """Values, sorted by their group, as one list a group."""
    edges = np.concatenate([[0], np.cumsum(np.bincount(edges_of, minlength=groups))])
    return pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), values)


def structs(**columns: np.ndarray) -> pa.StructArray:
    return pa.StructArray.from_arrays([c if isinstance(c, pa.Array) else pa.array(c.astype(np.int32)) for c in columns.values()], names=list(columns))


def ranges_of(text: np.ndarray, at: np.ndarray, stops: np.ndarray, first: np.ndarray, groups: int) -> pa.ListArray:
    """The places that matches cover, as ranges that do not touch, by document."""
    order = np.argsort(at, kind="stable")
    text, at, stops = text[order], at[order], np.maximum.accumulate(stops[order]) if len(order) else stops
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] > stops[:-1]) | (text[1:] != text[:-1])
    last = np.append(new[1:], True) if len(at) else new
    base = first[text[new]]
    return listed(text[new], groups, structs(start=at[new] - base, stop=stops[last] - base))


def names_of(items: Items, windows: np.ndarray, text: np.ndarray, groups: int) -> pa.ListArray:
    """The different names of the items that matched, by document."""
    pairs = np.unique(text * max(len(items.length), 1) + windows)
    text, windows = np.divmod(pairs, max(len(items.length), 1))
    lengths = np.diff(items.edges)[windows]
    members = np.repeat(items.edges[windows] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
    pairs = np.unique(np.repeat(text, lengths) * max(len(items.distinct), 1) + items.name[items.item[members]])
    text, name = np.divmod(pairs, max(len(items.distinct), 1))
    return listed(text, groups, pa.array(items.distinct.astype(object), pa.string()).take(pa.array(name)))


def hits_of(items: Items, windows: np.ndarray, at: np.ndarray, text: np.ndarray, first: np.ndarray, groups: int) -> pa.ListArray:
    """Every match of every item, by document."""
    order = np.lexsort((at, text))
    windows, at, text = windows[order], at[order], text[order]
    lengths = np.diff(items.edges)[windows]
    members = np.repeat(items.edges[windows] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
    names = pa.array(items.distinct.astype(object), pa.string()).take(pa.array(items.name[items.item[members]]))
    return listed(np.repeat(text, lengths), groups, structs(
        item=names, item_at=items.at[members], doc_at=np.repeat(at - first[text], lengths), length=np.repeat(items.length[windows], lengths)))


def search(index: DataFrame, items: Items, slack: int = 0, hits: bool = False) -> DataFrame:
    """One row for each document: the items that match exactly, the word ranges they cover, and the items of proximity matches.

    With ``hits`` also every single match, ``exact`` and ``near``; there may be many.
    """
    sent = index.sparkSession.sparkContext.broadcast(items)
    kind = index.schema["ids"].dataType.elementType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = sent.value
        for batch in batches:
            for r in range(batch.num_rows):
                block, ids, n_words, terms, counts, places = (batch.column(c)[r] for c in range(6))
                n_words = n_words.values.to_numpy(zero_copy_only=False)
                first, groups = np.concatenate([[0], np.cumsum(n_words)]), len(n_words)
                terms = terms.values.to_numpy(zero_copy_only=False).view(np.uint64)
                edges = np.concatenate([[0], np.cumsum(counts.values.to_numpy(zero_copy_only=False))])
                places = places.values.to_numpy(zero_copy_only=False)
                found, listed_hits = {}, {}
                for name, s in (("exact", 0), ("near", slack)):
                    w, at = (np.zeros(0, np.int64),) * 2 if name == "near" and not slack else intersected(items, terms, edges, places, first, s)
                    text = np.searchsorted(first, at, side="right") - 1
                    found[name] = names_of(items, w, text, groups)
                    if name == "exact":
                        ranges = ranges_of(text, at, at + items.length[w], first, groups)
                    if hits:
                        listed_hits[name] = hits_of(items, w, at, text, first, groups)
                yield pa.RecordBatch.from_arrays([
                    pa.array([block.as_py()] * groups, pa.string()), pa.array(np.arange(groups, dtype=np.int32)),
                    ids.values, pa.array(n_words.astype(np.int64)), found["exact"], ranges, found["near"], *listed_hits.values(),
                ], names=["block", "number", "doc_id", "n_words", "items", "ranges", "near_items", *listed_hits])

    schema = (f"block string, number int, doc_id {kind.simpleString()}, n_words long, items array<string>, "
              "ranges array<struct<start:int,stop:int>>, near_items array<string>" + (f", exact array<{HIT}>, near array<{HIT}>" if hits else ""))
    return in_batches(index, run, schema)


def chunks(items: DataFrame) -> Iterator[tuple[list[str], list[str | None], bool]]:
    """Items in chunks of at most ``CHUNK_WORDS`` words (taken as bytes / 2, of which a text has no more), and whether it is the last."""
    names, texts, size = [], [], 0
    for row in items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("name"), "text").toLocalIterator():
        n = len(row["text"] or "") // 2
        if names and size + n > CHUNK_WORDS:
            yield names, texts, False
            names, texts, size = [], [], 0
        names.append(row["name"])
        texts.append(row["text"])
        size += n
    if names:
        yield names, texts, True


def find(docs: DataFrame, items: DataFrame, slack: int = 0, window: int = WINDOW, hits: bool = False) -> DataFrame:
    """One row for each document with what matches in it (see :func:`search`).

    With items in several chunks, each chunk's rows are added to one table.
    """
    spark = docs.sparkSession
    index = build_index(docs, word_filter(items))
    counts = saved(frequencies(index), "frequencies")
    path = None
    found = search(index, _no_items(window), slack, hits)
    for number, (names, texts, last) in enumerate(chunks(items)):
        chunk = Items(names, texts, window)
        terms = spark.createDataFrame(pd.DataFrame({"term": np.unique(chunk.hashes).view(np.int64)}), "term long")
        # at most as many rows as the chunk has words
        chunk.anchored(dict(map(tuple, counts.join(F.broadcast(terms), "term").select("term", "frequency").collect())))
        found = search(index, chunk, slack, hits)
        if last and not number:
            break
        path = path or made_path(spark, "matches")
        found.write.mode("append").parquet(path)
    if path:
        found = spark.read.schema(found.schema).parquet(path)
        lists = [c for c in found.columns if c not in ("block", "number", "doc_id", "n_words")]
        found = found.groupBy("block", "number", "doc_id", "n_words").agg(*(F.flatten(F.collect_list(c)).alias(c) for c in lists))
        found = found.withColumns({c: F.array_distinct(c) for c in ("items", "near_items")})
    return found.drop("block", "number")


def _no_items(window: int) -> Items:
    none = Items([], [], window)
    none.anchored({})
    return none


def covered(ranges: Column) -> Column:
    """Number of places in a union of ranges."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("stop"))
    return F.aggregate(F.array_sort(ranges), start, lambda done, x: F.struct(
        (done["n"] + F.greatest(F.lit(0), x["stop"] - F.greatest(x["start"], done["stop"]))).alias("n"),
        F.greatest(done["stop"], x["stop"]).alias("stop")), lambda done: done["n"])


def clean_documents(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in which no window of any item occurs."""
    key = F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("text"))
    found = find(docs.select(key.alias("doc_id"), "text"), items, window=window)
    hit = found.where(F.size("items") > 0).select(F.col("doc_id.id").alias("hit_id"), F.col("doc_id.text").alias("hit_text")).distinct()
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["hit_id"]) & (F.xxhash64(docs["text"]) == hit["hit_text"]), "left_anti")


def op6_decontaminate_index(spark: SparkSession, folder: str) -> DataFrame:
    """The contract's columns are about exact matches; ``n_near`` and ``near_items`` name the items with proximity matches."""
    found = find(documents(spark, folder), table(spark, folder, "benchmark"), SLACK)
    names = F.array_join(F.array_sort("items"), ",")
    n_hit = covered(F.col("ranges"))
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.encode(names, "UTF-8"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
        F.size("near_items").cast("long").alias("n_near"), F.array_join(F.array_sort("near_items"), ",").alias("near_items"))
