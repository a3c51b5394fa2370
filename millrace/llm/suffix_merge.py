"""Repeated byte strings across all texts, by merging Burrows-Wheeler transforms of shards.

A transform lists a text's suffixes in sorted order, with the byte that precedes each. Here each shard (the
documents of one task) keeps the suffixes at anchors only: places picked by content, so that every stretch of
143 bytes holds one at the same place wherever it occurs, and every 200-byte string has a first anchor within
its first 128 bytes. An anchor suffix is kept with the bytes that follow it and those that precede it (its symbols).

1. Shards give the hash of the 73 bytes after each anchor; only suffixes that share it with another go on. The rest
   can begin no repeated string.
2. The suffixes that agree on those bytes, from all shards, are merged: their order by the bytes that follow is
   refined word by word where it is still tied, and gives the common prefix of neighbours.
3. The interleave is then refined by one preceding byte after the other: after step o, suffixes are together
   that agree on the o bytes before the anchor. Those that also have a common prefix of 200 - o bytes after it begin,
   o bytes before their anchors, the same 200-byte string: a repeated interval. Suffixes that are alone drop out.

Suffixes are never sorted as a whole, and texts never leave their shard but for those with candidates. An anchor
context so common that it would not fit one task (``HOT_ROWS``) is taken apart into its single strings, which are
counted by hash in sorted streams.

Defined results: null and empty texts have no bytes, nothing is removed, and the kept bytes' digest is that of
nothing. Texts of fewer than 200 bytes hold no such string. Of equal texts of 200 bytes or more every byte goes.
Equal rows are judged alike, rows with null or repeated ids too. An empty table gives an empty result. Strings of 73
bytes are told apart by 128 bits, texts and strings of hot contexts by 64.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.llm.tables import documents, finished, in_batches, saved
from millrace.llm.words import BYTE_VALUE, BitTable, U, Hasher, bit_table, mixed, steps

LENGTH = 200
#: Bytes that an anchor is picked by, and places of which the one with the smallest hash is the anchor.
GRAM, PICK = 16, 128
SIDE = PICK - 1
#: Bytes after an anchor that belong to every string with that first anchor.
SURE = LENGTH - SIDE
CHECK_VALUE = mixed(BYTE_VALUE)
#: Suffixes that are merged at once, and of one context at most.
MERGE_ROWS, HOT_ROWS = 20_000, 100_000
#: Texts that a task remembers, to pass on copies once only.
SEEN = 200_000


def text_key(text: bytes) -> int:
    return int.from_bytes(blake2b(text, digest_size=8).digest(), "little", signed=True)


def anchors(data: np.ndarray, offsets: np.ndarray, hashed: Hasher) -> tuple[np.ndarray, ...]:
    """Text number, place of the anchor, and first and last start of the strings whose first anchor it is."""
    n = len(data)
    if n < LENGTH:
        return (np.zeros(0, np.int64),) * 4
    at = np.arange(n - GRAM + 1)
    # ties go to the later place, so the pick depends on content alone
    least = (hashed(at, at + GRAM) >> U(32) << U(32)) | (U((1 << 32) - 1) - at.astype(np.uint64))
    span = 1
    while span < PICK:
        step = min(span, PICK - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    lengths = np.diff(offsets)
    long = np.flatnonzero(lengths >= LENGTH)
    number = lengths[long] - LENGTH + 1
    starts = np.arange(number.sum()) + np.repeat(offsets[long] - (np.cumsum(number) - number), number)
    text = np.repeat(long, number)
    anchor = (U((1 << 32) - 1) - (least[starts] & U((1 << 32) - 1))).astype(np.int64)
    first = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])) if len(starts) else [])
    last = np.append(first[1:], len(starts)) - 1
    return text[first], anchor[first], starts[first], starts[last]


def distinct_texts(batch: pa.RecordBatch, column: int, seen: set[int]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes, offsets and keys of each step, and which of its texts have not been passed on yet."""
    for lo, hi, data, offsets in steps(batch.column(column)):
        keys = np.array([text_key(data[a:b].tobytes()) for a, b in zip(offsets, offsets[1:])], np.int64)
        fresh = np.zeros(len(keys), bool)
        for i, k in enumerate(keys.tolist()):
            if k not in seen:
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(k)
                fresh[i] = True
        yield data, offsets, keys, fresh


def measured(docs: DataFrame) -> DataFrame:
    """One slim row for each document: id, key of the text, number of bytes, digest."""

    def run(batches):
        for batch in batches:
            rows = []
            for _, _, data, offsets in steps(batch.column(1)):
                for a, b in zip(offsets, offsets[1:]):
                    text = data[a:b].tobytes()
                    rows.append((text_key(text), len(text), sha256(text).hexdigest()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[c] for r in rows], kind) for c, kind in
                                                                enumerate((pa.int64(), pa.int64(), pa.string())))],
                                             names=["doc_id", "text_key", "n_bytes", "whole_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return saved(in_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, text_key long, n_bytes long, whole_sha256 string"), "measured")


PLACES = "key long, text_key long, places array<int>"


def _placed(key: np.ndarray, text: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    """One row for each key and text, with all places: a text that repeats itself has one row, not thousands."""
    order = np.lexsort((at, key, text))
    key, text, at = key[order], text[order], at[order]
    first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (text[1:] != text[:-1])) if len(key) else [])
    lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(key)).astype(np.int32)), pa.array(at.astype(np.int32)))
    return pa.RecordBatch.from_arrays([pa.array(key[first]), pa.array(text[first]), lists], names=["key", "text_key", "places"])


def shard_suffixes(docs: DataFrame) -> DataFrame:
    """Every anchor suffix of every different text: hash of its sure bytes, its text, its places."""

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            for data, offsets, keys, fresh in distinct_texts(batch, 0, seen):
                hashed = Hasher(data)
                text, anchor, _, _ = anchors(data, offsets, hashed)
                text, anchor = text[fresh[text]], anchor[fresh[text]]
                yield _placed(hashed(anchor, anchor + SURE).view(np.int64), keys[text], anchor - offsets[text])

    return in_batches(docs.select("text"), run, PLACES)


def shared(rows: DataFrame) -> DataFrame:
    """The rows (``PLACES``) whose key another text or place has too, in sorted streams."""

    def run(batches):
        held, given = None, False  # the last row so far, and whether it has been given out
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            key, text = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            size = np.diff(batch.column(2).offsets.to_numpy())
            fresh = np.append(True, (key[1:] != key[:-1]) | (text[1:] != text[:-1]))  # copies may come from several tasks
            at = np.flatnonzero(fresh)
            same = key[at][1:] == key[at][:-1]
            out = size[at] > 1
            out[1:] |= same
            out[:-1] |= same
            out[0] &= not given
            given = bool(out[-1]) or (given and len(at) == 1)
            held = batch.slice(int(at[-1]), 1)
            yield batch.take(pa.array(at[out]))

    sorted_rows = rows.repartition("key").sortWithinPartitions("key", "text_key")
    return in_batches(sorted_rows, run, PLACES)


def texts_with(docs: DataFrame, lists: DataFrame) -> DataFrame:
    """The different texts that have a row in ``lists`` (one for each ``text_key``), beside it.

    A bit table of fixed size keeps most other texts out of the shuffle; the join decides.
    """

    known = bit_table(lists.select("text_key"), lambda batch: batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        seen: set[int] = set()
        wanted = BitTable(sent.value)
        for batch in batches:
            keys, texts = [], []
            for data, offsets, key, fresh in distinct_texts(batch, 0, seen):
                for i in np.flatnonzero(fresh & wanted(key.view(np.uint64))):
                    keys.append(int(key[i]))
                    texts.append(data[offsets[i]:offsets[i + 1]].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(texts, pa.binary())], names=["text_key", "text"])

    return in_batches(docs.select("text"), run, "text_key long, text binary").join(lists, "text_key")


def _suffixes_of(text: bytes) -> tuple[np.ndarray, Hasher, np.ndarray, np.ndarray, np.ndarray]:
    data = np.frombuffer(text, np.uint8)
    hashed = Hasher(data)
    _, anchor, first, last = anchors(data, np.array([0, len(data)]), hashed)
    return data, hashed, anchor, first, last


def contexts(texts: DataFrame) -> DataFrame:
    """The suffixes to be merged, each with its symbols before, a check of its sure bytes, and the bytes after.

    ``texts`` has the candidate anchors of a text in ``places``.
    """

    def run(batches):
        for batch in batches:
            for key, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                data, hashed, anchor, first, last = _suffixes_of(text)
                there = np.isin(anchor, wanted.values.to_numpy(zero_copy_only=False))
                anchor, first, last = anchor[there], first[there], last[there]
                padded = np.concatenate([np.zeros(SIDE, np.uint8), data, np.zeros(SIDE, np.uint8)])
                around = np.lib.stride_tricks.sliding_window_view(padded, SIDE)
                check = Hasher(data, CHECK_VALUE)(anchor, anchor + SURE)
                row = np.concatenate([around[anchor], check.view(np.uint8).reshape(-1, 8), around[anchor + SIDE + SURE]], axis=1)
                blob = pa.FixedSizeBinaryArray.from_buffers(pa.binary(row.shape[1]), len(row), [None, pa.py_buffer(np.ascontiguousarray(row))])
                yield pa.RecordBatch.from_arrays([
                    pa.array(hashed(anchor, anchor + SURE).view(np.int64)), pa.array(np.full(len(anchor), key)),
                    pa.array(anchor.astype(np.int32)), pa.array((anchor - last).astype(np.int16)),
                    pa.array((anchor - first).astype(np.int16)), blob.cast(pa.binary())],
                    names=["key", "text_key", "at", "least", "most", "around"])

    return in_batches(texts.select("text_key", "text", "places"), run,
                      "key long, text_key long, at int, least short, most short, around binary")


def refined(classes: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Classes split by one more symbol, numbered again."""
    return np.unique(classes * 256 + symbols, return_inverse=True)[1]


def merged_order(block: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes by block and following bytes, and common prefix with the one before (-1: none).

    Ties are broken word by word, among those suffixes only that are still tied.
    """
    words = np.zeros((len(after), -(-after.shape[1] // 8) * 8), np.uint8)
    words[:, :after.shape[1]] = after
    words = words.view(">u8").astype(np.uint64)
    rank, order = block.copy(), np.argsort(block, kind="stable")
    for w in range(words.shape[1]):
        first = np.append(True, rank[order][1:] != rank[order][:-1])
        group = np.cumsum(first) - 1
        tied = (np.bincount(group) > 1)[group]
        if not tied.any():
            break
        at = np.flatnonzero(tied)
        mine = order[at]
        order[at] = mine[np.lexsort((words[mine, w], group[at]))]
        new = np.append(True, (rank[order][1:] != rank[order][:-1]) | (words[order, w][1:] != words[order, w][:-1]))
        rank[order] = np.cumsum(new)
    differ = after[order][1:] != after[order][:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), after.shape[1])
    common = np.where(block[order][1:] == block[order][:-1], common, -1)
    return order, np.append(-1, common)


def repeated_intervals(key: np.ndarray, around: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every suffix the fewest and the most bytes before its anchor at which a repeated string begins (-1: none)."""
    sure = np.stack([key, np.ascontiguousarray(around[:, SIDE:SIDE + 8]).view(np.int64).ravel()], axis=1)
    block = np.unique(sure, axis=0, return_inverse=True)[1].ravel()
    order, common = merged_order(block, around[:, SIDE + 8:])
    low, high = np.full(len(key), -1), np.full(len(key), -1)
    classes, alive = block[order].astype(np.int64), np.arange(len(order))
    for o in range(PICK):
        if o:
            classes = refined(classes, around[order[alive], SIDE - o])
        # suffixes that are alone stay so
        together = np.bincount(classes)[classes] > 1
        alive, classes = alive[together], classes[together]
        if not len(alive):
            break
        rows = order[alive]
        in_run = (least[rows] <= o) & (o <= most[rows])
        prefix = np.cumsum(common < SIDE - o)[alive[in_run]]
        _, place, count = np.unique(classes[in_run] * (len(order) + 1) + prefix, return_inverse=True, return_counts=True)
        found = rows[in_run][count[place] > 1]
        low[found] = np.where(low[found] < 0, o, low[found])
        high[found] = o
    return low, high


def merged(rows: DataFrame) -> DataFrame:
    """Covered intervals (``text_key``, ``start``, ``stop``) from the suffixes of all shards."""
    width = 2 * SIDE + 8

    def finish(key, text, at, least, most, around):
        own = np.unique(np.stack([text, at], axis=1), axis=0, return_index=True)[1]
        key, text, at, least, most, around = (x[own] for x in (key, text, at, least, most, around))
        low, high = repeated_intervals(key, around, least, most)
        hit = high >= 0
        return pa.RecordBatch.from_arrays([pa.array(text[hit]), pa.array((at - high)[hit].astype(np.int32)),
                                           pa.array((at - low)[hit].astype(np.int32) + np.int32(LENGTH))], names=["text_key", "start", "stop"])

    def run(batches):
        parts: list[list[np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            blob = batch.column(5).cast(pa.binary(width))
            around = np.frombuffer(blob.buffers()[1], np.uint8)[width * blob.offset:width * (blob.offset + len(blob))]
            parts.append([*(batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(5)), around.reshape(-1, width)])
            if sum(len(p[0]) for p in parts) >= MERGE_ROWS:
                columns = [np.concatenate(c) for c in zip(*parts)]
                # whole contexts only: what has the last key waits
                whole = int(np.searchsorted(columns[0] == columns[0][-1], True))
                if whole:
                    yield finish(*(c[:whole] for c in columns))
                parts = [[c[whole:].copy() for c in columns]]
        if parts:
            yield finish(*(np.concatenate(c) for c in zip(*parts)))

    sorted_rows = rows.repartition("key").sortWithinPartitions("key")
    return in_batches(sorted_rows, run, "text_key long, start int, stop int")


def single_strings(texts: DataFrame) -> DataFrame:
    """Every 200-byte string whose first anchor is one of the text's ``places``, by hash."""

    def run(batches):
        for batch in batches:
            for key, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                data, hashed, anchor, first, last = _suffixes_of(text)
                there = np.isin(anchor, wanted.values.to_numpy(zero_copy_only=False))
                first, number = first[there], (last - first + 1)[there]
                starts = np.arange(number.sum()) + np.repeat(first - (np.cumsum(number) - number), number)
                yield _placed(hashed(starts, starts + LENGTH).view(np.int64), np.full(len(starts), key), starts)

    return in_batches(texts.select("text_key", "text", "places"), run, PLACES)


def repeated(docs: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Covered intervals of the different texts, in bytes; they may overlap."""
    return finished(docs.sparkSession, lambda: _repeated(docs, hot_rows), "intervals")


def _repeated(docs: DataFrame, hot_rows: int) -> DataFrame:
    candidates = saved(shared(shard_suffixes(docs)), "suffixes")
    hot = saved(candidates.groupBy("key").agg(F.sum(F.size("places")).alias("rows")).where(F.col("rows") > hot_rows)
                .select(F.col("key").alias("hot_key")), "hot")
    marked = candidates.join(hot, candidates["key"] == hot["hot_key"], "left")

    def lists(rows: DataFrame) -> DataFrame:
        return rows.groupBy("text_key").agg(F.flatten(F.collect_list("places")).alias("places"))

    found = merged(contexts(texts_with(docs, lists(marked.where("hot_key IS NULL")))))
    if not hot.isEmpty():
        single = shared(single_strings(texts_with(docs, lists(marked.where("hot_key IS NOT NULL")))))
        single = single.select("text_key", F.explode("places").alias("start"))
        found = found.unionByName(single.withColumn("stop", F.col("start") + LENGTH))
    return found


def cut_texts(docs: DataFrame, intervals: DataFrame) -> DataFrame:
    """For each different text with intervals: bytes and runs removed, what is kept."""
    lists = intervals.groupBy("text_key").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))

    def run(batches):
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2)):
                edges = np.zeros(len(text) + 1, np.int32)
                start, stop = (spans.values.field(c).to_numpy(zero_copy_only=False) for c in (0, 1))
                np.add.at(edges, start, 1)
                np.add.at(edges, stop, -1)
                gone = np.cumsum(edges[:-1]) > 0
                runs = int((gone & ~np.append(False, gone[:-1])).sum())
                rows.append((int(gone.sum()), runs, np.frombuffer(text, np.uint8)[~gone].tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[c] for r in rows], kind) for c, kind in
                                                                enumerate((pa.int64(), pa.int64(), pa.binary())))],
                                             names=["text_key", "n_removed", "n_spans", "kept"])

    return in_batches(texts_with(docs, lists).select("text_key", "text", "spans"), run,
                      "text_key long, n_removed long, n_spans long, kept binary")


def op10_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    rows = measured(docs)
    copies = rows.groupBy("text_key").agg(F.count("*").alias("copies"))
    cut = cut_texts(docs, repeated(docs)).select("text_key", "n_removed", "n_spans", F.sha2("kept", 256).alias("cut_sha256"))
    found = saved(copies.join(cut.dropDuplicates(["text_key"]), "text_key", "left"), "cut")
    rows = rows.join(found, "text_key")
    all_gone = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)

    def pick(copied: Column, name: str, else_: Column) -> Column:
        return F.when(all_gone, copied).otherwise(F.coalesce(F.col(name), else_)).alias(name)

    return rows.select(
        "doc_id", "n_bytes", pick(F.col("n_bytes"), "n_removed", F.lit(0).cast("long")),
        pick(F.lit(1).cast("long"), "n_spans", F.lit(0).cast("long")),
        F.when(all_gone, F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("cut_sha256", "whole_sha256")).alias("kept_sha256"))
