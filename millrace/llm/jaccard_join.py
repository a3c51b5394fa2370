"""N-gram Jaccard join: links between texts whose sets of word shingles are similar, and their components.

Texts of equal sets are one class; only classes are joined. The join is size-aware:

* Light sets (small): every subset that is as large as an overlap with a similar set can be is enumerated. Two
  sets that share such a subset, large enough for both sizes, are similar: that is a link, without comparing.
* Heavy sets: the shingles are dealt by hash into more blocks than the differences that similarity allows, so
  similar sets agree on a whole block. Inverted lists of blocks are scanned. A list of a single shingle would hold
  every text with a common passage; few lists of blocks do.
* Lists that are long all the same are left out at first. The shingles in their blocks are frequent; sets that are
  in long lists are dealt again without frequent shingles. Similar sets lose the same ones, so they still agree on
  a block. Lists that are long even then (different near copies of one text) are cut into chunks, and each pair of
  chunks is a list of its own.
* Within a list, sets are told apart by sketches: how many shingles fall into each of some ranges of hashes. The
  sketches of similar sets differ by no more than the sets, so no pair is missed, and most unlike sets that only
  share a passage part here. What is left, directly or by way of others, forms a cluster, and within clusters the
  sets themselves are compared, in chunks of bounded size.

The boundary is the size for which the estimated rows of both ways are fewest, from a histogram of sizes. Sets a
little below it take part in both, so no pair is missed. Nothing is emitted for all pairs of a list or cluster:
lists and clusters give one link for each set they join.

An empty block says nothing, so some spare blocks are dealt; a set that still has more empty ones than spares is
dealt once more with another hash, as often as it takes.

Defined results: texts without words, and null texts, have the empty set and link with nothing, not even each
other. A text of fewer words than a shingle is one shingle. Repeated rows are copies. The component is named by its
smallest id; rows without an id belong to components but never name one (a component of such rows only has none).
Empty tables give empty results. Shingles, and whole sets, are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from millrace.llm.components import components
from millrace.llm.tables import documents, finished, in_batches, perhaps_among, saved
from millrace.llm.words import SPACE, BitTable, U, Words, bit_table, lowered, mixed, steps, windows

FOLDED = lowered(SPACE)
#: Largest boundary that is weighed.
LARGEST_LIGHT = 64
#: Weight of comparing a heavy set, in rows for each shingle.
COMPARE = 0.25
#: Most shingles and sets of a chunk.
CHUNK_SHINGLES, CHUNK_SETS = 1 << 20, 1024
#: Longest list of a block that is followed without dealing its sets again.
LONG = 1024
#: Shingles to a range of a sketch, and sets of a list that are held against as many others at once.
SKETCHED, SIDE_BY_SIDE = 8, 256
#: Places over which the rows of a long list are spread.
SPREAD = 16
#: Shingles that are dealt at once; a larger set is dealt by itself.
DEALT = 1 << 17
#: Sets that a task remembers, to pass on each once only, and rows that it sends on together.
SEEN, SENT_ROWS = 200_000, 50_000


class Rule(NamedTuple):
    """Words in a shingle, and the least similarity in percent."""

    size: int = 3
    percent: int = 90

    def similar(self, overlap, a, b):
        return (100 + self.percent) * overlap >= self.percent * (a + b)

    def fewest_shared(self, n: int) -> int:
        """Least overlap of a set of n with any similar one."""
        return -(-self.percent * n // 100)

    def most_different(self, a: int, b: int) -> int:
        """Most shingles that are in just one of two similar sets."""
        return (100 - self.percent) * (a + b) // (100 + self.percent)

    def level(self, n: int) -> int:
        """Sizes of one level differ by no more than similar sets can; similar sets are one level apart at most."""
        return math.floor(math.log(n) / -math.log(self.percent / 100) + 1e-9) if n else 0

    def largest(self, level: int) -> int:
        """No set of the level is larger."""
        return math.floor((100 / self.percent) ** (level + 1) + 1e-6)

    def blocks(self, level: int) -> tuple[int, int]:
        """Number of blocks for sets of a level and the next, and how many of them may be empty."""
        different = self.most_different(self.largest(level), self.largest(level + 1))
        spare = 2 + different // 16
        return different + 1 + spare, spare


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The set of every text, as sorted hashes."""
    for _, _, data, offsets in steps(column):
        words = Words(data, offsets, FOLDED)
        hashes = words.hashes()
        grams, at = windows(hashes, words.first, size)
        bounds = np.searchsorted(at, words.first)
        for t, n in enumerate(words.counts):
            if n >= size:
                yield np.unique(grams[bounds[t]:bounds[t + 1]])
            elif n:
                short = windows(hashes[words.first[t]:words.first[t + 1]], np.array([0, n]), int(n))[0]
                yield mixed(short + U(n))
            else:
                yield np.zeros(0, np.uint64)


def set_id(shingles: np.ndarray) -> int | None:
    return int.from_bytes(blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True) if len(shingles) else None


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Numbers of shingles in equal ranges of hashes, to 255; a power of two of ranges, more for larger sets."""
    bits = max(0, (len(shingles) // SKETCHED).bit_length())
    if not bits:
        return np.array([min(len(shingles), 255)], np.uint8)
    counts = np.bincount((shingles >> U(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(counts, 255).astype(np.uint8)


def folded(sketches: list[bytes]) -> np.ndarray:
    """Sketches as rows of as many ranges as the shortest has. Where 255 stands for more, sums are no larger than true."""
    width = min(map(len, sketches))
    rows = (np.frombuffer(s, np.uint8).astype(np.int32) for s in sketches)
    return np.stack([r if len(r) == width else r.reshape(width, -1).sum(axis=1) for r in rows])


def signed(docs: DataFrame, rule: Rule) -> DataFrame:
    """One row for each document: id, set, size and sketch of the set, and its shingles.

    Shingles are given once for each set as far as a task remembers. They are kept, since texts take longer to cut
    and to hash than sets to read.
    """

    def run(batches):
        seen: set[int] = set()

        def new(own: int | None) -> bool:
            if own is None or own in seen:
                return False
            if len(seen) >= SEEN:
                seen.clear()
            seen.add(own)
            return True

        for batch in batches:
            sets = list(shingle_sets(batch.column(1), rule.size))
            names = list(map(set_id, sets))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([sketch(s).tobytes() for s in sets], pa.binary()),
                 pa.array([s.tobytes() if new(own) else None for own, s in zip(names, sets)], pa.binary())],
                names=["doc_id", "set", "n", "sketch", "shingles"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return in_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, set long, n long, sketch binary, shingles binary")


def stored(batches) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Some rows at a time of columns ``set`` and ``shingles``: the sets, the shingles of all in a row, and their numbers."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(1).cast(pa.large_binary())
        _, offsets, data = column.buffers()
        offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
        names, low = batch.column(0).to_numpy(zero_copy_only=False), 0
        while low < len(names):
            high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + 8 * DEALT, side="right")) - 1)
            yield (names[low:high], np.frombuffer(data, np.uint8)[offsets[low]:offsets[high]].view(np.uint64),
                   np.diff(offsets[low:high + 1]) // 8)
            low = high


def together(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Record batches of many short pieces of columns."""
    held, size = [], 0

    def sent():
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    for row in rows:
        held.append(row)
        size += len(row[0])
        if size >= SENT_ROWS:
            yield sent()
            held, size = [], 0
    if held:
        yield sent()


def subset_count(n: int, rule: Rule) -> int:
    return sum(math.comb(n, d) for d in range(n - rule.fewest_shared(n) + 1))


def boundary(classes: DataFrame, rule: Rule) -> int:
    """The largest light size: the one for which the rows to be shuffled and compared are fewest."""
    sizes = {r["n"]: r["count"] for r in classes.where(F.col("n") <= 2 * LARGEST_LIGHT).groupBy("n").count().collect()}

    def heavy(n: int) -> float:
        level = rule.level(n)
        return rule.blocks(level)[0] + rule.blocks(max(level - 1, 0))[0] + COMPARE * n

    def cost(x: int) -> float:
        return sum(c * (subset_count(n, rule) * (n <= x) + heavy(n) * (n >= rule.fewest_shared(x + 1))) for n, c in sizes.items())

    # enumeration grows without bound, so sizes are weighed up to where one set costs more than all of them
    return min((x for x in range(1, LARGEST_LIGHT + 1) if subset_count(x, rule) < 100_000), key=cost, default=1)


def subset_keys(shingles: np.ndarray, rule: Rule) -> Iterator[tuple[int, int, int]]:
    """Two hashes and the size of every subset that may be the overlap with a similar set."""
    first, second = mixed(shingles), mixed(shingles ^ U(0x5851F42D4C957F2D))
    n = len(shingles)
    with np.errstate(over="ignore"):
        a, b = first.sum(dtype=np.uint64), second.sum(dtype=np.uint64)
        for d in range(n - rule.fewest_shared(n) + 1):
            for out in combinations(range(n), d):
                out = list(out)
                yield (int((a - first[out].sum(dtype=np.uint64)).view(np.int64)),
                       int((b - second[out].sum(dtype=np.uint64)).view(np.int64)), n - d)


class Dealing(NamedTuple):
    """Blocks of several sets: a hash of each that is not empty, its set, and where it starts and ends in what is dealt.

    ``places`` are those of the dealt shingles among the shingles of all sets; none if it is not these that are dealt.
    """

    keys: np.ndarray
    owner: np.ndarray
    first: np.ndarray
    last: np.ndarray
    places: np.ndarray | None


def dealings(shingles: np.ndarray, sizes: np.ndarray, rule: Rule, kept: np.ndarray | None = None) -> Iterator[Dealing]:
    """The sets, one after the other in ``shingles``, dealt into blocks, all at once.

    A set is dealt for its own level and the one below. With ``kept``, which tells the shingles that are not left out,
    blocks are of those, and of all only if too many are empty.
    """
    levels = np.zeros(len(sizes), np.int64)
    for n in np.unique(sizes):
        levels[sizes == n] = rule.level(int(n))
    for below in (0, 1):
        todo = np.flatnonzero(levels >= below)
        # the shingles of the sets still to be dealt, and whose of them they are
        held, own = np.flatnonzero(np.repeat(levels >= below, sizes)), np.repeat(np.arange(len(todo)), sizes[todo])
        blocks = {int(at): rule.blocks(int(at)) for at in np.unique(levels[todo] - below)}
        number, spare = np.array([blocks[int(at)] for at in levels[todo] - below], np.int64).reshape(-1, 2).T
        deal = 1 if kept is None else 0
        while len(todo):
            name = ((levels[todo] - below << 32) + deal).astype(np.uint64)
            of, places = (own, held) if deal else (own[kept[held]], held[kept[held]])
            dealt = shingles[places]
            if deal > 1:
                dealt, places = mixed(dealt + U(deal)), None
                dealt = dealt[np.lexsort((dealt, of))]
            # hashes of a set are sorted, so a block is a range of them
            width = np.array([(1 << 64) // int(n) for n in number], np.uint64)
            block = np.minimum(dealt // width[of], (number - 1).astype(np.uint64)[of])
            first = np.flatnonzero(np.append(True, (block[1:] != block[:-1]) | (of[1:] != of[:-1]))[:len(dealt)])
            last = np.append(first[1:], len(dealt))[:len(first)]
            sums = np.zeros(len(dealt) + 1, np.uint64)
            np.cumsum(mixed(dealt + U(0x2545F4914F6CDD1D)), out=sums[1:])
            yield Dealing(mixed((sums[last] - sums[first]) ^ mixed(mixed(block[first]) + name[of[first]])), todo[of[first]], first, last, places)
            again = (number - np.bincount(of[first], minlength=len(todo)) > spare) & (deal <= 4 * sizes[todo])
            held, own = held[again[own]], (np.cumsum(again) - 1)[own[again[own]]]
            todo, number, spare, deal = todo[again], number[again], spare[again], deal + 1


def block_keys(shingles: np.ndarray, rule: Rule) -> np.ndarray:
    return np.concatenate([d.keys for d in dealings(shingles, np.array([len(shingles)]), rule)])


def light_rows(sets: DataFrame, rule: Rule, light: int) -> DataFrame:
    """The subsets of all sets up to the boundary."""
    schema = pa.schema([("set", pa.int64()), ("n", pa.int32()), ("key", pa.int64()), ("check", pa.int64()), ("shared", pa.int32())])

    def run(batches):
        def rows():
            for names, shingles, sizes in stored(batches):
                for own, one in zip(names, np.split(shingles, np.cumsum(sizes)[:-1])):
                    keys = np.array(list(subset_keys(one, rule)), np.int64).reshape(-1, 3)
                    yield np.full(len(keys), own), np.full(len(keys), len(one)), keys[:, 0], keys[:, 1], keys[:, 2]

        yield from together(rows(), schema)

    return in_batches(sets.where(F.col("n") <= light).select("set", "shingles"), run, "set long, n int, key long, check long, shared int")


KEYED = pa.schema([("key", pa.int64()), ("set", pa.int64())])


def heavy_sets(sets: DataFrame, rule: Rule, light: int) -> DataFrame:
    """The sets above the boundary, and those so close to it that they may link across."""
    return sets.where(F.col("n") >= rule.fewest_shared(light + 1)).select("set", "shingles")


def block_rows(sets: DataFrame, rule: Rule) -> DataFrame:
    """The blocks of all sets."""

    def run(batches):
        yield from together(((d.keys.view(np.int64), names[d.owner]) for names, shingles, sizes in stored(batches)
                             for d in dealings(shingles, sizes, rule)), KEYED)

    return in_batches(sets, run, "key long, set long")


def light_links(rows: DataFrame, rule: Rule) -> DataFrame:
    """Every set with the smallest that has the same subset: if that is too small for a pair, so is any other."""
    ends = F.struct("n", "set")
    shared = (rows.groupBy("key", "check", "shared").agg(F.min(ends).alias("least"), F.max(ends).alias("most"))
              .where("least <> most").drop("most"))
    rows = rows.join(shared, ["key", "check", "shared"])
    close = rule.similar(F.col("shared"), F.col("n"), F.col("least.n"))
    return rows.where(close & (F.col("set") != F.col("least.set"))).select(F.col("set").alias("a"), F.col("least.set").alias("b"))


def shared_lists(rows: DataFrame, longest: int | None = None) -> DataFrame:
    """The rows ``key``, ``set`` of inverted lists with several sets; of a list of more than ``longest`` its key alone.

    Rows come sorted by block, and of a list that goes on in the next batch no more than ``longest`` rows wait.
    """

    def found(rows: np.ndarray) -> pa.RecordBatch:
        first = np.flatnonzero(np.append(True, rows[1:, 0] != rows[:-1, 0])) if len(rows) else np.zeros(0, np.int64)
        size = np.diff(np.append(first, len(rows)))
        long = size > (longest or len(rows))
        kept = rows[np.repeat((size > 1) & ~long, size)]
        key = np.concatenate([kept[:, 0], rows[first[long], 0]])
        return pa.RecordBatch.from_arrays([
            pa.array(key), pa.array(np.concatenate([kept[:, 1], np.zeros(long.sum(), np.int64)]), mask=np.arange(len(key)) >= len(kept))],
            names=["key", "set"])

    def run(batches):
        held = np.zeros((0, 2), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            held = np.concatenate([held, np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1)], axis=1)])
            # copies of a set may come from several tasks
            held = held[np.append(True, (held[1:] != held[:-1]).any(axis=1))]
            open_ = int(np.searchsorted(held[:, 0] == held[-1, 0], True))
            yield found(held[:open_])
            held = held[open_:] if longest is None else held[open_:][:longest + 1]
        if len(held):
            yield found(held)

    return in_batches(rows.repartition("key").sortWithinPartitions("key", "set"), run, "key long, set long")


def in_chunks(rows: DataFrame, long: DataFrame) -> DataFrame:
    """The rows of the lists whose keys ``long`` has, cut by hash into chunks: each pair of chunks is a list.

    The rows of a key are spread while their number is looked up and while they are repeated for the pairs.
    """
    place = F.pmod(F.hash("set"), F.lit(SPREAD))

    def spread(keys: DataFrame) -> DataFrame:
        return keys.withColumn("place", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))

    rows = saved(rows.withColumn("place", place).join(spread(long.select("key").distinct()), ["key", "place"])
                 .select("key", "set").distinct(), "long")
    parts = rows.groupBy("key").agg(F.ceil(F.count("*") / F.lit(LONG)).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("set"), F.col("parts")).cast("int")
    rows = rows.withColumn("place", place).join(spread(parts), ["key", "place"]).withColumn("own", own)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return rows.select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key"), "set")


def alike(sizes: np.ndarray, sketches: list[bytes], rule: Rule) -> np.ndarray:
    """For each set of a list the first of those it is tied to by sketches that similar sets may have."""
    group = np.arange(len(sizes))
    rows = folded(sketches)

    def close(a: slice, b: slice) -> np.ndarray:
        apart = np.abs(rows[a, None, :] - rows[None, b, :]).sum(axis=2)
        return apart <= rule.most_different(sizes[a, None], sizes[None, b])

    for low in range(0, len(sizes), SIDE_BY_SIDE):
        a = slice(low, low + SIDE_BY_SIDE)
        for other in range(0, low + 1, SIDE_BY_SIDE):
            b = slice(other, other + SIDE_BY_SIDE)
            if (group[a] == group[low]).all() and (group[b] == group[low]).all():
                continue
            near = close(a, b)
            # pairs of one group say nothing new
            for i in np.flatnonzero((near & (group[a, None] != group[None, b])).any(axis=1)):
                tied = np.unique(np.append(group[b][near[i]], group[low + i]))
                if len(tied) > 1:
                    group[np.isin(group, tied)] = tied[0]
    return group


def list_links(lists: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """Links of the sets in the same list whose sketches do not rule out that they are similar."""

    def links(key, own, size, sketches) -> pa.RecordBatch:
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        a, b = [], []
        for low, high in zip(first, np.append(first[1:], len(key))):
            if high - low == 2 and len(sketches[low]) == len(sketches[low + 1]):
                # most lists
                gap = np.abs(np.frombuffer(sketches[low], np.uint8).astype(np.int32) - np.frombuffer(sketches[low + 1], np.uint8)).sum()
                if gap <= rule.most_different(size[low], size[low + 1]):
                    a.append(own[low + 1])
                    b.append(own[low])
            elif high - low > 1:
                group = alike(size[low:high], sketches[low:high], rule)
                tied = np.flatnonzero(group != np.arange(high - low))
                a.extend(own[low + tied])
                b.extend(own[low + group[tied]])
        pairs = np.unique(np.stack([np.array(a, np.int64), np.array(b, np.int64)], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = [*(batch.column(c).to_numpy(zero_copy_only=False) for c in range(3)), np.array(batch.column(3).to_pylist() + [None], object)[:-1]]
            held = new if held is None else [np.concatenate(c) for c in zip(held, new)]
            open_ = int(np.searchsorted(held[0] == held[0][-1], True))
            if open_:
                yield links(*(c[:open_] for c in held))
                held = [c[open_:] for c in held]
        if held is not None:
            yield links(*held)

    rows = lists.join(classes.select("set", "n", "sketch"), "set").select("key", "set", "n", "sketch")
    return in_batches(rows.repartition("key").sortWithinPartitions("key", "set"), run, "a long, b long").distinct()


def sets_of(sets: DataFrame, members: DataFrame) -> DataFrame:
    """The sets named in ``members`` (one row for each ``set``), as bytes, beside its columns.

    A map of fixed size keeps most others out of the shuffle; the join decides.
    """
    return perhaps_among(sets.select("set", "shingles"), members, "set").join(members, "set")


def in_clusters(links: DataFrame, classes: DataFrame) -> DataFrame:
    """Sets that links bring together: ``set``, ``n``, ``cluster``, and into how many parts the cluster is cut."""
    nodes = components(links)
    members = nodes.join(classes, nodes["node"] == classes["set"]).select("set", "n", F.col("root").alias("cluster"))
    sums = members.groupBy("cluster").agg(F.sum("n").alias("weight"), F.count("*").alias("sets"))
    parts = F.greatest(F.ceil(F.col("weight") / CHUNK_SHINGLES), F.ceil(F.col("sets") / CHUNK_SETS)).cast("int")
    return saved(members.join(sums.select("cluster", parts.alias("parts")), "cluster"), "members")


def dealt_again(sets: DataFrame, rule: Rule, long: DataFrame) -> DataFrame:
    """Blocks of the sets in long lists (``long`` has their keys), without the shingles of such lists.

    Both are told by tables of fixed size; what they hold besides is the same for all sets.
    """
    spark = sets.sparkSession
    sent = spark.sparkContext.broadcast(bit_table(long.select("key"), lambda batch: batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)))

    def of_long(batches) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Sets with a block that is a long list, with which of their shingles are in such blocks."""
        keys = BitTable(sent.value)
        for names, shingles, sizes in stored(batches):
            inside, any_long = np.zeros(len(shingles), bool), np.zeros(len(sizes), bool)
            for d in dealings(shingles, sizes, rule):
                long_ = keys(d.keys)
                any_long[d.owner[long_]] = True
                if d.places is not None:
                    inside[d.places[np.repeat(long_, d.last - d.first)]] = True
            if any_long.any():
                in_any = np.repeat(any_long, sizes)
                yield names[any_long], shingles[in_any], sizes[any_long], inside[in_any]

    def frequent(batch: pa.RecordBatch) -> np.ndarray:
        return np.concatenate([shingles[inside] for _, shingles, _, inside in of_long([batch])] or [np.zeros(0, np.uint64)])

    shingles_sent = spark.sparkContext.broadcast(bit_table(sets, frequent))

    def run(batches):
        common = BitTable(shingles_sent.value)
        yield from together(((d.keys.view(np.int64), names[d.owner]) for names, shingles, sizes, _ in of_long(batches)
                             for d in dealings(shingles, sizes, rule, ~common(shingles))), KEYED)

    return in_batches(sets, run, "key long, set long")


def compared(frame: pd.DataFrame, rule: Rule) -> Iterator[tuple[int, int]]:
    """Links among the sets of one chunk: each set that has any with the first of those it is joined to."""
    names, sets = frame["set"].tolist(), [np.frombuffer(x, np.uint64) for x in frame["shingles"]]
    sizes = np.array([len(s) for s in sets], np.int64)
    if len(sets) < 2:
        return
    if len(sets) == 2:
        overlap = len(np.intersect1d(*sets, assume_unique=True))
        shared = np.array([[0, overlap], [overlap, 0]])
    else:
        owner = np.repeat(np.arange(len(sets)), sizes)
        _, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        common = count[place] > 1
        column = (np.cumsum(count > 1) - 1)[place[common]]
        owner = owner[common]
        order = np.argsort(column, kind="stable")
        column, owner = column[order], owner[order]
        shared = np.zeros((len(sets), len(sets)), np.float32)
        width = max(1, (1 << 22) // len(sets))
        for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
            a, b = np.searchsorted(column, [low, low + width])
            part = np.zeros((len(sets), width), np.float32)
            part[owner[a:b], column[a:b] - low] = 1
            shared += part @ part.T
    linked = rule.similar(shared.astype(np.int64), sizes[:, None], sizes[None, :])
    np.fill_diagonal(linked, True)
    group = np.arange(len(sets))
    while True:
        least = np.where(linked, group[None, :], len(sets)).min(axis=1)
        if (least == group).all():
            break
        group = least
    for i, g in enumerate(group):
        if g != i:
            yield names[i], names[g]


def cluster_links(sets: DataFrame, members: DataFrame, rule: Rule) -> DataFrame:
    """Exact links within clusters, compared in chunks, small clusters many at a time."""
    weight = members.where("parts = 1").agg(F.sum("n")).first()[0] or 0
    bins = int(weight // CHUNK_SHINGLES) + 1
    rows = sets_of(sets, members.select("set", "cluster", "parts"))
    own = F.pmod(F.hash("set"), F.col("parts"))
    # a chunk of a large cluster meets each other chunk of it once
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    one = F.concat(F.lit("bin "), F.pmod(F.hash("cluster"), F.lit(bins)))
    pair = F.concat_ws(" ", "cluster", F.least("own", "other"), F.greatest("own", "other"))
    rows = rows.select("set", "shingles", "cluster", F.when(F.col("parts") == 1, one).otherwise(pair).alias("group"))

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates("set")
        found = [link for _, part in frame.groupby("cluster", sort=False) for link in compared(part, rule)]
        return pd.DataFrame(found, columns=["a", "b"])

    return rows.groupBy("group").applyInPandas(compare, "a long, b long")


def all_links(sets: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """Links ``a``, ``b`` between similar sets, enough of them to keep together all that are."""
    light = boundary(classes, rule)
    links = light_links(saved(light_rows(sets, rule, light), "subsets"), rule)
    heavy = heavy_sets(sets, rule, light)
    lists = saved(shared_lists(block_rows(heavy, rule), LONG), "lists")
    long, lists = lists.where("set IS NULL"), lists.where("set IS NOT NULL")
    if not long.isEmpty():
        again = saved(dealt_again(heavy, rule, long), "again")
        left = saved(shared_lists(again, LONG), "left")
        lists = lists.unionByName(left.where("set IS NOT NULL"))
        long = left.where("set IS NULL")
        if not long.isEmpty():
            lists = lists.unionByName(in_chunks(again, long))
    members = finished(sets.sparkSession, lambda: in_clusters(list_links(lists, classes, rule), classes), "members")
    return links.unionByName(cluster_links(sets, members, rule))


def joined(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """One row for each document: id, set and size of its set, its component and that one's smallest id."""
    rows = saved(signed(docs, rule), "signed")
    classes = saved(rows.where("set IS NOT NULL").groupBy("set").agg(
        F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.min("doc_id").alias("doc")), "classes")
    spark = docs.sparkSession
    sets = rows.where("shingles IS NOT NULL").select("set", "n", "shingles")
    links = finished(spark, lambda: all_links(sets, classes, rule), "links")
    labels = finished(spark, lambda: components(links), "labels")
    named = classes.join(labels, classes["set"] == labels["node"], "left").select("set", F.coalesce("root", "set").alias("root"), "doc")
    names = named.groupBy("root").agg(F.min("doc").alias("component_id"))
    named = saved(named.join(names, "root").select(F.col("set").alias("of"), "root", "component_id"), "named")
    return (rows.join(named, rows["set"] == named["of"], "left")
            .select("doc_id", "set", "n", "root", F.when(F.col("set").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))


def one_of_each(docs: DataFrame, rule: Rule = Rule(5, 80)) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row with the smallest id stays.

    Rows without words all stay. Ids come before no id; of several rows with that id, the smallest set id, then
    the smallest hash of the whole row decides.
    """
    rows = saved(joined(docs, rule), "joined")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "set"))
    kept = rows.where("set IS NOT NULL").groupBy("root").agg(first.alias("k")).select("k.doc_id", "k.set")
    same = F.col("r.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("r.set") == F.col("k.set"))
    kept = saved(rows.alias("r").join(kept.alias("k"), same).groupBy("r.doc_id", "r.set")
                 .agg(F.count("*").alias("times")).toDF("kept_id", "kept_set", "times"), "kept")

    at, at_id = docs.columns.index("text"), docs.columns.index("doc_id")

    def sign(batches):
        for batch in batches:
            sets = pa.array(map(set_id, shingle_sets(batch.column(at), rule.size)), pa.int64())
            whole = pa.StructArray.from_arrays(batch.columns, fields=list(batch.schema))
            yield pa.RecordBatch.from_arrays([whole, batch.column(at_id), sets], names=["row", "id", "set"])

    marked = in_batches(docs, sign, StructType([StructField("row", docs.schema), StructField("id", docs.schema["doc_id"].dataType),
                                                StructField("set", LongType())]))
    found = marked.join(kept, marked["id"].eqNullSafe(kept["kept_id"]) & (marked["set"] == kept["kept_set"]))
    out = found.where("times = 1").select("row.*").unionByName(marked.where("set IS NULL").select("row.*"))
    if not kept.where("times > 1").isEmpty():
        place = Window.partitionBy("id", "set").orderBy(F.xxhash64("row"))
        out = out.unionByName(found.where("times > 1").withColumn("place", F.row_number().over(place)).where("place = 1").select("row.*"))
    return out


def op7_jaccard_components(spark: SparkSession, folder: str) -> DataFrame:
    return joined(documents(spark, folder), Rule(3, 90)).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
