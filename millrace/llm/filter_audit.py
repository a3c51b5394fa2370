"""How filters overlap: what each of them removes in every order they could be applied in, from decision diagrams.

Every document gets a mask with one bit for each filter it fails. The masks are counted per part of the corpus, which
leaves at most 2^filters rows a part. From these rows a decision diagram is built: one level for each filter,
an edge for documents that pass and one for those that fail, and at every node the number of documents below it.
Neighbouring levels are swapped until all orders have been seen (each order is one swap away from the one before).
In each order the path of documents that pass everything gives the steps: at a node, the failing edge holds what
the step removes and the passing edge what it keeps. A filter that comes first removes all that fail it, one that
comes last only those that fail nothing else.

Defined results: a null text is empty; an empty text has no words and fails A only, and E if a smaller id has an empty text
too. Texts are equal if their SHA-256 is. A document without an id neither fails E nor makes others fail it;
rows that repeat the smallest id of a text all pass. A document counts as good (toxic) if any label row of its id
has quality (toxic) 1; rows without an id have no label. A null language is the part of the empty string. Empty tables
give no rows. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.llm.tables import documents, in_batches, saved, table

FILTERS = "ABCDE"
MIN_WORDS = 200
DISTINCT_PERCENT = 50
CAPITAL_PERCENT = 3
#: What is counted: documents, good ones, toxic ones.
COUNTS = ("docs", "good", "toxic")
STEP = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
        "good_lost long, toxic_lost long, shapley long")


def text_failures(text: Column) -> dict[str, Column]:
    """The conditions that look at one text only."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+", -1), "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < DISTINCT_PERCENT * F.size(words),
        "C": 100 * capitals > CAPITAL_PERCENT * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def failure_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each document: ``part``, ``mask`` (bit i: fails filter i), ``good``, ``toxic``.

    Texts are read once. Copies are told by id and digest together, so those of one text never meet in a task.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    bits = sum(F.when(failed, F.lit(1 << FILTERS.index(name))).otherwise(0) for name, failed in text_failures(text).items())
    narrow = saved(docs.select("doc_id", "lang", text.alias("text")).select(
        "doc_id", F.coalesce("lang", F.lit("")).alias("part"), bits.alias("bits"),
        F.unhex(F.sha2("text", 256)).alias("digest")), "masks")
    first = (narrow.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
             .withColumn("first", F.lit(True)))
    marked = labels.where("quality = 1 OR toxic = 1").groupBy("doc_id").agg(
        *(F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(name) for name, c in (("good", "quality"), ("toxic", "toxic"))))
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return narrow.join(first, ["digest", "doc_id"], "left").join(marked, "doc_id", "left").select(
        "part", (F.col("bits") + F.when(copy, 1 << FILTERS.index("E")).otherwise(0)).cast("int").alias("mask"),
        *(F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")))


class Node:
    """A filter's place on one path: what passes, what fails, and the counts of both together."""

    __slots__ = ("passed", "failed", "counts")

    def __init__(self, passed: Node | None, failed: Node | None, counts: tuple[int, ...] | None = None):
        self.passed, self.failed = passed, failed
        self.counts = counts or tuple(a + b for a, b in zip(below(passed), below(failed)))


def below(node: Node | None) -> tuple[int, ...]:
    return node.counts if node else (0,) * len(COUNTS)


class Diagram:
    """A count-weighted decision diagram of failure masks. Equal branches are one node, branches without rows none."""

    def __init__(self, filters: str, counts: dict[int, tuple[int, ...]]):
        self.order = list(filters)
        self.levels: list[dict] = [{} for _ in filters]
        leaves: dict[tuple, Node] = {}

        def grown(level: int, mask: int) -> Node | None:
            if level == len(filters):
                return leaves.setdefault(counts[mask], Node(None, None, counts[mask])) if mask in counts else None
            return self._node(level, grown(level + 1, mask), grown(level + 1, mask | 1 << level))

        self.root = grown(0, 0)

    def _node(self, level: int, passed: Node | None, failed: Node | None) -> Node | None:
        if passed is None and failed is None:
            return None
        key = (passed, failed)
        found = self.levels[level].get(key)
        if found is None:
            found = self.levels[level][key] = Node(passed, failed)
        return found

    def swap(self, level: int) -> None:
        """Exchange a level with the next. Nodes of the level stay the same nodes, so those above them stand."""
        upper = list(self.levels[level].values())
        self.levels[level], self.levels[level + 1] = {}, {}
        for node in upper:
            passed, failed = node.passed, node.failed
            corners = [(n.passed, n.failed) if n else (None, None) for n in (passed, failed)]
            (pp, pf), (fp, ff) = corners
            node.passed, node.failed = self._node(level + 1, pp, fp), self._node(level + 1, pf, ff)
            self.levels[level][node.passed, node.failed] = node
        self.order[level:level + 2] = self.order[level + 1], self.order[level]

    def steps(self) -> list[tuple[tuple[int, ...], tuple[int, ...]]]:
        """Along the path that passes everything: what each step keeps and what it removes."""
        out, node = [], self.root
        for _ in self.order:
            out.append((below(node.passed if node else None), below(node.failed if node else None)))
            node = node.passed if node else None
        return out


def plain_changes(n: int) -> Iterator[int]:
    """Places to swap with the next, one after the other, to run through all orders of ``n`` (the bell ringers' way)."""
    if n < 2:
        return
    down = True
    for inner in [*plain_changes(n - 1), None]:
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        if inner is not None:
            yield inner + 1 if down else inner
        down = not down


def audited(filters: str, counts: dict[int, tuple[int, ...]]) -> list[tuple]:
    """All orders and steps of one part, from its counts by mask."""
    diagram = Diagram(filters, counts)
    orders = {"".join(diagram.order): diagram.steps()}
    for place in plain_changes(len(filters)):
        diagram.swap(place)
        orders["".join(diagram.order)] = diagram.steps()
    removed = {(order, f): step[1][0] for order, steps in orders.items() for f, step in zip(order, steps)}
    shapley = {f: sum(removed[order, f] for order in orders) for f in filters}
    failing = {order[0]: removed[order, order[0]] for order in orders}
    alone = {order[-1]: removed[order, order[-1]] for order in orders}
    return [(order, step, kept[0], gone[0], failing[f] - gone[0], alone[f], gone[1], gone[2], shapley[f])
            for order, steps in orders.items() for step, (f, (kept, gone)) in enumerate(zip(order, steps), 1)]


def audit(masks: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Every order and step of every part, from rows ``part``, ``mask``, ``good``, ``toxic``; at most 8 filters."""
    if len(filters) > 8:
        raise ValueError("the orders of more than 8 filters are too many to list")
    counted = masks.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("docs"), *(F.count_if(F.col(c)).alias(c) for c in COUNTS[1:]))
    # at most one entry for each mask
    parts = counted.groupBy("part").agg(F.collect_list(F.struct("mask", *COUNTS)).alias("counts"))

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                rows = audited(filters, {c["mask"]: tuple(c[k] for k in COUNTS) for c in row["counts"]})
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * len(rows)), *(pa.array(column, pa.string() if i == 0 else pa.int32() if i == 1 else pa.int64())
                                                            for i, column in enumerate(zip(*rows)))],
                    names=[c.split()[0] for c in STEP.split(", ")])

    return in_batches(parts, run, STEP)


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit(failure_masks(documents(spark, folder), table(spark, folder, "labels")))
