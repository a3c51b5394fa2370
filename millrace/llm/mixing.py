"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

Every source gets a share of the budget by its weight; a source that would be repeated more often than the
given number of epochs is clamped there, and the excess goes to the others by weight until none is above.
A source of target t and size s then takes every document floor(t / s) times, and the documents up to one
place of a seeded order once more, the place chosen so that the words taken come nearest to t. Sources are a
table like any other: ranks, shares and places are worked out by joins and windows within a source and cell.

Defined results: a null text has no words and size 0; a document of size 0 is taken whole times only if its
source is. Rows without a source form a source of their own, last in order. A repeated row counts each time;
fully equal rows share one place in the seeded order. An empty table gives an empty result. A budget that
exceeds what all sources can give is cut to that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from millrace.llm.tables import boxed, documents, saved

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
EPOCHS = 3
SEED = 20240611
#: Cells of the seeded order that a source's sizes are added up by, as bits.
CELL_BITS = 12
#: Parts that the sorted list of sources is ranked in.
RANK_PARTS = 16


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def seeded_place(seed: int, *columns: Column) -> Column:
    """A place from 0 to 2^62 that depends on the seed and the row alone."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 2)


def ranked(sources: DataFrame, column: str = "source") -> DataFrame:
    """Adds ``rank`` from 0 in code point order, null last, by ranges: counts of the ranges, then within each."""
    parts = saved(sources.repartitionByRange(RANK_PARTS, F.col(column).asc_nulls_last())
                  .withColumn("part", F.spark_partition_id()), "sources")
    counts = {r["part"]: r["count"] for r in parts.groupBy("part").count().collect()}
    start, before = 0, F.lit(0)
    for part in sorted(counts):
        before = F.when(F.col("part") == part, F.lit(start)).otherwise(before)
        start += counts[part]
    own = Window.partitionBy("part").orderBy(F.col(column).asc_nulls_last())
    return parts.withColumn("rank", (before + F.row_number().over(own) - 1).cast("long")).drop("part")


def cycled_weights(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Adds ``weight``: the given weights in turn, by the order of the sources."""
    values = F.array(*(F.lit(float(w)) for w in weights))
    return ranked(sources).withColumn("weight", F.element_at(values, (F.col("rank") % len(weights) + 1).cast("int")))


def water_filled(sources: DataFrame, epochs: float = EPOCHS, budget: float | None = None) -> DataFrame:
    """Adds ``target`` to sources with ``source_size`` and ``weight``.

    Each pass clamps all sources that the present level (words per weight) lifts above their cap and raises the
    level for the rest; it ends when a pass clamps none, at the latest when all are. One row of sums comes to
    the driver for each pass.
    """
    cap = F.col("source_size") * float(epochs)
    size = sources.agg(F.sum("source_size").alias("s")).first()["s"] or 0
    budget = min(float(size if budget is None else budget), float(size) * epochs)
    clamped, level = -1, 0.0
    above = F.lit(False)
    while True:
        at = sources.agg(
            F.count(F.when(above, 1)).alias("n"),
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0.0)).alias("held"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)).alias("weight")).first()
        if at["n"] == clamped or at["weight"] <= 0:
            break
        clamped, level = at["n"], max(0.0, budget - at["held"]) / at["weight"]
        above = F.col("weight") * F.lit(level) > cap
    return sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))


def places(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Adds ``whole`` and ``cut`` to the sources: rows of place up to ``cut`` are taken once more.

    ``rows`` has ``source``, ``size`` and ``place``. Sizes are added up per source and cell of the order;
    rows are sorted only in the one cell of each source that the cut lies in.
    """
    cell = F.shiftright("place", 62 - CELL_BITS)
    sources = sources.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                                 .otherwise(0).cast("long"))
    sources = sources.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    sums = rows.groupBy("source", cell.alias("cell")).agg(F.sum("size").alias("size"))
    upto = Window.partitionBy("source").orderBy("cell")
    sums = sums.withColumn("upto", F.sum("size").over(upto))
    same = lambda a, b: F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))
    hit = (sums.alias("c").join(sources.alias("s"), same("c", "s"))
           .where((F.col("upto") - F.col("size") <= F.col("rest")) & (F.col("rest") < F.col("upto")))
           .select("s.source", "cell", "rest", (F.col("upto") - F.col("size")).alias("before")))
    inside = (rows.withColumn("cell", cell).alias("r")
              .join(hit.alias("h"), same("r", "h") & (F.col("r.cell") == F.col("h.cell")))
              .groupBy("h.source", "rest", "before", "place").agg(F.sum("r.size").alias("size")))
    running = Window.partitionBy("source").orderBy("place")
    inside = (inside.withColumn("upto", F.col("before") + F.sum("size").over(running))
              # the row that crosses the target is taken if that comes nearer to it
              .where((F.col("upto") <= F.col("rest"))
                     | ((F.col("upto") - F.col("size") <= F.col("rest"))
                        & (F.col("upto") - F.col("rest") <= F.col("rest") - F.col("upto") + F.col("size")))))
    last = inside.groupBy("source").agg(F.max("place").alias("last"))
    first = hit.select("source", (F.shiftleft(F.col("cell"), 62 - CELL_BITS) - 1).alias("floor"))
    return (sources.alias("s").join(first.alias("f"), same("s", "f"), "left")
            .join(last.alias("l"), same("s", "l"), "left")
            .select("s.*", F.coalesce("last", "floor", F.lit(-1)).alias("cut")))


def plan(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: float = EPOCHS) -> DataFrame:
    """One row for each source: size, weight, target, whole repetitions, and the cut for one more."""
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    return saved(places(rows, water_filled(cycled_weights(sources, weights), epochs)), "mix")


def times(place: Column) -> Column:
    return F.col("whole") + (place <= F.col("cut")).cast("long")


def measured(docs: DataFrame, seed: int = SEED) -> DataFrame:
    text = F.col("text")
    return docs.select("doc_id", "source", word_count(text).alias("size"),
                       seeded_place(seed, F.col("doc_id"), text).alias("place"))


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: float = EPOCHS,
                  seed: int = SEED) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    mix = plan(saved(measured(docs, seed), "measured"), weights, epochs).select("source", "whole", "cut")
    rows = boxed(docs, place=seeded_place(seed, F.col("doc_id"), F.col("text")), from_source=F.col("source"))
    # Spark sends the sources to all executors if they are small, else it joins by shuffle and splits hot ones
    taken = rows.join(mix, rows["from_source"].eqNullSafe(mix["source"])).withColumn("times", times(F.col("place")))
    return (taken.where("times > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
            .select("row.*"))


def op4_mix_waterfill(spark: SparkSession, folder: str) -> DataFrame:
    rows = saved(measured(documents(spark, folder)), "measured")
    mix = plan(rows)
    return (rows.alias("r").join(mix.alias("m"), F.col("r.source").eqNullSafe(F.col("m.source")))
            .select("r.doc_id", "r.size", "m.source_size", "m.target",
                    (F.col("r.size") * times(F.col("r.place"))).alias("taken")))
