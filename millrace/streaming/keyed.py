"""Keyed streams: latest value, counters, ticks, duplicates, history and per-key order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from millrace.operators.quality import mark_known

WATERMARK = "1 hour"


def latest_value(stream: DataFrame, keys: Sequence[str], value: str, seq: str) -> DataFrame:
    """Newest value per key so far; for update mode."""
    return stream.groupBy(*keys).agg(F.max_by(value, seq).alias(value), F.max(seq).alias(seq))


def key_counter(stream: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Messages per key; the counts live in the checkpoint and survive a restart."""
    return stream.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def tick_counts(
    stream: DataFrame, at: str, every: str = "5 seconds", by: Sequence[str] = (),
    delay: str = WATERMARK,
) -> DataFrame:
    """Rows per tumbling window; rows later than the delay are dropped and counted by Spark.

    A row is late when its window ended before the watermark of the preceding micro-batch.
    """
    counted = stream.withWatermark(at, delay).groupBy(F.window(at, every), *by).agg(
        F.count(F.lit(1)).alias("n")
    )
    return counted.select(F.col("window.start").alias("tick"), *by, "n")


def first_deliveries(
    stream: DataFrame, at: str, ids: Sequence[str], delay: str = WATERMARK, salts: int = 1
) -> DataFrame:
    """The first row per id; copies that arrive within the delay are dropped.

    A repeated id is refused while the earlier one is remembered, which is for at least the delay,
    not for as long as the earlier run is active.

    An id with very many copies would send them all to one task. With ``salts`` above 1 they are first thinned out
    in that many groups, by the input partition they come from, and what is left, at most one copy per group,
    meets in the second step; that costs a second shuffle and state for every id.
    """
    rows = stream.withWatermark(at, delay)
    if salts > 1:
        rows = rows.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        rows = rows.dropDuplicatesWithinWatermark([*ids, "_salt"]).drop("_salt")
    return rows.dropDuplicatesWithinWatermark(list(ids))


def history(log: DataFrame, key: str, seq: str, type_col: str, closing: str) -> DataFrame:
    """Everything written so far in order per key, and whether the key's stream is closed."""
    closed = log.where(F.col(type_col) == closing).select(key)
    return mark_known(log, key, closed, key, "closed").orderBy(key, seq)


def partition_ordered(
    df: DataFrame, keys: Sequence[str], seq: str, partitions: int | None = None
) -> DataFrame:
    """Rows laid out so that each key's rows follow one another in order, keys side by side.

    Ranges over (key, seq) keep the order within a partition and from one partition to the next,
    and a key with very many rows fills several neighbouring partitions instead of one.
    """
    by = [*keys, seq]
    ranged = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    return ranged.sortWithinPartitions(*by)
