"""Removing the duplicates that at-least-once loading leaves behind."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions.hashing import content_hash

#: Kinds of columns that cannot be sorted by.
UNORDERED = ("map<", "variant")


def newest_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> list[Column]:
    """Descending order on ``order``, then on every other column so that no tie is left open."""
    rest = [
        name for name, kind in df.dtypes
        if name not in keys and name not in order and not any(u in kind for u in UNORDERED)
    ]
    return [F.col(c).desc() for c in [*order, *rest]]


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key.

    ``row_number() = 1`` lets Spark keep one row per key and input partition before the shuffle,
    so a key with very many copies reaches its task as a handful of rows.
    """
    window = Window.partitionBy(*keys).orderBy(*newest_first(df, keys, order))
    return df.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") == 1).drop("_rn")


def unique_count(
    df: DataFrame, keys: Sequence[str], by: Sequence[str] = (), approximate: bool = False
) -> DataFrame:
    """Rows left after :func:`dedup_latest`, counted without sorting."""
    record = F.struct(*keys)
    if approximate:
        count = F.approx_count_distinct(F.xxhash64(*keys))
    else:
        count = F.count_distinct(record)
    return df.groupBy(*by).agg(count.alias("unique_count"))


def duplicate_count(df: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Total rows, unique keys and the difference.

    Rows are counted per key first, with map-side combine, so no count holds a set of keys.
    """
    per_key = df.groupBy(*by, *[F.col(k) for k in keys if k not in by]).agg(
        F.count(F.lit(1)).alias("_n")
    )
    return per_key.groupBy(*by).agg(
        F.sum("_n").alias("total_count"),
        F.count(F.lit(1)).alias("unique_count"),
        (F.sum("_n") - F.count(F.lit(1))).alias("duplicate_count"),
    )


def content_hash_dedup(df: DataFrame, id_col: str, *content: str) -> DataFrame:
    """Smallest id per content hash, with the number of copies."""
    return df.groupBy(content_hash(*content).alias("content_hash")).agg(
        F.min(id_col).alias(id_col), F.count(F.lit(1)).alias("copies")
    )


def latest_run(df: DataFrame, run: str, at: str) -> DataFrame:
    """The run with the newest timestamp; ties go to the larger run id."""
    return df.agg(
        F.max_by(run, F.struct(at, run)).alias(run), F.max(at).alias(at)
    )
