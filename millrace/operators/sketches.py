"""Unique counts over any set of runs without reading their rows again: one small sketch a run and tenant, merged when asked."""

from __future__ import annotations

from collections.abc import Sequence
from math import sqrt

from pyspark.sql import Column, DataFrame, functions as F

#: Sketches have 2^PRECISION registers, of about half a byte each.
PRECISION = 14


def key_sketches(df: DataFrame, keys: Sequence[str], by: Sequence[str], precision: int = PRECISION) -> DataFrame:
    """One row a group: ``row_count`` and a ``sketch`` of its different keys. Null is a value like others.

    Groups combine on the map side, so a group with most of the rows reaches its task as one sketch a partition.
    Store the rows; a repeated run replaces its own.
    """
    key = F.xxhash64(*[c for k in keys for c in (F.col(k).isNull(), F.col(k))])
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"), F.hll_sketch_agg(key, precision).alias("sketch"))


def merged_counts(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Total rows, unique keys and duplicates of the stored groups, put together by ``by``; the last two are estimates.

    A key that occurs in several groups counts once. Sketches of different precision are merged at the lower one.
    """
    unique = F.hll_sketch_estimate(F.hll_union_agg("sketch", F.lit(True)))
    merged = sketches.groupBy(*by).agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_count"), unique.alias("unique_count"))
    counted = F.coalesce("unique_count", F.lit(0))
    return merged.select(*by, "total_count", counted.alias("unique_count"),
                         F.greatest(F.col("total_count") - counted, F.lit(0)).alias("duplicate_count"))


def relative_error(precision: int = PRECISION, deviations: float = 3.0) -> float:
    """Share by which a merged count may be off, at so many standard deviations."""
    return deviations * 1.04 / sqrt(1 << precision)


def within_error(estimate: Column, exact: Column, precision: int = PRECISION, deviations: float = 3.0) -> Column:
    return F.abs(estimate - exact) <= exact * relative_error(precision, deviations)
