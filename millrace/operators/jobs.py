"""Reports on job, queue and tenant tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.values import (
    parameter_key, parameter_type, parameter_value, root_id, run_depth,
)


def where_given(df: DataFrame, **equal) -> DataFrame:
    """Equality filters; a missing argument or empty text filters nothing, 0 and False do."""
    conditions = [F.col(name) == value for name, value in equal.items() if value is not None and value != ""]
    return df.where(reduce(Column.__and__, conditions)) if conditions else df


def tenant_count(df: DataFrame, by: Sequence[str] = (), **equal) -> DataFrame:
    """Number of rows, per group if asked, after optional filters."""
    return where_given(df, **equal).groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"))


def status_filter(
    df: DataFrame, statuses: Sequence[str] | None = None, limit: int | None = None,
    order: Sequence[Column] = (), status_col: str = "status", **equal,
) -> DataFrame:
    """Runs by status list and exact fields, optionally the first ones in an order."""
    rows = where_given(df, **equal)
    if statuses:
        rows = rows.where(F.col(status_col).isin(*statuses))
    if order:
        rows = rows.orderBy(*order)
    return rows if limit is None else rows.limit(limit)


def queue_status_counts(
    df: DataFrame, by: Sequence[str], id_col: str, created: str
) -> DataFrame:
    """Runs per group and the id of the one created first."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("runs"),
        F.min_by(id_col, F.struct(created, id_col)).alias("first_id"),
    )


def top_recent(df: DataFrame, at: str, tie: str, k: int) -> DataFrame:
    """The k newest rows."""
    return df.orderBy(F.col(at).desc(), F.col(tie)).limit(k)


def sort_by(df: DataFrame, column: str, tie: str, ascending: bool = True) -> DataFrame:
    """Rows by the chosen column in the chosen direction."""
    key = F.col(column).asc() if ascending else F.col(column).desc()
    return df.orderBy(key, F.col(tie))


def count_by(df: DataFrame, *by: str, name: str = "n") -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def run_summary(df: DataFrame, by: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """One row per group, one per prefix of the grouping and a grand total.

    Rows are added up per finest group before the roll-up repeats them for every level.
    ``level`` is 0 for the finest groups and grows with the number of columns rolled up.
    """
    finest = df.groupBy(*by).agg(*[c.alias(n) for n, c in sums.items()])
    rolled = finest.rollup(*by).agg(
        F.grouping_id().alias("_grouping"), *[F.sum(n).alias(n) for n in sums]
    )
    return rolled.withColumn("level", F.bit_count("_grouping")).drop("_grouping")


def root_run_rollup(df: DataFrame, run: str, amount: str) -> DataFrame:
    """Child runs added up to their root run."""
    return df.groupBy(root_id(run).alias("root_id")).agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum(amount).alias("total"),
        F.max(run_depth(run)).alias("max_depth"),
    )


def list_totals(items: Column) -> Column:
    """Size and sum of a list of numbers; an empty list has sum 0."""
    zero = F.lit(0).cast("bigint")
    return F.struct(
        F.size(items).cast("bigint").alias("size"),
        F.aggregate(items, zero, lambda acc, x: acc + x.cast("bigint")).alias("total"),
    )


def nested_list_totals(df: DataFrame, nested: str) -> DataFrame:
    """Inner lists, elements and total of a list of number lists held in one row.

    Lists that would have to be collected from rows are added up with ``groupBy`` instead.
    """
    outer = F.col(nested)
    totals = list_totals(F.flatten(outer))
    return df.withColumns({
        "lists": F.size(outer).cast("bigint"),
        "elements": totals["size"],
        "total": totals["total"],
    })


def parse_parameters(df: DataFrame, text: str) -> DataFrame:
    """``key=value`` text as columns ``key``, ``value`` and ``type``."""
    parsed = df.withColumns({"key": parameter_key(text), "value": parameter_value(text)})
    return parsed.withColumn("type", parameter_type("value"))


def parameter_profile(df: DataFrame, text: str) -> DataFrame:
    """Values per key and inferred type of ``key=value`` text.

    Equal texts are counted first, so a value is looked at once however often it occurs.
    """
    texts = df.groupBy(text).agg(F.count(F.lit(1)).alias("_n"))
    return parse_parameters(texts, text).groupBy("key", "type").agg(
        F.sum("_n").alias("n"), F.count_distinct("value").alias("distinct_values")
    )
