"""Checks that split a table into good rows and rows for the error table.

Every check comes in two forms: ``*_check`` adds a ``message`` that is null for good rows, in one
pass; ``*_split`` returns good and bad rows as two frames.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F


def _split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    message = F.col("message")
    return checked.where(message.isNull()).drop("message"), checked.where(message.isNotNull())


def mark_known(df: DataFrame, key: str, known: DataFrame, known_key: str, out: str) -> DataFrame:
    """Flag rows whose key exists among the known ones.

    The known keys are unique after ``distinct``, so a key that fills much of ``df`` only skews
    the left side, which adaptive execution splits.
    """
    ref = known.select(F.col(known_key).alias("_known")).where("_known is not null").distinct()
    joined = df.join(ref, df[key] == ref["_known"], "left")
    return joined.withColumn(out, F.col("_known").isNotNull()).drop("_known")


def fk_check(df: DataFrame, key: str, known: DataFrame, known_key: str) -> DataFrame:
    """An error message where the foreign key does not exist."""
    text = F.format_string(f"{key} %s does not exist", F.col(key).cast("string"))
    marked = mark_known(df, key, known, known_key, "_ok")
    return marked.withColumn("message", F.when(~F.col("_ok"), text)).drop("_ok")


def fk_split(
    df: DataFrame, key: str, known: DataFrame, known_key: str
) -> tuple[DataFrame, DataFrame]:
    """Rows whose foreign key exists, and the others with an error message."""
    return _split(fk_check(df, key, known, known_key))


def unique_violation(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def insert_if_absent(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The new rows whose key is not taken yet."""
    return new.join(existing.select(*keys), list(keys), "left_anti")


def enum_check(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """An error message where the value is not an allowed one; null is not allowed."""
    shown = F.coalesce(F.col(column), F.lit("null"))
    text = F.format_string(f"invalid {column}: %s", shown)
    ok = F.coalesce(F.col(column).isin(*allowed), F.lit(False))
    return df.withColumn("message", F.when(~ok, text))


def enum_split(df: DataFrame, column: str, allowed: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with an allowed value, and the others with an error message."""
    return _split(enum_check(df, column, allowed))


def dispatch_check(
    df: DataFrame, column: str, routes: dict[str, tuple[str, int, int]]
) -> DataFrame:
    """Route rows by type to (queue, limit, period in seconds); an unknown type is an error.

    The routes are part of the program, a handful of entries, so they travel as a literal map.
    """
    entries = []
    for kind, (queue, limit, period) in routes.items():
        target = F.struct(
            F.lit(queue).alias("queue_name"), F.lit(limit).alias("queue_limit"),
            F.lit(period).alias("queue_period"),
        )
        entries += [F.lit(kind), target]
    route = F.try_element_at(F.create_map(*entries), F.col(column))
    shown = F.coalesce(F.col(column), F.lit("null"))
    text = F.format_string("unknown type: %s", shown)
    routed = df.withColumn("_route", route)
    routed = routed.withColumn("message", F.when(F.col("_route").isNull(), text))
    return routed.select("*", "_route.*").drop("_route")


def dispatch_split(
    df: DataFrame, column: str, routes: dict[str, tuple[str, int, int]]
) -> tuple[DataFrame, DataFrame]:
    """Rows with their queue, and rows of unknown type with an error message."""
    good, bad = _split(dispatch_check(df, column, routes))
    return good, bad.drop("queue_name", "queue_limit", "queue_period")


def approval_gate(approved: Column) -> Column:
    """``completed`` when approved; a refusal or no answer cancels."""
    return F.when(F.coalesce(approved, F.lit(False)), "completed").otherwise("cancelled")


def transform_quarantine(
    df: DataFrame, column: str, fn: Callable[[str], str]
) -> tuple[DataFrame, DataFrame]:
    """Apply a Python function that may raise: results, and failed rows with their message.

    The function runs once per row inside Arrow batches; a failing row does not fail its task.
    Write the marked frame (:func:`transform_marked`) once when both halves are needed.
    """
    marked = transform_marked(df, column, fn)
    good = marked.where("_done.ok").withColumn("transformed", F.col("_done.value")).drop("_done")
    bad = marked.where("not _done.ok").withColumn("message", F.col("_done.error")).drop("_done")
    return good, bad


def transform_marked(df: DataFrame, column: str, fn: Callable[[str], str]) -> DataFrame:
    """``df`` with ``_done`` = struct(ok, value, error) of the function on the column."""

    @F.pandas_udf("ok boolean, value string, error string")
    def attempt(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        def one(x):
            try:
                return True, fn(x), None
            except Exception as exc:  # the function's own failure is data here
                return False, None, str(exc)

        for batch in batches:
            yield pd.DataFrame([one(x) for x in batch], columns=["ok", "value", "error"])

    return df.withColumn("_done", attempt(F.col(column)))
