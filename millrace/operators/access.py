"""Access requests with the accesses they ask for and the users who ask."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from millrace.functions.values import iso_format
from millrace.operators.dedup import dedup_latest


def access_join(
    requests: DataFrame, accesses: DataFrame, users: DataFrame, user_id=None
) -> DataFrame:
    """Requests in the shape the API returns, optionally of one user, newest first.

    No join strategy is forced: dimensions that fit are broadcast by their measured size, larger
    ones are shuffled, and a user with very many requests is split by the adaptive skew join. No user,
    or an empty name, asks for the requests of all.
    """
    if user_id is not None and user_id != "":
        requests = requests.where(F.col("user_id") == user_id)
    r, a, u = requests.alias("r"), accesses.alias("a"), users.alias("u")
    return (
        r.join(a, F.col("r.access_id") == F.col("a.id"))
        .join(u, F.col("r.user_id") == F.col("u.id"))
        .orderBy(F.col("r.created_at").desc(), F.col("r.id"))
        .select(
            F.col("r.id").alias("access_request_id"),
            iso_format("r.created_at").alias("access_request_created_at"),
            F.col("r.status").alias("access_request_status"),
            F.col("a.id").alias("access_id"),
            F.col("a.description").alias("access_description"),
            F.col("u.id").alias("user_id"),
            F.col("u.name").alias("user_name"),
        )
    )


def point_update(
    df: DataFrame, updates: DataFrame, key: str, column: str = "status"
) -> DataFrame:
    """``df`` with the column replaced where ``updates`` holds a value for the key.

    ``updates`` has at most one row per key.
    """
    new = updates.select(F.col(key).alias("_key"), F.col(column).alias("_value"))
    joined = df.join(new, df[key] == new["_key"], "left")
    return joined.withColumn(column, F.coalesce("_value", column)).drop("_key", "_value")


def current_requests(
    requests: DataFrame, changes: DataFrame, key: str = "id", newest: Sequence[str] = ("changed_at",)
) -> DataFrame:
    """Requests with the newest status of an append-only log of status changes."""
    return point_update(requests, dedup_latest(changes, [key], newest), key)
