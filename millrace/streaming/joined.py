"""Replies to requests as an outer join of two streams, for messages that have one receiver.

Where at most one request of a key is open at a time, its first message within the timeout needs no queue: requests and
messages are joined by key and time range. Both streams have a watermark, so Spark drops a request when its timeout has
passed, with an answer of nulls if nothing came, and a message when no request from before it can still arrive.
Messages for several requests of a key, to be delivered once each, are the work of :mod:`millrace.streaming.timers`.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

REPLY = ("request_id", "request_at", "message_id", "message_at")


def replies(
    requests: DataFrame, messages: DataFrame, keys: Sequence[str], timeout_us: int, delay: str, messages_delay: str | None = None
) -> DataFrame:
    """Pairs of a request and a message of its key sent from its time on, up to ``timeout_us`` later; nulls if none was.

    Both are streams of (keys, id, at_us) rows; ``delay`` and ``messages_delay`` are how late they may come (times up to
    1970 are late for Spark from the start). Null is a key like any other. For append mode; :func:`first_replies` takes
    the first message of each.
    """
    asked = requests.select(
        *keys, F.col("id").alias("request_id"), F.col("at_us").alias("request_at"), F.timestamp_micros("at_us").alias("_asked")
    ).withWatermark("_asked", delay)
    sent = messages.select(
        *(F.col(k).alias(f"_to_{k}") for k in keys), F.col("id").alias("message_id"), F.col("at_us").alias("message_at"),
        F.timestamp_micros("at_us").alias("_sent"),
    ).withWatermark("_sent", messages_delay or delay)
    wait = F.expr(f"INTERVAL '{timeout_us // 1_000_000}.{timeout_us % 1_000_000:06d}' SECOND")
    same_key = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_to_{k}")) for k in keys))
    in_time = (F.col("_sent") >= F.col("_asked")) & (F.col("_sent") <= F.col("_asked") + wait)
    return asked.join(sent, same_key & in_time, "leftOuter").select(*keys, *REPLY)


def waiting(spark: SparkSession, checkpoint: str, keys: Sequence[str]) -> DataFrame:
    """Requests whose timeout has not passed, as the state of a checkpoint of :func:`replies` holds them."""
    state = spark.read.format("statestore").option("joinSide", "left").load(checkpoint)
    return state.select(*(f"value.{c}" for c in (*keys, *REPLY[:2])))


def first_replies(given: DataFrame, keys: Sequence[str], still_waiting: DataFrame | None = None) -> DataFrame:
    """The oldest message (the smaller id of equals) of each request among the pairs given so far.

    When the streams have ended and no more rows come, ``still_waiting`` are requests without one unless it is there.
    """
    if still_waiting is not None:
        given = given.unionByName(still_waiting, allowMissingColumns=True)
    message = F.when(F.col("message_at").isNotNull(), F.struct("message_at", "message_id"))
    first = given.groupBy(*keys, *REPLY[:2]).agg(F.min(message).alias("_first"))
    return first.select(*keys, *REPLY[:2], "_first.message_id", "_first.message_at")
