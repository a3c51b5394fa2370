"""One-time delivery of queued messages to waiting requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from millrace.operators.ordered import DAY_US, Shifted, order_within


def first_message_within(
    requests: DataFrame,
    messages: DataFrame,
    keys: Sequence[str],
    timeout_us: int,
    *,
    at: str = "at_us",
    id_col: str = "id",
    width: int = DAY_US,
) -> DataFrame:
    """Message each request receives, or null when none comes within the timeout.

    Per key the requests are served in order. Each takes the oldest message not yet taken, whether
    sent before the request or up to ``timeout_us`` after it, and a message is delivered once.

    Request and message pairs are never formed. With M(k) messages sent by the deadline of the
    k-th request, the number delivered after it is c(k) = min(c(k-1) + 1, M(k)), which unrolls to
    k + min(0, least of M(j) - j for j <= k): three running values over one ordered union. The
    k-th request and message number c(k) then meet in a grouping with at most two rows per group.

    A request without a time has no deadline and gets no message; a message without one is in time for none.
    Repeated requests each count.
    """
    timeless = requests.where(F.col(at).isNull()).select(*keys, F.col(id_col).alias("request_id"), F.col(at).alias("request_at"))
    requests, messages = (f.where(F.col(at).isNotNull()) for f in (requests, messages))
    events = messages.select(
        *keys, F.col(at).alias("_t"), F.lit(0).alias("_kind"), F.col(id_col).alias("_id"),
        F.col(at).alias("_at"),
    ).unionByName(
        requests.select(
            *keys, (F.col(at) + timeout_us).alias("_t"), F.lit(1).alias("_kind"),
            F.col(id_col).alias("_id"), F.col(at).alias("_at"),
        )
    ).withColumns({"_is_msg": 1 - F.col("_kind"), "_is_req": F.col("_kind")})

    is_request = F.col("_kind") == 1
    spare = F.when(is_request, F.col("_msgs") - F.col("_reqs"))
    rows = order_within(events, keys, ("_t", "_kind", "_id"), width).scan(
        sums={"_msgs": "_is_msg", "_reqs": "_is_req"},
        shifted={"_low": Shifted("min_before", spare, {"_msgs": 1, "_reqs": -1})},
    )
    # requests that went without so far, as a number <= 0; one more does if M(k) - k is below it
    missed = F.least(F.lit(0), F.coalesce("_low", F.lit(0)))
    served = is_request & (spare >= missed)
    seq = F.when(~is_request, F.col("_msgs")).when(served, F.col("_reqs") + missed)
    unserved = F.when(is_request & ~served, F.col("_reqs"))

    placed = rows.result().select(
        *keys, seq.alias("_seq"), unserved.alias("_unserved"), "_kind", "_id", "_at"
    )
    met = placed.groupBy(*keys, "_seq", "_unserved").agg(
        F.max(F.when(is_request, F.col("_id"))).alias("request_id"),
        F.max(F.when(is_request, F.col("_at"))).alias("request_at"),
        F.max(F.when(~is_request, F.col("_id"))).alias("message_id"),
        F.max(F.when(~is_request, F.col("_at"))).alias("message_at"),
        F.max("_kind").alias("_asked"),
    )
    answers = met.where(F.col("_asked") == 1).select(*keys, "request_id", "request_at", "message_id", "message_at")
    return answers.unionByName(timeless, allowMissingColumns=True)
