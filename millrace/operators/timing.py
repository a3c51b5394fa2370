"""Job and call logs: gaps, schedules, limits, concurrency, attempts, durations.

Times are whole microseconds. Everything that depends on the order of rows within a key goes
through :mod:`millrace.operators.ordered`, so one busy key does not end up in one task; ``width`` is how
much time (or how many numbers) of a key one task takes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.ordered import DAY_US, Shifted, order_within


def call_gaps(
    df: DataFrame, keys: Sequence[str], at: str, tie: str, width: int = DAY_US
) -> DataFrame:
    """Gap to the key's previous call and time since its first call."""
    calls = order_within(df, keys, (at, tie), width).scan(lag={"_prev": at}, lows={"_start": at})
    return calls.with_columns(
        {"gap_us": F.col(at) - F.col("_prev"), "elapsed_us": F.col(at) - F.col("_start")}
    ).result().drop("_prev", "_start")


def running_count_before(
    df: DataFrame, keys: Sequence[str], at: str, tie: str, width: int = DAY_US
) -> DataFrame:
    """Messages of the key seen before this one."""
    seen = order_within(df, keys, (at, tie), width).scan(number="_n")
    return seen.result().withColumn("count_before", F.col("_n") - 1).drop("_n")


def spacing_schedule(
    df: DataFrame, keys: Sequence[str], at: str, tie: str, interval_us: int,
    width: int = DAY_US,
) -> DataFrame:
    """Start of call k when slots are fixed from the first call on.

    Slots that pass while no call arrives are not lost, so calls after a pause catch up in a burst.
    """
    calls = order_within(df, keys, (at, tie), width).scan(number="_n", lows={"_start": at})
    slot = F.col("_start") + (F.col("_n") - 1) * interval_us
    return calls.result().withColumn("start_us", F.greatest(at, slot)).drop("_n", "_start")


def spacing_strict(
    df: DataFrame, keys: Sequence[str], at: str, tie: str, interval_us: int,
    width: int = DAY_US,
) -> DataFrame:
    """Start of call k when consecutive starts are never closer than the interval.

    start(k) = max(at(k), start(k-1) + d) unrolls to k d + max over j <= k of (at(j) - j d).
    """
    slack = F.col(at) - F.col("_n") * interval_us
    calls = order_within(df, keys, (at, tie), width).scan(
        number="_n", shifted={"_most": Shifted("max", slack, {"_n": -interval_us})})
    start = F.col("_n") * interval_us + F.col("_most")
    return calls.result().withColumn("start_us", start).drop("_n", "_most")


def _levels(
    df: DataFrame, edges: Column, keys: Sequence[str], sums: dict[str, Column], width: int
) -> DataFrame:
    """Running total of ``delta`` per key, one row per instant ``at``.

    ``edges`` is an array of structs with ``at`` and ``delta``; one without a time is left out. Changes of one
    instant are added up before the shuffle, so equal timestamps cost nothing.
    """
    timed = F.filter(edges, lambda e: e["at"].isNotNull())
    instants = df.select(*keys, F.inline(timed)).groupBy(*keys, "at").agg(
        F.sum("delta").alias("_delta"), *[c.alias(n) for n, c in sums.items()]
    )
    ordered = order_within(instants, keys, ("at",), width)
    return ordered.scan(sums={"level": "_delta"}).result()


def rate_limit_compliance(
    df: DataFrame, keys: Sequence[str], at: str, limit: int | str, period_us: int | str,
    width: int = DAY_US,
) -> DataFrame:
    """Starts in the trailing period at every instant with starts, flagged above the limit.

    ``limit`` and ``period_us`` are numbers, or columns fixed per key. A start counts for the
    half-open period [t, t + period): it adds one at t and takes it away at t + period, which
    needs one pass however many starts fall in a period.
    """
    names = [*keys, *[c for c in (limit, period_us) if isinstance(c, str)]]
    period = F.col(period_us) if isinstance(period_us, str) else F.lit(period_us)
    limit_col = F.col(limit) if isinstance(limit, str) else F.lit(limit)
    edges = F.array(
        F.struct(F.col(at).alias("at"), F.lit(1).alias("delta")),
        F.struct((F.col(at) + period).alias("at"), F.lit(-1).alias("delta")),
    )
    levels = _levels(df, edges, names, {"starts": F.count_if(F.col("delta") > 0)}, width)
    return levels.where(F.col("starts") > 0).select(
        *names, F.col("at").alias(at), "starts", F.col("level").alias("in_period"),
        (F.col("level") > limit_col).alias("over_limit"),
    )


def peak_concurrency(
    df: DataFrame, keys: Sequence[str], start: str, end: str, limit: int | None = None,
    width: int = DAY_US,
) -> DataFrame:
    """Highest number of jobs running at once per key; a job runs in [start, end).

    A job without an end still runs; one without a start has not begun and does not count.
    """
    df = df.where(F.col(start).isNotNull())
    edges = F.array(
        F.struct(F.col(start).alias("at"), F.lit(1).alias("delta")),
        F.struct(F.col(end).alias("at"), F.lit(-1).alias("delta")),
    )
    levels = _levels(df, edges, keys, {}, width)
    peaks = levels.groupBy(*keys).agg(F.max("level").alias("peak"))
    if limit is None:
        return peaks
    return peaks.withColumn("over_limit", F.col("peak") > limit)


def attempts_exhausted(
    df: DataFrame, keys: Sequence[str], at: str, tie: str, *, max_attempts: int,
    interval_ms: int, backoff_rate: int, width: int = DAY_US,
) -> DataFrame:
    """Attempt number of each failure, the wait before its retry, and whether retries ran out."""
    failures = order_within(df, keys, (at, tie), width).scan(number="attempt").result()
    attempt = F.col("attempt")
    wait = F.round(interval_ms * F.pow(F.lit(backoff_rate), attempt - 1)).cast("bigint")
    return failures.withColumns({
        "backoff_ms": F.when(attempt < max_attempts, wait),
        "exhausted": attempt >= max_attempts,
    })


def with_fallback(df: DataFrame, value: str, exhausted: str, fallback: Column) -> DataFrame:
    """Value of a step, or the fallback where its attempts ran out."""
    return df.withColumn(value, F.when(F.col(exhausted), fallback).otherwise(F.col(value)))


def completion_order(
    df: DataFrame, keys: Sequence[str], finished: str, tie: str, width: int = DAY_US
) -> DataFrame:
    """Position of each result in the order of finish within its run; null while it is unfinished."""
    done = df.withColumn("_done", F.col(finished).isNotNull().cast("bigint"))
    ranked = order_within(done, keys, (finished, tie), width).scan(sums={"finish_rank": "_done"}).result()
    return ranked.withColumn("finish_rank", F.when(F.col(finished).isNotNull(), F.col("finish_rank"))).drop("_done")


def chunk_assign(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: int = 100, batch: int = 10,
    width: int = 1_000_000,
) -> DataFrame:
    """Chunk of each row per tenant and sub-batch within the chunk, from 0; no row is left out."""
    rows = order_within(df, keys, order, width).scan(number="_n").result()
    place = F.col("_n") - 1
    return rows.withColumns({
        "chunk_no": F.floor(place / chunk),
        "batch_no": F.floor((place % chunk) / batch),
    }).drop("_n")


def page_number(batch: Column, index: Column, size: int) -> Column:
    """Page of the index-th (from 0) fetch in a batch; batches count from 1."""
    return (batch - 1) * size + index + 1


def duration_summary(
    df: DataFrame, keys: Sequence[str], duration: str, start: str, end: str
) -> DataFrame:
    """Work done, wall clock and their ratio (the speed-up of running side by side)."""
    sums = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum(duration).alias("total_duration"),
        (F.max(end) - F.min(start)).alias("wall_clock"),
    )
    ratio = F.try_divide(F.col("total_duration"), F.col("wall_clock"))
    return sums.withColumn("ratio", F.round(ratio, 6))


def payload_size_profile(df: DataFrame, size: str) -> DataFrame:
    """Rows, total and mean size per power of ten of the size."""
    by_class = (F.length(F.col(size).cast("string")) - 1).cast("bigint").alias("size_class")
    return df.groupBy(by_class).agg(
        F.count(F.lit(1)).alias("payloads"),
        F.sum(size).alias("total_size"),
        F.round(F.avg(size), 6).alias("mean_size"),
    )
