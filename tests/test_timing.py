import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import timing as T

SIZES = [5, 170, 10**9]


@pytest.fixture(scope="module")
def log():
    rng = random.Random(11)
    calls = []
    for i in range(600):
        key = rng.choice(["a", "a", "a", "b", "c"])
        calls.append((key, rng.randrange(3000), i, rng.randrange(0, 200)))
    return calls


@pytest.fixture(scope="module")
def calls(spark, log):
    df = spark.createDataFrame(log, "k string, at bigint, id bigint, len bigint")
    return df.withColumn("end", F.col("at") + F.col("len")).repartition(3).cache()


def by_key(log):
    groups = {}
    for key, at, i, length in sorted(log, key=lambda r: (r[0], r[1], r[2])):
        groups.setdefault(key, []).append((at, i, length))
    return groups


@pytest.mark.parametrize("size", SIZES)
def test_gaps_and_counts(calls, log, rows, size):
    got = rows(T.call_gaps(calls, ["k"], "at", "id", size), "id", "gap_us", "elapsed_us")
    counts = rows(T.running_count_before(calls, ["k"], "at", "id", size), "id", "count_before")
    want, want_counts = [], []
    for group in by_key(log).values():
        for n, (at, i, _) in enumerate(group):
            want.append((i, at - group[n - 1][0] if n else None, at - group[0][0]))
            want_counts.append((i, n))
    assert got == sorted(want, key=repr) and counts == sorted(want_counts, key=repr)


@pytest.mark.parametrize("size", SIZES)
@pytest.mark.parametrize("gap", [1, 7, 40])
def test_schedules_equal_a_loop(calls, log, rows, size, gap):
    slots, strict = [], []
    for group in by_key(log).values():
        allowed = last = None
        for at, i, _ in group:
            # fixed slots: the next one moves on by the gap whether or not it was used in time
            start = at if allowed is None else max(at, allowed)
            allowed = (at if allowed is None else allowed) + gap
            slots.append((i, start))
            last = at if last is None else max(at, last + gap)
            strict.append((i, last))
    assert rows(T.spacing_schedule(calls, ["k"], "at", "id", gap, size), "id", "start_us") == sorted(slots, key=repr)
    assert rows(T.spacing_strict(calls, ["k"], "at", "id", gap, size), "id", "start_us") == sorted(strict, key=repr)


def test_two_calls_per_second(spark):
    five = spark.createDataFrame([("q", 0, i) for i in range(5)], "k string, at bigint, id bigint")
    starts = T.spacing_schedule(five, ["k"], "at", "id", 500_000).orderBy("id").collect()
    assert [r.start_us for r in starts] == [0, 500_000, 1_000_000, 1_500_000, 2_000_000]


def test_pause_then_burst(spark):
    rows = [("q", 0, 0), ("q", 0, 1), ("q", 3_000_000, 2), ("q", 3_000_000, 3)]
    df = spark.createDataFrame(rows, "k string, at bigint, id bigint")
    slots = {r.id: r.start_us for r in T.spacing_schedule(df, ["k"], "at", "id", 500_000).collect()}
    strict = {r.id: r.start_us for r in T.spacing_strict(df, ["k"], "at", "id", 500_000).collect()}
    assert slots[3] == 3_000_000 and strict[3] == 3_500_000


@pytest.mark.parametrize("size", SIZES)
def test_rate_limit(calls, log, rows, size):
    want = []
    for key, group in by_key(log).items():
        times = [at for at, _, _ in group]
        for at in sorted(set(times)):
            inside = sum(1 for t in times if at - 100 < t <= at)
            want.append((key, at, times.count(at), inside, inside > 12))
    got = T.rate_limit_compliance(calls, ["k"], "at", 12, 100, size)
    assert rows(got, "k", "at", "starts", "in_period", "over_limit") == sorted(want, key=repr)


def test_rate_limit_per_key_limits(spark, rows):
    df = spark.createDataFrame(
        [("u", t, 2, 1_000_000) for t in (0, 400_000, 900_000, 1_000_000)]
        + [("g", t, 2, 5_000_000) for t in (0, 4_999_999, 5_000_000)],
        "q string, at bigint, lim int, per bigint",
    )
    got = rows(T.rate_limit_compliance(df, ["q"], "at", "lim", "per"), "q", "at", "in_period", "over_limit")
    assert ("u", 900_000, 3, True) in got and ("u", 1_000_000, 3, True) in got
    assert ("g", 5_000_000, 2, False) in got


@pytest.mark.parametrize("size", SIZES)
def test_peak_concurrency(calls, log, rows, size):
    want = []
    for key, group in by_key(log).items():
        instants = {at for at, _, _ in group}
        peak = max(sum(1 for at, _, n in group if at <= t < at + n) for t in instants)
        want.append((key, peak))
    assert rows(T.peak_concurrency(calls, ["k"], "at", "end", width=size), "k", "peak") == sorted(want, key=repr)


@pytest.mark.parametrize("size", SIZES)
def test_chunks_lose_nothing(calls, log, size):
    out = T.chunk_assign(calls, ["k"], ["at", "id"], 100, 10, size).collect()
    assert len(out) == len(log)
    sizes = {}
    for r in out:
        sizes[(r.k, r.chunk_no, r.batch_no)] = sizes.get((r.k, r.chunk_no, r.batch_no), 0) + 1
    assert max(sizes.values()) <= 10 and {b for _, _, b in sizes} == set(range(10))
    assert sizes[("a", 0, 9)] == 10


def test_page_number(spark):
    df = spark.range(30).select(T.page_number(F.floor(F.col("id") / 10) + 1, F.col("id") % 10, 10).alias("p"))
    assert [r.p for r in df.orderBy("p").collect()] == list(range(1, 31))


@pytest.mark.parametrize("size", [2, 10**9])
def test_attempts(spark, rows, size):
    df = spark.createDataFrame([("s", t, t) for t in range(5)] + [("t", 9, 9)], "step string, at bigint, id bigint")
    out = T.attempts_exhausted(
        df, ["step"], "at", "id", max_attempts=4, interval_ms=2000, backoff_rate=2, width=size
    )
    assert rows(out, "step", "attempt", "backoff_ms", "exhausted") == [
        ("s", 1, 2000, False), ("s", 2, 4000, False), ("s", 3, 8000, False), ("s", 4, None, True),
        ("s", 5, None, True), ("t", 1, 2000, False),
    ]
    fallback = T.with_fallback(out.withColumn("v", F.lit("value")), "v", "exhausted", F.lit("default"))
    assert rows(fallback.where("step = 's'"), "attempt", "v")[-1] == (5, "default")


def test_durations_and_order(spark, rows):
    df = spark.createDataFrame(
        [("r", 1, 0, 10), ("r", 2, 0, 30), ("r", 3, 5, 10)], "run string, id bigint, at bigint, end bigint"
    ).withColumn("len", F.col("end") - F.col("at"))
    assert rows(T.duration_summary(df, ["run"], "len", "at", "end")) == [("r", 3, 45, 30, 1.5)]
    assert rows(T.completion_order(df, ["run"], "end", "id"), "id", "finish_rank") == [(1, 1), (2, 3), (3, 2)]
    zero = T.duration_summary(df.where("id = 0"), ["run"], "len", "at", "end")
    assert zero.count() == 0


def test_size_classes(spark, rows):
    df = spark.createDataFrame([(1,), (9,), (10,), (1000,)], "n bigint")
    assert rows(T.payload_size_profile(df, "n")) == [(0, 2, 10, 5.0), (1, 1, 10, 10.0), (3, 1, 1000, 1000.0)]
