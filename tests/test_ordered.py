import random
import re

import pytest
from pyspark.sql import Window, functions as F

from millrace.operators import ordered as O


@pytest.fixture(scope="module")
def skewed(spark):
    """2,400 rows: one key holds two thirds, a null key, null and many equal times, null values."""
    rng = random.Random(7)
    data = []
    for i in range(2400):
        key = rng.choice(["hot", "hot", "hot", "hot", f"k{rng.randrange(40)}", None])
        at = rng.choice([500, rng.randrange(-300, 1000), rng.randrange(1000), rng.choice([None, 7])])
        data.append((key, at, i, rng.choice([None, rng.randrange(-50, 50)])))
    rng.shuffle(data)
    return spark.createDataFrame(data, "k string, at bigint, id bigint, v bigint").repartition(4).cache()


def expected(df):
    w = Window.partitionBy("k").orderBy("at", "id")
    upto, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    rows = df.select(
        "k", "id", "v", F.row_number().over(w).cast("bigint").alias("n"), F.lag("v").over(w).alias("prev"),
        F.sum("v").over(upto).alias("total"), F.min("v").over(upto).alias("low"),
        F.max("v").over(upto).alias("high"), "at",
    )
    return rows.select(
        "k", "id", "n", "prev", "total", "low", "high",
        F.max(F.col("v") - 3 * F.col("n")).over(upto).alias("most"),
        F.min(F.col("v") + F.col("total")).over(before).alias("least"),
    )


@pytest.mark.parametrize("width", [1, 30, 700, 10**9])
def test_scan_equals_plain_window(skewed, rows, width):
    got = O.order_within(skewed, ["k"], ["at", "id"], width).scan(
        number="n", lag={"prev": "v"}, sums={"total": "v"}, lows={"low": "v"}, highs={"high": "v"},
        shifted={"most": O.Shifted("max", F.col("v") - 3 * F.col("n"), {"n": -3}),
                 "least": O.Shifted("min_before", F.col("v") + F.col("total"), {"total": 1})},
    ).result()
    want = expected(skewed)
    assert rows(got, *want.columns) == rows(want)


def test_scans_follow_one_another(skewed, rows):
    once = O.order_within(skewed, ["k"], ["at", "id"], 50).scan(number="n")
    twice = once.with_columns({"x": F.col("v") - 3 * F.col("n")}).scan(highs={"most": "x"}).result()
    want = expected(skewed).select("k", "id", "n", "most")
    assert rows(twice, *want.columns) == rows(want)


def test_empty_input(spark):
    df = spark.createDataFrame([], "k string, at bigint")
    assert O.order_within(df, ["k"], ["at"]).scan(number="n").result().count() == 0


def jobs_of(spark, action):
    """Numbers of the jobs that an action starts."""
    spark.sparkContext.setJobGroup("watched", "jobs of a test")
    out = action()
    found = spark.sparkContext.statusTracker().getJobIdsForGroup("watched")
    spark.sparkContext.setJobGroup("", "")
    return out, found


def test_hot_key_plan(spark, tmp_path):
    """Rows are shuffled once and no job runs before the result is asked for, however much a key holds."""
    spark.range(4000).select(F.lit("hot").alias("k"), F.col("id").alias("at"), "id").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    scan = O.Shifted("max", F.col("at") - F.col("n"), {"n": -1})
    out, started = jobs_of(spark, lambda: O.order_within(df, ["k"], ["at", "id"], 100).scan(number="n", shifted={"m": scan}).result())
    assert not started
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # the rows once, read again for the totals; then one row a bucket
    assert final.count("Scan parquet") == 1
    assert final.count("ReusedExchange") >= 1
    sizes = out.count()
    assert sizes == 4000 and out.select("n").distinct().count() == 4000


def test_numbers_alone_sort_rows_once(spark):
    frame = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("t"))
    numbered = O.order_within(frame, ["k"], ("t",), 10).scan(number="n").result()
    assert numbered.where(F.col("n") != F.floor(F.col("t") / 7) + 1).count() == 0 and numbered.count() == 1000
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Window \[row_number", plan)) == 1
