import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.functions.hashing import content_hash
from millrace.operators import cdc, dedup
from millrace.schemas import TENANT, USER_KEYS

NEWEST = ("created_at", "batch_seq")
PAYLOAD = ["external_id", "name", "email", "content_hash"]


def staging_of(spark, data):
    """Rows (id, org, integration, name, email, seq) as staged rows."""
    schema = (
        "id string, organization_id string, connected_integration_id string, name string, "
        "email string, seq int"
    )
    at = F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz")
    return spark.createDataFrame(data, schema).select(
        "id", F.lit("run").alias("workflow_id"), F.concat(F.lit("x"), "id").alias("external_id"),
        "organization_id", "connected_integration_id", "name", "email",
        content_hash("name", "email").alias("content_hash"),
        at.alias("created_at"), F.col("seq").cast("bigint").alias("batch_seq"),
    )


def latest_of(spark, data):
    return staging_of(spark, [(*r, 0) for r in data]).select(*USER_KEYS, *PAYLOAD)


@pytest.fixture(scope="module")
def random_sides(spark):
    rng = random.Random(3)

    def user(i):
        return (f"u{i}", f"o{i % 3}", f"i{i % 2}", f"n{rng.randrange(3)}", f"e{rng.randrange(2)}")

    staged = [(*user(i), seq) for i in range(300) if i % 5 for seq in range(rng.choice([1, 1, 2, 4]))]
    prior = [user(i) for i in range(300) if i % 7]
    return staging_of(spark, staged).cache(), latest_of(spark, prior).cache()


def test_apply_gives_staging(random_sides, rows):
    staging, latest = random_sides
    changes = cdc.detect_changes(staging, latest, newest=NEWEST)
    after = cdc.apply_changes(latest, changes)
    want = dedup.dedup_latest(staging, USER_KEYS, NEWEST)
    columns = [*USER_KEYS, "name", "email", "content_hash"]
    assert rows(after, *columns) == rows(want, *columns)
    # nothing is left to do, and applying the changes again changes nothing
    assert cdc.detect_changes(staging, after, newest=NEWEST).count() == 0
    assert rows(cdc.apply_changes(after, changes), *columns) == rows(after, *columns)
    assert cdc.reconcile(latest, changes, after).where("not ok").count() == 0


def test_key_sets_match_counts(random_sides):
    staging, latest = random_sides
    counts = cdc.change_counts(cdc.detect_changes(staging, latest, newest=NEWEST)).first()
    sides = {r.side: r["count"] for r in cdc.key_set_diff(staging, latest).groupBy("side").count().collect()}
    assert counts.inserts == sides["staging"] and counts.deletes == sides["latest"]
    assert 0 < counts.updates < sides["both"]
    assert counts.total_changes == counts.inserts + counts.updates + counts.deletes


def test_change_values(spark, rows):
    staging = staging_of(spark, [
        ("new", "o", "i", "N", "e", 1), ("same", "o", "i", "S", "e", 1),
        ("mod", "o", "i", "stale", "e", 1), ("mod", "o", "i", "M2", "e", 2),
        ("null", "o", "i", "Z", None, 1), ("both-null", "o", "i", None, "e1", 1),
    ])
    latest = latest_of(spark, [
        ("same", "o", "i", "S", "e"), ("mod", "o", "i", "M", "e"), ("gone", "o", "i", "G", "g"),
        ("null", "o", "i", "Z", "z"), ("both-null", "o", "i", None, "e2"),
    ])
    got = cdc.detect_changes(staging, latest, newest=NEWEST)
    assert rows(got, "id", "name", "email", "change_type") == [
        ("both-null", None, "e1", "UPDATE"), ("gone", "G", "g", "DELETE"),
        ("mod", "M2", "e", "UPDATE"), ("new", "N", "e", "INSERT"), ("null", "Z", None, "UPDATE"),
    ]


def test_same_id_in_other_tenant_is_another_record(spark, rows):
    staging = staging_of(spark, [("u", "o1", "i", "A", "a", 1)])
    latest = latest_of(spark, [("u", "o2", "i", "B", "b")])
    got = cdc.detect_changes(staging, latest, newest=NEWEST, all_tenants=True)
    assert rows(got, "organization_id", "change_type") == [("o1", "INSERT"), ("o2", "DELETE")]


def test_tenants_limit_the_run(spark, rows):
    latest = latest_of(spark, [("a", "o1", "i", "A", "a"), ("b", "o2", "i", "B", "b")])
    empty = staging_of(spark, [])
    # a tenant that was not extracted is left alone, unless the run says that it covers all
    assert cdc.detect_changes(empty, latest, newest=NEWEST).isEmpty()
    one = staging_of(spark, [("c", "o1", "i", "C", "c", 1)])
    assert rows(cdc.detect_changes(one, latest, newest=NEWEST), "id", "change_type") == [("a", "DELETE"), ("c", "INSERT")]
    everything = cdc.detect_changes(empty, latest, newest=NEWEST, all_tenants=True)
    assert everything.where("change_type = 'DELETE'").count() == 2
    only = spark.createDataFrame([("o2", "i")], "organization_id string, connected_integration_id string")
    got = cdc.detect_changes(empty, latest, newest=NEWEST, tenants=only)
    assert rows(got, "id", "change_type") == [("b", "DELETE")]
    assert rows(cdc.excess_deletes(everything, latest, 0.5), "organization_id") == [("o1",), ("o2",)]


def test_null_keys_match(spark, rows):
    data = [("u", None, "i", "A", "a"), (None, "o", None, "B", "b"), ("v", None, "i", "V", "v")]
    staging, latest = staging_of(spark, [(*r, 1) for r in data[:2]]), latest_of(spark, data)
    changes = cdc.detect_changes(staging, latest, newest=NEWEST)
    assert rows(changes, "id", "organization_id", "change_type") == [("v", None, "DELETE")]
    assert rows(cdc.apply_changes(latest, changes), "name") == [("A",), ("B",)]
    assert rows(cdc.excess_deletes(changes, latest, 0.4), "organization_id") == [(None,)]


@pytest.mark.parametrize("scope", [{}, {"all_tenants": True}, {"tenants": [("o1", "i1"), ("o9", "i9")]}])
def test_next_snapshot_is_changes_applied(spark, random_sides, rows, scope):
    staging, latest = random_sides
    if "tenants" in scope:
        scope = {"tenants": spark.createDataFrame(scope["tenants"], ", ".join(f"{c} string" for c in TENANT))}
    else:
        staging = staging.where("organization_id <> 'o2'")
    want = cdc.apply_changes(latest, cdc.detect_changes(staging, latest, newest=NEWEST, **scope))
    got = cdc.next_snapshot(staging, latest, newest=NEWEST, **scope)
    columns = [*USER_KEYS, *PAYLOAD]
    assert rows(got, *columns) == rows(want, *columns)


def test_external_id_alone_is_no_change(spark):
    staging = staging_of(spark, [("u", "o", "i", "A", "a", 1)]).withColumn("external_id", F.lit("other"))
    latest = latest_of(spark, [("u", "o", "i", "A", "a")])
    assert cdc.detect_changes(staging, latest, newest=NEWEST).count() == 0


def test_newest_change_of_several_runs_wins(spark, rows):
    latest = latest_of(spark, [("u", "o", "i", "A", "a"), ("v", "o", "i", "V", "v")])
    change = latest.withColumn("change_type", F.lit("UPDATE"))
    runs = (
        change.where("id = 'u'").withColumns({"name": F.lit("first"), "run": F.lit(1)})
        .unionByName(change.where("id = 'u'").withColumns({"name": F.lit("second"), "run": F.lit(2)}))
        .unionByName(change.where("id = 'v'").withColumns({"change_type": F.lit("DELETE"), "run": F.lit(2)}))
    )
    assert rows(cdc.apply_changes(latest, runs, newest=["run"]), "id", "name") == [("u", "second")]


def test_customer_fixture_counts(spark):
    """Both sides from the customer table; the counts were worked out independently in SQL."""
    customer = spark.read.parquet("/root/testdata/sf0.01/customer.parquet").select(
        F.col("c_custkey").alias("n"), F.col("c_custkey").cast("string").alias("id"),
        F.col("c_mktsegment").alias("organization_id"),
        F.col("c_nationkey").cast("string").alias("connected_integration_id"),
        F.col("c_custkey").cast("string").alias("external_id"), F.col("c_name").alias("name"),
    )

    def with_email(df, suffix):
        full = df.withColumn("email", F.concat("name", F.lit("@"), suffix))
        return full.withColumn("content_hash", content_hash("name", "email"))

    suffix = F.when(F.col("n") % 7 == 0, "new").otherwise("old")
    kept = customer.where("n % 10 <> 0")
    staging = with_email(kept, suffix).withColumn("seq", F.lit(2)).unionByName(
        with_email(kept.where("n % 3 = 0"), F.lit("stale")).withColumn("seq", F.lit(1))
    ).drop("n")
    latest = with_email(customer.where("n % 9 <> 0"), F.lit("old")).select(*USER_KEYS, *PAYLOAD)
    assert (staging.count(), latest.count()) == (1800, 1333)
    changes = cdc.detect_changes(staging, latest, newest=["seq"])
    counts = cdc.change_counts(changes).first()
    assert (counts.inserts, counts.updates, counts.deletes) == (150, 172, 133)
    assert cdc.apply_changes(latest, changes).count() == 1350


def test_dedup_counts(spark, rows):
    day = datetime(2024, 1, 1)
    data = [("k1", 1, day, "a"), ("k1", 1, day + timedelta(seconds=1), "b"), ("k1", 2, day, "c"), (None, 1, day, "d")]
    df = spark.createDataFrame(data, "k string, run int, at timestamp_ntz, v string")
    keys = ["k", "run"]
    assert rows(dedup.dedup_latest(df, keys, ["at"]), "k", "run", "v") == sorted(
        [("k1", 1, "b"), ("k1", 2, "c"), (None, 1, "d")], key=repr
    )
    assert dedup.unique_count(df, keys).first()[0] == 3
    assert dedup.unique_count(df, keys, approximate=True).first()[0] == 3
    assert rows(dedup.duplicate_count(df, keys)) == [(4, 3, 1)]
    assert rows(dedup.latest_run(df, "run", "at")) == [(1, day + timedelta(seconds=1))]


def test_ties_are_settled_by_the_other_columns(spark):
    day = datetime(2024, 1, 1)
    df = spark.createDataFrame([("k", day, v) for v in "bca"], "k string, at timestamp_ntz, v string")
    for parts in (1, 3):
        assert dedup.dedup_latest(df.repartition(parts), ["k"], ["at"]).first().v == "c"


def test_copies_drop_before_the_shuffle(random_sides):
    plan = dedup.dedup_latest(random_sides[0], USER_KEYS, NEWEST)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange hashpartitioning") == 1


def test_detection_shuffles_each_side_once(spark, random_sides, tmp_path):
    staging, latest = random_sides
    staging.write.parquet(str(tmp_path / "s"))
    latest.write.parquet(str(tmp_path / "l"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = cdc.detect_changes(
            spark.read.parquet(str(tmp_path / "s")), spark.read.parquet(str(tmp_path / "l")), newest=NEWEST,
            all_tenants=True,
        )
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("FileScan") == 2


def test_read_changes(random_sides):
    staging, latest = random_sides
    found = cdc.detect_changes(staging, latest, newest=NEWEST).withColumn("detected_at", F.lit(1))
    got = cdc.read_changes(found, organization_id="o1", connected_integration_id="i0").collect()
    assert got and {r.organization_id for r in got} == {"o1"} and [r.id for r in got] == sorted(r.id for r in got)


def test_tenant_scope_of_reconcile(spark, rows):
    latest = latest_of(spark, [("a", "o1", "i", "A", "a")])
    wrong = cdc.reconcile(latest, latest.limit(0).withColumn("change_type", F.lit("INSERT")), latest.limit(0))
    assert rows(wrong, *TENANT, "expected_count", "after_count", "ok") == [("o1", "i", 1, 0, False)]


def test_a_bucketed_snapshot_is_not_shuffled(spark, tmp_path, rows):
    from millrace.sinks import bucketed

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = spark.range(400).select(
            F.col("id").cast("string").alias("id"), F.when(F.col("id") % 7 > 0, "o").alias("organization_id"), F.lit("i").alias("connected_integration_id"),
            F.lit("n").alias("name"), (F.col("id") % 5).cast("string").alias("content_hash"))
        staged = base.where("id % 3 > 0").withColumn("content_hash", F.when(F.col("id") % 4 == 0, "new").otherwise(F.col("content_hash")))
        staged = staged.unionByName(staged.withColumn("id", F.concat("id", F.lit("x")))).withColumn("at", F.lit(1))
        stored = bucketed.store_snapshot(base, "bucketed_test", str(tmp_path / "t"), 6)
        found = cdc.detect_changes(staged, stored, newest=["at"], all_tenants=True, buckets=6)
        want = cdc.detect_changes(staged, base, newest=["at"], all_tenants=True)
        assert found.columns == want.columns and rows(found) == rows(want)
        plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
        with pytest.raises(ValueError, match="there already"):
            bucketed.store_snapshot(base, "bucketed_again", str(tmp_path / "t"), 6)
        bucketed.forget_snapshot(spark, "bucketed_test", str(tmp_path / "t"))
        assert not spark.catalog.tableExists("bucketed_test")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_derived_hash_is_not_read_nor_shuffled(spark, tmp_path, random_sides, rows):
    staging, latest = random_sides
    staging.write.parquet(str(tmp_path / "staging"))
    latest.write.parquet(str(tmp_path / "latest"))
    staged, stored = (spark.read.parquet(str(tmp_path / n)) for n in ("staging", "latest"))
    changes = cdc.detect_changes(staged, stored, newest=NEWEST)
    slim = cdc.detect_changes(staged, stored, newest=NEWEST, hash_of=["name", "email"])
    assert slim.columns == changes.columns and rows(slim) == rows(changes)
    assert "content_hash:" not in slim._jdf.queryExecution().executedPlan().toString()
    log = changes.withColumn("at", F.lit(2)).unionByName(latest.withColumns({"change_type": F.lit("INSERT"), "at": F.lit(1)}))
    log.write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    after = cdc.apply_changes(stored, log, newest=["at"])
    # copies meet by the columns of the join: one shuffle of the log, one of the snapshot at most
    assert after._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 2
    assert rows(cdc.apply_changes(stored, log, newest=["at"], hash_of=["name", "email"])) == rows(after)


def test_buckets_grow_with_the_rows(spark, tmp_path, monkeypatch):
    from millrace.catalog import records
    from millrace.sinks import bucketed, folders

    assert [bucketed.buckets_for(n, 4) for n in (0, 4_000_000, 4_000_001, 200_000_000)] == [4, 4, 5, 200]
    monkeypatch.setattr(bucketed, "ROWS_PER_BUCKET", 500)
    monkeypatch.setattr(records, "work_path", lambda spark, name: str(tmp_path / f"{name}-grow"))
    assert records.cdc_bucketed(spark, "/root/testdata/sf0.001").count() > 0
    files = [n for n in folders.names(spark, str(tmp_path / "snapshot-grow")) if n.endswith(".parquet")]
    assert len(files) > spark.sparkContext.defaultParallelism
