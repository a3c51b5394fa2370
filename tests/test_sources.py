import json
import os
import uuid
from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators import access, jobs, quality
from millrace.sinks import tables as sinks
from millrace.sources import documents, generated, paged, tables

PERSON = {
    "gender": "female",
    "name": {"title": "Ms", "first": "Zoë", "last": "Ünal"},
    "location": {
        "street": {"number": 12, "name": "Main"}, "city": "Izmir", "state": "Aegean",
        "country": "Turkey", "postcode": 35000,
        "coordinates": {"latitude": "38.4", "longitude": "-27.1"},
        "timezone": {"offset": "+3:00", "description": "Istanbul"},
    },
    "email": "z@example.org",
    "login": {"uuid": "u-1", "username": "zoe", "password": "p", "salt": "s", "md5": "m", "sha1": "1", "sha256": "2"},
    "dob": {"date": "1956-08-11T16:36:39.869Z", "age": 68},
    "registered": {"date": "2010-01-02T03:04:05.000Z", "age": 14},
    "phone": "1", "cell": "2", "id": {"name": "", "value": None},
    "picture": {"large": "l", "medium": "m", "thumbnail": "t"}, "nat": "TR",
}


def test_whole_file_document(spark, tmp_path):
    other = json.loads(json.dumps(PERSON))
    other["location"]["postcode"] = "AB1 2CD"
    other["location"]["coordinates"]["latitude"] = "north"
    path = tmp_path / "doc.json"
    path.write_text(json.dumps({"results": [PERSON, other], "info": {"seed": "s", "results": 2}}, indent=1))
    people = documents.json_document_scan(spark, str(path), multi_line=True)
    flat = documents.flatten_person(people)
    assert len(flat.columns) == 34
    first, second = flat.orderBy(F.col("postcode")).collect()
    assert (first.postcode, second.postcode) == ("35000", "AB1 2CD")
    assert (first.latitude, first.longitude, second.latitude) == (38.4, -27.1, None)
    assert first.date_of_birth == datetime(1956, 8, 11, 16, 36, 39, 869000)
    assert (first.street_number, first.age, first.id_value, first.password, first.sha256) == (12, 68, None, None, None)
    assert uuid.UUID(first.id).version == 4 and first.id != second.id
    kept = documents.flatten_person(people, keep_secrets=True).first()
    assert (kept.password, kept.salt, kept.md5) == ("p", "s", "m")


def test_read_through_fetches_once(spark, tmp_path):
    fetched = []

    def fetch():
        fetched.append(1)
        return spark.range(3)

    for _ in range(2):
        assert documents.read_through(spark, str(tmp_path / "copy"), fetch).count() == 3
    assert len(fetched) == 1


def _plan(spark):
    tenants = spark.createDataFrame([("o1", 3), ("o2", 12), ("o3", 0)], "org string, pages int")
    return paged.page_plan(tenants, "pages")


def _page(request):
    return pd.DataFrame({"org": [request["org"]] * 10, "n": [request["page"] * 10 + i for i in range(10)]})


def test_paged_extract(spark, rows):
    plan = _plan(spark)
    assert rows(plan.where("org = 'o2'"), "page", "batch")[-1] == (9, 1)
    assert plan.where("page = 11").first().batch == 2
    got = paged.paged_extract(plan, _page, "org string, n bigint", requests_in_parallel=3)
    want = [("o1", p * 10 + i) for p in (1, 2, 3) for i in range(10)]
    want += [("o2", p * 10 + i) for p in range(1, 13) for i in range(10)]
    assert rows(got) == sorted(want, key=repr)


def test_paged_extract_retries(spark, tmp_path):
    marks = str(tmp_path)

    def flaky(request):
        mark = os.path.join(marks, f"{request['org']}-{request['page']}")
        tries = len(open(mark).read()) if os.path.exists(mark) else 0
        with open(mark, "a") as f:
            f.write("x")
        if tries < 2:
            raise IOError("no answer")
        return _page(request)

    assert paged.paged_extract(_plan(spark), flaky, "org string, n bigint").count() == 150
    assert {len(open(os.path.join(marks, m)).read()) for m in os.listdir(marks)} == {3}

    def broken(request):
        raise IOError("never answers")

    with pytest.raises(Exception, match="never answers"):
        paged.paged_extract(_plan(spark), broken, "org string, n bigint").count()


def test_paged_extract_of_records(spark):
    def records(request):
        return [{"org": request["org"], "n": request["page"], "other": 1}, {"n": None}]

    got = paged.paged_extract(_plan(spark).where("page <= 2"), records, "org string, n bigint", records=True)
    assert sorted(got.collect(), key=repr) == sorted([("o1", 1), ("o1", 2), ("o2", 1), ("o2", 2), *[(None, None)] * 4], key=repr)


def test_stored_pages_are_whole_and_read_in_small_groups(spark, tmp_path):
    """A reader holds a row group of pages at a time, so one file of many pages has several."""
    from pyarrow import parquet

    frame = spark.range(20_000).select(F.col("id"), F.concat(F.lit("t"), F.col("id") % 3).alias("org"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 32).alias("text"))
    pages = paged.store_pages(paged.stored_pages(frame, ["org"], ["id"], 100).coalesce(1), str(tmp_path / "pages"))
    counted = {(r.org, r.page): len(json.loads(r.body)) for r in pages.collect()}
    for org, n in (("t0", 6667), ("t1", 6667), ("t2", 6666)):
        assert [counted[org, p] for p in range(1, 68)] == [100] * 66 + [n % 100]
    assert paged.union_pages(pages, "id bigint, org string, text string").exceptAll(frame).count() == 0
    [file] = (tmp_path / "pages").glob("*.parquet")
    found = parquet.ParquetFile(file).metadata
    assert max(found.row_group(i).num_rows for i in range(found.num_row_groups)) <= 64 < found.num_rows == 201


def test_stored_pages_of_equal_rows_and_maps(spark):
    frame = spark.range(250).select(F.lit("t").alias("org"), F.lit(1).alias("n"), F.create_map(F.lit("a"), F.col("id") % 5).alias("m"))
    pages = paged.stored_pages(frame, ["org"], ["n"], 100).collect()
    assert sorted((r.page, len(json.loads(r.body))) for r in pages) == [(1, 100), (2, 100), (3, 50)]


def test_plan_of_stored_pages(spark, tmp_path, rows):
    spark.createDataFrame([("o1", 2), ("o2", 0)], "org string, pages int").write.parquet(str(tmp_path / "tenants"))
    stored = [("o1", p, f"b{p}") for p in (1, 2, 3)] + [("o2", 1, "x"), ("o9", 1, "x"), (None, 1, "x")]
    spark.createDataFrame(stored, "org string, page bigint, body string").write.parquet(str(tmp_path / "bodies"))
    tenants, bodies = (spark.read.parquet(str(tmp_path / n)) for n in ("tenants", "bodies"))
    plan = paged.page_plan(tenants, "pages", 1, bodies=bodies, tenant=["org"])
    assert rows(plan, "org", "page", "batch", "body") == [("o1", 1, 1, "b1"), ("o1", 2, 2, "b2")]
    assert "hashpartitioning" not in plan._jdf.queryExecution().executedPlan().toString()


def test_object_listing(spark, tmp_path):
    (tmp_path / "a").mkdir()
    for name in ("a/x.bin", "a/y.txt", "z.bin"):
        (tmp_path / name).write_bytes(b"12345"[: len(name)])
    listing = tables.object_listing(spark, str(tmp_path), "*.bin")
    assert {(os.path.basename(r.path), r.size_bytes) for r in listing.collect()} == {("x.bin", 5), ("z.bin", 5)}
    plan = listing._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_prefix_listing(spark, tmp_path):
    for name in ("p1/a/x", "p1/y", "p2/z", "p2/b/c/w", "p3/skip"):
        file = tmp_path / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(b"1" * len(name))
    uris = spark.createDataFrame([(f"file://{tmp_path}/{p}",) for p in ("p1", "p2")], "prefix string")
    got = tables.prefix_listing(uris, page_size=1, tasks=2).collect()
    assert {(os.path.relpath(r.path, tmp_path), r.size_bytes) for r in got} == {
        (n, len(n)) for n in ("p1/a/x", "p1/y", "p2/z", "p2/b/c/w")
    }


def test_seeds(spark):
    """Two integrations for each organization; ids are the name-based ids of ``organization:provider:number``."""
    seeds = generated.seed_integrations(spark.range(1, 4), "id").collect()
    want = {
        ("d6f3de5e-8033-5696-b4c4-9d3c7b1bab99", "org-001", "okta", 1),
        ("153026a0-ecfe-55d5-bf56-b31cac6585da", "org-001", "google", 2),
        ("9c58e67f-93b1-58e5-80f3-b1be6873293a", "org-002", "google", 1),
        ("698ea87a-a3fc-5104-87ce-c9968f2acb6b", "org-002", "azure", 2),
        ("697b1cd6-ceae-5268-9bb9-797d01bde1b0", "org-003", "azure", 1),
        ("235bc877-9ee2-5301-ac1e-19efea818583", "org-003", "okta", 2),
    }
    data = '{{"permission_source_name":"{0}_source_{1}","api_endpoint":"https://api.{0}.com/v1","last_sync":null}}'
    assert {tuple(s) for s in seeds} == {(*w[:3], data.format(*w[2:])) for w in want} and len(seeds) == 6


def test_seed_only_when_empty(spark):
    some = spark.range(2)
    assert generated.seed_if_empty(some, spark.range(9)).count() == 2
    assert generated.seed_if_empty(some.limit(0), spark.range(9)).count() == 9


def test_synthetic_users_cycle(spark):
    df = generated.synthetic_users(spark.range(6000), "id", F.lit("o"), F.lit("i"))
    row = df.agg(F.count_distinct("id"), F.count_distinct("name"), F.count_distinct("email")).first()
    assert tuple(row) == (1500, 1200, 1300)
    one = df.first()
    assert one.id == str(uuid.uuid5(uuid.NAMESPACE_DNS, one.external_id))


def test_request_grid(spark):
    grid = generated.request_grid(spark.range(1), 5)
    assert grid.count() == 45
    for column in ("provider", "data_type"):
        assert {r["count"] for r in grid.groupBy(column).count().collect()} == {15}
    by_row = generated.request_grid(spark.createDataFrame([(0,), (2,)], "n int"), "n")
    assert by_row.count() == 18
    routed, unknown = quality.dispatch_split(
        grid.withColumn("data_type", F.when(F.col("request_num") == 5, "other").otherwise(F.col("data_type"))),
        "data_type", generated.ROUTES,
    )
    assert (routed.count(), unknown.count()) == (36, 9)
    users = routed.where("data_type = 'permissions'").select("queue_name", "queue_limit", "queue_period").distinct()
    assert tuple(users.first()) == ("queue_permissions", 3, 10)


def test_replacing_a_run(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", "x", 1), ("b", "x", 2), ("a", "y", 3)], "run string, org string, v int")
    sinks.replace_slice(df, path, ["run", "org"])
    sinks.replace_slice(df.where("run = 'a'"), path, ["run", "org"])
    assert rows(spark.read.parquet(path), "run", "org", "v") == [("a", "x", 1), ("a", "y", 3), ("b", "x", 2)]
    runs = str(tmp_path / "runs")
    for run in ("a", "b"):
        sinks.replace_run(df.where(F.col("run") == run), runs, run=run)
    sinks.replace_run(df.limit(0), runs, run="b")  # the repeated run finds nothing
    assert rows(spark.read.parquet(runs), "run", "v") == [("a", 1), ("a", 3)]
    sinks.truncate(df, path)
    assert spark.read.schema(df.schema).parquet(path).count() == 0


def test_log_lines(spark, tmp_path):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1, 0, 0, 0, 5), "INFO", "m", (1, 2))],
        "asctime timestamp_ntz, levelname string, message string, nested struct<a: int, b: int>",
    )
    sinks.json_log_lines(df, str(tmp_path / "log"))
    (line,) = [r.value for r in spark.read.text(str(tmp_path / "log")).collect()]
    assert json.loads(line) == {
        "timestamp": "2024-01-01T00:00:00.000005", "severity": "INFO", "message": "m", "nested": {"a": 1, "b": 2},
    }


def test_quarantine(spark, rows):
    def shout(text):
        if text == "task 50":
            raise ValueError("task 50 is invalid")
        return text.upper()

    df = spark.createDataFrame([(i, f"task {i}") for i in (1, 50, 51)], "id int, data string")
    good, bad = quality.transform_quarantine(df, "data", shout)
    assert rows(good, "id", "transformed") == [(1, "TASK 1"), (51, "TASK 51")]
    assert rows(bad, "id", "message") == [(50, "task 50 is invalid")]


def test_parallel_map(spark, rows):
    def double(batch):
        return pd.DataFrame({"id": batch["id"], "twice": batch["id"] * 2})

    got = paged.parallel_map(spark.range(100), double, "id bigint, twice bigint", tasks=4)
    assert rows(got) == sorted([(i, 2 * i) for i in range(100)], key=repr)
    assert got.rdd.getNumPartitions() == 4


def test_access_requests(spark, rows):
    day = datetime(2024, 1, 1)
    requests = spark.createDataFrame(
        [("r1", "u1", "a1", "requested", day), ("r2", "u2", "a1", "approved", day.replace(hour=2))],
        "id string, user_id string, access_id string, status string, created_at timestamp_ntz",
    )
    accesses = spark.createDataFrame([("a1", "read")], "id string, description string")
    users = spark.createDataFrame([("u1", "Ann"), ("u2", "Bob")], "id string, name string")
    everything = access.access_join(requests, accesses, users).collect()
    assert [r.access_request_id for r in everything] == ["r2", "r1"]
    assert tuple(everything[1]) == ("r1", "2024-01-01T00:00:00", "requested", "a1", "read", "u1", "Ann")
    assert access.access_join(requests, accesses, users, "u1").count() == 1
    log = spark.createDataFrame(
        [("r1", "approved", 1), ("r1", "rejected", 2), ("r9", "canceled", 1)],
        "id string, status string, changed_at int",
    )
    assert rows(access.current_requests(requests, log), "id", "status") == [("r1", "rejected"), ("r2", "approved")]
    updated = access.point_update(requests, spark.createDataFrame([("r1", "rejected")], "id string, status string"), "id")
    assert rows(updated, "id", "status") == [("r1", "rejected"), ("r2", "approved")]


def test_optional_filters(spark):
    df = spark.createDataFrame([("o1", "i1"), ("o1", "i2"), ("o2", "i1")], "org string, integ string")
    assert jobs.tenant_count(df, org="o1").first().row_count == 2
    assert jobs.tenant_count(df, org="o1", integ="").first().row_count == 2
    assert jobs.tenant_count(df, org=None).first().row_count == 3
    assert jobs.tenant_count(df, org="none").first().row_count == 0


def test_summary_levels(spark, rows):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 4), ("b", None, 8)], "o string, i string, v int")
    got = jobs.run_summary(df, ["o", "i"], {"v": F.sum("v")})
    assert rows(got.where("level = 1"), "o", "v") == [("a", 3), ("b", 12)]
    assert rows(got.where("level = 2"), "v") == [(15,)]
    assert got.where("level = 0").count() == 4


def test_nested_lists(spark, rows):
    df = spark.createDataFrame([(1, [[1, 2], [3]]), (2, []), (3, [[]])], "id int, l array<array<int>>")
    assert rows(jobs.nested_list_totals(df, "l"), "id", "lists", "elements", "total") == [
        (1, 2, 3, 6), (2, 0, 0, 0), (3, 1, 0, 0),
    ]


def test_queue_lists(spark, rows):
    df = spark.createDataFrame(
        [(1, "PENDING", "q", 5), (2, "PENDING", "q", 3), (3, "SUCCESS", "q", 1)],
        "id int, status string, queue string, created int",
    )
    assert rows(jobs.queue_status_counts(df, ["queue", "status"], "id", "created")) == [
        ("q", "PENDING", 2, 2), ("q", "SUCCESS", 1, 3),
    ]
    first = jobs.status_filter(df, ["PENDING"], 1, [F.col("created")], queue="q")
    assert rows(first, "id") == [(2,)]
    assert [r.id for r in jobs.top_recent(df, "created", "id", 2).collect()] == [1, 2]
    assert [r.id for r in jobs.sort_by(df, "created", "id").collect()] == [3, 2, 1]
    taken = spark.createDataFrame([(1,)], "id int")
    assert rows(quality.insert_if_absent(taken, df, ["id"]), "id") == [(2,), (3,)]


def test_slices_of_run_and_tenant(spark, tmp_path, rows):
    """One tenant's slice is replaced, whatever signs the names hold; the run's others stay."""
    table = str(tmp_path / "t")
    df = spark.createDataFrame([(r, t, i) for r in ("a/1", "b%2") for t in ("x:y", "z=") for i in range(2)], "run string, tenant string, i int")
    for r in ("a/1", "b%2"):
        for t in ("x:y", "z="):
            sinks.replace_run(df.where((F.col("run") == r) & (F.col("tenant") == t)), table, run=r, tenant=t)
    sinks.replace_run(df.limit(0), table, run="a/1", tenant="z=")
    got = rows(spark.read.parquet(table), "run", "tenant", "i")
    assert got == sorted(((r, t, i) for r, t, i in map(tuple, df.collect()) if (r, t) != ("a/1", "z=")), key=repr)


def test_zero_and_false_are_filters(spark, rows):
    df = spark.createDataFrame([(0, False, "a"), (1, True, "")], "n int, b boolean, t string")
    assert rows(jobs.where_given(df, n=0), "n") == [(0,)] == rows(jobs.where_given(df, b=False), "n")
    assert jobs.where_given(df, n=None, t="").count() == 2
    assert jobs.tenant_count(df, n=0).first().row_count == 1
    requests = spark.createDataFrame([(1, 0, 1, "s", datetime(2024, 1, 1)), (2, 5, 1, "s", datetime(2024, 1, 1))],
                                     "id int, user_id int, access_id int, status string, created_at timestamp_ntz")
    users = spark.createDataFrame([(0, "zero"), (5, "five")], "id int, name string")
    accesses = spark.createDataFrame([(1, "d")], "id int, description string")
    assert rows(access.access_join(requests, accesses, users, user_id=0), "user_name") == [("zero",)]
    assert access.access_join(requests, accesses, users).count() == 2
