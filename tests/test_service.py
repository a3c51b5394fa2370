"""Services as Spark sources. Every fetch leaves a file, so that fetches can be counted."""

import pathlib
import uuid

import pandas as pd
import pytest

from millrace.sources import service
from millrace.streaming import base

TENANTS = [{"org": "a", "n": 1, "pages": 5}, {"org": "b", "n": 2, "pages": 3}, {"org": None, "n": 3, "pages": 1}, {"org": "c", "n": 4, "pages": 0}]
SCHEMA = "org string, n int, page bigint, id string, score double"


@pytest.fixture
def paged(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()

    def fetch(request):
        (calls / uuid.uuid4().hex).write_text(f"{request['org']}-{request['page']}")
        return pd.DataFrame({"id": [f"{request['org']}{request['page']}{k}" for k in range(2)]})

    name = f"pages_{uuid.uuid4().hex}"
    service.register_pages(spark, name, SCHEMA, ["org", "n"], lambda: TENANTS, fetch, pages_per_partition=2)
    return name, lambda: sorted(p.read_text() for p in pathlib.Path(calls).iterdir())


def test_each_page_is_fetched_once(spark, paged):
    name, calls = paged
    rows = service.read_pages(spark, name).collect()
    assert len(rows) == 18 and {(r.org, r.n) for r in rows} == {("a", 1), ("b", 2), (None, 3)}
    assert all(r.id == f"{r.org}{r.page}{r.id[-1]}" and r.score is None for r in rows)
    assert calls() == sorted([f"a-{p}" for p in range(1, 6)] + [f"b-{p}" for p in range(1, 4)] + ["None-1"])


def test_one_partition_for_each_tenant_and_block(spark, paged):
    assert service.read_pages(spark, paged[0]).rdd.getNumPartitions() == 3 + 2 + 1


def test_only_wanted_pages_are_fetched(spark, paged):
    name, calls = paged
    part = service.read_pages(spark, name, first_page=2, last_page=4, org="a")
    assert sorted(r.page for r in part.collect()) == [2, 2, 3, 3, 4, 4] and calls() == ["a-2", "a-3", "a-4"]
    assert service.read_pages(spark, name, n=2).count() == 6
    assert service.read_pages(spark, name, org="nobody").count() == 0
    # what one frame asks for does not cut another
    whole, one = service.read_pages(spark, name), service.read_pages(spark, name, org="b")
    assert one.count() == 6 and whole.count() == 18 and whole.unionByName(one).count() == 24
    assert whole.where("org = 'a'").count() == 10 and whole.count() == 18


def test_a_failing_page_is_repeated_by_itself(spark, tmp_path):
    def flaky(request):
        mark = tmp_path / f"seen-{request['page']}"
        if request["page"] == 3 and not mark.exists():
            mark.write_text("")
            raise ConnectionError("try again")
        (tmp_path / f"fetched-{request['page']}-{uuid.uuid4().hex}").write_text("")
        return pd.DataFrame({"id": ["x"]})

    service.register_pages(spark, "flaky_pages", SCHEMA, ["org", "n"], lambda: TENANTS[:1], flaky, max_attempts=2)
    assert service.read_pages(spark, "flaky_pages").count() == 5
    assert len(list(tmp_path.glob("fetched-*"))) == 5
    (tmp_path / "seen-3").unlink()
    service.register_pages(spark, "flaky_pages", SCHEMA, ["org", "n"], lambda: TENANTS[:1], flaky, max_attempts=1)
    with pytest.raises(Exception, match="try again"):
        service.read_pages(spark, "flaky_pages").count()


def test_empty_pages_and_no_tenants(spark):
    service.register_pages(spark, "no_rows", SCHEMA, ["org", "n"], lambda: TENANTS, lambda r: pd.DataFrame({"id": []}))
    assert service.read_pages(spark, "no_rows").count() == 0
    service.register_pages(spark, "no_tenants", SCHEMA, ["org", "n"], lambda: [], lambda r: pd.DataFrame({"id": ["x"]}))
    assert service.read_pages(spark, "no_tenants").count() == 0


def polled(spark, tmp_path, name, fail=None):
    log, heard = tmp_path / "log", tmp_path / "heard"
    log.mkdir(exist_ok=True), heard.mkdir(exist_ok=True)

    def newest():
        return max((int(p.name) for p in log.iterdir()), default=0)

    def fetch(after, upto):
        if fail and (tmp_path / fail).exists():
            raise ConnectionError("log is away")
        return pd.DataFrame([(int(p.name), p.read_text()) for p in log.iterdir() if after < int(p.name) <= upto], columns=["position", "value"])

    service.register_log(spark, name, "position bigint, value string", newest, fetch, entries_per_partition=3, max_attempts=1,
                         consumed=lambda position: (heard / str(position)).write_text(""))
    return spark.readStream.format(name).load(), log, heard


def test_a_log_is_read_once_over_restarts(spark, tmp_path):
    stream, log, heard = polled(spark, tmp_path, "polled_log")
    for upto in (7, 7, 12, 20):
        for n in range(1, upto + 1):
            (log / str(n)).write_text(f"v{n}")
        base.run_batches(stream, str(tmp_path / "checkpoint"), base.append_log(str(tmp_path / "rows")))
    rows = base.read_log(spark, str(tmp_path / "rows")).collect()
    assert sorted((r.position, r.value) for r in rows) == [(n, f"v{n}") for n in range(1, 21)]
    assert {r.batch_id for r in rows} == {0, 1, 2}
    assert heard.joinpath("7").exists() and heard.joinpath("12").exists()


def test_a_batch_that_failed_is_read_again_to_the_same_position(spark, tmp_path):
    stream, log, _ = polled(spark, tmp_path, "failing_log", fail="away")
    for n in range(1, 6):
        (log / str(n)).write_text("x")
    (tmp_path / "away").write_text("")
    with pytest.raises(Exception, match="log is away"):
        base.run_batches(stream, str(tmp_path / "checkpoint"), base.append_log(str(tmp_path / "rows")))
    (tmp_path / "away").unlink()
    (log / "6").write_text("x")  # came after the batch was planned
    for _ in range(2):
        base.run_batches(stream, str(tmp_path / "checkpoint"), base.append_log(str(tmp_path / "rows")))
    rows = base.read_log(spark, str(tmp_path / "rows")).collect()
    assert sorted((r.batch_id, r.position) for r in rows) == [(0, n) for n in range(1, 6)] + [(1, 6)]


def test_stored_pages_and_log(spark, tmp_path):
    frame = spark.createDataFrame([(n, f"t{n % 2}", n // 10, '[{"id": "%d", "score": 1.5}]' % n) for n in range(40)], "n int, org string, page int, body string")
    frame.where("n < 4").select("org", F_page(), "body").write.partitionBy("org", "page").parquet(str(tmp_path / "pages"))
    answer = service.StoredPages(str(tmp_path / "pages"), ["org"])({"org": "t1", "page": 3})
    assert answer.to_dict("records") == [{"id": "3", "score": 1.5}]
    frame.selectExpr("n", "body", "page AS block").write.partitionBy("block").parquet(str(tmp_path / "stored"))
    log = service.StoredLog(str(tmp_path / "stored"), "n", 10)
    log.grow(25)
    assert log.newest() == 25 and sorted(log(7, 25)["n"]) == list(range(8, 26)) and len(log(39, 90)) == 0


def F_page():
    from pyspark.sql import functions as F

    return F.col("n").alias("page")
