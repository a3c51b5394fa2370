import json
import pathlib
import re
import shutil

import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators import cdc
from millrace.plans import elt, imports
from millrace.schemas import TENANT
from millrace.sinks import folders
from millrace.sources.generated import synthetic_users


def users(spark, start, size, org="org-001", integration="int-1"):
    return synthetic_users(spark.range(start, start + size), "id", F.lit(org), F.lit(integration))


def counts(report):
    row = report.counts.agg(F.sum("inserts"), F.sum("updates"), F.sum("deletes")).first()
    return tuple(v or 0 for v in row)


def snapshot(spark, root):
    return sorted(map(tuple, elt.latest(spark, root).drop("last_updated").collect()))


def test_two_rounds_of_new_users(spark, tmp_path):
    root = str(tmp_path)
    elt.load(users(spark, 0, 50), root, "run-a")
    assert counts(elt.run(spark, root, "run-a")) == (50, 0, 0)
    assert elt.latest(spark, root).count() == 50
    # the counter runs on, so all ids of the second extract are new
    elt.load(users(spark, 50, 50), root, "run-b")
    assert counts(elt.run(spark, root, "run-b")) == (50, 0, 50)
    assert elt.latest(spark, root).count() == 50
    assert spark.read.parquet(f"{root}/staging").count() == 100
    assert spark.read.parquet(f"{root}/cdc").count() == 150


def test_replay_and_retry_leave_the_same_tables(spark, tmp_path):
    root = str(tmp_path)
    elt.load(users(spark, 0, 60), root, "r1")
    elt.run(spark, root, "r1")
    for _ in range(3):  # a load that was repeated twice
        elt.load(users(spark, 1480, 60), root, "r2", batch_seq=1)
    first = counts(elt.run(spark, root, "r2"))
    tables = snapshot(spark, root), elt.changes_of(spark, root, "r2").drop("detected_at").collect()
    again = elt.run(spark, root, "r2")
    assert counts(again) == first and first[0] > 0 and first[1] > 0 and first[2] > 0
    assert snapshot(spark, root) == tables[0]
    changes = elt.changes_of(spark, root, "r2").drop("detected_at").collect()
    assert sorted(changes, key=repr) == sorted(tables[1], key=repr)
    assert elt.staging_of(spark, root, "r2").count() == 180
    total = again.summary.where("level = 2").first()
    assert (total.loaded, total.unique_count) == (180, 60)


def test_time_of_update(spark, tmp_path):
    root = str(tmp_path)
    elt.load(users(spark, 0, 10), root, "r1")
    elt.run(spark, root, "r1")
    first = {r.id: r.last_updated for r in elt.latest(spark, root).collect()}
    # the ids of the first users come again after 1500 with other names; the others are unchanged
    mixed = users(spark, 0, 5).unionByName(users(spark, 1505, 5))
    elt.load(mixed, root, "r2")
    assert counts(elt.run(spark, root, "r2")) == (0, 5, 0)
    second = {r.id: r.last_updated for r in elt.latest(spark, root).collect()}
    assert set(first) == set(second)
    later = [i for i in first if second[i] > first[i]]
    assert len(later) == 5 and sum(first[i] == second[i] for i in first) == 5


def test_a_run_reads_only_its_own_staging(spark, tmp_path):
    root = str(tmp_path)
    elt.load(users(spark, 0, 40), root, "loaded")
    report = elt.run(spark, root, "another-run")
    assert counts(report) == (0, 0, 0)


def tenants(spark, *pairs):
    return spark.createDataFrame(list(pairs), ", ".join(f"{c} string" for c in TENANT))


def files_of(root, organization):
    return {
        (p.name, p.stat().st_mtime_ns, p.read_bytes())
        for p in pathlib.Path(root, "latest", f"organization_id={organization}").rglob("*.parquet")
    }


def test_untouched_organizations_keep_their_files(spark, tmp_path):
    root = str(tmp_path)
    two = users(spark, 0, 20).unionByName(users(spark, 0, 30, "org-002", "int-2"))
    elt.load(two, root, "r1")
    elt.run(spark, root, "r1")
    before = files_of(root, "org-002"), files_of(root, "org-001")
    elt.load(users(spark, 5, 20).unionByName(users(spark, 0, 30, "org-002", "int-2")), root, "r2")
    report = elt.run(spark, root, "r2")
    assert counts(report) == (5, 0, 5) and elt.latest(spark, root).count() == 50
    assert files_of(root, "org-002") == before[0] and files_of(root, "org-001") > before[1]
    assert elt.latest(spark, root, 1).count() == 50
    old, new = (set(map(tuple, elt.latest(spark, root, v).select("id", "organization_id").collect())) for v in (1, 2))
    assert len(old - new) == len(new - old) == 5


def test_tenants_of_one_run_one_after_the_other(spark, tmp_path):
    root = str(tmp_path)
    a, b = ("org-001", "int-1"), ("org-001", "int-2")
    c = ("org-002", "int-1")
    for tenant in (a, b, c):
        elt.load(users(spark, 0, 10, *tenant), root, "w")
    for tenant in (a, b, c):
        assert counts(elt.run(spark, root, "w", tenants=tenants(spark, tenant))) == (10, 0, 0)
    assert elt.latest(spark, root).count() == 30 and elt.changes_of(spark, root, "w").count() == 30
    # one of them again: the same changes, and nothing of the others is lost
    assert counts(elt.run(spark, root, "w", tenants=tenants(spark, a))) == (10, 0, 0)
    assert elt.latest(spark, root).count() == 30 and elt.changes_of(spark, root, "w").count() == 30
    # a repeated call that finds fewer changes clears its own slice only
    shutil.rmtree(f"{root}/staging/workflow_id=w")
    elt.load(users(spark, 0, 4, *a), root, "w")
    assert counts(elt.run(spark, root, "w", tenants=tenants(spark, a))) == (4, 0, 0)
    assert elt.latest(spark, root).count() == 24 and elt.changes_of(spark, root, "w").count() == 24


def test_a_tenant_without_changes_left_has_no_slice(spark, tmp_path):
    root = str(tmp_path)
    elt.load(users(spark, 0, 10), root, "w")
    elt.run(spark, root, "w")
    shutil.rmtree(f"{root}/staging/workflow_id=w")
    assert counts(elt.run(spark, root, "w", tenants=tenants(spark, ("org-001", "int-1")))) == (0, 0, 0)
    assert elt.latest(spark, root).isEmpty() and elt.changes_of(spark, root, "w").isEmpty()


@pytest.mark.parametrize("name", ["team/nightly", "a%3Ab", "2024-01-01T00:00:00", "x=y {z} *"])
def test_any_run_id(spark, tmp_path, name):
    root = str(tmp_path)
    elt.load(users(spark, 0, 7, "org/1", "int:1%"), root, name)
    assert elt.staging_of(spark, root, name).count() == 7
    assert counts(elt.run(spark, root, name)) == (7, 0, 0)
    assert elt.changes_of(spark, root, name).select("workflow_id").distinct().first()[0] == name
    elt.load(users(spark, 3, 7, "org/1", "int:1%"), root, name + "2")
    assert counts(elt.run(spark, root, name + "2")) == (3, 0, 3)
    assert {r.organization_id for r in elt.latest(spark, root).collect()} == {"org/1"}


def test_tenants_without_names(spark, tmp_path):
    root = str(tmp_path)
    rows = users(spark, 0, 6).withColumn("organization_id", F.when(F.col("name") > "User 2", F.col("organization_id")))
    elt.load(rows, root, "r1")
    assert counts(elt.run(spark, root, "r1")) == (6, 0, 0)
    elt.load(rows, root, "r2")
    assert counts(elt.run(spark, root, "r2")) == (0, 0, 0) and elt.latest(spark, root).count() == 6


def test_two_writers_do_not_overwrite_each_other(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    elt.load(users(spark, 0, 5), root, "r1")
    elt.run(spark, root, "r1")
    elt.load(users(spark, 5, 5), root, "r2")
    elt.load(users(spark, 0, 7, "org-002"), root, "r3")
    publish = folders.publish

    def after_the_other(*args):  # both have read version 1
        monkeypatch.setattr(folders, "publish", publish)
        elt.run(spark, root, "r3")
        return publish(*args)

    monkeypatch.setattr(folders, "publish", after_the_other)
    with pytest.raises(RuntimeError, match="by another run"):
        elt.run(spark, root, "r2")
    assert elt.latest(spark, root).count() == 12 and elt.changes_of(spark, root, "r2").isEmpty()
    assert counts(elt.run(spark, root, "r2")) == (5, 0, 5)
    assert elt.latest(spark, root).count() == 12


def test_a_name_is_given_once(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "rows").write_text(name)
    assert folders.publish(spark, str(tmp_path / "a"), str(tmp_path / "out" / "version=1"))
    assert not folders.publish(spark, str(tmp_path / "b"), str(tmp_path / "out" / "version=1"))
    assert (tmp_path / "out" / "version=1" / "rows").read_text() == "a"
    assert not (tmp_path / "out" / "version=1" / "b").exists()


class Lost(Exception):
    """The driver is gone."""


STEPS = ["cdc", "latest", "/tenants", "publish", "_remove_replaced", "remove_old"]


@pytest.mark.parametrize("step", STEPS)
def test_a_driver_lost_at_any_step(spark, tmp_path, monkeypatch, step):
    """Whatever step it was lost after, the same call and those of others go on, with the results of a whole run."""
    root = str(tmp_path)
    elt.load(users(spark, 0, 20).unionByName(users(spark, 0, 10, "org-002", "int-2")), root, "r1")
    elt.run(spark, root, "r1")
    first = snapshot(spark, root)
    elt.load(users(spark, 1505, 20).unionByName(users(spark, 0, 10, "org-002", "int-2")), root, "r2")
    with monkeypatch.context() as patch:
        def lost_after(real):
            def write(df, path, *args):
                real(df, path, *args)
                if re.search(f"{step}$", path):
                    raise Lost
            return write

        def lost(*args):
            raise Lost

        patch.setattr(elt, "recreate", lost_after(elt.recreate))
        patch.setattr(elt, "replace_slice", lost_after(elt.replace_slice))
        if step == "publish":
            patch.setattr(folders, "publish", lost)
        elif step in ("_remove_replaced", "remove_old"):
            patch.setattr(elt, step, lost)
        with pytest.raises(Lost):
            elt.run(spark, root, "r2")
    published = step in ("_remove_replaced", "remove_old")
    assert (snapshot(spark, root) == first) == (not published) and elt.changes_of(spark, root, "r2").isEmpty() == (not published)
    # another run for another tenant goes on, then the lost one is called again
    elt.load(users(spark, 3, 10, "org-003", "int-3"), root, "r3")
    assert counts(elt.run(spark, root, "r3")) == (10, 0, 0)
    assert counts(elt.run(spark, root, "r2")) == (5, 15, 5)
    assert elt.changes_of(spark, root, "r2").count() == 25 and elt.latest(spark, root).count() == 40
    lost_ones = elt.remove_unpublished(spark, root, -1)
    assert len(lost_ones) == (not published)
    attempts = {p.name for p in pathlib.Path(root).rglob("attempt=*")}
    assert not any(f"attempt={a}" in attempts for a in lost_ones) and elt.remove_unpublished(spark, root, -1) == []
    assert elt.latest(spark, root).count() == 40 and elt.changes_of(spark, root, "r2").count() == 25


def test_a_run_whose_base_is_gone_cannot_be_repeated(spark, tmp_path):
    root = str(tmp_path)
    elt.load(users(spark, 0, 10), root, "r1")
    elt.run(spark, root, "r1", keep_versions=1)
    elt.load(users(spark, 1505, 10), root, "r2")
    elt.run(spark, root, "r2", keep_versions=1)
    for n in range(3, 5):
        elt.load(users(spark, n, 5, "org-002", "int-2"), root, f"r{n}")
        elt.run(spark, root, f"r{n}", keep_versions=1)
    before = snapshot(spark, root), sorted(map(repr, elt.changes_of(spark, root, "r2").collect()))
    with pytest.raises(ValueError, match="no longer kept"):
        elt.run(spark, root, "r2", keep_versions=1)
    with pytest.raises(ValueError, match="later runs build on it"):
        elt.run(spark, root, "r1", keep_versions=1)
    assert (snapshot(spark, root), sorted(map(repr, elt.changes_of(spark, root, "r2").collect()))) == before


def test_what_is_read_does_not_grow_with_the_versions(spark, tmp_path):
    root = str(tmp_path)
    for n in range(6):
        elt.load(users(spark, n, 4), root, f"r{n}")
        elt.run(spark, root, f"r{n}", keep_versions=2)
    assert [n for n in folders.names(spark, f"{root}/published") if n.startswith("version=")] == ["version=5", "version=6"]
    assert folders.names(spark, f"{root}/published/pending") == [] == folders.names(spark, f"{root}/work")
    assert spark.read.parquet(f"{root}/published/version=6/tenants").count() == 1
    for n in range(6):  # the changes of old runs stay readable
        assert elt.changes_of(spark, root, f"r{n}").count() == (4 if n == 0 else 2)


def test_lost_rows_do_not_reconcile(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    elt.load(users(spark, 0, 20), root, "r1")
    whole = cdc.detect_changes
    monkeypatch.setattr(cdc, "detect_changes", lambda *a, **k: whole(*a, **k).limit(15))
    with pytest.raises(ValueError, match="do not reconcile"):
        elt.run(spark, root, "r1")


def test_old_versions_are_removed(spark, tmp_path):
    root = str(tmp_path)
    for n in range(5):
        elt.load(users(spark, n, 5).unionByName(users(spark, 0, 5, "org-002", "int-2")), root, f"r{n}")
        elt.run(spark, root, f"r{n}", keep_versions=2)
    assert elt.latest(spark, root).count() == 10 and elt.latest(spark, root, 4).count() == 10
    assert len(folders.names(spark, f"{root}/latest/organization_id=org-001")) == 2
    assert len(folders.names(spark, f"{root}/latest/organization_id=org-002")) == 1
    assert [n for n in folders.names(spark, f"{root}/published") if n.startswith("version=")] == ["version=4", "version=5"]


def test_extract_load_and_run(spark, tmp_path):
    root = str(tmp_path)
    integrations = spark.createDataFrame(
        [("org-001", "int-1", 3), ("org-002", "int-2", 1), ("org-003", "int-3", 0)], ", ".join(f"{c} string" for c in TENANT) + ", pages int")

    def fetch(request):
        ids = [f"{request['organization_id']}-{request['page']}-{n}" for n in range(4)]
        return pd.DataFrame({"id": ids, "external_id": ids, "organization_id": request["organization_id"],
                             "connected_integration_id": request["connected_integration_id"], "name": "n", "email": "e"})

    scope = elt.extract(integrations, fetch, root, "r1")
    report = elt.run(spark, root, "r1", tenants=scope)
    assert counts(report) == (16, 0, 0) and scope.count() == 3
    gone = elt.extract(integrations.withColumn("pages", F.col("pages") - 1), fetch, root, "r2")
    assert counts(elt.run(spark, root, "r2", tenants=gone)) == (0, 0, 8)
    assert elt.latest(spark, root).count() == 8


def test_first_run_of_a_large_tenant(spark, tmp_path):
    root = str(tmp_path)
    for batch in range(10):
        elt.load(users(spark, batch * 100, 100), root, "r", batch)
    report = elt.run(spark, root, "r")
    assert counts(report) == (1000, 0, 0)
    assert report.reconciliation.where("not ok").count() == 0


def test_tenants_and_guard(spark, tmp_path):
    root = str(tmp_path)
    two = users(spark, 0, 20).unionByName(users(spark, 0, 20, "org-002", "int-2"))
    elt.load(two, root, "r1")
    assert counts(elt.run(spark, root, "r1")) == (40, 0, 0)
    only = tenants(spark, ("org-001", "int-1"))
    with pytest.raises(ValueError, match="too many deletes"):
        elt.run(spark, root, "r2", tenants=only, max_delete_fraction=0.5)
    assert elt.latest(spark, root).count() == 40
    assert counts(elt.run(spark, root, "r2", tenants=only)) == (0, 0, 20)
    assert [r.organization_id for r in elt.latest(spark, root).select("organization_id").distinct().collect()] == ["org-002"]
    with pytest.raises(ValueError, match="cannot be repeated"):
        elt.run(spark, root, "r1")


def test_import_people(spark, tmp_path):
    from tests.test_sources import PERSON

    source = tmp_path / "in"
    source.mkdir()
    bad = json.loads(json.dumps(PERSON))
    bad["dob"]["age"] = "old"
    partly = json.dumps({"results": [PERSON, bad], "info": {}})
    lines = [json.dumps({"results": [PERSON, PERSON], "info": {}}), "{broken", json.dumps({"results": []}), partly]
    (source / "part.json").write_text("\n".join(lines))
    imports.import_people(spark, str(source), str(tmp_path / "people"), str(tmp_path / "errors"))
    people = spark.read.parquet(str(tmp_path / "people"))
    assert people.count() == 2 and people.select("id").distinct().count() == 2
    errors = spark.read.parquet(str(tmp_path / "errors")).collect()
    assert sorted(json.loads(e.message)["error"] for e in errors) == sorted(["{broken", partly])


def test_a_partly_bad_file_is_one_error(spark, tmp_path):
    from tests.test_sources import PERSON

    bad = json.loads(json.dumps(PERSON))
    bad["location"]["street"]["number"] = "twelve"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "good.json").write_text(json.dumps({"results": [PERSON], "info": {}}, indent=1))
    (tmp_path / "in" / "bad.json").write_text(json.dumps({"results": [PERSON, bad], "info": {}}, indent=1))
    imports.import_people(spark, str(tmp_path / "in"), str(tmp_path / "people"), str(tmp_path / "errors"), multi_line=True)
    assert spark.read.parquet(str(tmp_path / "people")).count() == 1 == spark.read.parquet(str(tmp_path / "errors")).count()


def test_accept_requests(spark, rows):
    schema = "id string, user_id string, access_id string, status string"
    requests = spark.createDataFrame([
        ("1", "u1", "a1", "requested"), ("2", "u9", "a1", "requested"), ("3", "u1", "a9", "approved"),
        ("4", "u1", "a1", "CANCELLED"), ("5", "u1", "a1", None), ("6", "u1", "a1", "canceled"),
    ], schema)
    users_df = spark.createDataFrame([("u1",), ("u2",)], "id string")
    accesses = spark.createDataFrame([("a1",)], "id string")
    existing = spark.createDataFrame([("6",)], "id string")
    valid, rejected = imports.accept_requests(requests, users_df, accesses, existing)
    assert rows(valid, "id") == [("1",)]
    assert rows(rejected, "id", "message") == [
        ("2", "user_id u9 does not exist"), ("3", "access_id a9 does not exist"),
        ("4", "invalid status: CANCELLED"), ("5", "invalid status: null"),
    ]


def test_a_table_that_is_not_there_is_known_to_be_empty(spark, tmp_path):
    """A first run has nothing to compare with: only the staged rows are shuffled."""
    nothing = elt._read(spark, str(tmp_path / "latest"), elt._LATEST)
    both = users(spark, 0, 5).join(nothing.withColumnRenamed("id", "other"), F.col("id") == F.col("other"), "full_outer")
    plan = both._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and both.count() == 5 and nothing.count() == 0
