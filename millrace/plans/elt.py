"""One run of the tenant pipeline: extract, stage, detect, apply, reconcile, publish.

All tenants of a run go through one set of jobs. A run may be made of several calls, each for some of its tenants;
what is replaced when a call is repeated is the slice of one run and tenant. Tables below ``root``:

``staging``    extracted rows, duplicates of retries included, one folder per run
``cdc``        changes, one folder per run, attempt, organization and integration
``latest``     snapshot rows, one folder per organization and attempt; a run writes anew only the organizations
               that it changes, and a folder is never written again
``published``  one folder per version, made ready under ``pending`` and published by giving it its name, in one step:
               which attempt holds each organization (``places``), what the version is about (``covered``), its counts
               (``reconciled``), and the last version of each tenant (``tenants``). Of versions that are removed,
               what they were about stays in ``runs``, one folder per run

What an attempt writes counts from the moment its version has its name: a driver lost before leaves folders that
nobody reads (see :func:`remove_unpublished`), one lost afterwards nothing to mend. Either way the call can be repeated.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace import schemas
from millrace.operators import cdc
from millrace.operators.dedup import unique_count
from millrace.operators.jobs import run_summary
from millrace.operators.joins import within, without
from millrace.schemas import TENANT
from millrace.sinks import folders
from millrace.sinks.tables import append_batch, recreate, replace_slice, staged
from millrace.sources.paged import page_plan, paged_extract

STAGED_ORDER = ("created_at", "batch_seq")
_TENANT_SCHEMA = ", ".join(f"{c} string" for c in TENANT)
_PLACES = "organization_id string, attempt string"
_COVERED = f"version bigint, attempt string, workflow_id string, {_TENANT_SCHEMA}, base bigint"
_TENANTS = f"{_TENANT_SCHEMA}, last bigint"
_LATEST = f"{schemas.USERS_LATEST}, attempt string"
_CHANGES = f"{schemas.USERS_CDC}, attempt string"


@dataclass(frozen=True)
class RunReport:
    """Frames about a finished run; each is computed when it is used."""

    loaded: DataFrame
    changes: DataFrame
    reconciliation: DataFrame

    @property
    def counts(self) -> DataFrame:
        return cdc.change_counts(self.changes, TENANT)

    @property
    def summary(self) -> DataFrame:
        return summary(self.loaded, self.changes)


def _empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema).limit(0)


def _read(spark: SparkSession, path: str, schema: str, part: str = "") -> DataFrame:
    """A table, or one folder of it, with the columns its folders stand for.

    One that is not there is known to be empty while a plan is made, so nothing is shuffled to be joined with it.
    """
    whole = f"{path}/{part}" if part else path
    if not folders.exists(spark, whole):
        return _empty(spark, schema)
    return spark.read.schema(schema).option("basePath", path).parquet(whole)


def _versions(spark: SparkSession, root: str) -> list[int]:
    """The versions that are kept."""
    return sorted(int(n.split("=")[1]) for n in folders.names(spark, f"{root}/published") if n.startswith("version="))


def _newest(spark: SparkSession, root: str) -> int:
    """The newest published version, 0 if there is none."""
    return max(_versions(spark, root), default=0)


def _of_version(spark: SparkSession, root: str, version: int, name: str, schema: str) -> DataFrame:
    return _read(spark, f"{root}/published/version={version}/{name}", schema)


def _places(spark: SparkSession, root: str, version: int) -> DataFrame:
    return _of_version(spark, root, version, "places", _PLACES)


def _covered(spark: SparkSession, root: str, workflow_id: str) -> DataFrame:
    """What the published calls of a run were about, from the kept versions and the folder of the run."""
    kept = [f"{root}/published/version={v}/covered" for v in _versions(spark, root)]
    rows = spark.read.schema(_COVERED).parquet(*kept) if kept else _empty(spark, _COVERED)
    own = folders.partition_folder(spark, workflow_id=workflow_id)
    return rows.where(F.col("workflow_id") == workflow_id).unionByName(_read(spark, f"{root}/published/runs", _COVERED, own))


def _attempts(spark: SparkSession, root: str, workflow_id: str) -> DataFrame:
    """Which attempt holds the changes of each tenant of a run."""
    return _covered(spark, root, workflow_id).groupBy(*TENANT).agg(F.max_by("attempt", "version").alias("attempt"))


def _rows(spark: SparkSession, root: str, places: DataFrame) -> DataFrame:
    """Snapshot rows of the organizations and attempts in ``places``; other folders are not read."""
    rows = _read(spark, f"{root}/latest", _LATEST)
    named = places.where("organization_id IS NOT NULL").select(F.col("organization_id").alias("_org"), F.col("attempt").alias("_attempt"))
    found = rows.join(named, (rows["organization_id"] == named["_org"]) & (rows["attempt"] == named["_attempt"]), "left_semi")
    # an organization without a name cannot be looked up by equality
    bare = places.where("organization_id IS NULL").select(F.col("attempt").alias("_attempt"))
    lost = rows.where("organization_id IS NULL").join(bare, rows["attempt"] == bare["_attempt"], "left_semi")
    return found.unionByName(lost).drop("attempt")


def latest(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The newest published snapshot, or an older one that is still kept."""
    version = _newest(spark, root) if version is None else version
    columns = [f.name for f in spark.createDataFrame([], schemas.USERS_LATEST).schema]
    return _rows(spark, root, _places(spark, root, version)).select(*columns)


def load(users: DataFrame, root: str, workflow_id: str, batch_seq: int = 0) -> None:
    """Stage one extracted batch; calling it again for the same batch is allowed."""
    append_batch(staged(users, workflow_id, batch_seq), f"{root}/staging", ["workflow_id"])


def extract(
    integrations: DataFrame, fetch: Callable[[Mapping], pd.DataFrame | list[dict]], root: str, workflow_id: str, *,
    pages: str = "pages", pages_per_batch: int = 10, requests_in_parallel: int | None = None,
    bodies: DataFrame | None = None, records: bool = False,
) -> DataFrame:
    """Fetch and stage all pages of all connected integrations; returns the tenants of the run.

    ``integrations`` has the tenant columns and the number of its pages; ``fetch`` answers one row of the plan.
    Pages that are stored already come as ``bodies`` (tenant, page, body) and travel with the plan. ``records`` is that of
    :func:`millrace.sources.paged.paged_extract`.
    A tenant without pages is part of the run: its rows are gone.
    """
    plan = page_plan(integrations, pages, pages_per_batch, bodies=bodies, tenant=TENANT)
    rows = paged_extract(plan, fetch, schemas.EXTRACTED_USER, requests_in_parallel=requests_in_parallel, records=records)
    load(rows, root, workflow_id)
    return integrations.select(*TENANT).distinct()


def staging_of(spark: SparkSession, root: str, workflow_id: str) -> DataFrame:
    """Rows of one run; the run is a folder, so other runs are not read."""
    return _read(spark, f"{root}/staging", schemas.USERS_STAGING, folders.partition_folder(spark, workflow_id=workflow_id))


def changes_of(spark: SparkSession, root: str, workflow_id: str) -> DataFrame:
    """The published changes of a run."""
    rows = _read(spark, f"{root}/cdc", _CHANGES, folders.partition_folder(spark, workflow_id=workflow_id))
    return within(rows, _attempts(spark, root, workflow_id), [*TENANT, "attempt"]).drop("attempt")


def run(
    spark: SparkSession,
    root: str,
    workflow_id: str,
    tenants: DataFrame | None = None,
    max_delete_fraction: float | None = None,
    keep_versions: int = 10,
) -> RunReport:
    """Bring the latest snapshot up to the staged rows of the run.

    ``tenants`` are the tenants of this call (see :func:`millrace.operators.cdc.detect_changes`), by default those
    that have staged rows. Repeating a call starts, for each tenant, from the version its first call started from, so
    it finds the same changes; a tenant that a later run has changed cannot be repeated.
    ``max_delete_fraction`` stops the run when a tenant would lose more than that share of its rows.
    Versions older than the last ``keep_versions`` are removed, with folders that only they use; a run that started
    from a removed version cannot be repeated.
    """
    attempt = uuid.uuid4().hex
    work, ready = f"{root}/work/{attempt}", f"{root}/published/pending/{attempt}"
    folders.make(spark, ready)
    kept = _versions(spark, root)
    newest = max(kept, default=0)
    loaded = staging_of(spark, root, workflow_id)
    given = (loaded if tenants is None else tenants).select(*TENANT).distinct()
    mine = _covered(spark, root, workflow_id).groupBy(*TENANT).agg(F.min("base").alias("base"), F.max("version").alias("own"))
    last = _of_version(spark, root, newest, "tenants", _TENANTS)
    marked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (given.withColumn("_given", F.lit(True)), mine, last))
    scope = marked.groupBy(*TENANT).agg(*[F.max(c).alias(c) for c in ("_given", "base", "own", "last")]).where("_given").select(
        *TENANT, F.coalesce("base", F.lit(newest)).cast("bigint").alias("base"), (F.col("own") < F.col("last")).alias("_later"))
    recreate(scope, f"{work}/scope")
    scope = spark.read.schema(scope.schema).parquet(f"{work}/scope")
    if not scope.where("_later").isEmpty():
        raise ValueError(f"run {workflow_id} cannot be repeated: later runs build on it")
    bases = [r["base"] for r in scope.select("base").distinct().collect()]
    if not {0, *kept}.issuperset(bases):
        raise ValueError(f"run {workflow_id} cannot be repeated: a version it started from is no longer kept")

    # the rows of each tenant as they were in the version it starts from
    parts = [within(_rows(spark, root, _places(spark, root, base)), scope.where(F.col("base") == base), TENANT) for base in bases]
    before = reduce(DataFrame.unionByName, parts, _empty(spark, schemas.USERS_LATEST))
    found = cdc.detect_changes(
        loaded, before.drop("last_updated"), newest=STAGED_ORDER, tenants=scope.select(*TENANT), hash_of=schemas.HASH_OF,
    ).withColumns({
        "workflow_id": F.lit(workflow_id), "attempt": F.lit(attempt),
        "detected_at": F.current_timestamp().cast("timestamp_ntz"),
    })
    replace_slice(found, f"{root}/cdc", ["workflow_id", "attempt", *TENANT], schemas.HASH_OF)
    changes = _read(spark, f"{root}/cdc", _CHANGES, folders.partition_folder(spark, workflow_id=workflow_id, attempt=attempt)).drop("attempt")

    if max_delete_fraction is not None:
        excess = cdc.excess_deletes(changes, before, max_delete_fraction).take(5)
        if excess:
            raise ValueError(f"too many deletes, extract may be partial: {excess}")

    # a changed row's time of update is the time its change was detected
    dated = changes.withColumn("last_updated", F.col("detected_at"))
    target = newest + 1
    now = _places(spark, root, newest)
    repeated = scope.where(F.col("base") < newest)
    touched = changes.select("organization_id").unionByName(repeated.select("organization_id")).distinct()
    recreate(touched, f"{work}/touched")
    touched = spark.read.schema(touched.schema).parquet(f"{work}/touched")
    others = without(_rows(spark, root, within(now, touched, ["organization_id"])), scope, TENANT)
    mine_after = within(cdc.apply_changes(before, dated, hash_of=schemas.HASH_OF), touched, ["organization_id"])
    written = others.unionByName(mine_after).withColumn("attempt", F.lit(attempt))
    replace_slice(written, f"{root}/latest", ["organization_id", "attempt"], schemas.HASH_OF)
    fresh = _read(spark, f"{root}/latest", _LATEST).where(F.col("attempt") == attempt).select("organization_id").distinct()
    places = without(now, touched, ["organization_id"]).unionByName(fresh.withColumn("attempt", F.lit(attempt)))
    recreate(places, f"{ready}/places")
    places = _read(spark, f"{ready}/places", _PLACES)

    after = within(_rows(spark, root, places), scope, TENANT)
    unique = within(loaded, scope, TENANT).select(*schemas.USER_KEYS).distinct()
    recreate(cdc.reconcile(before, changes, after, staged=unique), f"{ready}/reconciled")
    if not spark.read.parquet(f"{ready}/reconciled").where(~F.col("ok")).isEmpty():
        raise ValueError(f"run {workflow_id}: counts of staged rows, changes and snapshot do not reconcile")

    covered = scope.select(F.lit(target).cast("bigint").alias("version"), F.lit(attempt).alias("attempt"),
                           F.lit(workflow_id).alias("workflow_id"), *TENANT, "base")
    recreate(covered, f"{ready}/covered")
    recreate(without(last, scope, TENANT).unionByName(covered.select(*TENANT, F.col("version").alias("last"))), f"{ready}/tenants")
    if not folders.publish(spark, ready, f"{root}/published/version={target}"):
        folders.remove(spark, ready)
        raise RuntimeError(f"version {target} was published by another run meanwhile; run {workflow_id} again")
    _remove_replaced(spark, root, workflow_id)
    remove_old(spark, root, keep_versions)
    folders.remove(spark, work)
    final = _of_version(spark, root, target, "covered", _COVERED)
    return RunReport(loaded, within(changes_of(spark, root, workflow_id), final, TENANT),
                     spark.read.parquet(f"{root}/published/version={target}/reconciled"))


def _remove_replaced(spark: SparkSession, root: str, workflow_id: str) -> None:
    """Remove changes of attempts of a run that a repeated call has replaced; those under way are left alone."""
    pending = folders.names(spark, f"{root}/published/pending")
    path = f"{root}/cdc/" + folders.partition_folder(spark, workflow_id=workflow_id)
    there = {n.removeprefix("attempt="): n for n in folders.names(spark, path)}
    if len(there) > 1:
        # one row for each call of the run at most
        used = {r[0] for r in _attempts(spark, root, workflow_id).select("attempt").distinct().collect()}
        for attempt in there.keys() - used - set(pending):
            folders.remove(spark, f"{path}/{there[attempt]}")


def remove_old(spark: SparkSession, root: str, keep_versions: int) -> None:
    """Remove versions older than the last ``keep_versions``, and snapshot folders that only those use.

    What they were about goes to the folders of their runs first; doing it again leaves the same rows there.
    """
    versions = _versions(spark, root)
    old = [v for v in versions if v <= versions[-1] - keep_versions] if versions else []
    if not old:
        return
    covered, places = ([f"{root}/published/version={v}/{name}" for v in old] for name in ("covered", "places"))
    replace_slice(spark.read.schema(_COVERED).parquet(*covered), f"{root}/published/runs", ["workflow_id", "version"])
    kept = reduce(DataFrame.unionByName, (_places(spark, root, v) for v in versions if v not in old))
    unused = without(spark.read.schema(_PLACES).parquet(*places).distinct(), kept, ["organization_id", "attempt"])
    for r in unused.toLocalIterator():
        folders.remove(spark, f"{root}/latest/" + folders.partition_folder(spark, organization_id=r[0], attempt=r[1]))
    for v in old:
        folders.remove(spark, f"{root}/published/version={v}")


def remove_unpublished(spark: SparkSession, root: str, older_than_seconds: float) -> list[str]:
    """Remove what attempts left behind whose drivers were lost; returns their names.

    An attempt counts as lost if nothing was added to its version for that long; choose more than a run may take.
    """
    pending = f"{root}/published/pending"
    lost = [a for a in folders.names(spark, pending) if folders.age_seconds(spark, f"{pending}/{a}") > older_than_seconds]
    for attempt in lost:
        for pattern in (f"{root}/latest/*/attempt={attempt}", f"{root}/cdc/*/attempt={attempt}", f"{root}/work/{attempt}", f"{pending}/{attempt}"):
            folders.remove_matching(spark, pattern)
    return lost


def summary(loaded: DataFrame, changes: DataFrame) -> DataFrame:
    """Rows loaded, unique rows and changes per integration, per organization and in total."""
    by = list(TENANT)
    zero = F.lit(0).cast("bigint")
    rows = loaded.groupBy(*by).agg(F.count(F.lit(1)).alias("loaded"))
    unique = unique_count(loaded, [*schemas.USER_KEYS, "workflow_id"], by)
    counts = cdc.change_counts(changes, by)
    names = ("loaded", "unique_count", "inserts", "updates", "deletes")
    parts = [
        part.select(*by, *[F.col(n) if n in part.columns else zero.alias(n) for n in names])
        for part in (rows, unique, counts)
    ]
    together = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return run_summary(together, by, {n: F.sum(n) for n in names})
