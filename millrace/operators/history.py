"""The change log as history: rows with the runs they were valid from and to, and the snapshot as of any run.

Runs are numbered. A row that run m brought and run n changed or deleted is valid from m, to n. Tables below ``path``:

``closed``  rows that are over, one folder for each run that ended them; never written again, except when
            their run is repeated
``open``    rows that are still valid after a run, one folder a run, of which the last two are kept
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from millrace.functions.hashing import content_hash
from millrace.operators.cdc import DELETE
from millrace.operators.joins import record_key
from millrace.schemas import USER_KEYS
from millrace.sinks import folders
from millrace.sinks.tables import recreate

FROM, TO = "valid_from", "valid_to"


def intervals(log: DataFrame, version: str, keys: Sequence[str] = USER_KEYS) -> DataFrame:
    """The whole log at once: its rows with ``valid_from`` and ``valid_to``, null where they are still valid.

    ``log`` holds at most one change of a key and run. A key's changes meet in one task, one for each run at most.
    """
    ends = F.lead(version).over(Window.partitionBy(record_key(keys)).orderBy(version))
    return log.withColumn(TO, ends).where(F.col("change_type") != DELETE).drop("change_type").withColumnRenamed(version, FROM)


def as_of(rows: DataFrame, version: int) -> DataFrame:
    """The snapshot that rows with their times give for a version."""
    return rows.where((F.col(FROM) <= version) & (F.col(TO).isNull() | (F.col(TO) > version))).drop(FROM, TO)


def _folder(path: str, kind: str, version: int) -> str:
    return f"{path}/{kind}/version={version}"


def _versions(spark: SparkSession, path: str, kind: str) -> list[int]:
    return sorted(int(n.split("=")[1]) for n in folders.names(spark, f"{path}/{kind}") if n.startswith("version="))


def record(changes: DataFrame, path: str, version: int, keys: Sequence[str] = USER_KEYS, hash_of: Sequence[str] = ()) -> None:
    """Add the changes of one run; runs come in order, and repeating the last one leaves the same tables.

    The rows still open meet the changes in one join; what is over is not read. With ``hash_of``, the column
    ``content_hash`` is that of those columns and is taken after the join instead of being shuffled.
    """
    spark = changes.sparkSession
    known = _versions(spark, path, "open")
    if any(v > version for v in known):
        raise ValueError(f"run {version} comes after run {known[-1]}, which was recorded before")
    before = max((v for v in known if v < version), default=None)
    new = changes.where(F.col("change_type") != DELETE).drop("change_type").withColumn(FROM, F.lit(version).cast("long"))
    if before is None:
        recreate(new, _folder(path, "open", version))
        recreate(new.limit(0).withColumn(TO, F.lit(version).cast("long")), _folder(path, "closed", version))
        return
    still = spark.read.parquet(_folder(path, "open", before)).withColumn("_key", record_key(keys))
    changed = changes.select(record_key(keys).alias("_changed"))
    ended = F.col("_changed").isNotNull()
    both = still.join(changed, F.col("_key") == F.col("_changed"), "left")
    columns = new.columns
    if hash_of:
        columns = [content_hash(*hash_of).alias(c) if c == "content_hash" else c for c in columns]
    recreate(both.where(ended).select(*columns, F.lit(version).cast("long").alias(TO)), _folder(path, "closed", version))
    recreate(both.where(~ended).select(*columns).unionByName(new), _folder(path, "open", version))
    for v in known:
        if v < before:
            folders.remove(spark, _folder(path, "open", v))


def recorded(spark: SparkSession, path: str) -> DataFrame:
    """All rows with their times."""
    newest = _versions(spark, path, "open")[-1]
    still = spark.read.parquet(_folder(path, "open", newest)).withColumn(TO, F.lit(None).cast("long"))
    return still.unionByName(spark.read.parquet(*(_folder(path, "closed", v) for v in _versions(spark, path, "closed"))))


def snapshot(spark: SparkSession, path: str, version: int) -> DataFrame:
    """The snapshot after a run: of the rows that are over, only those that later runs ended are read."""
    newest = _versions(spark, path, "open")[-1]
    rows = spark.read.parquet(_folder(path, "open", newest)).withColumn(TO, F.lit(None).cast("long"))
    later = [_folder(path, "closed", v) for v in _versions(spark, path, "closed") if v > version]
    return as_of(rows.unionByName(spark.read.parquet(*later)) if later else rows, version)
