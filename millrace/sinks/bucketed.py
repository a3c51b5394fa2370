"""Snapshots stored in buckets of their record key, so that comparing them with an extract shuffles the extract only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.joins import PlainKey
from millrace.schemas import USER_KEYS
from millrace.sinks import folders
from millrace.sinks.tables import COMPRESSION


#: Rows that one task compares; some hundred bytes each, with those of the extract.
ROWS_PER_BUCKET = 1_000_000


def buckets_for(rows: int, at_least: int = 1) -> int:
    """How many buckets a snapshot takes that is compared with an extract, by the rows of the larger of both."""
    return max(at_least, -(-rows // ROWS_PER_BUCKET))


def store_snapshot(latest: DataFrame, table: str, path: str, buckets: int, keys: Sequence[str] = USER_KEYS) -> DataFrame:
    """Write a snapshot as a table in ``buckets`` files' worth of buckets at ``path``, and read it.

    The table has the columns of the snapshot and those of its plain key (see :class:`PlainKey`), which rows are dealt
    and sorted by. Choose as many buckets as make tasks of some hundred megabytes (:func:`buckets_for`); a
    snapshot that grew out of them is stored anew. A folder is written once: the next snapshot goes to another path under another name.
    """
    spark, key = latest.sparkSession, PlainKey(latest, keys)
    if folders.exists(spark, path):
        raise ValueError(f"{path} is there already")
    dealt = latest.select(*key.columns(), *latest.columns).repartition(buckets, *key.names)
    dealt.write.bucketBy(buckets, *key.names).sortBy(*key.names).option("path", path).option("compression", COMPRESSION).format("parquet").saveAsTable(table)
    return spark.table(table)


def forget_snapshot(spark: SparkSession, table: str, path: str) -> None:
    """Remove a snapshot that is no longer needed: its name and its files."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    folders.remove(spark, path)
