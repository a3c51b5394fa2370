"""Writing tables so that a repeated run leaves the same rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.hashing import content_hash
from millrace.schemas import HASH_OF
from millrace.sinks import folders

#: Ids and hashes take half the room of Spark's default.
COMPRESSION = "zstd"
MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def staged(
    users: DataFrame, workflow_id: str | Column, batch_seq: Column | int = 0,
    created_at: Column | None = None,
) -> DataFrame:
    """Extracted users as staging rows: run id, content hash, load time and batch number.

    ``current_timestamp`` is one value per query; ``batch_seq`` orders the loads of a run.
    """
    run = F.lit(workflow_id) if isinstance(workflow_id, str) else workflow_id
    seq = F.lit(batch_seq) if isinstance(batch_seq, int) else batch_seq
    at = F.current_timestamp() if created_at is None else created_at
    return users.select(
        "id", run.alias("workflow_id"), "external_id", "organization_id",
        "connected_integration_id", "name", "email",
        content_hash(*HASH_OF).alias("content_hash"),
        at.cast("timestamp_ntz").alias("created_at"), seq.cast("bigint").alias("batch_seq"),
    )


def append_batch(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Add the rows; a retry adds them again, which deduplication takes care of."""
    df.write.mode("append").option("compression", COMPRESSION).partitionBy(*partition_by).parquet(path)


def replace_slice(df: DataFrame, path: str, partition_by: Sequence[str], hash_of: Sequence[str] = ()) -> None:
    """Replace the partitions that ``df`` holds rows for and leave the others alone.

    Rows are brought together by partition, so that not every task writes a file into every folder;
    the rebalancing splits a partition that holds much of the data over several tasks. With ``hash_of``, the column
    ``content_hash`` is that of those columns and is taken afterwards, so it is not shuffled.
    """
    columns = df.columns
    laid = (df.drop("content_hash") if hash_of else df).hint("rebalance", *partition_by)
    if hash_of:
        laid = laid.withColumn("content_hash", content_hash(*hash_of)).select(*columns)
    (
        laid.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", COMPRESSION)
        .partitionBy(*partition_by).parquet(path)
    )


def replace_run(df: DataFrame, path: str, partition_by: Sequence[str] = (), **slice_) -> None:
    """Replace all rows of one slice, such as a run or a run and tenant, also when the new result is empty.

    The slice (``workflow_id="w"``, ``organization_id="o"``, ...) is a folder of the table, in the order given, so
    writing it anew clears what an earlier try left there. Values may hold any sign.
    """
    folder = folders.partition_folder(df.sparkSession, **slice_)
    recreate(df.drop(*slice_), f"{path}/{folder}", partition_by)


def truncate(df_like: DataFrame, path: str) -> None:
    """Leave an empty table of the same columns."""
    (
        df_like.limit(0).write.mode("overwrite").option("partitionOverwriteMode", "static")
        .parquet(path)
    )


def recreate(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Drop whatever is there and write the rows."""
    laid = df.hint("rebalance", *partition_by) if partition_by else df
    (
        laid.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", COMPRESSION)
        .partitionBy(*partition_by).parquet(path)
    )


def json_log_lines(
    df: DataFrame, path: str, level: str = "levelname", at: str = "asctime"
) -> None:
    """One JSON object per row; the level is written as severity and the time as timestamp."""
    renamed = df.withColumnsRenamed({level: "severity", at: "timestamp"})
    line = F.to_json(F.struct(*renamed.columns), {"timestampNTZFormat": MICROS, "timestampFormat": MICROS})
    renamed.select(line.alias("value")).write.mode("overwrite").text(path)
