"""Change capture on a stream, with its state in tables.

State is written per micro-batch and read from the previous batch's folder, so a batch that is
repeated after a failure starts from the same state and writes the same results.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.operators import cdc
from millrace.operators.joins import within
from millrace.schemas import TENANT, USER_KEYS
from millrace.sinks import folders
from millrace.sinks.tables import COMPRESSION
from millrace.streaming.base import append_log, batch_folder, batches_of, read_log


def state_after(
    spark: SparkSession, base: DataFrame, log_path: str, before_batch: int,
    keys: Sequence[str] = USER_KEYS, tenants: DataFrame | None = None, hash_of: Sequence[str] = (),
) -> DataFrame:
    """The snapshot after all batches before ``before_batch``: base with the newest changes.

    With ``tenants``, a frame of distinct tenants, only their rows are read and put together.
    """
    names = tenants.columns if tenants is not None else []
    if names:
        base = within(base, tenants, names)
    if before_batch <= 0 or not any(batches_of(spark, p) for p in (log_path, f"{log_path}-state")):
        return base
    log = read_log(spark, log_path).where(F.col("batch_id") < before_batch)
    if names:
        log = within(log, tenants, names)
    return cdc.apply_changes(base, log, keys=keys, newest=["batch_id"], hash_of=hash_of)


EXTRACT, END = "extract_id", "end_of_extract"


def capture_changes(
    base: Callable[[SparkSession], DataFrame], path: str, *, newest: Sequence[str],
    keys: Sequence[str] = USER_KEYS, tenant: Sequence[str] = TENANT, every: int = 20, hash_of: Sequence[str] = (),
) -> Callable[[DataFrame, int], None]:
    """Handler that turns a stream of extracts into changes of the snapshot.

    Rows carry the tenant, the id of their extract (later extracts have larger ids) and ``end_of_extract``, which is
    true in one row without a record that follows the last record. An extract may come in any number of micro-batches:
    its rows wait in ``path/staged`` and are compared when its end has come, so no row counts as missing before.
    Of several extracts of a tenant that end in one micro-batch the latest counts.

    Changes go to ``path/changes`` under the batch id as run id, :func:`state_after` is the result. Staged batches
    whose extracts have all ended are removed, and the log of changes is summed up every ``every`` batches. ``hash_of`` is that of
    :func:`millrace.operators.cdc.detect_changes`.
    """
    staged, ended = f"{path}/staged", f"{path}/ended"
    write = append_log(f"{path}/changes", keys=keys, every=every)

    def detect(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        named = [*tenant, EXTRACT]
        # a hash that follows from other columns need not wait with the rows
        batch.where(f"NOT {END}").drop(END, *(["content_hash"] if hash_of else [])).write.mode("overwrite").option("compression", COMPRESSION).parquet(batch_folder(staged, batch_id))
        batch.where(END).select(*named).distinct().write.mode("overwrite").parquet(batch_folder(ended, batch_id))
        ends = spark.read.parquet(batch_folder(ended, batch_id))
        last = ends.groupBy(*tenant).agg(F.max(EXTRACT).alias(EXTRACT))
        # a batch that is repeated finds only what had come before it
        waiting = read_log(spark, staged).where(F.col("batch_id") <= batch_id)
        rows = within(waiting, last, named).drop("batch_id", EXTRACT)
        tenants = last.select(*tenant)
        before = state_after(spark, base(spark), f"{path}/changes", batch_id, keys, tenants, hash_of)
        write(cdc.detect_changes(rows, before, newest=newest, keys=keys, tenants=tenants, hash_of=hash_of), batch_id)
        # what ended before this batch is no longer needed, even if this batch is repeated
        finished = read_log(spark, ended).where(F.col("batch_id") < batch_id).groupBy(*tenant).agg(F.max(EXTRACT).alias("_done"))
        if not finished.isEmpty():
            kept = waiting.select("batch_id", *named).distinct()
            same = reduce(Column.__and__, [kept[c].eqNullSafe(finished[c]) for c in tenant])
            needed = kept.join(finished, same, "left").where(F.col("_done").isNull() | (F.col(EXTRACT) > F.col("_done")))
            needed = {r["batch_id"] for r in needed.select("batch_id").distinct().collect()}
            for b in batches_of(spark, staged):
                if b < batch_id and b not in needed:
                    folders.remove(spark, batch_folder(staged, b))

    return detect
