"""Reading tables as streams and keeping micro-batch results in tables that can be repeated."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager, nullcontext
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators.dedup import dedup_latest
from millrace.session import SETTINGS
from millrace.sinks import folders
from millrace.sinks.tables import COMPRESSION
from millrace.streaming.progress import ProgressTable


def stream_files(
    spark: SparkSession, path: str, schema, files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files under a path (or glob) as a stream, a bounded number of files per trigger."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


#: Where streams keep their state; the settings of a session hold it too, but sessions come from elsewhere as well.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams that start within have the state store of ``SETTINGS``, which state of several variables needs.

    A stream takes the setting when it starts, or from its checkpoint; afterwards the session has its own again.
    """
    own = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, SETTINGS[STATE_STORE])
    try:
        yield
    finally:
        spark.conf.set(STATE_STORE, own) if own else spark.conf.unset(STATE_STORE)


def run_batches(
    stream: DataFrame,
    checkpoint: str,
    handle: Callable[[DataFrame, int], None],
    mode: str = "append",
    processing_time: str | None = None,
    progress: str | None = None,
    several_states: bool = False,
):
    """Run the stream over what is there, or every ``processing_time``, and return the query.

    Without an interval the query ends by itself; an outside scheduler starts it again. What each micro-batch did
    goes to the table ``progress`` (see :mod:`millrace.streaming.progress`), for a query that ends by itself.
    ``several_states`` is for streams that keep several state variables a key (:mod:`millrace.streaming.timers`).
    """
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(handle)
    spark, listener = stream.sparkSession, None
    if processing_time:
        with state_on_disk(spark) if several_states else nullcontext():
            return writer.trigger(processingTime=processing_time).start()
    if progress:
        listener = ProgressTable(spark, progress)
        spark.streams.addListener(listener)
    try:
        with state_on_disk(spark) if several_states else nullcontext():
            query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        if listener:  # reports come after the fact, the end is the last
            listener.ended.wait(REPORT_SECONDS)
    finally:
        if listener:
            spark.streams.removeListener(listener)
    return query


#: How long to wait for the last report of a query that has ended.
REPORT_SECONDS = 30


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def batches_of(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n.split("=")[1]) for n in folders.names(spark, path) if n.startswith("batch_id="))


def append_log(
    path: str, rebalance: bool = False, keys: Sequence[str] | None = None, every: int = 20
) -> Callable[[DataFrame, int], None]:
    """Handler that writes each micro-batch to its own folder; a repeated batch replaces itself.

    ``rebalance`` brings the rows of many state partitions together into files of a decent size. With ``keys``,
    only the newest row of a key counts: every ``every`` batches the log before is summed up in one table
    (see :func:`compact`), so reading the state does not grow with the number of batches.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.hint("rebalance") if rebalance else batch
        rows.write.mode("overwrite").option("compression", COMPRESSION).parquet(batch_folder(path, batch_id))
        if keys and batch_id and batch_id % every == 0:
            compact(batch.sparkSession, path, keys, batch_id - 1)

    return write


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All rows written so far, with the ``batch_id`` they came in; those summed up count as of their last batch."""
    summed = batches_of(spark, f"{path}-state")[-1:]
    parts = [spark.read.option("basePath", f"{path}-state").parquet(batch_folder(f"{path}-state", b)) for b in summed]
    tail = [batch_folder(path, b) for b in batches_of(spark, path) if not summed or b > summed[0]]
    if tail:
        parts.append(spark.read.option("basePath", path).parquet(*tail))
    return reduce(DataFrame.unionByName, parts).withColumn("batch_id", F.col("batch_id").cast("bigint"))


def compact(spark: SparkSession, path: str, keys: Sequence[str], upto: int) -> None:
    """Sum up the batches to ``upto`` as the newest row of each key, and remove what that replaces.

    Only finished batches are summed up, so one that is repeated still replaces itself.
    """
    newest_rows(read_log(spark, path).where(F.col("batch_id") <= upto), keys).write.mode("overwrite").option("compression", COMPRESSION).parquet(
        batch_folder(f"{path}-state", upto))
    for b in batches_of(spark, path):
        if b <= upto:
            folders.remove(spark, batch_folder(path, b))
    for b in batches_of(spark, f"{path}-state")[:-1]:
        folders.remove(spark, batch_folder(f"{path}-state", b))


def newest_rows(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The row of the newest batch per key: the state of an update-mode stream."""
    return dedup_latest(log, keys, ["batch_id"]).drop("batch_id")
