"""Queries that run a table through Structured Streaming; the result equals the batch form."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.base import (
    CDC_SQL, STAGED_ORDER, Query, Tables, cdc_latest, cdc_staging,
)
from millrace.catalog.timing import FIRST_MESSAGE_SQL, WAIT_US
from millrace.functions.hashing import content_hash
from millrace.functions.values import epoch_micros
from millrace.schemas import HASH_OF
from millrace.session import work_path
from millrace.sinks.tables import COMPRESSION, recreate
from millrace.sources import service
from millrace.streaming import base, joined, keyed, progress, stateful, timers


FILES = 3
#: How long an order waits for its first line to be shipped.
SHIP_WAIT_US = 180 * 86_400_000_000


def _in_files(t: Tables, rows, order: str, name: str) -> str:
    """Rows as ``FILES`` pieces with rising times, each of as many files as a micro-batch takes.

    Rows are dealt by a hash of all their columns: they stay in order, so neighbours that are alike take little room.
    """
    path = work_path(t.spark, name)
    low, high = rows.agg(F.min(order), F.max(order)).first()
    at = F.floor(F.lit(FILES) * (F.col(order) - F.lit(low)) / F.lit(high - low + 1))
    for n in range(FILES):
        piece = rows.where(F.coalesce(at, F.lit(0)) == n).repartition(_piece_files(t.spark), F.xxhash64(*rows.columns))
        piece.write.mode("append").option("compression", COMPRESSION).parquet(path)
    return path


def _piece_files(spark) -> int:
    return spark.sparkContext.defaultParallelism


def _events(t: Tables):
    events = t("events").withColumn("_us", F.unix_micros(F.col("ts").cast("timestamp")))
    path = _in_files(t, events, "_us", "events")
    stream = base.stream_files(t.spark, path, events.schema, _piece_files(t.spark)).drop("_us")
    return stream.withColumn("at", F.col("ts").cast("timestamp"))


def _to_log(spark, stream, name: str, mode: str = "append", keys=None):
    path = work_path(spark, name)
    handler = base.append_log(f"{path}/log", rebalance=mode == "update", keys=keys, every=2)
    base.run_batches(stream, f"{path}/checkpoint", handler, mode)
    return base.read_log(spark, f"{path}/log")


def stream_latest_value(spark, sf):
    latest = keyed.latest_value(
        _events(Tables(spark, sf)), ["user_id", "event_type"], "props", "event_id"
    )
    log = _to_log(spark, latest, "latest-value", "update", ["user_id", "event_type"])
    return base.newest_rows(log, ["user_id", "event_type"])


def stream_key_counter(spark, sf):
    counts = keyed.key_counter(_events(Tables(spark, sf)), ["user_id"])
    return base.newest_rows(_to_log(spark, counts, "key-counter", "update", ["user_id"]), ["user_id"])


def stream_tick_counts(spark, sf):
    ticks = keyed.tick_counts(_events(Tables(spark, sf)), "at", "5 seconds", ["event_type"])
    log = _to_log(spark, ticks, "ticks", "update", ["tick", "event_type"])
    newest = base.newest_rows(log, ["tick", "event_type"])
    return newest.select(F.unix_micros("tick").alias("tick_us"), "event_type", "n")


def stream_progress(spark, sf):
    """Rows that a stream of ticks took and dropped, from the table of its progress over two runs of one checkpoint."""
    t = Tables(spark, sf)
    path = work_path(spark, "progress")
    stream = keyed.tick_counts(_events(t), "at", "1 hour", ["event_type"])
    for _ in range(2):
        base.run_batches(stream, f"{path}/checkpoint", base.append_log(f"{path}/log"), "update", progress=f"{path}/progress")
    rows = progress.progress(spark, f"{path}/progress")
    return rows.agg(F.sum("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows"),
                    (F.count_if(F.col("input_rows") > 0) > 1).alias("several_batches"))


def stream_history(spark, sf):
    events = _events(Tables(spark, sf)).select("user_id", "event_id", "event_type", "props")
    log = _to_log(spark, events, "history").drop("batch_id")
    return keyed.history(log, "user_id", "event_id", "event_type", "purchase")


def stream_log_source(spark, sf):
    """Events from a log that is polled, in three parts of one checkpoint as the log grows."""
    t = Tables(spark, sf)
    path, block = work_path(spark, "log"), 10_000
    events = t("events").select("event_id", "user_id", "event_type", "props")
    blocks = events.withColumn("block", F.floor(F.col("event_id") / block))
    blocks.repartition("block").write.partitionBy("block").parquet(path)
    stored = service.StoredLog(path, "event_id", block)
    last = events.agg(F.max("event_id")).first()[0] or 0
    service.register_log(spark, "event_log", events.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "),
                         stored.newest, stored, start=-1, entries_per_partition=block)
    stream = spark.readStream.format("event_log").load()
    for part in range(1, FILES + 1):
        stored.grow(last * part // FILES)
        base.run_batches(stream, f"{path}-checkpoint", base.append_log(f"{path}-rows"))
    return base.read_log(spark, f"{path}-rows").drop("batch_id")


def stream_dedup(spark, sf):
    twice = _events(Tables(spark, sf)).withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2))))
    first = keyed.first_deliveries(twice.drop("delivery"), "at", ["event_id"])
    log = _to_log(spark, first, "dedup")
    return log.select("event_id", "user_id", "event_type", "props")


def stream_message_timeout(spark, sf):
    t = Tables(spark, sf)
    path = work_path(spark, "messages")
    kind = F.when(F.col("event_type") == "signup", timers.REQUEST).when(
        F.col("event_type") == "purchase", timers.MESSAGE
    )
    stream = _events(t).select(
        "user_id", kind.alias("kind"), F.col("event_id").alias("id"), epoch_micros("ts").alias("at_us")
    ).where("kind is not null and user_id is not null")
    given = timers.message_delivery(stream, ["user_id"], WAIT_US, "1 hour")
    base.run_batches(given, f"{path}/checkpoint", base.append_log(f"{path}/answers"), several_states=True)
    log = base.read_log(spark, f"{path}/answers").drop("batch_id")
    return timers.answers(log, f"{path}/checkpoint", ["user_id"], WAIT_US)


def stream_first_reply(spark, sf):
    """The first line of each order that is shipped within half a year of it: two streams, each with a watermark."""
    t = Tables(spark, sf)
    path = work_path(spark, "replies")

    def stream(table: str, at: str, key: str, id_: str):
        rows = t(table).select(F.col(key).alias("order_key"), F.col(id_).alias("id"), epoch_micros(at).alias("at_us"))
        return base.stream_files(spark, _in_files(t, rows, "at_us", table), rows.schema, _piece_files(spark))

    orders = stream("orders", "o_orderdate", "o_orderkey", "o_custkey")
    lines = stream("lineitem", "l_shipdate", "l_orderkey", "l_linenumber")
    given = joined.replies(orders, lines, ["order_key"], SHIP_WAIT_US, "1 day")
    base.run_batches(given, f"{path}/checkpoint", base.append_log(f"{path}/pairs"))
    log = base.read_log(spark, f"{path}/pairs").drop("batch_id")
    return joined.first_replies(log, ["order_key"], joined.waiting(spark, f"{path}/checkpoint", ["order_key"]))


def stream_cdc_apply(spark, sf):
    """Each tenant's extract comes in three pieces and is followed by its end."""
    t = Tables(spark, sf)
    path = work_path(spark, "cdc")
    recreate(cdc_latest(t), f"{path}/base")
    # the hash follows from columns beside it: it is taken as the rows come
    lines = cdc_staging(t).drop("content_hash").withColumns({
        "_piece": F.pmod(F.hash("id"), F.lit(FILES)), stateful.EXTRACT: F.lit(1), stateful.END: F.lit(False)})
    ends = lines.select("organization_id", "connected_integration_id", stateful.EXTRACT).distinct().withColumns(
        {"_piece": F.lit(FILES - 1), stateful.END: F.lit(True)})
    source = _in_files(t, lines.unionByName(ends, allowMissingColumns=True), "_piece", "extracts")
    stream = base.stream_files(spark, source, spark.read.parquet(source).schema, _piece_files(spark)).drop("_piece")
    handler = stateful.capture_changes(
        lambda s: s.read.parquet(f"{path}/base"), path, newest=STAGED_ORDER, every=2, hash_of=HASH_OF
    )
    base.run_batches(stream, f"{path}/checkpoint", handler)
    last = base.batches_of(spark, f"{path}/ended")[-1]
    return stateful.state_after(spark, spark.read.parquet(f"{path}/base"), f"{path}/changes", last + 1, hash_of=HASH_OF)


def partition_ordered(spark, sf):
    t = Tables(spark, sf)
    path = work_path(spark, "ordered-log")
    write = base.append_log(f"{path}/log")

    def handle(batch, batch_id):
        write(keyed.partition_ordered(batch, ["user_id"], "event_id"), batch_id)

    events = _events(t).select("user_id", "event_id", "event_type", "props")
    base.run_batches(events, f"{path}/checkpoint", handle)
    return base.read_log(spark, f"{path}/log").drop("batch_id")


QUERIES = {
    "stream_latest_value": Query(stream_latest_value, """
        SELECT user_id, event_type, last(props ORDER BY event_id) AS props, max(event_id) AS event_id
        FROM events GROUP BY user_id, event_type
    """),
    "stream_key_counter": Query(stream_key_counter, """
        SELECT user_id, count(*) AS n FROM events GROUP BY user_id
    """),
    "stream_tick_counts": Query(stream_tick_counts, """
        SELECT epoch_us(ts) // 5000000 * 5000000 AS tick_us, event_type, count(*) AS n
        FROM events GROUP BY ALL
    """),
    "stream_progress": Query(stream_progress, """
        SELECT CAST(count(*) AS BIGINT) AS input_rows, CAST(0 AS BIGINT) AS late_rows, true AS several_batches FROM events
    """),
    "stream_history": Query(stream_history, """
        SELECT user_id, event_id, event_type, props,
               user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase') AS closed
        FROM events ORDER BY user_id, event_id
    """),
    "stream_log_source": Query(stream_log_source, "SELECT event_id, user_id, event_type, props FROM events"),
    "stream_dedup": Query(stream_dedup, "SELECT event_id, user_id, event_type, props FROM events"),
    "stream_message_timeout": Query(stream_message_timeout, FIRST_MESSAGE_SQL),
    "stream_first_reply": Query(stream_first_reply, f"""
        SELECT o_orderkey AS order_key, o_custkey AS request_id, epoch_us(o_orderdate) AS request_at,
               first(l_linenumber ORDER BY l_shipdate, l_linenumber) AS message_id, min(epoch_us(l_shipdate)) AS message_at
        FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_shipdate >= o_orderdate
             AND epoch_us(l_shipdate) <= epoch_us(o_orderdate) + {SHIP_WAIT_US}
        GROUP BY o_orderkey, o_custkey, o_orderdate
    """),
    "stream_cdc_apply": Query(stream_cdc_apply, CDC_SQL + """
        SELECT id, organization_id, connected_integration_id, external_id, name, email, content_hash
        FROM fresh
        UNION ALL
        SELECT id, organization_id, connected_integration_id, external_id, name, email, content_hash
        FROM prior WHERE (organization_id, connected_integration_id) NOT IN (
            SELECT (organization_id, connected_integration_id) FROM fresh)
    """),
    "partition_ordered": Query(partition_ordered, """
        SELECT user_id, event_id, event_type, props FROM events
    """),
}
