import random
import time
from datetime import timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import Row, functions as F

from millrace.operators import cdc
from millrace.operators.messages import first_message_within
from millrace.schemas import USER_KEYS
from millrace.session import SETTINGS
from millrace.streaming import base, joined, keyed, progress, stateful, timers
from tests.test_cdc import latest_of, staging_of

EVENTS = "/root/testdata/sf0.001/events.parquet"


def write_files(df, path, order, files):
    """The rows in order as numbered files with rising modification times."""
    pdf = df.toPandas().sort_values(order)
    size = -(-len(pdf) // files)
    for n in range(files):
        add_file(df.sparkSession, pdf.iloc[n * size:(n + 1) * size], df.schema, path)


def add_file(spark, pdf, schema, path):
    spark.createDataFrame(pdf, schema).coalesce(1).write.mode("append").parquet(path)
    time.sleep(1.05)


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(EVENTS)


@pytest.fixture(scope="module")
def split_events(spark, events, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("events"))
    write_files(events, path, "ts", 4)
    return path


def stream(spark, path, schema):
    return base.stream_files(spark, path, schema, 1).withColumn("at", F.col("ts").cast("timestamp"))


def test_latest_value_and_counter(spark, events, split_events, tmp_path, rows):
    source = stream(spark, split_events, events.schema)
    for name, frame, keys in (
        ("latest", keyed.latest_value(source, ["user_id"], "props", "event_id"), ["user_id"]),
        ("count", keyed.key_counter(source, ["user_id"]), ["user_id"]),
    ):
        log = str(tmp_path / name / "log")
        query = base.run_batches(frame, str(tmp_path / name / "cp"), base.append_log(log), "update")
        assert query.lastProgress["batchId"] >= 3
        state = base.newest_rows(base.read_log(spark, log), keys)
        if name == "latest":
            want = events.groupBy("user_id").agg(F.max_by("props", "event_id"), F.max("event_id"))
            assert rows(state, "user_id", "props", "event_id") == rows(want)
        else:
            assert rows(state, "user_id", "n") == rows(events.groupBy("user_id").count())


def test_counter_goes_on_after_a_restart(spark, events, tmp_path, rows):
    path, log, checkpoint = (str(tmp_path / n) for n in ("in", "log", "cp"))
    pdf = events.toPandas().sort_values("ts")
    add_file(spark, pdf.iloc[:400], events.schema, path)
    for part in (None, pdf.iloc[400:]):
        if part is not None:
            add_file(spark, part, events.schema, path)
        frame = keyed.key_counter(stream(spark, path, events.schema), ["user_id"])
        base.run_batches(frame, checkpoint, base.append_log(log), "update")
    state = base.newest_rows(base.read_log(spark, log), ["user_id"])
    assert rows(state, "user_id", "n") == rows(events.groupBy("user_id").count())


def test_interval_trigger(spark, events, split_events, tmp_path):
    frame = stream(spark, split_events, events.schema).select("event_id")
    query = base.run_batches(
        frame, str(tmp_path / "cp"), base.append_log(str(tmp_path / "log")), processing_time="1 second"
    )
    try:
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert base.read_log(spark, str(tmp_path / "log")).count() == events.count()


def test_repeated_batch_replaces_itself(spark, tmp_path):
    write = base.append_log(str(tmp_path / "log"))
    for _ in range(2):
        write(spark.range(5), 0)
    write(spark.range(3), 1)
    assert base.read_log(spark, str(tmp_path / "log")).count() == 8


def test_ticks_drop_late_rows(spark, events, tmp_path, rows):
    path, log = str(tmp_path / "in"), str(tmp_path / "log")
    pdf = events.toPandas().sort_values("ts")
    write_files(events, path, "ts", 3)
    # rows count as late by the watermark of the batch before, hence one more file in between
    last = pdf.iloc[:1].assign(ts=pdf["ts"].max() + timedelta(days=1))
    add_file(spark, last, events.schema, path)
    late = pdf.iloc[:25].assign(ts=pdf["ts"].max() - timedelta(days=2))
    add_file(spark, late, events.schema, path)
    ticks = keyed.tick_counts(stream(spark, path, events.schema), "at", "5 seconds")
    base.run_batches(ticks, str(tmp_path / "cp"), base.append_log(log), "update", progress=str(tmp_path / "progress"))
    assert progress.late_rows(spark, str(tmp_path / "progress")) > 0
    got = base.newest_rows(base.read_log(spark, log), ["tick"])
    window = F.window(F.col("ts").cast("timestamp"), "5 seconds").alias("w")
    kept = events.unionByName(spark.createDataFrame(last, events.schema))
    want = kept.groupBy(window).count().select(F.col("w.start").alias("tick"), "count")
    assert rows(got, "tick", "n") == rows(want, "tick", "count")


def test_duplicates_across_files(spark, events, tmp_path, rows):
    path, log = str(tmp_path / "in"), str(tmp_path / "log")
    pdf = events.toPandas().sort_values("ts")
    add_file(spark, pdf.iloc[:500], events.schema, path)
    # the second file delivers some rows of the first one again
    again = pdf.iloc[480:]
    add_file(spark, again, events.schema, path)
    first = keyed.first_deliveries(stream(spark, path, events.schema), "at", ["event_id"], "100 days")
    base.run_batches(first, str(tmp_path / "cp"), base.append_log(log))
    assert rows(base.read_log(spark, log), "event_id") == rows(events, "event_id")


def test_history_and_closed(spark, tmp_path, rows):
    log = spark.createDataFrame(
        [("a", 2, "result"), ("a", 1, "start"), ("a", 3, "complete"), ("b", 1, "start")],
        "wf string, seq int, type string",
    )
    got = [tuple(r) for r in keyed.history(log, "wf", "seq", "type", "complete").collect()]
    assert got == [
        ("a", 1, "start", True), ("a", 2, "result", True), ("a", 3, "complete", True), ("b", 1, "start", False),
    ]


def deliveries(rng, n):
    return [(rng.choice(["hot", "hot", "x", None]), rng.choice([timers.MESSAGE, timers.REQUEST]), i, i * 10_000 + rng.randrange(9000)) for i in range(n)]


ITEMS = "k string, kind string, id bigint, at_us bigint"


def test_delivery_with_timers(spark, tmp_path, rows):
    df = spark.createDataFrame(deliveries(random.Random(5), 200), ITEMS)
    path, cp = str(tmp_path / "in"), str(tmp_path / "cp")
    write_files(df, path, "at_us", 5)
    source = base.stream_files(spark, path, df.schema, 1)
    out = timers.message_delivery(source, ["k"], 60_000, "0 seconds")
    query = base.run_batches(out, cp, base.append_log(str(tmp_path / "log")))
    assert query.lastProgress["batchId"] >= 4
    given = base.read_log(spark, str(tmp_path / "log"))
    want = first_message_within(df.where(F.col("kind") == timers.REQUEST), df.where(F.col("kind") == timers.MESSAGE), ["k"], 60_000)
    assert given.select("batch_id").distinct().count() >= 4  # answered as the time comes, not at the end
    assert rows(timers.answers(given.drop("batch_id"), cp, ["k"], 60_000)) == rows(want)
    assert 0 < given.count() < want.count()


def test_state_goes_on_after_a_restart(spark, tmp_path, rows):
    df = spark.createDataFrame(deliveries(random.Random(8), 120), ITEMS)
    path, cp, log = str(tmp_path / "in"), str(tmp_path / "cp"), str(tmp_path / "log")
    pdf = df.toPandas().sort_values("at_us")
    for n in range(3):
        add_file(spark, pdf.iloc[n * 40:(n + 1) * 40], df.schema, path)
        out = timers.message_delivery(base.stream_files(spark, path, df.schema, 1), ["k"], 60_000, "0 seconds")
        base.run_batches(out, cp, base.append_log(log))
    want = first_message_within(df.where(F.col("kind") == timers.REQUEST), df.where(F.col("kind") == timers.MESSAGE), ["k"], 60_000)
    assert rows(timers.answers(base.read_log(spark, log).drop("batch_id"), cp, ["k"], 60_000)) == rows(want)


def test_delivery_in_a_session_of_other_settings(spark, tmp_path, rows):
    """The store that keeps several variables is set where the stream starts; the session keeps its own."""
    spark.conf.set(base.STATE_STORE, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        df = spark.createDataFrame(deliveries(random.Random(9), 80), ITEMS)
        path, cp, log = str(tmp_path / "in"), str(tmp_path / "cp"), str(tmp_path / "log")
        write_files(df, path, "at_us", 3)
        out = timers.message_delivery(base.stream_files(spark, path, df.schema, 1), ["k"], 60_000, "0 seconds")
        base.run_batches(out, cp, base.append_log(log), several_states=True)
        got = timers.answers(base.read_log(spark, log).drop("batch_id"), cp, ["k"], 60_000)
        want = first_message_within(df.where(F.col("kind") == timers.REQUEST), df.where(F.col("kind") == timers.MESSAGE), ["k"], 60_000)
        assert rows(got) == rows(want)
        assert spark.conf.get(base.STATE_STORE).endswith("HDFSBackedStateStoreProvider")
    finally:
        spark.conf.set(base.STATE_STORE, SETTINGS[base.STATE_STORE])


def test_delivery_of_rows_without_a_time(spark, tmp_path, rows):
    big = (1 << 60) + 1
    data = [("a", timers.MESSAGE, 1, None), ("a", timers.REQUEST, big, None), ("a", timers.REQUEST, 3, 1_000_000), (None, timers.MESSAGE, 4, 1_500_000),
            (None, timers.REQUEST, big + 2, 1_400_000)]
    df = spark.createDataFrame(data, ITEMS)
    path, cp, log = str(tmp_path / "in"), str(tmp_path / "cp"), str(tmp_path / "log")
    df.write.parquet(path)
    out = timers.message_delivery(base.stream_files(spark, path, df.schema), ["k"], 60_000_000, "0 seconds")
    base.run_batches(out, cp, base.append_log(log))
    got = timers.answers(base.read_log(spark, log).drop("batch_id"), cp, ["k"], 60_000_000)
    assert rows(got, "k", *joined.REPLY) == sorted(
        [("a", big, None, None, None), ("a", 3, 1_000_000, None, None), (None, big + 2, 1_400_000, 4, 1_500_000)], key=repr)


def test_delivery_to_numbers_as_keys_some_missing(spark, tmp_path, rows):
    """A key that is missing leaves the others whole, beyond what floating point holds too."""
    big, rng = (1 << 60) + 1, random.Random(4)
    data = [(rng.choice([None, 1, big, big + 1]), *r[1:]) for r in deliveries(rng, 120)]
    df = spark.createDataFrame(data, ITEMS.replace("k string", "k bigint"))
    path, cp, log = str(tmp_path / "in"), str(tmp_path / "cp"), str(tmp_path / "log")
    for n in range(3):
        df.where(F.floor(F.col("id") / 40) == n).coalesce(1).write.mode("append").parquet(path)
    out = timers.message_delivery(base.stream_files(spark, path, df.schema, 1), ["k"], 60_000, "0 seconds")
    base.run_batches(out, cp, base.append_log(log))
    got = timers.answers(base.read_log(spark, log).drop("batch_id"), cp, ["k"], 60_000)
    want = first_message_within(df.where(F.col("kind") == timers.REQUEST), df.where(F.col("kind") == timers.MESSAGE), ["k"], 60_000)
    assert got.schema["k"].dataType == df.schema["k"].dataType
    assert rows(got) == rows(want)


SENT = "k string, id bigint, at_us bigint"


def asked_and_sent(spark, rng, n):
    """One request a key, none or some messages after it, some of them too late, and one key that is null."""
    asked = [(f"k{i}" if i != n - 3 else None, i, 1_000_000 + i * 10_000) for i in range(n)]
    sent = [(k, 1000 * i + j, at + rng.choice([0, 5_000, 60_000, 60_001, 90_000, 400_000]))
            for k, i, at in asked for j in range(rng.randrange(4))]
    return spark.createDataFrame(asked, SENT), spark.createDataFrame(sent, SENT)


def test_replies_of_two_streams(spark, tmp_path, rows):
    """Equals the batch operator where a key has one request; stopped and started again after each file."""
    asked, sent = asked_and_sent(spark, random.Random(3), 120)
    cp, log, paths = str(tmp_path / "cp"), str(tmp_path / "log"), [str(tmp_path / n) for n in ("asked", "sent")]
    pieces = [df.toPandas().sort_values("at_us") for df in (asked, sent)]
    for n in range(4):
        for pdf, path in zip(pieces, paths):
            add_file(spark, pdf[(pdf["at_us"] - 1_000_000).clip(upper=1_199_999) // 300_000 == n], asked.schema, path)
        streams = (base.stream_files(spark, path, asked.schema, 1) for path in paths)
        base.run_batches(joined.replies(*streams, ["k"], 60_000, "0 seconds"), cp, base.append_log(log))
    given = base.read_log(spark, log)
    got = joined.first_replies(given.drop("batch_id"), ["k"], joined.waiting(spark, cp, ["k"]))
    want = first_message_within(asked, sent, ["k"], 60_000)
    assert rows(got) == rows(want)
    assert want.where("message_id IS NULL").count() > 5 < want.where("message_id IS NOT NULL").count()
    # what has timed out was answered as the watermark passed, and left the state
    assert given.where("message_id IS NULL").count() > 5 and joined.waiting(spark, cp, ["k"]).count() < 20


def extract_rows(spark, extracts):
    """Rows of extracts (id, rows), each followed by its end."""
    parts = []
    for number, extract in extracts:
        staged = staging_of(spark, extract).withColumns({stateful.EXTRACT: F.lit(number), stateful.END: F.lit(False)})
        org, integration = extract[0][1:3]
        end = spark.createDataFrame([(org, integration, number, True)],
                                    f"organization_id string, connected_integration_id string, {stateful.EXTRACT} int, {stateful.END} boolean")
        parts += [staged, staged.limit(0).unionByName(end, allowMissingColumns=True)]
    return parts


@pytest.mark.parametrize("pieces", [1, 3])
def test_changes_in_micro_batches(spark, tmp_path, rows, pieces):
    """Whole extracts of one tenant each, the first tenant twice; each extract in several micro-batches."""
    latest = latest_of(spark, [(f"u{i}", f"o{i % 3}", "i", f"n{i}", "e") for i in range(30)])
    latest.write.parquet(str(tmp_path / "base"))
    extracts = [
        [(f"u{i}", "o0", "i", f"n{i}", "new" if i % 2 else "e", 1) for i in range(0, 24, 3)],
        [(f"u{i}", "o1", "i", f"n{i}", "e", 1) for i in range(1, 40, 3)],
        [(f"u{i}", "o0", "i", f"n{i}", "e", 1) for i in range(3, 30, 3)],
    ]
    path = str(tmp_path / "in")
    parts = extract_rows(spark, list(enumerate(extracts)))
    for staged, end in zip(parts[::2], parts[1::2]):
        for n in range(pieces):
            piece = staged.where(F.pmod(F.hash("id"), F.lit(pieces)) == n)
            whole = piece.unionByName(end) if n == pieces - 1 else piece
            whole.coalesce(1).write.mode("append").parquet(path)
            time.sleep(0.2)
    schema = spark.read.parquet(path).schema
    handler = stateful.capture_changes(
        lambda s: s.read.parquet(str(tmp_path / "base")), str(tmp_path), newest=["created_at", "batch_seq"], every=2
    )
    query = base.run_batches(base.stream_files(spark, path, schema, 1), str(tmp_path / "cp"), handler)
    last = query.lastProgress["batchId"]
    assert last >= 3 * pieces - 1
    log = str(tmp_path / "changes")
    state = stateful.state_after(spark, latest, log, last + 1)
    want = latest
    for extract in extracts:
        staged = staging_of(spark, extract)
        want = cdc.apply_changes(want, cdc.detect_changes(staged, want, newest=["batch_seq"]))
    columns = [*USER_KEYS, "name", "email"]
    assert rows(state, *columns) == rows(want, *columns)
    assert state.where("organization_id = 'o2'").count() == 10
    # repeating the last batch changes nothing; what is no longer needed is gone
    assert len(base.batches_of(spark, log)) <= 3 and len(base.batches_of(spark, str(tmp_path / "staged"))) <= pieces + 1
    handler(parts[-2].unionByName(parts[-1]) if pieces == 1 else parts[-2].where(
        F.pmod(F.hash("id"), F.lit(pieces)) == pieces - 1).unionByName(parts[-1]), last)
    assert rows(stateful.state_after(spark, latest, log, last + 1), *columns) == rows(want, *columns)


def test_log_is_summed_up(spark, tmp_path, rows):
    log = str(tmp_path / "log")
    write = base.append_log(log, keys=["k"], every=3)
    for n in range(11):
        write(spark.createDataFrame([("all", n), (f"k{n % 4}", n)], "k string, v int"), n)
    assert len(base.batches_of(spark, log)) <= 3 and len(base.batches_of(spark, f"{log}-state")) == 1
    assert rows(base.newest_rows(base.read_log(spark, log), ["k"])) == [("all", 10), ("k0", 8), ("k1", 9), ("k2", 10), ("k3", 7)]


def test_late_rows_of_all_batches_count(spark, events, tmp_path):
    """More micro-batches than Spark keeps reports of."""
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        path = str(tmp_path / "in")
        pdf = events.toPandas().sort_values("ts")
        add_file(spark, pdf.iloc[-5:], events.schema, path)
        table = str(tmp_path / "progress")
        for part in range(2):  # the second run goes on from the first one's checkpoint
            for n in range(3):
                add_file(spark, pdf.iloc[n:n + 1].assign(ts=pdf["ts"].min()), events.schema, path)
            ticks = keyed.tick_counts(stream(spark, path, events.schema), "at", "5 seconds")
            query = base.run_batches(ticks, str(tmp_path / "cp"), base.append_log(str(tmp_path / "log")), "update", progress=table)
            assert len(query.recentProgress) <= 2
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert progress.late_rows(spark, table) >= 5
    done = progress.progress(spark, table).where("input_rows > 0")
    assert done.agg(F.sum("input_rows")).first()[0] == 11 and done.select("run_id").distinct().count() == 2
    assert progress.late_rows(spark, str(tmp_path / "nothing")) == 0


def test_messages_are_kept_for_a_time(spark, tmp_path, rows):
    path, cp, log = str(tmp_path / "in"), str(tmp_path / "cp"), str(tmp_path / "log")
    data = [("a", timers.MESSAGE, 1, 0), ("b", timers.MESSAGE, 2, 500), ("b", timers.REQUEST, 3, 510), ("a", timers.REQUEST, 4, 520),
            ("c", timers.MESSAGE, 5, 900)]
    df = spark.createDataFrame([(*r[:3], r[3] * 1000) for r in data], ITEMS)
    write_files(df, path, "at_us", 5)
    out = timers.message_delivery(base.stream_files(spark, path, df.schema, 1), ["k"], 10_000, "0 seconds", keep_us=100_000)
    base.run_batches(out, cp, base.append_log(log))
    assert rows(base.read_log(spark, log), "request_id", "message_id") == [(3, 2), (4, None)]
    assert rows(timers.still_open(spark, cp, ["k"])) == [("c", timers.MESSAGE, 5, 900_000)]


class Kept:
    """State and timers of one key, as the store would hold them."""

    def __init__(self):
        self.lists, self.timers, self.woken = {}, [], 0

    def getListState(self, name, schema):
        rows = self.lists.setdefault(name, [])
        return SimpleNamespace(get=lambda: iter(list(rows)), appendList=rows.extend, clear=rows.clear,
                               put=lambda new: (rows.clear(), rows.extend(new)))

    def registerTimer(self, at):
        self.timers.append(at)

    def settle(self, delivery, watermark):
        """What the timers answer that the watermark has passed, each of them told of once."""
        given = []
        while due := sorted(t for t in set(self.timers) if t <= watermark):
            self.woken += 1
            now = SimpleNamespace(getExpiryTimeInMs=lambda: due[0])
            given += delivery.handleExpiredTimer(("a",), SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark), now)
            self.timers = [t for t in self.timers if t != due[0]]
        return sorted((r["request_id"], r["message_id"]) for r in given)


def one_by_one(rows, timeout_ms, keep_ms):
    """Who gets what if each row had a timer of its own: (request, message) as requests fall due."""
    messages, answers = sorted((t, i) for kind, i, t in rows if kind == timers.MESSAGE), []
    for t, request in sorted((t, i) for kind, i, t in rows if kind == timers.REQUEST):
        if keep_ms is not None:
            messages = [m for m in messages if m[0] + keep_ms >= t + timeout_ms]
        got = messages.pop(0)[1] if messages and messages[0][0] <= t + timeout_ms else None
        answers.append((request, got))
    return sorted(answers)


@pytest.mark.parametrize("keep_ms", [None, 250, 40])
def test_a_key_is_woken_once_for_all_that_is_due(keep_ms):
    """A thousand rows of a key take one timer a batch, and are answered as if each had one."""
    rng, wait = random.Random(11), 100
    data = [(rng.choice([timers.MESSAGE, timers.REQUEST, timers.REQUEST]), i, i * 3 + rng.randrange(3)) for i in range(1000)]
    delivery = timers.Delivery(["k"], wait * 1000, None if keep_ms is None else keep_ms * 1000)
    kept, given = Kept(), []
    delivery.init(kept)
    for n in range(4):
        part = [Row(k="a", kind=kind, id=i, at_us=t * 1000) for kind, i, t in data[n * 250:(n + 1) * 250]]
        assert not list(delivery.handleInputRows(("a",), iter(part), None))
        assert len(set(kept.timers)) <= 2
        given += kept.settle(delivery, (n + 1) * 750)
    given += kept.settle(delivery, 1 << 40)
    assert sorted(given) == one_by_one(data, wait, keep_ms)
    assert kept.woken <= 12
    assert not kept.lists["requests"] and (keep_ms is None or not kept.lists["messages"])


def test_order_is_kept_per_key(spark, rows):
    df = spark.range(2000).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("k"),
        F.pmod(F.hash("id"), F.lit(10**6)).alias("seq"), "id",
    )
    laid = keyed.partition_ordered(df, ["k"], "seq", 8).withColumn("part", F.spark_partition_id())
    parts = {}
    for r in laid.collect():
        parts.setdefault(r.part, []).append((r.k, r.seq))
    assert len(parts) == 8 and max(map(len, parts.values())) < 700
    chain = [x for p in sorted(parts) for x in parts[p]]
    assert chain == sorted(chain) and len(chain) == 2000


def test_ordered_batches_hold_all_rows(spark, events, split_events, tmp_path, rows):
    handled = []

    def handle(batch, batch_id):
        handled.append(batch_id)
        base.append_log(str(tmp_path / "log"))(keyed.partition_ordered(batch, ["user_id"], "event_id", 2), batch_id)

    base.run_batches(base.stream_files(spark, split_events, events.schema, 1), str(tmp_path / "cp"), handle)
    assert len(handled) == 4
    assert rows(base.read_log(spark, str(tmp_path / "log")), *events.columns) == rows(events)


def test_input_of_streams_keeps_its_order(spark, tmp_path, monkeypatch):
    """Rows are dealt by a hash, not in turn, so each file holds them in the order of the table; none is lost."""
    from millrace.catalog import streams
    from millrace.catalog.base import Tables

    monkeypatch.setattr(streams, "work_path", lambda spark, name: str(tmp_path / name))
    events = spark.range(0, 3000, 1, 1).select(F.col("id").alias("event_id"), F.lit("x").alias("props"))
    path = streams._in_files(Tables(spark, "/nowhere"), events, "event_id", "events")
    seen = spark.read.parquet(path).select("event_id", F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("n"))
    files = {}
    for r in seen.orderBy("f", "n").collect():
        files.setdefault(r["f"], []).append(r["event_id"])
    assert sorted(i for f in files.values() for i in f) == list(range(3000))
    assert all(f == sorted(f) for f in files.values()) and len(files) == streams.FILES * streams._piece_files(spark)
