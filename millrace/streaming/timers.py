"""Message delivery on unbounded input: keyed state with event-time timers.

What is open is kept per key in Spark's state store, and a timer wakes the key when the watermark has passed the
earliest deadline. A micro-batch touches the keys that have new rows or a timer that is due, whatever else is open.
Rows come and go as rows, not as a pandas frame for each key: keys are many and have few rows in a micro-batch.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import batched

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ListState

from millrace.operators.messages import first_message_within
from millrace.session import work_path
from millrace.sinks.tables import COMPRESSION

MESSAGE, REQUEST = "message", "request"
#: A request without a time, within a stream.
TIMELESS = "timeless"
#: Rows lie in the state in runs as they came, not one by one: what a row costs there is its two numbers.
_RUN = "id array<long>, at_us array<long>"
#: Rows of a key that are sent to the state together.
SENT_ROWS = 10_000
ANSWER = "request_id long, request_at long, message_id long, message_at long"


def _run(rows: Iterable[tuple[int, int]]) -> tuple[list[int], list[int]]:
    ids, times = zip(*rows)
    return list(ids), list(times)


def _in_order(state: ListState) -> list[tuple[int, int]]:
    """Time and id of all rows of a state."""
    return sorted((at, i) for ids, times in state.get() for i, at in zip(ids, times))


class Delivery(StatefulProcessor):
    """Requests of a key are served in order; each takes the oldest message sent by its deadline and not yet taken.

    A key has a timer at the earliest time it waits for, not one for each row. When it wakes, all that the watermark
    has passed is settled at once, and the next timer is set.
    """

    def __init__(self, keys: Sequence[str], timeout_us: int, keep_us: int | None):
        self.keys, self.timeout_us, self.keep_us = list(keys), timeout_us, keep_us
        self.answer = Row(*self.keys, "request_id", "request_at", "message_id", "message_at")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.messages = handle.getListState("messages", _RUN)
        self.requests = handle.getListState("requests", _RUN)

    def _due_ms(self, at_us: int, wait_us: int) -> int:
        # the watermark counts whole milliseconds: beyond this one, all rows up to the time are in
        return (at_us + wait_us) // 1000 + 1

    def _wake(self, messages: list[int], requests: list[int]) -> None:
        """Sets a timer for the earliest of the times of messages and requests that something is due for."""
        due = [self._due_ms(min(at), wait) for at, wait in ((messages, self.keep_us), (requests, self.timeout_us)) if at and wait is not None]
        if due:
            self.handle.registerTimer(min(due))

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        for batch in batched(rows, SENT_ROWS):
            found = {kind: [(r["id"], r["at_us"]) for r in batch if r["kind"] == kind] for kind in (MESSAGE, REQUEST, TIMELESS)}
            for request, _ in found[TIMELESS]:
                yield self.answer(*key, request, None, None, None)
            for kind, state in ((MESSAGE, self.messages), (REQUEST, self.requests)):
                if found[kind]:
                    state.appendList([_run(found[kind])])
            self._wake(*([at for _, at in found[kind]] for kind in (MESSAGE, REQUEST)))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        requests = _in_order(self.requests)
        due = [r for r in requests if self._due_ms(r[0], self.timeout_us) <= now]
        if not due and self.keep_us is None:  # another timer has been here
            self._wake([], [at for at, _ in requests[:1]])
            return
        messages = _in_order(self.messages)
        taken = 0
        for at, request in due:
            answered = self._due_ms(at, self.timeout_us)
            # what was kept no longer than to a time before
            while self.keep_us is not None and taken < len(messages) and self._due_ms(messages[taken][0], self.keep_us) < answered:
                taken += 1
            fits = taken < len(messages) and messages[taken][0] <= at + self.timeout_us
            got, sent = (messages[taken][1], messages[taken][0]) if fits else (None, None)
            taken += fits
            yield self.answer(*key, request, at, got, sent)
        left, waiting = messages[taken:], requests[len(due):]
        if self.keep_us is not None:
            left = [m for m in left if self._due_ms(m[0], self.keep_us) > now]
        for state, items, before in ((self.messages, left, messages), (self.requests, waiting, requests)):
            if len(items) < len(before):
                state.put([_run((i, at) for at, i in items)]) if items else state.clear()
        self._wake(*([at for at, _ in items[:1]] for items in (left, waiting)))

    def close(self) -> None:
        pass


def message_delivery(
    stream: DataFrame, keys: Sequence[str], timeout_us: int, delay: str, keep_us: int | None = None,
) -> DataFrame:
    """Answers to the requests of a stream of (keys, kind, id, at_us) rows; for append mode.

    ``delay`` is how late rows may come; a request is answered when the watermark has passed its deadline, with all its
    messages in. A message waits until it is delivered, or with ``keep_us`` for that long in event time. What is
    open for one key is read when its timer is due; it should fit into a task, as should the answers that a micro-batch
    gives in one state partition. A request without a time has no
    deadline and is answered at once, with no message; a message without one is in time for none. The state has the
    keys as text: numbers among which some are missing would be rounded on their way, and those of all keys be mixed up.
    """
    at = F.timestamp_micros("at_us").alias("_at")
    kind = F.when(F.col("at_us").isNotNull(), F.col("kind")).when(F.col("kind") == REQUEST, TIMELESS).alias("kind")
    rows = stream.select(*(F.col(k).cast("string").alias(k) for k in keys), kind, "id", F.coalesce("at_us", F.lit(0)).cast("bigint").alias("at_us"), at)
    rows = rows.where("kind IS NOT NULL").withWatermark("_at", delay)
    kinds = ", ".join(f"{k} string" for k in keys)
    given = rows.groupBy(*keys).transformWithState(
        Delivery(keys, timeout_us, keep_us), outputStructType=f"{kinds}, {ANSWER}", outputMode="append", timeMode="eventTime")
    return _typed(given, keys, stream)


def _typed(rows: DataFrame, keys: Sequence[str], like: DataFrame) -> DataFrame:
    """Keys that were text in the state as they are in ``like``."""
    return rows.withColumns({k: F.col(k).cast(like.schema[k].dataType) for k in keys})


def still_open(spark: SparkSession, checkpoint: str, keys: Sequence[str]) -> DataFrame:
    """Rows (keys, kind, id, at_us) that a stream's checkpoint holds in its state; keys are text."""
    parts = []
    for name, kind in (("messages", MESSAGE), ("requests", REQUEST)):
        state = spark.read.format("statestore").option("stateVarName", name).load(checkpoint)
        parts.append(state.select(*(F.col("key")[k].alias(k) for k in keys), F.lit(kind).alias("kind"),
                                  F.inline(F.arrays_zip("list_element.id", "list_element.at_us")).alias("id", "at_us")))
    return parts[0].unionByName(parts[1])


def answers(given: DataFrame, checkpoint: str, keys: Sequence[str], timeout_us: int) -> DataFrame:
    """All answers once the stream has ended and no more rows come: those given, and those of what is still open."""
    spark = given.sparkSession
    found, path = still_open(spark, checkpoint, keys), work_path(spark, "open")
    # the order below takes several passes, and each would open all state stores
    found.hint("rebalance").write.option("compression", COMPRESSION).parquet(path)
    left = _typed(spark.read.schema(found.schema).parquet(path), keys, given)
    rest = first_message_within(left.where(F.col("kind") == REQUEST), left.where(F.col("kind") == MESSAGE), keys, timeout_us)
    return given.unionByName(rest)
