import random

import pytest

from millrace.operators.messages import first_message_within


def serve(requests, messages, timeout):
    """Requests of one key in order; each takes the oldest message left, if sent in time."""
    queue = sorted(messages)
    out = []
    for at, rid in sorted(requests):
        if queue and queue[0][0] <= at + timeout:
            sent, mid = queue.pop(0)
            out.append((rid, at, mid, sent))
        else:
            out.append((rid, at, None, None))
    return out


@pytest.mark.parametrize("width", [1, 37, 10**9])
@pytest.mark.parametrize("seed", [1, 2])
def test_delivery_equals_a_queue(spark, rows, seed, width):
    rng = random.Random(seed)
    requests, messages = [], []
    for i in range(160):
        key = rng.choice(["hot", "hot", "hot", "x", "y", None])
        (requests if rng.random() < 0.55 else messages).append((key, rng.randrange(400), i))
    want = []
    for key in {r[0] for r in requests}:
        mine = [(at, i) for k, at, i in requests if k == key]
        theirs = [(at, i) for k, at, i in messages if k == key]
        want += [(key, *r) for r in serve(mine, theirs, 15)]
    schema = "k string, at_us bigint, id bigint"
    got = first_message_within(
        spark.createDataFrame(requests, schema), spark.createDataFrame(messages, schema), ["k"], 15,
        width=width,
    )
    assert rows(got) == sorted(want, key=repr)
    assert any(r[3] is None for r in want) and any(r[3] is not None for r in want)


def test_early_late_and_missing(spark, rows):
    schema = "wf string, at_us bigint, id bigint"
    requests = spark.createDataFrame([("a", 100, 1), ("b", 100, 2), ("c", 100, 3), ("d", 100, 4)], schema)
    messages = spark.createDataFrame([("a", 5, 11), ("b", 160, 12), ("c", 161, 13)], schema)
    got = rows(first_message_within(requests, messages, ["wf"], 60), "wf", "message_id")
    assert got == [("a", 11), ("b", 12), ("c", None), ("d", None)]


def test_repeats_and_rows_without_a_time(spark, rows):
    """Repeated requests each count, those without a time come to nothing, messages without one reach nobody."""
    schema = "wf string, at_us bigint, id bigint"
    requests = spark.createDataFrame([("a", 100, 1), ("a", 100, 1), ("b", None, 2), ("b", 100, 3), ("c", None, 4)], schema)
    messages = spark.createDataFrame([("b", None, 11), ("b", 150, 12), ("c", None, 13)], schema)
    got = rows(first_message_within(requests, messages, ["wf"], 60))
    assert got == sorted([("a", 1, 100, None, None)] * 2 + [("b", 2, None, None, None), ("b", 3, 100, 12, 150),
                                                            ("c", 4, None, None, None)], key=repr)
