import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from millrace.llm import suffix_merge as sm
from tests.llm.conftest import SF


def expected(docs, length=200):
    texts = [(d["text"] or "").encode() for d in docs]
    count = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    for d, t in zip(docs, texts):
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                gone[i:i + length] = True
        runs = int((gone & ~np.append(False, gone[:-1])).sum()) if len(t) else 0
        yield d["doc_id"], len(t), int(gone.sum()), runs, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()


@pytest.fixture(scope="module")
def mixed(spark, tmp_path_factory):
    """Passages of 150 to 600 bytes that lie in different surroundings, overlap, repeat in one text, or differ in one byte."""
    folder = str(tmp_path_factory.mktemp("suffixes"))
    rng = random.Random(8)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passages = [noise(n) for n in (150, 199, 200, 201, 230, 300, 450, 600)]
    texts = []
    for _ in range(120):
        parts = []
        for _ in range(rng.randrange(4)):
            p = rng.choice(passages)
            a = rng.randrange(0, 60)
            p = p[a:len(p) - rng.randrange(0, 60)] if rng.random() < 0.6 else p
            if rng.random() < 0.3 and p:
                at = rng.randrange(len(p))
                p = p[:at] + "Z" + p[at + 1:]
            parts += [noise(rng.randrange(250)), p]
        texts.append("".join(parts))
    texts += ["q" * 199, "q" * 200, "r" * 201, "r" * 500, "xy" * 300, "é" * 150, noise(250) * 2, None, "", texts[5], texts[5]]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4).write.parquet(f"{folder}/documents.parquet")
    return folder


@pytest.mark.parametrize("where", ["mixed", "odd", SF])
@pytest.mark.parametrize("hot", [3, 100_000])
def test_removed_bytes(spark, request, read, same, monkeypatch, where, hot):
    folder = where if "/" in where else request.getfixturevalue(where)
    monkeypatch.setattr(sm.repeated, "__defaults__", (hot,))
    monkeypatch.setattr(sm, "MERGE_ROWS", 200)
    out = sm.op10_suffix_dedup(spark, folder).collect()
    same([tuple(r) for r in out], expected(read(folder)))


def test_every_repeated_string_has_its_anchor_in_both_places():
    rng = np.random.default_rng(2)
    shared = rng.integers(97, 105, 260, dtype=np.uint8)
    for _ in range(20):
        places = []
        for _ in range(2):
            before = rng.integers(97, 105, rng.integers(0, 300), dtype=np.uint8)
            data = np.concatenate([before, shared, rng.integers(97, 105, 150, dtype=np.uint8)])
            _, anchor, first, last = sm.anchors(data, np.array([0, len(data)]), sm.Hasher(data))
            of = {s: a - s for a, f, t in zip(anchor, first, last) for s in range(f, t + 1)}
            assert set(of) == set(range(len(data) - sm.LENGTH + 1)) and all(0 <= d < sm.PICK for d in of.values())
            places.append([of[len(before) + k] for k in range(len(shared) - sm.LENGTH + 1)])
        assert places[0] == places[1]


def test_merged_order_is_the_sorted_order():
    rng = np.random.default_rng(3)
    block = np.sort(rng.integers(0, 5, 300))
    after = rng.integers(0, 3, (300, 20), dtype=np.uint8)
    after[50:90] = after[50]
    order, common = sm.merged_order(block, after)
    rows = [(int(block[i]), after[i].tobytes()) for i in order]
    assert rows == sorted(rows)
    for k in range(1, len(rows)):
        want = -1 if rows[k][0] != rows[k - 1][0] else next((j for j in range(20) if rows[k][1][j] != rows[k - 1][1][j]), 20)
        assert common[k] == want


def test_empty(spark, bare):
    assert sm.op10_suffix_dedup(spark, bare).count() == 0
