import random
import re
from collections import Counter
from itertools import permutations

import pytest

from millrace.llm.filter_audit import FILTERS, Diagram, audit, audited, failure_masks, op11_filter_audit, plain_changes
from tests.llm.conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()


def plain(docs, labels):
    """Every order applied to every document."""
    smallest = {}
    for d in docs:
        if d["doc_id"] is not None:
            t = d["text"] or ""
            smallest[t] = min(smallest.get(t, d["doc_id"]), d["doc_id"])
    good = {r["doc_id"] for r in labels if r["doc_id"] is not None and r["quality"] == 1}
    toxic = {r["doc_id"] for r in labels if r["doc_id"] is not None and r["toxic"] == 1}
    rows = []
    for d in docs:
        t = d["text"] or ""
        w = WORD.findall(t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
                 "D": bool(re.search("[#$%&*|]", t)), "E": d["doc_id"] is not None and d["doc_id"] > smallest[t]}
        rows.append((d["lang"] or "", {f for f in fails if fails[f]}, d["doc_id"] in good, d["doc_id"] in toxic))
    out = []
    for part in {r[0] for r in rows}:
        own, shapley = [r for r in rows if r[0] == part], Counter()
        steps = []
        for order in permutations(FILTERS):
            left = own
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                failing = [r for r in own if f in r[1]]
                shapley[f] += len(gone)
                steps.append((f, (part, "".join(order), step, len(left), len(gone), len(failing) - len(gone),
                                  sum(r[1] == {f} for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone))))
        out += [(*s, shapley[f]) for f, s in steps]
    return out


@pytest.mark.parametrize("folder", ["odd", SF])
def test_equals_filtering_in_every_order(spark, request, read, same, folder):
    folder = folder if "/" in folder else request.getfixturevalue(folder)
    same([tuple(r[c] for c in COLUMNS) for r in op11_filter_audit(spark, folder).collect()], plain(read(folder), read(folder, "labels")))


def test_every_swap_gives_the_next_order():
    for n in range(1, 6):
        order, seen = list(range(n)), {tuple(range(n))}
        for place in plain_changes(n):
            order[place:place + 2] = order[place + 1], order[place]
            seen.add(tuple(order))
        assert seen == set(permutations(range(n)))


def test_diagram_keeps_its_counts_and_shares_nodes():
    counts = {m: (1 + m % 3, m % 2, 0) for m in range(32) if m % 5}
    diagram = Diagram(FILTERS, counts)
    before, size = diagram.steps(), [len(level) for level in diagram.levels]
    assert size[-1] < 16  # equal branches are one node
    for place in [3, 0, 2, 1, 1, 2, 0, 3]:
        diagram.swap(place)
        assert diagram.root.counts == tuple(map(sum, zip(*counts.values())))
    assert "".join(diagram.order) == FILTERS and diagram.steps() == before and [len(level) for level in diagram.levels] == size


def test_few_filters_and_no_rows():
    assert audited("X", {0: (3, 1, 0), 1: (2, 1, 1)}) == [("X", 1, 3, 2, 0, 2, 1, 1, 2)]
    rows = audited("XY", {3: (4, 0, 0)})
    assert sorted((r[0], r[1], r[3], r[4]) for r in rows) == [("XY", 1, 4, 0), ("XY", 2, 0, 4), ("YX", 1, 4, 0), ("YX", 2, 0, 4)]


def test_copies_without_ids_and_with_repeated_ids(spark):
    docs = spark.createDataFrame([(None, "same", "x"), (5, "same", "x"), (5, "same", "y"), (9, "same", "x"), (3, None, None), (4, "", "x")],
                                 "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(5, 1, None), (5, 0, 1), (None, 1, 1)], "doc_id long, quality long, toxic long")
    found = sorted((r["part"], r["mask"], r["good"], r["toxic"]) for r in failure_masks(docs, labels).collect())
    assert found == [("", 1, False, False), ("x", 1, False, False), ("x", 1, True, True), ("x", 17, False, False), ("x", 17, False, False), ("y", 1, True, True)]


def test_one_part_with_many_rows_and_a_hot_text(spark):
    rng = random.Random(2)
    rows = [(i, "copy of one text" if i % 3 else f"text {rng.random()}", "en") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality long, toxic long")
    out = {(r["filter_order"], r["step"]): r for r in audit(failure_masks(docs, labels)).collect()}
    assert out["EABCD", 1]["removed"] == 1999 and out["EABCD", 2]["removed"] == 1001 and out["ABCDE", 1]["removed"] == 3000
    assert out["ABCDE", 5]["redundant"] == 1999


def test_empty_tables_and_too_many_filters(spark, bare):
    assert op11_filter_audit(spark, bare).count() == 0
    with pytest.raises(ValueError):
        audit(spark.createDataFrame([], "part string, mask int, good boolean, toxic boolean"), "ABCDEFGHI")
