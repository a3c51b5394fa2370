import random
import re
import time

import pytest
from pyspark.sql import functions as F

from millrace.llm import licenses as li
from tests.llm.conftest import SF


def grams(text):
    words = re.findall("[a-z0-9]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i:i + 2]) for i in range(max(1, len(words) - 1))} if words else set()


TEMPLATES = [(name, grams(text)) for name, text in li.NOTICES]


def expected(text, templates=TEMPLATES):
    lines = (text or "").split("\n")
    found = []
    for at, unit in [*enumerate(lines), *([(-1, text)] if len(lines) > 1 else [])]:
        own = grams(unit)
        found += [(at, name, 2_000_000 * len(own & g) // (len(own) + len(g))) for name, g in templates if own and g]
    found = [f for f in found if f[2] >= 800_000]
    return len({f[0] for f in found}), ",".join(sorted({f[1] for f in found})), max((f[2] for f in found), default=0), bool(found)


TEXTS = [
    "Released under the MIT License.", "RELEASED!! UNDER!! THE!! MIT!! LICENSE!!", "some text\nLicensed under CC BY-NC 4.0.\nmore",
    "This work is licensed under the GNU General Public License, version 2.", "mit", "MIT License", None, "", "\n\n...\n",
    "Permission is hereby granted, free of charge,\nto any person obtaining a copy of this software and\nassociated documentation files "
    "(the Software), to deal\nin the Software without restriction.", "the the the " * 5000, "Released under the MIT License. " * 40,
    "x " * 100 + "Released under the MIT License.", "R\u00e9leased under the MIT License.", "Licensed under the Apache License, Version 2.0.\n" * 3,
    "Released under the license of MIT", "word",
]


@pytest.mark.parametrize("where", ["odd", SF])
def test_query(spark, request, read, same, where):
    folder = where if "/" in where else request.getfixturevalue(where)
    same([tuple(r) for r in li.op2_license_dice(spark, folder).collect()], [(d["doc_id"], *expected(d["text"])) for d in read(folder)])


def test_texts(spark, same, tmp_path):
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = [tuple(r) for r in li.op2_license_dice(spark, str(tmp_path)).collect()]
    same(out, [(i, *expected(t)) for i, t in enumerate(TEXTS)])
    licensed = {r[0]: r[2] for r in out if r[4]}
    assert licensed[0] == licensed[1] == "MIT" and licensed[2] == "CC-BY-NC-4.0" and licensed[9] == "MIT" and 4 not in licensed


def test_templates_of_a_table(spark, same):
    rows = [("own", "word"), ("own2", "You may share this text with friends"), (None, "x"), ("none", None), ("void", "...")]
    templates = spark.createDataFrame(rows, "license string, text string")
    docs = spark.createDataFrame([(i, t, "kept") for i, t in enumerate([*TEXTS, "you may share this text with your friends"])],
                                 "doc_id long, text string, licenses_seen string")
    known = [(n, grams(t)) for n, t in rows if n and t]
    out = li.scan(docs, templates)
    assert out.columns == [*docs.columns, "licenses"]
    got = {r["doc_id"]: sorted((m["unit"], m["license"], m["dice"]) for m in r["licenses"]) for r in out.collect()}
    for i, text in enumerate([*TEXTS, "you may share this text with your friends"]):
        want = expected(text, known)
        assert (len({m[0] for m in got[i]}), ",".join(sorted({m[1] for m in got[i]})), bool(got[i])) == (want[0], want[1], want[3])
    assert got[16] == [(0, "own", 1_000_000)] and not got[17]
    assert li.scan(docs, templates.limit(0)).where("size(licenses) > 0").isEmpty()


def test_template_of_a_whole_text(spark):
    text = (li.TEXTS / "GPL-3.0.txt").read_text()
    templates = spark.createDataFrame([("GPL-3.0", text)], "license string, text string")
    out = li.scan(spark.createDataFrame([(1, text)], "doc_id long, text string"), templates).first()
    assert [tuple(m) for m in out["licenses"]] == [(-1, "GPL-3.0", 1_000_000)]


def test_empty_and_native(spark, bare, odd):
    assert li.op2_license_dice(spark, bare).count() == 0
    plan = li.op2_license_dice(spark, odd)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def brute(text, templates):
    """The best of all windows of every template, the shortest of equals, and of overlapping ones the best."""
    words = re.findall("[a-z0-9]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    pairs = list(zip(words, words[1:]))
    found = []
    for name, notice in templates:
        own, n = grams(notice), len(re.findall("[A-Za-z0-9]+", notice)) - 1
        windows = []
        for at in range(len(pairs)):
            if pairs[at] in own and not (at and pairs[at - 1] in own):
                for length in range(1, n * 3 // 2 + 1):
                    window = set(pairs[at:at + length])
                    both = len(window & own)
                    windows.append((2_000_000 * both // (len(window) + len(own)), both, at, -length))
        if windows and max(windows)[0] >= 800_000:
            found.append((name, *max(windows)))
    return sorted((name, dice) for name, dice, both, at, length in found
                  if not any(a < at - length and at < a - n and (k, d) > (both, dice) for _, d, k, a, n in found))


def embedded():
    prose = "the quick brown fox jumps over lazy dogs and the rest of the story goes on for a while " * 12
    for path in sorted(li.TEXTS.glob("*.txt")):
        notice = path.read_text()
        yield re.sub(r"\.(notice|permission)$", "", path.stem), prose + "\n" + "\n".join(" * " + line for line in notice.split("\n")) + "\n" + prose
    permission = (li.TEXTS / "MIT.permission.txt").read_text()
    yield "MIT", " ".join(permission.split())
    yield "MIT", prose + "This project is released under the MIT License. " + prose
    yield "Apache-2.0", "// " + "\n// ".join("Licensed under the Apache License,\nVersion 2.0.".split("\n")) + "\nint main() {}\n" + prose


def test_passages_are_found_wherever_they_stand(spark, tmp_path):
    cases = [*embedded(), ("", "the quick brown fox " * 300), ("", None), ("", "mit")]
    spark.createDataFrame([(i, t) for i, (_, t) in enumerate(cases)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = {r["doc_id"]: r for r in li.op2_license_passages(spark, str(tmp_path)).collect()}
    for i, (name, _) in enumerate(cases):
        assert out[i]["licenses"] == name and out[i]["licensed"] == bool(name), (name, out[i])


def test_passages_equal_all_windows(spark):
    templates = list(li.NOTICES)
    texts = [*(t for t in TEXTS if t is None or len(t) < 2000), "a b c " * 20 + "Licensed under the Apache big License, Version 2.0. " + "d e f " * 20,
             "Released under the MIT License. some other words. Released under the License of MIT. " * 5]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = docs.select("doc_id", li.passages(spark, docs["text"], templates).alias("m")).collect()
    for r in got:
        assert sorted(map(tuple, r["m"])) == brute(texts[r["doc_id"]], templates), texts[r["doc_id"]]


def test_every_length_of_a_long_template_is_tried(spark):
    """Passages just above and just below the least coefficient, by foreign words and by missing ones."""
    words = [f"w{i % 61}x{i // 3}" for i in range(150)]
    templates = [("long", " ".join(words))]
    texts, rng = [], random.Random(5)
    for k in range(60):
        kept = words[rng.randrange(0, 45):150 - rng.randrange(0, 12)]
        for _ in range(rng.randrange(0, 16)):
            kept.insert(rng.randrange(len(kept) + 1), f"foreign{rng.randrange(4)}")
        texts.append(" ".join(["before"] * k + kept + ["after"] * 40 + words[:k]))
    want = [brute(t, templates) for t in texts]
    assert 10 < sum(map(bool, want)) < 55
    got = spark.createDataFrame(list(enumerate(texts)), "i long, text string").select("i", li.passages(spark, F.col("text"), templates).alias("m")).collect()
    assert [sorted(map(tuple, r["m"])) for r in sorted(got)] == want


def test_broken_quotes_take_time_with_their_length(spark):
    """A long text quoted again and again with a foreign word after every sixth: the passes are linear."""
    words = (li.TEXTS / "MPL-2.0.txt").read_text().split()
    broken = " ".join(w if i % 6 else w + " foreign" for i, w in enumerate(words))
    templates = [t for t in li.whole_templates() if t[0] == "MPL-2.0"]

    def seconds(copies):
        docs = spark.createDataFrame([(1, " ".join([broken] * copies))], "i long, text string")
        start = time.monotonic()
        names = {m["license"] for m in docs.select(li.passages(spark, F.col("text"), templates).alias("m")).first()["m"]}
        return time.monotonic() - start, names

    seconds(1)
    (one, names), (four, more) = seconds(2), seconds(8)
    assert names == more and four < 12 * max(one, 0.5)


def test_passages_hold_lines_and_are_native(spark, odd, bare):
    lines = li.op2_license_dice(spark, SF).select("doc_id", "best_dice", "licensed")
    held = lines.join(li.op2_license_passages(spark, SF).toDF("doc_id", "l", "best", "found"), "doc_id")
    assert held.where("licensed AND NOT found OR best < best_dice").isEmpty() and held.where("licensed").count() > 0
    assert li.op2_license_passages(spark, bare).count() == 0
    assert not re.search("Python|Pandas|Arrow|Exchange", li.op2_license_passages(spark, odd)._jdf.queryExecution().executedPlan().toString())
