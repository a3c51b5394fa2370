import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.llm.quality import fit, judged, keep_good, op5_quality_ratio, trusted_sample
from tests.llm.conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if often[g] > 1:
            covered.update((i, i + 1, i + 2))
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed)


@pytest.mark.parametrize("folder", ["odd", SF])
def test_base_counts(spark, request, read, same, folder):
    folder = folder if "/" in folder else request.getfixturevalue(folder)
    out = op5_quality_ratio(spark, folder).collect()
    same([(r["doc_id"], *(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))) for r in out],
         [(d["doc_id"], *counts(d["text"])) for d in read(folder)])
    assert not any(r["kept"] and r["base_failed"] for r in out)


def test_verdict_follows_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    out = op5_quality_ratio(spark, folder).join(labels, "doc_id").where("NOT base_failed").groupBy("quality", "kept").count().collect()
    n = {(r["quality"], r["kept"]): r["count"] for r in out}
    assert n[1, True] >= 0.98 * (n[1, True] + n.get((1, False), 0))
    assert n[0, False] >= 0.9 * (n[0, False] + n.get((0, True), 0))


def test_ratio_is_that_of_the_multinomials(spark):
    """A plain count of words and pairs of words gives the same ratios, for words alone in their bucket."""
    import math

    import numpy as np

    from millrace.llm import quality
    from millrace.llm.words import SPACE, Words, windows

    docs = spark.createDataFrame([(i, "good fine good text" if i % 2 else "bad worse junk bad") for i in range(40)], "doc_id long, text string")
    sample = spark.createDataFrame([(i, True) for i in range(1, 40, 2)], "doc_id long, counted boolean")
    ratio = quality.ratios(docs, sample)
    size = 1 << quality.BUCKET_BITS

    def at(text):
        data = np.frombuffer(text.encode(), np.uint8)
        words = Words(data, np.array([0, len(data)]), SPACE)
        h, _ = windows(words.hashes(), words.first, len(words.starts))
        return int(h[0] >> np.uint64(64 - quality.BUCKET_BITS))

    raw = Counter()
    for i in range(40):
        w = ("good fine good text" if i % 2 else "bad worse junk bad").split()
        raw.update([*w, *(" ".join(p) for p in zip(w, w[1:]))])
    total = sum(raw.values())
    for gram, trusted in (("good", 40), ("bad", 0), ("good fine", 20), ("worse junk", 0)):
        prior = size * (raw[gram] + 1) / (total + size)
        want = math.log((trusted + prior) / (140 + size)) - math.log((raw[gram] + 1) / (total + size))
        assert abs(ratio[at(gram)] / quality.FIXED_POINT - want) < 1e-5


def test_score_does_not_depend_on_batches(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    ratio, threshold = fit(docs, spark.read.parquet(f"{odd}/labels.parquet"))
    a = sorted(map(repr, judged(docs.coalesce(1), ratio, threshold).collect()))
    b = sorted(map(repr, judged(docs.repartition(7), ratio, threshold).collect()))
    assert a == b


def test_empty_and_unlabelled(spark, bare, odd):
    assert op5_quality_ratio(spark, bare).count() == 0
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    none = spark.read.parquet(f"{bare}/labels.parquet")
    kept = keep_good(docs, none)
    assert kept.columns == docs.columns
    failed = F.udf(lambda t: counts(t)[-1], "boolean")
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, docs.where(~failed("text")).collect()))


def test_sample_is_bounded(spark):
    labels = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    assert trusted_sample(labels, 100).count() == 100


def test_all_labelled_rows_are_trusted(spark, monkeypatch):
    """Beyond any number, every row labelled as good gives counts or the threshold."""
    from millrace.llm import quality

    n, seen = 20_100, []
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("some good words").alias("text"))
    sample_of = quality.trusted_sample

    def kept(*given):
        seen.append(sample_of(*given))
        return seen[-1]

    monkeypatch.setattr(quality, "trusted_sample", kept)
    fit(docs, docs.select("doc_id", F.lit(1).alias("quality")))
    assert seen[0].count() == n
    assert 0 < seen[0].where("counted").count() < n


def test_trusted_texts_are_met_without_shuffling_the_others(spark, monkeypatch):
    """All rows of the ids, repeated ones and those of few bits among them; the map leaves out most others, whatever Spark broadcasts."""
    from millrace.llm import quality, tables

    docs = spark.range(4000).select((F.col("id") % 3990).alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    docs = docs.unionByName(spark.createDataFrame([(None, "no id")], docs.schema))
    ids = spark.range(0, 4000, 7).select(F.col("id").cast("int").alias("doc_id"))
    sample = ids.withColumn("counted", F.col("doc_id") % 2 == 0)
    want = sorted((f"text {i}", i % 3990 % 2 == 0) for i in range(4000) if i % 3990 % 7 == 0)
    assert sorted(map(tuple, quality.trusted_texts(docs, sample).collect())) == want
    assert len(want) <= tables.perhaps_among(docs, ids, "doc_id").count() < len(want) + 20
    monkeypatch.setattr(tables, "MAP_BITS", 64)
    assert sorted(map(tuple, quality.trusted_texts(docs, sample).collect())) == want


def test_texts_are_shuffled_once_and_only_trusted_ones(spark, monkeypatch):
    """No join that a fit runs has all texts on a side that is shuffled, few labels or many."""
    from millrace.llm import quality

    plans, batches, write = [], quality.in_batches, quality.saved

    def seen(df, *rest, **options):
        plans.append(df._jdf.queryExecution().toString())
        return (write if isinstance(rest[0], str) else batches)(df, *rest, **options)

    monkeypatch.setattr(quality, "in_batches", seen)
    monkeypatch.setattr(quality, "saved", seen)
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("some good words").alias("text"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fit(docs, docs.select("doc_id", F.lit(1).alias("quality")).where("doc_id < 30"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    physical = [p.partition("== Physical Plan ==")[2] for p in plans]
    assert sum("SortMergeJoin" in p for p in physical) == 1
    assert "BroadcastHashJoin" in next(p for p in physical if "SortMergeJoin" in p)
