import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import toxicity as tx


@pytest.fixture(scope="module")
def decoder(spark):
    words = ["you are an idiot", "what a loser", "pathetic trash and scum", "the quick brown fox", "a stupid disgusting moron", "in the house"]
    docs = spark.createDataFrame([(" ".join(words),)] * 50, "text string")
    return tx.Decoder(tx.letter_model(docs))


@pytest.mark.parametrize("signs,word", [
    ("1d10t", "idiot"), ("i d i o t", "idiot"), ("iiidiooot", "idiot"), ("p@thet1c", "pathetic"), ("l0$er", "loser"), ("tr4sh", "trash"),
    ("s.c.u.m", "scum"), ("st*pid", "stupid"), ("m-o-r-o-n", "moron"), ("idiot", "idiot"), ("", "")])
def test_restored(decoder, signs, word):
    assert decoder.decode(signs) == word


def brute(decoder, signs, apart):
    """The best way over all choices, for short signs."""
    best = [(-1e9, "")]

    def walk(i, a, b, score, letters):
        if i == len(signs):
            score += float(decoder.model[a, b, 0])
            if score > best[0][0]:
                best[0] = (score, letters)
            return
        for letter, cost in decoder.options(signs[i], signs[i - 1] if i else "", apart):
            if letter is None or (letter == 0 and b == 0):
                walk(i + 1, a, b, score - cost, letters)
            else:
                walk(i + 1, b, letter, score - cost + float(decoder.model[a, b, letter]),
                     letters + (tx.LETTERS[letter - 1] if letter else " "))

    walk(0, 0, 0, 0.0, "")
    return best[0][1]


@pytest.mark.parametrize("apart", [False, True])
@pytest.mark.parametrize("signs", ["1d10t", "l0$3r", "a b c", "$$!", "s.c-u m", "11!!", "xx*"])
def test_viterbi_finds_the_best_way(decoder, signs, apart):
    assert decoder.decode(signs, apart) == brute(decoder, signs, apart)


def test_plain_words_stay(decoder):
    assert tx.words_of("house,", decoder) == ["house"] and tx.words_of("...", decoder) == []
    assert tx.words_of("9807915762804490", decoder) == ["9807915762804490"]


def test_letter_counts_grow_with_all_documents(spark):
    one = spark.createDataFrame([("ab ab",), (None,), ("",)], "text string")
    n = lambda df: tx.letter_counts(df).agg(F.sum("n")).first()[0]
    assert n(one.unionAll(one)) == pytest.approx(2 * n(one), abs=4)


def area(score, label):
    rank = np.argsort(np.argsort(score)) + 1
    p = label == 1
    return (rank[p].sum() - p.sum() * (p.sum() + 1) / 2) / (p.sum() * (~p).sum())


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    out = tx.op3_toxicity_channel(spark, folder).toPandas()
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas()
    assert len(out) == out["doc_id"].nunique() == 10_000 and out["score"].between(0, 1).all()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out.itertuples())
    assert (out["predicted"] == (out["score"] >= 0.5)).all()
    held = out[out["held_out"]].merge(labels, on="doc_id")
    assert area(held["score"].to_numpy(), held["toxic"].to_numpy()) > 0.97
    assert held.loc[held["predicted"] == 1, "toxic"].mean() > 0.95 and held.loc[held["toxic"] == 1, "predicted"].mean() > 0.8


def test_disguise_raises_the_score(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    fitted = tx.fit(docs, labels)
    clean = docs.where("doc_id = 1").first()["text"]
    texts = [clean + more for more in ("", " idiot scum", " 1d10t $cum", " i.d.i.o.t, s c u m.", " idiooot sssscum", " !diot 5cum")]
    score = [r["score"] for r in tx.scored(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1), fitted)
             .orderBy("doc_id").collect()]
    assert score[0] < 0.2 and all(s >= 0.5 for s in score[1:]), score


def test_held_out_labels_teach_nothing(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    labels = spark.read.parquet(f"{odd}/labels.parquet")
    flipped = labels.withColumn("toxic", F.when(tx.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(map(repr, tx.scored(docs, tx.fit(docs, x)).collect())) for x in (labels, flipped))
    assert a == b


def test_odd_rows_and_empty(spark, odd, bare):
    out = tx.op3_toxicity_channel(spark, odd).collect()
    assert len(out) == spark.read.parquet(f"{odd}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 for r in out) and all(r["held_out"] for r in out if r["doc_id"] is None)
    assert tx.op3_toxicity_channel(spark, bare).count() == 0
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    assert tx.scored(docs, tx.fit(docs, spark.read.parquet(f"{bare}/labels.parquet"))).where("score <> 0").isEmpty()


LOOKS = str.maketrans("aiose", "@!0$3")
APART_ = lambda w: " ".join(w)
SIGNS = lambda w: w.translate(LOOKS)
INSIDE = lambda sign: lambda w: w[:len(w) // 2] + sign + w[len(w) // 2:]
WAYS = {
    "plain": str, "signs": SIGNS, "apart": APART_, "dotted": ".".join, "signs apart": lambda w: APART_(SIGNS(w)),
    **{f"inside {s}": INSIDE(s) for s in ".-_'`~"}, "signs, inside -": lambda w: INSIDE("-")(SIGNS(w)), "signs, dotted": lambda w: ".".join(SIGNS(w)),
}


@pytest.mark.parametrize("text,runs", [
    ("you s h ! t now", ["s h ! t"]), ("$ t u p i d", ["$ t u p i d", "t u p i d"]), ("an @ s s h o l e!", ["@ s s h o l e", "s s h o l e"]), ("f u k", ["f u k"]), ("s~c~u~m, d'o'g", ["s~c~u~m", "d'o'g"]),
    ("* $ # ", []), ("s c u m$$$ t$$$ (i d 1 o t)", ["s c u m", "i d 1 o t"]), ("f * c k", ["f * c k"]), ("a b", []), ("* * * *", []), ("word - word $100 ...", []), ("x" + "*" * 5000 + "ab", [])])
def test_runs_of_symbols(text, runs):
    assert list(tx.runs_apart(text)) == runs


@pytest.mark.parametrize("signs,words", [("stu-pid", ["stupid"]), ("st.upid", ["stupid"]), ("stu_pid", ["stupid"]), ("st~up!d", ["stupid"]), ("id'1ot", ["idiot"])])
def test_fillers_within_a_word(decoder, signs, words):
    assert tx.words_of(signs, decoder) == words


def test_held_out_recall_of_disguised_documents(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = docs.join(labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "doc_id").where("toxic IS NOT NULL") \
        .select("doc_id", "text", "toxic", tx.held_out(F.col("doc_id")).alias("held")).toPandas()
    words = [set(re.findall(r"[^\W\d_]+", (t or "").lower())) for t in rows["text"]]
    seen = {1: Counter(), 0: Counter()}
    for own, toxic, held in zip(words, rows["toxic"], rows["held"]):
        if not held:
            seen[toxic].update(own)
    n = rows.loc[~rows["held"], "toxic"].value_counts()
    marked = {w for w, k in seen[1].items() if len(w) > 3 and k >= 5 and k / n[1] > 10 * seen[0][w] / n[0]}
    texts = rows.loc[rows["held"] & (rows["toxic"] == 1), "text"].tolist()
    cases = [(way, re.sub(r"[^\W\d_]+", lambda m: change(m[0].lower()) if m[0].lower() in marked else m[0], text))
             for way, change in WAYS.items() for text in texts]
    fitted = tx.fit(docs, labels)
    out = tx.scored(spark.createDataFrame([(i, t) for i, (_, t) in enumerate(cases)], "doc_id long, text string"), fitted).toPandas()
    hit = {r.doc_id: r.score >= 0.5 for r in out.itertuples()}
    recall = {way: np.mean([hit[i] for i, (w, _) in enumerate(cases) if w == way]) for way in WAYS}
    print(len(marked), len(texts), {w: round(float(r), 3) for w, r in recall.items()})
    assert all(r >= recall["plain"] - 0.05 for r in recall.values()), recall


def test_sample_is_bounded_when_ids_repeat(spark):
    docs = spark.range(100_000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 50).alias("text"))
    docs = docs.unionByName(spark.range(200).select((F.col("id") + 100).alias("doc_id"), F.lit("plain").alias("text")))
    labels = docs.select("doc_id").distinct().withColumn("toxic", F.col("doc_id") % 2)
    ids = [r["doc_id"] for r in tx.train_sample(docs, labels).collect()]
    assert len(ids) == len(set(ids)) <= 201 and len(tx.train_sample(docs, labels, 20).collect()) == 20
