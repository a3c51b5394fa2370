"""Quality rules: counts of words, symbols and repeats, and a likelihood ratio against trusted text.

Every document's hashed word n-grams are scored by how much likelier they are under a multinomial of trusted
documents than under one of the whole corpus; the mean over its n-grams is the score. Counts of the corpus come
from all documents. Trusted documents are all rows labelled as good: a seeded half gives the trusted counts; all of
the other half, scored as the unseen text it is, gives the threshold, set below nearly all of it. Ratios are whole
numbers (fixed point), so a score does not depend on how rows are batched.

Base rules reject documents of fewer than 50 words and those of which more than half the words lie in repeated
three-word windows.

Defined results: a null text is an empty one; a document without words has score 0 and fails the base rules. A
repeated row is judged like any other and counts each time in the corpus counts. Without trusted rows (empty or
unlabelled tables) every ratio is 0 and the base rules alone decide. Ids may be null or repeated; a trusted id
that several rows share stands for all of them. Columns beyond id and text are passed through unread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm.tables import documents, in_batches, perhaps_among, saved, table
from millrace.llm.words import SPACE, U, Hasher, Words, mixed, steps, sums_between, windows
from millrace.sinks.tables import COMPRESSION

MIN_WORDS, REPEAT_PERCENT, WINDOW = 50, 50, 3
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
BUCKET_BITS = 16
ORDERS = (1, 2)
#: The threshold lies below this share of unseen trusted text, by ``MARGIN`` times the way from the median to there.
TRUSTED_LOSS, MARGIN = 0.002, 0.5
#: Added to each bucket's count before ratios are taken.
SMOOTHING = 1.0
FIXED_POINT = 1 << 20
#: Steps of a score that the threshold is found in: their counts meet in one task, not the scores of all rows.
SCORE_STEPS = 1 << 16

BASE_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeats_before(keys: np.ndarray) -> np.ndarray:
    """Marks the elements that equal an earlier one."""
    order = np.argsort(keys, kind="stable")
    again = np.zeros(len(keys), bool)
    again[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    return again


def base_counts(data: np.ndarray, offsets: np.ndarray, words: Words, hashes: np.ndarray) -> dict[str, np.ndarray]:
    texts = len(offsets) - 1
    characters = words.inside & ((data & 0xC0) != 0x80)
    line_starts = np.union1d(offsets[:-1][np.diff(offsets) > 0], np.flatnonzero(data == 10) + 1)
    line_starts = line_starts[line_starts < len(data)]
    line_ends = np.append(line_starts[1:], len(data))
    # a line ends before its break; the last one of a text has none
    line_ends = line_ends - (data[line_ends - 1] == 10) if len(line_starts) else line_ends[:0]
    spoken = np.searchsorted(words.starts, line_ends) > np.searchsorted(words.starts, line_starts)
    line_starts, line_ends = line_starts[spoken], line_ends[spoken]
    line_text = np.searchsorted(offsets, line_starts, side="right") - 1
    line_keys = Hasher(data)(line_starts, line_ends) + mixed(line_text.astype(np.uint64) + U(1))
    duplicate = _repeats_before(line_keys)

    grams, at = windows(hashes, words.first, WINDOW)
    gram_text = np.searchsorted(words.first, at, side="right") - 1
    _, place, count = np.unique(grams + mixed(gram_text.astype(np.uint64) + U(1)), return_inverse=True, return_counts=True)
    twice = at[count[place] > 1]
    edges = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edges, twice, 1)
    np.add.at(edges, twice + WINDOW, -1)
    covered = np.cumsum(edges[:-1]) > 0
    return {
        "n_words": words.counts.astype(np.int64),
        "word_chars": sums_between(characters, offsets),
        "n_symbols": sums_between(SYMBOLS[data], offsets),
        "n_dup_lines": np.bincount(line_text[duplicate], minlength=texts).astype(np.int64),
        "n_repeat_words": sums_between(covered, words.first),
    }


def features(hashes: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram and the text it is in."""
    found = []
    for order in ORDERS:
        grams, at = windows(hashes, words.first, order)
        found.append(((grams >> U(64 - BUCKET_BITS)).astype(np.int64), np.searchsorted(words.first, at, side="right") - 1))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns text, trusted: counts of the task's buckets, once at its end; a trusted text comes as one of the corpus too."""
    size = 1 << BUCKET_BITS
    raw, trusted = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for batch in batches:
        marks = batch.column(1).to_numpy(zero_copy_only=False)
        for lo, hi, data, offsets in steps(batch.column(0)):
            words = Words(data, offsets, SPACE)
            buckets, text = features(words.hashes(), words)
            mark = marks[lo:hi][text]
            raw += np.bincount(buckets[~mark], minlength=size)
            trusted += np.bincount(buckets[mark], minlength=size)
    some = np.flatnonzero(raw + trusted)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(trusted[some])],
                                     names=["bucket", "raw", "trusted"])


def trusted_sample(labels: DataFrame, rows: int | None = None) -> DataFrame:
    """The ids labelled as good, with ``rows`` at most that many by a seeded order; every second one is held for the threshold."""
    ids = labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    if rows is not None:
        ids = ids.orderBy(F.xxhash64(F.lit(7), "doc_id"), "doc_id").limit(rows)
    return ids.select("doc_id", (F.pmod(F.xxhash64(F.lit(8), "doc_id"), F.lit(2)) == 0).alias("counted"))


def trusted_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """The texts of the sample's rows; only they, and few others, are shuffled, in the same way for any number of them."""
    near = perhaps_among(docs.select("doc_id", "text"), sample, "doc_id")
    return near.join(sample.hint("merge"), "doc_id").select("text", "counted")


def ratios(docs: DataFrame, sample: DataFrame) -> np.ndarray:
    """Log ratio of trusted to raw share for each bucket, as whole numbers."""
    return ratios_of(docs, trusted_texts(docs, sample))


def ratios_of(docs: DataFrame, trusted: DataFrame) -> np.ndarray:
    """The same, of the counted rows among trusted texts. The driver gets one row a bucket."""
    texts = docs.select("text", F.lit(False).alias("trusted")).unionByName(
        trusted.where("counted").select("text", F.lit(True).alias("trusted")))
    counts = (in_batches(texts, _count, "bucket long, raw long, trusted long").groupBy("bucket")
              .agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted")).toPandas())
    size = 1 << BUCKET_BITS
    raw, trusted = np.zeros(size), np.zeros(size)
    raw[counts["bucket"]], trusted[counts["bucket"]] = counts["raw"], counts["trusted"]
    if not trusted.sum():
        return np.zeros(size, np.int64)
    # what the trusted counts lack is filled in from the corpus, in proportion
    prior = SMOOTHING * size * (raw + 1) / (raw + 1).sum()
    ratio = np.log((trusted + prior) / (trusted + prior).sum()) - np.log((raw + 1) / (raw + 1).sum())
    return np.rint(ratio * FIXED_POINT).astype(np.int64)


def scores(data: np.ndarray, offsets: np.ndarray, words: Words, hashes: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """Mean ratio of each text's n-grams; 0 for a text without any."""
    buckets, text = features(hashes, words)
    # sums of whole numbers below 2^53 are exact in floating point
    total = np.bincount(text, ratio[buckets], len(words.counts))
    number = np.bincount(text, minlength=len(words.counts))
    return total / np.maximum(number, 1) / FIXED_POINT


def judge(column: pa.Array, ratio: np.ndarray, threshold: float) -> dict[str, np.ndarray]:
    """The counts, the score and the verdict for every text of a column."""
    parts = []
    for _, _, data, offsets in steps(column):
        words = Words(data, offsets, SPACE)
        hashes = words.hashes()
        out = base_counts(data, offsets, words, hashes)
        out["score"] = scores(data, offsets, words, hashes, ratio)
        parts.append(out)
    if not parts:
        return {c: np.zeros(0) for c in (*BASE_COLUMNS, "score", "base_failed", "kept")}
    out = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
    out["base_failed"] = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > REPEAT_PERCENT * out["n_words"])
    out["kept"] = ~out["base_failed"] & (out["score"] >= threshold)
    return out


def fit(docs: DataFrame, labels: DataFrame, rows: int | None = None, loss: float = TRUSTED_LOSS) -> tuple[np.ndarray, float]:
    """Ratios and threshold. Docs are read once for the trusted texts, which are written, and once for the counts."""
    sample = saved(trusted_sample(labels, rows), "trusted")
    trusted = saved(trusted_texts(docs, sample), "trusted-texts", compression=COMPRESSION)
    ratio = ratios_of(docs, trusted)

    def held(batches):
        for batch in batches:
            out = judge(batch.column(0), ratio, 0.0)
            yield pa.RecordBatch.from_arrays([pa.array(out["score"][~out["base_failed"].astype(bool)], pa.float64())], names=["score"])

    unseen = trusted.where("NOT counted").select("text")
    step = (F.round(F.col("score") * SCORE_STEPS) / SCORE_STEPS).alias("score")
    often = in_batches(unseen, held, "score double").groupBy(step).agg(F.count(F.lit(1)).alias("n"))
    at = often.agg(F.percentile("score", F.lit(loss), F.col("n")).alias("low"),
                   F.percentile("score", F.lit(0.5), F.col("n")).alias("median")).first()
    if at["low"] is None or not ratio.any():
        return ratio, float("-inf")
    return ratio, at["low"] - MARGIN * (at["median"] - at["low"])


def judged(docs: DataFrame, ratio: np.ndarray, threshold: float) -> DataFrame:
    """One row for each document: its id, counts, score and verdict."""

    def run(batches):
        for batch in batches:
            out = judge(batch.column(1), ratio, threshold)
            columns = [batch.column(0), *(pa.array(out[c].astype(np.int64)) for c in BASE_COLUMNS),
                       pa.array(out["score"].astype(float)),
                       *(pa.array(out[c].astype(bool)) for c in ("base_failed", "kept"))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *BASE_COLUMNS, "score", "base_failed", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {', '.join(f'{c} long' for c in BASE_COLUMNS)}, score double, base_failed boolean, kept boolean"
    return in_batches(docs.select("doc_id", "text"), run, schema)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep."""
    ratio, threshold = fit(docs, labels)
    place = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            kept = judge(batch.column(place), ratio, threshold)["kept"].astype(bool)
            yield batch.filter(pa.array(kept))

    return in_batches(docs, run, docs.schema)


def op5_quality_ratio(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return judged(docs, *fit(docs, table(spark, folder, "labels")))
