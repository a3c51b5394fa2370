"""Toxicity of whole texts, after undoing disguised spelling with a noisy-channel decoder.

Words that look disguised (letters mixed with look-alike signs or fillers, letters repeated three times and more,
three or more letters or signs written apart) become lattices: each sign may stand for the letters it looks like, be a letter itself, repeat the
one before, or be mere filler, each at a cost. A Viterbi search finds the letters that are likeliest under a
character trigram model, whose counts come from all documents. Then the restored words are scored: their stems and
forms are features of a logistic model, fitted on a bounded, seeded sample of the labelled rows.

Rows whose checksum of the id leaves 0 modulo 5 are held out: nothing is learned from their labels. Labels, ids,
languages and sources are never inputs of a score.

Defined results: null and empty texts are scored as texts without words. Repeated rows get equal scores. A row
without an id counts as held out. Without labelled rows, or with one class only, every score is 0. An empty table
gives an empty result. Other columns are never read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from millrace.llm.tables import documents, in_batches, saved, table

#: Numbers of the model's letters; everything else is a boundary, 0.
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïñòóôõöøùúûüýÿœ"
CODES = 64
CODE = np.zeros(0x160, np.int64)
CODE[[ord(c) for c in LETTERS]] = np.arange(1, len(LETTERS) + 1)

#: Letters that a sign may stand for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a",
    "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¥": "y", "*": "aeiou", "#": "h",
}
FILLERS = " .-_*~'`"
#: Costs, in natural log units, of reading a sign as a letter, as filler, or as a repeat.
AS_LETTER, AS_FILLER, AS_REPEAT, AS_NOTHING, AS_BREAK = 1.0, 0.5, 1.0, 10.0, 2.0
SIGNS = re.escape("".join(c for c in LOOKS_LIKE if not c.isalnum()))
MIXED = re.compile(rf"(?=.*[^\W\d_])(?=.*[0-9{SIGNS}{re.escape(FILLERS)}])")
REPEATED = re.compile(r"(.)\1\1")
#: Single letters, digits and signs with fillers between them: no letter or digit stands beside another. Every sign
#: fits one branch only, so a run is read once. Longer gaps and strings of signs part runs; signs that stand right at
#: the first or last letter of a run are punctuation.
APART = re.compile(rf"(?<![^\W_])(?:[^\W_](?![^\W_])|[{SIGNS}])(?:[^\W_](?![^\W_])|[{SIGNS}{re.escape(FILLERS)}])+")
GAP, FILLER = re.compile(rf"[ .\-_~'`]{{3,}}|[{SIGNS}]{{3,}}"), re.compile(r"[ .\-_~'`]+")
AT_ENDS = re.compile(rf"^[{SIGNS}]+(?=[^\W_])|(?<=[^\W_])[{SIGNS}]+$")
OUTSIDE = re.compile(r"^[\W_]+|(?<=[^\W_])[\W_]+$")
#: Symbols that make a run.
SYMBOLS = 3
LEFT, RIGHT = ".,;:?\"'()[]{}<>*#%&", ".,;:?!\"'()[]{}<>*#%&|"

STEMS = (3, 4, 5, 6, 7)
BUCKETS = 1 << 20
#: Labelled rows that are learned from, at most, and features of the model: those that tell the classes apart best. With more
#: of them no more held-out rows are caught (README has figures).
TRAIN_ROWS, FEATURES = 20_000, 400
RIDGE, ROUNDS, RATE = 0.03, 800, 0.05
#: Words whose features a task remembers.
REMEMBERED = 300_000


def codes_of(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    return np.where(points < len(CODE), CODE[np.minimum(points, len(CODE) - 1)], 0)


def letter_counts(docs: DataFrame) -> DataFrame:
    """Counts of character trigrams (as one number) over all documents."""

    def run(batches):
        counts = np.zeros(CODES ** 3, np.int64)
        for batch in batches:
            c = codes_of(f"  {'  '.join(t for t in batch.column(0).to_pylist() if t)}  ".lower())
            c = c[np.append(True, (c[1:] > 0) | (c[:-1] > 0))]  # runs of boundaries count once
            c = np.concatenate([[0], c])
            counts += np.bincount(c[:-2] * CODES ** 2 + c[1:-1] * CODES + c[2:], minlength=CODES ** 3)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["trigram", "n"])

    return in_batches(docs.select("text"), run, "trigram long, n long").groupBy("trigram").agg(F.sum("n").alias("n"))


def letter_model(docs: DataFrame) -> np.ndarray:
    """Log probability of a character after two others; the driver gets a row for each trigram at most."""
    found = letter_counts(docs).toPandas()
    counts = np.zeros(CODES ** 3)
    counts[found["trigram"]] = found["n"]
    counts = counts.reshape(CODES, CODES, CODES)
    pairs = counts.sum(axis=0) + 0.5
    pairs = pairs / pairs.sum(axis=1, keepdims=True)
    # a trigram's share leans on that of the pair where it is rare
    full = (counts + 5 * pairs[None]) / (counts.sum(axis=2, keepdims=True) + 5)
    return np.log(full).astype(np.float32)


class Decoder:
    """Restores disguised words."""

    def __init__(self, model: np.ndarray):
        self.model = model

    def options(self, sign: str, before: str, apart: bool = False) -> list[tuple[int | None, float]]:
        """Letters (or a boundary, 0, or nothing, None) that a sign may mean, and their costs.

        Between letters written ``apart`` a filler is most likely just that.
        """
        code = int(CODE[ord(sign)]) if ord(sign) < len(CODE) else 0
        found = [(code, 0.0)] if code else []
        found += [(int(CODE[ord(c)]), AS_LETTER) for c in LOOKS_LIKE.get(sign, "")]
        if sign == before:
            found.append((None, AS_REPEAT))
        if sign in FILLERS:
            found += [(None, 0.0), (0, AS_BREAK)] if apart else [(None, AS_FILLER), (0, 0.0 if sign == " " else AS_BREAK)]
        elif not code:
            found += [(None, AS_NOTHING), (0, AS_NOTHING)]
        return found

    def decode(self, signs: str, apart: bool = False) -> str:
        """The likeliest letters for the signs, with spaces for boundaries."""
        paths: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        before = ""
        for sign in signs:
            after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for letter, cost in self.options(sign, before, apart):
                for (a, b), (score, path) in paths.items():
                    if letter is None or (letter == 0 and b == 0):
                        state, value, way = (a, b), score - cost, path
                    else:
                        state, value = (b, letter), score - cost + float(self.model[a, b, letter])
                        way = (path, letter)
                    if state not in after or after[state][0] < value:
                        after[state] = (value, way)
            paths, before = after, sign
        _, way = max((score + float(self.model[a, b, 0]), way or ()) for (a, b), (score, way) in paths.items())
        letters = []
        while way:
            way, letter = way
            letters.append(LETTERS[letter - 1] if letter else " ")
        return "".join(reversed(letters))


def runs_apart(text: str) -> Iterator[str]:
    """The runs of symbols written apart, look-alike signs included.

    Signs at the ends may be of the word or of the text around it, so a run with such comes without them, too.
    """
    for found in APART.finditer(text):
        for run in GAP.split(found.group()):
            run = AT_ENDS.sub("", run.strip(FILLERS.replace("*", "")))
            for way in dict.fromkeys((run, OUTSIDE.sub("", run))):
                if sum(bool(piece.strip("*")) for piece in FILLER.split(way)) >= SYMBOLS:
                    yield way


def words_of(token: str, decoder: Decoder) -> list[str]:
    """The plain words of a token in lower case, restored if it looks disguised."""
    core = token.lstrip(LEFT).rstrip(RIGHT)
    if core.endswith("$$$"):
        core = core.rstrip(RIGHT + "$")
    if core.isalpha() and not REPEATED.search(core):
        return [core]
    if not core or not (MIXED.match(core) or REPEATED.search(core)):
        return [core] if core else []
    return decoder.decode(core).split()


def features(word: str) -> Iterator[str]:
    yield word + "$"
    for n in STEMS:
        if len(word) >= n:
            yield "^" + word[:n]


def bucket(feature: str) -> int:
    return zlib.crc32(feature.encode()) % BUCKETS


class Reader:
    """Features of texts, as numbers; words seen before are not worked out again."""

    def __init__(self, model: np.ndarray, wanted: dict[int, int] | None = None):
        self.decoder, self.wanted, self.known = Decoder(model), wanted, {}

    def of_word(self, token: str) -> tuple[int, ...]:
        found = self.known.get(token)
        if found is None:
            numbers = {bucket(f) for w in words_of(token, self.decoder) for f in features(w)}
            if self.wanted is not None:
                numbers = {self.wanted[n] for n in numbers if n in self.wanted}
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            found = self.known[token] = tuple(numbers)
        return found

    def of_text(self, text: str | None) -> tuple[set[int], int]:
        """The set of features, and the number of different tokens."""
        lowered = (text or "").lower()
        tokens = set(lowered.split())
        out: set[int] = set()
        for token in tokens:
            out.update(self.of_word(token))
        for run in runs_apart(lowered):
            for word in self.decoder.decode(run, apart=True).split():
                out.update(self.of_word(word))
        return out, len(tokens)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train_sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """Text and label of at most ``rows`` labelled documents that are not held out, by a seeded order.

    Of several documents with one id one is taken, so there are never more rows than ids.
    """
    place = F.xxhash64(F.lit(3), "doc_id")
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(place, "doc_id").limit(rows)
    one = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text")
    labelled = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").withColumn("_n", F.row_number().over(one)).where("_n = 1")
    return saved(labelled.select(place.alias("place"), "doc_id", "text", F.col("toxic").cast("int").alias("toxic")), "sample")


def chosen(sample: DataFrame, model: np.ndarray, size: int = FEATURES) -> dict[int, int]:
    """The features that tell the classes apart best, numbered: by the difference of shares over its error."""

    def run(batches):
        counts = np.zeros((2, BUCKETS), np.int64)
        reader = Reader(model)
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[toxic, list(reader.of_text(text)[0])] += 1
        some = np.flatnonzero(counts.sum(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(some), *(pa.array(counts[k, some]) for k in (0, 1))], names=["feature", "clean", "toxic"])

    total = sample.agg(F.count(F.when(F.col("toxic") == 1, 1)).alias("t"), F.count(F.when(F.col("toxic") == 0, 1)).alias("c")).first()
    if not total["t"] or not total["c"]:
        return {}
    counts = (in_batches(sample.select("text", "toxic"), run, "feature long, clean long, toxic long")
              .groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))
    share = (F.col("clean") + F.col("toxic")) / F.lit(total["t"] + total["c"])
    error = F.sqrt(F.greatest(share * (1 - share), F.lit(1e-9)))
    gap = F.col("toxic") / F.lit(total["t"]) - F.col("clean") / F.lit(total["c"])
    best = counts.where("clean + toxic >= 3").orderBy(F.desc(gap / error), "feature").limit(size).collect()
    return {r["feature"]: k for k, r in enumerate(best)}


def _read(reader: Reader, texts: Iterable[str | None]) -> tuple[list[list[int]], list[int]]:
    pairs = [reader.of_text(t) for t in texts]
    return [sorted(p[0]) for p in pairs], [p[1] for p in pairs]


def length_feature(tokens) -> np.ndarray:
    return np.log1p(np.asarray(tokens, float)) - 5.0


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, dict[int, int], np.ndarray] | None:
    """Letter model, numbered features, and weights (features, length, constant)."""
    model = letter_model(docs)
    sample = train_sample(docs, labels, rows)
    wanted = chosen(sample, model)
    if not wanted:
        return None

    def run(batches):
        reader = Reader(model, wanted)
        for batch in batches:
            found, tokens = _read(reader, batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), pa.array(found, pa.list_(pa.int32())),
                                              pa.array(tokens, pa.int64())], names=["place", "doc_id", "toxic", "features", "tokens"])

    kind = sample.schema["doc_id"].dataType.simpleString()
    # numbers only: at most ``rows`` short lists
    read = in_batches(sample, run, f"place long, doc_id {kind}, toxic int, features array<int>, tokens long").toPandas()
    read = read.sort_values(["place", "tokens", "toxic"], kind="stable")
    n = [len(x) for x in read["features"]]
    column = np.concatenate([np.asarray(x, np.int64) for x in read["features"]]) if sum(n) else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(n)), n)
    length, label = length_feature(read["tokens"]), read["toxic"].to_numpy(float)
    size = len(wanted)
    weights = np.zeros(size + 2)
    ridge = np.full(size + 2, RIDGE)
    ridge[size:] = 0.01
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, ROUNDS + 1):
        score = np.bincount(owner, weights[column], len(label)) + weights[size] * length + weights[size + 1]
        off = 1 / (1 + np.exp(-score)) - label
        slope = np.concatenate([np.bincount(column, off[owner], size), [off @ length, off.sum()]]) + ridge * weights
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope ** 2
        weights -= RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return model, wanted, weights


def scored(docs: DataFrame, fitted) -> DataFrame:
    """One row for each document: id and score."""

    def run(batches):
        if fitted:
            model, wanted, weights = fitted
            reader, size = Reader(model, wanted), len(wanted)
        for batch in batches:
            if not fitted:
                score = np.zeros(batch.num_rows)
            else:
                found, tokens = _read(reader, batch.column(1).to_pylist())
                score = np.array([weights[f].sum() for f in found]) + weights[size] * length_feature(tokens) + weights[size + 1]
                score = 1 / (1 + np.exp(-score))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return in_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, score double")


def op3_toxicity_channel(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    found = scored(docs, fit(docs, table(spark, folder, "labels")))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
