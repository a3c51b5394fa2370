"""Secret scans: patterns for known forms, and character Markov models for the rest.

Two first-order Markov models of characters, one of random strings and one of ordinary identifiers, are trained
from labelled samples; the sum of log ratios of their transition probabilities says how much likelier a token is
under the first. Tokens of at least 16 characters whose ratio passes a fixed bound are spans of kind ``markov``,
unless a base span overlaps them. The registered query takes its samples from the corpus: values that the known
forms match are random strings, all other tokens of 12 or more characters are ordinary. Every document counts.

Ratios are whole numbers (thousandths), so sums do not depend on order. Long runs of one class are read once.

Defined results: a null text is an empty one, with no spans; the digest is then that of an empty string. Places
are code points. Without samples of both labels no Markov span is found. Rows with equal or null ids are each
scanned. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.llm.spans import apart, digest, let, ordered, spans, written
from millrace.llm.tables import documents, saved

TOKEN = "A-Za-z0-9+/_.=-"
#: The token characters; a place in here, from 1, is a character's number.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
SIZE = len(ALPHABET) + 1
LABELS = ("password", "passwd", "secret", "token", "api_?key")


def either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


ASSIGN = rf"""(?:{"|".join(map(either_case, LABELS))})["']?\x20*[:=]\x20*["']?([{TOKEN}]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "markov")
ASSIGN_LENGTH = 12
#: Shortest token that is scored, and shortest that a model learns from.
SCORED_LENGTH, LEARNED_LENGTH = 16, 12
#: Log likelihood ratio, in thousandths, from which a token is a secret.
BOUND = 12_000
#: Added to every character's count, and weight of the characters' own shares in those of transitions.
SMOOTHING, BACKOFF = 0.5, 20
#: Taken off every transition's count.
DISCOUNT = 1


def base_spans(text: Column) -> dict[str, Column]:
    assigned = spans(text, ASSIGN, "assign", 0, group=1)
    return {
        "assign": F.filter(assigned, lambda x: F.length(x["value"]) >= ASSIGN_LENGTH),
        "access": spans(text, ACCESS, "access", 1),
        "hex": spans(text, HEX, "hex", 2),
    }


def tokens(text: Column, least: int) -> Column:
    return spans(text, rf"[{TOKEN}]{{{least},}}", "markov", 3)


def scanned(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``base`` (a struct of arrays of spans) and ``tokens`` (long tokens apart from those)."""
    text = F.coalesce(F.col(text), F.lit(""))
    base = F.struct(*(v.alias(k) for k, v in base_spans(text).items()))
    out = docs.withColumn("base", F.explode(F.array(base)))
    certain = F.concat(*(F.col(f"base.{k}") for k in KINDS[:3]))
    return out.withColumn("tokens", F.explode(F.array(let(certain, lambda b: apart(tokens(text, LEARNED_LENGTH), b)))))


def train(samples: DataFrame) -> list[int] | None:
    """Log ratios in thousandths for every pair of characters, from ``value`` and ``random`` (true or false).

    Equal samples count once.

    Transitions are counted in the cluster; at most one row for each pair of characters comes to the driver.
    """
    pairs = F.transform(F.sequence(F.lit(1), F.length("value") - 1), lambda i: F.substr("value", i, F.lit(2)))
    counts = (samples.where(F.length("value") > 1).distinct().select(F.explode(pairs).alias("pair"), "random")
              .groupBy("pair").agg(F.count(F.when(F.col("random"), 1)).alias("random"),
                                   F.count(F.when(~F.col("random"), 1)).alias("ordinary")).collect())
    table = np.zeros((2, SIZE, SIZE))
    for r in counts:
        a, b = (ALPHABET.find(c) + 1 for c in r["pair"])
        table[:, a, b] += (r["random"], r["ordinary"])
    if not table.any(axis=(1, 2)).all():
        return None
    # what a single token shows is no habit: the scored token is among the samples itself
    table = np.maximum(table - DISCOUNT, 0)
    # after a character that a model has hardly seen, its characters' shares decide
    alone = table.sum(axis=1, keepdims=True) + SMOOTHING
    alone /= alone.sum(axis=2, keepdims=True)
    chances = (table + BACKOFF * alone) / (table.sum(axis=2, keepdims=True) + BACKOFF)
    return [round(1000 * math.log(x)) for x in (chances[0] / chances[1]).ravel()]


def ratio(value: Column, model: list[int]) -> Column:
    """Log likelihood ratio of a token, in thousandths."""
    table = F.split(F.lit(",".join(map(str, model))), ",").cast("array<int>")

    def numbers(v: Column) -> Column:
        return F.transform(F.split(v, ""), lambda c: F.instr(F.lit(ALPHABET), c))

    def total(n: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(0), F.size(n) - 2), F.lit(0).cast("long"),
                           lambda done, i: done + F.get(table, F.get(n, i) * SIZE + F.get(n, i + 1)))

    return let(numbers(value), total)


def op8_secret_markov(spark: SparkSession, folder: str) -> DataFrame:
    rows = scanned(documents(spark, folder).select("doc_id", "text")).drop("text")
    rows = saved(rows, "scanned")
    certain = F.concat(*(F.col(f"base.{k}") for k in KINDS[:3]))
    label = lambda found, random: F.transform(found, lambda x: F.struct(x["value"].alias("value"), F.lit(random).alias("random")))
    samples = rows.select(F.explode(F.concat(label(certain, True), label(F.col("tokens"), False))).alias("s")).select("s.*")
    model = train(samples)
    found = F.array().cast(rows.schema["tokens"].dataType)
    if model:
        long_enough = F.filter("tokens", lambda x: F.length(x["value"]) >= SCORED_LENGTH)
        found = F.filter(long_enough, lambda x: ratio(x["value"], model) >= BOUND)
    rows = rows.select("doc_id", *(F.size(f"base.{k}").cast("long").alias(f"n_{k}") for k in KINDS[:3]),
                       certain.alias("certain"), found.alias("added"))
    return rows.select(
        "doc_id", *(f"n_{k}" for k in KINDS[:3]), F.size("added").cast("long").alias("n_markov"),
        digest(written(ordered(F.col("certain")))).alias("base_sha256"),
        written(ordered(F.col("certain"), F.col("added"))).alias("spans"))
