"""Personal data: patterns propose spans, checksums confirm them, words nearby move the score.

Every kind has a pattern and, where there is one, a check: card numbers the Luhn sum, account numbers (IBAN) the
length of their country and the remainder modulo 97, addresses of machines the range of their parts, phone numbers the count of digits. A span's
score starts from how sure its pattern and check are, rises if a fitting word stands within 48 characters before
or after it, and falls if a word that speaks against it does. These characters are those of the text, whatever other
spans they hold. Kinds without a checksum that anything numeric could match
(social security numbers, local phone numbers) count only from a score of 0.5. Spans of the base kinds stay
whatever their score.

Patterns are written so that a long run of one character class is read once: no nested backtracking, no recursion.

Defined results: a null text is an empty one, with no spans; the digest is then that of an empty string. Places
are code points. Rows with equal or null ids are each scanned. An empty table gives an empty result.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.llm.spans import apart, digest, let, ordered, spans, written
from millrace.llm.tables import documents

LOCAL = "A-Za-z0-9._%+-"
PART = "(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2}))"

ACCEPTED = 0.5
FOR, AGAINST = 0.25, -0.25


#: Characters of an account number (IBAN), by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28, "CH": 21,
    "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FK": 18, "FO": 18,
    "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HN": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23,
    "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27,
    "MD": 24, "ME": 22, "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28, "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28,
    "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24, "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27,
    "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20, "YE": 30,
}


def iban_pattern() -> str:
    """An account number ends where its country's length says, whatever capitals or digits follow after a space.

    It is written in one piece or in groups with single spaces.
    """
    by_length: dict[int, list[str]] = {}
    for country, length in IBAN_LENGTHS.items():
        by_length.setdefault(length, []).append(country)
    forms = "|".join(rf"(?:{'|'.join(countries)})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{length - 4}}}" for length, countries in sorted(by_length.items()))
    return rf"(?<![A-Za-z0-9])(?:{forms})(?![A-Za-z0-9])"


class Kind(NamedTuple):
    pattern: str
    score: float
    near: str
    far: str = r"(?i)\b(version|release|build|serial|order|invoice|isbn)\b"


BASE = {
    # a name cannot begin inside a run of name characters, unless a match has just ended there
    "email": Kind(rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.9,
                  r"(?i)\b(mail|e-mail|email|contact|write)\b"),
    "ip": Kind(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", 0.6, r"(?i)\b(ip|host|address|server|client)\b"),
    # whole chains of 14 to 19 digits with single separators
    "card": Kind(r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}(?![\x20-]?[0-9])", 0.7,
                 r"(?i)\b(card|credit|debit|visa|mastercard|amex|payment)\b"),
    "phone": Kind(r"\+[0-9][\x20().0-9-]+[0-9]", 0.7, r"(?i)\b(phone|call|tel|mobile|fax|cell)\b"),
}
ADDED = {
    "iban": Kind(iban_pattern(), 0.9,
                 r"(?i)\b(iban|account|bank|konto|cuenta|compte)\b"),
    "ssn": Kind(r"(?<![0-9-])(?!000|666|9[0-9]{2})[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", 0.3,
                r"(?i)\b(ssn|social|security|tax)\b"),
    "local_phone": Kind(r"(?<![0-9])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])", 0.3,
                        r"(?i)\b(phone|call|tel|mobile|fax|cell|reach)\b"),
}
KINDS = BASE | ADDED


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits of a number of at most some dozens pass the Luhn check."""

    def total(d: Column) -> Column:
        def add(done: Column, i: Column) -> Column:
            digit = F.ascii(F.substr(d, i, F.lit(1))) - 48
            twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
            return done + F.when((F.length(d) - i) % 2 == 1, twice).otherwise(digit)

        return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), add)

    return let(digits(value), lambda d: total(d) % 10 == 0)


def mod_97(value: Column) -> Column:
    """Whether an account number, its first four characters moved to the end, leaves 1 modulo 97."""

    def remainder(v: Column) -> Column:
        def add(done: Column, i: Column) -> Column:
            code = F.ascii(F.substr(v, i, F.lit(1)))
            return F.when(code >= 65, (done * 100 + code - 55) % 97).otherwise((done * 10 + code - 48) % 97)

        return F.aggregate(F.sequence(F.lit(1), F.length(v)), F.lit(0), add)

    plain = F.regexp_replace(value, r"\x20", "")
    return let(F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4))), lambda v: remainder(v) == 1)


def confirmed(kind: str, value: Column) -> Column:
    n = F.length(digits(value))
    return {
        "ip": lambda: value.rlike(rf"^{PART}(?:\.{PART}){{3}}$"),
        "card": lambda: n.between(14, 19) & luhn(value),
        "phone": lambda: n.between(10, 15),
        "iban": lambda: mod_97(value),
    }.get(kind, lambda: F.lit(True))()


def score(kind: str, span: Column) -> Column:
    """0 to 1, in hundredths: the kind's own, moved by the words before and after the span."""
    k = KINDS[kind]
    near = lambda words: span["before"].rlike(words) | span["after"].rlike(words)
    return (F.lit(round(100 * k.score))
            + F.when(near(k.near), round(100 * FOR)).otherwise(0)
            + F.when(near(k.far), round(100 * AGAINST)).otherwise(0))


def found(text: Column, kind: str) -> Column:
    """The confirmed spans of a kind."""
    rank = list(KINDS).index(kind)
    return F.filter(spans(text, KINDS[kind].pattern, kind, rank, context=True), lambda x: confirmed(kind, x["value"]))


def accepted(text: Column, kind: str) -> Column:
    """The confirmed spans of a kind whose score suffices."""
    return F.filter(found(text, kind), lambda x: score(kind, x) >= round(100 * ACCEPTED))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``base`` and ``added``, arrays of spans; texts of spans are in ``value``."""
    text = F.coalesce(F.col(text), F.lit(""))
    base = F.struct(*(found(text, kind).alias(kind) for kind in BASE))
    added = F.concat(*(accepted(text, kind) for kind in ADDED))
    return (docs.withColumn("base", F.explode(F.array(base)))
            .withColumn("added", F.explode(F.array(added))))


def op9_pii_spans(spark: SparkSession, folder: str) -> DataFrame:
    rows = scan(documents(spark, folder).select("doc_id", "text"))
    counts = [F.size(f"base.{kind}").cast("long").alias(f"n_{kind}") for kind in BASE]
    rows = rows.select("doc_id", *counts, F.concat(*(F.col(f"base.{kind}") for kind in BASE)).alias("certain"), "added")
    certain = F.col("certain")

    def scored(x: Column) -> Column:
        points = F.lit(0)
        for kind in KINDS:
            points = F.when(x["kind"] == kind, score(kind, x)).otherwise(points)
        return F.concat_ws(":", x["start"], points)

    every = ordered(certain, apart(F.col("added"), certain))
    return rows.select(
        "doc_id", *(f"n_{kind}" for kind in BASE), digest(written(ordered(certain))).alias("base_sha256"),
        written(every).alias("spans"), F.array_join(F.transform(every, scored), ",").alias("scores"))
