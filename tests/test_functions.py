import hashlib
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions import values as V
from millrace.functions.hashing import content_hash, uuid5
from millrace.operators.jobs import parse_parameters

TEXTS = ["", "a", "Zoë Ünal", "日本", "x:y", "org-001:google:1", "a" * 300, "line\nbreak"]


def test_uuid5_equals_python(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = {r.t: r.u for r in df.select("t", uuid5("t").alias("u")).collect()}
    assert got == {t: str(uuid.uuid5(uuid.NAMESPACE_DNS, t)) for t in TEXTS}
    url = df.select("t", uuid5("t", uuid.NAMESPACE_URL).alias("u")).collect()
    assert all(r.u == str(uuid.uuid5(uuid.NAMESPACE_URL, r.t)) for r in url)


def test_content_hash(spark):
    pairs = [("John", "j@x.org"), ("Zoë", "z@x"), ("a:b", "c"), ("a", "b:c"), (None, "x"), (None, "y")]
    df = spark.createDataFrame(pairs, "name string, email string")
    plain, prefixed = zip(*[
        tuple(r) for r in df.select(
            content_hash("name", "email"), content_hash("name", "email", length_prefixed=True)
        ).collect()
    ])
    for (name, email), digest in zip(pairs[:4], plain):
        assert digest == hashlib.md5(f"{name}:{email}".encode()).hexdigest()
    assert plain[2] == plain[3] and prefixed[2] != prefixed[3]
    assert plain[4] is not None and plain[4] != plain[5]


KEY = "0f8fad5b-d9cb-469f-a165-70867728950e"
TYPES = {
    "boolean": ["true", "False", "TRUE"],
    "integer": ["123", "-5", "+7", "1_000"],
    "float": ["1.5", ".5", "5.", "1e5", "nan", "-inf", "Infinity"],
    "json": ['{"k":1}', "[1,2]", "[]"],
    "uuid": [KEY],
    "string": [
        "_1", "1__0", ".", "", "1e", "infin", "{bad", "{bad}", "[1,", "x=y", "0x10", "g" + KEY[1:], "plain text",
        "\u0661\u0662\u0663x", "{", "]",
    ],
}


def test_parameter_types(spark):
    values = [(v, kind) for kind, vs in TYPES.items() for v in vs]
    texts = [f"k={v}" for v, _ in values] + [" a = b ", "novalue", "=v", "a==b", "\tn\t=\t5\t"]
    df = parse_parameters(spark.createDataFrame([(t,) for t in texts], "t string"), "t")
    got = {r.t: (r.key, r.value, r.type) for r in df.collect()}
    for v, kind in values:
        assert got[f"k={v}"] == ("k", v, kind), v
    assert got[" a = b "] == ("a", "b", "string")
    assert got["novalue"] == (None, None, "invalid")
    assert got["=v"] == ("", "v", "string")
    assert got["a==b"] == ("a", "=b", "string")
    assert got["\tn\t=\t5\t"] == ("n", "5", "integer")


def test_progress_is_cut_like_python(spark):
    pairs = [(i, n) for n in range(1, 101) for i in range(n + 1)]
    df = spark.createDataFrame(pairs, "i int, n int").select("i", "n", V.progress_pct("i", "n").alias("p"))
    assert all(r.p == int((r.i / r.n) * 100) for r in df.collect())
    nothing = spark.createDataFrame([(0, 0)], "i int, n int").select(V.progress_pct("i", "n")).first()
    assert nothing[0] is None


def test_iso_text(spark):
    moments = [datetime(2024, 1, 1), datetime(1956, 8, 11, 16, 36, 39, 869000), datetime(2024, 2, 29, 1, 2, 3, 4)]
    df = spark.createDataFrame([(m,) for m in moments], "t timestamp_ntz")
    for r in df.select("t", V.iso_format("t").alias("s"), V.iso_parse(V.iso_format("t")).alias("b")).collect():
        assert r.s == r.t.isoformat() and r.b == r.t
    odd = spark.createDataFrame([("",), ("soon",), (None,), ("1956-08-11T16:36:39.869Z",)], "s string")
    parsed = [r[0] for r in odd.select(V.iso_parse("s")).collect()]
    assert parsed == [None, None, None, datetime(1956, 8, 11, 16, 36, 39, 869000)]


def test_maps_and_ids(spark):
    row = spark.range(1).select(
        V.map_merge(
            F.create_map(F.lit("a"), F.lit("x"), F.lit("b"), F.lit("y")),
            F.create_map(F.lit("b"), F.lit("z")),
        ).alias("m"),
        V.map_upper(F.create_map(F.lit("k"), F.lit("v"))).alias("u"),
        V.format_id("org", F.lit(7)).alias("short"), V.format_id("org", F.lit(-7)).alias("minus"),
        V.format_id("org", F.lit(12345)).alias("long"),
        V.array_pick(["g", "a", "o"], F.lit(4)).alias("pick"),
        V.byte_length(V.byte_concat(F.lit("é"), F.lit("a"))).alias("bytes"),
    ).first()
    assert row.m == {"a": "x", "b": "z"} and row.u == {"k": "V"}
    assert row.minus == f"org-{-7:03d}"
    assert (row.short, row.long, row.pick, row.bytes) == ("org-007", "org-12345", "a", 3)


def test_run_tree(spark):
    root = str(uuid.uuid4())
    df = spark.createDataFrame([(root,), (root + "-1",), (root + "-1-12",)], "r string")
    got = [tuple(r) for r in df.select(V.root_id("r"), V.run_depth("r")).collect()]
    assert got == [(root, 0), (root, 1), (root, 2)]


@pytest.mark.parametrize("text,expected", [("", None), ("a", "a"), (None, None)])
def test_empty_to_null(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(V.empty_to_null("t")).first()[0] == expected
