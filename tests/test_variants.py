import re

from millrace.sources import variants


def test_parsed_profiled_and_put_aside(spark, tmp_path, rows):
    texts = ['{"a": 1, "b": "x"}', '{"a": 2.5, "b": null}', '[1, "two"]', "7", "{broken", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    good, errors = variants.parsed(df, "text")
    assert good.columns == ["id", "data"] and rows(errors, "id", "message") == [(4, "not JSON: {broken"), (5, "not JSON: ")]
    good.write.parquet(str(tmp_path / "v"))
    stored = spark.read.parquet(str(tmp_path / "v"))
    assert dict(stored.dtypes)["data"] == "variant" and stored.count() == 5
    assert rows(variants.type_profile(stored).where("key IS NOT NULL")) == [
        ("0", "BIGINT", 1), ("1", "STRING", 1), ("a", "BIGINT", 1), ("a", "DECIMAL", 1), ("b", "STRING", 1), ("b", "VOID", 1)]
    assert {r["id"]: r["type"] for r in variants.fields(stored, keep=["id"]).where("key = 'a'").collect()} == {0: "BIGINT", 1: "DECIMAL"}
    schema = variants.common_schema(stored.where("id < 2")).first()["schema"]
    assert re.fullmatch(r"OBJECT<a: DECIMAL\(\d+,\d+\), b: STRING>", schema)
