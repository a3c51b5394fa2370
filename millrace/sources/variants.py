"""Free-form JSON stored as VARIANT: parsed once on the way in, profiled without parsing again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def parsed(df: DataFrame, text: str, name: str = "data") -> tuple[DataFrame, DataFrame]:
    """Rows with ``text`` parsed to a VARIANT column, and the rows whose text is no JSON, with a message.

    A null text is a null value, not an error. Write the first frame to Parquet; readers take single fields out of it.
    """
    tried = df.withColumn(name, F.try_parse_json(text))
    bad = F.col(name).isNull() & F.col(text).isNotNull()
    good = tried.where(~bad).drop(*([text] if text != name else []))
    errors = tried.where(bad).drop(name).withColumn("message", F.concat(F.lit("not JSON: "), F.left(F.col(text), F.lit(200))))
    return good, errors


def fields(df: DataFrame, name: str = "data", keep: Sequence[str] = ()) -> DataFrame:
    """One row for each field at the top of an object (or place of a list): ``key``, ``value`` and its ``type``."""
    exploded = df.select(*keep, F.col(name).alias("_v")).lateralJoin(
        df.sparkSession.tvf.variant_explode(F.col("_v").outer()))
    # the kind of value: digits of decimals and what lists and objects hold are left out
    kind = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)
    key = F.coalesce(F.col("key"), F.col("pos").cast("string"))
    return exploded.select(*keep, key.alias("key"), "value", kind.alias("type"))


def type_profile(df: DataFrame, name: str = "data", by: Sequence[str] = ()) -> DataFrame:
    """How often each field has which type."""
    return fields(df, name, by).groupBy(*by, "key", "type").agg(F.count(F.lit(1)).alias("n"))


def common_schema(df: DataFrame, name: str = "data", by: Sequence[str] = ()) -> DataFrame:
    """One schema a group that all its values fit."""
    return df.groupBy(*by).agg(F.schema_of_variant_agg(name).alias("schema"))
