"""Nested JSON documents ``{"results": [...], "info": {...}}``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.schemas import PEOPLE_DOCUMENT

SECRETS = ("password", "salt", "md5", "sha1", "sha256")


def parsed_documents(
    spark: SparkSession, path: str, schema: str = PEOPLE_DOCUMENT, multi_line: bool = False
) -> DataFrame:
    """Documents as they are, in one scan; ``_corrupt_record`` holds the text of those that do not fit the schema.

    One document per line lets Spark split large files; ``multi_line`` reads a file as one document.
    The schema is always given, so no pass over the data is spent on inferring it.
    """
    return (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .option("multiLine", multi_line)
        .json(path)
    )


def records_of(documents: DataFrame) -> DataFrame:
    """One row per element of ``results`` of the sound documents, as column ``r``."""
    return documents.where("_corrupt_record IS NULL").select(F.explode("results").alias("r"))


def corrupt_of(documents: DataFrame) -> DataFrame:
    """The text of the documents that do not fit, whole: nothing of them is among the records."""
    return documents.where("_corrupt_record IS NOT NULL").select(F.col("_corrupt_record").alias("value"))


def json_document_scan(
    spark: SparkSession, path: str, schema: str = PEOPLE_DOCUMENT, multi_line: bool = False
) -> DataFrame:
    return records_of(parsed_documents(spark, path, schema, multi_line))


def read_through(spark: SparkSession, copy: str, fetch) -> DataFrame:
    """Rows of the local copy; ``fetch()`` is called and stored only when there is no copy yet."""
    try:
        return spark.read.parquet(copy)
    except Exception as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
    fetch().write.parquet(copy)
    return spark.read.parquet(copy)


def flatten_person(
    df: DataFrame, record: str = "r", new_id: Column | None = None, keep_secrets: bool = False
) -> DataFrame:
    """Nested person to 34 flat columns, with the casts the target table implies.

    Passwords, salts and password digests come out null unless ``keep_secrets`` is set. ``new_id``
    is the row's id; the default is random, so write the result before reading it twice.
    """
    def at(path: str) -> Column:
        return F.col(f"{record}.{path}")

    def secret(name: str) -> Column:
        return (at(f"login.{name}") if keep_secrets else F.lit(None).cast("string")).alias(name)

    return df.select(
        (F.uuid() if new_id is None else new_id).alias("id"),
        at("gender").alias("gender"),
        at("name.title").alias("title"),
        at("name.first").alias("first_name"),
        at("name.last").alias("last_name"),
        at("location.street.number").alias("street_number"),
        at("location.street.name").alias("street_name"),
        at("location.city").alias("city"),
        at("location.state").alias("state"),
        at("location.country").alias("country"),
        at("location.postcode").alias("postcode"),
        at("location.coordinates.latitude").try_cast("double").alias("latitude"),
        at("location.coordinates.longitude").try_cast("double").alias("longitude"),
        at("location.timezone.offset").alias("timezone_offset"),
        at("location.timezone.description").alias("timezone_description"),
        at("email").alias("email"),
        at("login.uuid").alias("uuid"),
        at("login.username").alias("username"),
        *[secret(name) for name in SECRETS],
        at("dob.date").try_cast("timestamp_ntz").alias("date_of_birth"),
        at("dob.age").alias("age"),
        at("registered.date").try_cast("timestamp_ntz").alias("registered_at"),
        at("phone").alias("phone"),
        at("cell").alias("cell"),
        at("id.name").alias("id_name"),
        at("id.value").alias("id_value"),
        at("picture.large").alias("picture_large"),
        at("picture.medium").alias("picture_medium"),
        at("picture.thumbnail").alias("picture_thumbnail"),
        at("nat").alias("nat"),
    )
