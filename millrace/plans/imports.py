"""Importing nested documents and access requests, with an error table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators.quality import enum_split, fk_split, insert_if_absent
from millrace.schemas import REQUEST_STATUSES
from millrace.session import work_path
from millrace.sinks import folders
from millrace.sinks.tables import append_batch
from millrace.sources.documents import corrupt_of, flatten_person, parsed_documents, records_of


def error_rows(messages: DataFrame, message: str = "message") -> DataFrame:
    """Error table rows with a random id and the current time."""
    return messages.select(
        F.uuid().alias("id"),
        F.to_json(F.struct(F.col(message).alias("error"))).alias("message"),
        F.current_timestamp().cast("timestamp_ntz").alias("created_at"),
    )


def import_people(
    spark: SparkSession, path: str, people_path: str, errors_path: str, keep_secrets: bool = False,
    multi_line: bool = False,
) -> None:
    """Append every person of the documents; a document that does not fit is one row of the error table.

    The documents are parsed once, into a working folder that is removed at the end.
    """
    copy = work_path(spark, "documents")
    parsed = parsed_documents(spark, path, multi_line=multi_line)
    parsed.write.parquet(copy)
    parsed = spark.read.schema(parsed.schema).parquet(copy)
    append_batch(flatten_person(records_of(parsed), keep_secrets=keep_secrets), people_path)
    append_batch(error_rows(corrupt_of(parsed), "value"), errors_path)
    folders.remove(spark, copy)


def accept_requests(
    requests: DataFrame, users: DataFrame, accesses: DataFrame, existing: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Requests with a known user, a known access and a valid status, and the rejected rest."""
    if existing is not None:
        requests = insert_if_absent(existing, requests, ["id"])
    valid, bad_status = enum_split(requests, "status", REQUEST_STATUSES)
    valid, no_user = fk_split(valid, "user_id", users, "id")
    valid, no_access = fk_split(valid, "access_id", accesses, "id")
    return valid, bad_status.unionByName(no_user).unionByName(no_access)
