"""What a registered query is, and the inputs several of them share."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace import schemas
from millrace.functions.hashing import content_hash
from millrace.functions.values import epoch_micros, format_id
from millrace.operators.dedup import dedup_latest


class Query(NamedTuple):
    """A Spark query over a folder of test tables, and the same in SQL where SQL can say it."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


class Tables:
    """The test tables below a folder, by name."""

    def __init__(self, spark: SparkSession, folder: str):
        # zone-less timestamps meet epoch functions, which read them in the session zone
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.folder = spark, folder

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}.parquet"

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def stream_path(self, name: str) -> str:
        """The table as a glob: a file stream takes a folder or a glob, not a single file."""
        return self.path(name)[:-1] + "[t]"


# order of the copies of a line: a total order on the test table
LINE_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")
STAGED_ORDER = ("created_at", "l_partkey", "l_suppkey", "l_extendedprice")


def event_times(t: Tables) -> DataFrame:
    """Events with their time, duration (value in minutes) and end in whole microseconds."""
    at = epoch_micros("ts")
    length = (F.col("value") * 60_000_000).cast("bigint")
    return t("events").withColumns(
        {"at_us": at, "length_us": length, "end_us": at + length}
    )


EVENT_TIMES_SQL = """
    SELECT *, epoch_us(ts) AS at_us, CAST(trunc(value * 60000000) AS BIGINT) AS length_us,
           epoch_us(ts) + CAST(trunc(value * 60000000) AS BIGINT) AS end_us
    FROM events
"""


#: Which lines are in the new extract and which in the snapshot before; every line is in one of them at least.
STAGED_LINES, PRIOR_LINES = "l_returnflag <> 'R' OR l_linestatus <> 'F'", "l_linestatus = 'F'"


def order_lines(t: Tables) -> DataFrame:
    """Order lines as extracted records; the copies of a line are what retries leave behind."""
    return t("lineitem").select(
        F.col("l_orderkey").cast("string").alias("id"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("external_id"),
        format_id("org", "l_linenumber").alias("organization_id"),
        F.concat(F.lit("int-"), "l_linenumber").alias("connected_integration_id"),
        F.concat(F.lit("part-"), "l_partkey").alias("name"),
        F.concat(F.lit("supp-"), "l_suppkey").alias("email"),
        F.col("l_shipdate").alias("created_at"),
        "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag", "l_linestatus",
    ).withColumn("content_hash", content_hash("name", "email"))


def cdc_staging(t: Tables) -> DataFrame:
    """The new extract: every line that was not returned or is not finished, with its copies."""
    return order_lines(t).where(STAGED_LINES).drop("l_returnflag", "l_linestatus")


def cdc_latest(t: Tables) -> DataFrame:
    """The snapshot so far: the newest copy of every line that was finished."""
    finished = order_lines(t).where(PRIOR_LINES)
    # the hash follows from columns beside it, so it need not travel with the copies
    newest = dedup_latest(finished.drop("content_hash"), schemas.USER_KEYS, STAGED_ORDER)
    return newest.select(
        "id", "external_id", "organization_id", "connected_integration_id", "name", "email",
        content_hash(*schemas.HASH_OF).alias("content_hash"),
    )


CDC_SQL = f"""
    WITH lines AS (
        SELECT CAST(l_orderkey AS VARCHAR) AS id,
               l_orderkey || '-' || l_linenumber AS external_id,
               'org-' || lpad(CAST(l_linenumber AS VARCHAR), 3, '0') AS organization_id,
               'int-' || l_linenumber AS connected_integration_id,
               'part-' || l_partkey AS name, 'supp-' || l_suppkey AS email,
               md5('part-' || l_partkey || ':supp-' || l_suppkey) AS content_hash,
               l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_returnflag, l_linestatus
        FROM lineitem
    ), fresh AS MATERIALIZED (
        SELECT * FROM lines WHERE {STAGED_LINES}
        QUALIFY row_number() OVER (
            PARTITION BY id, organization_id, connected_integration_id
            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1
    ), prior AS MATERIALIZED (
        SELECT * FROM lines WHERE {PRIOR_LINES}
        QUALIFY row_number() OVER (
            PARTITION BY id, organization_id, connected_integration_id
            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1
    ), changes AS MATERIALIZED (
        SELECT f.id, f.organization_id, f.connected_integration_id, f.external_id, f.name, f.email,
               f.content_hash, 'INSERT' AS change_type
        FROM fresh f ANTI JOIN prior p USING (id, organization_id, connected_integration_id)
        UNION ALL
        SELECT f.id, f.organization_id, f.connected_integration_id, f.external_id, f.name, f.email,
               f.content_hash, 'UPDATE'
        FROM fresh f JOIN prior p USING (id, organization_id, connected_integration_id)
        WHERE f.content_hash IS DISTINCT FROM p.content_hash
        UNION ALL
        SELECT p.id, p.organization_id, p.connected_integration_id, p.external_id, p.name, p.email,
               p.content_hash, 'DELETE'
        FROM prior p ANTI JOIN fresh f USING (id, organization_id, connected_integration_id)
    )
"""

# The namespace of DNS names, as hex digits.
DNS_NAMESPACE_HEX = "6ba7b8109dad11d180b400c04fd430c8"


def uuid5_sql(text: str) -> str:
    """SQL expression for the version 5 id of a text expression."""
    h = f"sha1(unhex('{DNS_NAMESPACE_HEX}') || encode({text}))"
    return (
        f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || "
        f"substr('89ab', (('0x' || substr({h}, 17, 1))::INTEGER % 4) + 1, 1) || "
        f"substr({h}, 18, 3) || '-' || substr({h}, 21, 12)"
    )
