"""Queries on single columns: ids, text, JSON, maps, timestamps."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.base import Query, Tables, uuid5_sql
from millrace.functions import values as V
from millrace.functions.hashing import uuid5
from millrace.session import work_path
from millrace.sources import variants


def prefix(spark, sf):
    run = F.concat_ws("-", uuid5(F.col("o_orderkey").cast("string")), "o_custkey", "o_orderkey")
    runs = Tables(spark, sf)("orders").select("o_orderkey", run.alias("run_id"))
    return runs.select(
        "o_orderkey", V.prefix("run_id").alias("root_id"), V.run_depth("run_id").alias("depth")
    )


def format_id(spark, sf):
    provider = F.lower("o_orderstatus")
    return Tables(spark, sf)("orders").select(
        "o_orderkey",
        V.format_id("org", "o_custkey").alias("organization_id"),
        F.concat(F.lit("https://api."), provider, F.lit(".com/v1")).alias("api_endpoint"),
        F.format_string("%s_source_%d", provider, "o_custkey").alias("permission_source_name"),
    )


def array_pick(spark, sf):
    return Tables(spark, sf)("lineitem").select(
        "l_orderkey", "l_linenumber",
        V.array_pick(["google", "azure", "okta"], F.col("l_orderkey") + F.col("l_linenumber"))
        .alias("provider"),
    ).distinct()


def case_normalize(spark, sf):
    return Tables(spark, sf)("orders").select(
        "o_orderkey", F.lower("o_orderpriority").alias("priority"),
        F.lower("o_orderstatus").alias("status"), F.upper(F.lit("aws")).alias("provider"),
    )


def empty_to_null(spark, sf):
    # the query part of an address, empty where there is none
    query = F.regexp_extract("url", r"\?(.*)$", 1)
    return Tables(spark, sf)("pages").select("page_id", V.empty_to_null(query).alias("query"))


def suffix_predicate(spark, sf):
    return Tables(spark, sf)("pages").where(F.col("url").endswith("#top")).select("page_id", "url")


def iso_format_parse(spark, sf):
    text = V.iso_format("ts")
    return Tables(spark, sf)("events").select(
        "event_id", text.alias("iso"), (V.iso_parse(text) == F.col("ts")).alias("same")
    )


def progress_pct(spark, sf):
    lines = Tables(spark, sf)("lineitem").select("l_orderkey", "l_linenumber").distinct()
    return lines.select("*", V.progress_pct("l_linenumber", F.lit(7)).alias("pct"))


def map_upper_merge(spark, sf):
    left = F.create_map(F.lit("type"), "event_type", F.lit("source"), F.lit("web"))
    right = F.create_map(F.lit("source"), F.lit("api"), F.lit("user"), F.col("user_id").cast("string"))
    merged = V.map_upper(V.map_merge(left, right))
    return Tables(spark, sf)("events").select("event_id", merged.alias("m")).select(
        "event_id", F.size("m").alias("entries"), F.col("m")["type"].alias("type"),
        F.col("m")["source"].alias("source"), F.col("m")["user"].alias("user"),
    )


def json_encode_decode(spark, sf):
    text = F.to_json(F.struct("event_id", "event_type"))
    coded = Tables(spark, sf)("events").select("event_id", text.alias("encoded"))
    back = F.from_json("encoded", "event_id bigint, event_type string")
    return coded.select(
        "*", back["event_type"].alias("decoded"),
        F.try_variant_get(F.try_parse_json("encoded"), "$.missing", "string").alias("missing"),
    )


def variant_type_profile(spark, sf):
    """Free-form events stored as VARIANT: the types of their fields, and how many texts were no JSON."""
    text = F.when(F.col("event_type") == "error", F.concat(F.lit("{broken "), "event_id")).otherwise(F.concat(
        F.lit('{"id":'), "event_id", F.lit(',"half":'), "user_id", F.lit('.5,"kind":"'), "event_type", F.lit('","bought":'),
        (F.col("event_type") == "purchase").cast("string"), F.when(F.col("event_type") == "click", ',"target":null').otherwise(""),
        F.lit(',"pair":['), "event_id", F.lit(","), "user_id", F.lit('],"props":'), "props", F.lit("}")))
    good, errors = variants.parsed(Tables(spark, sf)("events").select(text.alias("text")), "text")
    path = work_path(spark, "variants")
    good.write.parquet(path)
    profile = variants.type_profile(spark.read.parquet(path))
    return profile.unionByName(errors.groupBy().agg(
        F.lit("text").alias("key"), F.lit("ERROR").alias("type"), F.count(F.lit(1)).alias("n")))


def events_json_props(spark, sf):
    k = F.from_json("props", "k int")["k"]
    return Tables(spark, sf)("events").groupBy("event_type").agg(F.sum(k).alias("k_total"))


def byte_concat(spark, sf):
    payload = V.byte_concat("text", "source")
    return Tables(spark, sf)("documents").select(
        "doc_id", V.byte_length(payload).cast("bigint").alias("bytes"),
        F.md5(payload).alias("digest"),
    )


def random_uuid(spark, sf):
    """What holds of random ids: all different, all of version 4."""
    # written first: a random id must not be computed a second time
    t = Tables(spark, sf)
    path = work_path(spark, "random-ids")
    t("customer").select("c_mktsegment", F.uuid().alias("id")).write.parquet(path)
    version_4 = F.col("id").rlike("^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$")
    return spark.read.parquet(path).groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("ids"), F.count_distinct("id").alias("distinct_ids"), F.count_if(version_4).alias("version_4")
    )


def default_now(spark, sf):
    """What holds of a default time: one for the whole query, never null, and now."""
    stamped = Tables(spark, sf)("customer").select(
        "c_mktsegment", F.current_timestamp().cast("timestamp_ntz").alias("created_at"),
    )
    age = F.abs(F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp(F.col("created_at").cast("timestamp")))
    return stamped.groupBy("c_mktsegment").agg(
        F.count("created_at").alias("stamped"), F.count_distinct("created_at").alias("times"), (F.max(age) < 60).alias("recent")
    )


QUERIES = {
    "prefix": Query(prefix, f"""
        SELECT o_orderkey, {uuid5_sql('CAST(o_orderkey AS VARCHAR)')} AS root_id, 2 AS depth
        FROM orders
    """),
    "format_id": Query(format_id, """
        SELECT o_orderkey, 'org-' || lpad(CAST(o_custkey AS VARCHAR),
                   CAST(greatest(3, length(CAST(o_custkey AS VARCHAR))) AS INTEGER), '0')
                   AS organization_id,
               'https://api.' || lower(o_orderstatus) || '.com/v1' AS api_endpoint,
               lower(o_orderstatus) || '_source_' || o_custkey AS permission_source_name
        FROM orders
    """),
    "array_pick": Query(array_pick, """
        SELECT DISTINCT l_orderkey, l_linenumber,
               ['google', 'azure', 'okta'][(l_orderkey + l_linenumber) % 3 + 1] AS provider
        FROM lineitem
    """),
    "case_normalize": Query(case_normalize, """
        SELECT o_orderkey, lower(o_orderpriority) AS priority, lower(o_orderstatus) AS status,
               'AWS' AS provider FROM orders
    """),
    "empty_to_null": Query(empty_to_null, r"""
        SELECT page_id, nullif(regexp_extract(url, '\?(.*)$', 1), '') AS query FROM pages
    """),
    "suffix_predicate": Query(suffix_predicate, """
        SELECT page_id, url FROM pages WHERE url LIKE '%#top'
    """),
    "iso_format_parse": Query(iso_format_parse, """
        SELECT event_id, CASE WHEN epoch_us(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
               ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS iso, true AS same
        FROM events
    """),
    "progress_pct": Query(progress_pct, """
        SELECT DISTINCT l_orderkey, l_linenumber,
               CAST(floor((l_linenumber / 7) * 100) AS INTEGER) AS pct
        FROM lineitem
    """),
    "map_upper_merge": Query(map_upper_merge, """
        SELECT event_id, 3 AS entries, upper(event_type) AS type, 'API' AS source,
               CAST(user_id AS VARCHAR) AS user FROM events
    """),
    "json_encode_decode": Query(json_encode_decode, """
        SELECT event_id, CAST(to_json({'event_id': event_id, 'event_type': event_type}) AS VARCHAR)
               AS encoded, event_type AS decoded, CAST(NULL AS VARCHAR) AS missing
        FROM events
    """),
    "variant_type_profile": Query(variant_type_profile, """
        WITH good AS (SELECT * FROM events WHERE event_type <> 'error')
        SELECT unnest(['id', 'half', 'kind', 'bought', 'pair', 'props']) AS key,
               unnest(['BIGINT', 'DECIMAL', 'STRING', 'BOOLEAN', 'ARRAY', 'OBJECT']) AS type, count(*) AS n FROM good
        UNION ALL SELECT 'target', 'VOID', count(*) FROM good WHERE event_type = 'click'
        UNION ALL SELECT 'text', 'ERROR', count(*) FROM events WHERE event_type = 'error'
    """),
    "events_json_props": Query(events_json_props, """
        SELECT event_type, CAST(sum(CAST(json_extract(props, '$.k') AS INTEGER)) AS BIGINT) AS k_total
        FROM events GROUP BY event_type
    """),
    "byte_concat": Query(byte_concat, """
        SELECT doc_id, octet_length(encode(text) || encode(source)) AS bytes,
               md5(text || source) AS digest FROM documents
    """),
    "random_uuid": Query(random_uuid, """
        SELECT c_mktsegment, count(*) AS ids, count(*) AS distinct_ids, count(*) AS version_4
        FROM customer GROUP BY c_mktsegment
    """),
    "default_now": Query(default_now, """
        SELECT c_mktsegment, count(*) AS stamped, CAST(1 AS BIGINT) AS times, true AS recent
        FROM customer GROUP BY c_mktsegment
    """),
}
