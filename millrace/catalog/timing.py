"""Queries on call and job logs; events per user or type stand for them."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.base import EVENT_TIMES_SQL, Query, Tables, event_times, uuid5_sql
from millrace.functions.hashing import uuid5
from millrace.operators import dedup, jobs, timing
from millrace.operators.messages import first_message_within as deliver

HOUR_US = 3_600_000_000
WAIT_US = 6 * HOUR_US
E = f"WITH e AS ({EVENT_TIMES_SQL})"


def call_gaps(spark, sf):
    calls = event_times(Tables(spark, sf)).select("user_id", "event_id", "at_us")
    return timing.call_gaps(calls, ["user_id"], "at_us", "event_id")


def running_count_before(spark, sf):
    calls = event_times(Tables(spark, sf)).select("user_id", "event_id", "at_us")
    return timing.running_count_before(calls, ["user_id"], "at_us", "event_id")


def spacing_schedule(spark, sf):
    calls = event_times(Tables(spark, sf)).select("user_id", "event_id", "at_us")
    return timing.spacing_schedule(calls, ["user_id"], "at_us", "event_id", HOUR_US)


def spacing_strict(spark, sf):
    calls = event_times(Tables(spark, sf)).select("user_id", "event_id", "at_us")
    return timing.spacing_strict(calls, ["user_id"], "at_us", "event_id", HOUR_US)


def rate_limit_compliance(spark, sf):
    calls = event_times(Tables(spark, sf)).select("event_type", "at_us")
    return timing.rate_limit_compliance(calls, ["event_type"], "at_us", 5, HOUR_US)


def chunk_assign(spark, sf):
    orders = Tables(spark, sf)("orders").select("o_orderstatus", "o_orderkey")
    return timing.chunk_assign(orders, ["o_orderstatus"], ["o_orderkey"])


def peak_concurrency(spark, sf):
    # views are still open
    end = F.when(F.col("event_type") != "view", F.col("end_us"))
    runs = event_times(Tables(spark, sf)).select("user_id", "at_us", end.alias("end_us"))
    return timing.peak_concurrency(runs, ["user_id"], "at_us", "end_us", limit=3)


def attempts_exhausted(spark, sf):
    failures = event_times(Tables(spark, sf)).where("event_type = 'error'")
    numbered = timing.attempts_exhausted(
        failures.select("user_id", "event_id", "at_us", F.col("props").alias("answer")), ["user_id"], "at_us", "event_id",
        max_attempts=3, interval_ms=2000, backoff_rate=2,
    )
    return timing.with_fallback(numbered, "answer", "exhausted", F.lit("default"))


def completion_order(spark, sf):
    end = F.when(F.col("event_type") != "view", F.col("end_us"))
    runs = event_times(Tables(spark, sf)).select("user_id", "event_id", end.alias("end_us"))
    return timing.completion_order(runs, ["user_id"], "end_us", "event_id")


def duration_summary(spark, sf):
    runs = event_times(Tables(spark, sf))
    return timing.duration_summary(runs, ["user_id"], "length_us", "at_us", "end_us")


def payload_size_profile(spark, sf):
    return timing.payload_size_profile(Tables(spark, sf)("documents"), "n_chars")


def first_message_within(spark, sf):
    events = event_times(Tables(spark, sf)).select(
        "user_id", "event_type", F.col("event_id").alias("id"), "at_us"
    ).where("user_id IS NOT NULL")
    requests = events.where("event_type = 'signup'")
    messages = events.where("event_type = 'purchase'")
    return deliver(requests, messages, ["user_id"], WAIT_US)


FIRST_MESSAGE_SQL = """
    WITH RECURSIVE req AS (
        SELECT user_id, event_id, epoch_us(ts) AS at_us,
               row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k
        FROM events WHERE event_type = 'signup'
    ), msg AS (
        SELECT user_id, event_id, epoch_us(ts) AS at_us,
               row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n
        FROM events WHERE event_type = 'purchase'
    ), reachable AS (
        SELECT r.user_id, r.k, count(m.n) AS sent
        FROM req r LEFT JOIN msg m ON m.user_id = r.user_id AND m.at_us <= r.at_us + 21600000000
        GROUP BY r.user_id, r.k
    ), walk AS (
        SELECT DISTINCT user_id, CAST(0 AS BIGINT) AS k, CAST(0 AS BIGINT) AS taken, false AS got
        FROM req
        UNION ALL
        SELECT w.user_id, r.k, least(w.taken + 1, r.sent), r.sent > w.taken
        FROM walk w JOIN reachable r ON r.user_id = w.user_id AND r.k = w.k + 1
    )
    SELECT r.user_id, r.event_id AS request_id, r.at_us AS request_at,
           m.event_id AS message_id, m.at_us AS message_at
    FROM req r JOIN walk w ON w.user_id = r.user_id AND w.k = r.k
    LEFT JOIN msg m ON w.got AND m.user_id = r.user_id AND m.n = w.taken
"""


def latest_run(spark, sf):
    return dedup.latest_run(Tables(spark, sf)("orders"), "o_orderkey", "o_orderdate")


def queue_status_filter(spark, sf):
    return jobs.status_filter(
        Tables(spark, sf)("orders"), ["F", "P"], status_col="o_orderstatus",
        o_orderpriority="1-URGENT",
    )


def queue_status_counts(spark, sf):
    return jobs.queue_status_counts(
        Tables(spark, sf)("orders"), ["o_orderpriority", "o_orderstatus"], "o_orderkey", "o_orderdate"
    )


def listing_limit(spark, sf):
    return jobs.status_filter(
        Tables(spark, sf)("orders"), ["F"], 10, [F.col("o_orderdate").desc(), F.col("o_orderkey")],
        "o_orderstatus",
    )


def topk_recent(spark, sf):
    return jobs.top_recent(Tables(spark, sf)("orders"), "o_orderdate", "o_orderkey", 20)


def column_sort(spark, sf):
    return jobs.sort_by(Tables(spark, sf)("orders"), "o_totalprice", "o_orderkey", ascending=False)


def counter_by_attribute(spark, sf):
    return jobs.count_by(Tables(spark, sf)("events"), "event_type")


def key_message_count(spark, sf):
    return jobs.count_by(Tables(spark, sf)("events"), "user_id")


def root_run_rollup(spark, sf):
    child = F.concat_ws(
        "-", uuid5(F.col("l_orderkey").cast("string")), "l_linenumber", "l_suppkey"
    )
    runs = Tables(spark, sf)("lineitem").select(
        child.alias("run_id"), F.col("l_quantity").cast("bigint").alias("rows_loaded")
    )
    return jobs.root_run_rollup(runs, "run_id", "rows_loaded")


def nested_list_totals(spark, sf):
    words = F.transform(
        F.split("text", "\n"), lambda line: F.transform(F.split(line, " "), lambda w: F.length(w))
    )
    lists = Tables(spark, sf)("documents").select("doc_id", words.alias("nested"))
    return jobs.nested_list_totals(lists, "nested").drop("nested")


def kv_type_profile(spark, sf):
    texts = F.array(
        F.concat(F.lit("props="), "props"),
        F.concat(F.lit(" user_id = "), "user_id"),
        F.concat(F.lit("half="), "event_id", F.lit(".5")),
        F.concat(F.lit("type="), "event_type"),
        F.concat(F.lit("key="), uuid5("event_type")),
        F.concat(F.lit("broken={"), "event_type", F.lit("}")),
        F.concat(F.lit("pair="), "event_type", F.lit("="), "user_id"),
        F.concat(F.lit("list=["), "user_id", F.lit(","), "event_id", F.lit("]")),
        F.concat(F.lit("flag="), F.when(F.col("event_type") == "error", "FALSE").otherwise("true")),
        F.col("event_type"),
    )
    rows = Tables(spark, sf)("events").select(F.explode(texts).alias("text"))
    return jobs.parameter_profile(rows, "text")


QUERIES = {
    "call_gaps": Query(call_gaps, E + """
        SELECT user_id, event_id, at_us, at_us - lag(at_us) OVER w AS gap_us,
               at_us - min(at_us) OVER (PARTITION BY user_id) AS elapsed_us
        FROM e WINDOW w AS (PARTITION BY user_id ORDER BY at_us, event_id)
    """),
    "running_count_before": Query(running_count_before, E + """
        SELECT user_id, event_id, at_us,
               row_number() OVER (PARTITION BY user_id ORDER BY at_us, event_id) - 1 AS count_before
        FROM e
    """),
    "spacing_schedule": Query(spacing_schedule, E + """
        SELECT user_id, event_id, at_us, greatest(at_us, min(at_us) OVER (PARTITION BY user_id)
               + (row_number() OVER (PARTITION BY user_id ORDER BY at_us, event_id) - 1) * 3600000000
               ) AS start_us
        FROM e
    """),
    "spacing_strict": Query(spacing_strict, """
        WITH RECURSIVE calls AS (
            SELECT user_id, event_id, epoch_us(ts) AS at_us,
                   row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k
            FROM events
        ), walk AS (
            SELECT user_id, event_id, at_us, k, at_us AS start_us FROM calls WHERE k = 1
            UNION ALL
            SELECT c.user_id, c.event_id, c.at_us, c.k,
                   greatest(c.at_us, w.start_us + 3600000000)
            FROM walk w JOIN calls c ON c.user_id = w.user_id AND c.k = w.k + 1
        )
        SELECT user_id, event_id, at_us, start_us FROM walk
    """),
    "rate_limit_compliance": Query(rate_limit_compliance, E + """
        , calls AS (SELECT event_type, at_us, count(*) AS starts FROM e GROUP BY ALL)
        , counted AS (
            SELECT *, CAST(sum(starts) OVER (PARTITION BY event_type ORDER BY at_us
                       RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW) AS BIGINT) AS in_period
            FROM calls
        )
        SELECT *, in_period > 5 AS over_limit FROM counted
    """),
    "chunk_assign": Query(chunk_assign, """
        WITH numbered AS (
            SELECT o_orderstatus, o_orderkey,
                   row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1 AS n
            FROM orders
        )
        SELECT o_orderstatus, o_orderkey, n // 100 AS chunk_no, (n % 100) // 10 AS batch_no
        FROM numbered
    """),
    "peak_concurrency": Query(peak_concurrency, E + """
        , edges AS (
            SELECT user_id, at_us AS t, 1 AS d FROM e
            UNION ALL SELECT user_id, end_us, -1 FROM e WHERE event_type <> 'view'
        ), levels AS (
            SELECT user_id, sum(d) OVER (PARTITION BY user_id ORDER BY t, d
                   ROWS UNBOUNDED PRECEDING) AS level FROM edges
        )
        SELECT user_id, CAST(max(level) AS BIGINT) AS peak, max(level) > 3 AS over_limit
        FROM levels GROUP BY user_id
    """),
    "attempts_exhausted": Query(attempts_exhausted, E + """
        , numbered AS (
            SELECT user_id, event_id, at_us, props,
                   row_number() OVER (PARTITION BY user_id ORDER BY at_us, event_id) AS attempt
            FROM e WHERE event_type = 'error'
        )
        SELECT * EXCLUDE (props), CASE WHEN attempt >= 3 THEN 'default' ELSE props END AS answer, CASE attempt WHEN 1 THEN CAST(2000 AS BIGINT) WHEN 2 THEN 4000 END AS backoff_ms,
               attempt >= 3 AS exhausted
        FROM numbered
    """),
    "completion_order": Query(completion_order, E + """
        , runs AS (SELECT user_id, event_id, CASE WHEN event_type <> 'view' THEN end_us END AS end_us FROM e)
        SELECT *, CASE WHEN end_us IS NOT NULL THEN
               rank() OVER (PARTITION BY user_id ORDER BY end_us NULLS LAST, event_id) END AS finish_rank
        FROM runs
    """),
    "duration_summary": Query(duration_summary, E + """
        SELECT user_id, count(*) AS runs, CAST(sum(length_us) AS BIGINT) AS total_duration,
               max(end_us) - min(at_us) AS wall_clock,
               round(CAST(sum(length_us) AS DOUBLE) / nullif(max(end_us) - min(at_us), 0), 6) AS ratio
        FROM e GROUP BY user_id
    """),
    "payload_size_profile": Query(payload_size_profile, """
        SELECT length(CAST(n_chars AS VARCHAR)) - 1 AS size_class, count(*) AS payloads,
               CAST(sum(n_chars) AS BIGINT) AS total_size, round(avg(n_chars), 6) AS mean_size
        FROM documents GROUP BY 1
    """),
    "first_message_within": Query(first_message_within, FIRST_MESSAGE_SQL),
    "latest_run": Query(latest_run, """
        SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1
    """),
    "queue_status_filter": Query(queue_status_filter, """
        SELECT * FROM orders WHERE o_orderstatus IN ('F', 'P') AND o_orderpriority = '1-URGENT'
    """),
    "queue_status_counts": Query(queue_status_counts, """
        SELECT o_orderpriority, o_orderstatus, count(*) AS runs,
               first(o_orderkey ORDER BY o_orderdate, o_orderkey) AS first_id
        FROM orders GROUP BY ALL
    """),
    "listing_limit": Query(listing_limit, """
        SELECT * FROM orders WHERE o_orderstatus = 'F'
        ORDER BY o_orderdate DESC, o_orderkey LIMIT 10
    """),
    "topk_recent": Query(topk_recent, """
        SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 20
    """),
    "column_sort": Query(column_sort, """
        SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey
    """),
    "counter_by_attribute": Query(counter_by_attribute, """
        SELECT event_type, count(*) AS n FROM events GROUP BY event_type
    """),
    "key_message_count": Query(key_message_count, """
        SELECT user_id, count(*) AS n FROM events GROUP BY user_id
    """),
    "root_run_rollup": Query(root_run_rollup, f"""
        SELECT {uuid5_sql('CAST(l_orderkey AS VARCHAR)')} AS root_id, count(*) AS runs,
               CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total, 2 AS max_depth
        FROM lineitem GROUP BY l_orderkey
    """),
    "nested_list_totals": Query(nested_list_totals, """
        WITH words AS (
            SELECT doc_id, len(string_split(text, chr(10))) AS lists,
                   flatten(list_transform(string_split(text, chr(10)),
                           lambda l: string_split(l, ' '))) AS items
            FROM documents
        )
        SELECT doc_id, lists, len(items) AS elements,
               CAST(coalesce(list_sum(list_transform(items, lambda w: length(w))), 0) AS BIGINT) AS total
        FROM words
    """),
    "kv_type_profile": Query(kv_type_profile, f"""
        WITH texts AS (
            SELECT unnest([
                'props=' || props, ' user_id = ' || user_id, 'half=' || event_id || '.5',
                'type=' || event_type, 'key=' || {uuid5_sql('event_type')},
                'broken={{' || event_type || '}}', 'pair=' || event_type || '=' || user_id,
                'list=[' || user_id || ',' || event_id || ']',
                'flag=' || CASE WHEN event_type = 'error' THEN 'FALSE' ELSE 'true' END, event_type
            ]) AS x FROM events
        ), cut AS (
            SELECT CASE WHEN instr(x, '=') > 0 THEN trim(substr(x, 1, instr(x, '=') - 1)) END AS k,
                   CASE WHEN instr(x, '=') > 0 THEN trim(substr(x, instr(x, '=') + 1)) END AS v
            FROM texts
        ), typed AS (
            SELECT k, v, CASE
                WHEN k IS NULL THEN 'invalid'
                WHEN lower(v) IN ('true', 'false') THEN 'boolean'
                WHEN (v LIKE '{{%}}' OR v LIKE '[%]') AND json_valid(v) THEN 'json'
                WHEN TRY_CAST(v AS BIGINT) IS NOT NULL AND v NOT LIKE '%.%' THEN 'integer'
                WHEN TRY_CAST(v AS DOUBLE) IS NOT NULL THEN 'float'
                WHEN TRY_CAST(v AS UUID) IS NOT NULL AND length(v) = 36 THEN 'uuid'
                ELSE 'string' END AS t
            FROM cut
        )
        SELECT k AS key, t AS type, count(*) AS n, count(DISTINCT v) AS distinct_values
        FROM typed GROUP BY k, t
    """),
}
