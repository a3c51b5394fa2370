"""Extraction from a source that answers one page at a time."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from millrace.operators.dedup import UNORDERED
from millrace.operators.ordered import order_within
from millrace.sinks.tables import COMPRESSION

_BLOCK = 10_000
#: Pages in a row group of stored pages.
_GROUP_PAGES = 64
#: Of 64-bit hashes, which makes 1,024 ranges for each tenant.
_PLACE_WIDTH = 1 << 54


def with_batch(pages: DataFrame, pages_per_batch: int = 10) -> DataFrame:
    """Number of the batch each page belongs to; pages and batches count from 1."""
    return pages.withColumn("batch", F.floor((F.col("page") - 1) / pages_per_batch) + 1)


def page_plan(
    tenants: DataFrame, pages: str, pages_per_batch: int = 10, *, bodies: DataFrame | None = None, tenant: Sequence[str] = (),
) -> DataFrame:
    """One row per tenant and page, with its batch.

    A tenant's pages are listed in blocks, so one with very many pages makes no long array. With ``bodies`` (the columns
    of ``tenant``, page, body) the plan has the pages that are stored there, each with its body: tenants are looked up
    for them, so that bodies need not move where tenants are few.
    """
    count = F.col(pages).cast("bigint")
    if bodies is not None:
        stored = bodies.withColumn("page", F.col("page").cast("bigint")).join(tenants, [*tenant])
        return with_batch(stored.where((F.col("page") >= 1) & (F.col("page") <= count)), pages_per_batch)
    first = F.sequence(F.lit(1).cast("bigint"), count, F.lit(_BLOCK).cast("bigint"))
    blocks = tenants.where(count > 0).withColumn("_first", F.explode(first))
    last = F.least(F.col("_first") + (_BLOCK - 1), count)
    numbered = blocks.withColumn("page", F.explode(F.sequence(F.col("_first"), last)))
    return with_batch(numbered.drop("_first"), pages_per_batch)


def stored_pages(df: DataFrame, tenant: Sequence[str], order: Sequence[str], rows: int) -> DataFrame:
    """A table as the pages of a service: per tenant, rows in order, ``rows`` to a page, as JSON in ``body``.

    Rows are numbered per tenant in ranges (see :mod:`millrace.operators.ordered`), so a page is the only group
    that is brought together. They become JSON when they have their number, so it is not sorted.
    """
    plain = [c for c, kind in df.dtypes if not any(u in kind for u in UNORDERED)]
    rest = {f"_json_{c}": F.to_json(F.struct(c)) for c in df.columns if c not in plain}
    rows_of = df.withColumns({"_place": F.xxhash64(*order), **rest})
    by = ("_place", *[c for c in plain if c not in tenant], *rest)
    placed = order_within(rows_of, tenant, by, _PLACE_WIDTH).scan(number="_n").result()
    page = F.floor((F.col("_n") - 1) / rows) + 1
    placed = placed.select(*tenant, page.cast("bigint").alias("page"), F.to_json(F.struct(*df.columns)).alias("_row"))
    # the hash is first, so that sorting by the group compares whole numbers
    pages = placed.groupBy(F.xxhash64(*tenant, "page").alias("_page_hash"), *tenant, "page").agg(F.collect_list("_row").alias("_rows"))
    return pages.select(*tenant, "page", F.concat(F.lit("["), F.array_join("_rows", ","), F.lit("]")).alias("body"))


def store_pages(pages: DataFrame, path: str) -> DataFrame:
    """Write pages of :func:`stored_pages` and read them back.

    A page is one long text and Spark reads up to 4,096 rows of a row group into one array, which would be most of a
    gigabyte. Few pages to a row group bound what a task holds, however many there are and however well they compress.
    """
    small = {"parquet.block.row.count.limit": _GROUP_PAGES, "compression": COMPRESSION}
    pages.write.mode("overwrite").options(**small).parquet(path)
    return pages.sparkSession.read.parquet(path)


def rows_of_page(request: Mapping) -> pd.DataFrame:
    """Rows of a stored page; what a service that answers in JSON would be parsed with."""
    return pd.DataFrame(json.loads(request["body"]))


def records_of_page(request: Mapping) -> list[dict]:
    """The same rows as records, which skip the frame."""
    return json.loads(request["body"])


def union_pages(pages: DataFrame, schema: str, body: str = "body") -> DataFrame:
    """All rows of all pages in one scan; a page that is not a list of rows gives none."""
    return pages.select(F.inline(F.from_json(body, f"array<struct<{schema}>>")))


def paged_extract(
    plan: DataFrame,
    fetch: Callable[[Mapping], pd.DataFrame | list[dict]],
    schema: str,
    *,
    requests_in_parallel: int | None = None,
    max_attempts: int = 3,
    wait_seconds: float = 0.0,
    records: bool = False,
) -> DataFrame:
    """All rows of all pages; ``fetch(row of the plan)`` returns one page.

    The plan is spread over ``requests_in_parallel`` tasks and every task fetches page after page,
    holding one page at a time. A failing fetch is repeated up to ``max_attempts`` times with
    doubled waits; after that the task fails and Spark's own task retry takes over.

    With ``records``, a page is a list of records whose values have the types of ``schema``; they become columns without a
    frame in between. Fields that a record lacks are null, others than those of ``schema`` are left out.
    """
    def answer(request: Mapping) -> pd.DataFrame | list[dict]:
        for attempt in range(1, max_attempts + 1):
            try:
                return fetch(request)
            except Exception:
                if attempt == max_attempts:
                    raise
                time.sleep(wait_seconds * 2 ** (attempt - 1))

    def pull(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for request in batch.to_dict("records"):
                yield answer(request)

    def pull_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                yield pa.RecordBatch.from_pylist(answer(batch.slice(n, 1).to_pylist()[0]), schema=kinds)

    if requests_in_parallel:
        plan = plan.repartition(requests_in_parallel)
    if records:
        kinds = to_arrow_schema(StructType.fromDDL(schema))
        return plan.mapInArrow(pull_records, schema)
    return plan.mapInPandas(pull, schema)


def parallel_map(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str,
                 tasks: int | None = None) -> DataFrame:
    """A CPU-bound Python function over batches of rows, one Python process per running task.

    ``tasks`` spreads the rows first; leave it out when the input has enough partitions.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    return (df.repartition(tasks) if tasks else df).mapInPandas(run, schema)
