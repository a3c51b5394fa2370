"""Services as Spark sources: pages of tenants as a table, an append log as a stream.

Both are Python data sources with their own plan of partitions. What a service holds is asked for when a query is
planned; a tenant and a range of pages can be asked for, so others are never fetched. A task fetches page after
page, each with its own retries, and holds one at a time.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

PAGE, FIRST, LAST = "page", "first_page", "last_page"


class Pages(InputPartition):
    """Some neighbouring pages of one tenant."""

    def __init__(self, tenant: tuple, first: int, last: int):
        self.tenant, self.first, self.last = tenant, first, last


class Entries(InputPartition):
    """Entries of a log after one position and up to another."""

    def __init__(self, after: int, upto: int):
        self.after, self.upto = after, upto


def fetched(fetch: Callable[..., pd.DataFrame], arguments: tuple, max_attempts: int, wait_seconds: float) -> pd.DataFrame:
    """One answer of a service; a failing call is repeated with doubled waits, the last failure is the caller's."""
    for attempt in range(1, max_attempts + 1):
        try:
            return fetch(*arguments)
        except Exception:
            if attempt == max_attempts:
                raise
            time.sleep(wait_seconds * 2 ** (attempt - 1))


def as_batch(answer: pd.DataFrame, schema: pa.Schema, constants: Mapping) -> pa.RecordBatch:
    """An answer with the columns of the source; what the service left out is null."""
    columns = [pa.array([constants[f.name]] * len(answer), f.type) if f.name in constants
               else pa.Array.from_pandas(answer[f.name], type=f.type) if f.name in answer and len(answer) else pa.nulls(len(answer), f.type)
               for f in schema]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


class PageReader(DataSourceReader):
    """The plan of partitions holds the pages the options ask for; the reader is one of the frame that was loaded."""

    def __init__(self, source: type, schema: StructType, options: Mapping[str, str]):
        self.source, self.schema = source, schema
        self.wanted = {c: options[c] for c in source.tenant if c in options}
        self.first, self.last = int(options.get(FIRST, 1)), int(options[LAST]) if LAST in options else None

    def partitions(self) -> Sequence[InputPartition]:
        out, size = [], self.source.pages_per_partition
        for row in self.source.list_tenants():
            tenant = tuple(row[c] for c in self.source.tenant)
            if all(row[c] is not None and str(row[c]) == value for c, value in self.wanted.items()):
                last = int(row["pages"]) if self.last is None else min(self.last, int(row["pages"]))
                out += [Pages(tenant, lo, min(lo + size - 1, last)) for lo in range(max(self.first, 1), last + 1, size)]
        return out

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        if partition is None:  # a plan without partitions
            return
        schema, named = to_arrow_schema(self.schema), dict(zip(self.source.tenant, partition.tenant))
        for page in range(partition.first, partition.last + 1):
            answer = fetched(self.source.fetch, ({**named, PAGE: page},), self.source.max_attempts, self.source.wait_seconds)
            yield as_batch(answer, schema, {**named, PAGE: page})


def register_pages(
    spark: SparkSession, name: str, schema: str, tenant: Sequence[str],
    list_tenants: Callable[[], Iterable[Mapping]], fetch: Callable[[Mapping], pd.DataFrame], *,
    pages_per_partition: int = 100, max_attempts: int = 3, wait_seconds: float = 0.0,
) -> None:
    """Make ``spark.read.format(name).load()`` the pages of a service.

    ``list_tenants()`` gives the tenant columns and the number of ``pages`` of each tenant when a frame is planned;
    ``fetch`` answers one tenant and ``page``, counted from 1. ``schema`` names the columns of the table, with those
    of the tenant and, if wanted, ``page`` among them. A partition is up to ``pages_per_partition`` neighbouring pages of
    one tenant, so a large tenant is read by many tasks and the plan has one entry for each.
    """
    settings = dict(tenant=list(tenant), list_tenants=staticmethod(list_tenants), fetch=staticmethod(fetch),
                    pages_per_partition=pages_per_partition, max_attempts=max_attempts, wait_seconds=wait_seconds)

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def reader(self, schema: StructType) -> PageReader:
            return PageReader(type(self), schema, self.options)

    for key, value in settings.items():
        setattr(Source, key, value)
    spark.dataSource.register(Source)


def read_pages(spark: SparkSession, name: str, first_page: int | None = None, last_page: int | None = None, **tenant) -> DataFrame:
    """The pages of a registered service; only those of the tenant values and the page range that are given are fetched.

    They are options of this frame and not filters that Spark hands down: in Spark 4.1 what is handed to a Python
    source stays with it and would also cut other uses of the same frame.
    """
    reader = spark.read.format(name).options(**{c: str(v) for c, v in tenant.items()})
    for option, value in ((FIRST, first_page), (LAST, last_page)):
        reader = reader if value is None else reader.option(option, str(value))
    return reader.load()


class LogReader(DataSourceStreamReader):
    def __init__(self, source: type, schema: StructType):
        self.source, self.schema = source, schema

    def initialOffset(self) -> dict:
        return {"position": self.source.start}

    def latestOffset(self) -> dict:
        return {"position": int(self.source.newest())}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        size = self.source.entries_per_partition
        return [Entries(lo, min(lo + size, end["position"])) for lo in range(start["position"], end["position"], size)]

    def read(self, partition: Entries) -> Iterator[pa.RecordBatch]:
        answer = fetched(self.source.fetch, (partition.after, partition.upto), self.source.max_attempts, self.source.wait_seconds)
        yield as_batch(answer, to_arrow_schema(self.schema), {})

    def commit(self, end: dict) -> None:
        if self.source.consumed:
            self.source.consumed(end["position"])


def register_log(
    spark: SparkSession, name: str, schema: str, newest: Callable[[], int], fetch: Callable[[int, int], pd.DataFrame], *,
    consumed: Callable[[int], None] | None = None, start: int = 0, entries_per_partition: int = 10_000,
    max_attempts: int = 3, wait_seconds: float = 0.0,
) -> None:
    """Make ``spark.readStream.format(name).load()`` an append log that is polled.

    Entries have rising positions. ``newest()`` is the position of the last one, ``fetch(after, upto)`` the entries behind
    ``after`` up to ``upto``; it has to give the same rows whenever it is asked. Spark writes the positions of
    a micro-batch to its checkpoint before it reads, so after a restart a batch is read again from and to the same
    positions. ``consumed`` hears of positions whose rows are through. A batch is what has come since the last.
    """
    settings = dict(newest=staticmethod(newest), fetch=staticmethod(fetch), consumed=staticmethod(consumed) if consumed else None,
                    start=start, entries_per_partition=entries_per_partition, max_attempts=max_attempts, wait_seconds=wait_seconds)

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def streamReader(self, schema: StructType) -> LogReader:
            return LogReader(type(self), schema)

    for key, value in settings.items():
        setattr(Source, key, value)
    spark.dataSource.register(Source)


class StoredPages:
    """A service that answers from pages stored as ``body`` in folders named after tenant and page."""

    def __init__(self, path: str, tenant: Sequence[str]):
        self.path, self.tenant = path, list(tenant)

    def __call__(self, request: Mapping) -> pd.DataFrame:
        folder = "/".join(f"{c}={request[c]}" for c in (*self.tenant, PAGE))
        store, path = _store(f"{self.path}/{folder}")
        return pd.DataFrame(json.loads(ds.dataset(path, filesystem=store, format="parquet").to_table(["body"]).column(0)[0].as_py()))


class StoredLog:
    """A log kept as Parquet in blocks of a fixed number of positions, with the newest position in a file of its own."""

    def __init__(self, path: str, position: str, block: int):
        self.path, self.position, self.block = path, position, block

    def grow(self, newest: int) -> None:
        """Let readers see the entries up to a position."""
        store, path = _store(self.path)
        with store.open_output_stream(f"{path}/newest") as file:
            file.write(str(newest).encode())

    def newest(self) -> int:
        store, path = _store(self.path)
        with store.open_input_stream(f"{path}/newest") as file:
            return int(file.read())

    def __call__(self, after: int, upto: int) -> pd.DataFrame:
        store, path = _store(self.path)
        blocks = [f"{path}/block={b}" for b in range((after + 1) // self.block, upto // self.block + 1)]
        there = [i.path for i in store.get_file_info(blocks) if i.type.name == "Directory"]
        parts = [ds.dataset(p, filesystem=store, format="parquet").to_table(
            filter=(ds.field(self.position) > after) & (ds.field(self.position) <= upto)) for p in there]
        return pa.concat_tables(parts).to_pandas() if parts else pd.DataFrame({self.position: []})


def _store(path: str):
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
