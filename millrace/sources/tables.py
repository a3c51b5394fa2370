"""Tables, databases and object listings."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F


def table_scan(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, schema: str | None = None
) -> DataFrame:
    """A Parquet table, or the named columns of it."""
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(path)
    return df.select(*columns) if columns else df


def database_scan(
    spark: SparkSession, url: str, table: str, *, column: str | None = None, lower: int | None = None,
    upper: int | None = None, partitions: int | None = None, **options: str,
) -> DataFrame:
    """A database table over JDBC, read in ranges of a numeric column when one is given.

    The driver class of the database has to be on the class path.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if column is not None:
        reader = reader.options(
            partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=partitions
        )
    return reader.load()


def federated_join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Two sources of any format in one plan; each gets its own filters and columns pushed down."""
    return left.join(right, on, how)


def object_listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Objects below a folder; the contents are not read.

    Spark keeps one entry per object on the driver. :func:`prefix_listing` does without.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", F.col("length").alias("size_bytes"), "modificationTime")
    )


_LISTING = "prefix string, path string, size_bytes bigint"


def prefix_listing(
    prefixes: DataFrame, prefix: str = "prefix", page_size: int = 1000, tasks: int | None = None
) -> DataFrame:
    """Objects below many prefixes, each listed by the task that holds it, page by page.

    Prefixes are folder URIs of any file system Arrow knows. A task walks one folder at a time, so
    nothing about the objects passes through the driver.
    """
    def pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri in batch[prefix]:
                store, root = fs.FileSystem.from_uri(uri)
                folders = [root]
                while folders:
                    entries = store.get_file_info(fs.FileSelector(folders.pop()))
                    folders += [e.path for e in entries if e.type == fs.FileType.Directory]
                    files = [(uri, e.path, e.size) for e in entries if e.type == fs.FileType.File]
                    for start in range(0, len(files), page_size):
                        yield pd.DataFrame(
                            files[start:start + page_size], columns=["prefix", "path", "size_bytes"]
                        )

    names = prefixes.select(prefix)
    return (names.repartition(tasks) if tasks else names).mapInPandas(pages, _LISTING)
