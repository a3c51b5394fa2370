"""Folders of partitioned tables: their names, listing, removal, and names that only one writer can take."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def partition_folder(spark: SparkSession, **values: str | int | None) -> str:
    """The folder Spark writes rows of these partition values to; special signs are escaped as Spark does."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return "/".join(
        f"{name}=" + ("__HIVE_DEFAULT_PARTITION__" if value in (None, "") else escape(str(value)))
        for name, value in values.items()
    )


def exists(spark: SparkSession, path: str) -> bool:
    target, store = _path(spark, path)
    return store.exists(target)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder; none if it is not there."""
    target, store = _path(spark, path)
    return sorted(s.getPath().getName() for s in store.listStatus(target)) if store.exists(target) else []


def remove(spark: SparkSession, path: str) -> None:
    target, store = _path(spark, path)
    store.delete(target, True)


def make(spark: SparkSession, path: str) -> None:
    target, store = _path(spark, path)
    store.mkdirs(target)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    target, store = _path(spark, path)
    out = store.create(target, True)
    try:
        out.write(text.encode())
    finally:
        out.close()


def age_seconds(spark: SparkSession, path: str) -> float:
    """Seconds since a folder was last changed."""
    target, store = _path(spark, path)
    return time.time() - store.getFileStatus(target).getModificationTime() / 1000


def remove_matching(spark: SparkSession, pattern: str) -> None:
    """Remove all folders a glob finds."""
    target, store = _path(spark, pattern)
    for status in store.globStatus(target) or []:
        store.delete(status.getPath(), True)


def publish(spark: SparkSession, prepared: str, path: str) -> bool:
    """Give a prepared folder its final name; false if that name is taken, so of several writers one succeeds.

    The store has to rename folders in one step (HDFS, ABFS, local disks). Some stores move a folder into one that has
    the name already instead of failing; what comes to lie there is taken out again.
    """
    source, store = _path(spark, prepared)
    target = _path(spark, path)[0]
    store.mkdirs(target.getParent())
    if store.exists(target):
        return False
    mark = f"_{source.getName()}"
    store.create(_path(spark, f"{prepared}/{mark}")[0], True).close()
    if store.rename(source, target) and store.exists(_path(spark, f"{path}/{mark}")[0]):
        return True
    remove(spark, f"{path}/{source.getName()}")
    return False
