"""Helpers all operators share: tables written to the shared folder, whole rows kept beside new columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.session import work_path

#: Bytes of text that one numpy step takes at a time; a longer document is a step of its own.
STEP_BYTES = 1 << 18
#: Bytes of an Arrow batch that is sent to Python.
BATCH_BYTES = 4 << 20


#: Tables made within each :func:`finished` that is under way.
_MADE: list[list[str]] = []


def saved(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts the lineage, survives lost executors.

    The folder is removed when the session's JVM ends, or with the step it belongs to (see :func:`finished`).
    """
    spark = df.sparkSession
    path = made_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def made_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder; what is written there goes as :func:`saved` tables do."""
    path = work_path(spark, name)
    if _MADE:
        _MADE[-1].append(path)
    return path


def finished(spark: SparkSession, build: Callable[[], DataFrame], name: str) -> DataFrame:
    """Write what ``build`` returns and remove the tables that were saved on the way; only the result stays."""
    _MADE.append([])
    try:
        out = build()
        path = work_path(spark, name)
        out.write.parquet(path)
    finally:
        made = _MADE.pop()
    if _MADE:
        _MADE[-1].append(path)
    for folder in made:
        _remove(spark, folder)
    return spark.read.schema(out.schema).parquet(path)


def _remove(spark: SparkSession, folder: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


#: Bits of the map that :func:`perhaps_among` sends to all tasks: 4 MB, however many ids there are.
MAP_BITS = 1 << 25


def perhaps_among(rows: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """The rows whose id is among ``ids``, and a few others that a join with the ids has to leave out.

    Tasks get one bit for each hash of an id and not the ids, so long texts need not be shuffled to find out that most
    of them are not wanted.
    """
    kind = rows.select(name).union(ids.select(name)).schema[name].dataType  # equal ids of two types have other hashes

    def slot(column):  # bitmaps count from 1
        return F.pmod(F.xxhash64(column.cast(kind)), F.lit(MAP_BITS)) + 1

    marks = ids.select(slot(ids[name]).alias("_slot")).groupBy(F.bitmap_bucket_number("_slot").alias("_part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias("_bits"))
    place = F.bitmap_bit_position(slot(rows[name]))
    byte = F.conv(F.hex(F.substring(marks["_bits"], (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = (F.bitmap_bucket_number(slot(rows[name])) == marks["_part"]) & (F.getbit(byte, (place % 8).cast("int")) == 1)
    return rows.join(F.broadcast(marks), hit, "left_semi")


class Rounds:
    """The table of an iteration: each round's rows replace those of the round before, which they are made from."""

    def __init__(self, name: str):
        self.name, self.path, self.frame = name, None, None

    def put(self, df: DataFrame) -> DataFrame:
        spark, old, self.path = df.sparkSession, self.path, work_path(df.sparkSession, self.name)
        df.write.parquet(self.path)
        if old:
            _remove(spark, old)
        self.frame = spark.read.schema(df.schema).parquet(self.path)
        return self.frame


def in_batches(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` with batches bounded in bytes, since texts may be long.

    The bound is a setting of the session and holds for its later Arrow batches too.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/documents.parquet")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def boxed(docs: DataFrame, **columns) -> DataFrame:
    """New columns beside the whole row in one column ``row``, so that no name can clash."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                       *(c.alias(name) for name, c in columns.items()))


def unboxed(frame: DataFrame) -> DataFrame:
    return frame.select("row.*")
