"""One gapless number for every row of a table, in one total order."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from millrace.session import work_path


def global_order(df: DataFrame, *order: str | Column, name: str = "row_id", start: int = 0) -> DataFrame:
    """The rows with the numbers ``start``, ``start + 1``, ... in the given order.

    Rows are dealt into ranges of the order and sorted within them; a row's number is its place in its range and the
    number of rows in the ranges before, of which there is one count each. No window runs over the rows.
    Rows that the order does not tell apart come in the order of a hash of all their columns, so one value with very many
    rows fills several ranges. The ranges are written to the shared folder, since numbers must not change
    when a lost executor's rows are made again.
    """
    by = [F.col(c) if isinstance(c, str) else c for c in order] + [F.xxhash64(*df.columns)]
    path = work_path(df.sparkSession, "ranges")
    # the number of a range in the upper bits, the place in it in the lower 33
    number = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(*by).sortWithinPartitions(*by)
    ranged.withColumn("_at", number).write.parquet(path)
    placed = df.sparkSession.read.parquet(path)
    part = F.shiftright("_at", 33)
    # one row a range, of which there are as many as shuffle partitions
    counts = sorted(tuple(r) for r in placed.groupBy(part).agg(F.count(F.lit(1))).collect())
    before = accumulate((n for _, n in counts), initial=start)
    offsets = df.sparkSession.createDataFrame([(r, n) for (r, _), n in zip(counts, before)], "_part long, _before long")
    joined = placed.join(F.broadcast(offsets), part == F.col("_part"))
    return joined.withColumn(name, F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_at", "_part", "_before")
