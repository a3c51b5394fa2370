"""Ordered computations per key that stay parallel when one key holds much of the data.

A window function sorts all rows of a key in one task. Here the order of a key is cut into buckets of fixed
width, given by the caller: a row's bucket is the whole part of its first order column over the width. The window
functions run per key and bucket, and what a bucket needs from those before it (a count, a running value, the last
row) comes from a table with one row per key and bucket, which is joined back by the same key. The plan is the same
whatever the data: rows are shuffled once, nothing is sampled beforehand, and nothing is broadcast by hand. Where rows are only
numbered, the totals are counts, which are added up before their shuffle; rows are sorted once.

The width decides how many rows of a key meet in one task, and how many buckets of a key are added up in one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

#: One day in microseconds.
DAY_US = 86_400_000_000


class Shifted(NamedTuple):
    """A running extreme of a value that moves with what came before the bucket.

    ``value`` is an expression over the running columns of the scan; in the whole order it is larger by
    ``factor`` times the running column's value before the bucket, for each of ``factors``. ``kind`` is ``max`` (up to
    and with the current row) or ``min_before`` (over the earlier rows).
    """

    kind: str
    value: Column
    factors: Mapping[str, int]


@dataclass(frozen=True)
class Ordered:
    """Rows with a total order within each key; ``_part`` is the key and the bucket, ``_part_hash`` a hash of them.

    The hash comes first where rows are sorted or joined by both: sorting compares whole numbers then, and the key and
    bucket only where those are equal.
    Between scans the key is in ``_part`` alone, so that rows and totals need the same columns of the input.
    """

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    columns: tuple[str, ...]

    def scan(
        self,
        *,
        number: str | None = None,
        lag: Mapping[str, str] | None = None,
        sums: Mapping[str, str] | None = None,
        lows: Mapping[str, str] | None = None,
        highs: Mapping[str, str] | None = None,
        shifted: Mapping[str, Shifted] | None = None,
    ) -> "Ordered":
        """Add columns computed over the rows up to the current one, in order, per key.

        ``number`` counts rows from 1, ``lag`` takes the previous row's value, ``sums``, ``lows``
        and ``highs`` run over all rows so far. Mappings go from new column to source column.
        """
        lag, sums, lows, highs, shifted = (dict(m or {}) for m in (lag, sums, lows, highs, shifted))
        added = ([number] if number else []) + list(sums)
        window = Window.partitionBy("_part_hash", "_part").orderBy(*self.order)
        so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        earlier = window.rowsBetween(Window.unboundedPreceding, -1)

        new = {"_first": F.row_number().over(window) == 1, "_last": F.lead(F.lit(1)).over(window).isNull()}
        if number:
            new[number] = F.row_number().over(window).cast("bigint")
        new |= {out: F.lag(src).over(window) for out, src in lag.items()}
        new |= {out: F.sum(src).over(so_far) for out, src in sums.items()}
        new |= {out: F.min(src).over(so_far) for out, src in lows.items()}
        new |= {out: F.max(src).over(so_far) for out, src in highs.items()}
        local = self.df.withColumns(new)
        local = local.withColumns({f"_v_{out}": s.value for out, s in shifted.items()})
        local = local.withColumns({
            out: F.max(f"_v_{out}").over(so_far) if s.kind == "max" else F.min(f"_v_{out}").over(earlier)
            for out, s in shifted.items()
        })

        # the last row of a bucket has its totals; then what the buckets before it add up to
        totals = [F.col(src).alias(f"_c_{out}") for out, src in lag.items()]
        totals += [F.col(out).alias(f"_c_{out}") for out in [*added, *lows, *highs]]
        for out, s in shifted.items():
            whole = F.col(out) if s.kind == "max" else F.least(out, f"_v_{out}")
            totals.append(whole.alias(f"_c_{out}"))
        of = F.col("_part_hash").alias("_of_hash"), F.col("_part").alias("_of")
        if number and not (lag or sums or lows or highs or shifted):
            buckets = self.df.groupBy(*of).agg(F.count(F.lit(1)).alias(f"_c_{number}"))
        else:
            buckets = local.where("_last").select(*of, *totals)
        by_bucket = Window.partitionBy(*[F.col(f"_of.k{i}") for i in range(len(self.keys))]).orderBy("_of.bucket")
        before = by_bucket.rowsBetween(Window.unboundedPreceding, -1)
        carried = {f"_c_{out}": F.sum(f"_c_{out}").over(before) for out in added}
        carried |= {f"_c_{out}": F.lag(f"_c_{out}").over(by_bucket) for out in lag}
        carried |= {f"_c_{out}": F.min(f"_c_{out}").over(before) for out in lows}
        carried |= {f"_c_{out}": F.max(f"_c_{out}").over(before) for out in highs}
        carry = buckets.withColumns(carried)
        for out, s in shifted.items():
            moved = F.col(f"_c_{out}") + self._shift(s)
            extreme = F.max if s.kind == "max" else F.min
            carry = carry.withColumn(f"_m_{out}", moved).withColumn(f"_m_{out}", extreme(f"_m_{out}").over(before))

        joined = local.join(carry, (local["_part_hash"] == carry["_of_hash"]) & (local["_part"] == carry["_of"]))
        merged = {}
        for out in added:
            merged[out] = F.when(
                F.col(out).isNotNull() | F.col(f"_c_{out}").isNotNull(),
                F.coalesce(out, F.lit(0)) + F.coalesce(f"_c_{out}", F.lit(0)),
            )
        for out in lag:
            merged[out] = F.when(F.col("_first"), F.col(f"_c_{out}")).otherwise(F.col(out))
        merged |= {out: F.least(out, f"_c_{out}") for out in lows}
        merged |= {out: F.greatest(out, f"_c_{out}") for out in highs}
        for out, s in shifted.items():
            pick = F.greatest if s.kind == "max" else F.least
            merged[out] = pick(F.col(out) + self._shift(s), f"_m_{out}")
        names = [*([number] if number else []), *lag, *sums, *lows, *highs, *shifted]
        return replace(self, df=joined.withColumns(merged).select(*self.df.columns, *names))

    @staticmethod
    def _shift(s: Shifted) -> Column:
        return sum((F.coalesce(f"_c_{name}", F.lit(0)) * factor for name, factor in s.factors.items()), F.lit(0))

    def with_columns(self, columns: Mapping[str, Column]) -> "Ordered":
        return replace(self, df=self.df.withColumns(dict(columns)))

    def result(self) -> DataFrame:
        """The rows with their own columns first, then what scans and ``with_columns`` added."""
        added = [c for c in self.df.columns if c not in self.columns and c not in ("_part_hash", "_part")]
        places = {k: f"_part.k{i}" for i, k in enumerate(self.keys)}
        return self.df.select(*[F.col(places[c]).alias(c) if c in places else F.col(c) for c in self.columns], *added)


def order_within(df: DataFrame, keys: Sequence[str], order: Sequence[str], width: int = DAY_US) -> Ordered:
    """Put ``df`` in order per key, ready for :meth:`Ordered.scan`.

    ``order`` must be total within a key (end it with a unique column); its first column is a whole number, and
    ``width`` is how much of it a bucket holds. Rows without it come first, in a bucket of their own. Building the
    plan starts no job.
    """
    keys, order = tuple(keys), tuple(order)
    # a struct compares null fields as equal, in windows and joins alike
    names = [F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]
    bucket = F.floor(F.col(order[0]) / F.lit(width)).cast("bigint").alias("bucket")
    rows = df.withColumn("_part", F.struct(*names, bucket)).withColumn("_part_hash", F.xxhash64("_part"))
    rows = rows.drop(*[k for k in keys if k not in order])
    return Ordered(rows, keys, order, tuple(df.columns))
