"""Joins on several columns in which null equals null."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType


def record_key(keys: Sequence[str]) -> Column:
    """All key columns as one value; structs compare null fields as equal, in windows and joins alike."""
    return F.struct(*[F.col(k).alias(k) for k in keys])


#: What stands for null in a column of a key; the key's bits tell it from the value itself.
_INSTEAD = {"string": "", "binary": bytearray(), "boolean": False, "date": "1970-01-01", "timestamp": "1970-01-01", "timestamp_ntz": "1970-01-01"}


class PlainKey:
    """A record key as columns without nulls, and a bit for each that was null.

    Windows and joins by these columns hash and compare plain values, null equals null, and rows that a window has
    brought together need no other shuffle for the join. Columns of other kinds than Spark's plain ones go as structs.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str]):
        self.keys = list(keys)
        self.names = [f"_k{i}" for i in range(len(self.keys))] + ["_nulls"]
        self.kinds = [df.schema[k].dataType for k in self.keys]

    def _instead(self, i: int) -> Column | None:
        kind = self.kinds[i].simpleString()
        if kind in _INSTEAD:
            return F.lit(_INSTEAD[kind]).cast(kind)
        return F.lit(0).cast(kind) if isinstance(self.kinds[i], NumericType) else None

    def columns(self) -> list[Column]:
        """The key's columns, from the frame's."""
        plain, bits = [], F.lit(0)
        for i, k in enumerate(self.keys):
            instead = self._instead(i)
            plain.append((F.struct(F.col(k)) if instead is None else F.coalesce(F.col(k), instead)).alias(f"_k{i}"))
            if instead is not None:
                bits = bits + F.when(F.col(k).isNull(), F.lit(1 << i)).otherwise(0)
        return [*plain, bits.alias("_nulls")]

    def back(self, pick: Callable[[str], Column]) -> list[Column]:
        """The columns of the record again; ``pick`` gives a column of the key by its name."""
        out = []
        for i, k in enumerate(self.keys):
            value = pick(f"_k{i}")
            value = value[k] if self._instead(i) is None else F.when(pick("_nulls").bitwiseAND(1 << i) == 0, value)
            out.append(value.alias(k))
        return out


def _matching(df: DataFrame, other: DataFrame, names: Sequence[str], how: str) -> DataFrame:
    marked = other.select(*[F.col(n).alias(f"_o_{n}") for n in names])
    same = reduce(Column.__and__, [df[n].eqNullSafe(marked[f"_o_{n}"]) for n in names])
    return df.join(marked, same, how)


def without(df: DataFrame, other: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows of ``df`` that ``other`` does not hold; null equals null."""
    return _matching(df, other, names, "left_anti")


def within(df: DataFrame, scope: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows whose ``names`` occur in ``scope``; null equals null. Spark chooses the join by the scope's size."""
    return _matching(df, scope, names, "left_semi")
