"""Content hashes and name-based ids."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def content_hash(*fields: ColumnOrName, length_prefixed: bool = False) -> Column:
    """MD5 of the fields joined with ``:``; a null field differs from every text.

    Joining with a plain delimiter lets ("a:b", "c") and ("a", "b:c") share a hash. With
    ``length_prefixed`` every field is preceded by its length, which rules that out.
    """
    parts = [F.coalesce(_col(f).cast("string"), F.lit("\u0000")) for f in fields]
    if length_prefixed:
        parts = [F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts]
    joined = [parts[0]]
    for part in parts[1:]:
        joined += [F.lit(":"), part]
    return F.md5(F.concat(*joined).cast("binary"))


def uuid5(name: ColumnOrName, namespace: uuid.UUID = uuid.NAMESPACE_DNS) -> Column:
    """Version 5 id of a string column, equal to Python's ``uuid.uuid5(namespace, name)``."""
    digest = F.sha1(F.concat(F.lit(bytearray(namespace.bytes)), _col(name).cast("binary")))
    # the two top bits of the 17th digit become the variant 10
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )
