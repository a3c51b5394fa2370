"""Scalar helpers: ids, text, timestamps, maps, JSON and typed parameters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from millrace.functions.hashing import ColumnOrName, _col

ROOT_ID_LENGTH = 36


def prefix(value: ColumnOrName, length: int = ROOT_ID_LENGTH) -> Column:
    return F.substring(_col(value), 1, length)


def root_id(run_id: ColumnOrName) -> Column:
    """Id of the root run: children append ``-<n>`` to their parent's id."""
    return prefix(run_id, ROOT_ID_LENGTH)


def run_depth(run_id: ColumnOrName) -> Column:
    """Levels below the root run."""
    tail = F.substring(_col(run_id), ROOT_ID_LENGTH + 1, 1 << 20)
    return F.length(tail) - F.length(F.replace(tail, F.lit("-"), F.lit("")))


def format_id(label: str, number: ColumnOrName, width: int = 3) -> Column:
    """``label-007``; numbers wider than ``width`` keep all their digits."""
    n = _col(number).cast("bigint")
    text = n.cast("string")
    padded = F.when((n >= 0) & (F.length(text) < width), F.lpad(text, width, "0"))
    # a sign goes before the zeros
    signed = F.when(n < 0, F.format_string(f"%0{width}d", n)).otherwise(text)
    return F.concat(F.lit(f"{label}-"), F.coalesce(padded, signed))


def array_pick(choices: Sequence[str], index: ColumnOrName) -> Column:
    """Element at ``index`` modulo the number of choices."""
    picked = F.pmod(_col(index), F.lit(len(choices))).cast("int") + 1
    return F.element_at(F.array(*[F.lit(c) for c in choices]), picked)


def empty_to_null(value: ColumnOrName) -> Column:
    return F.nullif(_col(value), F.lit(""))


def iso_format(ts: ColumnOrName) -> Column:
    """Python's ``isoformat``: microseconds are printed only when there are any."""
    c = _col(ts)
    return F.when(
        F.date_format(c, "SSSSSS") == "000000", F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    ).otherwise(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def iso_parse(text: ColumnOrName) -> Column:
    """Timestamp of an ISO-8601 text; null for empty or malformed text."""
    return empty_to_null(text).try_cast("timestamp_ntz")


def epoch_micros(ts: ColumnOrName) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, read as UTC by the session zone."""
    return F.unix_micros(_col(ts).cast("timestamp"))


def from_epoch_micros(micros: ColumnOrName) -> Column:
    return F.timestamp_micros(_col(micros)).cast("timestamp_ntz")


def progress_pct(done: ColumnOrName, total: ColumnOrName) -> Column:
    """Whole percent done, cut off; null when there is nothing to do.

    The share is taken first and then scaled, in floating point: 29 of 100 is 28 percent.
    """
    return F.floor(F.try_divide(_col(done), _col(total)) * 100).cast("int")


def map_upper(m: ColumnOrName) -> Column:
    return F.transform_values(_col(m), lambda _, v: F.upper(v))


def map_merge(left: ColumnOrName, right: ColumnOrName) -> Column:
    """Union of two maps; the right one wins on shared keys."""
    lhs, rhs = _col(left), _col(right)
    only_left = F.map_filter(lhs, lambda k, _: ~F.map_contains_key(rhs, k))
    return F.map_concat(only_left, rhs)


def byte_length(payload: ColumnOrName) -> Column:
    return F.octet_length(_col(payload))


def byte_concat(*payloads: ColumnOrName) -> Column:
    return F.concat(*[_col(p).cast("binary") for p in payloads])


# Fixed patterns: what Python's int() and float() accept.
_INTEGER = r"^[+-]?\d+(_\d+)*$"
_FLOAT = (
    r"^[+-]?((\d+(_\d+)*)(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?$"
    r"|^[+-]?([iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])$"
)

_BLANKS = " \t\n\r\x0b\x0c"


def parameter_key(text: ColumnOrName) -> Column:
    """Text before the first ``=``, trimmed; null when there is none."""
    c = _col(text)
    at = F.instr(c, "=")
    return F.when(at > 0, F.btrim(F.substring(c, F.lit(1), at - 1), F.lit(_BLANKS)))


def parameter_value(text: ColumnOrName) -> Column:
    """Text after the first ``=``, trimmed; null when there is none."""
    c = _col(text)
    at = F.instr(c, "=")
    return F.when(at > 0, F.btrim(F.substring(c, at + 1, F.length(c)), F.lit(_BLANKS)))


def parameter_type(value: ColumnOrName) -> Column:
    """First type that fits: boolean, json, integer, float, uuid, string; ``invalid`` for null."""
    v = _col(value)
    digits = F.replace(v, F.lit("-"), F.lit(""))
    bracketed = (v.startswith("{") & v.endswith("}")) | (v.startswith("[") & v.endswith("]"))
    is_uuid = (
        (F.length(v) == 36) & (F.length(digits) == 32) & digits.rlike("^[0-9a-fA-F]{32}$")
    )
    return (
        F.when(v.isNull(), "invalid")
        .when(F.lower(v).isin("true", "false"), "boolean")
        .when(bracketed & F.try_parse_json(v).isNotNull(), "json")
        .when(v.rlike(_INTEGER), "integer")
        .when(v.rlike(_FLOAT), "float")
        .when(is_uuid, "uuid")
        .otherwise("string")
    )
