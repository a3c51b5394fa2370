"""Change capture between a staged extract and the latest snapshot."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.hashing import content_hash
from millrace.operators.dedup import dedup_latest
from millrace.operators.joins import PlainKey, within, without
from millrace.schemas import TENANT, USER_KEYS

INSERT, UPDATE, DELETE = "INSERT", "UPDATE", "DELETE"


def _payload(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in keys]


def _compared(
    staging: DataFrame, latest: DataFrame, newest: Sequence[str], keys: Sequence[str],
    tenants: DataFrame | None, all_tenants: bool, hash_col: str, buckets: int | None = None, hash_of: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame | None]:
    """Both sides of every key in one row (``_old_*``, ``_new_*``, ``_kind``), and the tenants it covers.

    Both sides meet in one full outer join on the columns of the record key, which is unique on either side and in
    which null equals null. The deduplication already distributes staging by them, so each side is shuffled once.
    """
    key = PlainKey(latest, keys)
    stored = bool(buckets)
    left_out = ([*key.names] if stored else []) + ([hash_col] if hash_of else [])
    payload = [c for c in _payload(latest, keys) if c not in left_out]
    names = [c for c in (tenants.columns if tenants is not None else TENANT) if c in keys]
    scope = None
    if names and not all_tenants:
        scope = (staging if tenants is None else tenants).select(*names).distinct()
        latest = within(latest, scope, names)
        if tenants is not None:
            staging = within(staging, scope, names)
    staging = staging.select(*key.columns(), *[c for c in staging.columns if c not in keys and not (hash_of and c == hash_col)])
    if stored:
        staging = staging.repartition(buckets, *key.names)
    new = _side(dedup_latest(staging, key.names, newest), key, payload, "_new", plain=True)
    old = _side(latest, key, payload, "_old", plain=stored)
    new_hash, old_hash = (_hash(side, hash_col, hash_of) for side in ("_new", "_old"))
    kind = (
        F.when(F.col("_old").isNull(), INSERT)
        .when(F.col("_new").isNull(), DELETE)
        .when(~new_hash.eqNullSafe(old_hash), UPDATE)
    )
    return new.join(old, _same(key), "full_outer").withColumn("_kind", kind), scope


def _side(df: DataFrame, key: PlainKey, payload: Sequence[str], side: str, *more: Column, plain: bool = False) -> DataFrame:
    """One side of a comparison: its key and payload under the side's name, and a mark that it is there."""
    named = [F.col(n) for n in key.names] if plain else key.columns()
    return df.select(*[c.alias(side + n) for c, n in zip(named, key.names)], F.lit(True).alias(side),
                     *[F.col(c).alias(f"{side}_{c}") for c in payload], *more)


def _same(key: PlainKey) -> Column:
    return reduce(Column.__and__, [F.col("_new" + n) == F.col("_old" + n) for n in key.names])


def _hash(side: str, hash_col: str, hash_of: Sequence[str]) -> Column:
    return content_hash(*[F.col(f"{side}_{c}") for c in hash_of]) if hash_of else F.col(f"{side}_{hash_col}")


def _sided(key: PlainKey, payload: Sequence[str], use_new: Column, hash_col: str = "", hash_of: Sequence[str] = ()) -> list[Column]:
    def picked(c: str) -> Column:
        return F.when(use_new, F.col(f"_new_{c}")).otherwise(F.col(f"_old_{c}"))

    return key.back(lambda n: F.coalesce(F.col("_new" + n), F.col("_old" + n))) + [
        (content_hash(*map(picked, hash_of)) if hash_of and c == hash_col else picked(c)).alias(c) for c in payload
    ]


def detect_changes(
    staging: DataFrame,
    latest: DataFrame,
    *,
    newest: Sequence[str],
    keys: Sequence[str] = USER_KEYS,
    tenants: DataFrame | None = None,
    all_tenants: bool = False,
    hash_col: str = "content_hash",
    buckets: int | None = None,
    hash_of: Sequence[str] = (),
) -> DataFrame:
    """Changes that turn ``latest`` into ``staging``: keys, the columns of latest, change_type.

    ``staging`` holds the rows of one run, duplicates included; ``newest`` orders the copies.
    A key missing from staging is a DELETE and keeps latest's values; all other changes carry
    staging's. ``tenants`` names the tenants the run extracted, also those that came back empty. Without it
    they are the tenants that have staged rows. Rows of other tenants are left alone, unless ``all_tenants`` says
    that the run covers every tenant.

    With ``buckets``, ``latest`` is a snapshot stored in that many (:func:`millrace.sinks.bucketed.store_snapshot`); then
    only the staged side is shuffled, once. With ``hash_of``, the hash of both sides is known to be the content hash of
    those columns: it is taken where the sides have met instead of being shuffled with them.
    """
    both, _ = _compared(staging, latest, newest, keys, tenants, all_tenants, hash_col, buckets, hash_of)
    key = PlainKey(latest, keys)
    payload = [c for c in _payload(latest, keys) if not buckets or c not in key.names]
    return both.where(F.col("_kind").isNotNull()).select(
        *_sided(key, payload, F.col("_new").isNotNull(), hash_col, hash_of), F.col("_kind").alias("change_type")
    )


def next_snapshot(
    staging: DataFrame,
    latest: DataFrame,
    *,
    newest: Sequence[str],
    keys: Sequence[str] = USER_KEYS,
    tenants: DataFrame | None = None,
    all_tenants: bool = False,
    hash_col: str = "content_hash",
) -> DataFrame:
    """The snapshot after the run, from the same join that finds the changes.

    Unchanged rows keep latest's values; the arguments are those of :func:`detect_changes`.
    """
    both, scope = _compared(staging, latest, newest, keys, tenants, all_tenants, hash_col)
    changed = F.col("_kind").isNotNull()
    after = both.where(F.col("_new").isNotNull()).select(*_sided(PlainKey(latest, keys), _payload(latest, keys), changed))
    return after if scope is None else after.unionByName(without(latest, scope, scope.columns))


def change_counts(changes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Inserts, updates, deletes and total per group, in one aggregation."""
    kind = F.col("change_type")
    return changes.groupBy(*by).agg(
        F.count_if(kind == INSERT).alias("inserts"),
        F.count_if(kind == UPDATE).alias("updates"),
        F.count_if(kind == DELETE).alias("deletes"),
        F.count(F.lit(1)).alias("total_changes"),
    )


def apply_changes(
    latest: DataFrame,
    changes: DataFrame,
    *,
    keys: Sequence[str] = USER_KEYS,
    newest: Sequence[str] | None = None,
    hash_col: str = "content_hash",
    hash_of: Sequence[str] = (),
) -> DataFrame:
    """The snapshot after the changes; repeating it changes nothing.

    With changes of several runs, ``newest`` orders them and the newest change per key counts: they are brought together
    by the columns the join needs. ``hash_of`` is that of :func:`detect_changes`.
    """
    key, payload = PlainKey(latest, keys), _payload(latest, keys)
    carried = [c for c in payload if not (hash_of and c == hash_col)]
    if newest:
        rest = [c for c in changes.columns if c not in keys and not (hash_of and c == hash_col)]
        changes = dedup_latest(changes.select(*key.columns(), *rest), key.names, newest)
    delta = _side(changes, key, carried, "_new", F.col("change_type").alias("_kind"), plain=bool(newest))
    merged = _side(latest, key, carried, "_old").join(delta, _same(key), "full_outer")
    kept = merged.where(F.col("_kind").isNull() | (F.col("_kind") != DELETE))
    return kept.select(*_sided(key, payload, F.col("_kind").isNotNull(), hash_col, hash_of))


def read_changes(
    cdc: DataFrame, *, keys: Sequence[str] = USER_KEYS, order: Sequence[str] = ("detected_at",), **equal
) -> DataFrame:
    """Changes of one run and tenant, in the order they were detected."""
    matching = [F.col(name) == value for name, value in equal.items()]
    return cdc.where(reduce(Column.__and__, matching, F.lit(True))).orderBy(*order, *keys)


def reconcile(
    before: DataFrame, changes: DataFrame, after: DataFrame, by: Sequence[str] = TENANT,
    staged: DataFrame | None = None,
) -> DataFrame:
    """Per tenant: count before, inserts, deletes, expected and actual count after, and ``ok``.

    Each input is counted on its own; only the counts, one row per tenant, are brought together. With ``staged``,
    the unique staged rows, ``staged_count`` has to equal the count after as well: changes that were lost
    cannot agree with themselves.
    """
    names = ("before_count", "inserts", "deletes", "after_count") + (("staged_count",) if staged is not None else ())

    def counted(df: DataFrame, **counts: Column) -> DataFrame:
        grouped = df.groupBy(*by).agg(*[c.alias(n) for n, c in counts.items()])
        missing = [F.lit(0).cast("bigint").alias(n) for n in names if n not in counts]
        return grouped.select(*by, *counts, *missing)

    kind = F.col("change_type")
    parts = [
        counted(before, before_count=F.count(F.lit(1))),
        counted(changes, inserts=F.count_if(kind == INSERT), deletes=F.count_if(kind == DELETE)),
        counted(after, after_count=F.count(F.lit(1))),
    ]
    if staged is not None:
        parts.append(counted(staged, staged_count=F.count(F.lit(1))))
    totals = reduce(DataFrame.unionByName, parts).groupBy(*by).agg(
        *[F.sum(n).alias(n) for n in names]
    )
    expected = F.col("before_count") + F.col("inserts") - F.col("deletes")
    ok = expected == F.col("after_count")
    if staged is not None:
        ok = ok & (F.col("staged_count") == F.col("after_count"))
    return totals.select("*", expected.alias("expected_count"), ok.alias("ok"))


def key_set_diff(staging: DataFrame, latest: DataFrame, keys: Sequence[str] = USER_KEYS) -> DataFrame:
    """Every key with the side it is on: ``staging``, ``latest`` or ``both``."""
    tagged = staging.select(*keys, F.lit(1).alias("_side")).unionByName(
        latest.select(*keys, F.lit(2).alias("_side"))
    )
    sides = tagged.groupBy(*keys).agg(F.bit_or("_side").alias("_sides"))
    side = F.when(F.col("_sides") == 1, "staging").when(F.col("_sides") == 2, "latest")
    return sides.select(*keys, side.otherwise("both").alias("side"))


def excess_deletes(
    changes: DataFrame, latest: DataFrame, max_fraction: float, by: Sequence[str] = TENANT
) -> DataFrame:
    """Tenants whose deletes exceed the fraction of their rows: a sign of a partial extract."""
    deletes = changes.where(F.col("change_type") == DELETE).groupBy(*by).agg(
        F.count(F.lit(1)).alias("deletes")
    )
    rows = latest.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))
    both = deletes.unionByName(rows, allowMissingColumns=True).groupBy(*by).agg(
        F.coalesce(F.sum("deletes"), F.lit(0)).alias("deletes"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")
    )
    return both.where(F.col("deletes") > F.col("rows") * max_fraction)
