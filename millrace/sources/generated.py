"""Rows made from counters and lists: test users, integrations, request grids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.hashing import ColumnOrName, _col, uuid5
from millrace.functions.values import array_pick, format_id

# fixed values: how often the generated ids, names and emails repeat
ID_PERIOD, NAME_PERIOD, EMAIL_PERIOD = 1500, 1200, 1300
# fixed values: providers, data types and the call limits of their queues (calls, seconds)
INTEGRATION_PROVIDERS = ("google", "azure", "okta")
PROVIDERS = ("aws", "azure", "gcp")
DATA_TYPES = ("users", "groups", "permissions")
ROUTES = {
    "users": ("queue_users", 2, 1),
    "groups": ("queue_groups", 2, 5),
    "permissions": ("queue_permissions", 3, 10),
}


def synthetic_users(
    counters: DataFrame, counter: str, organization_id: Column, connected_integration_id: Column
) -> DataFrame:
    """A user per counter value; ids, names and emails repeat with periods of their own.

    A repeated id comes back with another name and email, so later extracts hold real updates.
    The id is the stable id of the external id; no state is kept between rows.
    """
    n = F.col(counter)
    external_id = uuid5(F.concat(F.lit("external-"), F.pmod(n, F.lit(ID_PERIOD)).cast("string")))
    name_no = F.pmod(n, F.lit(NAME_PERIOD)).cast("string")
    email_no = F.pmod(n, F.lit(EMAIL_PERIOD)).cast("string")
    users = counters.select(
        external_id.alias("external_id"),
        organization_id.alias("organization_id"),
        connected_integration_id.alias("connected_integration_id"),
        F.concat(F.lit("User "), name_no).alias("name"),
        F.concat(F.lit("user"), email_no, F.lit("@example.org")).alias("email"),
    )
    return users.select(uuid5("external_id").alias("id"), "*")


def seed_integrations(
    organizations: DataFrame, number: ColumnOrName, per_organization: int = 2
) -> DataFrame:
    """``per_organization`` integrations for each numbered organization."""
    i, j = _col(number), F.col("_j")
    rows = organizations.withColumn("_j", F.explode(F.sequence(F.lit(1), F.lit(per_organization))))
    org, provider = format_id("org", i), array_pick(INTEGRATION_PROVIDERS, i + j)
    data = F.to_json(
        F.struct(
            F.concat(provider, F.lit("_source_"), j.cast("string")).alias("permission_source_name"),
            F.concat(F.lit("https://api."), provider, F.lit(".com/v1")).alias("api_endpoint"),
            F.lit(None).cast("string").alias("last_sync"),
        ),
        {"ignoreNullFields": "false"},
    )
    return rows.select(
        uuid5(F.concat_ws(":", org, provider, j.cast("string"))).alias("id"),
        org.alias("organization_id"),
        provider.alias("provider"),
        data.alias("provider_data"),
    )


def seed_if_empty(existing: DataFrame, seeds: DataFrame) -> DataFrame:
    """The existing rows, or the seeds when there are none."""
    return seeds if existing.isEmpty() else existing


def request_grid(
    df: DataFrame, requests: int | str, providers: Sequence[str] = PROVIDERS,
    data_types: Sequence[str] = DATA_TYPES,
) -> DataFrame:
    """``requests`` numbered requests per row for every provider and data type.

    ``requests`` is a number or a column. The lists are expanded within each row, no join is needed.
    """
    count = F.col(requests).cast("int") if isinstance(requests, str) else F.lit(requests)
    numbers = F.when(count > 0, F.sequence(F.lit(1), count))
    return (
        df.withColumn("provider", F.explode(F.array(*[F.lit(p) for p in providers])))
        .withColumn("data_type", F.explode(F.array(*[F.lit(d) for d in data_types])))
        .withColumn("request_num", F.explode(numbers))
    )
