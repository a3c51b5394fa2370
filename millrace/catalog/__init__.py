"""Registered queries over the test tables, each with its SQL where SQL can say it."""

from millrace.catalog import records, sources, streams, timing, values
from millrace.catalog.base import Query

QUERIES: dict[str, Query] = {
    **records.QUERIES, **timing.QUERIES, **values.QUERIES, **sources.QUERIES, **streams.QUERIES,
}
