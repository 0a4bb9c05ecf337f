"""Named queries over the shared test tables, each with an SQL statement of the same result.

The tables stand in for personal data: line items of parts are strength sets, events are
measurements, workouts and diary entries of many users, orders a daily total, documents
diary notes.  Doubles are rounded, as the two engines add in different orders.
"""

from daybook.catalog import basics, goals, series, tables, texts, views  # noqa: F401
from daybook.catalog.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
