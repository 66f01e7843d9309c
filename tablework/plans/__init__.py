"""Registered queries, one module per operator family, each beside its oracle SQL."""

from tablework.plans import (  # noqa: F401 - importing a module registers its queries
    flagship,
    scans,
    bad_records,
    writes,
    projections,
    filters,
    joins,
    time_joins,
    aggregates,
    relational,
    row_sets,
    texts,
    calendar_dates,
    cell_values,
    reshapes,
    version_tables,
    commits,
    streams,
    event_streams,
)
from tablework.plans.registry import REGISTERED

__all__ = ["REGISTERED"]
