"""The named queries over the driver tables, each with its SQL twin where SQL can express it."""

from __future__ import annotations

from sluice.plans import acquisition, curation, extensions, planning, scalars, sequences, stages  # noqa: F401  they register their queries
from sluice.plans.registry import QUERIES, SQL, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
