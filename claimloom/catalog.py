"""Registry of the claim-evidence queries and their DuckDB oracles."""

from __future__ import annotations

from claimloom.plans import claim_queries, driver_queries, record_queries  # noqa: F401  (each registers its queries)


def queries() -> dict:
    return dict(driver_queries.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(driver_queries.ORACLES)
