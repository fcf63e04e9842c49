"""Registered queries over the driver's tables, and their SQL."""

from __future__ import annotations


def queries() -> dict:
    from caremill.plans import whole  # noqa: F401
    from caremill.plans.registered import QUERIES

    return {name: fn for name, (fn, _) in QUERIES.items()}


def oracle_sql() -> dict:
    from caremill.plans import whole  # noqa: F401
    from caremill.plans.registered import QUERIES

    return {name: sql for name, (_, sql) in QUERIES.items() if sql}
