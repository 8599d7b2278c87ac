"""Registered queries: name -> (Spark builder, DuckDB oracle SQL).

Every builder takes a ``Ledger`` (tables derived from the driver data by
Spark) and returns a lazy DataFrame over the whole tables.  The oracle SQL is
the same query in DuckDB's dialect over the same derivations; column names
match the Spark output one for one.  Parameters stand in for the literals of
the original statements and are the same for every data size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.fixtures import Ledger
from .oracle_fixtures import with_tables

# Parameters replacing the literals of the original statements.
PARAMS = dict(
    year=1996, start="1996-01-01", end="1996-12-31", as_of="1998-06-01",
    since="1995-01-01", threshold=11, account="customer_000000001",
    bill_account="customer_000001397", projected_account="centerpoint_owner",
    receipt_guid="guid-39", token_as_of="2024-01-15 00:00:00",
    range_a="1996-08-31", range_b="1996-08-01",   # reversed on purpose (symmetric)
)

Builder = Callable[[Ledger], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, None if sql is None else with_tables(sql))
        return fn
    return deco


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return {name: (lambda spark, sf_dir, _fn=fn: _fn(Ledger.of(spark, sf_dir)))
            for name, (fn, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {name: sql for name, (_, sql) in REGISTRY.items() if sql is not None}


def _load_all() -> None:
    # importing the modules registers their queries
    from . import q_cascade, q_checks, q_io, q_mutations, q_operators, q_reports  # noqa: F401
