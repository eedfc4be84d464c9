"""DuckDB oracle: for each registered query, SQL over the driver tables.

The stand-in views are CTEs (``views.with_views``); double columns are rounded
to 6 decimals like ``marketlens.plans.catalog.finalize`` does on the Spark side.
"""

from __future__ import annotations

from oracle import basics, customers, fulfilment, generic, inventory, marketing, price_models, pricing, reviews, sales, sentiment, supply
from oracle.views import with_views

ORACLE_MODULES = [sales, customers, marketing, reviews, supply, inventory, pricing, price_models, fulfilment, generic, basics, sentiment]


def _wrap(sql: str, doubles: list[str]) -> str:
    body = with_views(sql)
    if not doubles:
        return body
    repl = ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({repl}) FROM (\n{body}\n) AS oracle_q"


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for m in ORACLE_MODULES:
        for name, (sql, doubles) in m.SQL.items():
            out[name] = _wrap(sql, doubles)
    return out
