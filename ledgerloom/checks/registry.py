"""Registry of (query, SQL) pairs."""

from __future__ import annotations

import importlib
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.sources.tables import Catalog

Tables = Mapping[str, DataFrame]

_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
_ORACLES: dict[str, str] = {}

AS_OF = "2001-11-05"

# Shorthands used in the SQL texts.
SQL_PARTS = {
    "as_of": f"DATE '{AS_OF}'",
    "amt": "CAST(l_extendedprice AS DECIMAL(18,2))",
    "money": "DECIMAL(19,2)",
    # Net amount of a line that carries a discount.
    "net": "CASE WHEN l_discount <> 0 THEN CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))"
    " ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END",
    # Amount grossed up by a percentage: see ratio_amount.
    "ratio_amt": "CAST(CASE WHEN l_tax <> 0 THEN round(l_extendedprice / round(l_tax * 100) * 100, 6) ELSE l_extendedprice END AS DECIMAL(28,6))",
}

MODULES = ("basics", "joins", "aggregates", "windows", "merging", "sales", "procurement", "receivables", "stock", "catalogue", "stores")


def query(name: str, sql: str | None = None):
    """Register a query under ``name`` with the SQL text of the same result."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"{name} registered twice")
        _QUERIES[name] = fn
        if sql is not None:
            for key, text in SQL_PARTS.items():
                sql_text = _ORACLES.get(name, sql)
                _ORACLES[name] = sql_text.replace("{" + key + "}", text)
        return fn

    return register


def _load() -> None:
    for module in MODULES:
        importlib.import_module(f"ledgerloom.checks.{module}")


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()

    def bind(fn):
        return lambda spark, sf_dir: fn(Catalog(spark, root=sf_dir))

    return {name: bind(fn) for name, fn in _QUERIES.items()}


def all_oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
