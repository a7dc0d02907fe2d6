"""Test tables in the types the jobs expect (exact decimals for money and quantities)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.checks.registry import Tables

# Order that makes line order total: the line key itself repeats in the test data.
LINE_TIES = ("l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey", "l_suppkey")


def dec(c: str, precision: int = 18, scale: int = 2) -> Column:
    return F.col(c).cast(f"decimal({precision},{scale})")


def big(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def money(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(19,2)")


def rounded(c: Column | str, digits: int = 4) -> Column:
    return F.round((F.col(c) if isinstance(c, str) else c).cast("double"), digits)


def lines(t: Tables) -> DataFrame:
    """Document lines: exact amount, quantity, discount, and tax percentage."""
    return t["lineitem"].withColumns(
        {
            "amt": dec("l_extendedprice"),
            "qty": dec("l_quantity"),
            "disc": dec("l_discount", 4),
            "tax": dec("l_tax", 4),
            "ratio": F.round(F.col("l_tax") * 100).cast("decimal(19,6)"),
        }
    )


def net_amount() -> Column:
    return F.when(F.col("l_discount") != 0, F.col("amt") * (1 - F.col("disc"))).otherwise(F.col("amt"))


def purchases(t: Tables) -> DataFrame:
    return t["events"].where(F.col("event_type") == "purchase")


def event_day() -> Column:
    return F.date_format("ts", "yyyy-MM-dd")
