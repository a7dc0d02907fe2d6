"""Upserts, slices, residual quantities, tags."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.checks.registry import Tables, query
from ledgerloom.checks.roles import dec, lines, money
from ledgerloom.functions.scalars import day_text, month_text
from ledgerloom.operators.lineage import residual_reversed, residual_union, trace_source
from ledgerloom.operators.merge import upsert
from ledgerloom.plans.upkeep import keep_other_slices, merged_deltas, parse_specs, previous_month

# The stored table ends in June 2000; the delta re-reports 2000 and adds what came later.
BASE = "o_orderdate < TIMESTAMP '2000-07-01'"
DELTA = "o_orderdate >= TIMESTAMP '2000-01-01'"


def _base_and_delta(t: Tables) -> tuple[DataFrame, DataFrame]:
    cols = t["orders"].select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    base = cols.where(F.col("o_orderdate") < "2000-07-01").drop("o_orderdate")
    delta = cols.where(F.col("o_orderdate") >= "2000-01-01").drop("o_orderdate").withColumn("o_orderstatus", F.lit("X"))
    return base, delta


@query(
    "upsert_delta",
    f"""SELECT o_orderkey, o_custkey, CASE WHEN {DELTA} THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE {BASE} OR {DELTA}""",
)
def upsert_delta(t: Tables) -> DataFrame:
    base, delta = _base_and_delta(t)
    ((_, merged),) = merged_deltas({"orders": base}, {"orders": delta}, parse_specs("orders--o_orderkey--o_orderstatus"))
    return merged


@query(
    "update_only_delta",
    f"""SELECT o_orderkey, o_custkey, CASE WHEN {DELTA} THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE {BASE}""",
)
def update_only_delta(t: Tables) -> DataFrame:
    return upsert(*_base_and_delta(t), ["o_orderkey"], insert_new=False)


@query(
    "replace_month_slice",
    """SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderkey, CASE WHEN strftime(o_orderdate, '%Y-%m') = '2001-07' THEN 'recomputed' ELSE o_orderstatus END AS status
       FROM orders""",
)
def replace_month_slice(t: Tables) -> DataFrame:
    stored = t["orders"].select(month_text("o_orderdate").alias("month"), "o_orderkey", F.col("o_orderstatus").alias("status"))
    month = previous_month("2001-08-01")
    fresh = stored.where(F.col("month") == month).withColumn("status", F.lit("recomputed"))
    return keep_other_slices(stored, fresh, "month", [month])


@query(
    "residual_rows",
    """WITH taken AS (SELECT l_orderkey AS k, sum({amt}) AS taken FROM lineitem GROUP BY 1)
       SELECT o_orderkey, l_partkey, l_suppkey, CAST({amt} AS {money}) AS amount FROM orders JOIN lineitem ON o_orderkey = l_orderkey
       UNION ALL SELECT o_orderkey, NULL, NULL, CAST(CAST(o_totalprice AS DECIMAL(18,2)) - coalesce(taken, 0) AS {money}) FROM orders
       LEFT JOIN taken ON k = o_orderkey WHERE taken IS NULL OR CAST(o_totalprice AS DECIMAL(18,2)) - taken > 0""",
)
def residual_rows(t: Tables) -> DataFrame:
    parent = t["orders"].select("o_orderkey", dec("o_totalprice").alias("total"))
    child = lines(t).select("l_orderkey", "l_partkey", "l_suppkey", "amt")
    rows = residual_union(parent, child, {"o_orderkey": "l_orderkey"}, "total", "amt", "amount")
    return rows.select("o_orderkey", "l_partkey", "l_suppkey", money("amount").alias("amount"))


@query(
    "residual_reversed",
    """SELECT o_orderkey, CAST(l.q - sum(o.qty) AS {money}) AS over FROM (SELECT o_orderkey, CAST(20 AS DECIMAL(18,2)) AS qty FROM orders) o
       JOIN (SELECT l_orderkey, CAST(l_quantity AS DECIMAL(18,2)) AS q FROM lineitem) l ON o_orderkey = l_orderkey
       GROUP BY o_orderkey, l.q HAVING l.q - sum(o.qty) > 0""",
)
def residual_reversed_query(t: Tables) -> DataFrame:
    parent = t["orders"].select("o_orderkey", F.lit(20).cast("decimal(18,2)").alias("ordered"))
    child = lines(t).select("l_orderkey", "qty")
    over = residual_reversed(parent, child, {"o_orderkey": "l_orderkey"}, "ordered", "qty", "over")
    return over.select("o_orderkey", money("over").alias("over"))


@query(
    "trace_source",
    """SELECT l_orderkey, l_partkey, l_suppkey, {amt} AS amt, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS ordered, c_name
       FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey WHERE l_returnflag = 'R'""",
)
def trace_source_query(t: Tables) -> DataFrame:
    returned = lines(t).where("l_returnflag = 'R'").select("l_orderkey", "l_partkey", "l_suppkey", "amt")
    order = trace_source(returned, t["orders"], {"l_orderkey": "o_orderkey"}, {"o_custkey": "o_custkey", "od": "o_orderdate"})
    named = trace_source(order, t["customer"], {"o_custkey": "c_custkey"}, {"c_name": "c_name"})
    return named.select("l_orderkey", "l_partkey", "l_suppkey", "amt", "o_custkey", day_text("od").alias("ordered"), "c_name")
