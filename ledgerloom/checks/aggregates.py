"""Aggregation shapes and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.checks.joins import SCOPE, SCOPE_SQL
from ledgerloom.checks.registry import Tables, query
from ledgerloom.checks.roles import big, dec, lines, money, net_amount, rounded
from ledgerloom.functions import codes
from ledgerloom.functions.scalars import month_text, safe_div
from ledgerloom.operators.aggregates import collect_names, money_sum, preagg_join, ratio_sum, tagged_pivot
from ledgerloom.operators.joins import Dim, header_join, star_join
from ledgerloom.plans.receivables import in_scope, project_totals


@query(
    "project_receivable",
    f"""SELECT n_name AS project, r_name AS customer, strftime(min(o_orderdate), '%Y-%m-%d') AS first_day, CAST(sum({{net}}) AS {{money}}) AS amount
        FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey LEFT JOIN customer ON o_custkey = c_custkey
        LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
        WHERE {SCOPE_SQL} GROUP BY n_name, r_name""",
)
def project_receivable(t: Tables) -> DataFrame:
    header = star_join(
        t["orders"].select("o_orderkey", "o_orderstatus", "o_custkey", "o_orderdate"),
        [
            Dim(t["customer"], {"o_custkey": "c_custkey"}, {"nk": "c_nationkey"}),
            Dim(t["nation"], {"nk": "n_nationkey"}, {"project": "n_name", "rk": "n_regionkey"}),
            Dim(t["region"], {"rk": "r_regionkey"}, {"customer": "r_name"}),
        ],
    )
    header = header.where(in_scope(SCOPE, "o_orderstatus", "customer", "project"))
    body = lines(t).select("l_orderkey", net_amount().alias("net"))
    joined = header_join(header, body.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey")
    return project_totals(joined, ["project", "customer"], "o_orderdate", money_sum("net"))


@query(
    "ratio_adjusted_sum",
    """SELECT l_suppkey, l_returnflag, CAST(sum({ratio_amt}) AS {money}) AS amount FROM lineitem GROUP BY 1, 2""",
)
def ratio_adjusted_sum(t: Tables) -> DataFrame:
    return lines(t).groupBy("l_suppkey", "l_returnflag").agg(ratio_sum("amt", "ratio").alias("amount"))


@query(
    "group_by_expr",
    """SELECT CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN c_mktsegment ELSE '其他' END AS segment,
       strftime(o_orderdate, '%Y-%m') AS month, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS {money}) AS amount
       FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
)
def group_by_expr(t: Tables) -> DataFrame:
    joined = star_join(t["orders"], [Dim(t["customer"], {"o_custkey": "c_custkey"}, {"seg": "c_mktsegment"})])
    segment = F.when(F.col("seg").isin("MACHINERY", "BUILDING"), F.col("seg")).otherwise(codes.OTHER)
    return joined.groupBy(segment.alias("segment"), month_text("o_orderdate").alias("month")).agg(
        big(F.count(F.lit(1))).alias("orders"), money(F.sum(dec("o_totalprice"))).alias("amount")
    )


@query(
    "conditional_count",
    """SELECT l_orderkey, count(CASE WHEN l_returnflag <> 'R' THEN 1 END) AS kept, count(*) AS lines FROM lineitem GROUP BY 1""",
)
def conditional_count(t: Tables) -> DataFrame:
    return t["lineitem"].groupBy("l_orderkey").agg(
        big(F.count_if(F.col("l_returnflag") != "R")).alias("kept"), big(F.count(F.lit(1))).alias("lines")
    )


@query(
    "having_residual",
    """SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) - sum({amt}) AS {money}) AS rest FROM orders
       LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_totalprice
       HAVING CAST(o_totalprice AS DECIMAL(18,2)) - sum({amt}) > 0""",
)
def having_residual(t: Tables) -> DataFrame:
    taken = lines(t).groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("amt").alias("taken"))
    rest = dec("o_totalprice") - F.col("taken")
    return t["orders"].join(taken, "o_orderkey").where(rest > 0).select("o_orderkey", money(rest).alias("rest"))


@query(
    "union_then_agg",
    """SELECT o_custkey, CAST(sum(a) AS {money}) AS amount FROM (
       SELECT o_custkey, CAST(o_totalprice AS DECIMAL(18,2)) AS a FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT o_custkey, {amt} FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderstatus = 'O') GROUP BY 1""",
)
def union_then_agg(t: Tables) -> DataFrame:
    orders = t["orders"]
    closed = orders.where("o_orderstatus = 'F'").select("o_custkey", dec("o_totalprice").alias("a"))
    open_ = orders.where("o_orderstatus = 'O'").join(lines(t), F.col("o_orderkey") == F.col("l_orderkey"))
    both = closed.unionByName(open_.select("o_custkey", F.col("amt").alias("a")))
    return both.groupBy("o_custkey").agg(money(F.sum("a")).alias("amount"))


@query(
    "union_all",
    "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F' UNION ALL "
    "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus = 'P'",
)
def union_all(t: Tables) -> DataFrame:
    cols = t["orders"].select("o_orderkey", "o_custkey", "o_orderstatus")
    return cols.where("o_orderstatus = 'F'").unionByName(cols.where("o_orderstatus = 'P'"))


@query(
    "unit_cost_by_lot",
    """SELECT l_partkey, l_suppkey, round(max(l_extendedprice) / max(l_quantity), 8) AS unit_cost FROM lineitem GROUP BY 1, 2""",
)
def unit_cost_by_lot(t: Tables) -> DataFrame:
    lots = lines(t).groupBy("l_partkey", "l_suppkey").agg(F.max("amt").alias("a"), F.max("qty").alias("q"))
    return lots.select("l_partkey", "l_suppkey", rounded(safe_div(F.col("a").cast("double"), F.col("q").cast("double")), 8).alias("unit_cost"))


@query(
    "collect_names",
    """SELECT l_orderkey, string_agg(DISTINCT s_name, '/' ORDER BY s_name) AS suppliers FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1""",
)
def collect_names_query(t: Tables) -> DataFrame:
    named = star_join(lines(t).select("l_orderkey", "l_suppkey"), [Dim(t["supplier"], {"l_suppkey": "s_suppkey"}, {"s_name": "s_name"})])
    return collect_names(named, ["l_orderkey"], "s_name", "suppliers")


LOT = ["l_partkey", "l_suppkey"]
FACTS = {f"{flag}{status}".lower(): (flag, status) for flag in "ANR" for status in "FO"}


def _lot_facts(t: Tables) -> dict[str, DataFrame]:
    moves = lines(t).select(*LOT, "l_returnflag", "l_linestatus", "qty")
    return {
        name: moves.where((F.col("l_returnflag") == flag) & (F.col("l_linestatus") == status)).select(*LOT, "qty")
        for name, (flag, status) in FACTS.items()
    }


LADDER_SQL = (
    "SELECT l_partkey, l_suppkey, "
    + ", ".join(
        f"CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) FILTER (l_returnflag = '{f}' AND l_linestatus = '{s}') AS DECIMAL(19,2)) AS {name}"
        for name, (f, s) in FACTS.items()
    )
    + " FROM lineitem GROUP BY 1, 2"
)


@query("lot_status_ladder", LADDER_SQL)
def lot_status_ladder(t: Tables) -> DataFrame:
    """One pre-aggregated fact after the other joined to the lots."""
    base = t["lineitem"].select(*LOT).distinct()
    steps = [(fact, LOT, {name: money(F.sum("qty"))}) for name, fact in _lot_facts(t).items()]
    return preagg_join(base, steps)


@query("lot_pivot", LADDER_SQL)
def lot_pivot(t: Tables) -> DataFrame:
    """The ladder's result in one shuffle."""
    pivot = tagged_pivot(_lot_facts(t), LOT, "qty")
    return pivot.select(*LOT, *[money(name).alias(name) for name in FACTS])
