"""Newest/oldest rows, partition totals, row ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.checks.registry import Tables, query
from ledgerloom.checks.roles import LINE_TIES, big, dec, lines, money
from ledgerloom.functions.scalars import day_text
from ledgerloom.operators.joins import Dim, star_join
from ledgerloom.operators.windows import first_per_key, global_row_id, latest_per_key, partition_total

TIES_DESC = ", ".join(f"{c} DESC" for c in LINE_TIES)
TIES_ASC = ", ".join(LINE_TIES)


@query(
    "latest_per_key",
    """SELECT user_id, event_id, event_type, CAST(value AS DECIMAL(18,2)) AS value, props FROM (
       SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def latest(t: Tables) -> DataFrame:
    return latest_per_key(t["events"], ["user_id"], "ts", ["event_id"]).select(
        "user_id", "event_id", "event_type", dec("value").alias("value"), "props"
    )


@query(
    "first_per_key",
    f"""SELECT l_partkey, l_orderkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d') AS day FROM (
        SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, {TIES_ASC}) AS rn FROM lineitem) WHERE rn = 1""",
)
def first(t: Tables) -> DataFrame:
    return first_per_key(t["lineitem"], ["l_partkey"], "l_shipdate", LINE_TIES).select(
        "l_partkey", "l_orderkey", "l_suppkey", day_text("l_shipdate").alias("day")
    )


@query(
    "latest_by_coalesced",
    f"""SELECT l_suppkey, l_orderkey, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey
        ORDER BY coalesce(CASE WHEN l_linestatus = 'F' THEN l_shipdate END, o_orderdate) DESC NULLS LAST, {TIES_DESC}) AS rn
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey) WHERE rn = 1""",
)
def latest_by_coalesced(t: Tables) -> DataFrame:
    joined = star_join(t["lineitem"], [Dim(t["orders"], {"l_orderkey": "o_orderkey"}, {"created": "o_orderdate"})])
    approved = F.when(F.col("l_linestatus") == "F", F.col("l_shipdate"))
    return latest_per_key(joined, ["l_suppkey"], F.coalesce(approved, "created"), LINE_TIES).select(
        "l_suppkey", "l_orderkey", "l_partkey"
    )


@query(
    "partition_total",
    """SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_quantity AS DECIMAL(18,2)) AS qty,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) OVER (PARTITION BY l_partkey) AS {money}) AS part_qty FROM lineitem""",
)
def partition_total_query(t: Tables) -> DataFrame:
    totals = partition_total(lines(t), ["l_partkey"], "qty", "part_qty")
    return totals.select("l_orderkey", "l_partkey", "l_suppkey", "qty", money("part_qty").alias("part_qty"))


@query(
    "global_row_id",
    f"""SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
        row_number() OVER (ORDER BY l_shipdate, {TIES_ASC}, l_quantity, l_discount, l_tax) AS row_id FROM lineitem""",
)
def global_row_id_query(t: Tables) -> DataFrame:
    order = [F.col(c).asc() for c in ("l_shipdate", *LINE_TIES, "l_quantity", "l_discount", "l_tax")]
    cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]
    numbered = global_row_id(t["lineitem"].select(*cols), order, "row_id")
    return numbered.select("l_orderkey", "l_partkey", "l_suppkey", big("l_linenumber").alias("l_linenumber"), big("row_id").alias("row_id"))
