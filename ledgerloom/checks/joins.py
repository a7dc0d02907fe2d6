"""Join shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.checks.basics import LAST_PURCHASE
from ledgerloom.checks.registry import Tables, query
from ledgerloom.checks.roles import big, dec, event_day, lines, money, purchases, rounded
from ledgerloom.functions.scalars import nullif_blank, safe_div
from ledgerloom.operators.joins import (
    Dim, anti_by, full_join_split, left_join_filtered, membership_join, not_in, semi_by, star_join,
)
from ledgerloom.operators.merge import multi_fact_merge, outer_chain
from ledgerloom.operators.windows import latest_per_key
from ledgerloom.plans.receivables import OrgRule, in_scope, net_receipts

LINE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_returnflag"]
SCOPE = [
    OrgRule("F", excluded_customers=("AFRICA", "ASIA")),
    OrgRule("O", excluded_project_text="1"),
]
SCOPE_SQL = "((o_orderstatus = 'F' AND r_name NOT IN ('AFRICA', 'ASIA')) OR (o_orderstatus = 'O' AND n_name NOT LIKE '%1%'))"


@query(
    "header_entry_inner",
    """SELECT o_orderkey, o_custkey, o_orderstatus, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, {amt} AS amt
       FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
)
def header_entry_inner(t: Tables) -> DataFrame:
    joined = t["orders"].join(lines(t), F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.select(
        "o_orderkey", "o_custkey", "o_orderstatus", big("l_linenumber").alias("l_linenumber"), "l_partkey", "l_suppkey", "amt"
    )


def _nation_roles(t: Tables) -> list[Dim]:
    """Nation and region of the customer and of the supplier: the same dims in two roles."""
    n, r = t["nation"], t["region"]
    return [
        Dim(t["orders"], {"l_orderkey": "o_orderkey"}, {"status": "o_orderstatus", "custkey": "o_custkey"}),
        Dim(t["part"], {"l_partkey": "p_partkey"}, {"part_name": "p_name"}),
        Dim(t["supplier"], {"l_suppkey": "s_suppkey"}, {"supplier": "s_name", "snation": "s_nationkey"}),
        Dim(t["customer"], {"custkey": "c_custkey"}, {"customer": "c_name", "cnation": "c_nationkey"}),
        Dim(n, {"cnation": "n_nationkey"}, {"customer_nation": "n_name", "cregion": "n_regionkey"}),
        Dim(n, {"snation": "n_nationkey"}, {"supplier_nation": "n_name", "sregion": "n_regionkey"}),
        Dim(r, {"cregion": "r_regionkey"}, {"customer_region": "r_name"}),
        Dim(r, {"sregion": "r_regionkey"}, {"supplier_region": "r_name"}),
    ]


STAR_SQL = """FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey
    LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey
    LEFT JOIN region cr ON cn.n_regionkey = cr.r_regionkey LEFT JOIN region sr ON sn.n_regionkey = sr.r_regionkey"""


@query(
    "star_left_join",
    f"""SELECT l_orderkey, l_partkey, l_suppkey, l_returnflag, {{amt}} AS amt, o_orderstatus AS status, p_name AS part_name,
        s_name AS supplier, c_name AS customer, cn.n_name AS customer_nation, sn.n_name AS supplier_nation,
        cr.r_name AS customer_region, sr.r_name AS supplier_region {STAR_SQL}""",
)
def star_left_join(t: Tables) -> DataFrame:
    return star_join(lines(t).select(*LINE_COLS, "amt"), _nation_roles(t)).select(
        *LINE_COLS, "amt", "status", "part_name", "supplier", "customer",
        "customer_nation", "supplier_nation", "customer_region", "supplier_region",
    )


@query(
    "role_dim_join",
    f"""SELECT l_orderkey, l_partkey, l_suppkey, l_returnflag, coalesce(CASE WHEN cr.r_name <> 'ASIA' THEN cn.n_name END, sn.n_name, '') AS nation,
        coalesce(CASE WHEN cr.r_name <> 'ASIA' THEN cr.r_name END, sr.r_name, '') AS region {STAR_SQL}""",
)
def role_dim_join(t: Tables) -> DataFrame:
    joined = star_join(lines(t).select(*LINE_COLS), _nation_roles(t))
    known = F.col("customer_region") != "ASIA"
    return joined.select(
        *LINE_COLS,
        F.coalesce(F.when(known, F.col("customer_nation")), "supplier_nation", F.lit("")).alias("nation"),
        F.coalesce(F.when(known, F.col("customer_region")), "supplier_region", F.lit("")).alias("region"),
    )


@query(
    "left_join_right_pred",
    f"SELECT c_custkey, event_id, CAST(value AS DECIMAL(18,2)) AS value FROM customer LEFT JOIN {LAST_PURCHASE} ON user_id = c_custkey AND value > 30",
)
def left_join_right_pred(t: Tables) -> DataFrame:
    last = latest_per_key(purchases(t), ["user_id"], "ts", ["event_id"]).withColumnRenamed("user_id", "c_custkey")
    joined = left_join_filtered(t["customer"], last, ["c_custkey"], F.col("value") > 30)
    return joined.select("c_custkey", "event_id", dec("value").alias("value"))


@query(
    "composite_key_join",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_returnflag, {amt} AS amt,
       round(max_amt / max_qty, 8) AS unit_cost FROM lineitem
       LEFT JOIN (SELECT l_partkey AS p, l_suppkey AS s, max(l_extendedprice) AS max_amt, max(l_quantity) AS max_qty
                  FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1, 2) ON l_partkey = p AND l_suppkey = s""",
)
def composite_key_join(t: Tables) -> DataFrame:
    lot = ["l_partkey", "l_suppkey"]
    cost = lines(t).where("l_returnflag = 'N'").groupBy(*lot).agg(F.max("amt").alias("a"), F.max("qty").alias("q"))
    cost = cost.select(*lot, rounded(safe_div(F.col("a").cast("double"), F.col("q").cast("double")), 8).alias("unit_cost"))
    return lines(t).select(*LINE_COLS, "amt").join(cost, lot, "left").select(*LINE_COLS, "amt", "unit_cost")


@query(
    "expr_key_join",
    """SELECT o_orderkey, c_custkey, c_name FROM orders LEFT JOIN customer
       ON c_custkey = CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey END""",
)
def expr_key_join(t: Tables) -> DataFrame:
    key = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey").cast("string")).otherwise(F.lit(""))
    keyed = t["orders"].select("o_orderkey", nullif_blank(key).cast("bigint").alias("key"))
    joined = keyed.join(t["customer"], F.col("key") == F.col("c_custkey"), "left")
    return joined.select("o_orderkey", "c_custkey", "c_name")


@query("semi_join_list", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT user_id FROM events WHERE event_type = 'purchase')")
def semi_join_list(t: Tables) -> DataFrame:
    return semi_by(t["customer"], purchases(t), {"c_custkey": "user_id"}).select("c_custkey", "c_name")


@query(
    "anti_join_list",
    "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM events WHERE event_type = 'purchase' AND user_id = c_custkey)",
)
def anti_join_list(t: Tables) -> DataFrame:
    return anti_by(t["customer"], purchases(t), {"c_custkey": "user_id"}).select("c_custkey", "c_name")


@query(
    "not_in_subquery",
    f"""WITH c AS (SELECT c_custkey, event_id FROM customer LEFT JOIN {LAST_PURCHASE} ON user_id = c_custkey)
        SELECT 'plain' AS list, c_custkey, event_id FROM c WHERE event_id NOT IN (SELECT event_id FROM events WHERE value < 20)
        UNION ALL SELECT 'with null', c_custkey, event_id FROM c WHERE event_id NOT IN (SELECT nullif(event_id, 0) FROM events WHERE value < 20)
        UNION ALL SELECT 'empty', c_custkey, event_id FROM c WHERE event_id NOT IN (SELECT event_id FROM events WHERE value < 0)""",
)
def not_in_subquery(t: Tables) -> DataFrame:
    last = latest_per_key(purchases(t), ["user_id"], "ts", ["event_id"]).select(F.col("user_id").alias("c_custkey"), "event_id")
    c = t["customer"].select("c_custkey").join(last, "c_custkey", "left")
    cheap = t["events"].where("value < 20")
    lists = {
        "plain": cheap.select(F.col("event_id").alias("id")),
        "with null": cheap.select(F.nullif("event_id", F.lit(0)).alias("id")),
        "empty": t["events"].where("value < 0").select(F.col("event_id").alias("id")),
    }
    out = None
    for name, ids in lists.items():
        part = not_in(c, "event_id", ids, "id").select(F.lit(name).alias("list"), "c_custkey", "event_id")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "receivable_scope",
    f"""SELECT o_orderkey, o_orderstatus, n_name, r_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey
        LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey WHERE {SCOPE_SQL}""",
)
def receivable_scope(t: Tables) -> DataFrame:
    joined = star_join(
        t["orders"].select("o_orderkey", "o_orderstatus", "o_custkey"),
        [
            Dim(t["customer"], {"o_custkey": "c_custkey"}, {"nk": "c_nationkey"}),
            Dim(t["nation"], {"nk": "n_nationkey"}, {"n_name": "n_name", "rk": "n_regionkey"}),
            Dim(t["region"], {"rk": "r_regionkey"}, {"r_name": "r_name"}),
        ],
    )
    return joined.where(in_scope(SCOPE, "o_orderstatus", "r_name", "n_name")).select("o_orderkey", "o_orderstatus", "n_name", "r_name")


def daily(t: Tables, kind: str, measure: str = "value") -> DataFrame:
    """Value per user and day of one event type."""
    rows = t["events"].where(F.col("event_type") == kind)
    return rows.groupBy("user_id", event_day().alias("day")).agg(money(F.sum(dec("value"))).alias(measure))


def daily_sql(kind: str) -> str:
    return (
        "(SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(19,2)) AS v"
        f" FROM events WHERE event_type = '{kind}' GROUP BY 1, 2)"
    )


CHAIN = ["purchase", "click", "view", "error"]
CHAIN_SELECT = """SELECT coalesce(a.user_id, b.user_id, c.user_id, d.user_id) AS user_id, coalesce(a.day, b.day, c.day, d.day) AS day,
    a.v AS purchase, b.v AS click, c.v AS view, d.v AS error"""


@query(
    "outer_chain_asis",
    f"""{CHAIN_SELECT} FROM {daily_sql('purchase')} a FULL JOIN {daily_sql('click')} b ON a.user_id = b.user_id AND a.day = b.day
        FULL JOIN {daily_sql('view')} c ON b.user_id = c.user_id AND b.day = c.day
        FULL JOIN {daily_sql('error')} d ON c.user_id = d.user_id AND c.day = d.day""",
)
def outer_chain_asis(t: Tables) -> DataFrame:
    return outer_chain([(daily(t, k, k), k) for k in CHAIN], ["user_id", "day"], "neighbour")


@query(
    "outer_chain_first",
    f"""{CHAIN_SELECT} FROM {daily_sql('purchase')} a FULL JOIN {daily_sql('click')} b ON a.user_id = b.user_id AND a.day = b.day
        FULL JOIN {daily_sql('view')} c ON a.user_id = c.user_id AND a.day = c.day
        FULL JOIN {daily_sql('error')} d ON a.user_id = d.user_id AND a.day = d.day""",
)
def outer_chain_first(t: Tables) -> DataFrame:
    return outer_chain([(daily(t, k, k), k) for k in CHAIN], ["user_id", "day"], "first")


def _pivot_sql(kinds, keys="user_id, strftime(ts, '%Y-%m-%d') AS day") -> str:
    sums = ", ".join(
        f"CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (event_type = '{k}') AS DECIMAL(19,2)) AS {k}" for k in kinds
    )
    listed = ", ".join(f"'{k}'" for k in kinds)
    return f"SELECT {keys}, {sums} FROM events WHERE event_type IN ({listed}) GROUP BY 1, 2"


@query("multi_fact_merge", _pivot_sql(CHAIN))
def multi_fact_merge_query(t: Tables) -> DataFrame:
    facts = {k: t["events"].where(F.col("event_type") == k).select("user_id", event_day().alias("day"), dec("value").alias("v")) for k in CHAIN}
    merged = multi_fact_merge(facts, ["user_id", "day"], "v")
    return merged.select("user_id", "day", *[money(k).alias(k) for k in CHAIN])


@query(
    "full_outer_net",
    f"""SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(a.day, b.day) AS day,
        CAST(coalesce(a.v, 0) - coalesce(b.v, 0) AS DECIMAL(19,2)) AS net
        FROM {daily_sql('purchase')} a FULL JOIN {daily_sql('error')} b ON a.user_id = b.user_id AND a.day = b.day""",
)
def full_outer_net(t: Tables) -> DataFrame:
    return net_receipts(daily(t, "purchase", "amount"), daily(t, "error", "amount"), ["user_id", "day"]).select(
        "user_id", "day", money("net").alias("net")
    )


@query(
    "full_join_split",
    """SELECT o_orderkey, event_id, o_custkey, user_id FROM orders FULL JOIN events ON o_custkey = user_id""",
)
def full_join_split_query(t: Tables) -> DataFrame:
    """All orders against all events; a customer's orders meet all of a user's events."""
    return full_join_split(t["orders"].select("o_orderkey", "o_custkey"), t["events"].select("event_id", "user_id"), {"o_custkey": "user_id"})


@query(
    "membership_join",
    """SELECT p_partkey, coalesce(string_agg(w, '/' ORDER BY w), '') AS names FROM (SELECT p_partkey, unnest(list_distinct(string_split(p_name, ' '))) AS w0 FROM part)
       LEFT JOIN (SELECT DISTINCT string_split(p_name, ' ')[2] AS w FROM part) ON w0 = w GROUP BY p_partkey""",
)
def membership_join_query(t: Tables) -> DataFrame:
    second = F.get(F.split("p_name", " "), F.lit(1))
    words = t["part"].select(second.alias("code"), second.alias("name")).distinct()
    return membership_join(t["part"], "p_partkey", "p_name", " ", words, "code", "name", "names").select("p_partkey", "names")
