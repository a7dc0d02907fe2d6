"""Lots, stock and returned goods.

Roles: (part, supplier) is the lot; lines with flag A are receipts, N shipments and stock,
R returns; the line number names the warehouse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.checks.registry import Tables, query
from ledgerloom.checks.roles import lines, money, rounded
from ledgerloom.functions.scalars import day_text
from ledgerloom.plans import stock as s

TIES = ["l_orderkey", "l_linenumber", "l_extendedprice"]
TIES_DESC, TIES_ASC = ", ".join(f"{c} DESC" for c in TIES), ", ".join(TIES)
STOCKS = ["NATION_1", "NATION_2", "NATION_3", "NATION_4"]


def lot_ids() -> list[Column]:
    return [F.col("l_partkey").alias("material_id"), F.col("l_suppkey").alias("lot_id")]


def _lot_lines(t: Tables, cond: str) -> DataFrame:
    """Lines with their lot numbers."""
    rows = lines(t).where(cond).withColumn("material_no", F.concat(F.lit("M"), F.col("l_partkey").cast("string")))
    names = t["supplier"].select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("lot_no"))
    return rows.join(names, "l_suppkey", "left")


def _dims(t: Tables) -> dict[str, DataFrame]:
    part, supplier, nation = t["part"], t["supplier"], t["nation"]
    return {
        "materials": part.select(
            F.col("p_partkey").alias("material_id"), F.concat(F.lit("M"), F.col("p_partkey").cast("string")).alias("material_no"),
            F.col("p_name").alias("material_name"), F.col("p_type").alias("specification"), F.col("p_brand").alias("brand"),
        ),
        "lots": supplier.select(F.col("s_suppkey").alias("lot_id"), F.col("s_name").alias("lot_no")),
        "stocks": nation.select(F.col("n_nationkey").alias("stock_id"), F.col("n_name").alias("stock_name")),
        "orgs": nation.select(F.col("n_nationkey").alias("org_id"), F.col("n_name").alias("org_name")),
        "customers": t["customer"].select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name")),
        "buyers": supplier.select(F.col("s_suppkey").alias("buyer_id"), F.col("s_name").alias("buyer_no"), F.col("s_name").alias("buyer_name")),
        "depts": t["region"].select(F.col("r_regionkey").alias("dept_id"), F.col("r_name").alias("dept_name")),
        "sellers": nation.select(F.col("n_nationkey").alias("seller_id"), F.col("n_nationkey").cast("string").alias("seller_no"), F.col("n_name").alias("seller_name")),
        "suppliers": supplier.select(F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("supplier_name")),
    }


def _return_frames(t: Tables) -> dict[str, DataFrame]:
    f = _dims(t)
    headers = t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
    f["returns"] = headers.select(
        F.col("o_orderkey").alias("bill_id"), F.col("o_orderkey").cast("string").alias("bill_no"), day_text("o_orderdate").alias("approved_at"), F.lit("1").alias("org_id"),
        F.col("c_nationkey").alias("sale_org_id"), F.col("o_custkey").alias("customer_id"), F.col("c_nationkey").alias("seller_id"),
        F.when(F.col("o_orderstatus") == "P", "A").otherwise("C").alias("status"), F.when(F.col("o_orderstatus") == "F", "1").otherwise("0").alias("workflow"),
    )
    f["return_entries"] = lines(t).where("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("bill_id"), F.col("l_linenumber").alias("stock_id"), F.col("l_orderkey").cast("string").alias("order_no"),
        F.col("l_partkey").alias("material_id"), F.col("l_suppkey").alias("lot_id"), F.col("l_suppkey").alias("buyer_id"), F.col("l_linenumber").alias("dept_id"), "qty",
        F.col("l_linestatus").alias("reason"), F.lit("n").alias("note"), F.when(F.col("l_tax") > 0, "1").otherwise("0").alias("stock_flag"),
        F.col("amt").alias("price"), F.col("l_linestatus").alias("source_bill_no"),
    )
    f["order_companies"] = t["orders"].select(
        F.col("o_orderkey").cast("string").alias("order_no"), F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("company")
    )
    f["settlements"] = _lot_lines(t, "l_returnflag = 'R' AND l_discount > 0.02").select(
        F.col("l_orderkey").cast("string").alias("bill_no"), *s.LOT, F.col("qty").alias("base_qty"), F.col("amt").alias("price")
    )
    f["receipts"] = _lot_lines(t, "l_returnflag = 'A'").select(F.lit("1").alias("org_id"), F.lit("1").alias("stock_flag"), *s.LOT, F.col("amt").alias("amount"), "qty")
    f["purchase_lines"] = t["orders"].select(
        F.col("o_orderkey").alias("bill_id"), F.lit(1).alias("entry_id"), F.concat(F.lit(" "), "o_orderpriority").alias("source_bill_no")
    )
    f["receipt_lines"] = _lot_lines(t, "l_returnflag = 'N'").select(
        F.lit("1").alias("org_id"), F.lit("C").alias("status"), *s.LOT, F.col("amt").alias("amount"), "qty", F.col("l_orderkey").alias("order_bill_id"), F.lit(1).alias("order_entry_id")
    )
    return f


RETURNS_SQL = """ret AS (SELECT l.*, o_orderdate, o_orderstatus, o_orderpriority, c_name, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN lineitem l ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P' AND l_returnflag = 'R' AND l_tax > 0 AND l_linenumber BETWEEN 1 AND 4)"""


@query(
    "return_pricing",
    f"""WITH {RETURNS_SQL}, cost AS (SELECT l_partkey, l_suppkey, max(l_extendedprice) / max(l_quantity) AS c FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1, 2),
        settled AS (SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, {{amt}} AS price FROM lineitem WHERE l_returnflag = 'R' AND l_discount > 0.02)
        SELECT CAST(r.l_orderkey AS VARCHAR) AS bill_no, strftime(o_orderdate, '%Y-%m-%d') AS approved_at, so.n_name AS sale_org, c_name AS return_customer, 'M' || r.l_partkey AS material_no,
        s_name AS lot_no, s_name AS buyer_no, s_name AS buyer, r_name AS dept, CAST(c_nationkey AS VARCHAR) AS seller_no, so.n_name AS seller, st.n_name AS stock_name,
        CAST(r.l_quantity AS DECIMAL(18,2)) AS qty, r.l_linestatus AS reason, 'n' AS note, CASE o_orderstatus WHEN 'F' THEN '是' ELSE '否' END AS workflow,
        coalesce(nullif(o_orderpriority, '5-LOW'), '') AS seller_company, round(c, 8) AS unit_cost, CASE WHEN so.n_name = 'NATION_3' THEN CAST(r.l_extendedprice AS DECIMAL(18,2)) ELSE settled.price END AS unit_price,
        r.l_linestatus AS source_bill_no FROM ret r LEFT JOIN nation so ON c_nationkey = so.n_nationkey LEFT JOIN nation st ON r.l_linenumber = st.n_nationkey
        LEFT JOIN supplier ON r.l_suppkey = s_suppkey LEFT JOIN region ON r.l_linenumber = r_regionkey LEFT JOIN cost ON cost.l_partkey = r.l_partkey AND cost.l_suppkey = r.l_suppkey
        LEFT JOIN settled ON settled.l_orderkey = r.l_orderkey AND settled.l_partkey = r.l_partkey AND settled.l_suppkey = r.l_suppkey AND settled.l_quantity = r.l_quantity""",
)
def return_pricing(t: Tables) -> DataFrame:
    return s.return_pricing(_return_frames(t), "1", "NATION_3", STOCKS).withColumn("unit_cost", rounded("unit_cost", 8))


MTO_SQL = RETURNS_SQL + """, cost AS (SELECT l_partkey, l_suppkey, max(l_extendedprice) / max(l_quantity) AS c FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE l_returnflag = 'N' AND (o_orderpriority LIKE '1-%' OR o_orderpriority LIKE '1%') GROUP BY 1, 2)"""


def _mto(t: Tables) -> DataFrame:
    return s.mto_returns(_return_frames(t), "1", STOCKS, "1-")


@query(
    "mto_returns",
    f"""WITH {MTO_SQL} SELECT CAST(r.l_orderkey AS VARCHAR) AS bill_no, strftime(o_orderdate, '%Y-%m-%d') AS approved_at, 'M' || r.l_partkey AS material_no, s_name AS lot_no,
        CAST(r.l_quantity AS DECIMAL(18,2)) AS qty, s_name AS buyer_no, s_name AS buyer, r_name AS dept, round(c, 8) AS unit_cost, CAST(round(CAST(CAST(c AS VARCHAR) AS DECIMAL(22,12)) * CAST(r.l_quantity AS DECIMAL(8,2)), 6) AS DOUBLE) AS amount,
        CAST(c_nationkey AS VARCHAR) AS seller_no, n_name AS seller, coalesce(nullif(o_orderpriority, '5-LOW'), '') AS seller_company
        FROM ret r JOIN cost ON cost.l_partkey = r.l_partkey AND cost.l_suppkey = r.l_suppkey LEFT JOIN supplier ON r.l_suppkey = s_suppkey
        LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON r.l_linenumber = r_regionkey""",
)
def mto_returns(t: Tables) -> DataFrame:
    return _mto(t).withColumns({"unit_cost": rounded("unit_cost", 8), "amount": rounded("amount", 6)})


# Twelve kinds of movements of a lot, by line status, discount and line number.
MOVES = {
    "purchase_return_qty": "l_returnflag = 'R' AND l_linestatus = 'F'", "resold_qty": "l_returnflag = 'N'", "stock_qty": "l_linestatus = 'O' AND l_returnflag = 'N'",
    "received_qty": "l_returnflag = 'A'", "transfer_out_qty": "l_linenumber = 1", "transfer_in_qty": "l_linenumber = 2", "loss_qty": "l_linenumber = 3", "gain_qty": "l_linenumber = 4",
    "assembly_qty": "l_linenumber = 5", "disassembly_qty": "l_linenumber = 6", "assembly_main_qty": "l_discount > 0.05", "disassembly_main_qty": "l_discount < 0.02",
}
MOVE_SUMS = ", ".join(f"CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) FILTER ({cond}) AS DECIMAL(19,2)) AS {name}" for name, cond in MOVES.items())


@query(
    "lot_disposition",
    f"""WITH {MTO_SQL}, base AS (SELECT r.l_partkey, r.l_suppkey, CAST(sum(CAST(r.l_quantity AS DECIMAL(18,2))) AS {{money}}) AS returned_qty, round(max(c), 8) AS unit_cost FROM ret r
            JOIN cost ON cost.l_partkey = r.l_partkey AND cost.l_suppkey = r.l_suppkey GROUP BY 1, 2),
        moves AS (SELECT l_partkey, l_suppkey, {MOVE_SUMS} FROM lineitem GROUP BY 1, 2)
        SELECT 'M' || l_partkey AS material_no, s_name AS lot_no, base.* EXCLUDE (l_partkey, l_suppkey), moves.* EXCLUDE (l_partkey, l_suppkey)
        FROM base LEFT JOIN moves USING (l_partkey, l_suppkey) JOIN supplier ON l_suppkey = s_suppkey""",
)
def lot_disposition(t: Tables) -> DataFrame:
    facts = {name: lines(t).where(cond).select(*lot_ids(), "qty") for name, cond in MOVES.items()}
    out = s.lot_disposition(_mto(t), facts, _dims(t))
    return out.select(
        *s.LOT, money("returned_qty").alias("returned_qty"), rounded("unit_cost", 8).alias("unit_cost"), *[money(name).alias(name) for name in MOVES]
    )


EVENTS = {
    "event_receipt": "l_returnflag = 'A' AND l_linestatus = 'F'", "event_return": "l_returnflag = 'R'", "event_transfer": "l_linestatus = 'O'", "event_assembly": "l_linenumber = 5",
    "event_disassembly": "l_linenumber = 6", "event_gain": "l_linenumber = 7", "event_opening": "l_quantity > 45",
}
COSTS = {"receipts": "l_returnflag = 'A'", "disassemblies": "l_linenumber = 6", "assemblies": "l_linenumber = 5", "gains": "l_linenumber = 7"}


@query(
    "earliest_event",
    """WITH f AS (SELECT l_partkey, l_suppkey, min(l_shipdate) AS d FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1, 2),
            n AS (SELECT l_partkey, l_suppkey, min(l_shipdate) AS d FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1, 2),
            r AS (SELECT l_partkey, l_suppkey, min(l_shipdate) AS d FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2),
            l AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)
       SELECT 'M' || l.l_partkey AS material_no, s_name AS lot_no, strftime(least(f.d, n.d, r.d), '%Y-%m-%d') AS approved_at FROM l
       LEFT JOIN f ON l.l_partkey = f.l_partkey AND l.l_suppkey = f.l_suppkey LEFT JOIN n ON l.l_partkey = n.l_partkey AND l.l_suppkey = n.l_suppkey
       LEFT JOIN r ON l.l_partkey = r.l_partkey AND l.l_suppkey = r.l_suppkey JOIN supplier ON l.l_suppkey = s_suppkey""",
)
def earliest_event(t: Tables) -> DataFrame:
    facts = {flag: _lot_lines(t, f"l_returnflag = '{flag}'").withColumnRenamed("l_shipdate", "approved_at") for flag in "ANR"}
    return s.earliest_event(facts).withColumn("approved_at", day_text("approved_at"))


def _cost_sql() -> str:
    def newest(cond: str, cost: str) -> str:
        return f"(SELECT l_partkey AS p, l_suppkey AS s, {cost} AS c FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_shipdate DESC, {TIES_DESC}) AS rn FROM lineitem WHERE {cond}) WHERE rn = 1)"

    per_unit = "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) / l_quantity"
    parts = [newest(cond, "l_extendedprice" if k == "gains" else per_unit) for k, cond in COSTS.items()]
    joins = " ".join(f"LEFT JOIN {sql} c{i} ON c{i}.p = l_partkey AND c{i}.s = l_suppkey" for i, sql in enumerate(parts))
    return f"(SELECT l_partkey AS cp, l_suppkey AS cs, coalesce(c0.c, c1.c, c2.c, c3.c, 0) AS cost FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) {joins})"


def _cost_sources(t: Tables) -> dict[str, DataFrame]:
    per_unit = F.try_divide("amt", "qty").cast("decimal(28,8)")
    return {
        k: _lot_lines(t, cond).select(*s.LOT, "l_shipdate", *TIES, (F.col("amt").cast("decimal(28,8)") if k == "gains" else per_unit).alias("cost")) for k, cond in COSTS.items()
    }


@query(
    "cost_priority",
    f"""SELECT 'M' || cp AS material_no, s_name AS lot_no, round(cost, 8) AS unit_cost FROM {_cost_sql()} JOIN supplier ON cs = s_suppkey
        WHERE (cp, cs) IN (SELECT (l_partkey, l_suppkey) FROM lineitem WHERE {' OR '.join(COSTS.values())})""",
)
def cost_priority(t: Tables) -> DataFrame:
    return s.cost_priority(_cost_sources(t), "l_shipdate", TIES).withColumn("unit_cost", rounded("unit_cost", 8))


def _event_sql() -> str:
    parts = " UNION ALL ".join(f"SELECT l_partkey AS ep, l_suppkey AS es, l_shipdate AS d FROM lineitem WHERE {cond} AND l_linenumber IN (1, 5, 6, 7)" for cond in EVENTS.values())
    return f"(SELECT ep, es, strftime(min(d), '%Y-%m-%d') AS first_day FROM ({parts}) GROUP BY 1, 2)"


@query(
    "stock_report",
    f"""WITH locked AS (SELECT l_orderkey || '-' || l_linenumber AS k, sum(CAST(l_quantity AS DECIMAL(18,2)) - 20) AS q FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 20 GROUP BY 1),
        inv AS (SELECT l.*, CAST(l_quantity AS DECIMAL(18,2)) AS q0, CAST(l_quantity AS DECIMAL(18,2)) - coalesce(locked.q, 0) AS q1, p_name, p_type, p_brand, p_size AS num, p_size // 10 AS den
            FROM lineitem l LEFT JOIN locked ON k = l_orderkey || '-' || l_linenumber LEFT JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'N' AND l_linenumber = 1),
        first AS (SELECT * FROM (SELECT l_partkey AS fp, l_suppkey AS fs, l_linenumber AS sup, row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_shipdate, {TIES_ASC}) AS rn
            FROM lineitem WHERE l_returnflag = 'A') WHERE rn = 1)
        SELECT 'M' || l_partkey AS material_no, p_brand AS brand, p_name AS material_name, p_type AS specification, lot.s_name AS lot_no, p_type AS assess_type, p_brand AS buyer_no, p_brand AS buyer, p_type AS dept,
            CAST(trunc(CASE WHEN den = 0 THEN q0 ELSE q0 * num / den END) AS BIGINT) AS stock_qty, CAST(trunc(CASE WHEN den = 0 THEN q1 ELSE q1 * num / den END) AS BIGINT) AS available_qty,
            first_day AS approved_at, fsup.s_name AS supplier, round(coalesce(cost, 0), 8) AS unit_cost
        FROM inv LEFT JOIN supplier lot ON l_suppkey = lot.s_suppkey LEFT JOIN first ON fp = l_partkey AND fs = l_suppkey LEFT JOIN supplier fsup ON sup = fsup.s_suppkey
        LEFT JOIN {_event_sql()} ON ep = l_partkey AND es = l_suppkey LEFT JOIN {_cost_sql()} ON cp = l_partkey AND cs = l_suppkey
        WHERE trunc(CASE WHEN den = 0 THEN q0 ELSE q0 * num / den END) <> 0 OR trunc(CASE WHEN den = 0 THEN q1 ELSE q1 * num / den END) <> 0""",
)
def stock_report(t: Tables) -> DataFrame:
    entry = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    rows, part = lines(t), t["part"]
    # The line number names the warehouse; all the event warehouses count as number 1 here.
    one = F.when(F.col("l_linenumber").isin(1, 5, 6, 7), 1).otherwise(0)
    f = _dims(t) | {k: rows.where(cond).select(*lot_ids(), F.col("l_shipdate").alias("approved_at"), one.alias("stock_id")) for k, cond in EVENTS.items()}
    for k, cond in COSTS.items():
        f[k] = _lot_lines(t, cond).select(
            *s.LOT, F.col("l_shipdate").alias("approved_at"), F.lit("1").alias("org_id"), F.col("amt").alias("amount"), "qty", F.col("amt").alias("price"),
            F.col("l_linenumber").alias("supplier_id"), *TIES,
        )
    f["inventory"] = rows.where("l_returnflag = 'N'").select(
        entry.alias("inventory_id"), F.col("l_linenumber").alias("stock_id"), F.col("l_partkey").alias("material_id"), F.col("l_suppkey").alias("lot_id"), F.col("qty").alias("base_qty")
    )
    f["reservations"] = rows.where("l_returnflag = 'R'").select(entry.alias("inventory_id"), (F.col("qty") - 20).alias("base_qty"))
    f["conversions"] = part.select(F.col("p_partkey").alias("material_id"), F.col("p_size").alias("numerator"), F.expr("p_size div 10").alias("denominator"))
    f["owners"] = part.select(
        F.concat(F.lit("M"), F.col("p_partkey").cast("string")).alias("material_no"), F.col("p_type").alias("assess_type"), F.col("p_brand").alias("buyer_no"),
        F.col("p_brand").alias("buyer"), F.col("p_type").alias("dept"),
    )
    out = s.stock_report(f, "NATION_1", "1", TIES)
    return out.withColumns({"approved_at": day_text("approved_at"), "unit_cost": rounded("unit_cost", 8)})
