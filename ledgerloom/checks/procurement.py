"""Procurement timeline, amounts, returns, workload, lead times, supplier orders.

Roles: orders are requisitions, lines grouped by (order, supplier) purchase lines, lines
receipts, customers the sales orders behind them; (part, supplier) is the lot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.checks.registry import Tables, query
from ledgerloom.checks.roles import dec, lines, money, rounded
from ledgerloom.functions.scalars import day_text, month_text
from ledgerloom.plans import procurement as p

TIES = ["bill_no", "l_linenumber", "l_extendedprice"]
DAYS = ("sale_days", "req_days", "pur_days", "stock_days")


def _moves(t: Tables, cond: str) -> DataFrame:
    return lines(t).where(cond).select(
        F.when(F.col("l_suppkey") != 5, F.concat(F.lit("L"), F.col("l_suppkey").cast("string"))).otherwise("").alias("lot_no"),
        F.col("l_partkey").alias("material_id"), F.col("l_orderkey").alias("bill_no"), F.col("l_shipdate").alias("created_at"),
        F.when(F.col("l_linestatus") == "F", F.col("l_shipdate") + F.expr("INTERVAL 2 DAYS")).alias("approved_at"), "qty", "l_linenumber", "l_extendedprice",
    )


def _timeline(t: Tables, as_written: bool) -> DataFrame:
    rows, orders, part = lines(t), t["orders"], t["part"]
    text = lambda c: F.col(c).cast("string")
    none = F.lit(None).cast("string")
    frames = {
        "requisitions": orders.select(
            F.col("o_orderkey").alias("bill_id"), F.lit(1).alias("entry_id"), F.col("o_custkey").alias("source_bill_id"), F.lit(1).alias("source_entry_id"),
            dec("o_totalprice").alias("qty"), text("o_orderkey").alias("req_no"), F.when(F.col("o_orderstatus") == "F", "C").otherwise(F.col("o_orderstatus")).alias("req_status"),
            F.col("o_orderdate").alias("req_created"), (F.col("o_orderdate") + F.expr("INTERVAL 36 HOURS")).alias("req_approved"),
            F.col("o_orderpriority").alias("req_org"),
            *[none.alias(c) for c in p.REQ_COLS if c not in ("req_no", "req_status", "req_created", "req_approved", "req_org")],
        ),
        "purchases": rows.groupBy("l_orderkey", "l_suppkey").agg(
            F.sum(F.when(F.col("l_returnflag") != "R", F.col("amt")).otherwise(0)).cast("decimal(18,2)").alias("qty"), F.min("l_shipdate").alias("first")
        ).select(
            F.col("l_orderkey").alias("bill_id"), F.col("l_suppkey").alias("entry_id"), F.col("l_orderkey").alias("req_bill_id"), F.lit(1).alias("req_entry_id"), "qty",
            F.concat_ws("/", text("l_orderkey"), text("l_suppkey")).alias("pur_no"), F.lit("B").alias("pur_status"),
            F.col("first").alias("pur_created"), (F.col("first") + F.expr("INTERVAL 6 HOURS")).alias("pur_approved"),
            *[none.alias(c) for c in p.PUR_COLS if c not in ("pur_no", "pur_status", "pur_created", "pur_approved")],
        ),
        "receipts": rows.where("l_returnflag <> 'N'").select(
            F.col("l_orderkey").alias("pur_bill_id"), F.col("l_suppkey").alias("pur_entry_id"), F.col("amt").alias("qty"), text("l_linenumber").alias("receipt_no"),
            F.col("l_shipdate").alias("receipt_created"), F.col("l_shipdate").alias("receipt_approved"), F.concat(F.lit("L"), text("l_suppkey")).alias("lot_no"),
            F.col("l_partkey").alias("material_id"), F.col("l_linestatus").alias("stock"),
        ),
        "notices": _moves(t, "l_linestatus = 'O'"),
        "shipments": _moves(t, "l_returnflag = 'N'"),
        "sale_orders": t["customer"].select(
            F.col("c_custkey").alias("bill_id"), F.lit(1).alias("entry_id"), (dec("c_acctbal") * 400).cast("decimal(18,2)").alias("qty"), F.col("c_name").alias("sale_no"),
            F.to_timestamp(F.lit("1995-01-01 00:00:00")).alias("sale_created"), F.to_timestamp(F.lit("1995-01-04 12:00:00")).alias("sale_approved"),
            F.col("c_mktsegment").alias("customer_order_no"),
        ),
    }
    out = p.procure_timeline(frames, TIES, as_written)
    qty = ("req_qty", "pur_qty", "received_qty", "sale_qty", "notice_qty", "ship_qty")
    return out.select(
        "req_no", "req_status", "req_org", "pur_no", "pur_status", "receipt_no", "lot_no", "material_id", "stock", "sale_no", "customer_order_no",
        *[money(c).alias(c) for c in qty], "notice_bill_no", "ship_bill_no", *[rounded(c).alias(c) for c in DAYS],
    )


def _timeline_sql(first_rest: str) -> str:
    lot = "CASE WHEN l_suppkey <> 5 THEN 'L' || l_suppkey ELSE '' END"

    def moves(cond: str, name: str) -> str:
        approved = "CASE WHEN l_linestatus = 'F' THEN l_shipdate + INTERVAL 2 DAY END"
        return f"""{name} AS (SELECT * FROM (SELECT {lot} AS lot, l_partkey AS m, l_orderkey AS bill, {approved} AS appr,
            CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) OVER (PARTITION BY l_partkey, l_suppkey) AS {{money}}) AS q,
            row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY coalesce({approved}, l_shipdate) DESC, l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC) AS rn
            FROM lineitem WHERE {cond}) WHERE rn = 1 AND lot <> '')"""

    req_cols = "r.req_no, r.req_status, r.req_org, r.created, r.approved, r.cust"
    return f"""WITH rec AS (SELECT l_orderkey AS b, l_suppkey AS e, {{amt}} AS rq, CAST(l_linenumber AS VARCHAR) AS receipt_no, l_shipdate AS rec_appr, 'L' || l_suppkey AS lot_no,
            l_partkey AS material_id, l_linestatus AS stock FROM lineitem WHERE l_returnflag <> 'N'),
        pur AS (SELECT l_orderkey AS b, l_suppkey AS e, CAST(sum(CASE WHEN l_returnflag <> 'R' THEN {{amt}} ELSE 0 END) AS DECIMAL(18,2)) AS q, l_orderkey || '/' || l_suppkey AS pur_no,
            min(l_shipdate) + INTERVAL 6 HOUR AS pur_appr FROM lineitem GROUP BY 1, 2),
        s1 AS (SELECT pur.b, pur_no, pur_appr, receipt_no, rec_appr, lot_no, material_id, stock, coalesce(rq, q) AS pur_qty, rq AS received_qty
               FROM pur LEFT JOIN rec ON pur.b = rec.b AND pur.e = rec.e
               UNION ALL SELECT b, pur_no, pur_appr, NULL, NULL, NULL, NULL, NULL, rest, NULL FROM ({first_rest})),
        req AS (SELECT o_orderkey AS b, CAST(o_orderkey AS VARCHAR) AS req_no, CASE o_orderstatus WHEN 'F' THEN '已审核' ELSE o_orderstatus END AS req_status, o_orderpriority AS req_org,
            o_orderdate AS created, o_orderdate + INTERVAL 36 HOUR AS approved, o_custkey AS cust, CAST(o_totalprice AS DECIMAL(18,2)) AS q FROM orders),
        s2 AS (SELECT {req_cols}, s1.pur_no, pur_appr, receipt_no, rec_appr, lot_no, material_id, stock, coalesce(pur_qty, r.q) AS req_qty, pur_qty, received_qty
               FROM req r LEFT JOIN s1 ON r.b = s1.b
               UNION ALL SELECT {req_cols}, NULL, NULL, NULL, NULL, NULL, NULL, NULL, r.q - sum(pur_qty), NULL, NULL FROM req r JOIN s1 ON r.b = s1.b
               GROUP BY r.b, r.q, {req_cols} HAVING r.q - sum(pur_qty) > 0),
        sale AS (SELECT c_custkey AS c, c_name AS sale_no, c_mktsegment AS customer_order_no, CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 400 AS DECIMAL(18,2)) AS q FROM customer),
        s3 AS (SELECT s2.*, sale_no, customer_order_no, coalesce(req_qty, q) AS sale_qty FROM s2 LEFT JOIN sale ON cust = c
               UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, sale_no, customer_order_no, q - sum(req_qty)
               FROM sale JOIN s2 ON cust = c GROUP BY c, sale_no, customer_order_no, q HAVING q - sum(req_qty) > 0),
        {moves("l_linestatus = 'O'", 'n')}, {moves("l_returnflag = 'N'", 's')}
        SELECT req_no, req_status, req_org, pur_no, CASE WHEN pur_no IS NOT NULL THEN '审核中' END AS pur_status, receipt_no, lot_no, material_id, stock, sale_no, customer_order_no,
            CAST(req_qty AS {{money}}) AS req_qty, CAST(pur_qty AS {{money}}) AS pur_qty, CAST(received_qty AS {{money}}) AS received_qty, CAST(sale_qty AS {{money}}) AS sale_qty,
            n.q AS notice_qty, s.q AS ship_qty, n.bill AS notice_bill_no, s.bill AS ship_bill_no, CASE WHEN sale_no IS NOT NULL THEN 3.5::DOUBLE END AS sale_days,
            CAST(round((epoch(approved) - epoch(created)) / 86400, 4) AS DOUBLE) AS req_days, CAST(round((epoch(pur_appr) - epoch(approved)) / 86400, 4) AS DOUBLE) AS pur_days,
            CAST(round((epoch(s.appr) - epoch(rec_appr)) / 86400, 4) AS DOUBLE) AS stock_days
        FROM s3 LEFT JOIN n ON n.lot = lot_no AND n.m = material_id LEFT JOIN s ON s.lot = lot_no AND s.m = material_id"""


@query(
    "procure_timeline",
    _timeline_sql("SELECT pur.b, pur_no, pur_appr, q - sum(rq) AS rest FROM pur JOIN rec ON pur.b = rec.b AND pur.e = rec.e GROUP BY pur.b, pur.e, pur_no, pur_appr, q HAVING q - sum(rq) > 0"),
)
def procure_timeline(t: Tables) -> DataFrame:
    return _timeline(t, as_written=False)


@query(
    "procure_timeline_asis",
    _timeline_sql("SELECT pur.b, pur_no, pur_appr, rq - sum(q) AS rest FROM pur JOIN rec ON pur.b = rec.b AND pur.e = rec.e GROUP BY pur.b, pur.e, pur_no, pur_appr, rq HAVING rq - sum(q) > 0"),
)
def procure_timeline_asis(t: Tables) -> DataFrame:
    return _timeline(t, as_written=True)


def _amount_frames(t: Tables) -> dict[str, DataFrame]:
    def fact(cond: str, dept=F.col("l_linestatus")) -> DataFrame:
        return lines(t).where(cond).select(
            month_text("l_shipdate").alias("day"), dept.alias("dept_id"), F.col("l_suppkey").alias("person_id"), F.col("l_linenumber").alias("material_id"),
            F.col("amt").alias("amount"),
        )

    nation = F.col("n_nationkey")
    return {
        "invoiced": fact("l_returnflag = 'A'", F.when(F.col("l_linestatus") == "F", "F").otherwise("")),
        "settled": fact("l_returnflag = 'N' AND l_linenumber < 4"),
        "shipped": fact("l_returnflag = 'N' AND l_discount > 0.02"),
        "ordered": fact("l_returnflag = 'R'"),
        "received": fact("l_quantity > 40 AND l_returnflag <> 'N'").withColumn("amount", F.when(F.col("material_id") == 2, 0).otherwise(F.col("amount"))),
        "materials": t["nation"].select(
            nation.alias("material_id"), nation.cast("string").alias("material_no"), F.col("n_name").alias("material_name"), F.lit("b").alias("brand"),
            F.lit("s").alias("specification"), F.col("n_regionkey").cast("string").alias("assess_type"),
        ),
        "depts": t["orders"].select(F.col("o_orderstatus").alias("dept_id"), F.concat(F.lit("dept "), "o_orderstatus").alias("dept_name")).distinct(),
        "buyers": t["supplier"].select(F.col("s_suppkey").alias("buyer_id"), F.col("s_name").alias("buyer_name")),
    }


KEYS_SQL = "strftime(l_shipdate, '%Y-%m') AS day, {dept} AS dept, l_suppkey AS p, l_linenumber AS m"
AMOUNT_SQL = {
    "a": ("l_returnflag = 'A'", "CASE WHEN l_linestatus = 'F' THEN 'F' ELSE '' END"),
    "c": ("l_returnflag = 'R'", "l_linestatus"),
}


def _amount_ctes() -> str:
    keys = KEYS_SQL.replace("{dept}", "l_linestatus")
    grouped = {k: f"SELECT {KEYS_SQL.replace('{dept}', dept)}, sum({{amt}}) AS v FROM lineitem WHERE {cond} GROUP BY 1, 2, 3, 4" for k, (cond, dept) in AMOUNT_SQL.items()}
    return f"""a AS ({grouped['a']}), b AS (SELECT day, dept, p, m, sum(v) AS v FROM (SELECT {keys}, {{amt}} AS v FROM lineitem WHERE l_returnflag = 'N' AND l_linenumber < 4
        UNION ALL SELECT {keys}, {{amt}} FROM lineitem WHERE l_returnflag = 'N' AND l_discount > 0.02) GROUP BY 1, 2, 3, 4), c AS ({grouped['c']}),
        d AS (SELECT {keys}, CASE WHEN l_linenumber = 2 THEN 0 ELSE {{amt}} END AS v FROM lineitem WHERE l_quantity > 40 AND l_returnflag <> 'N')"""


def _amounts_select(source: str) -> str:
    return f"""SELECT day, CASE WHEN dept <> '' THEN 'dept ' || dept END AS dept, s_name AS buyer, CAST(m AS VARCHAR) AS material_no, n_name AS material_name, 'b' AS brand, 's' AS specification,
        CAST(coalesce(a, 0) AS DECIMAL(18,4)) AS invoiced, CAST(coalesce(b, 0) AS DECIMAL(18,4)) AS uninvoiced, CAST(coalesce(c, 0) AS DECIMAL(18,4)) AS in_execution,
        CAST(coalesce(d, 0) AS DECIMAL(18,4)) AS on_hand, CAST(n_regionkey AS VARCHAR) AS assess_type
        FROM ({source}) LEFT JOIN nation ON m = n_nationkey LEFT JOIN supplier ON p = s_suppkey
        WHERE coalesce(a, 0) <> 0 OR coalesce(b, 0) <> 0 OR coalesce(c, 0) <> 0 OR coalesce(d, 0) <> 0"""


def _match(x: str, y: str) -> str:
    return " AND ".join(f"{x}.{k} = {y}.{k}" for k in ("day", "dept", "p", "m"))


@query(
    "purchase_amounts",
    f"WITH {_amount_ctes()} "
    + _amounts_select(
        "SELECT coalesce(a.day, b.day, c.day, d.day) AS day, coalesce(nullif(a.dept, ''), nullif(b.dept, ''), nullif(c.dept, ''), nullif(d.dept, '')) AS dept, coalesce(a.p, b.p, c.p, d.p) AS p,"
        " coalesce(a.m, b.m, c.m, d.m) AS m, a.v AS a, b.v AS b, c.v AS c, d.v AS d FROM a"
        f" FULL JOIN b ON {_match('a', 'b')} FULL JOIN c ON {_match('b', 'c')} FULL JOIN d ON {_match('d', 'c')}"
    ),
)
def purchase_amounts(t: Tables) -> DataFrame:
    return p.purchase_amounts(_amount_frames(t))


@query(
    "purchase_amounts_merged",
    f"WITH {_amount_ctes()} "
    + _amounts_select(
        "SELECT day, dept, p, m, sum(v) FILTER (k = 'a') AS a, sum(v) FILTER (k = 'b') AS b, sum(v) FILTER (k = 'c') AS c, sum(v) FILTER (k = 'd') AS d FROM ("
        "SELECT 'a' AS k, * FROM a UNION ALL SELECT 'b', * FROM b UNION ALL SELECT 'c', * FROM c UNION ALL SELECT 'd', * FROM d) GROUP BY 1, 2, 3, 4"
    ),
)
def purchase_amounts_merged(t: Tables) -> DataFrame:
    return p.purchase_amounts(_amount_frames(t), merged=True)


@query(
    "return_list",
    """SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, s_name AS buyer, o_orderpriority AS org_name, c_name AS seller, CAST(o_orderkey AS VARCHAR) AS bill_no,
       l_partkey AS material_id, p_name AS material_name FROM orders LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'R') ON o_orderkey = l_orderkey
       LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON p_size = s_suppkey
       WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'""",
)
def return_list(t: Tables) -> DataFrame:
    orders = t["orders"]
    frames = {
        "headers": orders.select(
            F.col("o_orderkey").alias("bill_id"), F.col("o_orderkey").cast("string").alias("bill_no"), day_text("o_orderdate").alias("day"), F.col("o_orderstatus").alias("org_id"),
            F.col("o_orderpriority").alias("org_name"), F.col("o_custkey").alias("seller_id"), F.lit("C").alias("status"),
            F.when(F.col("o_orderpriority") == "5-LOW", "1").otherwise("0").alias("cross_org"),
        ),
        "entries": t["lineitem"].where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("bill_id"), F.col("l_partkey").alias("material_id")),
        "sellers": t["customer"].select(F.col("c_custkey").alias("seller_id"), F.col("c_name").alias("seller_name")),
        "materials": t["part"].select(F.col("p_partkey").alias("material_id"), F.col("p_name").alias("material_name")),
        "material_buyers": t["part"].select(F.col("p_partkey").alias("material_id"), F.col("p_size").alias("buyer_id")),
        "buyers": t["supplier"].select(F.col("s_suppkey").alias("buyer_id"), F.col("s_name").alias("buyer_name")),
    }
    return p.return_list(frames, "F")


def _docs(t: Tables, kind: str) -> DataFrame:
    return t["events"].where(F.col("event_type") == kind).select(
        F.date_format("ts", "yyyy-MM-dd").alias("day"), F.col("user_id").alias("buyer"),
        F.when(F.col("value") > 10, "card").otherwise("cash").alias("pay_type"), dec("value").alias("amount"),
    )


@query(
    "daily_workload",
    """WITH e AS (SELECT strftime(ts, '%Y-%m-%d') AS day, user_id AS buyer, event_type, CASE WHEN value > 10 THEN 'card' ELSE 'cash' END AS pay_type, CAST(value AS DECIMAL(18,2)) AS v FROM events),
       a AS (SELECT day, buyer, count(*) AS n FROM e WHERE event_type = 'click' GROUP BY 1, 2), b AS (SELECT day, buyer, count(*) AS n FROM e WHERE event_type = 'view' GROUP BY 1, 2),
       c AS (SELECT day, buyer, count(*) AS n FROM e WHERE event_type = 'signup' GROUP BY 1, 2),
       d AS (SELECT day, buyer, pay_type, CAST(sum(v) AS {money}) AS paid FROM e WHERE event_type = 'purchase' GROUP BY 1, 2, 3)
       SELECT coalesce(a.day, b.day) AS approved_day, coalesce(c.day, d.day) AS paid_day, coalesce(a.buyer, b.buyer, c.buyer, d.buyer) AS buyer, pay_type,
              a.n AS requests, b.n AS orders, c.n AS payments, paid
       FROM a FULL JOIN b ON a.day = b.day AND a.buyer = b.buyer FULL JOIN c ON a.day = c.day AND a.buyer = c.buyer FULL JOIN d ON a.day = d.day AND a.buyer = d.buyer""",
)
def daily_workload(t: Tables) -> DataFrame:
    return p.daily_workload(_docs(t, "click"), _docs(t, "view"), _docs(t, "signup"), _docs(t, "purchase")).withColumn("paid", money("paid"))


def _lead_frames(t: Tables) -> dict[str, DataFrame]:
    part, supplier, customer = t["part"], t["supplier"], t["customer"]
    return {
        "purchases": lines(t).select(
            F.col("l_orderkey").cast("string").alias("bill_no"), F.col("l_shipdate").alias("created_at"), (F.col("l_shipdate") + F.expr("INTERVAL 1 DAYS")).alias("approved_at"),
            F.col("l_linestatus").alias("org_id"), F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).otherwise("").alias("source_bill_no"),
            F.col("l_orderkey").alias("req_bill_id"), F.lit(1).alias("req_entry_id"), F.col("l_suppkey").alias("supplier_id"), F.col("l_suppkey").alias("contact_id"),
            F.col("l_partkey").alias("material_id"), "qty", F.col("l_linenumber").alias("unit_id"), F.col("l_linenumber").alias("stock_id"), F.col("l_suppkey").alias("creator_id"),
            F.col("l_linestatus").alias("dept_id"), F.col("l_suppkey").alias("seller_id"), F.col("l_orderkey").cast("string").alias("order_no"), F.col("l_returnflag").alias("status"),
        ),
        "requisitions": t["orders"].where("o_orderstatus <> 'P'").select(
            F.col("o_orderkey").alias("bill_id"), F.lit(1).alias("entry_id"), F.col("o_orderkey").cast("string").alias("req_no"), F.col("o_orderdate").alias("req_approved")
        ),
        "sale_lines": t["lineitem"].select(
            F.col("l_orderkey").cast("string").alias("order_no"), F.col("l_partkey").cast("string").alias("material_no"),
            F.col("l_returnflag").alias("project_no"), F.col("l_linestatus").alias("project_name"),
        ),
        "materials": part.select(
            F.col("p_partkey").alias("material_id"), F.col("p_partkey").cast("string").alias("material_no"), F.col("p_name").alias("material_name"),
            F.col("p_type").alias("specification"), F.col("p_brand").alias("brand"),
        ),
        "suppliers": supplier.select(F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("supplier_name")),
        "contacts": supplier.select(F.col("s_suppkey").alias("contact_id"), F.col("s_name").alias("contact_name"), F.col("s_nationkey").cast("string").alias("mobile")),
        "units": t["region"].select(F.col("r_regionkey").alias("unit_id"), F.col("r_name").alias("unit_name")),
        "stocks": t["nation"].select(F.col("n_nationkey").alias("stock_id"), F.col("n_name").alias("stock_name")),
        "users": supplier.select(F.col("s_suppkey").alias("user_id"), F.col("s_name").alias("user_name")),
        "depts": t["lineitem"].select(F.col("l_linestatus").alias("dept_id"), F.concat(F.lit("dept "), "l_linestatus").alias("dept_name")).distinct(),
        "sellers": supplier.select(F.col("s_suppkey").alias("seller_id"), F.col("s_name").alias("seller_name"), F.col("s_nationkey").cast("string").alias("company")),
        "orgs": t["nation"].select(F.col("n_nationkey").alias("org_id"), F.col("n_name").alias("org_name")),
        "buyers": supplier.select(F.col("s_suppkey").alias("buyer_id"), F.col("s_name").alias("buyer_name")),
    }


@query(
    "lead_time",
    """WITH q AS (SELECT * FROM lineitem WHERE l_linestatus = 'F' AND l_returnflag <> 'R')
       SELECT CAST(o_orderkey AS VARCHAR) AS req_no, strftime(o_orderdate, '%Y-%m-%d') AS req_approved, strftime(q.l_shipdate, '%Y-%m-%d') AS created_at, strftime(q.l_shipdate + INTERVAL 1 DAY, '%Y-%m-%d') AS approved_at,
       CAST(q.l_orderkey AS VARCHAR) AS bill_no, CASE q.l_returnflag WHEN 'A' THEN '创建' ELSE q.l_returnflag END AS status, s_name AS supplier, s_name AS contact, CAST(s_nationkey AS VARCHAR) AS mobile,
       CAST(p_partkey AS VARCHAR) AS material_no, p_brand AS brand, p_name AS material_name, p_type AS specification, CAST(q.l_quantity AS DECIMAL(18,2)) AS qty, r_name AS unit, n_name AS stock, s_name AS creator,
       'dept ' || q.l_linestatus AS dept, s_name AS seller, CAST(s_nationkey AS VARCHAR) AS seller_company, CAST(q.l_orderkey AS VARCHAR) AS order_no, x.l_returnflag AS project_no, x.l_linestatus AS project_name,
       CAST(round((epoch(q.l_shipdate) - epoch(o_orderdate)) / 86400, 4) AS DOUBLE) AS days
       FROM q JOIN orders ON q.l_orderkey = o_orderkey AND o_orderstatus <> 'P' LEFT JOIN part ON q.l_partkey = p_partkey LEFT JOIN supplier ON q.l_suppkey = s_suppkey
       LEFT JOIN region ON q.l_linenumber = r_regionkey LEFT JOIN nation ON q.l_linenumber = n_nationkey
       LEFT JOIN lineitem x ON x.l_orderkey = q.l_orderkey AND x.l_partkey = p_partkey""",
)
def lead_time(t: Tables) -> DataFrame:
    out = p.lead_time(_lead_frames(t), "F")
    return out.withColumns({c: day_text(c) for c in ("req_approved", "created_at", "approved_at")}).withColumn("days", rounded("days"))


@query(
    "receipt_lead_time",
    """SELECT CAST(l_orderkey AS VARCHAR) AS bill_no, c_name AS supplier, CAST(p_partkey AS VARCHAR) AS material_no, p_name AS material_name, p_brand AS brand, 'dept ' || o_orderstatus AS dept, s_name AS buyer,
       s_name AS creator, strftime(o_orderdate, '%Y-%m-%d') AS receipt_approved, CAST(l_suppkey AS VARCHAR) AS order_no, strftime(a, '%Y-%m-%d') AS order_approved,
       CAST(round((epoch(o_orderdate) - epoch(a)) / 86400, 4) AS DOUBLE) AS days
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey
       LEFT JOIN supplier ON CAST(substring(o_orderpriority, 1, 1) AS INTEGER) = s_suppkey LEFT JOIN (SELECT l_suppkey AS k, min(l_shipdate) AS a FROM lineitem GROUP BY 1) ON k = l_suppkey
       WHERE n_name IN ('NATION_3', 'NATION_7', 'NATION_11') AND l_linenumber IN (1, 2) AND o_orderstatus IN ('F', 'O')""",
)
def receipt_lead_time(t: Tables) -> DataFrame:
    f = _lead_frames(t)
    lead = F.substring("o_orderpriority", 1, 1).cast("int")
    f["receipts"] = t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("bill_id"), F.col("o_orderkey").cast("string").alias("bill_no"), F.col("o_orderdate").alias("approved_at"), F.col("c_nationkey").alias("org_id"),
        F.col("o_custkey").alias("supplier_id"), F.col("o_orderstatus").alias("dept_id"), lead.alias("buyer_id"), lead.alias("creator_id"),
        F.when(F.col("o_orderstatus") != "P", "C").otherwise("A").alias("status"),
    )
    f["receipt_entries"] = t["lineitem"].select(
        F.col("l_orderkey").alias("bill_id"), F.col("l_linenumber").alias("stock_id"), F.col("l_partkey").alias("material_id"), F.col("l_suppkey").cast("string").alias("order_no")
    )
    f["purchase_orders"] = t["lineitem"].groupBy(F.col("l_suppkey").cast("string").alias("order_no")).agg(F.min("l_shipdate").alias("approved_at"))
    f["suppliers"] = t["customer"].select(F.col("c_custkey").alias("supplier_id"), F.col("c_name").alias("supplier_name"))
    f["depts"] = t["orders"].select(F.col("o_orderstatus").alias("dept_id"), F.concat(F.lit("dept "), "o_orderstatus").alias("dept_name")).distinct()
    out = p.receipt_lead_time(f, ["NATION_3", "NATION_7", "NATION_11"], ["NATION_1", "NATION_2"])
    return out.withColumns({c: day_text(c) for c in ("receipt_approved", "order_approved")}).withColumn("days", rounded("days"))


@query(
    "tagged_union",
    """WITH link AS (SELECT DISTINCT l_orderkey AS b, l_linenumber AS e, l_suppkey AS s FROM lineitem WHERE l_returnflag = 'A'),
        src AS (SELECT b, e, CAST(o_orderkey AS VARCHAR) AS source_no FROM link JOIN (SELECT DISTINCT o_orderkey, l_suppkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey) ON b = o_orderkey AND s = l_suppkey)
       SELECT CAST(o_orderkey AS VARCHAR) AS bill_no, '' AS source_no, strftime(o_orderdate, '%Y-%m-%d') AS approved_at, CAST(p_partkey AS VARCHAR) AS material_no, p_type AS assess_type, a AS amount, c_name AS supplier, '采购订单' AS kind
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN (SELECT l_orderkey, l_suppkey, max(l_partkey) AS pk, CAST(sum({amt}) AS {money}) AS a FROM lineitem GROUP BY 1, 2) ON o_orderkey = l_orderkey LEFT JOIN part ON pk = p_partkey
       WHERE o_orderstatus <> 'P' AND o_orderpriority <> '1-URGENT' AND n_regionkey IN (SELECT r_regionkey FROM region WHERE r_name = 'ASIA') AND l_suppkey <> 7
       UNION ALL
       SELECT CAST(o_orderkey AS VARCHAR), coalesce(source_no, ''), strftime(o_orderdate, '%Y-%m-%d'), CAST(l_partkey AS VARCHAR), '', CAST({amt} AS {money}), '', '采购退货'
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN lineitem ON o_orderkey = l_orderkey AND l_returnflag = 'R'
       LEFT JOIN src ON b = l_orderkey AND e = l_linenumber WHERE o_orderstatus <> 'P' AND n_regionkey IN (SELECT r_regionkey FROM region WHERE r_name = 'ASIA')""",
)
def tagged_union(t: Tables) -> DataFrame:
    orders = t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
    rows = lines(t)
    nations = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    head = orders.select(
        F.col("o_orderkey").alias("bill_id"), F.col("o_orderkey").cast("string").alias("bill_no"), day_text("o_orderdate").alias("approved_at"), F.col("c_nationkey").alias("org_id"),
        F.col("o_custkey").alias("supplier_id"), F.when(F.col("o_orderstatus") != "P", "C").otherwise("A").alias("status"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "1").otherwise("0").alias("manual_close"),
    )
    frames = {
        "purchases": head,
        "purchase_entries": rows.groupBy(F.col("l_orderkey").alias("bill_id"), F.col("l_suppkey").alias("entry_id")).agg(
            F.max("l_partkey").alias("material_id"), money(F.sum("amt")).alias("amount")
        ).withColumn("termination", F.when(F.col("entry_id") == 7, "B").otherwise("A")),
        "returns": head.drop("supplier_id", "manual_close"),
        "return_entries": rows.where("l_returnflag = 'R'").select(
            F.col("l_orderkey").alias("bill_id"), F.col("l_partkey").alias("material_id"), money("amt").alias("amount"),
            F.col("l_orderkey").alias("receipt_bill_id"), F.col("l_linenumber").alias("receipt_entry_id"),
        ),
        "receipt_links": rows.where("l_returnflag = 'A'").select(
            F.col("l_orderkey").alias("bill_id"), F.col("l_linenumber").alias("entry_id"), F.col("l_orderkey").alias("order_bill_id"), F.col("l_suppkey").alias("order_entry_id")
        ).distinct(),
        "orgs": nations.select(F.col("n_nationkey").alias("org_id"), F.col("r_name").alias("org_name")),
        "materials": t["part"].select(F.col("p_partkey").alias("material_id"), F.col("p_partkey").cast("string").alias("material_no"), F.col("p_type").alias("assess_type")),
        "suppliers": t["customer"].select(F.col("c_custkey").alias("supplier_id"), F.col("c_name").alias("supplier_name")),
    }
    return p.supplier_orders(frames, ["ASIA"])
