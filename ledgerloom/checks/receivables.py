"""Receivable boards, payment and invoicing status, sales board.

Roles: orders are receivable headers (organisation = order status, customer name =
market segment), lines are entries, suppliers are projects and their tickets, nations
are sellers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.checks.registry import Tables, query
from ledgerloom.checks.roles import big, dec, lines, money, purchases
from ledgerloom.functions.scalars import day_text
from ledgerloom.operators.aggregates import money_sum
from ledgerloom.operators.merge import change_flag
from ledgerloom.plans import receivables as r

AS_OF, CUTOFF, MARK = "2001-08-01", "2000-01-01", "7"
RULES = [
    r.OrgRule("F", excluded_customers=("MACHINERY", "BUILDING")),
    r.OrgRule("O", excluded_project_text="3"),
    r.OrgRule("P", excluded_short_name="N3"),
]
TWO_RULES = RULES[:2]


def roles(t: Tables) -> dict[str, DataFrame]:
    orders, supplier = t["orders"], t["supplier"]
    name, nation = F.col("s_name"), F.col("s_nationkey")
    ratio = F.when(nation == 0, "").when(nation == 1, "0").when(nation != 2, (nation * 4).cast("string"))
    headers = orders.select(
        F.col("o_orderkey").alias("bill_id"), F.col("o_orderstatus").alias("org_id"), F.col("o_custkey").alias("customer_id"),
        F.lit("C").alias("status"), F.col("o_orderdate").alias("business_day"),
        F.col("o_orderdate").alias("created_at"), F.col("o_orderdate").alias("invoiced_on"),
    )
    price = dec("l_extendedprice", 12)
    body = t["lineitem"].select(
        F.col("l_orderkey").alias("bill_id"), F.col("l_suppkey").alias("project_id"), F.col("l_suppkey").cast("string").alias("project_text"), F.col("l_linenumber").alias("seller_id"),
        F.when(F.col("l_linenumber") == 1, "").otherwise(F.col("l_orderkey").cast("string")).alias("order_no"),
        dec("l_quantity", 6).alias("qty"), (price * (1 - dec("l_discount", 4))).alias("price"), price.alias("tax_price"),
        price.alias("cost"), "l_returnflag", dec("l_extendedprice").alias("amount"),
    )
    return {
        "headers": headers,
        "entries": body,
        "customers": t["customer"].select(F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("customer_name")),
        "projects": supplier.select(F.col("s_suppkey").alias("project_id"), name.alias("project_no"), name.alias("project_name"), ratio.alias("ratio")),
        "tickets": supplier.select(
            name.alias("ticket_no"), F.when(F.col("s_acctbal") > 5000, "own").otherwise("other").alias("company"),
            nation.cast("string").alias("dept"), nation.alias("seller_id"),
        ),
        "sellers": t["nation"].select(F.col("n_nationkey").alias("seller_id"), F.col("n_name").alias("seller_name")),
        "short_names": supplier.where(nation < 15).select(
            name.alias("project_name"), F.concat(F.lit("N"), nation.cast("string")).alias("short_name"),
            F.when(nation < 8, "是").otherwise("否").alias("online"),
        ),
        "sale_orders": orders.select(
            F.col("o_orderkey").cast("string").alias("order_no"),
            F.when(F.col("o_orderstatus") == "P", "1").otherwise("0").alias("agent_flag"), F.col("o_orderpriority").alias("address"),
        ),
        "receipt_rows": body.where("l_returnflag = 'N'"),
        "refund_rows": body.where("l_returnflag = 'R'"),
    }


def ratio_sql(amount: str, ratio: str) -> str:
    """Exact half-up rounding to six decimals, on whole millionths."""
    return (
        f"CASE WHEN {ratio} > 0 THEN CAST((2 * CAST(CAST({amount} AS DECIMAL(28,6)) * 1000000 AS HUGEINT) * 100 + {ratio}) // (2 * {ratio}) AS DECIMAL(28,0))"
        f" * CAST(0.000001 AS DECIMAL(7,6)) ELSE CAST({amount} AS DECIMAL(28,6)) END"
    )


LINES_SQL = """{name} AS (SELECT o_orderkey, o_orderstatus AS org_id, o_orderdate AS d, s_name AS project_no, l_returnflag, l_linenumber,
    CASE WHEN s_nationkey < 15 THEN 'N' || s_nationkey END AS short_name, CASE WHEN s_nationkey < 8 THEN '电商化业务' ELSE '非电商化业务' END AS online,
    CASE WHEN s_nationkey > 2 THEN s_nationkey * 4 ELSE 0 END AS ratio, CASE WHEN s_acctbal > 5000 THEN 'own' WHEN s_acctbal <= 5000 THEN 'other' END AS company,
    CAST(s_nationkey AS VARCHAR) AS dept, tn.n_name AS ticket_seller, en.n_name AS entry_seller,
    CASE WHEN l_linenumber <> 1 THEN o_orderpriority END AS address, l_linenumber <> 1 AND o_orderstatus = 'P' AS agent,
    CAST(l_quantity AS DECIMAL(6,2)) * (CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS net_amount,
    CAST(l_quantity AS DECIMAL(6,2)) * CAST(l_extendedprice AS DECIMAL(12,2)) AS tax_amount,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS cost, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount
    FROM orders LEFT JOIN (SELECT * FROM lineitem{flag}) ON o_orderkey = l_orderkey LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation tn ON s_nationkey = tn.n_nationkey LEFT JOIN nation en ON l_linenumber = en.n_nationkey
    WHERE (o_orderstatus = 'F' AND c_mktsegment NOT IN ('MACHINERY', 'BUILDING')) OR (o_orderstatus = 'O' AND s_name NOT LIKE '%3%') {third})"""
THIRD = "OR (o_orderstatus = 'P' AND s_nationkey < 15 AND s_nationkey <> 3)"



def _lines_sql(name: str, third: str = THIRD, flag: str = "") -> str:
    where = f" WHERE l_returnflag = '{flag}'" if flag else ""
    return LINES_SQL.replace("{name}", name).replace("{third}", third).replace("{flag}", where)


RL, RL_TWO = _lines_sql("rl"), _lines_sql("rl", third="")


@query(
    "sales_board",
    f"""WITH {RL} SELECT entry_seller AS seller, company, dept, strftime(d, '%Y-%m-%d') AS day,
        CASE WHEN contains(a, 'URGENT') OR contains(a, 'HIGH') THEN 'fast' WHEN contains(a, 'LOW') OR contains(a, '4') THEN 'slow' ELSE '' END AS region,
        CASE WHEN agent THEN '自营' WHEN project_no LIKE '%7%' THEN '非自营' ELSE '自营' END AS form, online, coalesce(short_name, '其他') AS short_name,
        CASE WHEN company = 'own' THEN 'O' END AS company_short, project_no, CAST(sum({ratio_sql('net_amount', 'ratio')}) AS {{money}}) AS amount,
        CAST(sum({ratio_sql('tax_amount', 'ratio')}) AS {{money}}) AS tax_amount, CAST(sum(cost) AS {{money}}) AS cost
        FROM (SELECT *, coalesce(address, 'a') AS a FROM rl) GROUP BY ALL, address""".replace("GROUP BY ALL, address", "GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, address"),
)
def sales_board(t: Tables) -> DataFrame:
    f = roles(t)
    levels = [[("URGENT", "fast"), ("HIGH", "fast")], [("LOW", "slow"), ("4", "slow")]]
    short = f["tickets"].where("company = 'own'").select("company", F.lit("O").alias("company_short")).distinct()
    return r.sales_board(r.receivable_lines(f, RULES), levels, short, MARK)


def _board_parts(t: Tables, rules) -> dict[str, DataFrame]:
    f = roles(t)
    supplier = t["supplier"].join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey"))
    hand = lines(t).where("l_returnflag = 'A' AND l_linestatus = 'O'").join(
        supplier.where("s_nationkey < 10"), F.col("l_suppkey") == F.col("s_suppkey")
    )
    hand = hand.select(
        F.col("s_name").alias("project_no"), F.col("n_name").alias("seller"), F.col("s_name").alias("project_name"),
        F.concat(F.lit("L-"), "n_name").alias("short_name"), "l_shipdate", F.col("amt").alias("amount"),
        F.when(F.col("l_tax") == 0, " ").otherwise("x").alias("org_level"),
    )
    return {
        "lines": r.receivable_lines(f, rules),
        "hand": hand,
        "receipts": r.settlement_lines(f, "headers", "receipt_rows", rules),
        "refunds": r.settlement_lines(f, "headers", "refund_rows", rules),
    }


def _board(t: Tables, rules, merge_scopes: bool) -> DataFrame:
    p = _board_parts(t, rules)
    ledger = r.hand_ledger(p["hand"].withColumn("day", day_text("l_shipdate")))
    return r.receivable_board(p["lines"], ledger, p["receipts"], p["refunds"], CUTOFF, AS_OF, MARK, merge_scopes)


def _board_sql(rl: str, by: str) -> str:
    def settled(flag: str, when: str) -> str:
        return f"(SELECT project_no, sum(amount) AS v FROM rl WHERE l_returnflag = '{flag}' AND {when} GROUP BY project_no{by})"

    since, year = f"d >= DATE '{CUTOFF}'", "d >= DATE '2001-01-01' AND d < DATE '2002-01-01'"
    facts = {"paid": settled("N", since), "ref": settled("R", since), "py": settled("N", year), "ry": settled("R", year)}

    def grouped(when: str) -> str:
        return f"""(SELECT entry_seller AS seller, project_no, CASE WHEN agent OR project_no LIKE '%7%' THEN '非自营' ELSE '自营' END AS form,
            coalesce(short_name, '其他') AS short_name, strftime(min(d), '%Y-%m-%d') AS first_day, CAST(sum(tax_amount) AS {{money}}) AS amount
            FROM rl WHERE {when} GROUP BY 1, 2, 3, 4)"""

    aged = "CAST(date_diff('day', CAST({0} AS DATE), DATE '" + AS_OF + "') AS BIGINT)"
    tail = "CAST({0} - coalesce(paid.v, 0) + coalesce(ref.v, 0) AS {{money}}) AS open_amount, {1} AS aging, '2001-07' AS update_month, CAST(coalesce(py.v, 0) - coalesce(ry.v, 0) AS {{money}}) AS year_amount"
    amounts = "CAST(paid.v AS {money}) AS paid, CAST(-ref.v AS {money}) AS refunded"
    return f"""WITH {rl}, led AS (SELECT s_name AS project_no, n_name AS seller, n_name AS short_name, strftime(min(l_shipdate), '%Y-%m-%d') AS day,
            CAST(sum({{amt}}) AS {{money}}) AS amount FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
            WHERE l_returnflag = 'A' AND l_linestatus = 'O' AND s_nationkey < 10 AND l_tax <> 0 GROUP BY 1, 2, 3)
        SELECT coalesce(l.seller, o.seller) AS seller, coalesce(l.day, o.first_day) AS day, coalesce(l.project_no, o.project_no) AS project_no,
            coalesce(o.project_no, l.project_no) AS project_name, form, coalesce(o.short_name, l.short_name) AS short_name, o.amount AS sale_amount, {amounts},
            {tail.format('coalesce(l.amount, 0)', aged.format('l.day')).replace('{{', '{').replace('}}', '}')}
        FROM {grouped('NOT ' + since)} o FULL JOIN led l ON l.project_no = o.project_no
        LEFT JOIN {facts['paid']} paid ON l.project_no = paid.project_no LEFT JOIN {facts['ref']} ref ON l.project_no = ref.project_no
        LEFT JOIN {facts['py']} py ON o.project_no = py.project_no LEFT JOIN {facts['ry']} ry ON o.project_no = ry.project_no
        UNION ALL
        SELECT n.seller, n.first_day, n.project_no, n.project_no, form, n.short_name, n.amount, {amounts},
            {tail.format('coalesce(n.amount, 0)', aged.format('n.first_day')).replace('{{', '{').replace('}}', '}')}
        FROM {grouped(since)} n
        LEFT JOIN {facts['paid']} paid ON n.project_no = paid.project_no LEFT JOIN {facts['ref']} ref ON n.project_no = ref.project_no
        LEFT JOIN {facts['py']} py ON n.project_no = py.project_no LEFT JOIN {facts['ry']} ry ON n.project_no = ry.project_no"""


@query("receivable_board", _board_sql(RL, ""))
def receivable_board(t: Tables) -> DataFrame:
    return _board(t, RULES, merge_scopes=True)


@query("receivable_board_asis", _board_sql(RL_TWO, ", org_id"))
def receivable_board_asis(t: Tables) -> DataFrame:
    return _board(t, TWO_RULES, merge_scopes=False)


@query(
    "receivable_board_v2",
    f"""WITH {RL}, shipped AS (SELECT ticket_seller AS seller, project_no, CASE WHEN project_no LIKE '%7%' THEN '非自营' ELSE '自营' END AS form,
            coalesce(short_name, '其他') AS short_name, strftime(min(d), '%Y-%m-%d') AS first_day, CAST(sum({ratio_sql('tax_amount', 'ratio')}) AS {{money}}) AS amount
            FROM rl GROUP BY 1, 2, 3, 4),
        before AS (SELECT project_no, CAST(sum(tax_amount) AS {{money}}) AS amount FROM rl WHERE d < DATE '1995-01-08' GROUP BY 1),
        since AS (SELECT project_no, strftime(min(d), '%Y-%m-%d') AS day, CAST(sum(tax_amount) AS {{money}}) AS amount FROM rl WHERE d >= DATE '{CUTOFF}' GROUP BY 1),
        led AS (SELECT s_name AS project_no, strftime(max(l_shipdate), '%Y-%m-%d') AS day, CAST(sum({{amt}}) AS {{money}}) AS amount
            FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_returnflag = 'A' AND l_linestatus = 'O' AND s_nationkey < 10 GROUP BY 1),
        paid AS (SELECT project_no, CAST(sum(amount) AS {{money}}) AS v FROM rl WHERE l_returnflag = 'N' AND d >= DATE '{CUTOFF}' GROUP BY 1),
        ref AS (SELECT project_no, CAST(sum(amount) AS {{money}}) AS v FROM rl WHERE l_returnflag = 'R' AND d >= DATE '{CUTOFF}' GROUP BY 1),
        base AS (SELECT first_day, s.project_no, s.seller, form, short_name, CAST(CASE WHEN s.amount - b.amount < 1 AND coalesce(l.amount, 0) = 0 THEN 0
                WHEN s.amount - b.amount BETWEEN -1 AND 1 AND coalesce(l.amount, 0) > 0 THEN s.amount - b.amount + coalesce(l.amount, 0)
                WHEN s.amount - b.amount < -1 AND coalesce(l.amount, 0) > 0 THEN s.amount
                WHEN s.amount - b.amount > 1 THEN s.amount - b.amount + coalesce(l.amount, 0) END AS {{money}}) AS amount
            FROM shipped s JOIN before b ON s.project_no = b.project_no LEFT JOIN led l ON s.project_no = l.project_no
            UNION ALL SELECT first_day, project_no, seller, form, short_name, amount FROM shipped
                WHERE project_no NOT IN (SELECT s.project_no FROM shipped s JOIN before b ON s.project_no = b.project_no)),
        inv AS (SELECT coalesce(h.project_no, s.project_no, '') AS project_no, coalesce(h.amount, 0) + coalesce(s.amount, 0) AS amount, coalesce(h.day, s.day, '') AS day
            FROM led h FULL JOIN since s ON h.project_no = s.project_no)
        SELECT b.seller, b.first_day AS day, b.project_no, b.project_no AS project_name, form, short_name, b.amount, paid.v AS paid, ref.v AS refunded,
            CAST(greatest(coalesce(b.amount, 0) - coalesce(paid.v, 0) + coalesce(ref.v, 0), 0) AS {{money}}) AS open_amount,
            CAST(date_diff('day', CAST(b.first_day AS DATE), DATE '{AS_OF}') AS BIGINT) AS aging, '2001-07' AS update_month,
            CAST(coalesce(paid.v, 0) - coalesce(ref.v, 0) AS {{money}}) AS year_amount, inv.day AS inv_day,
            CAST(date_diff('day', CAST(inv.day AS DATE), DATE '{AS_OF}') AS BIGINT) AS inv_aging,
            CAST(CASE WHEN coalesce(inv.amount, 0) = 0 THEN 0 ELSE greatest(inv.amount - coalesce(paid.v, 0) + coalesce(ref.v, 0), 0) END AS {{money}}) AS inv_open_amount
        FROM base b LEFT JOIN paid ON b.project_no = paid.project_no LEFT JOIN ref ON b.project_no = ref.project_no LEFT JOIN inv ON b.project_no = inv.project_no""",
)
def receivable_board_v2(t: Tables) -> DataFrame:
    f, p = roles(t), _board_parts(t, RULES)
    since = F.col("created_at") >= CUTOFF
    invoiced = F.col("invoiced_on")
    shipped, before, later = r.board_amounts(p["lines"], MARK, invoiced < "1995-01-08", invoiced >= CUTOFF)
    ledger = r.opening_invoices(p["hand"].withColumn("day", F.date_format("l_shipdate", "yyyy/M/d")))
    sellers = f["tickets"].join(f["sellers"], "seller_id", "left").select(
        F.col("ticket_no").alias("project_no"), F.col("seller_name").alias("seller")
    )
    return r.receivable_board_v2(
        shipped, before, ledger, r.per_project(p["receipts"].where(since)),
        r.per_project(p["refunds"].where(since)), later, sellers, AS_OF,
    )


@query(
    "invoiced_totals",
    f"""WITH {RL} SELECT ticket_seller AS seller, project_no, project_no AS project_name, coalesce(short_name, '其他') AS short_name,
        strftime(min(d), '%Y-%m-%d') AS first_day, CAST(sum(tax_amount) AS {{money}}) AS amount FROM rl WHERE company = 'own' GROUP BY 1, 2, 3, 4""",
)
def invoiced_totals(t: Tables) -> DataFrame:
    return r.invoiced_totals(r.receivable_lines(roles(t), RULES, company="own"))


@query(
    "distinct_pairs",
    f"WITH {RL} SELECT DISTINCT entry_seller AS seller, project_no, project_no AS project_name, company FROM rl",
)
def distinct_pairs(t: Tables) -> DataFrame:
    return r.seller_list(r.receivable_lines(roles(t), RULES))


def _daily_sql(source: str) -> str:
    return f"""(SELECT ticket_seller AS seller, project_no, short_name, org_id, strftime(d, '%Y-%m-%d') AS day, sum(amount) AS v FROM {source} GROUP BY 1, 2, 3, 4, 5)"""


@query(
    "receipts_by_day",
    f"""WITH {_lines_sql('rn', flag='N')}, {_lines_sql('rr', flag='R')} SELECT coalesce(a.project_no, b.project_no) AS project_no, coalesce(a.day, b.day) AS day,
        coalesce(a.seller, b.seller) AS seller, coalesce(a.short_name, b.short_name) AS short_name, CAST(coalesce(a.v, 0) - coalesce(b.v, 0) AS {{money}}) AS net
        FROM {_daily_sql('rn')} a FULL JOIN {_daily_sql('rr')} b ON a.project_no = b.project_no AND a.day = b.day""",
)
def receipts_by_day(t: Tables) -> DataFrame:
    p = _board_parts(t, RULES)
    return r.receipts_by_day(p["receipts"], p["refunds"]).withColumn("net", money("net"))


@query(
    "receivable_tolerance",
    """WITH c AS (SELECT o_custkey, CAST(count(*) FILTER (o_orderstatus = 'F') AS DECIMAL(10,0)) AS f,
            CAST(count(*) FILTER (o_orderstatus = 'O') AS DECIMAL(10,0)) AS o, CAST(count(*) FILTER (o_orderstatus = 'P') AS DECIMAL(10,0)) - 2 AS p FROM orders GROUP BY 1)
       SELECT o_custkey, CAST(CASE WHEN f - o < 1 AND p = 0 THEN 0 WHEN f - o BETWEEN -1 AND 1 AND p > 0 THEN f - o + p
            WHEN f - o < -1 AND p > 0 THEN f WHEN f - o > 1 THEN f - o + p END AS BIGINT) AS open_orders FROM c""",
)
def receivable_tolerance(t: Tables) -> DataFrame:
    def n(status: str):
        return F.count_if(F.col("o_orderstatus") == status).cast("decimal(10,0)")

    counts = t["orders"].groupBy("o_custkey").agg(n("F").alias("f"), n("O").alias("o"), (n("P") - 2).alias("p"))
    return counts.select("o_custkey", big(r.tolerance_amount("f", "o", "p")).alias("open_orders"))


def _base_roles(t: Tables) -> dict[str, DataFrame]:
    """Tickets are parts; half of the lines reach theirs by project, the others by number."""
    orders, part = t["orders"], t["part"]
    known = F.col("p_size") > 25
    return {
        "headers": orders.select(
            F.col("o_orderkey").alias("bill_id"), F.col("o_custkey").alias("customer_id"), F.lit("C").alias("status"),
            F.when(F.col("o_orderstatus") == "P", "2").otherwise("1").alias("order_type"),
            F.col("o_orderpriority").alias("invoice_no"), day_text("o_orderdate").alias("invoiced_on"),
        ),
        "entries": t["lineitem"].select(
            F.col("l_orderkey").alias("bill_id"), F.col("l_partkey").alias("project_id"),
            F.concat(F.lit("T"), F.col("l_partkey").cast("string")).alias("ticket_no"), dec("l_extendedprice").alias("amount"),
        ),
        "projects": part.select(
            F.col("p_partkey").alias("project_id"),
            F.when(known, F.concat(F.lit("T"), F.col("p_partkey").cast("string"))).alias("project_no"),
            F.col("p_name").alias("project_name"),
        ),
        "tickets": part.where("p_size > 10").select(
            F.concat(F.lit("T"), F.col("p_partkey").cast("string")).alias("ticket_no"),
            F.col("p_name").alias("ticket_name"), F.col("p_size").alias("seller_id"),
        ),
        "sellers": t["nation"].select(
            F.col("n_nationkey").alias("seller_id"), F.col("n_name").alias("seller_name"), F.col("n_nationkey").cast("string").alias("seller_no")
        ),
        "customers": t["customer"].select(
            F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"), F.col("c_mktsegment").alias("customer_no")
        ),
    }


@query(
    "receivable_base",
    """SELECT coalesce(p_name, '') AS project_name, coalesce('T' || p_partkey, '') AS project_no, c_name AS customer_name, c_mktsegment AS customer_no,
       coalesce(n_name, '') AS seller_name, coalesce(CAST(n_nationkey AS VARCHAR), '') AS seller_no, o_orderpriority AS invoice_no,
       strftime(o_orderdate, '%Y-%m-%d') AS invoiced_on, {amt} AS amount
       FROM orders JOIN lineitem ON o_orderkey = l_orderkey LEFT JOIN customer ON o_custkey = c_custkey
       LEFT JOIN part ON l_partkey = p_partkey AND p_size > 10 LEFT JOIN nation ON p_size = n_nationkey WHERE o_orderstatus <> 'P'""",
)
def receivable_base(t: Tables) -> DataFrame:
    return r.receivable_base(_base_roles(t))


def _receipts(t: Tables) -> DataFrame:
    f = _base_roles(t)
    rows = purchases(t)
    f["receipts"] = rows.select(
        F.col("event_id").alias("bill_id"), F.col("event_id").cast("string").alias("bill_no"), F.date_format("ts", "yyyy-MM-dd").alias("day"),
        dec("value").alias("amount"), F.col("user_id").alias("customer_id"), F.lit(3).alias("seller_id"),
    )
    f["receipt_entries"] = rows.select(
        F.col("event_id").alias("bill_id"), F.col("user_id").alias("project_id"), F.get_json_object("props", "$.k").alias("settle_type_id")
    )
    f["settle_types"] = t["nation"].select(F.col("n_nationkey").cast("string").alias("settle_type_id"), F.col("n_name").alias("settle_type"))
    return r.receipt_base(f)


@query(
    "receipt_base",
    """SELECT CAST(event_id AS VARCHAR) AS bill_no, strftime(ts, '%Y-%m-%d') AS day, CAST(value AS DECIMAL(18,2)) AS amount, s.n_name AS settle_type,
       CASE WHEN p_size > 25 THEN 'T' || p_partkey END AS project_no, p_name AS project_name, c_mktsegment AS customer_no, c_name AS customer_name,
       '3' AS seller_no, 'NATION_3' AS seller_name FROM events LEFT JOIN part ON user_id = p_partkey LEFT JOIN customer ON user_id = c_custkey
       LEFT JOIN nation s ON CAST(s.n_nationkey AS VARCHAR) = CAST(json_extract(props, '$.k') AS VARCHAR) WHERE event_type = 'purchase'""",
)
def receipt_base(t: Tables) -> DataFrame:
    return _receipts(t)


@query(
    "payment_status",
    """WITH due AS (SELECT coalesce('T' || p_partkey, '') AS project_no, coalesce(p_name, '') AS project_name, coalesce(n_name, '') AS seller_name,
            coalesce(CAST(n_nationkey AS VARCHAR), '') AS seller_no, sum({amt}) AS due FROM orders JOIN lineitem ON o_orderkey = l_orderkey
            JOIN customer ON o_custkey = c_custkey LEFT JOIN part ON l_partkey = p_partkey AND p_size > 10 LEFT JOIN nation ON p_size = n_nationkey
            WHERE o_orderstatus <> 'P' AND c_name <> 'Customer#000000007' GROUP BY 1, 2, 3, 4),
        got AS (SELECT 'T' || p_partkey AS project_no, sum(CAST(value AS DECIMAL(18,2))) AS v, max(strftime(ts, '%Y-%m-%d')) AS last_day FROM events
            JOIN part ON user_id = p_partkey JOIN customer ON user_id = c_custkey WHERE event_type = 'purchase' AND p_size > 25 AND c_name <> 'Customer#000000007' GROUP BY 1)
        SELECT project_no, project_name, CASE WHEN due - coalesce(v, 0) <= 0 AND due <> 0 AND coalesce(v, 0) <> 0 THEN '已回款'
            WHEN due - coalesce(v, 0) > 0 AND due - coalesce(v, 0) < due THEN '部分回款' WHEN coalesce(v, 0) = 0 THEN '未回款' ELSE '其他状态' END AS status,
            seller_name, seller_no, CAST(due AS {money}) AS due, CAST(coalesce(v, 0) AS {money}) AS received, CAST(due - coalesce(v, 0) AS {money}) AS difference,
            coalesce(last_day, '') AS last_day FROM due LEFT JOIN got USING (project_no)""",
)
def payment_status(t: Tables) -> DataFrame:
    return r.payment_status(r.receivable_base(_base_roles(t)), _receipts(t), ["Customer#000000007"])


BILLED_SQL = """billed AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS total, billed, last_ship FROM orders
    LEFT JOIN (SELECT l_orderkey, sum({amt}) AS billed, max(strftime(l_shipdate, '%Y-%m-%d')) AS last_ship FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey)"""
INVOICE_SELECT = """SELECT o_orderkey AS ticket_id, CAST(o_orderkey AS VARCHAR) AS ticket_no,
    CASE o_orderstatus WHEN 'F' THEN '关闭' WHEN 'O' THEN '未关闭' ELSE '未知' END AS close_status,
    CASE WHEN coalesce(billed, 0) > 0 AND coalesce(total - billed, 0) <= 0 THEN '已开票' WHEN coalesce(billed, 0) > 0 AND coalesce(total - billed, 0) >= 0 AND o_orderstatus = 'F' THEN '已开票'
         WHEN coalesce(billed, 0) > 0 AND coalesce(total - billed, 0) > 0 AND o_orderstatus = 'O' THEN '部分开票' WHEN coalesce(billed, 0) <= 0 THEN '未开票' ELSE '其他' END AS status,
    CAST(billed AS {money}) AS invoiced, CAST(total - billed AS {money}) AS open_amount, coalesce(last_ship, '') AS last_invoice FROM billed"""


def _invoice_status(t: Tables) -> DataFrame:
    billed = lines(t).groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("amt").alias("billed"))
    code = F.when(F.col("o_orderstatus") == "F", "B").when(F.col("o_orderstatus") == "O", "A").otherwise("?")
    tickets = t["orders"].join(billed, "o_orderkey", "left").select(
        F.col("o_orderkey").alias("ticket_id"), F.col("o_orderkey").cast("string").alias("ticket_no"), code.alias("close_code"),
        money("billed").alias("invoiced"), money(dec("o_totalprice") - F.col("billed")).alias("open_amount"),
    )
    invoices = t["lineitem"].select(F.col("l_orderkey").cast("string").alias("ticket_no"), day_text("l_shipdate").alias("invoiced_on"))
    return r.invoice_status(tickets, invoices)


@query("invoice_status", f"WITH {BILLED_SQL} {INVOICE_SELECT}")
def invoice_status(t: Tables) -> DataFrame:
    return _invoice_status(t)


# The earlier snapshot knows the orders placed before 2001, with the amounts of that day:
# finished ones as they are, open ones with no invoices yet, pending ones half a unit less.
@query(
    "snapshot_change_flag",
    f"""WITH {BILLED_SQL}, cur AS ({INVOICE_SELECT}), prev AS (SELECT ticket_id, close_status, status,
            CASE close_status WHEN '未关闭' THEN NULL WHEN '未知' THEN invoiced - 0.5 ELSE invoiced END AS invoiced, open_amount
            FROM cur JOIN orders ON ticket_id = o_orderkey WHERE o_orderdate < DATE '2001-01-01')
        SELECT c.*, CASE WHEN c.close_status <> coalesce(p.close_status, '') OR c.status <> coalesce(p.status, '')
            OR trunc(c.invoiced) <> trunc(coalesce(p.invoiced, 0)) OR trunc(c.open_amount) <> trunc(coalesce(p.open_amount, 0)) THEN '是' ELSE '否' END AS changed
        FROM cur c LEFT JOIN prev p ON c.ticket_id = p.ticket_id""",
)
def snapshot_change_flag(t: Tables) -> DataFrame:
    cur = _invoice_status(t)
    early = t["orders"].where(F.col("o_orderdate") < "2001-01-01").select(F.col("o_orderkey").alias("ticket_id"))
    before = F.when(F.col("close_status") == "未关闭", F.lit(None)).when(F.col("close_status") == "未知", F.col("invoiced") - 0.5)
    prev = cur.join(early, "ticket_id", "left_semi").withColumn("invoiced", before.otherwise(F.col("invoiced")).cast("decimal(19,2)"))
    return change_flag(cur, prev, ["ticket_id"], ["close_status", "status"], {"invoiced": 0, "open_amount": 0})
