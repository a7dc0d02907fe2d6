"""Flat documents, staff directory, sales order report, margins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.checks.registry import Tables, query
from ledgerloom.checks.roles import big, dec, lines, money
from ledgerloom.functions.scalars import day_text
from ledgerloom.plans import flatten, sales

def entry_id() -> Column:
    return F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))


ENTRY_SQL = "CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)"


def half_up(x: str, digits: int = 7) -> str:
    """Round a double half-up on its decimal text, as Spark does."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,16)), {digits}) AS DOUBLE)"


# Columns of the flat documents in terms of the shared tables, valid in both SQL dialects:
# orders are the headers, lines the entries, suppliers the lots.
DAY = "substring(cast(o_orderdate as string), 1, 10)"
HEADERS = {
    "bill_id": "o_orderkey", "bill_no": "concat('B', o_orderkey)", "status": "o_orderstatus", "creator_id": "o_custkey", "created_at": DAY,
    "approver_id": "o_custkey % 7", "approved_at": f"CASE WHEN o_orderstatus = 'F' THEN {DAY} END", "org_id": "o_custkey % 5", "business_date": DAY,
    "applicant_org_id": "o_custkey % 3", "applied_at": DAY, "supplier_id": "o_custkey % 11", "buyer_id": "o_custkey % 13", "dept_id": "o_custkey % 4",
    "customer_id": "o_custkey", "seller_id": "o_custkey % 9", "operator_id": "o_custkey % 6", "order_type": "o_orderkey % 2", "purchase_type": "substring(o_orderpriority, 1, 1)",
    "agent_flag": "concat('', o_orderkey % 2)", "project_basic_id": "o_orderkey % 17", "consignee": "concat('C', o_custkey)", "phone": "concat('+', o_custkey)",
    "address": "o_orderpriority", "free_text_a": "concat('a', o_orderkey % 8)", "free_text_b": "CASE WHEN o_orderkey % 8 > 4 THEN 'b' END",
}
ENTRY = "l_orderkey * 8 + l_linenumber"
QTY, NET = "cast(l_quantity as decimal(18,2))", "cast(l_extendedprice as decimal(18,2))"
ENTRIES = {
    "bill_id": "l_orderkey", "entry_id": ENTRY, "material_id": "l_partkey", "project_id": "l_suppkey % 19", "seller_id": "l_suppkey % 9", "lot_id": "l_suppkey",
    "stock_id": "l_suppkey % 3", "unit_id": "l_partkey % 5", "is_gift": "l_returnflag", "termination": "l_linestatus", "note": "concat(l_returnflag, l_linestatus)",
    "source_bill_no": "concat('S', l_partkey)", **dict.fromkeys(("qty", "req_qty", "approved_qty", "due_qty", "received_qty", "shipped_qty", "referred_qty", "base_qty"), QTY),
    **dict.fromkeys(("price", "tax_price", "amount", "gross_amount", "line_amount", "referred_amount", "base_amount"), NET),
}
# Companions have one row per entry; entry numbers repeat among the lines.
SATELLITES = {
    "source_bill_no": "max(concat('S', l_partkey))", "lot_no": "max(s_name)",
    **{c: f"max({QTY})" for c in ("not_joined_qty", "joined_qty")},
    **{c: f"max({NET})" for c in ("price", "tax_price", "amount", "gross_amount", "line_amount", "joined_amount", "receivable_amount")},
}


def _listed(cols, exprs: dict[str, str], prefix: str = "") -> str:
    return ", ".join(f"{exprs[c]} AS {prefix}{c}" for c in dict.fromkeys(cols))


def _document_sql(spec: flatten.DocumentSpec) -> str:
    cols, joins = [*spec.header_cols, *spec.entry_cols], ""
    for i, sat in enumerate(spec.satellites):
        key, table = ("s_suppkey", "supplier") if sat.table == "lot" else (ENTRY, "lineitem")
        joins += f" LEFT JOIN (SELECT {key} AS k{i}, {_listed(sat.take, SATELLITES)} FROM {table} GROUP BY {key}) s{i} ON e_{sat.key} = k{i}"
    entry_cols = ["bill_id", *spec.entry_cols, *(s.key for s in spec.satellites)]
    out = [*spec.header_cols, *(f"e_{c} AS {c}" for c in spec.entry_cols), *(f"s{i}.{c}" for i, s in enumerate(spec.satellites) for c in s.take)]
    assert len(set(cols)) == len(cols)
    return f"""SELECT {", ".join(out)} FROM (SELECT {_listed(spec.header_cols, HEADERS)} FROM orders)
        LEFT JOIN (SELECT {_listed(entry_cols, ENTRIES, "e_")} FROM lineitem) ON bill_id = e_bill_id{joins}"""


def _document(t: Tables, spec: flatten.DocumentSpec) -> DataFrame:
    def picked(df: DataFrame, cols, exprs: dict[str, str]) -> DataFrame:
        return df.select(*[F.expr(exprs[c]).alias(c) for c in dict.fromkeys(cols)])

    frames = {
        spec.header: picked(t["orders"], spec.header_cols, HEADERS),
        spec.entry: picked(t["lineitem"], ["bill_id", *spec.entry_cols, *(s.key for s in spec.satellites)], ENTRIES),
    }
    for sat in spec.satellites:
        key, table = ("s_suppkey", t["supplier"]) if sat.table == "lot" else (ENTRY, t["lineitem"])
        frames[sat.table] = table.groupBy(F.expr(key).alias(sat.key)).agg(*[F.expr(SATELLITES[c]).alias(c) for c in sat.take])
    return flatten.flatten_document(frames, spec)


for _name, _spec in flatten.DOCUMENTS.items():
    query(f"flat_{_name}", _document_sql(_spec))(lambda t, spec=_spec: _document(t, spec))


@query(
    "dwd_order_detail",
    """SELECT o_orderkey AS bill_id, o_orderstatus AS status, o_custkey AS customer_id, strftime(o_orderdate, '%Y-%m-%d') AS created_on,
       CAST(l_linenumber AS BIGINT) AS line_no, l_partkey AS material_id, l_suppkey AS lot_id, {amt} AS amount, s_name AS lot_no
       FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey LEFT JOIN supplier ON l_suppkey = s_suppkey""",
)
def dwd_order_detail(t: Tables) -> DataFrame:
    frames = {
        "order": t["orders"].select(
            F.col("o_orderkey").alias("bill_id"), F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("customer_id"),
            day_text("o_orderdate").alias("created_on"),
        ),
        "order_entry": lines(t).select(
            F.col("l_orderkey").alias("bill_id"), big("l_linenumber").alias("line_no"), F.col("l_partkey").alias("material_id"),
            F.col("l_suppkey").alias("lot_id"), F.col("amt").alias("amount"),
        ),
        "lot": t["supplier"].select(F.col("s_suppkey").alias("lot_id"), F.col("s_name").alias("lot_no")),
    }
    spec = flatten.DocumentSpec(
        "order", "order_entry", ("bill_id", "status", "customer_id", "created_on"), ("line_no", "material_id", "lot_id", "amount"),
        (flatten.Satellite("lot", ("lot_no",), key="lot_id"),),
    )
    return flatten.flatten_document(frames, spec)


@query(
    "org_directory",
    """WITH u AS (SELECT 'R' || r_regionkey AS id, r_name AS name, NULL AS up FROM region
                  UNION ALL SELECT 'N' || n_nationkey, n_name, 'R' || n_regionkey FROM nation),
       p AS (SELECT 'C' || c_custkey AS id, c_name AS name, c_mktsegment AS py, 'N' || c_nationkey AS up, CAST(c_acctbal AS DECIMAL(18,2)) AS bal
             FROM customer WHERE c_mktsegment = 'MACHINERY')
       SELECT u.name AS dept_name, b.name AS parent_name, p.name AS name, p.py AS name_pinyin, CAST(p.bal AS VARCHAR) AS mobile, lower(p.id) AS email,
              u.id AS dept_id, b.id AS parent_id FROM u LEFT JOIN u b ON u.up = b.id LEFT JOIN p ON p.up = u.id""",
)
def org_directory(t: Tables) -> DataFrame:
    def key(prefix: str, c: str):
        return F.concat(F.lit(prefix), F.col(c).cast("string"))

    none = F.lit(None).cast("string")
    regions = t["region"].select(
        key("R", "r_regionkey").alias("id"), F.col("r_name").alias("name"), none.alias("name_pinyin"), none.alias("parent_id"),
        F.lit("1").alias("org_type"), F.lit(1).alias("available"),
    )
    nations = t["nation"].select(
        key("N", "n_nationkey").alias("id"), F.col("n_name").alias("name"), none.alias("name_pinyin"), key("R", "n_regionkey").alias("parent_id"),
        F.lit("2").alias("org_type"), F.lit(1).alias("available"),
    )
    people = t["customer"].select(
        key("C", "c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("name_pinyin"),
        key("N", "c_nationkey").alias("parent_id"), F.lit("8").alias("org_type"),
        F.when(F.col("c_mktsegment") == "MACHINERY", 1).otherwise(0).alias("available"),
    )
    contacts = t["customer"].select(
        key("C", "c_custkey").alias("id"), dec("c_acctbal").cast("string").alias("mobile"), F.lower(key("C", "c_custkey")).alias("email")
    )
    return flatten.staff_directory(regions.unionByName(nations).unionByName(people), contacts)


@query(
    "sale_order_report",
    f"""WITH issued AS (SELECT {ENTRY_SQL} AS e, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS {{money}}) AS q FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1),
        ticket AS (SELECT DISTINCT p_brand AS b, p_brand || ' project' AS n, lower(p_brand) AS d FROM part WHERE p_brand <> 'Brand#3')
        SELECT strftime(o_orderdate, '%Y-%m-%d') AS create_date, n AS project_name, p_brand AS project_no, p_type AS customer_order_no, b AS sales_company, d AS sales_dept,
        s_name AS create_user, s_name AS sale_name, r_name AS operator_name, p_name AS material_no, p_brand AS brand, p_name AS material_name, p_type AS specification,
        CAST(l_quantity AS DECIMAL(19,4)) AS qty, CAST(l_extendedprice AS DECIMAL(19,4)) AS tax_price, CAST(l_extendedprice AS DECIMAL(19,4)) AS amount,
        c_name AS consignee, o_orderpriority AS phone, c_mktsegment AS address,
        CASE WHEN c_nationkey = 0 THEN '否' WHEN c_nationkey = 1 THEN '是' ELSE CAST(c_nationkey AS VARCHAR) END AS is_internal_customer,
        CASE l_returnflag WHEN 'A' THEN '自采' ELSE l_returnflag END AS purchase_type, CASE l_returnflag WHEN 'A' THEN '正常' ELSE l_returnflag END AS termination,
        CASE l_linenumber WHEN 1 THEN '是' ELSE CAST(l_linenumber AS VARCHAR) END AS is_agent,
        CASE WHEN l_linenumber = 1 OR p_brand LIKE '%7%' THEN '非自营' ELSE '自营' END AS form, o_orderpriority AS unit_name, l_linestatus AS note,
        CAST(l_orderkey AS VARCHAR) AS bill_no, '小票销售订单' AS bill_kind, l_returnflag AS status0,
        CASE l_returnflag WHEN 'A' THEN '创建' ELSE l_returnflag END AS status, issued.q AS issued_qty, n_name AS sale_org, o_orderpriority AS header_note, CAST(p_size AS VARCHAR) AS ratio
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN part ON l_partkey = p_partkey
        LEFT JOIN ticket ON p_brand = b LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN region ON l_linenumber = r_regionkey LEFT JOIN issued ON e = {ENTRY_SQL}
        WHERE nullif(l_linenumber, 2) IS DISTINCT FROM 3""".replace("l_returnflag AS status0,\n", ""),
)
def sale_order_report(t: Tables) -> DataFrame:
    orders, part, customer, supplier = t["orders"], t["part"], t["customer"], t["supplier"]
    rows = lines(t).join(orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
    rows = rows.select(
        day_text("o_orderdate").alias("created_at"), F.col("l_orderkey").alias("bill_id"), F.col("l_orderkey").cast("string").alias("bill_no"),
        entry_id().alias("entry_id"), F.col("c_nationkey").alias("org_id"), F.col("l_partkey").alias("project_id"), F.col("l_suppkey").alias("creator_id"),
        F.col("l_suppkey").alias("seller_id"), F.col("l_linenumber").alias("operator_id"), F.col("o_orderpriority").alias("unit_id"),
        F.col("l_partkey").alias("material_id"), F.col("o_custkey").alias("customer_id"), "qty", F.col("amt").alias("tax_price"), F.col("amt").alias("amount"),
        F.col("c_name").alias("consignee"), F.col("o_orderpriority").alias("phone"), F.col("c_mktsegment").alias("address"),
        F.col("l_returnflag").alias("purchase_type"), F.col("l_returnflag").alias("termination"), F.col("l_linenumber").cast("string").alias("agent_flag"),
        F.col("l_linestatus").alias("note"), F.col("l_returnflag").alias("status"), F.nullif("l_linenumber", F.lit(2)).alias("order_type"),
    )
    brand = F.col("p_brand")
    frames = {
        "lines": rows,
        "projects": part.select(F.col("p_partkey").alias("project_id"), brand.alias("project_no"), F.col("p_type").alias("customer_order_no"), F.col("p_size").cast("string").alias("ratio")),
        "tickets": part.where(brand != "Brand#3").select(brand.alias("ticket_no"), F.concat(brand, F.lit(" project")).alias("ticket_name"), brand.alias("company"), F.lower(brand).alias("dept")).distinct(),
        "orgs": t["nation"].select(F.col("n_nationkey").alias("org_id"), F.col("n_name").alias("org_name")),
        "users": supplier.select(F.col("s_suppkey").alias("user_id"), F.col("s_name").alias("user_name")),
        "sellers": supplier.select(F.col("s_suppkey").alias("seller_id"), F.col("s_name").alias("seller_name")),
        "operators": t["region"].select(F.col("r_regionkey").alias("operator_id"), F.col("r_name").alias("operator_name")),
        "units": orders.select(F.col("o_orderpriority").alias("unit_id"), F.col("o_orderpriority").alias("unit_name")).distinct(),
        "materials": part.select(F.col("p_partkey").alias("material_id"), F.col("p_name").alias("material_no"), brand.alias("brand"), F.col("p_name").alias("material_name"), F.col("p_type").alias("specification")),
        "customers": customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").cast("string").alias("internal_flag")),
        "issued": lines(t).where("l_returnflag <> 'R'").groupBy(entry_id().alias("entry_id")).agg(money(F.sum("qty")).alias("issued_qty")),
        "headers": orders.select(F.col("o_orderkey").alias("bill_id"), F.col("o_orderpriority").alias("header_note")),
    }
    return sales.sale_order_report(frames, agency_mark="7", excluded_type=3)


@query(
    "transfer_margin",
    """WITH best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_extendedprice DESC, l_linenumber DESC, l_suppkey DESC) AS rn FROM lineitem) WHERE rn = 1),
       x AS (SELECT l.*, o_orderdate, o_orderstatus, c_name, n_name, p_name, p_brand, p_type, s_name,
            CASE WHEN b.l_returnflag = 'A' OR b.l_linestatus = 'P' THEN CAST(b.l_extendedprice AS DECIMAL(18,2))
                 WHEN b.l_linestatus = 'F' AND b.l_linenumber <= 4 THEN CAST((2 * CAST(round(b.l_extendedprice * 100) AS HUGEINT) * 100 + (100 + round(b.l_tax * 100)::HUGEINT)) // (2 * (100 + round(b.l_tax * 100)::HUGEINT)) AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2))
                 WHEN b.l_linestatus = 'F' THEN CAST(l.l_extendedprice AS DECIMAL(18,2)) ELSE 0 END AS tp
            FROM orders JOIN lineitem l ON o_orderkey = l.l_orderkey JOIN part ON l.l_partkey = p_partkey
            LEFT JOIN best b ON l.l_orderkey = b.l_orderkey AND l.l_partkey = b.l_partkey LEFT JOIN customer ON o_custkey = c_custkey
            LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN supplier ON l.l_suppkey = s_suppkey WHERE o_orderstatus = 'F')
       SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, CAST(l_orderkey AS VARCHAR) AS bill_no, c_name AS customer_name, 'org ' || o_orderstatus AS sale_org, '已审核' AS status,
              CAST(l_partkey AS VARCHAR) AS material_no, p_brand AS brand, p_name AS material_name, p_type AS specification, CAST(l_quantity AS DECIMAL(10,2)) AS qty,
              p_type AS unit_name, CAST(l_extendedprice AS DECIMAL(18,2)) AS tax_price, CAST(l_extendedprice AS DECIMAL(18,2)) AS price, CAST(round(l_tax * 100) AS DECIMAL(18,2)) AS tax_rate,
              CAST(l_tax AS DECIMAL(18,2)) AS tax_amount, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, CAST(l_extendedprice AS DECIMAL(18,2)) AS net_amount,
              p_type AS category, p_brand AS buyer, p_type AS dept, s_name AS sale_name, s_name AS sale_company, CAST(l_orderkey AS VARCHAR) AS order_no, CAST(tp AS DECIMAL(18,2)) AS terminal_price,
              CAST(tp * CAST(l_quantity AS DECIMAL(10,2)) AS DECIMAL(18,2)) AS terminal_amount, coalesce(nullif(l_returnflag, 'R'), '') AS project_no, p_name AS project_name,
              CAST(l_quantity AS DECIMAL(18,2)) AS cost, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) - CAST(l_quantity AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS margin FROM x""",
)
def transfer_margin(t: Tables) -> DataFrame:
    rows, part, supplier = lines(t), t["part"], t["supplier"]
    named = rows.join(part.select("p_partkey", "p_name", "p_type"), F.col("l_partkey") == F.col("p_partkey"), "left")
    order_no = F.col("l_orderkey").cast("string")
    frames = {
        "headers": t["orders"].select(
            F.col("o_orderkey").alias("bill_id"), F.col("o_orderkey").cast("string").alias("bill_no"), day_text("o_orderdate").alias("day"),
            F.col("o_orderstatus").alias("org_id"), F.col("o_custkey").alias("customer_id"), F.lit("C").alias("status"),
        ),
        "entries": named.select(
            F.col("l_orderkey").alias("bill_id"), order_no.alias("order_no"), F.col("l_partkey").alias("material_id"), dec("l_quantity", 10).alias("qty"),
            F.col("amt").alias("price"), F.col("amt").alias("tax_price"), F.round(F.col("l_tax") * 100).cast("decimal(18,2)").alias("tax_rate"),
            dec("l_tax").alias("tax_amount"), F.col("amt").alias("amount"), F.col("amt").alias("net_amount"), F.col("qty").alias("cost"),
            F.col("l_suppkey").alias("seller_id"), F.col("p_type").alias("unit_id"), F.nullif("l_returnflag", F.lit("R")).alias("project_no"), F.col("p_name").alias("project_name"),
        ),
        "order_lines": rows.select(
            order_no.alias("order_no"), F.col("l_partkey").cast("string").alias("material_no"), F.when(F.col("l_returnflag") == "A", "B").alias("purchase_type"),
            F.col("l_linestatus").alias("org_id"), F.col("amt").alias("price"), F.when(F.col("l_linenumber") > 4, "channel").alias("note"),
            F.col("amt").alias("list_price"), F.round(F.col("l_tax") * 100).cast("decimal(18,2)").alias("tax_rate"), "l_linenumber", "l_suppkey",
        ),
        "materials": part.select(
            F.col("p_partkey").alias("material_id"), F.col("p_partkey").cast("string").alias("material_no"), F.col("p_name").alias("material_name"),
            F.col("p_type").alias("specification"), F.col("p_brand").alias("brand"), F.col("p_type").alias("category"), F.col("p_brand").alias("buyer"), F.col("p_type").alias("dept"),
        ),
        "customers": t["customer"].select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name")),
        "orgs": t["orders"].select(F.col("o_orderstatus").alias("org_id"), F.concat(F.lit("org "), "o_orderstatus").alias("org_name")).distinct(),
        "units": part.select(F.col("p_type").alias("unit_id"), F.col("p_type").alias("unit_name")).distinct(),
        "sellers": supplier.select(F.col("s_suppkey").alias("seller_id"), F.col("s_name").alias("seller_name"), F.col("s_name").alias("company")),
    }
    return sales.transfer_margin(frames, own_orgs=["F"], channel_org="P", channel_note="channel", ties=["l_linenumber", "l_suppkey"])


GROSS_SQL = f"""WITH x AS (SELECT 'P' || p_partkey AS project_no, p_name AS project_name, c_mktsegment AS customer_name, c_mktsegment AS contact_name, p_brand AS brand, p_type AS brand_type,
            CAST(p_partkey AS VARCHAR) AS material_no, p_name AS material_name, p_type AS specification, p_type AS material_group, CAST(p_size AS VARCHAR) AS ratio,
            CAST(CASE WHEN p_size % 5 = p_size % 25 THEN 0 ELSE p_size / 100 END AS DECIMAL(9,6)) AS agent_rate, strftime(o_orderdate, '%Y-%m') AS created_at,
            CAST(l_tax AS DECIMAL(6,4)) AS tax, CAST(CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity END AS DECIMAL(18,2)) AS q, CAST(l_extendedprice AS DECIMAL(18,2)) AS a,
            coalesce(c.v, 0) AS c FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey LEFT JOIN customer ON o_custkey = c_custkey
            LEFT JOIN (SELECT l_orderkey AS k, l_linenumber AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(19,2)) AS v FROM lineitem WHERE l_returnflag <> 'A' GROUP BY 1, 2) c
              ON k = l_orderkey AND n = l_linenumber WHERE o_orderstatus <> 'P'),
        g AS (SELECT project_no, project_name, customer_name, contact_name, brand, brand_type, material_no, material_name, specification, material_group, ratio, created_at, agent_rate, tax,
            CAST(sum(q) AS DECIMAL(28,2)) AS qd, CAST(sum(q) AS DOUBLE) AS q, CAST(sum(a) AS DOUBLE) AS a, CAST(sum(c) AS DOUBLE) AS c, CAST(agent_rate AS DOUBLE) AS r, CAST(tax AS DOUBLE) AS t FROM x GROUP BY ALL),
        h AS (SELECT *, CASE WHEN r > 0 THEN a / r ELSE a END AS sale, CASE WHEN r > 0 THEN a / (1 + t) ELSE c END AS cost, CASE WHEN q = 0 THEN 1.0::DOUBLE ELSE q END AS u FROM g)
        SELECT project_no, project_name, customer_name, contact_name, brand, brand_type, material_no, material_name, specification, material_group, ratio, created_at, agent_rate, tax,
            qd AS sale_qty, qd AS cost_qty, {half_up('sale / (1 + t) / u')} AS net_sale_price, {half_up('sale / u')} AS tax_sale_price, {half_up('sale / (1 + t)')} AS net_sale_amount, {half_up('sale')} AS tax_sale_amount,
            {half_up('cost / u')} AS net_cost_price, {half_up('cost * (1 + t) / u')} AS tax_cost_price, {half_up('cost')} AS net_cost_amount, {half_up('cost * (1 + t)')} AS tax_cost_amount,
            {half_up('sale / (1 + t) - cost')} AS gross_margin FROM h"""


@query("gross_margin", GROSS_SQL)
def gross_margin(t: Tables) -> DataFrame:
    orders, part, customer = t["orders"], t["part"], t["customer"]
    rows = lines(t)
    frames = {
        "headers": orders.select(
            F.col("o_orderkey").alias("bill_id"), F.date_format("o_orderdate", "yyyy-MM").alias("created_at"), F.col("o_custkey").alias("customer_id"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("org_id"), F.when(F.col("o_orderstatus") == "P", "1").otherwise("2").alias("order_type"), F.lit("C").alias("status"),
        ),
        "entries": rows.join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("l_orderkey").alias("bill_id"), F.col("l_linenumber").alias("entry_id"), F.col("l_partkey").alias("project_id"), F.col("o_custkey").alias("contact_id"),
            F.col("l_partkey").alias("material_id"), F.when(F.col("l_returnflag") != "R", F.col("qty")).alias("qty"), "ratio", F.col("amt").alias("amount"),
        ).withColumnRenamed("ratio", "tax_percent"),
        "costs": rows.where("l_returnflag <> 'A'").groupBy(F.col("l_orderkey").alias("bill_id"), F.col("l_linenumber").alias("entry_id")).agg(money(F.sum("qty")).alias("cost")),
        "projects": part.select(
            F.col("p_partkey").alias("project_id"), F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("project_no"), F.col("p_name").alias("project_name"),
            F.col("p_size").cast("string").alias("ratio"), (F.col("p_size") % 5).alias("owner_org_id"), (F.col("p_size") % 25).alias("use_org_id"),
        ),
        "orgs": t["nation"].select(F.col("n_nationkey").alias("org_id"), F.col("n_name").alias("org_no")),
        "customers": customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("customer_name")),
        "materials": part.select(
            F.col("p_partkey").alias("material_id"), F.col("p_partkey").cast("string").alias("material_no"), F.col("p_name").alias("material_name"),
            F.col("p_type").alias("specification"), F.col("p_type").alias("material_group"), F.col("p_brand").alias("brand"), F.col("p_type").alias("brand_type"),
        ),
    }
    return sales.gross_margin(sales.margin_lines(frames), digits=7).withColumns({c: F.col(c).cast("decimal(28,2)") for c in ("sale_qty", "cost_qty")})


SHEET_TEXTS = (
    "project_no", "project_name", "customer_name", "contact_name", "brand", "brand_type", "material_no", "material_name", "specification", "material_group", "ratio", "created_at",
)
SHEET_AMOUNTS = (
    "net_sale_price", "tax_sale_price", "net_sale_amount", "tax_sale_amount", "net_cost_price", "tax_cost_price", "net_cost_amount", "tax_cost_amount", "gross_margin",
)


@query(
    "margin_sheet",
    "SELECT " + ", ".join(f"coalesce({c}, '') AS {c}" for c in SHEET_TEXTS)
    + ", sale_qty, CAST(tax AS DECIMAL(6,2)) AS sale_tax, cost_qty, CAST(tax AS DECIMAL(6,2)) AS cost_tax, "
    + ", ".join(f"CAST(CAST({c} AS VARCHAR) AS DECIMAL(23,10)) AS {c}" for c in SHEET_AMOUNTS)
    + f" FROM ({GROSS_SQL})",
)
def margin_sheet(t: Tables) -> DataFrame:
    return sales.margin_sheet(gross_margin(t))
