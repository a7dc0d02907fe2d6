"""Material catalogue, ledger, payables, platform orders, unit check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.checks.registry import Tables, query
from ledgerloom.checks.receivables import ratio_sql
from ledgerloom.checks.roles import big, dec, lines, money, purchases, rounded
from ledgerloom.checks.sales import ENTRY_SQL, entry_id
from ledgerloom.functions.scalars import day_text
from ledgerloom.plans import catalogue as c, platform as pf


def _text(name: str):
    return F.col(name).cast("string")


def _categories(t: Tables) -> DataFrame:
    """Part type over brand over size over name, as one self-referencing table."""
    part = t["part"]
    path = ["p_type", "p_brand", "p_size", "p_name"]

    def level(n: int) -> DataFrame:
        own = F.concat_ws("/", *[_text(x) for x in path[:n]])
        up = F.concat_ws("/", *[_text(x) for x in path[: n - 1]]) if n > 1 else F.lit(None).cast("string")
        return part.select(
            own.alias("id"), up.alias("parent_id"), F.lit(str(n)).alias("level"), F.concat(F.lit(f"L{n}:"), _text(path[n - 1])).alias("code"), _text(path[n - 1]).alias("name")
        ).distinct()

    out = level(1)
    for n in (2, 3, 4):
        out = out.unionByName(level(n))
    return out


def category_key() -> Column:
    return F.concat_ws("/", "p_type", "p_brand", F.col("p_size").cast("string"), "p_name")


@query(
    "category_path",
    """SELECT p_partkey, p_type AS category_1, p_brand AS category_2, CAST(p_size AS VARCHAR) AS category_3, p_name AS category_4,
       'L1:' || p_type AS category_1_code, 'L2:' || p_brand AS category_2_code, 'L3:' || p_size AS category_3_code, 'L4:' || p_name AS category_4_code FROM part""",
)
def category_path(t: Tables) -> DataFrame:
    keyed = t["part"].select("p_partkey", category_key().alias("category_id"))
    return c.category_path(keyed, "category_id", _categories(t)).drop("category_id")


@query(
    "material_catalog",
    """WITH w AS (SELECT DISTINCT string_split(p_name, ' ')[2] AS word FROM part),
        plat AS (SELECT p_partkey AS k, coalesce(string_agg(word, '/' ORDER BY word), '') AS names FROM (SELECT p_partkey, unnest(list_distinct(string_split(p_name, ' '))) AS x FROM part) LEFT JOIN w ON x = word GROUP BY 1)
       SELECT CAST(p_partkey AS VARCHAR) AS code, 'L4:' || p_name AS category_4_code, p_name AS category_4, 'L3:' || p_size AS category_3_code, CAST(p_size AS VARCHAR) AS category_3,
        'L2:' || p_brand AS category_2_code, p_brand AS category_2, 'L1:' || p_type AS category_1_code, p_type AS category_1, p_name AS name, names AS platforms, CAST(p_retailprice AS DECIMAL(18,2)) AS price,
        'B' || p_size AS brand_code, CASE WHEN s_name IS NULL THEN '/' ELSE s_name || '/' END AS brand, 'unit ' || p_type AS unit,
        CASE CAST(p_size AS VARCHAR) WHEN '1' THEN '上架' WHEN '0' THEN '下架' ELSE '未知' END AS shelf_state, CASE CAST(p_size AS VARCHAR) WHEN '0' THEN '可售' WHEN '1' THEN '不可售' ELSE '未知' END AS sale_state,
        CASE 'SL0' || p_size || '_SYS' WHEN 'SL01_SYS' THEN '17%增值税' WHEN 'SL02_SYS' THEN '13%增值税' WHEN 'SL03_SYS' THEN '7%增值税' WHEN 'SL04_SYS' THEN '0%增值税' WHEN 'SL05_SYS' THEN '11%增值税'
            WHEN 'SL06_SYS' THEN '6%增值税' WHEN 'SL07_SYS' THEN '3%增值税' WHEN 'SL08_SYS' THEN '16%增值税' WHEN 'SL09_SYS' THEN '1%增值税' ELSE '未知' END AS tax_rate,
        coalesce(r_name, '') AS assess_type, coalesce(n_name, '') AS buyer, string_split(p_name, ' ')[1] AS length, string_split(p_name, ' ')[2] AS width, string_split(p_name, ' ')[3] AS height,
        CASE WHEN p_size > 20 THEN '是' ELSE '否' END AS has_picture, CASE WHEN n_name IS NOT NULL THEN n_name ELSE p_brand END AS creator,
        CASE CAST(p_size AS VARCHAR) WHEN '1' THEN '存量' WHEN '2' THEN '增量' WHEN '3' THEN '已去存' ELSE '未知' END AS nature,
        CASE CAST(p_size AS VARCHAR) WHEN '1' THEN '是' WHEN '0' THEN '否' ELSE '未知' END AS disabled,
        CASE CAST(p_size AS VARCHAR) WHEN '1' THEN '主推商品属性组' WHEN '2' THEN '常规商品属性组' WHEN '3' THEN '零星商品属性组' WHEN '0' THEN '未分类商品属性组' ELSE '未知' END AS grade,
        string_split(p_name, ' ')[1] AS link1, string_split(p_name, ' ')[4] AS link4
       FROM part LEFT JOIN plat ON k = p_partkey LEFT JOIN supplier ON p_size = s_suppkey LEFT JOIN region ON p_size = r_regionkey LEFT JOIN nation ON p_size = n_nationkey
       WHERE nullif(p_type, 'SMALL') IS DISTINCT FROM 'PROMO'""",
)
def material_catalogue(t: Tables) -> DataFrame:
    part, nation, supplier = t["part"], t["nation"], t["supplier"]
    size = _text("p_size")
    known = {
        "material_id": F.col("p_partkey"), "code": _text("p_partkey"), "name": F.col("p_name"), "category_id": category_key(), "category_two": F.nullif("p_type", F.lit("SMALL")),
        "platform_codes": F.col("p_name"), "price": dec("p_retailprice"), "brand_id": F.col("p_size"), "unit_code": F.col("p_type"), "shelf_state": size, "sale_state": size,
        "tax_code": F.concat(F.lit("SL0"), size, F.lit("_SYS")), "assess_code": size, "buyer_id": size, "creator_id": size, "creator_name": F.col("p_brand"), "size": F.col("p_name"),
        "content": F.when(F.col("p_size") > 20, F.col("p_name")).otherwise(""), "nature": size, "disabled": size, "grade": size, "links": F.col("p_name"),
    }
    empty = [
        "specification", "shipper", "bar_code", "mnemonic", "supplier_code", "description", "old_code", "market_price", "transfer_price", "reference_price", "remark", "dept_id", "examiner_id",
        "gross_weight", "weight", "affects_price", "affects_cost", "manager_id", "min_order", "delivery_days",
    ]
    none = F.lit(None).cast("string")
    staff = nation.select(_text("n_nationkey").alias("id"), _text("n_nationkey").alias("code"), F.col("n_name").alias("name"))
    second = F.get(F.split("p_name", " "), F.lit(1))
    frames = {
        "materials": part.select(*[col.alias(k) for k, col in known.items()], *[none.alias(k) for k in empty]),
        "categories": _categories(t),
        "platforms": part.select(second.alias("code"), second.alias("name")).distinct(),
        "brands": part.select(F.col("p_size").alias("brand_id")).distinct().join(supplier, F.col("brand_id") == F.col("s_suppkey"), "left").select(
            "brand_id", F.concat(F.lit("B"), F.col("brand_id").cast("string")).alias("brand_code"), F.col("s_name").alias("name_en"), none.alias("name_cn")
        ),
        "units": part.select(F.col("p_type").alias("unit_code"), F.concat(F.lit("unit "), "p_type").alias("unit_name")).distinct(),
        "assess_types": t["region"].select(_text("r_regionkey").alias("code"), F.col("r_name").alias("name")),
        "depts": staff, "employees": staff, "managers": staff.select("id", "name"),
    }
    out = c.material_catalogue(frames, "PROMO", sep=" ")
    return out.select(
        "code", *[f"category_{n}{e}" for n in (4, 3, 2, 1) for e in ("_code", "")], "name", "platforms", "price", "brand_code", "brand", "unit", "shelf_state", "sale_state", "tax_rate",
        "assess_type", "buyer", "length", "width", "height", "has_picture", "creator", "nature", "disabled", "grade", "link1", "link4",
    )


def _ledger(t: Tables, period: str, whole_year: bool) -> DataFrame:
    orders = t["orders"]
    money_cols = [dec("o_totalprice").alias(n) for n in ("debit", "credit", "ending")]
    frames = {
        "balances": orders.select(
            F.col("o_orderdate").alias("period"), F.col("o_custkey").alias("company_id"), F.col("o_orderstatus").alias("account_id"),
            F.substring("o_orderpriority", 1, 1).alias("currency_id"), F.when(F.col("o_orderstatus") == "P", "1").otherwise("5").alias("balance_type"), *money_cols,
        ),
        "companies": t["customer"].select(F.col("c_custkey").alias("company_id"), F.col("c_mktsegment").alias("company_no"), F.col("c_name").alias("company_name")),
        "accounts": orders.select(F.col("o_orderstatus").alias("account_id"), F.concat(F.lit("account "), "o_orderstatus").alias("account_name"), F.lower("o_orderstatus").alias("account_no")).distinct(),
        "currencies": orders.select(F.substring("o_orderpriority", 1, 1).alias("currency_id"), F.col("o_orderpriority").alias("currency_no")).distinct(),
    }
    return c.ledger_balances(frames, period, "1-URGENT", "5", "MACHINERY", whole_year)


def _ledger_sql(period: str) -> str:
    price = ", ".join(f"CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(19,4)) AS {n}" for n in ("debit", "credit", "ending"))
    return f"""SELECT c_name AS company_name, strftime(o_orderdate, '%Y%m') AS period, 'account ' || o_orderstatus AS account_name, lower(o_orderstatus) AS account_no, {price}
        FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority = '1-URGENT' AND o_orderstatus <> 'P' AND c_mktsegment = 'MACHINERY' AND {period}"""


@query("ledger_period", _ledger_sql("strftime(o_orderdate, '%Y%m') = '200007'"))
def ledger_period(t: Tables) -> DataFrame:
    return _ledger(t, "200007", whole_year=False)


@query("ledger_ytd", _ledger_sql("strftime(o_orderdate, '%Y') = '2000'"))
def ledger_ytd(t: Tables) -> DataFrame:
    return _ledger(t, "200007", whole_year=True)


PAY_TIES = ["bill_no", "price_unit_id", "price", "material_id", "supplier_id", "price_qty"]
PAY_OUT = [
    "bill_type", "business_type", "day", "supplier", "bill_no", "currency", "total", "settle_org", "purchase_org", "pay_org", "dept", "buyer", "status", "material_no", "material_name", "price_unit",
    "price", "price_qty", "source_type", "lot_no", "is_free", "stock_unit", "stock_qty", "brand", "category", "seller", "seller_dept", "project_name", "row_id",
]


@query(
    "payables_wide",
    f"""WITH es AS (SELECT {ENTRY_SQL} AS e, min(l_linenumber) AS u, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS {{money}}) AS q, min(l_suppkey) AS lot FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1)
        SELECT 'type ' || o_orderstatus AS bill_type, '其他采购' AS business_type, strftime(o_orderdate, '%Y-%m-%d') AS day, s.s_name AS supplier,
        CAST(o_orderkey AS VARCHAR) AS bill_no, o_orderpriority AS currency, CAST(o_totalprice AS DECIMAL(18,2)) AS total, 'NATION_1' AS settle_org, po.n_name AS purchase_org, pay.n_name AS pay_org, r_name AS dept,
        b.s_name AS buyer, '已审核' AS status, CAST(p_partkey AS VARCHAR) AS material_no, p_name AS material_name, pu.n_name AS price_unit, {{amt}} AS price, CAST(l_quantity AS DECIMAL(18,2)) AS price_qty,
        CASE l_returnflag WHEN 'A' THEN '采购入库单' ELSE '未知源单类型' END AS source_type, lot.s_name AS lot_no, CASE es.u WHEN 1 THEN '是' ELSE '未知' END AS is_free, su.n_name AS stock_unit, es.q AS stock_qty,
        p_brand AS brand, p_type AS category, c_name AS seller, so.n_name AS seller_dept, p_name AS project_name,
        row_number() OVER (ORDER BY strftime(o_orderdate, '%Y-%m-%d'), CAST(o_orderkey AS VARCHAR), l_linenumber, {{amt}}, l_partkey, l_suppkey, l_quantity) AS row_id
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN lineitem ON o_orderkey = l_orderkey LEFT JOIN es ON e = {ENTRY_SQL} LEFT JOIN part ON l_partkey = p_partkey
        LEFT JOIN supplier s ON l_suppkey = s.s_suppkey LEFT JOIN supplier b ON l_linenumber = b.s_suppkey LEFT JOIN supplier lot ON es.lot = lot.s_suppkey LEFT JOIN nation so ON c_nationkey = so.n_nationkey
        LEFT JOIN nation po ON CAST(substring(o_orderpriority, 1, 1) AS INTEGER) = po.n_nationkey LEFT JOIN region pr ON so.n_regionkey = pr.r_regionkey LEFT JOIN nation pay ON so.n_regionkey = pay.n_nationkey
        LEFT JOIN nation pu ON l_linenumber = pu.n_nationkey LEFT JOIN nation su ON es.u = su.n_nationkey WHERE o_orderstatus <> 'P' AND c_nationkey < 20""",
)
def payables_wide(t: Tables) -> DataFrame:
    part, supplier, nation, orders = t["part"], t["supplier"], t["nation"], t["orders"]
    rows, none = lines(t), F.lit(None).cast("string")
    head = orders.join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    headers = head.select(
        F.col("o_orderkey").alias("bill_id"), _text("o_orderkey").alias("bill_no"), F.col("o_orderstatus").alias("bill_type_id"), F.col("o_orderstatus").alias("business_type"),
        day_text("o_orderdate").alias("day"), none.alias("due_day"), F.col("o_orderpriority").alias("currency_id"), dec("o_totalprice").alias("total"),
        F.when(F.col("c_nationkey") < 20, "1").otherwise("2").alias("settle_org_id"), F.substring("o_orderpriority", 1, 1).alias("purchase_org_id"), _text("n_regionkey").alias("pay_org_id"),
        F.col("n_regionkey").alias("dept_id"), F.col("o_custkey").alias("seller_id"), F.when(F.col("o_orderstatus") != "P", "C").otherwise("A").alias("status"),
    )
    unused = [
        "net_tax_price", "tax_rate", "comment", "discount_rate", "source_no", "order_no", "discount", "net_amount", "tax", "amount", "base_qty", "local_tax", "local_amount", "local_net",
        "paid", "sale_order_no", "reference_price", "transfer_diff",
    ]
    # Supplier and buyer sit on the lines of the test data, the seller on the header.
    number = ("price_unit_id", "stock_id", "division_id", "bin_id", "buyer_id")
    entries = rows.select(
        F.col("l_orderkey").alias("bill_id"), entry_id().alias("entry_id"), F.col("l_partkey").alias("material_id"), F.col("amt").alias("price"), F.col("qty").alias("price_qty"), F.col("amt").alias("tax_price"),
        F.when(F.col("l_returnflag") == "A", "STK_InStock").otherwise(F.col("l_returnflag")).alias("source_type"), F.col("l_partkey").alias("project_id"), F.col("l_suppkey").alias("supplier_id"),
        *[F.col("l_linenumber").alias(n) for n in number], *[none.alias(n) for n in unused],
    )

    def named(frame: DataFrame, key: str, name: str, out: str) -> DataFrame:
        return frame.select(F.col(key).alias(f"{out}_id"), F.col(name).alias(f"{out}_name")).distinct()

    stored = rows.where("l_returnflag <> 'R'").groupBy(entry_id().alias("entry_id")).agg(
        F.min("l_linenumber").alias("stock_unit_id"), money(F.sum("qty")).alias("stock_qty"), F.min("l_suppkey").alias("lot_id")
    )
    frames = {
        "headers": headers, "entries": entries,
        "entry_stock": stored.withColumns({"is_free": _text("stock_unit_id"), "stock_base_qty": F.col("stock_qty")}),
        "bill_types": orders.select(F.col("o_orderstatus").alias("bill_type_id"), F.concat(F.lit("type "), "o_orderstatus").alias("bill_type_name")).distinct(),
        "suppliers": named(supplier, "s_suppkey", "s_name", "supplier"), "currencies": named(orders, "o_orderpriority", "o_orderpriority", "currency"),
        "orgs": nation.select(_text("n_nationkey").alias("org_id"), F.col("n_name").alias("org_name")), "depts": named(t["region"], "r_regionkey", "r_name", "dept"),
        "buyers": supplier.select(F.col("s_suppkey").alias("buyer_id"), F.col("s_name").alias("buyer_name"), _text("s_suppkey").alias("buyer_no")),
        "materials": part.select(
            F.col("p_partkey").alias("material_id"), _text("p_partkey").alias("material_no"), none.alias("specification"), F.col("p_name").alias("material_name"), none.alias("description"),
            F.col("p_brand").alias("brand_id"), F.col("p_type").alias("category_id"),
        ),
        "units": named(nation, "n_nationkey", "n_name", "unit"), "lots": supplier.select(F.col("s_suppkey").alias("lot_id"), F.col("s_name").alias("lot_no")),
        "brands": named(part, "p_brand", "p_brand", "brand"), "stocks": named(nation, "n_nationkey", "n_name", "stock"),
        "sellers": head.select(F.col("o_custkey").alias("seller_id"), F.col("c_name").alias("seller_name"), F.col("n_name").alias("dept_name")).distinct(),
        "projects": part.select(F.col("p_partkey").alias("project_id"), _text("p_partkey").alias("project_no"), F.col("p_name").alias("project_name"), none.alias("ratio")),
        "divisions": named(nation, "n_nationkey", "n_name", "division"), "bins": named(nation, "n_nationkey", "n_name", "bin"), "categories": named(part, "p_type", "p_type", "category"),
    }
    return c.payables_wide(frames, "1", PAY_TIES).withColumn("row_id", big("row_id")).select(*PAY_OUT)


def _platform_frames(t: Tables) -> dict[str, DataFrame]:
    orders, part = t["orders"], t["part"]
    rows = lines(t).join(part.select("p_partkey", "p_size"), F.col("l_partkey") == F.col("p_partkey"), "left")
    number = lambda factor: F.concat(F.lit("'"), (F.col("p_partkey") * factor).cast("string"), F.lit("'"))
    gross = F.when(F.col("p_size") > 45, F.lit(0)).otherwise(dec("l_extendedprice", 12)).cast("decimal(12,2)")
    lookup = t["nation"].select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    headers = orders.select(
        F.col("o_orderkey").alias("bill_id"), F.col("o_orderstatus").alias("org_id"), F.when(F.col("o_orderpriority") == "5-LOW", "A").otherwise("C").alias("status"), F.col("o_orderdate").alias("approved_at")
    )
    amounts = lambda flag: lines(t).where(f"l_returnflag = '{flag}'").select(F.col("l_orderkey").alias("bill_id"), F.col("l_partkey").alias("project_id"), F.col("amt").alias("amount"))
    return {
        "hand_orders": purchases(t).select(
            F.col("ts").cast("timestamp").alias("order_time"), F.concat(F.lit("E"), _text("event_id")).alias("order_id"), dec("value").alias("price"), F.col("event_type").alias("title"), F.lit("east").alias("region")
        ),
        "platform_orders": orders.select(
            F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("timestamp").alias("order_time"),
            F.when(F.col("o_orderstatus") == "F", (F.col("o_orderdate") + F.expr("INTERVAL 2 DAYS")).cast("timestamp")).when(F.col("o_orderstatus") == "P", F.lit("1900-01-01").cast("timestamp")).alias("examine_time"),
            _text("o_orderkey").alias("order_id"), dec("o_totalprice").alias("price"), F.col("o_orderpriority").alias("title"), F.col("o_orderpriority").alias("address"), F.lit("1").alias("state"),
            F.col("o_orderstatus").alias("channel"), F.substring("o_orderpriority", 1, 1).alias("order_state"),
        ),
        "returns": orders.select(F.col("o_orderkey").alias("return_id"), F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") == "P", "0").otherwise("1").alias("state")),
        "return_lines": lines(t).where("l_returnflag = 'R'").select(
            F.col("l_orderkey").alias("return_id"), F.when(F.col("l_linestatus") == "F", "1").otherwise("0").alias("state"), dec("l_quantity", 6).alias("qty"), dec("l_discount", 6).alias("sell_price")
        ),
        "tickets": part.select(
            F.col("p_partkey").alias("bill_id"), F.concat(F.lit("T"), _text("p_partkey")).alias("project_no"), F.col("p_type").alias("project_name"),
            F.when(F.col("p_size") > 5, F.concat_ws("、", number(1), number(7))).alias("customer_orders"), F.col("p_size").alias("seller_id"), F.col("p_brand").alias("created_at"),
        ),
        "ticket_entries": lines(t).select(F.col("l_partkey").alias("bill_id"), F.col("amt").alias("tax_amount"), F.col("qty").alias("amount")),
        "sellers": lookup.select(F.col("id").alias("seller_id"), F.col("name").alias("seller_name")),
        "mappings": part.where("p_size = 20").select(F.concat(F.lit("T"), _text("p_partkey")).alias("project_no"), F.concat(F.lit("E"), _text("p_partkey")).alias("customer_order")),
        "headers": headers, "receipts": headers, "refunds": headers, "receipt_entries": amounts("N"), "refund_entries": amounts("R"),
        "entries": rows.select(
            F.col("l_orderkey").alias("bill_id"), F.col("l_partkey").alias("project_id"), F.col("l_partkey").alias("material_id"), F.col("l_linenumber").alias("unit_id"),
            F.when(F.col("l_linenumber") == 1, "").otherwise(_text("l_orderkey")).alias("order_no"), dec("l_quantity", 6).alias("qty"), dec("l_extendedprice", 12).alias("price"), gross.alias("tax_price"),
            dec("l_quantity").alias("cost"),
        ),
        "projects": part.select(F.col("p_partkey").alias("project_id"), F.concat(F.lit("T"), _text("p_partkey")).alias("project_no"), F.when(F.col("p_size") > 10, _text("p_size")).otherwise("0").alias("ratio")),
        "orgs": orders.select(F.col("o_orderstatus").alias("org_id"), F.concat(F.lit("org "), "o_orderstatus").alias("org_name")).distinct(),
        "materials": part.select(F.col("p_partkey").alias("material_id"), _text("p_partkey").alias("material_no"), F.col("p_name").alias("material_name"), F.col("p_type").alias("specification"), F.col("p_brand").alias("brand")),
        "units": lookup.select(F.col("id").alias("unit_id"), F.col("name").alias("unit_name")),
        "sale_orders": orders.select(_text("o_orderkey").alias("order_no"), F.col("o_orderpriority").alias("address"), _text("o_custkey").alias("consignee"), F.col("o_orderstatus").alias("phone")),
    }


LEVELS = [[("URGENT", "north"), ("HIGH", "south")], [("MEDIUM", "west")]]
PROJECTS = ["ECONOMY", "SMALL", "PROMO"]


def _recon(t: Tables, f: dict[str, DataFrame]) -> DataFrame:
    orders = pf.platform_orders(f, LEVELS, ["F", "P"], "1996-01-01", ["3", "9"])
    return pf.platform_recon(orders, pf.project_orders(f, PROJECTS), pf.project_settlements(f, ["org F"], "org O"))


RECON_SQL = f"""po AS (SELECT ts AS order_time, 'E' || event_id AS order_id, CAST(value AS {{money}}) AS price, event_type AS title, 'east' AS region FROM events WHERE event_type = 'purchase'
        UNION ALL SELECT CASE WHEN CAST(o_orderkey AS VARCHAR) LIKE '2%' OR o_orderstatus = 'P' OR o_orderdate + INTERVAL 2 DAY < TIMESTAMP '2000-01-01' THEN o_orderdate ELSE o_orderdate + INTERVAL 2 DAY END,
            CAST(o_orderkey AS VARCHAR), CAST(CAST(o_totalprice AS DECIMAL(18,2)) - CASE WHEN o_orderstatus = 'F' THEN coalesce(back, 0) ELSE 0 END AS {{money}}), o_orderpriority,
            CASE o_orderpriority WHEN '1-URGENT' THEN 'north' WHEN '2-HIGH' THEN 'south' WHEN '3-MEDIUM' THEN 'west' ELSE '' END
            FROM orders LEFT JOIN (SELECT l_orderkey AS k, sum(CAST(l_quantity AS DECIMAL(6,2)) * CAST(l_discount AS DECIMAL(6,2))) AS back FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F' GROUP BY 1) ON k = o_orderkey
            WHERE o_orderstatus IN ('F', 'P') AND o_orderdate >= DATE '1996-01-01' AND o_orderpriority NOT LIKE '3%'),
    proj AS (SELECT CASE WHEN p_size = 20 THEN 'E' || p_partkey ELSE o END AS customer_order, 'T' || p_partkey AS project_no, n_name AS seller, p_brand AS created_at,
        CAST(sum(ta) AS {{money}}) AS ta, CAST(sum(a) AS {{money}}) AS a
        FROM (SELECT *, unnest(CASE WHEN p_size > 5 THEN [CAST(p_partkey AS VARCHAR), CAST(p_partkey * 7 AS VARCHAR)] ELSE [''] END) AS o FROM part WHERE p_type IN ('ECONOMY', 'SMALL', 'PROMO'))
        JOIN (SELECT l_partkey, CAST(sum({{amt}}) AS {{money}}) AS ta, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS {{money}}) AS a FROM lineitem GROUP BY 1) ON l_partkey = p_partkey LEFT JOIN nation ON p_size = n_nationkey
        GROUP BY p_partkey, p_size, o, n_name, p_brand),
    x AS (SELECT 'T' || p_partkey AS project_no, o_orderstatus AS st, l_returnflag AS rf, CASE WHEN p_size > 10 THEN p_size ELSE 0 END AS ratio, CAST(l_quantity AS DECIMAL(18,2)) AS cost, {{amt}} AS amount,
        CAST(l_quantity AS DECIMAL(6,2)) * CAST(l_extendedprice AS DECIMAL(12,2)) AS net, CAST(l_quantity AS DECIMAL(6,2)) * CASE WHEN p_size > 45 THEN 0 ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END AS gross
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey WHERE o_orderpriority <> '5-LOW'),
    st AS (SELECT project_no, CAST(sum({ratio_sql('gross', 'ratio')}) FILTER (st = 'F') AS {{money}}) AS small_tax_amount, CAST(sum({ratio_sql('net', 'ratio')}) FILTER (st = 'F') AS {{money}}) AS small_amount,
        CAST(sum(cost) FILTER (st = 'F') AS {{money}}) AS small_cost, CAST(sum(gross) FILTER (st = 'O') AS {{money}}) AS big_tax_amount,
        CAST(sum(amount) FILTER (st = 'O' AND rf = 'N') AS {{money}}) AS paid, CAST(sum(amount) FILTER (st = 'O' AND rf = 'R') AS {{money}}) AS refunded FROM x GROUP BY 1),
    recon AS (SELECT order_time, order_id, price, title, region, proj.project_no, ta, a, seller, created_at, st.* EXCLUDE (project_no)
        FROM po FULL JOIN proj ON order_id = customer_order LEFT JOIN st ON proj.project_no = st.project_no WHERE proj.project_no IS NULL OR trunc(coalesce(big_tax_amount, 1)) <> 0)"""


@query(
    "platform_recon",
    f"""WITH {RECON_SQL} SELECT strftime(order_time, '%Y-%m-%d') AS order_time, order_id, price, title, region, project_no, ta AS project_tax_amount, a AS project_amount, seller, created_at,
        small_tax_amount, small_amount, small_cost, big_tax_amount, paid, refunded FROM recon""",
)
def platform_recon(t: Tables) -> DataFrame:
    return _recon(t, _platform_frames(t)).withColumn("order_time", day_text("order_time"))


@query(
    "platform_recon_lines",
    f"""WITH {RECON_SQL} SELECT 'T' || p_partkey AS project_no, CAST(p_partkey AS VARCHAR) AS material_no, p_brand AS brand, p_name AS material_name, p_type AS specification, n_name AS unit,
        round(CAST(CASE WHEN p_size > 45 THEN 0 WHEN p_size > 10 THEN l_extendedprice / p_size * 100 ELSE l_extendedprice END AS DOUBLE), 6) AS unit_tax_price, CAST(l_quantity AS DECIMAL(6,2)) AS qty,
        CAST({ratio_sql('CAST(l_quantity AS DECIMAL(6,2)) * CASE WHEN p_size > 45 THEN 0 ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END', '(CASE WHEN p_size > 10 THEN p_size ELSE 0 END)')} AS DECIMAL(19,10)) AS tax_amount,
        CASE WHEN l_linenumber <> 1 THEN o_orderpriority END AS address, CASE WHEN l_linenumber <> 1 THEN CAST(o_custkey AS VARCHAR) END AS consignee, CASE WHEN l_linenumber <> 1 THEN o_orderstatus END AS phone,
        CASE WHEN l_linenumber = 1 THEN '' ELSE CAST(l_orderkey AS VARCHAR) END AS order_no, strftime(o_orderdate, '%Y-%m-%d') AS approved_at
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey LEFT JOIN nation ON l_linenumber = n_nationkey
        WHERE o_orderpriority <> '5-LOW' AND o_orderstatus = 'F' AND 'T' || p_partkey IN (SELECT project_no FROM recon WHERE project_no IS NOT NULL)""",
)
def platform_recon_lines(t: Tables) -> DataFrame:
    f = _platform_frames(t)
    out = pf.platform_recon_lines(f, _recon(t, f), ["org F"])
    return out.withColumns({"unit_tax_price": rounded("unit_tax_price", 6), "approved_at": day_text("approved_at")})


@query(
    "unit_mismatch",
    """SELECT o_orderkey AS code, c.n_name AS unit, s.n_name AS other_unit FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation c ON c_nationkey = c.n_nationkey
       JOIN lineitem ON o_orderkey = l_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation s ON s_nationkey = s.n_nationkey WHERE c.n_name <> s.n_name AND l_returnflag <> 'R'""",
)
def unit_mismatch(t: Tables) -> DataFrame:
    nation = t["nation"].select(F.col("n_nationkey").alias("nk"), F.col("n_name").alias("unit"))
    ours = t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("nk"))
    theirs = t["lineitem"].join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey")).join(nation, F.col("s_nationkey") == F.col("nk"))
    unit = F.when(F.col("l_returnflag") != "R", F.col("unit"))
    return c.unit_mismatch(ours.select(F.col("o_orderkey").alias("code"), "unit"), theirs.select(F.col("l_orderkey").alias("code"), unit.alias("unit")))
