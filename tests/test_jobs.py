"""Jobs on small frames: the rules the shared tables do not show."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import codes
from ledgerloom.plans import catalogue, flatten, platform, procurement, receivables, sales, stock


def frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


@pytest.mark.parametrize("name", list(flatten.DOCUMENTS))
def test_every_document_flattens(spark, name):
    """Two headers, one with two entries (satellite on one of them), one without."""
    spec = flatten.DOCUMENTS[name]

    def table(cols, *data):
        cols = list(dict.fromkeys(cols))
        return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in data], ", ".join(f"{c} string" for c in cols))

    entry_cols = ["bill_id", *spec.entry_cols, *(s.key for s in spec.satellites)]
    t = {
        spec.header: table(spec.header_cols, {"bill_id": "1", "bill_no": "A"}, {"bill_id": "2", "bill_no": "B"}),
        spec.entry: table(entry_cols, {"bill_id": "1", "entry_id": "10", "lot_id": "L"}, {"bill_id": "1", "entry_id": "11"}),
    }
    for sat in spec.satellites:
        t[sat.table] = table([sat.key, *sat.take], {sat.key: {"entry_id": "10", "lot_id": "L"}[sat.key], **{c: "x" for c in sat.take}})
    out = flatten.flatten_document(t, spec)
    assert len(out.columns) == len(set(out.columns))
    got = {(r["bill_no"], r["entry_id"]): r for r in out.collect()}
    assert set(got) == {("A", "10"), ("A", "11"), ("B", None)}
    for sat in spec.satellites:
        assert got[("A", "10")][sat.take[0]] == "x"
        assert got[("A", "11")][sat.take[0]] is None


def test_the_flat_sales_order_feeds_the_report(spark):
    """Every line column the report reads is in the flat table; the amount is the gross one."""
    flat = flatten.DOCUMENTS["sale_order"]
    cols = {*flat.header_cols, *flat.entry_cols, *(c for s in flat.satellites for c in s.take)}
    needed = {
        "created_at", "bill_id", "bill_no", "entry_id", "org_id", "project_id", "creator_id", "seller_id", "operator_id", "unit_id", "material_id", "customer_id", "qty",
        "tax_price", "amount", "gross_amount", "consignee", "phone", "address", "purchase_type", "termination", "agent_flag", "note", "status", "order_type",
    }
    assert needed <= cols


def test_staff_directory(spark, rows):
    schema = "id string, name string, name_pinyin string, parent_id string, org_type string, available int"
    elements = frame(
        spark, schema,
        ("c", "Company", None, None, "1", 1), ("d", "Dept", None, "c", "2", 1), ("x", "Closed", None, "c", "2", 0),
        ("p1", "Ann", "ann", "d", "8", 1), ("p2", "Bob", "bob", "d", "8", 0), ("p3", "Cy", "cy", "x", "8", 1),
    )
    contacts = frame(spark, "id string, mobile string, email string", ("p1", "1", "a@x"))
    got = rows(flatten.staff_directory(elements, contacts), "dept_name", "parent_name", "name", "mobile")
    assert got == [("Company", None, None, None), ("Dept", "Company", "Ann", "1")]


def test_payment_status_drops_internal_and_nameless_customers(spark, rows):
    base = frame(
        spark, "project_no string, project_name string, seller_name string, seller_no string, customer_name string, amount double",
        ("P1", "p", "s", "1", "out", 100.0), ("P1", "p", "s", "1", " inner ", 900.0), ("P2", "q", "s", "1", "out", 50.0), ("P3", "r", "s", "1", None, 5.0),
    )
    got = frame(
        spark, "project_no string, customer_name string, day string, amount double",
        ("P1", "out", "2023-01-02", 30.0), ("P1", "out", "2023-01-05", 10.0), ("P1", "inner", "2023-09-09", 99.0), (None, "out", "2023-01-01", 1.0),
    )
    out = receivables.payment_status(base, got, ["inner"])
    assert rows(out, "project_no", "status", "due", "received", "difference", "last_day") == [
        ("P1", codes.PART_PAID, D("100.00"), D("40.00"), D("60.00"), "2023-01-05"),
        ("P2", codes.UNPAID, D("50.00"), D("0.00"), D("50.00"), ""),
    ]


def test_invoice_status_latest_day(spark, rows):
    tickets = frame(spark, "ticket_id int, ticket_no string, close_code string, invoiced double, open_amount double", (1, "T1", "A", 5.0, 5.0), (2, "T2", None, None, 1.0))
    invoices = frame(spark, "ticket_no string, invoiced_on string", ("T1", "2023-01-01"), ("T1", "2023-03-01"), (None, "2024-01-01"))
    out = receivables.invoice_status(tickets, invoices)
    assert rows(out, "ticket_id", "close_status", "status", "last_invoice") == [
        (1, codes.CLOSE_STATUS["A"], codes.PART_INVOICED, "2023-03-01"), (2, codes.UNKNOWN, codes.NOT_INVOICED, ""),
    ]


@pytest.mark.parametrize("invoiced, projects", [([("P1", 10.0)], ["P1", "P2"]), ([("P9", 1.0)], ["P1", "P2", None])])
def test_board_v2_drops_missing_projects_only_next_to_earlier_invoices(spark, invoiced, projects):
    money = "project_no string, amount double"
    shipped = frame(
        spark, "seller string, project_no string, project_name string, form string, short_name string, first_day string, amount decimal(19,2)",
        ("s", "P1", "a", "f", "n", "2023-01-01", D("100")), ("s", "P2", "b", "f", "n", "2023-01-01", D("50")), ("s", None, "c", "f", "n", "2023-01-01", D("5")),
    )
    out = receivables.receivable_board_v2(
        shipped, frame(spark, money, *invoiced), frame(spark, "project_no string, day string, amount double", ("P1", "2022-06-01", 7.0)),
        frame(spark, money, ("P2", 60.0)), frame(spark, money, ("P2", 2.0)), frame(spark, "project_no string, first_day string, amount double", ("P2", "2023-02-01", 20.0)),
        frame(spark, "project_no string, seller string", ("P1", "ann")), "2023-03-01",
    )
    got = {r["project_no"]: r for r in out.collect()}
    assert sorted(got, key=str) == sorted(projects, key=str)
    # Earlier invoices: 100 shipped less 10, plus the opening ledger.
    assert got["P1"]["amount"] == (D("97.00") if invoiced[0][0] == "P1" else D("100.00"))
    # More received than shipped floors at zero.
    assert (got["P2"]["open_amount"], got["P2"]["year_amount"], got["P2"]["inv_open_amount"]) == (D("0.00"), D("58.00"), D("0.00"))
    assert (got["P1"]["seller"], got["P1"]["inv_day"], got["P1"]["inv_aging"], got["P1"]["update_month"]) == ("ann", "2022-06-01", 273, "2023-02")


def test_hand_ledger_and_opening_invoices(spark, rows):
    schema = "project_no string, seller string, project_name string, short_name string, day string, amount double, org_level string"
    ledger = frame(spark, schema, ("P", "s", "n", "A-Grid", "2023/1/5", 1.0, "1"), ("P", "s", "n", "B-Grid", "2023/1/15", 2.0, "1"), ("P", "s", "n", "A-Grid", "2023/1/1", 4.0, " "), ("P", "s", "n", "x", "?", 8.0, None))
    assert rows(receivables.hand_ledger(ledger), "project_no", "short_name", "day", "amount") == [("P", "Grid", "2023/1/15", D("3.00"))]
    # Days are typed by hand: compared as dates, not as text.
    assert rows(receivables.opening_invoices(ledger)) == [("P", "2023-01-15", D("15.00"))]


def test_net_receipts_from_either_side(spark, rows):
    a = frame(spark, "k string, amount int", ("x", 5), ("y", 7), (None, 1))
    b = frame(spark, "k string, amount int", ("x", 2), ("z", 3), (None, 4))
    assert rows(receivables.net_receipts(a, b, ["k"])) == [(None, -4), (None, 1), ("x", 3), ("y", 7), ("z", -3)]


def test_per_project_keeps_or_merges_organisations(spark, rows):
    lines = frame(spark, "project_no string, org_id string, amount int", ("P", "1", 5), ("P", "2", 6), ("Q", "1", 1))
    assert rows(receivables.per_project(lines, merge_scopes=False, sign=-1)) == [("P", D("-5.00")), ("P", D("-6.00")), ("Q", D("-1.00"))]
    assert rows(receivables.per_project(lines)) == [("P", D("11.00")), ("Q", D("1.00"))]


def board_lines(spark):
    schema = (
        "entry_seller string, company string, dept string, business_day string, address string, agent_flag string, project_no string, online string, short_name string,"
        " net_amount double, tax_amount double, ratio string, cost double"
    )
    return frame(
        spark, schema,
        ("s", "c", "d", "2023-01-01", "杭州 1", None, "P", "是", None, 10.0, 11.0, "50", 1.0),
        ("s", "c", "d", "2023-01-01", "浙江 2", None, "P", "是", None, 10.0, 11.0, "", 1.0),
        ("s", "c", "d", "2023-01-01", None, "1", "AGP", None, "n", 1.0, 1.0, None, 1.0),
        ("s", "c", "d", "2023-01-01", None, "0", "AGP", None, "n", 1.0, 1.0, "0", 1.0),
    )


def test_sales_board_rows_per_address_or_region(spark, rows):
    levels = [[("浙江", "浙江")], [("杭州", "浙江")]]
    short = frame(spark, "company string, company_short string", ("c", "C"))
    each = receivables.sales_board(board_lines(spark), levels, short, "AG")
    assert rows(each, "region", "form", "online", "short_name", "amount") == [
        ("", codes.SELF_RUN, codes.OFFLINE, "n", D("1.00")), ("", codes.AGENT_RUN, codes.OFFLINE, "n", D("1.00")),
        ("浙江", codes.SELF_RUN, codes.ONLINE, codes.OTHER, D("10.00")), ("浙江", codes.SELF_RUN, codes.ONLINE, codes.OTHER, D("20.00")),
    ]
    merged = receivables.sales_board(board_lines(spark), levels, short, "AG", by_address=False)
    assert rows(merged.where("region <> ''"), "amount", "tax_amount", "cost") == [(D("30.00"), D("33.00"), D("2.00"))]


def test_margin_lines_meet_header_and_lookups(spark, rows):
    """Each line has the names of its payer and its contact; a tax that does not fit matters only where its line stays."""
    money = "decimal(18,2)"
    t = {
        "headers": frame(spark, "bill_id int, created_at string, customer_id int, org_id int, order_type string, status string", (1, "m", 7, 1, "2", "C"), (2, "m", None, 1, "2", "C"), (3, "m", 7, 1, "2", "A")),
        "entries": frame(
            spark, f"bill_id int, entry_id int, project_id int, contact_id int, material_id int, qty {money}, tax_percent decimal(19,6), amount {money}",
            (1, 1, 5, 8, 6, D("2"), D("13"), D("9")), (1, 2, 5, None, 6, None, None, None), (2, 1, 5, 7, 6, D("1"), D("0"), D("1")),
            (2, 2, 99, 7, 6, D("1"), D("99999"), D("1")), (3, 1, 5, 8, 6, D("1"), D("99999"), D("1")),
        ),
        "costs": frame(spark, f"bill_id int, entry_id int, cost {money}", (1, 1, D("4"))),
        "projects": frame(spark, "project_id int, project_no string, project_name string, ratio string, owner_org_id int, use_org_id int", (5, "P", "p", "50", 1, 2)),
        "orgs": frame(spark, "org_id int, org_no string", (1, "a"), (2, "b")),
        "customers": frame(spark, "customer_id int, customer_name string", (7, "payer"), (8, "contact")),
        "materials": frame(spark, "material_id int, material_no string, material_name string, specification string, material_group string, brand string, brand_type string", (6, "M", "n", "s", "g", "b", "t")),
    }
    out = sales.margin_lines(t)
    assert rows(out, "contact_name", "customer_name", "agent_rate", "qty", "tax", "amount", "cost") == [
        (None, "payer", D("0.500000"), D("1.00"), D("0.0000"), D("1.00"), D("0.00")),
        ("payer", None, D("0.500000"), D("0.00"), D("0.0000"), D("0.00"), D("0.00")),
        ("payer", "contact", D("0.500000"), D("2.00"), D("0.1300"), D("9.00"), D("4.00")),
    ]
    t["projects"] = t["projects"].unionByName(t["projects"].withColumn("project_id", F.lit(99)))
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        sales.margin_lines(t).collect()


def test_gross_margin_guards(spark):
    schema = "project_no string, agent_rate double, tax double, qty int, amount double, cost double"
    data = frame(spark, schema, ("A", 0.0, 0.13, 0, 113.0, 60.0), ("B", 0.5, 0.0, 4, 100.0, 999.0), ("C", 0.0, None, 2, 10.0, 4.0))
    got = {r["project_no"]: r for r in sales.gross_margin(data, keys=["project_no"]).collect()}
    assert (got["A"]["net_sale_price"], got["A"]["gross_margin"]) == (100.0, 40.0)  # zero quantity divides by one
    assert (got["B"]["tax_sale_amount"], got["B"]["net_cost_amount"], got["B"]["tax_sale_price"]) == (200.0, 100.0, 50.0)
    assert (got["C"]["net_sale_amount"], got["C"]["net_cost_price"]) == (10.0, 2.0)


def test_daily_workload_is_keyed_to_requests(spark, rows):
    doc, pay = "day string, buyer string", "day string, buyer string, pay_type string, amount int"
    out = procurement.daily_workload(
        frame(spark, doc, ("d1", "a"), ("d1", "a")), frame(spark, doc, ("d1", "a"), ("d2", "b")), frame(spark, doc, ("d2", "b")), frame(spark, pay, ("d2", "b", "cash", 3), ("d1", "a", "card", 4))
    )
    assert rows(out) == [
        (None, "d2", "b", None, None, None, 1, None), (None, "d2", "b", "cash", None, None, None, 3),
        ("d1", "d1", "a", "card", 2, 1, None, 4), ("d2", None, "b", None, None, 1, None, None),
    ]


def test_timeline_of_one_chain(spark):
    """One requisition of 10: bought 6, received 4; its sales order sold 12."""
    ts = "2023-01-0{} 00:00:00".format
    text = lambda cols: ", ".join(f"{c} string" for c in cols)
    req = {"bill_id": "r", "entry_id": "1", "source_bill_id": "s", "source_entry_id": "1", "req_no": "R", "req_status": "C", "req_created": ts(1), "req_approved": ts(2)}
    pur = {"bill_id": "p", "entry_id": "1", "req_bill_id": "r", "req_entry_id": "1", "pur_no": "P", "pur_status": "A", "pur_approved": ts(4)}
    rec = {"pur_bill_id": "p", "pur_entry_id": "1", "receipt_no": "I", "lot_no": "L", "material_id": "m", "receipt_approved": ts(5)}
    sale = {"bill_id": "s", "entry_id": "1", "sale_no": "S", "sale_created": ts(1), "sale_approved": ts(1)}

    def table(values, extra, qty):
        cols = list(dict.fromkeys([*values, *extra]))
        return spark.createDataFrame([(*(values.get(c) for c in cols), qty)], text(cols) + ", qty int")

    move = "lot_no string, material_id string, bill_no string, created_at string, approved_at string, qty int"
    t = {
        "requisitions": table(req, procurement.REQ_COLS, 10), "purchases": table(pur, procurement.PUR_COLS, 6), "receipts": table(rec, procurement.REC_COLS, 4),
        "sale_orders": table(sale, ["customer_order_no"], 12),
        "notices": frame(spark, move, ("L", "m", "N1", ts(5), None, 1), ("L", "m", "N2", ts(4), ts(6), 2), ("", "m", "N3", ts(9), ts(9), 9)),
        "shipments": frame(spark, move, ("L", "m", "O1", ts(7), ts(7), 3)),
    }
    out = procurement.procure_timeline(t).collect()
    got = sorted((r["req_no"] or "", r["pur_no"] or "", r["receipt_no"] or "", r["sale_qty"], r["req_qty"], r["pur_qty"], r["received_qty"]) for r in out)
    assert got == [
        ("", "", "", 2, None, None, None),  # sold and not requested
        ("R", "", "", 4, 4, None, None),  # requested and not bought
        ("R", "P", "", 2, 2, 2, None),  # bought and not received
        ("R", "P", "I", 4, 4, 4, 4),
    ]
    full = next(r for r in out if r["receipt_no"] == "I")
    assert (full["notice_bill_no"], full["notice_qty"], full["ship_qty"]) == ("N2", 3, 3)
    assert (full["req_status"], full["pur_status"]) == ("已审核", "创建")
    assert (full["req_days"], full["pur_days"], full["stock_days"], full["sale_days"]) == (1.0, 2.0, 2.0, 0.0)
    written = procurement.procure_timeline(t, as_written=True).collect()
    assert sorted((r["req_no"] or "", r["pur_no"] or "", r["receipt_no"] or "", r["sale_qty"]) for r in written) == [("", "", "", 2), ("R", "", "", 6), ("R", "P", "I", 4)]


def test_lot_unit_cost_rules(spark, rows):
    receipts = frame(
        spark, "material_no string, lot_no string, amount decimal(18,2), qty decimal(18,2)",
        ("a", "1", D("10"), D("4")), ("a", "1", D("9"), D("5")), ("b", "1", D("10"), None), ("c", "1", D("10"), D("0")),
    )
    assert rows(stock.lot_unit_cost(receipts)) == [("a", "1", D("2.00000000000000000000")), ("b", "1", D("0E-20")), ("c", "1", None)]


def test_cost_priority_zero_counts_as_found(spark, rows):
    schema = "material_no string, lot_no string, t string, id int, cost decimal(18,2)"
    first = frame(spark, schema, ("a", "1", "2020", 1, D("5")), ("a", "1", "2021", 2, D("0")), ("b", "1", "2020", 1, None), ("b", "1", None, 9, D("7")))
    second = frame(spark, schema, ("a", "1", "2022", 1, D("8")), ("b", "1", "2020", 1, D("3")), ("c", "1", None, 1, None))
    assert rows(stock.cost_priority({"x": first, "y": second}, "t", ["id"])) == [("a", "1", D("0.00")), ("b", "1", D("3.00")), ("c", "1", D("0.00"))]


def test_lead_time_fans_out_unless_asked(spark):
    text = lambda *cols: ", ".join(f"{c} string" for c in cols)
    purchase_cols = (
        "bill_no", "created_at", "approved_at", "org_id", "source_bill_no", "req_bill_id", "req_entry_id", "supplier_id", "contact_id", "material_id", "qty", "unit_id", "stock_id",
        "creator_id", "dept_id", "seller_id", "order_no", "status",
    )
    base = dict.fromkeys(purchase_cols, "1")
    base |= {"created_at": "2023-01-03 00:00:00", "status": "C"}
    rows_ = [base, base | {"bill_no": "2", "source_bill_no": ""}, base | {"bill_no": "3", "req_bill_id": "9"}]
    dims = {
        "materials": ("material_id", "material_no", "material_name", "specification", "brand"), "suppliers": ("supplier_id", "supplier_name"), "contacts": ("contact_id", "contact_name", "mobile"),
        "units": ("unit_id", "unit_name"), "stocks": ("stock_id", "stock_name"), "users": ("user_id", "user_name"), "depts": ("dept_id", "dept_name"), "sellers": ("seller_id", "seller_name", "company"),
    }
    t = {k: frame(spark, text(*cols), tuple("1" for _ in cols)) for k, cols in dims.items()}
    t["purchases"] = frame(spark, text(*purchase_cols), *[tuple(r[c] for c in purchase_cols) for r in rows_])
    t["requisitions"] = frame(spark, text("bill_id", "entry_id", "req_no", "req_approved"), ("1", "1", "R", "2023-01-01 12:00:00"))
    t["sale_lines"] = frame(spark, text("order_no", "material_no", "project_no", "project_name"), ("1", "1", "P", "p"), ("1", "1", "P", "p"))
    got = procurement.lead_time(t, "1").collect()
    assert [(r["req_no"], r["days"], r["status"]) for r in got] == [("R", 1.5, "已审核")] * 2
    assert procurement.lead_time(t, "1", one_line_per_order=True).count() == 1


def test_category_path_stops_at_a_missing_parent(spark, rows):
    cats = frame(
        spark, "id string, parent_id string, level string, code string, name string",
        ("4", "3", "4", "c4", "n4"), ("3", "2", "3", "c3", "n3"), ("2", "1", "2", "c2", "n2"), ("1", None, "1", "c1", "n1"), ("40", "2", "4", "x", "odd"),
    )
    df = frame(spark, "m int, c string", (1, "4"), (2, "40"), (3, None))
    got = rows(catalogue.category_path(df, "c", cats), "m", "category_1", "category_2", "category_3", "category_4")
    # Key 2 points past a level: its parent is not of the level above, so the walk ends.
    assert got == [(1, "n1", "n2", "n3", "n4"), (2, "", "", "", "odd"), (3, "", "", "", "")]


def test_unit_mismatch_ignores_missing_units(spark, rows):
    ours = frame(spark, "code string, unit string", ("a", "kg"), ("b", "kg"), ("c", None), ("d", "kg"), ("e", "kg"))
    theirs = frame(spark, "code string, unit string", ("a", "kg"), ("b", "box"), ("c", "box"), ("d", None))
    assert rows(catalogue.unit_mismatch(ours, theirs)) == [("b", "kg", "box")]


def test_platform_orders_alike_are_one(spark, rows):
    at = "2023-03-01 08:00:00"
    cols = "id string, order_id string, order_time timestamp, examine_time timestamp, price decimal(19,2), title string, address string, state string, channel string, order_state string"
    live = [("1", "9"), ("2", "9"), ("3", "8")]
    t = {
        "platform_orders": spark.sql("select * from values " + ", ".join(
            f"('{i}', '{o}', timestamp'{at}', timestamp'{'1900-01-01' if o == '8' else '2023-04-02'}', 100.00BD, 't', 'x', '1', 'c', 'ok')" for i, o in live)).toDF(*[c.split()[0] for c in cols.split(", ")]),
        "returns": frame(spark, "return_id string, id string, state string", ("r1", "1", "1"), ("r2", "2", "1"), ("r3", "3", "0")),
        "return_lines": frame(spark, "return_id string, state string, qty int, sell_price int", ("r1", "1", 2, 5), ("r1", "1", 1, 3), ("r2", "1", 1, 7), ("r3", "1", 9, 9)),
        "hand_orders": spark.sql(f"select timestamp'{at}' as order_time, 'h' as order_id, 1.00BD as price, 'h' as title, 'r' as region"),
    }
    got = platform.platform_orders(t, [[("x", "north")]], ["c"], "2023-01-01", ["gone"])
    found = rows(got.selectExpr("order_id", "date_format(order_time, 'MM-dd') as day", "cast(price as string) as price", "region"))
    assert found == [("8", "03-01", "100.00", "north"), ("9", "04-02", "80.00", "north"), ("h", "03-01", "1.00", "r")]


def test_project_orders_lists_and_mapping(spark, rows):
    t = {
        "tickets": frame(
            spark, "bill_id int, project_no string, project_name string, customer_orders string, seller_id int, created_at string",
            (1, "A", "job", "'11'、'12'", 1, "d"), (2, "B", "job", None, 1, "d"), (3, "C", "job", "13", 1, "d"), (4, "D", "other", "14", 1, "d"), (5, "E", "job", "15", 1, "d"),
        ),
        "ticket_entries": frame(spark, "bill_id int, tax_amount double, amount double", (1, 5.0, 4.0), (1, 6.0, 5.0), (2, 1.0, 1.0), (3, 2.0, 2.0), (4, 9.0, 9.0)),
        "sellers": frame(spark, "seller_id int, seller_name string", (1, "s")),
        "mappings": frame(spark, "project_no string, customer_order string", ("C", "99")),
    }
    got = rows(platform.project_orders(t, ["job"]), "project_no", "customer_order", "project_tax_amount")
    assert got == [("A", "11", D("11.00")), ("A", "12", D("11.00")), ("B", "", D("1.00")), ("C", "99", D("2.00"))]


def test_platform_recon_leaves_out_projects_billed_at_zero(spark, rows):
    orders = frame(spark, "order_time string, order_id string, price int, title string, region string", ("t", "11", 1, "x", "r"), ("t", "77", 1, "x", "r"), ("t", "55", 1, "x", "r"))
    projects = frame(
        spark, "customer_order string, project_no string, project_tax_amount int, project_amount int, created_at string, seller string",
        ("11", "A", 1, 1, "d", "s"), ("12", "B", 1, 1, "d", "s"), ("55", "Z", 1, 1, "d", "s"),
    )
    settled = frame(
        spark, "project_no string, small_tax_amount int, small_amount int, small_cost int, big_tax_amount double, big_units bigint, paid int, refunded int",
        ("A", 1, 1, 1, 5.0, 5, 1, 1), ("Z", 1, 1, 1, 0.4, 0, 1, 1), ("B", 2, 2, 2, None, None, None, None),
    )
    got = rows(platform.platform_recon(orders, projects, settled), "order_id", "project_no", "small_amount")
    assert got == [(None, "B", 2), ("11", "A", 1), ("77", None, None)]


def test_scope_without_exclusions(spark):
    df = frame(spark, "org string", ("1",), (None,))
    assert df.where(receivables.in_scope([receivables.OrgRule("1")], "org", F.lit("c"), F.lit("p"))).count() == 1
