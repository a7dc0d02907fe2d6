"""Procurement: timeline, amounts, returns, workload, lead times, supplier orders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions import codes
from ledgerloom.functions.scalars import decode, elapsed_days, is_blank
from ledgerloom.operators.joins import Dim, all_present, header_join, star_join
from ledgerloom.operators.lineage import residual_reversed, residual_total, residual_union, trace_source, with_taken
from ledgerloom.operators.merge import multi_fact_merge, outer_chain
from ledgerloom.operators.windows import first_per_key, latest_with_total
from ledgerloom.session import drop_but_last, written_count, written_table

REQ_COLS = [
    "req_no", "req_status", "req_org", "req_applied", "req_project_no", "project_name", "sale_org", "seller", "material_no", "material_name",
    "brand", "specification", "test_type", "req_created", "req_approved",
]
PUR_COLS = ["pur_no", "pur_status", "supplier", "pur_dept", "buyer", "pur_created", "pur_approved"]
REC_COLS = ["receipt_no", "receipt_created", "receipt_approved", "lot_no", "material_id", "stock"]
LOT_KEY = ["lot_no", "material_id"]
LOT_TAKE = ["bill_no", "created_at", "approved_at"]


def lot_moves(moves: DataFrame, prefix: str, ties: Sequence[str]) -> DataFrame:
    """Newest notice or shipment per (lot, material) with the total quantity moved.

    moves: lot_no, material_id, bill_no, created_at, approved_at, qty, ``ties``. Rows
    without a lot are left out.
    """
    order = F.coalesce("approved_at", "created_at")
    newest = latest_with_total(moves.where(~is_blank("lot_no")), LOT_KEY, order, ties, LOT_TAKE, "qty", f"{prefix}_qty")
    return newest.select(*LOT_KEY, f"{prefix}_qty", *[F.col(c).alias(f"{prefix}_{c}") for c in LOT_TAKE])


def with_lot_moves(receipts: DataFrame, moves: Mapping[str, DataFrame], ties: Sequence[str]) -> DataFrame:
    """Receipts with the newest move of their lot, for each kind of move its prefix.

    Receipts without a lot meet no move and are not shuffled for one.
    """
    has_lot, on_lot = all_present(LOT_KEY) & ~is_blank("lot_no"), {c: c for c in LOT_KEY}
    dims = [Dim(lot_moves(f, p, ties), on_lot, {f"{p}_{c}": f"{p}_{c}" for c in (*LOT_TAKE, "qty")}) for p, f in moves.items()]
    return star_join(receipts.where(has_lot), dims).unionByName(receipts.where(~has_lot), allowMissingColumns=True)


def procure_timeline(t: Mapping[str, DataFrame], ties: Sequence[str] = ("bill_no",), as_written: bool = False) -> DataFrame:
    """Requisition, purchase, receipt, notice, shipment and sales order of every line.

    Frames: ``requisitions`` (bill_id, entry_id, source_bill_id, source_entry_id, qty and
    REQ_COLS), ``purchases`` (bill_id, entry_id, req_bill_id, req_entry_id, qty and
    PUR_COLS), ``receipts`` (pur_bill_id, pur_entry_id, qty and REC_COLS), ``notices`` and
    ``shipments`` as in ``lot_moves``, ``sale_orders`` (bill_id, entry_id, sale_no,
    sale_created, sale_approved, customer_order_no, qty). Every stage shows what the next
    one took and what is left of it. ``as_written`` keeps the report's reversed first
    stage: received less ordered instead of ordered less received.

    A stage feeds the next one twice (its rows and their totals), so each is written once
    to the shared folder, and what was shuffled for it is deleted. Lots are looked up on the
    receipts and sales orders on the requisitions, the tables that hold their keys: no row
    is shuffled with all columns.
    """
    before, status = written_count(), codes.DOCUMENT_STATUS
    receipts = t["receipts"].withColumnRenamed("qty", "received_qty")
    receipts = with_lot_moves(receipts, {"notice": t["notices"], "ship": t["shipments"]}, ties)
    receipts = written_table(receipts, "timeline-receipts", compact=True)

    purchases = t["purchases"].withColumn("pur_status", decode("pur_status", status)).withColumnRenamed("qty", "ordered")
    link = {"bill_id": "pur_bill_id", "entry_id": "pur_entry_id"}
    stage = residual_union(
        purchases, receipts, link, "ordered", "received_qty", "pur_qty", keep_child_qty=True, with_rest=not as_written
    )
    if as_written:
        over = residual_reversed(purchases, receipts, link, "ordered", "received_qty", "pur_qty")
        stage = stage.unionByName(over, allowMissingColumns=True)
    stage = written_table(stage.drop("ordered", "bill_id", "entry_id"), "timeline-purchases", compact=True)
    drop_but_last(receipts.sparkSession, before)

    req = t["requisitions"].withColumn("req_status", decode("req_status", status)).withColumnRenamed("qty", "requested")
    link = {"bill_id": "req_bill_id", "entry_id": "req_entry_id"}
    req = written_table(with_taken(req, stage, link, "pur_qty"), "timeline-requisitions", compact=True)

    orders = t["sale_orders"].withColumnRenamed("qty", "__sold")
    order_cols = ["sale_no", "sale_created", "sale_approved", "customer_order_no"]
    key = {"source_bill_id": "bill_id", "source_entry_id": "entry_id"}
    # An order that repeats a key repeats the rows, but not the quantity they use.
    used = residual_total(req, "requested", list(key), "__used")
    met = trace_source(req, orders, key, {c: c for c in (*order_cols, "__sold")})
    met = residual_union(met, stage, link, "requested", "pur_qty", "req_qty", keep_child_qty=True, taken_known=True)
    met = met.withColumn("sale_qty", F.coalesce("req_qty", "__sold")).drop("__sold", "requested", *link)
    left = trace_source(orders, used, {"bill_id": "source_bill_id", "entry_id": "source_entry_id"}, {"__used": "__used"}, "inner")
    rest = F.col("__sold") - F.col("__used")
    left = left.where(rest > 0).select(*order_cols, rest.alias("sale_qty"))
    line = met.unionByName(left, allowMissingColumns=True)
    return line.select(
        *REQ_COLS, *PUR_COLS, *REC_COLS, *order_cols, "req_qty", "pur_qty", "received_qty", "sale_qty",
        "notice_bill_no", "notice_created_at", "notice_approved_at", "notice_qty",
        "ship_bill_no", "ship_created_at", "ship_approved_at", "ship_qty",
        elapsed_days("sale_created", "sale_approved").alias("sale_days"),
        elapsed_days("req_created", "req_approved").alias("req_days"),
        elapsed_days("req_approved", "pur_approved").alias("pur_days"),
        elapsed_days("receipt_approved", "ship_approved_at").alias("stock_days"),
    )


AMOUNT_KEYS = ["day", "dept_id", "person_id", "material_id"]


def purchase_amounts(t: Mapping[str, DataFrame], merged: bool = False) -> DataFrame:
    """Invoiced, uninvoiced, in-execution and on-hand amounts side by side.

    ``invoiced``, ``settled``, ``shipped``, ``ordered``, ``received``: AMOUNT_KEYS and
    amount (settled and shipped are both uninvoiced). Dims: materials (material_id,
    material_no, material_name, brand, specification, assess_type), depts, buyers. As the
    report is written each amount meets its neighbour only, and receipts stay single
    lines; ``merged`` gives one row per key.
    """

    def total(frame: DataFrame, name: str) -> DataFrame:
        return frame.groupBy(*AMOUNT_KEYS).agg(F.sum("amount").alias(name))

    open_lines = t["settled"].select(*AMOUNT_KEYS, "amount").unionByName(t["shipped"].select(*AMOUNT_KEYS, "amount"))
    names = ["invoiced", "uninvoiced", "in_execution", "on_hand"]
    if merged:
        facts = dict(zip(names, [t["invoiced"], open_lines, t["ordered"], t["received"]]))
        rows = multi_fact_merge(facts, AMOUNT_KEYS, "amount")
    else:
        chain = [
            (total(t["invoiced"], "invoiced"), "invoiced"),
            (total(open_lines, "uninvoiced"), "uninvoiced"),
            (total(t["ordered"], "in_execution"), "in_execution"),
            (t["received"].select(*AMOUNT_KEYS, F.col("amount").alias("on_hand")), "on_hand"),
        ]
        rows = outer_chain(chain, AMOUNT_KEYS, "neighbour", blank_keys=True, single_lines=["on_hand"])
    rows = rows.withColumns({n: F.coalesce(n, F.lit(0)).cast("decimal(18,4)") for n in names})
    rows = rows.where(" OR ".join(f"{n} <> 0" for n in names))
    rows = star_join(
        rows,
        [
            Dim(t["materials"], {"material_id": "material_id"}, {c: c for c in ("material_no", "material_name", "brand", "specification", "assess_type")}),
            Dim(t["depts"], {"dept_id": "dept_id"}, {"dept": "dept_name"}),
            Dim(t["buyers"], {"person_id": "buyer_id"}, {"buyer": "buyer_name"}),
        ],
    )
    return rows.select("day", "dept", "buyer", "material_no", "material_name", "brand", "specification", *names, "assess_type")


def return_list(t: Mapping[str, DataFrame], org: str) -> DataFrame:
    """Approved returns of one organisation that are not its internal cross-org copies.

    headers: bill_id, bill_no, day, org_id, org_name, seller_id, status, cross_org;
    entries: bill_id, material_id; dims: sellers, materials, material_buyers
    (material_id, buyer_id), buyers.
    """
    head = t["headers"].where((F.col("org_id") == org) & (F.col("status") == "C") & (F.col("cross_org") == "0"))
    return star_join(
        header_join(head, t["entries"].select("bill_id", "material_id"), "bill_id"),
        [
            Dim(t["sellers"], {"seller_id": "seller_id"}, {"seller": "seller_name"}),
            Dim(t["materials"], {"material_id": "material_id"}, {"material_name": "material_name"}),
            Dim(t["material_buyers"], {"material_id": "material_id"}, {"buyer_id": "buyer_id"}),
            Dim(t["buyers"], {"buyer_id": "buyer_id"}, {"buyer": "buyer_name"}),
        ],
    ).select("day", "buyer", "org_name", "seller", "bill_no", "material_id", "material_name")


def daily_workload(requests: DataFrame, orders: DataFrame, payments: DataFrame, amounts: DataFrame) -> DataFrame:
    """Documents and paid amounts per buyer and day, everything keyed to the requests.

    Inputs: day, buyer per document; ``amounts`` also pay_type and amount. Days or buyers
    without requests start rows of their own, one per kind of document, as the report
    defines it.
    """

    keys = ["day", "buyer"]

    def counted(df: DataFrame, name: str) -> tuple[DataFrame, str]:
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)), name

    paid = amounts.groupBy(*keys, "pay_type").agg(F.sum("amount").alias("paid"))
    paid = paid.select(*keys, F.struct("pay_type", "paid").alias("pay"))
    facts = [counted(requests, "requests"), counted(orders, "orders"), counted(payments, "payments"), (paid, "pay")]
    out = outer_chain(facts, keys, "first", single_lines=["pay"])
    return out.select(
        F.expr("CASE WHEN requests IS NOT NULL OR orders IS NOT NULL THEN day END").alias("approved_day"),
        F.expr("CASE WHEN payments IS NOT NULL OR pay IS NOT NULL THEN day END").alias("paid_day"),
        "buyer", "pay.pay_type", "requests", "orders", "payments", "pay.paid",
    )


def lead_time(t: Mapping[str, DataFrame], org: str, one_line_per_order: bool = False) -> DataFrame:
    """Days from the approval of a requisition to the purchase order made for it.

    purchases: bill_no, created_at, approved_at, org_id, source_bill_no, req_bill_id,
    req_entry_id, supplier_id, contact_id, material_id, qty, unit_id, stock_id, creator_id,
    dept_id, seller_id, order_no, status; requisitions: bill_id, entry_id, req_no,
    req_approved; sale_lines: order_no, material_no, project_no, project_name; dims by
    their ids. A sales order with several lines of a material repeats the row, as written;
    ``one_line_per_order`` keeps the one of the smallest project number, then name.
    """
    rows = t["purchases"].where((F.col("org_id") == org) & ~is_blank("source_bill_no", trim=False))
    rows = trace_source(
        rows, t["requisitions"], {"req_bill_id": "bill_id", "req_entry_id": "entry_id"},
        {"req_no": "req_no", "req_approved": "req_approved"}, "inner",
    ).where(F.col("req_no").isNotNull())
    sale_lines = t["sale_lines"]
    if one_line_per_order:
        sale_lines = first_per_key(sale_lines, ["order_no", "material_no"], "project_no", ["project_name"])
    rows = star_join(
        rows,
        [
            Dim(t["materials"], {"material_id": "material_id"}, {c: c for c in ("material_no", "material_name", "specification", "brand")}),
            Dim(t["suppliers"], {"supplier_id": "supplier_id"}, {"supplier": "supplier_name"}),
            Dim(t["contacts"], {"contact_id": "contact_id"}, {"contact": "contact_name", "mobile": "mobile"}),
            Dim(t["units"], {"unit_id": "unit_id"}, {"unit": "unit_name"}),
            Dim(t["stocks"], {"stock_id": "stock_id"}, {"stock": "stock_name"}),
            Dim(t["users"], {"creator_id": "user_id"}, {"creator": "user_name"}),
            Dim(t["depts"], {"dept_id": "dept_id"}, {"dept": "dept_name"}),
            Dim(t["sellers"], {"seller_id": "seller_id"}, {"seller": "seller_name", "seller_company": "company"}),
            Dim(sale_lines, {"order_no": "order_no", "material_no": "material_no"}, {"project_no": "project_no", "project_name": "project_name"}, "sale_lines", one_line_per_order),
        ],
    )
    return rows.select(
        "req_no", "req_approved", "created_at", "approved_at", "bill_no", decode("status", codes.DOCUMENT_STATUS).alias("status"),
        "supplier", "contact", "mobile", "material_no", "brand", "material_name", "specification", "qty", "unit", "stock", "creator",
        "dept", "seller", "seller_company", "order_no", "project_no", "project_name", elapsed_days("req_approved", "created_at").alias("days"),
    )


def receipt_lead_time(t: Mapping[str, DataFrame], org_names: Sequence[str], stock_names: Sequence[str]) -> DataFrame:
    """Days from the approval of a purchase order to the approval of its receipt.

    receipts: bill_id, bill_no, approved_at, org_id, supplier_id, dept_id, buyer_id,
    creator_id, status; receipt_entries: bill_id, stock_id, material_id, order_no;
    purchase_orders: order_no, approved_at; dims by their ids. Organisation and warehouse
    are chosen by name, before the entries are joined to anything large.
    """
    orgs = t["orgs"].where(F.col("org_name").isin(*org_names)).select("org_id")
    stocks = t["stocks"].where(F.col("stock_name").isin(*stock_names)).select("stock_id")
    head = t["receipts"].where(F.col("status") == "C").join(orgs, "org_id", "left_semi")
    rows = head.join(t["receipt_entries"].join(stocks, "stock_id", "left_semi"), "bill_id")
    rows = star_join(
        rows,
        [
            Dim(t["suppliers"], {"supplier_id": "supplier_id"}, {"supplier": "supplier_name"}),
            Dim(t["materials"], {"material_id": "material_id"}, {"material_no": "material_no", "material_name": "material_name", "brand": "brand"}),
            Dim(t["depts"], {"dept_id": "dept_id"}, {"dept": "dept_name"}),
            Dim(t["buyers"], {"buyer_id": "buyer_id"}, {"buyer": "buyer_name"}),
            Dim(t["users"], {"creator_id": "user_id"}, {"creator": "user_name"}),
            Dim(t["purchase_orders"], {"order_no": "order_no"}, {"order_approved": "approved_at"}),
        ],
    )
    return rows.select(
        "bill_no", "supplier", "material_no", "material_name", "brand", "dept", "buyer", "creator", F.col("approved_at").alias("receipt_approved"),
        "order_no", "order_approved", elapsed_days("order_approved", "approved_at").alias("days"),
    )


def supplier_orders(t: Mapping[str, DataFrame], org_names: Sequence[str]) -> DataFrame:
    """Purchase order lines and purchase returns in one tagged list.

    purchases: bill_id, bill_no, approved_at, org_id, supplier_id, status, manual_close;
    purchase_entries: bill_id, entry_id, material_id, amount, termination; returns:
    bill_id, bill_no, approved_at, org_id, status; return_entries: bill_id, material_id,
    amount, receipt_bill_id, receipt_entry_id; receipt_links: bill_id, entry_id,
    order_bill_id, order_entry_id; dims: orgs, materials (with assess_type), suppliers. A
    return is traced to its receipt and from there to the order it was bought with.
    """
    orgs = t["orgs"].where(F.col("org_name").isin(*org_names)).select("org_id")
    bought = t["purchases"].where((F.col("status") == "C") & (F.col("manual_close") == "0")).join(orgs, "org_id", "left_semi")
    bought = bought.join(t["purchase_entries"].where(F.col("termination") == "A"), "bill_id")
    bought = star_join(
        bought,
        [
            Dim(t["materials"], {"material_id": "material_id"}, {"material_no": "material_no", "assess_type": "assess_type"}),
            Dim(t["suppliers"], {"supplier_id": "supplier_id"}, {"supplier": "supplier_name"}),
        ],
    ).select(
        "bill_no", F.lit("").alias("source_no"), "approved_at", "material_no", "assess_type", "amount", "supplier",
        F.lit(codes.PURCHASE_ORDER_TAG).alias("kind"),
    )

    lines = t["purchases"].select("bill_id", "bill_no").join(t["purchase_entries"].select("bill_id", "entry_id"), "bill_id")
    source = trace_source(
        t["receipt_links"], lines, {"order_bill_id": "bill_id", "order_entry_id": "entry_id"}, {"source_no": "bill_no"}, "inner"
    )
    sent = t["returns"].where(F.col("status") == "C").join(orgs, "org_id", "left_semi").join(t["return_entries"], "bill_id")
    sent = trace_source(sent, source, {"receipt_bill_id": "bill_id", "receipt_entry_id": "entry_id"}, {"source_no": "source_no"})
    sent = star_join(sent, [Dim(t["materials"], {"material_id": "material_id"}, {"material_no": "material_no"})]).select(
        "bill_no", F.coalesce("source_no", F.lit("")).alias("source_no"), "approved_at", "material_no", F.lit("").alias("assess_type"),
        "amount", F.lit("").alias("supplier"), F.lit(codes.PURCHASE_RETURN_TAG).alias("kind"),
    )
    return bought.unionByName(sent)
