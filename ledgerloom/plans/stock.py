"""Lots: unit costs, return pricing, warehouse stock, what became of returned goods.

A lot is the pair (material_no, lot_no).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions import codes
from ledgerloom.functions.scalars import first_priced, int_part, is_blank, safe_div
from ledgerloom.operators.aggregates import tagged_pivot
from ledgerloom.operators.joins import Dim, semi_by, star_join
from ledgerloom.operators.windows import first_per_key
from ledgerloom.session import written_table

LOT = ["material_no", "lot_no"]
LOT_ID = ["material_id", "lot_id"]
ON_LOT = {c: c for c in LOT}
APPROVED = "C"


def with_lot(rows: DataFrame, t: Mapping[str, DataFrame]) -> DataFrame:
    """Material and lot numbers for material_id and lot_id."""
    return star_join(
        rows,
        [
            Dim(t["materials"], {"material_id": "material_id"}, {"material_no": "material_no"}),
            Dim(t["lots"], {"lot_id": "lot_id"}, {"lot_no": "lot_no"}),
        ],
    )


def lot_unit_cost(receipts: DataFrame) -> DataFrame:
    """Cost per unit of each lot from receipt lines (LOT, amount, qty): largest by largest."""
    top = receipts.groupBy(*LOT).agg(F.max("amount").alias("__a"), F.max("qty").alias("__q"))
    return top.select(*LOT, safe_div("__a", "__q").alias("unit_cost"))


def return_pricing(t: Mapping[str, DataFrame], org: str, own_org_name: str, stock_names: Sequence[str]) -> DataFrame:
    """Sales returns with lot cost and unit price.

    returns: bill_id, bill_no, approved_at, org_id, sale_org_id, customer_id, seller_id,
    status, workflow; return_entries: bill_id, stock_id, order_no, material_id, lot_id,
    buyer_id, dept_id, qty, reason, note, stock_flag, price, source_bill_no; receipts: org_id,
    stock_flag, LOT, amount, qty; settlements: bill_no, LOT, base_qty, price;
    order_companies: order_no, company; dims by their ids. Own sales keep the return's
    price, others take it from the settlement of the same bill, lot and quantity.
    """
    stocks = t["stocks"].where(F.col("stock_name").isin(*stock_names))
    head = t["returns"].where((F.col("org_id") == org) & (F.col("status") == APPROVED))
    body = t["return_entries"].where(F.col("stock_flag") == "1").join(stocks.select("stock_id", "stock_name"), "stock_id")
    rows = with_lot(head.join(body, "bill_id"), t)
    cost = lot_unit_cost(t["receipts"].where((F.col("org_id") == org) & (F.col("stock_flag") == "1")))
    companies = t["order_companies"].select("order_no", F.coalesce("company", F.lit("")).alias("company")).distinct()
    rows = star_join(
        rows,
        [
            Dim(t["orgs"], {"sale_org_id": "org_id"}, {"sale_org": "org_name"}),
            Dim(t["customers"], {"customer_id": "customer_id"}, {"return_customer": "customer_name"}),
            Dim(t["buyers"], {"buyer_id": "buyer_id"}, {"buyer_no": "buyer_no", "buyer": "buyer_name"}),
            Dim(t["depts"], {"dept_id": "dept_id"}, {"dept": "dept_name"}),
            Dim(t["sellers"], {"seller_id": "seller_id"}, {"seller_no": "seller_no", "seller": "seller_name"}),
            Dim(companies, {"order_no": "order_no"}, {"seller_company": "company"}),
            Dim(cost, ON_LOT, {"unit_cost": "unit_cost"}),
            Dim(t["settlements"], {"bill_no": "bill_no", **ON_LOT, "qty": "base_qty"}, {"settled_price": "price"}),
        ],
    )
    price = F.when(F.col("sale_org") == own_org_name, F.col("price")).otherwise(F.col("settled_price"))
    workflow = F.when(F.col("workflow") == "1", codes.YES_NO["1"]).otherwise(codes.YES_NO["0"])
    return rows.select(
        "bill_no", "approved_at", "sale_org", "return_customer", *LOT, "buyer_no", "buyer", "dept", "seller_no", "seller", "stock_name",
        "qty", "reason", "note", workflow.alias("workflow"), "seller_company", "unit_cost", price.alias("unit_price"), "source_bill_no",
    )


def earliest_event(facts: Mapping[str, DataFrame], keys: Sequence[str] = tuple(LOT)) -> DataFrame:
    """First date per key over any number of event types (keys, approved_at).

    The events are stacked and reduced together: one shuffle instead of a join per type.
    """
    stacked = None
    for fact in facts.values():
        part = fact.select(*keys, "approved_at")
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked.groupBy(*keys).agg(F.min("approved_at").alias("approved_at"))


def cost_priority(sources: Mapping[str, DataFrame], order: str, ties: Sequence[str]) -> DataFrame:
    """Newest cost per lot of the first source that has one, in the order given.

    Each source: LOT, ``order``, ``ties``, cost. A cost of zero counts, a missing one does
    not; a lot without any cost takes zero.
    """
    stacked = None
    for tag, source in sources.items():
        part = source.select(*LOT, order, *ties, "cost", F.lit(tag).alias("__tag"))
        stacked = part if stacked is None else stacked.unionByName(part)
    rank = F.struct(order, *ties)
    newest = [
        F.max_by(F.struct("cost"), F.when(F.col("__tag") == tag, rank)).alias(tag) for tag in sources
    ]
    found = stacked.groupBy(*LOT).agg(*newest)
    return found.select(*LOT, first_priced(*[F.col(tag)["cost"] for tag in sources]).alias("unit_cost"))


def stock_report(t: Mapping[str, DataFrame], stock_name: str, org: str, ties: Sequence[str]) -> DataFrame:
    """Stock of one warehouse by lot with age, first supplier and latest cost.

    inventory: inventory_id, stock_id, material_id, lot_id, base_qty; reservations:
    inventory_id, base_qty; conversions: material_id, numerator, denominator; ``event_*``
    frames: material_id, lot_id, stock_id, approved_at (movements into stock); receipts,
    disassemblies, assemblies: LOT, approved_at, org_id, amount, qty (receipts with
    supplier_id); gains: LOT, approved_at, org_id, price; ``ties`` order equal dates.
    Dims: stocks, materials (with name, specification, brand), lots, suppliers, owners
    (material_no, assess_type, buyer_no, buyer, dept). Lots whose whole stock and whole
    available quantity are both zero are left out.
    """
    stocks = t["stocks"].where(F.col("stock_name") == stock_name).select("stock_id")
    locked = t["reservations"].where("base_qty > 0").groupBy("inventory_id").agg(F.sum("base_qty").alias("locked"))
    rows = with_lot(semi_by(t["inventory"], stocks, {"stock_id": "stock_id"}), t)
    own = {k: t[k].where(F.col("org_id") == org) for k in ("receipts", "disassemblies", "assemblies", "gains")}
    first = first_per_key(own["receipts"], LOT, "approved_at", ties)
    per_unit = safe_div("amount", "qty").cast("decimal(28,8)").alias("cost")
    sources = {
        k: own[k].select(*LOT, "approved_at", *ties, per_unit) for k in ("receipts", "disassemblies", "assemblies")
    }
    sources["gains"] = own["gains"].select(*LOT, "approved_at", *ties, F.col("price").cast("decimal(28,8)").alias("cost"))
    # Reduced by id first; the numbers are looked up once per lot, not once per movement.
    events = {k: semi_by(f, stocks, {"stock_id": "stock_id"}) for k, f in t.items() if k.startswith("event_")}
    age = with_lot(earliest_event(events, LOT_ID), t).groupBy(*LOT).agg(F.min("approved_at").alias("approved_at"))
    rows = star_join(
        rows,
        [
            Dim(t["materials"], {"material_id": "material_id"}, {"material_name": "material_name", "specification": "specification", "brand": "brand"}),
            Dim(t["conversions"], {"material_id": "material_id"}, {"numerator": "numerator", "denominator": "denominator"}),
            Dim(locked, {"inventory_id": "inventory_id"}, {"locked": "locked"}),
            Dim(t["owners"], {"material_no": "material_no"}, {c: c for c in ("assess_type", "buyer_no", "buyer", "dept")}),
            Dim(first, ON_LOT, {"supplier_id": "supplier_id"}),
            Dim(t["suppliers"], {"supplier_id": "supplier_id"}, {"supplier": "supplier_name"}),
            Dim(age, ON_LOT, {"approved_at": "approved_at"}),
            Dim(cost_priority(sources, "approved_at", ties), ON_LOT, {"unit_cost": "unit_cost"}),
        ],
    )

    def main_units(qty: Column) -> Column:
        in_main = F.try_divide(qty * F.col("numerator"), F.col("denominator"))
        return int_part(F.when(F.col("denominator") == 0, qty).otherwise(in_main))

    free = F.col("base_qty") - F.coalesce("locked", F.lit(0))
    rows = rows.withColumns({"stock_qty": main_units(F.col("base_qty")), "available_qty": main_units(free)})
    return rows.where("stock_qty <> 0 OR available_qty <> 0").select(
        "material_no", "brand", "material_name", "specification", "lot_no", "assess_type", "buyer_no", "buyer", "dept", "stock_qty",
        "available_qty", "approved_at", "supplier", F.coalesce("unit_cost", F.lit(0)).cast("decimal(28,8)").alias("unit_cost"),
    )


def mto_returns(t: Mapping[str, DataFrame], org: str, stock_names: Sequence[str], request_mark: str) -> DataFrame:
    """Returned goods whose lot was bought for a requisition, valued at lot cost.

    returns and return_entries as in ``return_pricing``; purchase_lines: bill_id, entry_id,
    source_bill_no; receipt_lines: org_id, status, LOT, amount, qty, order_bill_id,
    order_entry_id. A purchase line counts when its source number starts with the mark.
    """
    asked = t["purchase_lines"].where(F.trim("source_bill_no").startswith(request_mark))
    bought = t["receipt_lines"].where((F.col("org_id") == org) & (F.col("status") == APPROVED))
    bought = bought.where(~is_blank("material_no") & ~is_blank("lot_no"))
    bought = semi_by(bought, asked, {"order_bill_id": "bill_id", "order_entry_id": "entry_id"})
    cost = lot_unit_cost(bought)
    stocks = t["stocks"].where(F.col("stock_name").isin(*stock_names)).select("stock_id")
    head = t["returns"].where((F.col("org_id") == org) & (F.col("status") == APPROVED))
    body = semi_by(t["return_entries"].where(F.col("stock_flag") == "1"), stocks, {"stock_id": "stock_id"})
    rows = with_lot(head.join(body, "bill_id"), t).join(cost, LOT)
    companies = t["order_companies"].select("order_no", F.coalesce("company", F.lit("")).alias("company")).distinct()
    rows = star_join(
        rows,
        [
            Dim(t["buyers"], {"buyer_id": "buyer_id"}, {"buyer_no": "buyer_no", "buyer": "buyer_name"}),
            Dim(t["depts"], {"dept_id": "dept_id"}, {"dept": "dept_name"}),
            Dim(t["sellers"], {"seller_id": "seller_id"}, {"seller_no": "seller_no", "seller": "seller_name"}),
            Dim(companies, {"order_no": "order_no"}, {"seller_company": "company"}),
        ],
    )
    return rows.select(
        "bill_no", "approved_at", *LOT, "qty", "buyer_no", "buyer", "dept", "unit_cost", (F.col("qty") * F.col("unit_cost")).alias("amount"),
        "seller_no", "seller", "seller_company",
    )


def lot_disposition(returned: DataFrame, facts: Mapping[str, DataFrame], t: Mapping[str, DataFrame]) -> DataFrame:
    """What became of each returned lot: one column per fact.

    returned: LOT, qty, unit_cost (``mto_returns``); each fact: material_id, lot_id, qty.
    The returned lots are written once to the shared folder. The facts of these lots are
    reduced by id in one shuffle, then named and joined once.
    """
    base = returned.groupBy(*LOT).agg(F.sum("qty").alias("returned_qty"), F.max("unit_cost").alias("unit_cost"))
    base = written_table(base, "returned-lots")
    ids = base.select(*LOT).join(t["materials"].select("material_no", "material_id"), "material_no").join(t["lots"].select("lot_no", "lot_id"), "lot_no")
    ids = written_table(ids.select(*LOT_ID).distinct(), "returned-lot-ids")
    facts = {name: semi_by(fact, ids, {c: c for c in LOT_ID}) for name, fact in facts.items()}
    moves = with_lot(tagged_pivot(facts, LOT_ID, "qty"), t).groupBy(*LOT).agg(*[F.sum(name).alias(name) for name in facts])
    return base.join(moves, LOT, "left")
