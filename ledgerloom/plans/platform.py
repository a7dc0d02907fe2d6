"""Platform orders against project orders, receivables and payments.

Frames: hand_orders (order_time, order_id, price, title, region); platform_orders (id,
order_time, examine_time, order_id, price, title, address, state, channel, order_state);
returns (return_id, id, state); return_lines (return_id, state, qty, sell_price); tickets
(bill_id, project_no, project_name, customer_orders, seller_id, created_at); ticket_entries
(bill_id, tax_amount, amount); sellers; mappings (project_no, customer_order); headers
(bill_id, org_id, status, approved_at); entries (bill_id, project_id, material_id,
unit_id, order_no, qty, price, tax_price, cost); projects (project_id, project_no, ratio);
receipts and refunds (bill_id, org_id, status) with receipt_entries and refund_entries
(bill_id, project_id, amount); orgs, materials, units, sale_orders.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.scalars import MONEY_TYPE, clean_list, nullif_blank, ratio_amount, ratio_value
from ledgerloom.functions.text import keyword_region
from ledgerloom.operators.aggregates import money_sum
from ledgerloom.operators.joins import Dim, full_join_split, semi_by, star_join

Levels = Sequence[Sequence[tuple[str, str]]]


def order_time(order_id: Column, ordered: Column, examined: Column) -> Column:
    """Time of a platform order: ids starting with 2 keep the order time, others take the
    time of examination unless it is missing or a placeholder whose year starts with 19."""
    valid = examined.isNotNull() & (F.substring(examined.cast("string"), 1, 2) != "19")
    return F.when(F.substring(order_id, 1, 1) == "2", ordered).otherwise(F.when(valid, examined).otherwise(ordered))


def platform_orders(
    t: Mapping[str, DataFrame], levels: Levels, channels: Sequence[str], since: str, dropped_states: Sequence[str]
) -> DataFrame:
    """Hand-kept and platform orders net of returned goods, with the delivery region.

    Platform orders alike in number, title, times, address and price are one order, from
    whose price the returns of all of them are taken.
    """
    live = t["platform_orders"].where(
        (F.col("state") == "1") & F.col("channel").isin(*channels) & (F.col("order_time") >= since) & ~F.col("order_state").isin(*dropped_states)
    )
    value = F.coalesce("qty", F.lit(0)).cast(MONEY_TYPE) * F.coalesce("sell_price", F.lit(0)).cast(MONEY_TYPE)
    back = t["returns"].where(F.col("state") == "1").select("return_id", "id")
    back = back.join(t["return_lines"].where(F.col("state") == "1").select("return_id", value.alias("__value")), "return_id")
    back = back.groupBy("id").agg(F.sum("__value").alias("__back"))
    alike = ["order_id", "title", "order_time", "address", "price", "examine_time"]
    joined = live.select("id", *alike).join(back, "id", "left").groupBy(*alike).agg(F.sum("__back").alias("__back"))
    net = F.col("price").cast(MONEY_TYPE) - F.coalesce("__back", F.lit(0))
    own = joined.select(
        order_time(F.col("order_id"), F.col("order_time"), F.col("examine_time")).alias("order_time"), "order_id",
        net.cast(MONEY_TYPE).alias("price"), "title", keyword_region("address", levels).alias("region"),
    )
    hand = t["hand_orders"].select("order_time", "order_id", F.col("price").cast(MONEY_TYPE).alias("price"), "title", "region")
    return hand.unionByName(own)


def project_orders(t: Mapping[str, DataFrame], project_names: Sequence[str], sep: str = "、") -> DataFrame:
    """Project amounts per customer order; a hand-kept mapping overrides the listed orders.

    Entries are totalled per ticket before the order list is split, so the split repeats
    one row per ticket instead of every entry.
    """
    tickets = t["tickets"].where(F.col("project_name").isin(*project_names))
    totals = semi_by(t["ticket_entries"], tickets, {"bill_id": "bill_id"}).groupBy("bill_id").agg(
        F.sum("tax_amount").alias("tax_amount"), F.sum("amount").alias("amount")
    )
    listed = tickets.join(totals, "bill_id").withColumn("__order", F.explode(clean_list("customer_orders", sep)))
    listed = star_join(listed, [Dim(t["sellers"], {"seller_id": "seller_id"}, {"seller": "seller_name"})])
    grouped = listed.groupBy("project_no", "seller", "__order", "created_at").agg(
        money_sum("tax_amount").alias("tax_amount"), money_sum("amount").alias("amount")
    )
    mapped = star_join(grouped, [Dim(t["mappings"], {"project_no": "project_no"}, {"__mapped": "customer_order"})])
    return mapped.select(
        F.coalesce("__mapped", "__order", F.lit("")).alias("customer_order"), "project_no",
        F.col("tax_amount").alias("project_tax_amount"), F.col("amount").alias("project_amount"), "created_at", "seller",
    )


def _org_lines(t: Mapping[str, DataFrame], bills: str, rows: str, org_names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    orgs = t["orgs"].where(F.col("org_name").isin(*org_names))
    head = t[bills].where(F.col("status") == "C").join(orgs, "org_id").select("bill_id", "org_name", *keep)
    joined = head.join(t[rows], "bill_id")
    return star_join(joined, [Dim(t["projects"], {"project_id": "project_id"}, {"project_no": "project_no", "ratio": "ratio"})])


def project_settlements(t: Mapping[str, DataFrame], small_orgs: Sequence[str], big_org: str) -> DataFrame:
    """Receivable, receipt and refund totals per project in one row.

    Receivables of the small and the big organisations are totalled in one pass.
    ``big_units`` is the whole part of the big total.
    """
    lines = _org_lines(t, "headers", "entries", [*small_orgs, big_org])
    small, big = F.col("org_name").isin(*small_orgs), F.col("org_name") == big_org
    net, gross = F.col("qty") * F.col("price"), F.col("qty") * F.col("tax_price")
    billed = lines.groupBy("project_no").agg(
        money_sum(F.when(small, ratio_amount(gross, "ratio"))).alias("small_tax_amount"),
        money_sum(F.when(small, ratio_amount(net, "ratio"))).alias("small_amount"),
        money_sum(F.when(small, F.col("cost"))).alias("small_cost"),
        money_sum(F.when(big, gross)).alias("big_tax_amount"),
        F.sum(F.when(big, gross)).cast("decimal(38,6)").cast("bigint").alias("big_units"),
    )
    out = billed
    for bills, rows, name in (("receipts", "receipt_entries", "paid"), ("refunds", "refund_entries", "refunded")):
        side = _org_lines(t, bills, rows, [big_org]).groupBy("project_no").agg(money_sum("amount").alias(name))
        out = out.join(side, "project_no", "full")
    return out


def platform_recon(orders: DataFrame, projects: DataFrame, settlements: DataFrame) -> DataFrame:
    """Platform orders met with project orders; projects billed at zero are left out."""
    met = full_join_split(orders, projects, {"order_id": "customer_order"})
    cols = ("small_tax_amount", "small_amount", "small_cost", "big_tax_amount", "paid", "refunded")
    # An order that met no project has no project number.
    on = {"project_no": "project_no"}
    met = star_join(met, [Dim(settlements, on, {c: c for c in (*cols, "big_units")}, spread=("order_id", "order_time", "title"))])
    met = met.where(F.coalesce(F.col("big_units") != 0, F.lit(True)))
    return met.select(
        "order_time", "order_id", "price", "title", "region", "project_no", "project_tax_amount", "project_amount", "seller", "created_at", *cols
    )


def platform_recon_lines(t: Mapping[str, DataFrame], recon: DataFrame, small_orgs: Sequence[str]) -> DataFrame:
    """Receivable lines of the small organisations for the projects of a reconciliation."""
    lines = semi_by(_org_lines(t, "headers", "entries", small_orgs, ("approved_at",)), recon, {"project_no": "project_no"})
    ten = "decimal(19,10)"
    lines = lines.withColumn("__order_key", nullif_blank("order_no"))
    unit = F.when(ratio_value("ratio").isNotNull(), F.col("tax_price") * 100 / ratio_value("ratio")).otherwise(F.col("tax_price"))
    lines = star_join(
        lines,
        [
            Dim(t["materials"], {"material_id": "material_id"}, {c: c for c in ("material_no", "brand", "material_name", "specification")}),
            Dim(t["units"], {"unit_id": "unit_id"}, {"unit": "unit_name"}),
            Dim(t["sale_orders"], {"__order_key": "order_no"}, {c: c for c in ("address", "consignee", "phone")}),
        ],
    )
    return lines.select(
        "project_no", "material_no", "brand", "material_name", "specification", "unit", unit.cast(ten).alias("unit_tax_price"), "qty",
        ratio_amount(F.col("qty") * F.col("tax_price"), "ratio").cast(ten).alias("tax_amount"), "address", "consignee", "phone", "order_no", "approved_at",
    )
