"""Sales order report, transfer price margin, gross margin."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions import codes
from ledgerloom.functions.scalars import decode, keep_unless
from ledgerloom.operators.joins import Dim, star_join
from ledgerloom.operators.windows import latest_per_key
from ledgerloom.session import written_table
from ledgerloom.sources.sinks import typed

BILL_KIND = "小票销售订单"  # fixed value: document kind of this report

SALE_ORDER_TYPES = {"qty": "decimal(19,4)", "tax_price": "decimal(19,4)", "amount": "decimal(19,4)"}


def sale_order_report(t: Mapping[str, DataFrame], agency_mark: str, excluded_type: int = 1) -> DataFrame:
    """Fulfilment report of sales order lines, codes decoded.

    lines: created_at, bill_id, bill_no, entry_id, org_id, project_id, creator_id,
    seller_id, operator_id, unit_id, material_id, customer_id, qty, tax_price, amount,
    consignee, phone, address, purchase_type, termination, agent_flag, note, status,
    order_type. Dims: projects, tickets, orgs, users, sellers, operators, units,
    materials, customers, issued (entry_id, issued_qty), headers (bill_id, header_note).
    Lines without an order type stay.
    """
    rows = t["lines"].where(keep_unless("order_type", excluded_type))
    projects = star_join(
        t["projects"].select("project_id", "project_no", "customer_order_no", "ratio"),
        [Dim(t["tickets"], {"project_no": "ticket_no"}, {"project_name": "ticket_name", "sales_company": "company", "sales_dept": "dept"})],
    )
    rows = star_join(
        rows,
        [
            # Narrow lookups first, wide texts last; the header's key deals the lines already.
            Dim(t["headers"], {"bill_id": "bill_id"}, {"header_note": "header_note"}),
            Dim(t["issued"], {"entry_id": "entry_id"}, {"issued_qty": "issued_qty"}),
            Dim(t["customers"], {"customer_id": "customer_id"}, {"internal_flag": "internal_flag"}),
            Dim(t["orgs"], {"org_id": "org_id"}, {"sale_org": "org_name"}),
            Dim(t["operators"], {"operator_id": "operator_id"}, {"operator_name": "operator_name"}),
            Dim(t["units"], {"unit_id": "unit_id"}, {"unit_name": "unit_name"}),
            Dim(t["users"], {"creator_id": "user_id"}, {"create_user": "user_name"}),
            Dim(t["sellers"], {"seller_id": "seller_id"}, {"sale_name": "seller_name"}),
            Dim(t["materials"], {"material_id": "material_id"}, {"material_no": "material_no", "brand": "brand", "material_name": "material_name", "specification": "specification"}),
            Dim(projects, {"project_id": "project_id"}, {c: c for c in projects.columns if c != "project_id"}),
        ],
    )
    agent = (F.col("agent_flag") == "1") | F.contains(F.col("project_no"), F.lit(agency_mark))
    return typed(
        rows.select(
            F.col("created_at").cast("string").alias("create_date"),
            "project_name", "project_no", "customer_order_no", "sales_company", "sales_dept", "create_user", "sale_name",
            "operator_name", "material_no", "brand", "material_name", "specification", "qty", "tax_price", "amount",
            "consignee", "phone", "address",
            decode("internal_flag", codes.YES_NO).alias("is_internal_customer"),
            decode("purchase_type", codes.PURCHASE_TYPE).alias("purchase_type"),
            decode("termination", codes.TERMINATION).alias("termination"),
            decode("agent_flag", codes.YES_NO).alias("is_agent"),
            F.when(agent, codes.AGENT_RUN).otherwise(codes.SELF_RUN).alias("form"),
            "unit_name", "note", "bill_no", F.lit(BILL_KIND).alias("bill_kind"),
            decode("status", codes.DOCUMENT_STATUS).alias("status"),
            "issued_qty", "sale_org", "header_note", "ratio",
        ),
        SALE_ORDER_TYPES,
    )


def terminal_price(own_orgs: Sequence[str], channel_org: str, channel_note: str) -> Column:
    """Price without tax that the end customer pays, by kind of sales order.

    Order columns carry the prefix ``so_``; ``price`` is the receivable's own price.
    """
    own, note = F.col("so_org_id").isin(*own_orgs), F.coalesce("so_note", F.lit(""))
    rate = F.coalesce(1 + F.col("so_tax_rate").cast("decimal(18,2)") / 100, F.lit(1))
    before_tax = F.coalesce(F.col("so_list_price").cast("decimal(18,2)"), F.lit(0)) / rate
    return (
        F.when((F.col("so_purchase_type") == "B") | (F.col("so_org_id") == channel_org), F.coalesce("so_price", F.lit(0)).cast("decimal(18,2)"))
        .when(own & (note != channel_note), before_tax.cast("decimal(18,2)"))
        .when(own & (note == channel_note), F.coalesce("price", F.lit(0)).cast("decimal(18,2)"))
        .otherwise(F.lit(0).cast("decimal(18,2)"))
    )


def transfer_margin(
    t: Mapping[str, DataFrame], own_orgs: Sequence[str], channel_org: str, channel_note: str, ties: Sequence[str] = ()
) -> DataFrame:
    """Receivable lines of own organisations priced at what the end customer pays.

    headers: bill_id, bill_no, day, org_id, customer_id, status; entries: bill_id,
    order_no, material_id, qty, price, tax_price, tax_rate, tax_amount, amount,
    net_amount, cost, seller_id, unit_id, project_no, project_name; order_lines: order_no,
    material_no, purchase_type, org_id, price, note, list_price, tax_rate (with ``ties``);
    dims: materials (material_id, material_no, material_name, specification, brand,
    category, buyer, dept), customers, orgs, units, sellers (seller_name, company). An
    order may list a material twice; its highest list price counts.
    """
    best = latest_per_key(t["order_lines"], ["order_no", "material_no"], "list_price", ties)
    head = t["headers"].where(F.col("org_id").isin(*own_orgs) & (F.col("status") == "C")).drop("status")
    rows = head.join(t["entries"], "bill_id")
    order_cols = ("purchase_type", "org_id", "price", "note", "list_price", "tax_rate")
    rows = rows.join(t["materials"], "material_id")
    rows = star_join(
        rows,
        [
            Dim(best, {"order_no": "order_no", "material_no": "material_no"}, {f"so_{c}": c for c in order_cols}),
            Dim(t["customers"], {"customer_id": "customer_id"}, {"customer_name": "customer_name"}),
            Dim(t["orgs"], {"org_id": "org_id"}, {"sale_org": "org_name"}),
            Dim(t["units"], {"unit_id": "unit_id"}, {"unit_name": "unit_name"}),
            Dim(t["sellers"], {"seller_id": "seller_id"}, {"sale_name": "seller_name", "sale_company": "company"}),
        ],
    ).withColumn("terminal_price", terminal_price(own_orgs, channel_org, channel_note))
    two = "decimal(18,2)"
    return rows.select(
        "day", "bill_no", "customer_name", "sale_org", F.lit(codes.DOCUMENT_STATUS["C"]).alias("status"), "material_no", "brand",
        "material_name", "specification", "qty", "unit_name", "tax_price", "price", "tax_rate", "tax_amount", "amount", "net_amount",
        "category", "buyer", "dept", "sale_name", "sale_company", "order_no", "terminal_price",
        (F.col("terminal_price") * F.coalesce("qty", F.lit(0))).cast(two).alias("terminal_amount"),
        F.coalesce("project_no", F.lit("")).alias("project_no"), F.coalesce("project_name", F.lit("")).alias("project_name"), "cost",
        (F.col("net_amount").cast(two) - F.col("cost").cast(two)).cast(two).alias("margin"),
    )


MARGIN_KEYS = [
    "project_no", "project_name", "customer_name", "contact_name", "brand", "brand_type", "material_no", "material_name",
    "specification", "material_group",
]


def margin_lines(t: Mapping[str, DataFrame], order_type: str = "2") -> DataFrame:
    """Approved receivable lines with project, material and cost, for ``gross_margin``.

    headers: bill_id, created_at, customer_id, org_id, order_type, status; entries:
    bill_id, entry_id, project_id, contact_id, material_id, qty, tax_percent, amount;
    costs: bill_id, entry_id, cost; projects: project_id, project_no, project_name, ratio,
    owner_org_id, use_org_id; orgs: org_id, org_no; customers; materials: material_id,
    material_no, material_name, specification, material_group, brand, brand_type. Lines
    without a project, its organisations, a material or a paying organisation are dropped.
    """
    orgs = t["orgs"]
    head = t["headers"].where((F.col("order_type") == order_type) & (F.col("status") == "C"))
    head = head.join(orgs.select("org_id"), "org_id", "left_semi").select("bill_id", "created_at", "customer_id")
    owner = orgs.select(F.col("org_id").alias("owner_org_id"), F.col("org_no").alias("__owner_no"))
    user = orgs.select(F.col("org_id").alias("use_org_id"), F.col("org_no").alias("__user_no"))
    projects = t["projects"].join(owner, "owner_org_id").join(user, "use_org_id")
    ratio = F.coalesce(F.col("ratio").cast("decimal(9,4)"), F.lit(0)) / 100
    projects = projects.select(
        "project_id", "project_no", "project_name", "ratio",
        F.when(F.col("__owner_no") == F.col("__user_no"), F.lit(0)).otherwise(ratio).cast("decimal(9,6)").alias("agent_rate"),
    )
    # Payers are looked up on the headers, which hold their key. What bringing lines and headers
    # together shuffles is deleted before the lookups shuffle the lines again.
    head = star_join(head, [Dim(t["customers"], {"customer_id": "customer_id"}, {"contact_name": "customer_name"})]).drop("customer_id")
    # Lines travel with the narrow tax; one that does not fit is an error only in a line that stays
    # (kept in an array, as a missing wide decimal takes as much room as one).
    zero, fits = F.lit(0), "decimal(6,4)"
    tax = (F.coalesce("tax_percent", zero) / 100).try_cast(fits)
    entries = t["entries"].select(
        "bill_id", "entry_id", "project_id", "contact_id", "material_id", "qty", "amount",
        tax.alias("tax"), F.when(tax.isNull(), F.array("tax_percent")).alias("__wide_tax"),
    )
    lines = written_table(head.join(entries, "bill_id"), "margin-lines", compact=True)
    # Narrow lookups first: the texts of projects and materials are shuffled least often.
    rows = star_join(
        lines,
        [
            Dim(t["costs"], {"bill_id": "bill_id", "entry_id": "entry_id"}, {"cost": "cost"}),
            Dim(t["customers"], {"contact_id": "customer_id"}, {"customer_name": "customer_name"}),
        ],
    )
    rows = rows.join(projects, "project_id").join(t["materials"], "material_id")
    return rows.select(
        *MARGIN_KEYS, "ratio", "agent_rate", "created_at",
        F.coalesce("qty", zero).alias("qty"), F.coalesce("tax", (F.col("__wide_tax")[0] / 100).cast(fits)).alias("tax"),
        F.coalesce("amount", zero).alias("amount"), F.coalesce("cost", zero).alias("cost"),
    )


def gross_margin(rows: DataFrame, keys: Sequence[str] = (*MARGIN_KEYS, "ratio", "created_at"), digits: int = 10) -> DataFrame:
    """Net and gross sale and cost per group, per unit and in total, and the gross margin.

    rows: ``keys``, agent_rate, tax (fraction), qty, amount (with tax), cost (without).
    With an agent rate the sale is grossed up by it and the cost is the sale before that,
    without tax. A zero quantity divides by one. Totals are summed exactly, ratios are
    rounded to ``digits``.
    """
    by = [*keys, "agent_rate", "tax"]
    sums = rows.groupBy(*by).agg(F.sum("qty").alias("__q"), F.sum("amount").alias("__a"), F.sum("cost").alias("__c"))
    rate, tax = F.col("agent_rate").cast("double"), F.coalesce(F.col("tax"), F.lit(0)).cast("double")
    amount, qty = F.col("__a").cast("double"), F.col("__q").cast("double")
    sale = F.when(rate > 0, F.try_divide(amount, rate)).otherwise(amount)
    cost = F.when(rate > 0, amount / (1 + tax)).otherwise(F.col("__c").cast("double"))
    units = F.when(F.coalesce(qty, F.lit(0.0)) == 0, F.lit(1.0)).otherwise(qty)
    sums = sums.withColumns({"__sale": sale, "__cost": cost, "__net": sale / (1 + tax), "__units": units})

    def out(c: Column, name: str) -> Column:
        return F.round(c, digits).alias(name)

    net, cost_, sale_, per = F.col("__net"), F.col("__cost"), F.col("__sale"), F.col("__units")
    return sums.select(
        *by, F.col("__q").alias("sale_qty"), F.col("__q").alias("cost_qty"),
        out(net / per, "net_sale_price"), out(sale_ / per, "tax_sale_price"), out(net, "net_sale_amount"), out(sale_, "tax_sale_amount"),
        out(cost_ / per, "net_cost_price"), out(cost_ * (1 + tax) / per, "tax_cost_price"), out(cost_, "net_cost_amount"),
        out(cost_ * (1 + tax), "tax_cost_amount"), out(net - cost_, "gross_margin"),
    )


def margin_sheet(margins: DataFrame, texts: Sequence[str] = (*MARGIN_KEYS, "ratio", "created_at")) -> DataFrame:
    """``gross_margin`` in the declared types of the report: no NULL texts, taxes with two
    digits, prices and amounts with ten."""
    amounts = (
        "net_sale_price", "tax_sale_price", "net_sale_amount", "tax_sale_amount",
        "net_cost_price", "tax_cost_price", "net_cost_amount", "tax_cost_amount", "gross_margin",
    )
    tax = F.col("tax").cast("decimal(6,2)")
    return margins.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in texts],
        "sale_qty", tax.alias("sale_tax"), "cost_qty", tax.alias("cost_tax"), *[F.col(c).cast("decimal(23,10)").alias(c) for c in amounts],
    )
