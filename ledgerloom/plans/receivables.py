"""Receivables: boards, receipts, payment and invoicing status, sales performance.

Input frames (extra columns are ignored):

headers       bill_id, org_id, customer_id, status, business_day, created_at, invoiced_on
entries       bill_id, project_id, project_text (number typed on the line), seller_id,
              order_no, qty, price, tax_price, cost
customers     customer_id, customer_name
projects      project_id, project_no, project_name, ratio
tickets       ticket_no, company, dept, seller_id
sellers       seller_id, seller_name
short_names   project_name, short_name, online
sale_orders   order_no, agent_flag, address
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions import codes
from ledgerloom.functions.scalars import (
    MONEY_TYPE, ColumnLike, after_first, aging_days, as_col, day_text, first_name, is_blank, nullif_blank, parse_date,
)
from ledgerloom.functions.text import keyword_region
from ledgerloom.operators.aggregates import money_sum, ratio_sum
from ledgerloom.operators.joins import Dim, header_join, star_join
from ledgerloom.session import written_table
from ledgerloom.plans.upkeep import previous_month

APPROVED = "C"


@dataclass(frozen=True)
class OrgRule:
    """Rows of one organisation, less some customers, project names or short names."""

    org_id: str
    excluded_customers: tuple[str, ...] = ()
    excluded_project_text: str | None = None
    excluded_short_name: str | None = None


def in_scope(
    rules: Sequence[OrgRule], org: ColumnLike, customer: ColumnLike, project: ColumnLike, short: ColumnLike | None = None
) -> Column:
    """Any rule holds. A missing name fails the rules that test it."""
    tests = []
    for rule in rules:
        test = as_col(org) == rule.org_id
        if rule.excluded_customers:
            test = test & ~as_col(customer).isin(*rule.excluded_customers)
        if rule.excluded_project_text is not None:
            test = test & ~F.contains(as_col(project), F.lit(rule.excluded_project_text))
        if rule.excluded_short_name is not None and short is not None:
            test = test & (as_col(short) != rule.excluded_short_name)
        tests.append(test)
    return reduce(lambda a, b: a | b, tests)


def _project_dims(t: Mapping[str, DataFrame]) -> list[Dim]:
    return [
        Dim(t["projects"], {"project_id": "project_id"}, {"project_no": "project_no", "project_name": "project_name", "ratio": "ratio"}),
        Dim(t["tickets"], {"project_no": "ticket_no"}, {"company": "company", "dept": "dept", "ticket_seller_id": "seller_id"}),
        Dim(t["short_names"], {"project_name": "project_name"}, {"short_name": "short_name", "online": "online"}),
        Dim(t["sellers"], {"ticket_seller_id": "seller_id"}, {"ticket_seller": "seller_name"}),
    ]


def receivable_lines(t: Mapping[str, DataFrame], rules: Sequence[OrgRule], company: str | None = None) -> DataFrame:
    """Approved receivable lines in scope with project, ticket, seller and order details."""
    head = t["headers"].where(F.col("status") == APPROVED).select(
        "bill_id", "org_id", "customer_id", "business_day", "created_at", "invoiced_on"
    )
    head = star_join(head, [Dim(t["customers"], {"customer_id": "customer_id"}, {"customer_name": "customer_name"})])
    body = t["entries"].select(
        "bill_id", "project_id", "project_text", F.col("seller_id").alias("entry_seller_id"), nullif_blank("order_no").alias("order_no"),
        (F.col("qty") * F.col("price")).alias("net_amount"), (F.col("qty") * F.col("tax_price")).alias("tax_amount"), "cost",
    )
    out = star_join(
        header_join(head, body, "bill_id"),
        [
            *_project_dims(t),
            Dim(t["sellers"], {"entry_seller_id": "seller_id"}, {"entry_seller": "seller_name"}),
            # Many lines have no order.
            Dim(t["sale_orders"], {"order_no": "order_no"}, {"agent_flag": "agent_flag", "address": "address"}, spread=("bill_id", "project_id")),
        ],
    )
    out = out.where(in_scope(rules, "org_id", "customer_name", "project_name", "short_name"))
    return out if company is None else out.where(F.col("company") == company)


def settlement_lines(
    t: Mapping[str, DataFrame], bills: str, rows: str, rules: Sequence[OrgRule], company: str | None = None
) -> DataFrame:
    """Approved receipt or refund lines in scope.

    ``t[bills]``: bill_id, org_id, customer_id, status, created_at; ``t[rows]``: bill_id,
    project_id, amount.
    """
    head = t[bills].where(F.col("status") == APPROVED).select("bill_id", "org_id", "customer_id", "created_at")
    head = star_join(head, [Dim(t["customers"], {"customer_id": "customer_id"}, {"customer_name": "customer_name"})])
    out = star_join(header_join(head, t[rows].select("bill_id", "project_id", "amount"), "bill_id"), _project_dims(t))
    out = out.where(in_scope(rules, "org_id", "customer_name", "project_name", "short_name"))
    return out if company is None else out.where(F.col("company") == company)


def project_totals(lines: DataFrame, keys: Sequence[ColumnLike], day: ColumnLike, total: Column) -> DataFrame:
    """First day and a total (``money_sum`` or ``ratio_sum``) per key."""
    return lines.groupBy(*keys).agg(day_text(F.min(as_col(day))).alias("first_day"), total.alias("amount"))


def project_form(mark: str, agent: bool = False, number: str = "project_no") -> Column:
    """Self-run unless the project number carries the agency mark (or the order flag is set)."""
    marked = F.contains(F.col(number), F.lit(mark))
    if agent:
        marked = (F.col("agent_flag") == "1") | marked
    return F.when(marked, codes.AGENT_RUN).otherwise(codes.SELF_RUN)


def shipped_totals(lines: DataFrame, mark: str) -> DataFrame:
    """All shipped amounts per project and ticket seller, grossed up by the project ratio."""
    keys = [
        F.col("ticket_seller").alias("seller"), "project_no", "project_name",
        project_form(mark).alias("form"), first_name("short_name", codes.OTHER).alias("short_name"),
    ]
    return project_totals(lines, keys, "business_day", ratio_sum("tax_amount", "ratio"))


def invoiced_totals(lines: DataFrame) -> DataFrame:
    """All invoiced amounts per project and ticket seller."""
    keys = [F.col("ticket_seller").alias("seller"), "project_no", "project_name", first_name("short_name", codes.OTHER).alias("short_name")]
    return project_totals(lines, keys, "invoiced_on", money_sum("tax_amount"))


def net_receipts(receipts: DataFrame, refunds: DataFrame, keys: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """Receipts less refunds per key, from whichever side has the key.

    Both inputs (keys, carry, amount) are already reduced; ``carry`` columns come from the
    receipt, else from the refund.
    """
    cols = [*keys, *carry]
    back = refunds.select(*[F.col(k).alias(f"__{k}") for k in cols], F.col("amount").alias("__back"))
    joined = receipts.join(back, [F.col(k) == F.col(f"__{k}") for k in keys], "full")
    return joined.select(
        *[F.coalesce(k, f"__{k}").alias(k) for k in cols],
        (F.coalesce("amount", F.lit(0)) - F.coalesce("__back", F.lit(0))).alias("net"),
    )


def receipts_by_day(receipts: DataFrame, refunds: DataFrame) -> DataFrame:
    """Net receipts per project and day, with seller and short name (``settlement_lines``).

    The organisations' settlements stay separate rows until they meet on project and day.
    """
    carry = ["seller", "short_name"]

    def daily(rows: DataFrame) -> DataFrame:
        keys = [F.col("ticket_seller").alias("seller"), "project_no", "project_name", "short_name", "org_id", day_text("created_at").alias("day")]
        return rows.groupBy(*keys).agg(F.sum("amount").alias("amount"))

    return net_receipts(daily(receipts), daily(refunds), ["project_no", "day"], carry)


def per_project(lines: DataFrame, merge_scopes: bool = True, sign: int = 1) -> DataFrame:
    """Settled amount per project.

    The boards list the two organisations' settlements as separate rows
    (``merge_scopes=False``), which repeats a board line whose project has both.
    """
    keys = ["project_no"] if merge_scopes else ["project_no", "org_id"]
    return lines.groupBy(*keys).agg((F.sum("amount") * sign).cast(MONEY_TYPE).alias("amount")).select("project_no", "amount")


def settled_amounts(receipts: DataFrame, refunds: DataFrame, since: Column, this_year: Column, merge_scopes: bool = True) -> DataFrame:
    """paid, refunded (negative), paid_year and refunded_year per project, from one pass.

    Without ``merge_scopes`` each is an array with an element per organisation that has such
    settlements, as ``per_project`` lists them; organisations are the few of the scope.
    """
    cols = ["project_no", "org_id", "created_at"]
    rows = receipts.select(*cols, "amount", F.lit(True).alias("__in")).unionByName(refunds.select(*cols, "amount", F.lit(False).alias("__in")))
    chosen = {
        "paid": F.col("__in") & since, "refunded": ~F.col("__in") & since,
        "paid_year": F.col("__in") & this_year, "refunded_year": ~F.col("__in") & this_year,
    }
    # Rows of no wanted period add to no total.
    rows = rows.where(since | this_year)
    totals = {name: F.sum(F.when(wanted, F.col("amount"))) * (-1 if name == "refunded" else 1) for name, wanted in chosen.items()}
    totals = {name: total.cast(MONEY_TYPE) for name, total in totals.items()}
    if merge_scopes:
        return rows.groupBy("project_no").agg(*[total.alias(name) for name, total in totals.items()])
    parts = [F.when(F.count_if(wanted) > 0, F.struct(totals[name].alias("amount"))).alias(name) for name, wanted in chosen.items()]
    return rows.groupBy("project_no", "org_id").agg(*parts).groupBy("project_no").agg(*[F.collect_list(name).alias(name) for name in chosen])


def hand_ledger(ledger: DataFrame) -> DataFrame:
    """Hand-kept opening balances (project_no, seller, project_name, short_name, day, amount, org_level)."""
    return (
        ledger.where(~is_blank("org_level"))
        .groupBy("project_no", "seller", "project_name", after_first("short_name", "-").alias("short_name"))
        .agg(F.min("day").alias("day"), money_sum("amount").alias("amount"))
    )


def _zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0)).cast(MONEY_TYPE)


def _attach(df: DataFrame, key: str, facts: Mapping[str, DataFrame]) -> DataFrame:
    return star_join(df, [Dim(frame, {key: "project_no"}, {name: "amount"}) for name, frame in facts.items()])


def receivable_board(
    lines: DataFrame,
    ledger: DataFrame,
    receipts: DataFrame,
    refunds: DataFrame,
    cutoff: str,
    as_of: str,
    mark: str,
    merge_scopes: bool = True,
) -> DataFrame:
    """Open receivables: opening ledger met with old lines, plus lines since the cutoff.

    ``lines``, ``receipts`` and ``refunds`` come from ``receivable_lines`` and
    ``settlement_lines``; ``ledger`` from ``hand_ledger``. ``cutoff`` is the first day
    the system itself accounts for. A project with several old lines meets its ledger row
    once per line, as the report defines it.
    """
    created = F.col("created_at")
    since, year = created >= cutoff, F.year(F.date_sub(F.lit(as_of).cast("date"), 1))
    year_start = F.concat_ws("-", year.cast("string"), F.lit("01-01")).cast("timestamp")
    year_end = F.concat_ws("-", (year + 1).cast("string"), F.lit("01-01")).cast("timestamp")
    this_year = (created >= year_start) & (created < year_end)

    # One pass over the lines: those since the cutoff are groups of their own, which take
    # the day of the invoice and the project number typed on the line.
    form = F.when(since, project_form(mark, agent=True, number="project_text")).otherwise(project_form(mark, agent=True))
    keys = [
        since.alias("__new"), F.col("entry_seller").alias("seller"), "project_no", "project_name",
        form.alias("form"), first_name("short_name", codes.OTHER).alias("short_name"),
    ]
    grouped = lines.where(since.isNotNull()).groupBy(*keys).agg(
        day_text(F.min("created_at")).alias("__created"), day_text(F.min("invoiced_on")).alias("__invoiced"), money_sum("tax_amount").alias("amount")
    )
    opening = ledger.select(*[F.col(c).alias(f"l_{c}") for c in ("project_no", "seller", "project_name", "short_name", "day", "amount")])
    met = grouped.join(opening, ~F.col("__new") & (F.col("project_no") == F.col("l_project_no")), "full")

    is_new = F.coalesce("__new", F.lit(False))
    first_day = F.when(is_new, F.col("__invoiced")).otherwise(F.col("__created"))
    met = met.select(
        is_new.alias("__new"), "l_project_no",
        F.coalesce("l_seller", "seller").alias("seller"),
        F.coalesce("l_day", first_day).alias("day"),
        F.col("project_no").alias("__line_project"),
        F.coalesce("l_project_no", "project_no").alias("project_no"),
        F.coalesce("project_name", "l_project_name").alias("project_name"),
        "form",
        F.coalesce("short_name", "l_short_name").alias("short_name"),
        F.col("amount").alias("sale_amount"),
        F.when(is_new, _zero("amount")).otherwise(_zero("l_amount")).alias("__due"),
        F.when(is_new, first_day).otherwise(F.col("l_day")).alias("__aged_from"),
    )
    settled = settled_amounts(receipts, refunds, since, this_year, merge_scopes).withColumnRenamed("project_no", "__settled")
    board = met.join(settled, F.col("project_no") == F.col("__settled"), "left")
    # Old lines count settlements for their ledger row, and those of the year for themselves.
    for name in ("paid", "refunded"):
        board = board.withColumn(name, F.when(is_new | F.col("l_project_no").isNotNull(), F.col(name)))
    for name in ("paid_year", "refunded_year"):
        board = board.withColumn(name, F.when(F.col("__line_project").isNotNull(), F.col(name)))
    for name in () if merge_scopes else ("paid", "refunded", "paid_year", "refunded_year"):
        board = board.withColumn(name, F.explode_outer(name)).withColumn(name, F.col(name)["amount"])
    return board.select(
        "seller", "day", "project_no", "project_name", "form", "short_name", "sale_amount", "paid", "refunded",
        (F.col("__due") - _zero("paid") - _zero("refunded")).cast(MONEY_TYPE).alias("open_amount"),
        aging_days("__aged_from", as_of).cast("bigint").alias("aging"),
        F.lit(previous_month(as_of)).alias("update_month"),
        (_zero("paid_year") - _zero("refunded_year")).cast(MONEY_TYPE).alias("year_amount"),
    )


def tolerance_amount(shipped: ColumnLike, invoiced: ColumnLike, ledger: ColumnLike) -> Column:
    """Amount still open when earlier invoices and a hand ledger meet the shipments.

    With d = shipped - invoiced and h = ledger: nothing for d < 1 without ledger; d + h
    for d within one unit of zero; the shipments alone for d below that; d + h above.
    Other combinations (such as d = 1 without ledger, or a negative ledger) are NULL.
    """
    shipped, d = as_col(shipped), as_col(shipped) - F.coalesce(as_col(invoiced), F.lit(0))
    h = F.coalesce(as_col(ledger), F.lit(0))
    return (
        F.when((d < 1) & (h == 0), F.lit(0))
        .when(d.between(-1, 1) & (h > 0), d + h)
        .when((d < -1) & (h > 0), shipped)
        .when(d > 1, d + h)
    )


def receivable_board_v2(
    shipped: DataFrame,
    invoiced_before: DataFrame,
    ledger: DataFrame,
    receipts: DataFrame,
    refunds: DataFrame,
    invoiced_since: DataFrame,
    ticket_sellers: DataFrame,
    as_of: str,
) -> DataFrame:
    """Open receivables of shipped goods, next to the invoiced part of them.

    shipped: project_no, project_name, form, short_name, first_day, amount (per seller);
    ledger: project_no, day, amount; invoiced_before, receipts, refunds: project_no,
    amount; invoiced_since: project_no, first_day, amount; ticket_sellers: project_no,
    seller. Projects already invoiced before go through ``tolerance_amount``; all others
    count as shipped. The report finds these with NOT IN, which a missing project number
    passes only when no project was invoiced before; both kinds come from one left join.
    """
    cols = ["first_day", "project_no", "project_name", "form", "short_name"]
    before = invoiced_before.select("project_no", "amount", F.lit(True).alias("met"))
    base = star_join(
        shipped,
        [
            Dim(before, {"project_no": "project_no"}, {"__invoiced": "amount", "__met": "met"}),
            Dim(ledger, {"project_no": "project_no"}, {"__ledger": "amount"}),
        ],
    )
    amount = F.when(F.col("__met"), tolerance_amount("amount", "__invoiced", "__ledger")).otherwise(F.col("amount"))
    met = shipped.select("project_no").join(before.select("project_no"), "project_no", "left_semi").agg(F.count(F.lit(1))).scalar()
    base = base.where(F.col("project_no").isNotNull() | (met == 0)).select(*cols, amount.cast(MONEY_TYPE).alias("amount"))

    hand = ledger.select(F.col("project_no").alias("__h"), F.col("day").alias("__hday"), F.col("amount").alias("__hamount"))
    inv = hand.join(invoiced_since, F.col("__h") == F.col("project_no"), "full").select(
        F.coalesce("__h", "project_no", F.lit("")).alias("project_no"),
        (F.coalesce("__hamount", F.lit(0)) + F.coalesce("amount", F.lit(0))).alias("amount"),
        F.coalesce("__hday", "first_day", F.lit("")).alias("day"),
    )
    out = _attach(base, "project_no", {"paid": receipts, "refunded": refunds})
    out = star_join(
        out,
        [
            Dim(ticket_sellers, {"project_no": "project_no"}, {"seller": "seller"}),
            Dim(inv, {"project_no": "project_no"}, {"inv_day": "day", "inv_amount": "amount"}),
        ],
    )

    def open_part(c: str) -> Column:
        left = _zero(c) - _zero("paid") + _zero("refunded")
        return F.when(left < 0, F.lit(0)).otherwise(left).cast(MONEY_TYPE)

    return out.select(
        "seller", F.col("first_day").alias("day"), "project_no", "project_name", "form", "short_name", "amount", "paid", "refunded",
        open_part("amount").alias("open_amount"),
        aging_days("first_day", as_of).cast("bigint").alias("aging"),
        F.lit(previous_month(as_of)).alias("update_month"),
        (_zero("paid") - _zero("refunded")).cast(MONEY_TYPE).alias("year_amount"),
        "inv_day",
        F.datediff(F.lit(as_of).cast("date"), F.col("inv_day").try_cast("date")).cast("bigint").alias("inv_aging"),
        F.when(F.coalesce("inv_amount", F.lit(0)) == 0, F.lit(0).cast(MONEY_TYPE)).otherwise(open_part("inv_amount")).alias("inv_open_amount"),
    )


def board_amounts(lines: DataFrame, mark: str, before: Column, since: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """shipped, invoiced_before and invoiced_since of ``receivable_board_v2``.

    One pass over the lines: they are reduced to the groups of ``shipped_totals`` with the
    amounts of both conditions, written once, and the two totals are taken from that.
    """
    keys = [
        F.col("ticket_seller").alias("seller"), "project_no", "project_name",
        project_form(mark).alias("form"), first_name("short_name", codes.OTHER).alias("short_name"),
    ]
    sums = {"before": before, "since": since}
    groups = lines.groupBy(*keys).agg(
        day_text(F.min("business_day")).alias("first_day"), ratio_sum("tax_amount", "ratio").alias("amount"),
        *[F.sum(F.when(when, F.col("tax_amount"))).alias(f"__{name}") for name, when in sums.items()],
        *[F.min(F.when(when, F.col("invoiced_on"))).alias(f"__{name}_day") for name, when in sums.items()],
    )
    groups = written_table(groups, "board-lines")

    def total(name: str) -> DataFrame:
        part = groups.where(F.col(f"__{name}_day").isNotNull())
        return part.groupBy("project_no").agg(day_text(F.min(f"__{name}_day")).alias("first_day"), F.sum(f"__{name}").cast(MONEY_TYPE).alias("amount"))

    return groups.drop("__before", "__since", "__before_day", "__since_day"), total("before"), total("since")


def opening_invoices(ledger: DataFrame, pattern: str = "yyyy/M/d") -> DataFrame:
    """Hand ledger per project: latest day (typed by hand as ``pattern``) and total."""
    return ledger.groupBy("project_no").agg(
        day_text(F.max(parse_date("day", pattern))).alias("day"), money_sum("amount").alias("amount")
    )


def sales_board(
    lines: DataFrame,
    region_levels: Sequence[Sequence[tuple[str, str]]],
    company_short: DataFrame,
    mark: str,
    by_address: bool = True,
) -> DataFrame:
    """Net and gross sales by seller, day, region and project.

    ``company_short``: company, company_short. The report groups by the raw address, so a
    region takes a row per address; ``by_address=False`` gives one row per region. The
    address is reduced before it is searched for place names, once per group.
    """
    form = (
        F.when(F.col("agent_flag") == "1", codes.SELF_RUN)
        .when(F.contains(F.col("project_no"), F.lit(mark)), codes.AGENT_RUN)
        .otherwise(codes.SELF_RUN)
    )
    keys = [
        F.col("entry_seller").alias("seller"), "company", "dept", day_text("business_day").alias("day"), "address",
        form.alias("form"),
        F.when(F.col("online") == codes.YES_NO["1"], codes.ONLINE).otherwise(codes.OFFLINE).alias("online"),
        first_name("short_name", codes.OTHER).alias("short_name"), "project_no",
    ]
    grouped = lines.groupBy(*keys).agg(
        ratio_sum("net_amount", "ratio").alias("amount"),
        ratio_sum("tax_amount", "ratio").alias("tax_amount"),
        money_sum("cost").alias("cost"),
    )
    # A missing address is searched as a text that names no place.
    grouped = grouped.withColumn("region", keyword_region(F.coalesce("address", F.lit("a")), region_levels))
    named = star_join(grouped, [Dim(company_short, {"company": "company"}, {"company_short": "company_short"})])
    cols = ["seller", "company", "dept", "day", "region", "form", "online", "short_name", "company_short", "project_no"]
    if by_address:
        return named.select(*cols, "amount", "tax_amount", "cost")
    return named.groupBy(*cols).agg(*[money_sum(c).alias(c) for c in ("amount", "tax_amount", "cost")])


def seller_list(lines: DataFrame) -> DataFrame:
    """Distinct seller, project and company combinations."""
    return lines.select(F.col("entry_seller").alias("seller"), "project_no", "project_name", "company").distinct()


def receivable_base(t: Mapping[str, DataFrame]) -> DataFrame:
    """Receivable lines of ticket orders with project and seller by two routes.

    headers: bill_id, customer_id, status, order_type, invoice_no, invoiced_on; entries:
    bill_id, project_id, ticket_no, amount; projects: project_id, project_no; tickets:
    ticket_no, ticket_name, seller_id; customers and sellers with numbers. The ticket is
    found by the project's number, else by the number typed on the line.
    """
    head = t["headers"].where((F.col("status") == APPROVED) & (F.col("order_type") == "1"))
    head = head.select("bill_id", "customer_id", "invoice_no", "invoiced_on")
    joined = head.join(t["entries"].select("bill_id", "project_id", "ticket_no", "amount"), "bill_id")

    def ticket(role: str, key: str) -> list[Dim]:
        return [
            Dim(t["tickets"], {key: "ticket_no"}, {f"{role}_no": "ticket_no", f"{role}_name": "ticket_name", f"{role}_sid": "seller_id"}),
            Dim(t["sellers"], {f"{role}_sid": "seller_id"}, {f"{role}_seller": "seller_name", f"{role}_seller_no": "seller_no"}),
        ]

    out = star_join(
        joined,
        [
            Dim(t["projects"], {"project_id": "project_id"}, {"project_key": "project_no"}),
            *ticket("a", "project_key"),
            *ticket("b", "ticket_no"),
            Dim(t["customers"], {"customer_id": "customer_id"}, {"customer_name": "customer_name", "customer_no": "customer_no"}),
        ],
    )

    def either(what: str, name: str) -> Column:
        return F.coalesce(f"a_{what}", f"b_{what}", F.lit("")).alias(name)

    return out.select(
        either("name", "project_name"), either("no", "project_no"), "customer_name", "customer_no",
        either("seller", "seller_name"), either("seller_no", "seller_no"), "invoice_no", "invoiced_on", "amount",
    )


def receipt_base(t: Mapping[str, DataFrame]) -> DataFrame:
    """Receipts with project, customer, seller and settlement type.

    receipts: bill_id, bill_no, day, amount, customer_id, seller_id; receipt_entries:
    bill_id, project_id, settle_type_id; settle_types: settle_type_id, settle_type.
    """
    joined = header_join(t["receipts"], t["receipt_entries"].select("bill_id", "project_id", "settle_type_id"), "bill_id")
    return star_join(
        joined,
        [
            Dim(t["projects"], {"project_id": "project_id"}, {"project_no": "project_no", "project_name": "project_name"}),
            Dim(t["customers"], {"customer_id": "customer_id"}, {"customer_no": "customer_no", "customer_name": "customer_name"}),
            Dim(t["sellers"], {"seller_id": "seller_id"}, {"seller_no": "seller_no", "seller_name": "seller_name"}),
            Dim(t["settle_types"], {"settle_type_id": "settle_type_id"}, {"settle_type": "settle_type"}),
        ],
    ).select(
        "bill_no", "day", "amount", "settle_type", "project_no", "project_name", "customer_no", "customer_name", "seller_no", "seller_name"
    )


def payment_state(due: ColumnLike, received: ColumnLike) -> Column:
    """Paid, partly paid, unpaid or other, tested in this order."""
    due, got = as_col(due), F.coalesce(as_col(received), F.lit(0))
    return (
        F.when((due - got <= 0) & (due != 0) & (got != 0), codes.PAID)
        .when((due - got > 0) & (due - got < due), codes.PART_PAID)
        .when(got == 0, codes.UNPAID)
        .otherwise(codes.OTHER_STATUS)
    )


def payment_status(receivables: DataFrame, receipts: DataFrame, internal_customers: Sequence[str]) -> DataFrame:
    """Due against received per project, without internal customers.

    Inputs as of ``receivable_base`` and ``receipt_base``. Rows without a customer name
    are dropped, as by any NOT IN. Total and last day of the receipts share one pass.
    """
    outside = ~F.trim("customer_name").isin(*internal_customers)
    due = receivables.where(outside).groupBy("project_no", "project_name", "seller_name", "seller_no").agg(
        F.sum(F.col("amount").cast("decimal(19,4)")).alias("due")
    )
    got = receipts.where(F.col("project_no").isNotNull() & outside).groupBy("project_no").agg(
        F.sum(F.col("amount").cast("decimal(19,4)")).alias("received"), F.max("day").alias("last_day")
    )
    received = F.coalesce("received", F.lit(0))
    return due.join(got, "project_no", "left").select(
        "project_no", "project_name", payment_state("due", "received").alias("status"), "seller_name", "seller_no",
        F.col("due").cast(MONEY_TYPE).alias("due"), received.cast(MONEY_TYPE).alias("received"),
        (F.col("due") - received).cast(MONEY_TYPE).alias("difference"),
        F.coalesce(F.col("last_day").cast("string"), F.lit("")).alias("last_day"),
    )


def invoice_state(invoiced: ColumnLike, open_amount: ColumnLike, closed: ColumnLike) -> Column:
    """Fully, partly or not invoiced from the invoiced and open amounts and the close code."""
    done, left, closed = F.coalesce(as_col(invoiced), F.lit(0)), F.coalesce(as_col(open_amount), F.lit(0)), as_col(closed)
    return (
        F.when((done > 0) & (left <= 0), codes.INVOICED)
        .when((done > 0) & (left >= 0) & (closed == "B"), codes.INVOICED)
        .when((done > 0) & (left > 0) & (closed == "A"), codes.PART_INVOICED)
        .when(done <= 0, codes.NOT_INVOICED)
        .otherwise(codes.OTHER)
    )


def invoice_status(tickets: DataFrame, invoices: DataFrame) -> DataFrame:
    """Invoicing status per ticket with its latest invoice day.

    tickets: ticket_id, ticket_no, close_code, invoiced, open_amount; invoices: ticket_no,
    invoiced_on. A blank ticket number on an invoice stands for any missing one.
    """
    latest = invoices.groupBy(F.coalesce("ticket_no", F.lit("")).alias("ticket_no")).agg(F.max("invoiced_on").alias("last_invoice"))
    return tickets.join(latest, "ticket_no", "left").select(
        "ticket_id", "ticket_no",
        F.when(F.col("close_code") == "A", codes.CLOSE_STATUS["A"])
        .when(F.col("close_code") == "B", codes.CLOSE_STATUS["B"])
        .otherwise(codes.UNKNOWN)
        .alias("close_status"),
        invoice_state("invoiced", "open_amount", "close_code").alias("status"),
        "invoiced", "open_amount",
        F.coalesce(F.col("last_invoice").cast("string"), F.lit("")).alias("last_invoice"),
    )
