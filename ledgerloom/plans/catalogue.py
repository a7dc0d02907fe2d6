"""Material catalogue, ledger balances, payables, unit check, single-bill lookup."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from ledgerloom.functions import codes
from ledgerloom.functions.scalars import decode, keep_unless, part_of
from ledgerloom.operators.joins import Dim, membership_join, star_join
from ledgerloom.operators.windows import global_row_id
from ledgerloom.sources.tables import period_slice


def category_path(df: DataFrame, key: str, categories: DataFrame, depth: int = 4) -> DataFrame:
    """Names and codes of a category and its parents, as ``category_<level>`` columns.

    categories: id, parent_id, level, code, name. ``key`` points at level ``depth``; the
    walk up is one lookup per level, each on the rows of that level only.
    """
    out, at = df, key
    for level in range(depth, 0, -1):
        side = categories if level == depth else categories.where(F.col("level") == str(level))
        up = f"__up{level}"
        out = star_join(out, [Dim(side, {at: "id"}, {f"category_{level}": "name", f"category_{level}_code": "code", up: "parent_id"})])
        at = up
    out = out.drop(*[f"__up{level}" for level in range(depth, 0, -1)])
    text = {f"category_{level}{end}": F.coalesce(f"category_{level}{end}", F.lit("")) for level in range(1, depth + 1) for end in ("", "_code")}
    return out.withColumns(text)


def material_catalogue(t: Mapping[str, DataFrame], excluded_category: str, sep: str = "、") -> DataFrame:
    """Materials with platforms, category path, decoded flags, sizes and links.

    materials: material_id, code, name, specification, category_id, category_two, shipper,
    bar_code, mnemonic, supplier_code, platform_codes, description, old_code, market_price,
    price, transfer_price, reference_price, brand_id, unit_code, remark, shelf_state,
    sale_state, tax_code, assess_code, dept_id, buyer_id, examiner_id, creator_id,
    creator_name, gross_weight, weight, size, content, nature, disabled, affects_price,
    affects_cost, manager_id, min_order, delivery_days, grade, links. Dims: categories,
    platforms (code, name), brands (brand_id, brand_code, name_en, name_cn), units,
    assess_types, depts, employees (id, code, name), managers. Materials without a second
    category stay.
    """
    rows = t["materials"].where(keep_unless("category_two", excluded_category))
    rows = membership_join(rows, "material_id", "platform_codes", sep, t["platforms"], "code", "name", "platforms")
    rows = category_path(rows, "category_id", t["categories"])
    staff = t["employees"]
    rows = star_join(
        rows,
        [
            Dim(t["brands"], {"brand_id": "brand_id"}, {"brand_code": "brand_code", "__en": "name_en", "__cn": "name_cn"}),
            Dim(t["units"], {"unit_code": "unit_code"}, {"unit": "unit_name"}),
            Dim(t["assess_types"], {"assess_code": "code"}, {"assess_type": "name"}),
            Dim(t["depts"], {"dept_id": "id"}, {"dept_code": "code", "dept": "name"}),
            Dim(staff, {"buyer_id": "id"}, {"buyer_code": "code", "buyer": "name"}),
            Dim(staff, {"examiner_id": "id"}, {"examiner_code": "code", "examiner": "name"}),
            Dim(staff, {"creator_id": "id"}, {"__cid": "id", "__creator": "name"}),
            Dim(t["managers"], {"manager_id": "id"}, {"manager": "name"}),
        ],
    )
    blank = {c: F.coalesce(c, F.lit("")) for c in ("assess_type", "dept_code", "dept", "buyer_code", "buyer", "examiner_code", "examiner", "manager")}
    rows = rows.withColumns(blank)
    unknown = codes.UNKNOWN

    def flag(c: str, mapping: Mapping[str, str], name: str | None = None):
        return decode(c, mapping, unknown).alias(name or c)

    path = [f"category_{level}{end}" for level in range(4, 0, -1) for end in ("_code", "")]
    return rows.select(
        "code", *path, "shipper", "name", "specification", "bar_code", "mnemonic", "supplier_code", "platforms", "description", "old_code",
        "market_price", "price", "transfer_price", "reference_price", "brand_code",
        F.concat_ws("/", F.coalesce("__en", F.lit("")), F.coalesce("__cn", F.lit(""))).alias("brand"), "unit", "remark",
        flag("shelf_state", codes.SHELF_STATE), flag("sale_state", codes.SALE_STATE), flag("tax_code", codes.TAX_RATE, "tax_rate"),
        "assess_type", "assess_code", "dept_code", "dept", "buyer_code", "buyer", "examiner_code", "examiner", "gross_weight", "weight",
        *[part_of("size", sep, i).alias(n) for i, n in enumerate(("length", "width", "height"))],
        F.when(F.coalesce("content", F.lit("")) != "", codes.YES_NO["1"]).otherwise(codes.YES_NO["0"]).alias("has_picture"),
        F.when(F.coalesce("__cid", F.lit("")) != "", F.col("__creator")).otherwise(F.col("creator_name")).alias("creator"),
        flag("nature", codes.DATA_NATURE), flag("disabled", codes.YES_NO), flag("affects_price", codes.YES_NO), "affects_cost", "manager",
        "min_order", "delivery_days", flag("grade", codes.MATERIAL_GRADE), *[part_of("links", sep, i).alias(f"link{i + 1}") for i in range(4)],
    )


def ledger_balances(
    t: Mapping[str, DataFrame], period: str, currency: str, balance_type: str, company: str, whole_year: bool = False
) -> DataFrame:
    """Account balances of one company for a period (``yyyyMM``) or its year to date.

    balances: period (``yyyyMM`` or a day, which reaches the scan as a range), company_id, account_id, currency_id, balance_type, debit, credit,
    ending; dims: companies (company_id, company_no, company_name), accounts, currencies.
    """
    rows = period_slice(t["balances"], "period", period, whole_year).where(F.col("balance_type") == balance_type)
    companies = t["companies"].where(F.col("company_no") == company)
    currencies = t["currencies"].where(F.col("currency_no") == currency).select("currency_id")
    if not isinstance(rows.schema["period"].dataType, T.StringType):
        rows = rows.withColumn("period", F.date_format("period", "yyyyMM"))
    rows = rows.join(currencies, "currency_id", "left_semi").join(companies.select("company_id", "company_name"), "company_id")
    rows = star_join(rows, [Dim(t["accounts"], {"account_id": "account_id"}, {"account_name": "account_name", "account_no": "account_no"})])
    money = "decimal(19,4)"
    return rows.select(
        "company_name", "period", "account_name", "account_no", *[F.col(c).cast(money).alias(c) for c in ("debit", "credit", "ending")]
    )


def payables_wide(t: Mapping[str, DataFrame], org: str, ties: Sequence[str]) -> DataFrame:
    """Approved payable lines with everything looked up, and a row id by date.

    headers: bill_id, bill_no, bill_type_id, business_type, day, due_day, supplier_id,
    currency_id, total, settle_org_id, purchase_org_id, pay_org_id, dept_id, buyer_id,
    status; entries: bill_id, entry_id, material_id, price_unit_id, price, price_qty,
    tax_price, net_tax_price, tax_rate, comment, discount_rate, source_no, order_no,
    source_type, discount, net_amount, tax, amount, base_qty, local_tax, local_amount,
    local_net, paid, stock_id, sale_order_no, seller_id, project_id, reference_price,
    transfer_diff, division_id, bin_id; entry_stock: entry_id, is_free, stock_unit_id,
    stock_qty, stock_base_qty, lot_id; dims by their ids. ``ties`` (header or entry
    columns) make the date order total. Lookups by a key of the headers or stock rows are
    made on those, which are fewer and narrower than the lines, and no line lacks such a key
    for want of a stock row. Lines are numbered before their own lookups, which are by
    unique ids: the ordered shuffle then moves the lines and their header's names alone.
    """
    head = t["headers"].where((F.col("status") == "C") & (F.col("settle_org_id") == org))
    orgs, units = t["orgs"], t["units"]
    lookups = [
        Dim(t["bill_types"], {"bill_type_id": "bill_type_id"}, {"bill_type": "bill_type_name"}),
        Dim(t["suppliers"], {"supplier_id": "supplier_id"}, {"supplier": "supplier_name"}),
        Dim(t["currencies"], {"currency_id": "currency_id"}, {"currency": "currency_name"}),
        Dim(orgs, {"settle_org_id": "org_id"}, {"settle_org": "org_name"}),
        Dim(orgs, {"purchase_org_id": "org_id"}, {"purchase_org": "org_name"}),
        Dim(orgs, {"pay_org_id": "org_id"}, {"pay_org": "org_name"}),
        Dim(t["depts"], {"dept_id": "dept_id"}, {"dept": "dept_name"}),
        Dim(t["buyers"], {"buyer_id": "buyer_id"}, {"buyer": "buyer_name", "buyer_no": "buyer_no"}),
        Dim(units, {"price_unit_id": "unit_id"}, {"price_unit": "unit_name"}),
        Dim(t["stocks"], {"stock_id": "stock_id"}, {"stock": "stock_name"}),
        Dim(t["sellers"], {"seller_id": "seller_id"}, {"seller": "seller_name", "seller_dept": "dept_name"}),
        Dim(t["projects"], {"project_id": "project_id"}, {"project_no": "project_no", "project_name": "project_name", "ratio": "ratio"}),
        Dim(t["divisions"], {"division_id": "division_id"}, {"division": "division_name"}),
        Dim(t["bins"], {"bin_id": "bin_id"}, {"bin": "bin_name"}),
    ]
    stored = star_join(
        t["entry_stock"],
        [
            Dim(units, {"stock_unit_id": "unit_id"}, {"stock_unit": "unit_name"}),
            Dim(t["lots"], {"lot_id": "lot_id"}, {"lot_no": "lot_no"}, spread=["entry_id"]),
        ],
    )
    in_stock = ("is_free", "stock_unit", "stock_qty", "stock_base_qty", "lot_no")
    material = ("material_no", "specification", "material_name", "description", "brand_id", "category_id")
    of_head = [d for d in lookups if set(d.on) <= set(head.columns)]
    of_line = [
        Dim(stored, {"entry_id": "entry_id"}, {c: c for c in in_stock}),
        *[d for d in lookups if d not in of_head],
        Dim(t["materials"], {"material_id": "material_id"}, {c: c for c in material}),
        Dim(t["brands"], {"brand_id": "brand_id"}, {"brand": "brand_name"}),
        Dim(t["categories"], {"category_id": "category_id"}, {"category": "category_name"}),
    ]
    order = [F.col(c).asc_nulls_first() for c in ("day", *ties)]
    done = {"status", *(c for d in of_head for c in d.on)} - {"bill_id", "day", *ties}
    rows = star_join(head, of_head).drop(*done).join(t["entries"], "bill_id")
    rows = star_join(global_row_id(rows, order, "row_id"), of_line)
    return rows.select(
        "row_id", "bill_type", decode("business_type", codes.BUSINESS_TYPE, codes.BUSINESS_TYPE_DEFAULT).alias("business_type"), "day", "supplier",
        "bill_no", "currency", "total", "due_day", "settle_org", "purchase_org", "dept", "buyer", "buyer_no",
        F.lit(codes.DOCUMENT_STATUS["C"]).alias("status"), "pay_org", "material_no", "specification", "material_name", "price_unit", "price",
        "price_qty", "tax_price", "net_tax_price", "tax_rate", "comment", "discount_rate", "source_no", "order_no",
        decode("source_type", codes.SOURCE_TYPE, codes.SOURCE_TYPE_DEFAULT).alias("source_type"), "discount", "net_amount", "tax", "amount",
        "base_qty", "lot_no", "local_tax", "local_amount", "local_net", decode("is_free", codes.YES_NO, codes.UNKNOWN).alias("is_free"),
        "stock_unit", "stock_qty", "stock_base_qty", "paid", "description", "brand", "stock", "sale_order_no", "seller", "seller_dept",
        "project_no", "project_name", "reference_price", "transfer_diff", "division", "bin", "ratio", "category",
    )


def unit_mismatch(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Materials (code, unit) whose unit differs in the other system; a missing unit is no difference."""
    other = theirs.select("code", F.col("unit").alias("other_unit"))
    return ours.select("code", "unit").join(other, "code").where(F.col("unit") != F.col("other_unit"))


def bill_lines(lines: DataFrame, projects: DataFrame, bill_no) -> DataFrame:
    """Project numbers of the lines of one bill; ``bill_no`` in the column's own type, so the scan can skip."""
    found = lines.where(F.col("bill_no") == bill_no)
    return star_join(found, [Dim(projects, {"project_id": "project_id"}, {"project_no": "project_no"})])
