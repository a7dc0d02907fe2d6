"""Flat document tables: header, entries and their satellites in one row; staff directory."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ledgerloom.operators.joins import Dim, header_join, star_join


@dataclass(frozen=True)
class Satellite:
    """One-to-one companion of an entry (amounts, relations, source links) or its lot."""

    table: str
    take: tuple[str, ...]
    key: str = "entry_id"
    own_key: str | None = None


@dataclass(frozen=True)
class DocumentSpec:
    """Tables of one document type and the columns its flat table keeps."""

    header: str
    entry: str
    header_cols: tuple[str, ...]
    entry_cols: tuple[str, ...]
    satellites: tuple[Satellite, ...] = ()


HEAD = ("bill_id", "bill_no", "status", "creator_id", "created_at", "approver_id", "approved_at")
DATED = (*HEAD, "org_id", "business_date")
LINE = ("entry_id", "material_id")
LOT = Satellite("lot", ("lot_no",), key="lot_id")
PRICED = ("price", "tax_price", "amount", "gross_amount")

# The seven flat tables of the warehouse. ``org_id`` is the organisation that buys, stocks,
# delivers, settles or sells; ``business_date`` the date typed on the document.
DOCUMENTS: dict[str, DocumentSpec] = {
    "requisition": DocumentSpec(
        "requisition", "requisition_entry",
        (*HEAD, "org_id", "applicant_org_id", "applied_at"), (*LINE, "project_id", "seller_id", "req_qty", "approved_qty"),
        (Satellite("requisition_entry_rel", ("source_bill_no",)),),
    ),
    "purchase_order": DocumentSpec(
        "purchase_order", "purchase_order_entry",
        (*DATED, "supplier_id", "buyer_id", "dept_id"), (*LINE, "qty"),
        (Satellite("purchase_order_entry_fin", PRICED), Satellite("purchase_order_entry_rel", ("source_bill_no",))),
    ),
    "receipt": DocumentSpec(
        "receipt", "receipt_entry",
        DATED, (*LINE, "lot_id", "stock_id", "due_qty", "received_qty", "is_gift", "source_bill_no"),
        (Satellite("receipt_entry_fin", ("not_joined_qty", "line_amount")), LOT),
    ),
    "delivery_notice": DocumentSpec(
        "delivery_notice", "delivery_notice_entry", DATED, (*LINE, "lot_id", "qty", "source_bill_no"), (LOT,),
    ),
    "shipment": DocumentSpec(
        "shipment", "shipment_entry",
        DATED, (*LINE, "due_qty", "shipped_qty", "line_amount"),
        (
            Satellite("shipment_entry_fin", PRICED),
            Satellite("shipment_entry_rel", ("source_bill_no", "joined_qty", "joined_amount", "receivable_amount", "not_joined_qty")),
        ),
    ),
    "settlement": DocumentSpec(
        "settlement", "settlement_entry",
        DATED, (*LINE, "qty", *PRICED, "referred_qty", "referred_amount", "base_qty", "base_amount", "source_bill_no"),
    ),
    "sale_order": DocumentSpec(
        "sale_order", "sale_order_entry",
        (
            *DATED, "customer_id", "seller_id", "operator_id", "order_type", "purchase_type", "agent_flag", "project_basic_id",
            "consignee", "phone", "address", "free_text_a", "free_text_b",
        ),
        (*LINE, "qty", "unit_id", "project_id", "termination", "note"),
        (Satellite("sale_order_entry_fin", PRICED),),
    ),
}


def flatten_document(t: Mapping[str, DataFrame], spec: DocumentSpec) -> DataFrame:
    """One row per entry; a header without entries keeps one row of its own.

    Entries meet their satellites first: the header's columns are then shuffled once per
    header and not, by entry, once per entry and satellite.
    """
    entry_cols = list(dict.fromkeys(("bill_id", *spec.entry_cols, *(s.key for s in spec.satellites))))
    dims = [Dim(t[s.table], {s.key: s.own_key or s.key}, {c: c for c in s.take}, s.table) for s in spec.satellites]
    entries = star_join(t[spec.entry].select(*entry_cols), dims)
    cols = [*spec.header_cols, *spec.entry_cols, *(c for s in spec.satellites for c in s.take)]
    return header_join(t[spec.header].select(*spec.header_cols), entries, "bill_id").select(*cols)


def staff_directory(
    elements: DataFrame, contacts: DataFrame, unit_types: Sequence[str] = ("1", "2"), person_type: str = "8"
) -> DataFrame:
    """People under each active unit, with the unit's parent and the contact data.

    elements: id, name, name_pinyin, parent_id, org_type, available; contacts: id, mobile,
    email. Units without people keep one row; people or parents that are not available
    are not shown.
    """
    active = elements.where(F.col("available") != 0)
    units = active.where(F.col("org_type").isin(*unit_types)).select("id", "name", "parent_id")
    people = active.where(F.col("org_type") == person_type)
    out = units.select(F.col("id").alias("dept_id"), F.col("name").alias("dept_name"), F.col("parent_id").alias("__up"))
    out = star_join(out, [Dim(units, {"__up": "id"}, {"parent_name": "name", "parent_id": "id"})])
    people = people.select(F.col("parent_id").alias("dept_id"), F.col("id").alias("person_id"), "name", "name_pinyin")
    out = header_join(out, people, "dept_id")
    out = star_join(out, [Dim(contacts, {"person_id": "id"}, {"mobile": "mobile", "email": "email"})])
    return out.select("dept_name", "parent_name", "name", "name_pinyin", "mobile", "email", "dept_id", "parent_id")
