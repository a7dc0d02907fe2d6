"""Round trips through versioned tables: what is read back after several writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.checks.merging import BASE, DELTA, _base_and_delta
from ledgerloom.checks.receivables import BILLED_SQL, INVOICE_SELECT, _invoice_status
from ledgerloom.checks.registry import Tables, query
from ledgerloom.functions.scalars import month_text
from ledgerloom.plans.upkeep import TableSpec, apply_deltas, parse_specs, publish_flagged, refresh_stores
from ledgerloom.session import own_path
from ledgerloom.sources.tables import Catalog
from ledgerloom.sources.versions import VersionedTable


def _store(t: Tables, label: str) -> VersionedTable:
    return VersionedTable(t.spark, own_path(t.spark, label))


@query(
    "published_newest",
    """SELECT l_orderkey, max(l_partkey) AS l_partkey, strftime(max(l_shipdate), '%Y-%m-%d') AS shipped FROM lineitem
       JOIN (SELECT l_orderkey AS k, max(l_shipdate) AS d FROM lineitem GROUP BY 1) ON k = l_orderkey AND l_shipdate = d GROUP BY l_orderkey""",
)
def published_newest(t: Tables) -> DataFrame:
    """A stored table is reduced over itself and read through the catalog."""
    store = _store(t, "newest")
    store.publish(t["lineitem"].select("l_orderkey", "l_partkey", "l_shipdate"))
    refresh_stores({"lines": store}, [TableSpec("lines", "l_orderkey", "l_shipdate")], {"lines": ["l_partkey"]})
    lines = Catalog(t.spark, stores={"lines": store.path})["lines"]
    return lines.select("l_orderkey", "l_partkey", F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"))


@query(
    "replaced_slices",
    """SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderkey, CASE WHEN strftime(o_orderdate, '%Y-%m') = '2001-07' THEN 'recomputed' ELSE o_orderstatus END AS status
       FROM orders WHERE strftime(o_orderdate, '%Y-%m') <> '2001-06'""",
)
def replaced_slices(t: Tables) -> DataFrame:
    """Two months are replaced by rows of one, so the other is emptied; a rerun changes nothing."""
    store = _store(t, "months")
    store.publish(t["orders"].select(month_text("o_orderdate").alias("month"), "o_orderkey", F.col("o_orderstatus").alias("status")), slice_by="month")
    for _ in range(2):
        fresh = store.read().where("month = '2001-07'").withColumn("status", F.lit("recomputed"))
        store.replace_slices(fresh, ["2001-06", "2001-07"])
    return store.read()


@query(
    "upserted_buckets",
    f"""SELECT o_orderkey, o_custkey, CASE WHEN {DELTA} THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE {BASE} OR {DELTA}""",
)
def upserted_buckets(t: Tables) -> DataFrame:
    """A table stored by key takes a delta; only buckets with keys of the delta are rewritten."""
    base, delta = _base_and_delta(t)
    store = _store(t, "orders")
    store.publish(base, key=["o_orderkey"], buckets=16)
    apply_deltas({"orders": store}, {"orders": delta}, parse_specs("orders--o_orderkey--o_orderstatus"))
    return store.read()


# The first run knows the orders placed before 2001; the second run is repeated.
@query(
    "snapshot_runs",
    f"""WITH {BILLED_SQL}, cur AS ({INVOICE_SELECT})
        SELECT c.*, CASE WHEN o_orderdate < DATE '2001-01-01' THEN '否' ELSE '是' END AS changed FROM cur c JOIN orders ON ticket_id = o_orderkey""",
)
def snapshot_runs(t: Tables) -> DataFrame:
    """Status rows of two dated runs, the later one run twice, flagged against the earlier."""
    store, cur = _store(t, "status"), _invoice_status(t)
    early = t["orders"].where(F.col("o_orderdate") < "2001-01-01").select(F.col("o_orderkey").alias("ticket_id"))
    compared = (["ticket_id"], ["close_status", "status"], {"invoiced": 0, "open_amount": 0})
    publish_flagged(store, cur.join(early, "ticket_id", "left_semi"), "2001-01-01", *compared)
    publish_flagged(store, cur, "2001-11-05", *compared)
    return publish_flagged(store, cur, "2001-11-05", *compared)
