"""Plan shapes that must hold whatever the size of the data."""

import re

import pytest
from pyspark.sql import functions as F

from ledgerloom import session
from ledgerloom.checks import all_queries
from ledgerloom.checks.receivables import RULES, roles
from ledgerloom.operators import joins as j
from ledgerloom.operators import merge as m
from ledgerloom.operators import windows as w
from ledgerloom.plans import receivables as r
from ledgerloom.sources.tables import Catalog

FOLDER = "/root/testdata/sf0.001"
QUERIES = all_queries()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def shuffled(spark):
    """Session without broadcast joins, as with tables too large for them."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_product_joins_and_no_single_partition(shuffled, name):
    plan = plan_of(QUERIES[name](shuffled, FOLDER))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan
    for line in plan.splitlines():
        assert not re.search(r"\bWindow(Exec)?\b.*\[\]", line), line
    # One partition is right only for one-row totals, to which each task sends one row.
    assert "SinglePartition" not in plan or name in ("not_in_subquery", "receivable_board_v2", "keyword_region_dim", "address_region")


def test_newest_row_is_picked_before_the_shuffle(spark):
    events = spark.read.parquet(f"{FOLDER}/events.parquet")
    plan = plan_of(w.latest_per_key(events, ["user_id"], "ts", ["event_id"]))
    below = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_scan_reads_only_what_is_used(spark):
    plan = plan_of(QUERIES["ratio_adjusted_sum"](spark, FOLDER))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"l_suppkey", "l_extendedprice", "l_tax", "l_returnflag"}


def test_filters_reach_the_scan(spark):
    plan = plan_of(QUERIES["ledger_ytd"](spark, FOLDER))
    assert "PushedFilters: [" in plan and "EqualTo(c_mktsegment,MACHINERY)" in plan


@pytest.fixture
def small_skew(shuffled):
    """Thresholds low enough for test data to count as skewed."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: shuffled.conf.get(k) for k in settings}
    for k, v in settings.items():
        shuffled.conf.set(k, v)
    yield shuffled
    for k, v in old.items():
        shuffled.conf.set(k, v)


def hot_children(spark, n=60_000):
    """A third of the rows under one parent, from several map tasks."""
    hot = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5_000)
    return spark.range(0, n, numPartitions=12).select(hot.alias("k"), F.col("id").alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))


def plan_of_final(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_header_is_split(small_skew):
    child = hot_children(small_skew)
    head = small_skew.range(6_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("h"))
    out = j.header_join(head, child, "k")
    assert "skew=true" in plan_of_final(out)
    assert out.count() == head.join(child, "k", "left").count()
    # The plain left join cannot split its right side.
    plain = head.join(child, "k", "left")
    assert "skew=true" not in plan_of_final(plain)


def test_hot_key_of_a_lookup_is_split(small_skew):
    fact = hot_children(small_skew)
    dim = small_skew.range(6_000).select(F.col("id").alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("name"))
    out = j.star_join(fact, [j.Dim(dim, {"k": "key"}, {"name": "name"})])
    assert "skew=true" in plan_of_final(out)


def test_checked_lookups_add_no_scan(shuffled):
    orders, customer = (shuffled.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("orders", "customer"))
    dims = [j.Dim(customer, {"o_custkey": "c_custkey"}, {"name": "c_name"}), j.Dim(customer, {"o_custkey": "c_custkey"}, {"segment": "c_mktsegment"})]
    checked, plain = (plan_of(j.star_join(orders, dims, check_unique=c)) for c in (True, False))
    assert checked.count("FileScan") == plain.count("FileScan") == 3
    # The join finds the lookup dealt by its key already.
    assert checked.count("Exchange hashpartitioning") <= plain.count("Exchange hashpartitioning")


def test_hot_key_total_is_reduced_before_the_shuffle(small_skew):
    out = w.partition_total(hot_children(small_skew), ["k"], "v", "total")
    plan = plan_of_final(out)
    assert "partial_sum" in plan and "skew=true" in plan
    assert "Window" not in plan


def test_hot_full_join_is_split(small_skew):
    left = hot_children(small_skew).withColumnRenamed("k", "x")
    right = small_skew.range(3_000, 9_000).select(F.col("id").alias("y"), F.lit("r").alias("r"))
    right = right.unionByName(small_skew.range(1).select(F.col("id").alias("y"), F.lit("r").alias("r")))
    out = j.full_join_split(left, right, {"x": "y"})
    assert "skew=true" in plan_of_final(out)
    assert out.count() == left.join(right, left.x == right.y, "full").count()


def test_full_join_reads_its_keys_once(shuffled):
    """Two scans of rows and one key table, whose shuffle both sides use."""
    plan = plan_of_final(QUERIES["full_join_split"](shuffled, "/root/testdata/sf0.001"))
    final = plan[: plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    assert "ReusedExchange" in final and "FullOuter" not in final


@pytest.mark.parametrize("rule", ["neighbour", "first"])
def test_hot_line_of_a_chain_is_split(small_skew, rule):
    facts = [(small_skew.range(6_000).select(F.col("id").alias("k"), F.lit(1).alias(n)), n) for n in "abc"]
    lines = hot_children(small_skew).select("k", F.struct("v", "pad").alias("d"))
    out = m.outer_chain([*facts, (lines, "d")], ["k"], rule, single_lines=["d"])
    assert "skew=true" in plan_of_final(out)
    assert out.count() == 60_000 + 1_000


def test_key_and_period_reach_the_scan(spark):
    assert "EqualTo(l_orderkey,7)" in plan_of(QUERIES["point_lookup"](spark, FOLDER))
    for name in ("ledger_period", "ledger_ytd"):
        plan = plan_of(QUERIES[name](spark, FOLDER))
        assert "GreaterThanOrEqual(o_orderdate,2000-0" in plan and "LessThan(o_orderdate,2" in plan


SCANS = {"outer_chain_asis": 5, "outer_chain_first": 5, "purchase_amounts": 9, "daily_workload": 5}
BOARDS = {"receivable_board": 30, "receivable_board_asis": 30, "receivable_board_v2": 35}


@pytest.mark.parametrize("name", list(BOARDS))
def test_boards_plan_their_lines_once(shuffled, name):
    """Lines and settlements are reduced once, not once for each amount of the board."""
    assert plan_of(QUERIES[name](shuffled, FOLDER)).count("FileScan") <= BOARDS[name]


@pytest.mark.parametrize("name", ["outer_chain_asis", "outer_chain_first", "purchase_amounts", "daily_workload"])
def test_chains_plan_no_full_join(shuffled, name):
    """Each fact is read once, and the keys of the last one besides."""
    plan = plan_of(QUERIES[name](shuffled, FOLDER))
    assert "FullOuter" not in plan
    assert plan.count("FileScan") <= SCANS[name]


@pytest.fixture
def dealt(shuffled):
    """Share of a frame's rows of a kind in their fullest partition, of eight in every shuffle.

    The kind should name a column of the lookup, or the optimizer leaves the lookup out."""
    old = shuffled.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    shuffled.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")

    def share(df, kind: str) -> float:
        counts = [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count_if(F.expr(kind)).alias("n")).collect()]
        return max(counts) / sum(counts)

    yield share
    shuffled.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_rows_without_a_key_are_spread(spark, dealt, rows):
    fact = spark.range(8_000).select(F.when(F.col("id") % 8 == 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    dim = spark.range(4_000).select(F.col("id").alias("key"), (F.col("id") * 2).alias("name"))
    out = j.star_join(fact, [j.Dim(dim, {"k": "key"}, {"name": "name"}, spread=("v",)), j.Dim(dim, {"k": "key"}, {"again": "name"}, spread=("v",))])
    assert out.columns == ["k", "v", "name", "again"]
    assert dealt(out, "k is null and name is null and again is null") < 0.3
    plain = j.star_join(fact, [j.Dim(dim, {"k": "key"}, {"name": "name"}), j.Dim(dim, {"k": "key"}, {"again": "name"})])
    assert rows(out) == rows(plain)


def test_spread_lookups_are_checked(spark):
    fact, dim = spark.range(3).select(F.col("id").alias("k")), spark.createDataFrame([(1, "a"), (1, "b")], "key int, name string")
    with pytest.raises(Exception, match="not unique"):
        j.star_join(fact, [j.Dim(dim, {"k": "key"}, {"name": "name"}, spread=("k",))]).collect()


@pytest.mark.parametrize("name", ["procure_timeline", "procure_timeline_asis"])
def test_lines_without_a_lot_are_spread(spark, dealt, name):
    assert dealt(QUERIES[name](spark, FOLDER), "lot_no is null and notice_qty is null and ship_qty is null") < 0.5


@pytest.mark.parametrize("name", ["procure_timeline", "procure_timeline_asis"])
def test_timeline_shuffles_no_full_rows(shuffled, name):
    """Lots are met by the receipts and sales orders by the requisitions, not by the lines."""
    before = session.written_count()
    plan = plan_of(QUERIES[name](shuffled, FOLDER))
    assert session.written_count() == before + 2  # the table of receipts is gone
    assert "material_id" not in "".join(re.findall(r"hashpartitioning\([^)]*\)", plan))
    lines = [s for s in re.findall(r"FileScan parquet \[([^\]]*)\]", plan) if "receipt_no" in s]
    assert len(lines) == 1 and "sale_no" not in lines[0]


def test_lines_without_an_order_are_spread(spark, dealt):
    lines = r.receivable_lines(roles(Catalog(spark, root=FOLDER)), RULES)
    assert dealt(lines, "order_no is null and agent_flag is null") < 0.5


@pytest.mark.parametrize("name", ["receivable_board", "receivable_board_asis"])
def test_boards_shuffle_settlements_of_wanted_periods(spark, name):
    assert plan_of(QUERIES[name](spark, FOLDER)).count("GreaterThanOrEqual(o_orderdate,2000-01-01") >= 2


def joined_on(df) -> list[str]:
    """Left keys of the sort merge joins, the last join first."""
    return re.findall(r"SortMergeJoin[^\[]*\[([^\]]*)\]", plan_of(df))


def depth(keys: list[str], col: str) -> int:
    return next(i for i, k in enumerate(keys) if re.search(rf"\b{col}#", k))


def test_sale_order_report_takes_wide_texts_last(shuffled):
    keys = joined_on(QUERIES["sale_order_report"](shuffled, FOLDER))
    assert depth(keys, "project_id") < depth(keys, "material_id") < depth(keys, "customer_id") < depth(keys, "entry_id") < depth(keys, "bill_id")


@pytest.mark.parametrize("name", ["gross_margin", "margin_sheet"])
def test_margins_take_wide_texts_last(shuffled, name):
    keys = joined_on(QUERIES[name](shuffled, FOLDER))
    assert depth(keys, "material_id") < depth(keys, "project_id") < depth(keys, "contact_id") < depth(keys, "entry_id")


@pytest.mark.parametrize("name", ["gross_margin", "margin_sheet"])
def test_margins_look_up_payers_on_headers(shuffled, name):
    """Lines were shuffled by payer, with both names and the header's keys, in one plan with their headers."""
    plan = plan_of(QUERIES[name](shuffled, FOLDER))
    assert not re.search(r"hashpartitioning\((customer_id|bill_id|l_orderkey)#\w+, \d+\)", plan)
    lines = [s for s in re.findall(r"FileScan parquet \[([^\]]*)\]", plan) if "contact_id" in s]
    assert len(lines) == 1 and "contact_name" in lines[0] and "customer_id" not in lines[0]


def test_orders_without_a_project_are_spread(spark, dealt):
    assert dealt(QUERIES["platform_recon"](spark, FOLDER), "project_no is null and paid is null") < 0.5


@pytest.mark.parametrize("name", ["sale_order", "purchase_order", "shipment"])
def test_satellites_join_entries_before_headers(shuffled, name):
    keys = joined_on(QUERIES[f"flat_{name}"](shuffled, FOLDER))
    assert depth(keys, "bill_id") < depth(keys, "entry_id")


def test_only_facts_of_returned_lots_are_summed(shuffled):
    assert plan_of(QUERIES["lot_disposition"](shuffled, FOLDER)).count("LeftSemi") >= 12


def test_payables_look_up_names_on_the_table_that_holds_the_key(shuffled):
    plan = plan_of(QUERIES["payables_wide"](shuffled, FOLDER))
    # Lines were shuffled by their header's keys, and all without a stock row to one task by lot.
    assert not re.search(r"hashpartitioning\((seller_id|bill_type_id|currency_id|settle_org_id|dept_id)#", plan)
    assert re.search(r"hashpartitioning\(lot_id#\w+, __at_lot_id_entry_id#", plan) and not re.search(r"hashpartitioning\(lot_id#\w+, \d+\)", plan)
