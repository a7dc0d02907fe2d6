"""Column rules for NULL, blank, zero and bad text."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import codes
from ledgerloom.functions import scalars as s
from ledgerloom.functions import text as x
from ledgerloom.plans.platform import order_time
from ledgerloom.plans.receivables import OrgRule, in_scope, invoice_state, payment_state, tolerance_amount
from ledgerloom.plans.sales import terminal_price


def one(spark, col, **values):
    """Value of a column expression over one row."""
    parts = [F.lit(None).cast("string").alias(k) if v is None else F.lit(v).alias(k) for k, v in values.items()]
    return spark.range(1).select(*parts).select(col.alias("out")).first()["out"]


@pytest.mark.parametrize("value, blank", [(None, True), ("", True), ("  ", True), ("a", False)])
def test_is_blank(spark, value, blank):
    assert one(spark, s.is_blank("v"), v=value) is blank


def test_blank_key_is_null(spark):
    assert one(spark, s.nullif_blank("v"), v="") is None
    assert one(spark, s.nullif_blank("v"), v=" ") == " "


@pytest.mark.parametrize("a, b, out", [(6.0, 2.0, 3.0), (6.0, 0.0, None), (6.0, None, 0.0)])
def test_safe_div(spark, a, b, out):
    got = one(spark, s.safe_div("a", F.col("b").cast("double")), a=a, b=b)
    assert got == out


def test_decode(spark):
    assert one(spark, s.decode("c", codes.DOCUMENT_STATUS), c="C") == "已审核"
    assert one(spark, s.decode("c", codes.DOCUMENT_STATUS), c="Q") == "Q"
    assert one(spark, s.decode("c", codes.DOCUMENT_STATUS, "?"), c=None) == "?"
    assert one(spark, s.decode("c", codes.DOCUMENT_STATUS), c=None) is None


@pytest.mark.parametrize("value, kept", [(None, True), (1, False), (2, True)])
def test_keep_unless_keeps_null(spark, value, kept):
    assert one(spark, s.keep_unless(F.col("v").cast("int"), 1), v=value) is kept


@pytest.mark.parametrize("value, out", [("1-URGENT", "URGENT"), ("plain", "plain"), ("a-b-c", "b-c"), ("x-", ""), (None, None)])
def test_after_first(spark, value, out):
    assert one(spark, s.after_first("v", "-"), v=value) == out


@pytest.mark.parametrize("value, out", [("1、2", ["1", "2", None]), ("", ["", None, None]), (None, [None] * 3)])
def test_part_of_past_the_end(spark, value, out):
    assert [one(spark, s.part_of("v", "、", i), v=value) for i in range(3)] == out


@pytest.mark.parametrize("value, out", [(None, [""]), ("", [""]), ("'1'、'2'", ["1", "2"]), ("7", ["7"])])
def test_clean_list(spark, value, out):
    assert one(spark, s.clean_list("v", "、"), v=value) == out


def test_separator_is_not_a_pattern(spark):
    assert one(spark, s.split_list("v", "."), v="a.b") == ["a", "b"]
    assert one(spark, s.split_list("v", "|"), v="a|b") == ["a", "b"]


@pytest.mark.parametrize("ratio, out", [(None, "100"), ("", "100"), (" ", "100"), ("0", "100"), ("abc", "100"), ("80", "125")])
def test_ratio_amount(spark, ratio, out):
    got = one(spark, s.ratio_amount(F.lit(Decimal("100.00")), "r"), r=ratio)
    assert got == Decimal(out)


def test_ratio_amount_is_exact_per_row(spark):
    assert one(spark, s.ratio_amount(F.lit(Decimal("0.01")), "r"), r="3") == Decimal("0.333333")
    assert one(spark, s.ratio_amount(F.lit(Decimal("0.0000005")), "r"), r="100") == Decimal("0.000001")


def test_dates(spark):
    assert str(one(spark, s.parse_date("v"), v="2022/3/7")) == "2022-03-07"
    assert one(spark, s.parse_date("v"), v="soon") is None
    assert one(spark, s.elapsed_days("a", "b"), a="2023-01-01 00:00:00", b="2023-01-02 12:00:00") == 1.5
    assert one(spark, s.elapsed_days("a", "b"), a=None, b="2023-01-02 12:00:00") is None
    assert one(spark, s.aging_days("a", "2023-02-01"), a="2023-01-01") == 31


def test_least_and_first_priced(spark):
    assert one(spark, s.earliest_of("a", "b", "c"), a=None, b="2", c="1") == "1"
    assert one(spark, s.first_priced(F.col("a").cast("int"), F.col("b").cast("int")), a=None, b=0) == 0
    assert one(spark, s.first_priced(F.col("a").cast("int"), F.col("b").cast("int")), a=None, b=None) == 0


@pytest.mark.parametrize("value, out", [("12.9", 12), ("-12.9", -12), ("", None), (None, None), ("0.99", 0)])
def test_int_part(spark, value, out):
    assert one(spark, s.int_part("v"), v=value) == out


CITIES = [("吉林", "吉林"), ("朝阳", "辽宁"), ("杭州", "浙江"), ("苏州", "江苏")]


@pytest.mark.parametrize(
    "text, out",
    [
        ("浙江省杭州市西湖区", "浙江"),
        ("杭州市余杭区", "浙江"),
        ("寄江苏 转北京", "北京"),  # list order, not text order
        ("苏州转杭州", "浙江"),
        ("朝阳区某路", "辽宁"),
        ("吉林路1号", "吉林"),
        ("无", ""),
        ("", ""),
        (None, None),
    ],
)
def test_address_region(spark, text, out):
    assert one(spark, x.address_region("v", CITIES), v=text) == out


@pytest.mark.parametrize(
    "text, out",
    [
        ("330381199901011234", "125412541254011234"),
        ("1234567", "1234567"),
        ("id 12345678.", "id 12545678."),
        ("none", "none"),
        (None, None),
    ],
)
def test_mask(spark, text, out):
    assert one(spark, x.mask_digits("v"), v=text) == out


@pytest.mark.parametrize("mode", ["ECB", "GCM"])
def test_protect_round_trip(spark, mode):
    df = spark.createDataFrame([(1, "Anna"), (2, "Anna"), (3, None), (4, "")], "id int, name string")
    hidden = x.protect_columns(df, ["name"], "0123456789abcdef", mode).cache()
    seen = {r["id"]: r["name"] for r in hidden.collect()}
    assert "Anna" not in seen.values() and seen[3] is None
    assert (seen[1] == seen[2]) is (mode == "ECB")
    back = x.unprotect_columns(hidden, ["name"], "0123456789abcdef", mode)
    assert {r["id"]: r["name"] for r in back.collect()} == {1: "Anna", 2: "Anna", 3: None, 4: ""}


def test_tag_by_keywords_equals_the_listed_form(spark):
    levels = [[("aa", "A"), ("c", "C")], [("b", "B"), ("abc", "D")]]
    listed = [(lv, i, k, v) for lv, ws in enumerate(levels) for i, (k, v) in enumerate(ws)]
    dim = spark.createDataFrame([*listed, (0, 9, None, "N"), (0, -1, "x", None)], "level int, ord int, keyword string, label string")
    texts = spark.createDataFrame([(i, t) for i, t in enumerate(["", None, "a", "xb", "abc", "caa", "aac", "caa", "zzabz"])], "id int, v string")
    want = texts.select("id", x.keyword_region("v", levels).alias("r")).collect()
    got = x.tag_by_keywords(texts, "v", dim, "r").select("id", "r").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert {tuple(r) for r in x.tag_by_keywords(texts, "v", dim.limit(0), "r").select("r").collect()} == {("",), (None,)}


def test_few_parts_of_texts_leave_the_scan(spark):
    words = spark.createDataFrame([("needle",), ("pin",)], "keyword string")
    texts = spark.range(500).select(F.concat(F.sha2(F.col("id").cast("string"), 512), F.when(F.col("id") % 50 == 0, "needle").otherwise("")).alias("v"))
    parts = x.keyword_parts(texts, "v", words)
    every = 500 * (123 + 126)
    assert 10 <= parts.count() < every / 1000
    assert parts.columns == ["__a", "__b", "__part"] and parts.where("__part = 'needle'").count() == 10
    plan = x.tag_by_keywords(texts, "v", words.selectExpr("0 as level", "0 as ord", "keyword", "'x' as label"), "r")._jdf.queryExecution().executedPlan().toString()
    exchanged = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanged and not any("__text" in line for line in exchanged)


@pytest.mark.parametrize(
    "due, got, out",
    [
        (0, 0, codes.UNPAID), (100, 0, codes.UNPAID), (100, None, codes.UNPAID), (100, 40, codes.PART_PAID), (100, 100, codes.PAID), (100, 120, codes.PAID),
        (-5, 0, codes.UNPAID), (0, 10, codes.OTHER_STATUS), (100, -10, codes.OTHER_STATUS),
    ],
)
def test_payment_state(spark, due, got, out):
    assert one(spark, payment_state(F.col("d").cast("int"), F.col("g").cast("int")), d=due, g=got) == out


@pytest.mark.parametrize(
    "done, left, closed, out",
    [
        (10, 0, "A", codes.INVOICED), (10, -1, "A", codes.INVOICED), (10, 5, "B", codes.INVOICED), (10, 5, "A", codes.PART_INVOICED), (0, 5, "A", codes.NOT_INVOICED),
        (None, 5, "B", codes.NOT_INVOICED), (10, 5, "X", codes.OTHER), (10, None, None, codes.INVOICED),
    ],
)
def test_invoice_state(spark, done, left, closed, out):
    got = one(spark, invoice_state(F.col("a").cast("int"), F.col("b").cast("int"), "c"), a=done, b=left, c=closed)
    assert got == out


@pytest.mark.parametrize(
    "d, h, out",
    [
        (-2, 0, 0), (0, 0, 0), (1, 0, None), (2, 0, 2), (-2, 5, 100), (-1, 5, 4), (0, 5, 5), (1, 5, 6), (2, 5, 7),
        (-2, -5, None), (0, -5, None), (1, -5, None), (2, -5, -3),
    ],
)
def test_tolerance(spark, d, h, out):
    got = one(spark, tolerance_amount("s", "i", "l"), s=100, i=100 - d, l=h)
    assert got == out


@pytest.mark.parametrize(
    "org, customer, project, short, kept",
    [
        ("1", "inner", "p", None, False), ("1", "outer", "p", None, True), ("1", None, "p", None, None), ("2", "outer", "big nuclear job", None, False), ("2", None, "p", None, True),
        ("3", None, None, "x", False), ("3", None, None, "y", True), ("4", "outer", "p", "y", False),
    ],
)
def test_scope(spark, org, customer, project, short, kept):
    rules = [OrgRule("1", ("inner",)), OrgRule("2", excluded_project_text="nuclear"), OrgRule("3", excluded_short_name="x")]
    assert one(spark, in_scope(rules, "o", "c", "p", "s"), o=org, c=customer, p=project, s=short) is kept


@pytest.mark.parametrize(
    "kind, org, note, out",
    [("B", "1", None, "7"), (None, "9", None, "7"), (None, "1", None, "100"), (None, "1", "channel", "50"), (None, "5", None, "0"), (None, None, None, "0")],
)
def test_terminal_price(spark, kind, org, note, out):
    got = one(
        spark, terminal_price(["1", "2"], "9", "channel"), so_purchase_type=kind, so_org_id=org, so_note=note, so_price=Decimal("7.00"),
        so_list_price=Decimal("113.00"), so_tax_rate=Decimal("13.00"), price=Decimal("50.00"),
    )
    assert got == Decimal(out)


@pytest.mark.parametrize(
    "order_id, examined, out",
    [("2001", "2023-05-05", "2023-01-01"), ("7", "2023-05-05", "2023-05-05"), ("7", "1900-01-01", "2023-01-01"), ("7", None, "2023-01-01")],
)
def test_order_time(spark, order_id, examined, out):
    got = one(spark, order_time(F.col("i"), F.lit("2023-01-01").cast("timestamp"), F.col("e").cast("timestamp")), i=order_id, e=examined)
    assert str(got)[:10] == out
