"""Projections, filters, scalar functions, JSON, text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ledgerloom.checks.registry import AS_OF, Tables, query
from ledgerloom.checks.roles import big, dec, purchases, rounded
from ledgerloom.functions import codes
from ledgerloom.functions.scalars import (
    after_first, aging_days, clean_list, day_text, decode, elapsed_days, first_name, is_blank,
    keep_unless, parse_date, part_of,
)
from ledgerloom.functions.text import keyword_region, mask_digits, protect_columns, tag_addresses, tag_by_keywords, unprotect_columns
from ledgerloom.operators.windows import latest_per_key
from ledgerloom.plans.catalogue import bill_lines
from ledgerloom.sources.json import active_items, explode_items, json_field

STATUS = {"F": "finished", "O": "open"}


@query(
    "json_items_active",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
       WHERE CAST(json_extract(props, '$.k') AS BIGINT) >= 50""",
)
def json_items_active(t: Tables) -> DataFrame:
    parsed = F.from_json("props", T.StructType([T.StructField("k", T.IntegerType())]))
    return t["events"].select("event_id", big(parsed["k"]).alias("k")).where("k >= 50")


@query(
    "json_field_extract",
    "SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS VARCHAR) AS k, "
    "CAST(event_type AS VARCHAR) AS code FROM events",
)
def json_field_extract(t: Tables) -> DataFrame:
    form = F.to_json(F.struct(F.to_json(F.struct(F.col("event_type").alias("code"))).alias("form")))
    return t["events"].select(
        "event_id", "user_id", json_field("props", "k").alias("k"), json_field(form, "form", "code").alias("code")
    )


@query(
    "json_items_explode",
    """SELECT p_partkey, CAST(p_partkey AS VARCHAR) || '-' || w AS id, w AS name, p_brand AS "parentId",
              'true' AS active, CAST(p_size AS VARCHAR) AS code
       FROM (SELECT *, unnest(string_split(p_name, ' ')) AS w FROM part) WHERE p_size > 10""",
)
def json_items_explode(t: Tables) -> DataFrame:
    item = lambda w: F.struct(
        F.concat_ws("-", F.col("p_partkey").cast("string"), w).alias("id"),
        w.alias("name"),
        F.col("p_brand").alias("parentId"),
        (F.col("p_size") > 10).cast("string").alias("active"),
        F.col("p_size").cast("string").alias("code"),
    )
    docs = t["part"].select(
        "p_partkey", F.to_json(F.struct(F.transform(F.split("p_name", " "), item).alias("items"))).alias("doc")
    )
    return active_items(explode_items(docs, "doc", ["p_partkey"]))


@query(
    "status_decode",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS status,
       CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE '未知' END AS status_or_unknown FROM orders""",
)
def status_decode(t: Tables) -> DataFrame:
    return t["orders"].select(
        "o_orderkey",
        decode("o_orderstatus", STATUS).alias("status"),
        decode("o_orderstatus", STATUS, codes.UNKNOWN).alias("status_or_unknown"),
    )


@query(
    "point_lookup",
    "SELECT CAST(l_orderkey AS VARCHAR) AS bill_no, l_partkey AS project_id, p_name AS project_no FROM lineitem LEFT JOIN part ON l_partkey = p_partkey WHERE l_orderkey = 7",
)
def point_lookup(t: Tables) -> DataFrame:
    rows = t["lineitem"].select(F.col("l_orderkey").alias("bill_no"), F.col("l_partkey").alias("project_id"))
    projects = t["part"].select(F.col("p_partkey").alias("project_id"), F.col("p_name").alias("project_no"))
    return bill_lines(rows, projects, 7).withColumn("bill_no", F.col("bill_no").cast("string"))


def _customers_with_last_purchase(t: Tables) -> DataFrame:
    last = latest_per_key(purchases(t), ["user_id"], "ts", ["event_id"])
    last = last.select(F.col("user_id").alias("c_custkey"), "event_type", "value", "event_id")
    return t["customer"].join(last, "c_custkey", "left")


LAST_PURCHASE = """(SELECT user_id, event_type, value, event_id FROM (SELECT *, row_number() OVER (
    PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE event_type = 'purchase') WHERE rn = 1)"""


@query(
    "null_keep_filter",
    """SELECT c_custkey, o_orderkey, coalesce(o_orderstatus, '-') AS status FROM customer
       LEFT JOIN orders ON c_custkey = o_custkey WHERE o_orderstatus IS DISTINCT FROM 'F'""",
)
def null_keep_filter(t: Tables) -> DataFrame:
    joined = t["customer"].join(t["orders"], F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.where(keep_unless("o_orderstatus", "F")).select(
        "c_custkey", "o_orderkey", F.coalesce("o_orderstatus", F.lit("-")).alias("status")
    )


@query(
    "not_in_list_filter",
    "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment NOT IN ('MACHINERY', 'BUILDING')",
)
def not_in_list_filter(t: Tables) -> DataFrame:
    return t["customer"].where(~F.col("c_mktsegment").isin("MACHINERY", "BUILDING")).select("c_custkey", "c_mktsegment")


@query(
    "like_flag",
    "SELECT p_partkey, CASE WHEN p_name LIKE '%ring%' THEN '非自营' ELSE '自营' END AS form FROM part WHERE p_name NOT LIKE '%bolt%'",
)
def like_flag(t: Tables) -> DataFrame:
    form = F.when(F.contains("p_name", F.lit("ring")), codes.AGENT_RUN).otherwise(codes.SELF_RUN)
    return t["part"].where(~F.contains("p_name", F.lit("bolt"))).select("p_partkey", form.alias("form"))


@query(
    "blank_filter",
    f"""SELECT c_custkey FROM customer LEFT JOIN (SELECT user_id, CASE WHEN value < 20 THEN '  ' ELSE event_type END AS et
        FROM {LAST_PURCHASE}) ON user_id = c_custkey WHERE et IS NULL OR trim(et) = ''""",
)
def blank_filter(t: Tables) -> DataFrame:
    note = F.when(F.col("value") < 20, F.lit("  ")).otherwise(F.col("event_type"))
    tagged = _customers_with_last_purchase(t).withColumn("event_type", note)
    return tagged.where(is_blank("event_type")).select("c_custkey")


@query(
    "string_funcs",
    """SELECT c_custkey, substring(c_name, 1, 8) AS head, trim('  ' || c_mktsegment || ' ') AS segment,
       concat_ws('/', c_mktsegment, CASE WHEN c_nationkey > 12 THEN c_name END) AS label,
       replace(c_name, 'Customer', 'C') AS short_name, length(c_name) AS n, strpos(c_name, '#') AS at FROM customer""",
)
def string_funcs(t: Tables) -> DataFrame:
    return t["customer"].select(
        "c_custkey",
        F.substring("c_name", 1, 8).alias("head"),
        F.trim(F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))).alias("segment"),
        F.concat_ws("/", "c_mktsegment", F.when(F.col("c_nationkey") > 12, F.col("c_name"))).alias("label"),
        F.replace("c_name", F.lit("Customer"), F.lit("C")).alias("short_name"),
        big(F.length("c_name")).alias("n"),
        big(F.instr("c_name", "#")).alias("at"),
    )


@query(
    "after_dash",
    """SELECT o_orderkey, CASE WHEN strpos(o_orderpriority, '-') > 0 THEN substring(o_orderpriority, strpos(o_orderpriority, '-') + 1)
       ELSE o_orderpriority END AS priority FROM orders""",
)
def after_dash(t: Tables) -> DataFrame:
    return t["orders"].select("o_orderkey", after_first("o_orderpriority", "-").alias("priority"))


@query(
    "null_defaults",
    f"""SELECT c_custkey, coalesce(event_type, '其他') AS last_event, coalesce(CAST(value AS DECIMAL(18,2)), 0) AS last_value
        FROM customer LEFT JOIN {LAST_PURCHASE} ON user_id = c_custkey""",
)
def null_defaults(t: Tables) -> DataFrame:
    return _customers_with_last_purchase(t).select(
        "c_custkey",
        first_name("event_type", codes.OTHER).alias("last_event"),
        F.coalesce(dec("value"), F.lit(0)).cast("decimal(18,2)").alias("last_value"),
    )


@query("parse_date", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def parse_date_query(t: Tables) -> DataFrame:
    typed = F.date_format("o_orderdate", "yyyy/M/d")
    return t["orders"].select("o_orderkey", day_text(parse_date(typed)).alias("day"))


@query(
    "split_parts",
    """SELECT p_partkey, string_split(p_name, ' ')[1] AS w0, string_split(p_name, ' ')[2] AS w1,
       string_split(p_name, ' ')[3] AS w2 FROM part""",
)
def split_parts(t: Tables) -> DataFrame:
    return t["part"].select("p_partkey", *[part_of("p_name", " ", i).alias(f"w{i}") for i in range(3)])


@query(
    "explode_codes",
    "SELECT p_partkey, unnest(string_split(replace(coalesce(nullif(p_name, 'red bolt'), ''), '''', ''), ' ')) AS word FROM part",
)
def explode_codes(t: Tables) -> DataFrame:
    name = F.nullif(F.col("p_name"), F.lit("red bolt"))
    return t["part"].select("p_partkey", F.explode(clean_list(name, " ")).alias("word"))


@query(
    "elapsed_days",
    """SELECT user_id, round((epoch(last_ts) - epoch(first_ts)) / 3600 / 24.0, 4) AS days FROM (
       SELECT user_id, date_trunc('second', min(ts)) AS first_ts, date_trunc('second', max(ts)) AS last_ts FROM events GROUP BY user_id)""",
)
def elapsed_days_query(t: Tables) -> DataFrame:
    span = t["events"].groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return span.select("user_id", rounded(elapsed_days("a", "b")).alias("days"))


@query(
    "aging_days",
    "SELECT o_orderkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), {as_of}) AS BIGINT) AS days FROM orders",
)
def aging_days_query(t: Tables) -> DataFrame:
    return t["orders"].select("o_orderkey", big(aging_days("o_orderdate", AS_OF)).alias("days"))


# Colours tag first, nouns only when no colour is named.
COLOURS = [("red", "warm"), ("green", "cool"), ("blue", "cool")]
NOUNS = [("ring", "hardware"), ("bolt", "hardware"), ("widget", "goods"), ("gear", "machine")]


def _region_sql(col: str, levels) -> str:
    branches = " ".join(f"WHEN contains({col}, '{k}') THEN '{v}'" for level in levels for k, v in level)
    return f"CASE WHEN {col} IS NULL THEN NULL {branches} ELSE '' END"


@query("keyword_region", f"SELECT doc_id, {_region_sql('text', [COLOURS, NOUNS])} AS region FROM documents")
def keyword_region_query(t: Tables) -> DataFrame:
    return t["documents"].select("doc_id", keyword_region("text", [COLOURS, NOUNS]).alias("region"))


@query(
    "keyword_region_dim",
    f"SELECT p_partkey, {_region_sql('p_name', [COLOURS, NOUNS])} AS region FROM part",
)
def keyword_region_dim(t: Tables) -> DataFrame:
    parts = t["part"]
    rows = [(lv, i, k, v) for lv, words in enumerate([COLOURS, NOUNS]) for i, (k, v) in enumerate(words)]
    dim = parts.sparkSession.createDataFrame(rows, "level int, ord int, keyword string, label string")
    return tag_by_keywords(parts.select("p_partkey", "p_name"), "p_name", dim, "region").select("p_partkey", "region")


# Addresses made of a province, of a city with a province in the caller's list, or of neither.
CITIES = [("石家庄", "河北"), ("大连", "辽宁"), ("苏州", "江苏"), ("杭州", "浙江"), ("深圳", "广东")]
ADDRESS = "concat(p_name, CASE WHEN p_partkey % 3 < 2 THEN {city} ELSE '' END, CASE WHEN p_partkey % 3 = 0 THEN {province} ELSE '' END, '路')"


def _case(texts: list[str]) -> str:
    return f"CASE p_partkey % {len(texts)} " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(texts)) + " END"


ADDRESS = ADDRESS.format(city=_case([c for c, _ in CITIES]), province=_case(codes.PROVINCES))


@query("address_region", f"SELECT p_partkey, {_region_sql('a', [[(p, p) for p in codes.PROVINCES], CITIES])} AS region FROM (SELECT p_partkey, {ADDRESS} AS a FROM part)")
def address_region_query(t: Tables) -> DataFrame:
    """A province named in the text wins over any city, whatever their places in it."""
    cities = t["part"].sparkSession.createDataFrame([(i, c, p) for i, (c, p) in enumerate(CITIES)], "ord int, city string, province string")
    addresses = t["part"].select("p_partkey", F.expr(ADDRESS).alias("address"))
    return tag_addresses(addresses, "address", cities, "region").select("p_partkey", "region")


@query(
    "mask_digits",
    r"""SELECT doc_id, array_to_string([
        CASE WHEN regexp_full_match(x, '\d{8,}') THEN repeat('1254', CAST(length(x) // 4 - 1 AS INTEGER)) || substring(x, (length(x) // 4 - 1) * 4 + 1)
        ELSE x END FOR x IN regexp_extract_all(text, '\d+|\D+')], '') AS masked FROM documents""",
)
def mask_digits_query(t: Tables) -> DataFrame:
    return t["documents"].select("doc_id", mask_digits("text").alias("masked"))


@query(
    "protect_columns",
    "SELECT c_custkey, c_name, c_mktsegment, true AS hidden FROM customer",
)
def protect_columns_query(t: Tables) -> DataFrame:
    # A throw-away key: real keys come from the job's configuration.
    key = F.lit("0123456789abcdef")
    plain = t["customer"].select("c_custkey", "c_name", "c_mktsegment", F.col("c_name").alias("__plain"))
    hidden = protect_columns(plain, ["c_name", "c_mktsegment"], key)
    hidden = hidden.withColumn("hidden", F.col("c_name") != F.col("__plain"))
    return unprotect_columns(hidden, ["c_name", "c_mktsegment"], key).drop("__plain")
