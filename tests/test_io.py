"""Sources and sinks."""

import json
import os
import time
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from ledgerloom import session
from ledgerloom.plans.upkeep import TableSpec, keep_other_slices, merged_deltas, newest_versions, parse_specs, previous_month
from ledgerloom.sources import json as js
from ledgerloom.sources import sinks, tables


@pytest.fixture
def orders(spark):
    return spark.createDataFrame([(1, "2023-05", 5), (2, "2023-06", 6), (3, "2023-06", 7)], "id int, month string, v int")


def test_catalog_resolves_paths_tables_and_root(spark, orders, tmp_path):
    orders.write.parquet(str(tmp_path / "root" / "orders.parquet"))
    orders.limit(1).write.parquet(str(tmp_path / "one"))
    orders.createOrReplaceTempView("orders_view")
    cat = tables.Catalog(spark, root=str(tmp_path / "root"), paths={"one": str(tmp_path / "one")}, tables={"view": "orders_view"})
    assert (cat["orders"].count(), cat["one"].count(), cat["view"].count()) == (3, 1, 3)
    assert cat["orders"] is cat["orders"]
    assert sorted(cat) == ["one", "view"] and len(cat) == 2
    with pytest.raises(KeyError):
        tables.Catalog(spark)["orders"]


def test_period_slice_is_pushed_to_the_scan(spark, tmp_path):
    rows = [("202212", 1), ("202301", 2), ("202306", 3), ("202312", 4), ("202401", 5)]
    spark.createDataFrame(rows, "period string, v int").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    year = tables.period_slice(df, "period", "202306", whole_year=True)
    assert sorted(r["v"] for r in year.collect()) == [2, 3, 4]
    assert [r["v"] for r in tables.period_slice(df, "period", "202306").collect()] == [3]
    plan = year._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(period,202301)" in plan and "LessThanOrEqual(period,202312)" in plan


def test_self_overwrite_is_staged(spark, orders, tmp_path):
    path = str(tmp_path / "t")
    orders.write.parquet(path)
    sinks.staged_overwrite(spark.read.parquet(path).where("id > 1").withColumn("v", F.col("v") * 10), path)
    assert sorted((r["id"], r["v"]) for r in spark.read.parquet(path).collect()) == [(2, 60), (3, 70)]


def test_newest_versions_over_their_own_table(spark, tmp_path):
    path = str(tmp_path / "versions")
    spark.createDataFrame([(1, "a", "2020"), (1, "b", "2021"), (2, "c", None)], "k int, v string, t string").write.parquet(path)
    for _, df in newest_versions({"t": spark.read.parquet(path)}, [TableSpec("t", "k", "t")]):
        sinks.staged_overwrite(df, path)
    assert sorted((r["k"], r["v"]) for r in spark.read.parquet(path).collect()) == [(1, "b"), (2, "c")]


def test_replace_slice_is_repeatable(spark, orders, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_slice(orders, path, "month")
    fresh = orders.where("month = '2023-06'").limit(1).withColumn("v", F.lit(0))
    for _ in range(2):
        sinks.replace_slice(fresh, path, "month")
    got = sorted((r["month"], r["v"]) for r in spark.read.parquet(path).collect())
    assert got == [("2023-05", 5), ("2023-06", 0)]


def test_write_table_replaces_everything_by_name(spark, orders, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(orders, path)
    sinks.write_table(orders.where("id = 1").select("v", "id"), path, columns=["id", "v"])
    back = spark.read.parquet(path)
    assert back.columns == ["id", "v"] and [tuple(r) for r in back.collect()] == [(1, 5)]


@pytest.mark.parametrize("files", [1, None])
def test_report_csv(spark, orders, tmp_path, files):
    path = tmp_path / "report"
    wide = orders.repartition(3, "id").repartitionByRange(3, "id")
    for _ in range(2):
        assert sinks.write_report_csv(wide, str(path), files) == 3
    assert files is None or len(list(path.glob("part-*.csv"))) == files
    assert spark.read.csv(str(path), header=True).count() == 3


def test_observed_count_needs_no_second_run(spark, orders, tmp_path):
    df, seen = sinks.observed_count(orders.where("id > 1"))
    df.write.parquet(str(tmp_path / "t"))
    assert seen.get["rows"] == 2


@pytest.mark.parametrize("cond, n", [("id > 0", 3), ("id > 9", 0)])
def test_write_counted(spark, orders, tmp_path, cond, n):
    path = str(tmp_path / "t")
    assert sinks.write_counted(orders.where(cond), lambda df: sinks.write_table(df, path, files=2)) == n
    assert spark.read.parquet(path).count() == n


def test_jdbc_options():
    target = tables.JdbcTarget("jdbc:mysql://host/db", "user", "secret")
    assert "secret" not in repr(target)
    plain = tables.jdbc_read_options(target, "t")
    assert plain["dbtable"] == "t" and "numPartitions" not in plain
    split = tables.jdbc_read_options(target, "t", partition_col="id", bounds=("1", "9"), partitions=4)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("id", "1", "9", "4")
    with pytest.raises(ValueError):
        tables.jdbc_read_options(target, "t", partition_col="id", bounds=("1", "9"))
    out = sinks.jdbc_write_options(target, "t", 4, {"a": "varchar(255)", "b": "decimal(19,4)"})
    assert out["createTableColumnTypes"] == "a varchar(255), b decimal(19,4)"
    assert out["numPartitions"] == "4" and out["batchsize"] == "10000" and out["truncate"] == "false"


def test_typed(spark, orders):
    assert dict(sinks.typed(orders, {"v": "decimal(19,4)"}).dtypes)["v"] == "decimal(19,4)"


FEES = {
    "items": [
        {"id": "1", "name": "travel", "parentId": None, "active": True, "code": "A"},
        {"id": "2", "name": "meals", "parentId": "1", "active": False, "code": "B"},
        {"id": "3", "name": "hotel", "parentId": "1", "code": "C"},
    ]
}


def test_item_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(FEES, indent=2))
    (tmp_path / "b.json").write_text(json.dumps({"items": []}))
    items = js.read_items(spark, str(tmp_path))
    assert items.columns == ["id", "name", "parentId", "active", "code"] and items.count() == 3
    assert [tuple(r) for r in js.active_items(items).collect()] == [("1", "travel", None, "true", "A")]


def test_items_in_a_column_and_nested_text(spark):
    doc = json.dumps({"items": [{"id": "1", "form": json.dumps({"code": "X9", "k": 5})}]})
    df = spark.createDataFrame([(7, json.dumps(FEES)), (8, "broken")], "doc_id int, doc string")
    assert sorted((r["doc_id"], r["code"]) for r in js.explode_items(df, "doc", ["doc_id"]).collect()) == [(7, "A"), (7, "B"), (7, "C")]
    nested = spark.createDataFrame([(doc,)], "doc string").select(js.json_field("doc", "items[0].form", "code").alias("code"))
    assert nested.first()["code"] == "X9"


def test_specs_and_deltas(spark):
    specs = parse_specs("orders--id--month, lines--line_id--ts,")
    assert specs == [TableSpec("orders", "id", "month"), TableSpec("lines", "line_id", "ts")]
    base = spark.createDataFrame([(1, "a", "1")], "id int, v string, month string")
    delta = spark.createDataFrame([(1, "b", "2"), (1, "c", "3"), (2, "d", "1")], "id int, v string, month string")
    (name, out), = merged_deltas({"orders": base}, {"orders": delta}, specs[:1])
    assert name == "orders" and sorted(tuple(r) for r in out.collect()) == [(1, "c", "3"), (2, "d", "1")]


def test_slices(spark, orders):
    assert previous_month("2023-06-01") == "2023-05" and previous_month("2023-06-02") == "2023-06"
    nulls = orders.unionByName(spark.createDataFrame([(9, None, 1)], "id int, month string, v int"))
    fresh = orders.limit(0)
    kept = keep_other_slices(nulls, fresh, "month", ["2023-06"])
    assert sorted(r["id"] for r in kept.collect()) == [1, 9]


def session_with(master, folder=None):
    get = lambda key, default=None: folder or default
    return SimpleNamespace(sparkContext=SimpleNamespace(master=master), conf=SimpleNamespace(get=get))


def test_shared_folder(monkeypatch):
    monkeypatch.setattr(session, "_named", [])
    assert session.shared_folder(session_with("spark://host:7077", "hdfs:///scratch/")) == "hdfs:///scratch"
    for master in ("spark://host:7077", "local[2]"):
        with pytest.raises(ValueError):
            session.shared_folder(session_with(master))
    session.name_own_folder(session_with("spark://host:7077"))
    assert not session._named
    session.name_own_folder(session_with("local[2]"))
    assert session.shared_folder(session_with("local[2]")) == session._named[0]


def test_compact_tables_leave_no_shuffle_files(spark):
    def shuffled() -> set[str]:
        folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
        return {f for d in folders for _, _, names in os.walk(d.getPath()) for f in names if f.startswith("shuffle_")}

    grouped = spark.range(1_000).groupBy((F.col("id") % 10).alias("k")).count()
    old, before = spark.conf.get(session.FREE_SHUFFLES, "false"), shuffled()
    with session.scratch(spark):
        kept = session.written_table(grouped, "kept", compact=True)
        for _ in range(50):  # files are deleted in the background
            if left := shuffled() - before:
                time.sleep(0.2)
        assert not left
        assert kept.count() == 10 and all(f.endswith(".zstd.parquet") for f in kept.inputFiles())
    assert spark.conf.get(session.FREE_SHUFFLES, "false") == old


def test_written_tables_are_deleted(spark, orders):
    with session.scratch(spark):
        kept = session.written_table(orders, "kept")
        assert kept.count() == 3
        folder = kept.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
    assert not os.path.exists(folder)


def test_only_the_last_table_is_kept(spark, orders):
    before = session.written_count()
    first, last = session.written_table(orders, "first"), session.written_table(orders, "last")
    folder = first.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
    session.drop_but_last(spark, before)
    assert not os.path.exists(folder) and last.count() == 3 and session.written_count() == before + 1
    session.drop_written(spark, before)
    assert session.written_count() == before


def test_staged_overwrite_leaves_no_copy(spark, orders, tmp_path):
    path, before = str(tmp_path / "t"), len(session._written)
    sinks.write_table(orders, path)
    sinks.staged_overwrite(spark.read.parquet(path).where("id > 1"), path)
    assert spark.read.parquet(path).count() == 2 and len(session._written) == before


@pytest.mark.parametrize("whole, n", [(False, 1), (True, 2)])
def test_period_of_days(spark, whole, n):
    days = spark.sql("select * from values (timestamp'2023-12-31 23:59:59'), (timestamp'2023-01-01 00:00:00'), (timestamp'2024-01-01 00:00:00') as t(day)")
    assert tables.period_slice(days, "day", "202312", whole).count() == n
