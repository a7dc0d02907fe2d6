"""Versioned tables: one-step publishing, slices, buckets, labels."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import upkeep
from ledgerloom.sources.tables import Catalog
from ledgerloom.sources.versions import Conflict, VersionedTable


@pytest.fixture
def store(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "store"))


@pytest.fixture
def months(spark):
    rows = [(1, "2023-05", 5), (2, "2023-06", 6), (3, "2023-06", 7), (4, None, 8), (5, "", 9), (6, "null", 1), (7, "a/b=c %", 2)]
    return spark.createDataFrame(rows, "id int, month string, v int")


def pairs(df):
    return sorted((r["id"], r["v"]) for r in df.collect())


def test_publish_over_itself_and_read_by_name(spark, store, months):
    assert store.manifest() is None and store.versions() == [] and store.before("z") is None
    with pytest.raises(FileNotFoundError):
        store.read()
    store.publish(months)
    store.publish(store.read().where("id > 4").withColumn("v", F.col("v") * 10))
    assert pairs(store.read()) == [(5, 90), (6, 10), (7, 20)]
    assert pairs(store.read(1)) == pairs(months)
    assert Catalog(spark, stores={"m": store.path})["m"].count() == 3
    store.publish(months.limit(0))
    assert store.read().count() == 0 and store.read().columns == months.columns


def test_a_crash_before_the_switch_leaves_the_old_version(store, months, monkeypatch):
    store.publish(months, slice_by="month")

    def crash(new):
        raise OSError("lost")

    monkeypatch.setattr(store, "_commit", crash)
    with pytest.raises(OSError):
        store.publish(months.where("id = 1"))
    with pytest.raises(OSError):
        store.replace_slices(months.limit(0), ["2023-05"])
    monkeypatch.undo()
    assert pairs(store.read()) == pairs(months) and store.versions() == [1]
    store.clean()
    assert len(os.listdir(f"{store.path}/data")) == 1 and pairs(store.read()) == pairs(months)


def test_a_failing_job_publishes_nothing(store, months):
    store.publish(months)
    with pytest.raises(Exception):
        store.publish(months.withColumn("v", F.raise_error(F.lit("bad row")).cast("int")))
    assert store.versions() == [1]


def test_one_of_two_writers_wins(spark, store, months, monkeypatch):
    store.publish(months)
    other = VersionedTable(spark, store.path)
    write = store._write

    def slowly(df, cut):
        out = write(df, cut)
        other.publish(months.where("id = 2"))
        return out

    monkeypatch.setattr(store, "_write", slowly)
    with pytest.raises(Conflict):
        store.publish(months.where("id = 1"))
    assert pairs(store.read()) == [(2, 6)]
    assert [f for f in os.listdir(f"{store.path}/manifests") if f.startswith(".") and not f.endswith(".crc")] == []


def test_replaced_slices_can_be_emptied(store, months):
    store.publish(months, slice_by="month")
    before = store.manifest().parts
    assert set(before) == {"v2023-05", "v2023-06", "null", "v", "vnull", "va/b=c %"}
    store.replace_slices(months.limit(0), ["2023-06", None])
    assert pairs(store.read()) == [(1, 5), (5, 9), (6, 1), (7, 2)]
    after = store.manifest().parts
    assert {k: before[k] for k in after} == after
    store.replace_slices(months.where("id in (4, 7)").withColumn("v", F.lit(0)), [None, "a/b=c %", "new"])
    assert pairs(store.read()) == [(1, 5), (4, 0), (5, 9), (6, 1), (7, 0)]
    assert pairs(store.read(slices=["va/b=c %"])) == [(7, 0)]
    with pytest.raises(ValueError):
        store.replace_slices(months.where("id in (1, 2)"), ["2023-05"])
    assert store.versions() == [1, 2, 3]


def test_upsert_rewrites_touched_buckets_only(spark, store):
    base = spark.range(1000).select(F.col("id"), F.lit(0).alias("v"))
    store.publish(base, key=["id"], buckets=8)
    before = store.manifest().parts
    assert len(before) == 8
    delta = spark.createDataFrame([(5, 1), (5000, 2)], "id long, v int")
    touched = store.upsert(delta)
    after = store.manifest().parts
    assert 1 <= len(touched) <= 2
    assert {k for k in after if after[k] != before.get(k)} == set(touched)
    got = dict(pairs(store.read()))
    assert len(got) == 1001 and got[5] == 1 and got[5000] == 2 and got[6] == 0
    assert len(store.upsert(spark.createDataFrame([(7, 3), (6000, 4)], "id long, v int"), insert_new=False)) <= 2
    got = dict(pairs(store.read()))
    assert got[7] == 3 and 6000 not in got and store.upsert(delta.limit(0)) == []
    store.publish(store.read().where("id < 10"))
    assert store.manifest().key == ("id",) and store.read().count() == 10


def test_wrong_uses_are_refused(store, months):
    with pytest.raises(FileNotFoundError):
        store.upsert(months)
    with pytest.raises(ValueError):
        store.publish(months, key=["id"])
    store.publish(months)
    with pytest.raises(ValueError):
        store.upsert(months)
    with pytest.raises(ValueError):
        store.replace_slices(months, ["2023-05"])


def test_clean_keeps_the_newest(store, months):
    store.publish(months, slice_by="month")
    store.replace_slices(months.where("id = 1").withColumn("v", F.lit(50)), ["2023-05"])
    store.replace_slices(months.limit(0), ["2023-06"])
    store.clean(2)
    assert store.versions() == [2, 3] and pairs(store.read(2))[0] == (1, 50)
    store.clean()
    assert pairs(store.read()) == [(1, 50), (4, 8), (5, 9), (6, 1), (7, 2)]


def test_refresh_and_deltas(spark, store, tmp_path):
    rows = [(1, "a", "2020"), (1, "b", "2021"), (2, "c", None)]
    store.publish(spark.createDataFrame(rows, "k int, v string, t string"))
    upkeep.refresh_stores({"t": store}, [upkeep.TableSpec("t", "k", "t")])
    assert sorted((r["k"], r["v"]) for r in store.read().collect()) == [(1, "b"), (2, "c")]
    keyed = VersionedTable(spark, str(tmp_path / "keyed"))
    keyed.publish(store.read(), key=["k"], buckets=4)
    delta = spark.createDataFrame([(2, "d", "2022"), (2, "e", "2023"), (3, "f", None)], "k int, v string, t string")
    touched = upkeep.apply_deltas({"t": keyed}, {"t": delta}, [upkeep.TableSpec("t", "k", "t")])
    assert 1 <= len(touched["t"]) <= 2
    assert sorted((r["k"], r["v"]) for r in keyed.read().collect()) == [(1, "b"), (2, "e"), (3, "f")]


def test_runs_are_flagged_against_the_run_before(spark, store):
    def run(day, rows):
        df = spark.createDataFrame(rows, "k int, s string, due double")
        out = upkeep.publish_flagged(store, df, day, ["k"], ["s"], {"due": 0})
        return {r["k"]: r["changed"] for r in out.collect()}

    first = [(1, "x", 5.0), (2, "y", 6.0)]
    assert run("2024-01-01", first) == {1: "是", 2: "是"}
    second = [(1, "x", 5.4), (2, "z", 6.0), (3, "w", 0.0)]
    want = {1: "否", 2: "是", 3: "是"}
    assert run("2024-01-02", second) == want and run("2024-01-02", second) == want
    assert run("2024-01-01", first) == {1: "是", 2: "是"}
    assert run("2024-01-03", second) == {1: "否", 2: "否", 3: "否"}
