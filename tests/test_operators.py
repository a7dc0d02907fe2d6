"""Operators on small frames: duplicates, NULL keys, hot keys, invariants."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import aggregates as a
from ledgerloom.operators import joins as j
from ledgerloom.operators import lineage as li
from ledgerloom.operators import merge as m
from ledgerloom.operators import windows as w


def test_star_join_roles_and_unique_check(spark, rows):
    fact = spark.createDataFrame([(1, 10, 20), (2, 20, None)], "id int, a int, b int")
    dim = spark.createDataFrame([(10, "x"), (20, "y")], "k int, name string")
    out = j.star_join(fact, [j.Dim(dim, {"a": "k"}, {"a_name": "name"}), j.Dim(dim, {"b": "k"}, {"b_name": "name"})])
    assert rows(out) == [(1, 10, 20, "x", "y"), (2, 20, None, "y", None)]
    twice = dim.unionByName(dim)
    with pytest.raises(Exception, match="names: join key .* is not unique"):
        j.star_join(fact, [j.Dim(twice, {"a": "k"}, {"n": "name"}, "names")]).collect()
    meant = j.star_join(fact, [j.Dim(twice, {"a": "k"}, {"n": "name"}, unique=False)])
    assert meant.count() == j.star_join(fact, [j.Dim(twice, {"a": "k"}, {"n": "name"})], check_unique=False).count() == 4
    nulls = dim.unionByName(spark.createDataFrame([(None, "z"), (None, "z")], "k int, name string"))
    assert rows(j.star_join(fact, [j.Dim(nulls, {"a": "k"}, {"n": "name"})])) == [(1, 10, 20, "x"), (2, 20, None, "y")]


def test_header_join_equals_left_join(spark, rows):
    head = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, h string")
    body = spark.createDataFrame([(1, 5), (1, 6), (3, 7), (None, 8)], "k int, v int")
    assert rows(j.header_join(head, body, "k")) == rows(head.join(body, "k", "left"))


@pytest.mark.parametrize("listed, kept", [([1, 3], [2]), ([1, None], []), ([], [1, 2, None])])
def test_not_in(spark, listed, kept):
    df = spark.createDataFrame([(1,), (2,), (None,)], "v int")
    sub = spark.createDataFrame([(x,) for x in listed], "x int")
    assert sorted([r[0] for r in j.not_in(df, "v", sub, "x").collect()], key=str) == sorted(kept, key=str)


def test_semi_and_anti_with_repeated_keys(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (None,)], "v int")
    keys = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(j.semi_by(df, keys, {"v": "k"})) == [(1,)]
    assert rows(j.anti_by(df, keys, {"v": "k"})) == [(None,), (2,)]


def test_full_join_split_equals_full_join(spark, rows):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "x int, l string")
    right = spark.createDataFrame([(1, "p"), (1, "q"), (3, "r"), (None, "s"), (None, "s")], "y int, r string")
    for a, b in ((left, right), (left.limit(0), right), (left, right.limit(0)), (left.limit(0), right.limit(0))):
        got = j.full_join_split(a, b, {"x": "y"})
        assert rows(got, "x", "l", "y", "r") == rows(a.join(b, a.x == b.y, "full"), "x", "l", "y", "r")


def test_full_join_split_on_two_keys(spark, rows):
    left = spark.createDataFrame([(1, "a", 5), (1, None, 6), (None, None, 7), (2, "b", 8)], "x int, s string, l int")
    right = spark.createDataFrame([("a", 1, 50), (None, 1, 60), ("b", 3, 70)], "t string, y int, r int")
    got = j.full_join_split(left, right, {"x": "y", "s": "t"})
    assert got.columns == ["x", "s", "l", "t", "y", "r"]
    assert rows(got) == rows(left.join(right, (left.x == right.y) & (left.s == right.t), "full"))


def test_membership_join(spark, rows):
    df = spark.createDataFrame([(1, "25、59、25"), (2, "99"), (3, ""), (4, None), (5, "59、25")], "id int, codes string")
    dim = spark.createDataFrame([("25", "Grid"), ("59", "Rail")], "code string, name string")
    out = j.membership_join(df, "id", "codes", "、", dim, "code", "name", "names")
    assert rows(out, "id", "names") == [(1, "Grid/Rail"), (2, ""), (3, ""), (4, ""), (5, "Grid/Rail")]


def test_latest_and_first(spark, rows):
    df = spark.createDataFrame(
        [(1, "2020-01-01", 1), (1, "2020-01-02", 2), (1, "2020-01-02", 3), (2, None, 4), (2, "2019-01-01", 5), (3, None, 6), (None, "2020-01-01", 7)],
        "k int, t string, id int",
    )
    assert rows(w.latest_per_key(df, ["k"], "t", ["id"]), "k", "id") == [(None, 7), (1, 3), (2, 5), (3, 6)]
    assert rows(w.first_per_key(df, ["k"], "t", ["id"]), "k", "id") == [(None, 7), (1, 1), (2, 5), (3, 6)]


def test_latest_with_total_matches_its_parts(spark, rows):
    df = spark.createDataFrame([(1, "a", None, 2), (1, "b", "2020", 3), (1, "c", "2020", 4), (2, "d", None, 5)], "k int, n string, t string, q int")
    got = w.latest_with_total(df, ["k"], "t", ["n"], ["n", "t"], "q", "total")
    assert rows(got) == [(1, "c", "2020", 9), (2, "d", None, 5)]


def test_partition_total_keeps_null_groups(spark, rows):
    df = spark.createDataFrame([(1, 2), (1, 3), (None, 4), (None, 5)], "k int, q int")
    assert rows(w.partition_total(df, ["k"], "q", "t")) == [(None, 4, 9), (None, 5, 9), (1, 2, 5), (1, 3, 5)]


def hot_rows(n=3000, seed=1):
    """A third of the rows share one key."""
    rnd = random.Random(seed)
    return [(0 if i % 3 == 0 else rnd.randrange(1, 200), i, rnd.randrange(50)) for i in range(n)]


def test_global_row_id_is_dense_and_ordered(spark):
    data = hot_rows()
    df = spark.createDataFrame(data, "k int, id int, q int").repartition(7)
    got = w.global_row_id(df, [F.col("k").asc(), F.col("q").desc(), F.col("id").asc()], "row_id").collect()
    want = sorted(data, key=lambda r: (r[0], -r[2], r[1]))
    assert [(r["k"], r["id"], r["q"]) for r in sorted(got, key=lambda r: r["row_id"])] == want
    assert sorted(r["row_id"] for r in got) == list(range(1, len(data) + 1))


def test_global_row_id_null_order_and_empty(spark):
    df = spark.createDataFrame([(None, 1), ("b", 2), ("a", 3)], "d string, id int")
    got = w.global_row_id(df, [F.col("d").asc_nulls_first(), F.col("id").asc()], "n")
    assert [(r["id"], r["n"]) for r in got.orderBy("n").collect()] == [(1, 1), (3, 2), (2, 3)]
    assert w.global_row_id(df.where("id < 0"), [F.col("d").asc()], "n").count() == 0


def test_upsert(spark, rows):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    delta = spark.createDataFrame([("B", 2), ("C", 3)], "v string, k int")
    assert rows(m.upsert(base, delta, ["k"])) == [(1, "a"), (2, "B"), (3, "C")]
    assert rows(m.upsert(base, delta, ["k"], insert_new=False)) == [(1, "a"), (2, "B")]


def test_change_flag(spark, rows):
    schema = "k int, s string, due double, paid double"
    cur = spark.createDataFrame([(1, "x", 10.9, 1.0), (2, "x", 11.0, 1.0), (3, "y", 10.0, 1.0), (4, "x", 0.5, 0.0), (5, None, None, None)], schema)
    prev = spark.createDataFrame([(1, "x", 10.1, 1.9), (2, "x", 10.0, 1.0), (3, "x", 10.0, 1.0), (5, "x", 1.0, 1.0)], schema)
    got = m.change_flag(cur, prev, ["k"], ["s"], {"due": 0, "paid": None}, labels=("Y", "N"))
    assert rows(got, "k", "changed") == [(1, "N"), (2, "Y"), (3, "Y"), (4, "Y"), (5, "N")]
    # Key 4 is new: its status differs from the blank; a missing amount alone marks nothing.
    same = m.change_flag(cur.where("k = 4").withColumn("s", F.lit("")), prev, ["k"], ["s"], {"due": 0, "paid": None}, labels=("Y", "N"))
    assert rows(same, "k", "changed") == [(4, "N")]


def chain_facts(spark):
    a1 = spark.createDataFrame([(1, 10), (2, 20)], "k int, a int")
    a2 = spark.createDataFrame([(1, 11), (3, 31)], "k int, b int")
    a3 = spark.createDataFrame([(2, 22), (3, 33)], "k int, c int")
    a4 = spark.createDataFrame([(2, 24), (2, 25), (None, 1)], "k int, d int")
    return [(a1, "a"), (a2, "b"), (a3, "c"), (a4, "d")]


def test_outer_chain_rules(spark, rows):
    facts = chain_facts(spark)
    neighbour = rows(m.outer_chain(facts, ["k"], "neighbour"))
    assert neighbour == [(None, None, None, None, 1), (1, 10, 11, None, None), (2, None, None, 22, 24), (2, None, None, 22, 25), (2, 20, None, None, None), (3, None, 31, 33, None)]
    assert rows(m.outer_chain(facts, ["k"], "neighbour", single_lines=["d"])) == neighbour
    first = rows(m.outer_chain(facts, ["k"], "first"))
    assert first == [(None, None, None, None, 1), (1, 10, 11, None, None), (2, 20, None, 22, 24), (2, 20, None, 22, 25), (3, None, None, 33, None), (3, None, 31, None, None)]
    with pytest.raises(ValueError):
        m.outer_chain(facts, ["k"], "last")


def test_outer_chain_plans_no_outer_join_on_absent_keys(spark, rows):
    """Most keys are in one fact only: no step may gather them on a NULL key."""
    facts = [(spark.range(i * 1000, i * 1000 + 1001).selectExpr("id as k", f"id as {n}"), n) for i, n in enumerate("abcd")]
    chain = m.outer_chain(facts, ["k"], "neighbour")
    assert "FullOuter" not in chain._jdf.queryExecution().toString() and chain.count() == 4001
    assert chain.where("a is not null and b is not null").count() == 1
    twice = [(facts[0][0].unionByName(facts[0][0]), "a"), *facts[1:]]
    with pytest.raises(Exception, match="occurs twice"):
        m.outer_chain(twice, ["k"], "first").count()


def test_multi_fact_merge_keeps_every_total(spark, rows):
    facts = {name: f.withColumnRenamed(name, "v") for f, name in chain_facts(spark)}
    got = m.multi_fact_merge(facts, ["k"], "v")
    assert rows(got) == [(None, None, None, None, 1), (1, 10, 11, None, None), (2, 20, None, 22, 49), (3, None, 31, 33, None)]


def parents_and_children(spark):
    parent = spark.createDataFrame([(1, 10), (2, 10), (3, 10), (4, 10), (5, 10)], "p int, q int")
    child = spark.createDataFrame([(1, 4, "a"), (1, 3, "b"), (2, 10, "c"), (3, 12, "d"), (4, None, "e"), (9, 1, "z")], "k int, cq int, n string")
    return parent, child


def test_residual_union(spark, rows):
    parent, child = parents_and_children(spark)
    got = li.residual_union(parent, child, {"p": "k"}, "q", "cq", "out")
    # 1: two children and a rest; 2: used up; 3: overdrawn; 4: child without quantity; 5: no child.
    assert rows(got) == [(1, 10, None, 3), (1, 10, "a", 4), (1, 10, "b", 3), (2, 10, "c", 10), (3, 10, "d", 12), (4, 10, "e", 10), (5, 10, None, 10)]
    total = {r["p"]: r["t"] for r in got.where("p IN (1, 2, 5)").groupBy("p").agg(F.sum("out").alias("t")).collect()}
    assert total == {1: 10, 2: 10, 5: 10}
    plain = li.residual_union(parent, child, {"p": "k"}, "q", "cq", "out", with_rest=False)
    assert rows(plain) == [r for r in rows(got) if r != (1, 10, None, 3)]


def test_taken_quantities_need_no_rows(spark, rows):
    """``with_taken`` and ``residual_total`` agree with the rows of ``residual_union``."""
    parents = [(1, "x", 10), (2, "x", None), (3, "y", 5), (3, "y", 5), (4, "z", None), (None, "z", 7), (5, "w", 4), (6, "v", None), (7, None, 3)]
    parent = spark.createDataFrame(parents, "p int, g string, q int").withColumn("q", F.col("q").cast("decimal(18,2)"))
    children = [(1, 4, "a"), (1, None, "b"), (2, 3, "c"), (3, 2, "d"), (3, 2, "d"), (5, 9, "e"), (6, None, "f"), (None, 1, "g")]
    child = spark.createDataFrame(children, "k int, cq int, id string").withColumn("cq", F.col("cq").cast("decimal(18,2)"))
    plain = li.residual_union(parent, child, {"p": "k"}, "q", "cq", "out", keep_child_qty=True)
    taken = li.with_taken(parent, child, {"p": "k"}, "cq")
    assert taken.count() == parent.count()
    known = li.residual_union(taken, child, {"p": "k"}, "q", "cq", "out", keep_child_qty=True, taken_known=True)
    assert (known.columns, rows(known)) == (plain.columns, rows(plain))
    wanted = plain.groupBy("g").agg(F.sum("out").alias("t"))
    assert rows(li.residual_total(taken, "q", ["g"], "t")) == rows(wanted)
    assert rows(wanted) == [(None, 3), ("v", None), ("w", 9), ("x", 23), ("y", 10), ("z", 7)]


def test_residual_reversed(spark, rows):
    parent, child = parents_and_children(spark)
    assert rows(li.residual_reversed(parent, child, {"p": "k"}, "q", "cq", "out")) == [(3, 10, 2)]


def test_trace_source(spark, rows):
    df = spark.createDataFrame([(1, 1, 1), (2, 9, 9), (3, None, None)], "id int, b int, e int")
    source = spark.createDataFrame([(1, 1, "PO1")], "b int, e int, no string")
    assert rows(li.trace_source(df, source, {"b": "b", "e": "e"}, {"source": "no"}), "id", "source") == [(1, "PO1"), (2, None), (3, None)]


def test_preagg_join_and_pivot_agree(spark, rows):
    facts = {n: spark.createDataFrame(hot_rows(600, i), "k int, id int, q int") for i, n in enumerate("abc")}
    base = facts["a"].unionByName(facts["b"]).unionByName(facts["c"]).select("k").distinct()
    ladder = a.preagg_join(base, [(f, ["k"], {n: F.sum("q")}) for n, f in facts.items()])
    assert rows(a.tagged_pivot(facts, ["k"], "q"), "k", "a", "b", "c") == rows(ladder, "k", "a", "b", "c")


def test_collect_names(spark, rows):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (1, "b"), (2, None)], "k int, n string")
    assert rows(a.collect_names(df, ["k"], "n", "names")) == [(1, "a/b"), (2, "")]
    blank = spark.createDataFrame([(1, ""), (1, "z"), (None, "q"), (None, "p"), (1, "é")], "k int, n string")
    assert rows(a.collect_names(blank, ["k"], "n", "names", "|")) == [(None, "p|q"), (1, "|z|é")]


def test_names_of_a_hot_key_are_joined_in_pieces(spark, rows):
    keys = spark.range(0, 30_000, numPartitions=6).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").cast("string").alias("n"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = a.collect_names(keys, ["k"], "n", "names")
        hot = got.where("k = 0").first()["names"]
        listed = keys.distinct().repartitionByRange("k", "n").where("k = 0").groupBy(F.spark_partition_id()).count().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert hot == "/".join(sorted(str(i) for i in range(0, 30_000, 3))) and got.count() == 20_001
    assert listed > 1


def test_hot_key_results_are_whole(spark, rows):
    data = hot_rows()
    child = spark.createDataFrame(data, "k int, id int, q int")
    parent = spark.createDataFrame([(k, 10_000) for k in range(205)], "p int, total int")
    got = li.residual_union(parent, child, {"p": "k"}, "total", "q", "out").collect()
    taken = {}
    for k, _, q in data:
        taken[k] = taken.get(k, 0) + q
    rest = [10_000 - taken.get(p, 0) for p in range(205)]
    assert len(got) == len(data) + sum(1 for p in range(205) if p not in taken) + sum(1 for p, r in enumerate(rest) if p in taken and r > 0)
    assert sum(r["out"] for r in got) == sum(taken.values()) + sum(r for r in rest if r > 0)
