"""Merging facts, versions and snapshots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.scalars import int_part
from ledgerloom.operators.joins import SPARES, all_present, spare


def upsert(base: DataFrame, delta: DataFrame, key: Sequence[str], insert_new: bool = True) -> DataFrame:
    """Delta rows replace base rows of the same key.

    With ``insert_new`` keys found only in the delta are added; without it they are
    ignored (update-only refresh). Keys are unique in both inputs.
    """
    key = list(key)
    kept = base.join(delta.select(*key), key, "left_anti")
    changed = delta if insert_new else delta.join(base.select(*key), key, "left_semi")
    return kept.select(*base.columns).unionByName(changed.select(*base.columns))


def change_flag(
    cur: DataFrame,
    prev: DataFrame,
    key: Sequence[str],
    text_cols: Sequence[str],
    int_cols: Mapping[str, int | None],
    name: str = "changed",
    labels: tuple[str, str] = ("是", "否"),
) -> DataFrame:
    """Mark rows that differ from the previous snapshot.

    Texts compare with ``''`` for a missing previous value. Amounts compare by whole part
    only (a change below one unit is none); the mapping gives the stand-in for a missing
    previous amount, NULL meaning that a missing amount alone marks nothing.
    """
    key = list(key)
    cols = [*text_cols, *int_cols]
    old = prev.select(*key, *[F.col(c).alias(f"__old_{c}") for c in cols])
    differs: Column = F.lit(False)
    for c in text_cols:
        differs = differs | (F.col(c) != F.coalesce(F.col(f"__old_{c}"), F.lit("")))
    for c, missing in int_cols.items():
        before = int_part(f"__old_{c}")
        if missing is not None:
            before = F.when(F.col(f"__old_{c}").isNull(), F.lit(missing)).otherwise(before)
        differs = differs | (int_part(c) != before)
    joined = cur.join(old, key, "left")
    return joined.withColumn(name, F.when(differs, labels[0]).otherwise(labels[1])).select(*cur.columns, name)


def outer_chain(
    facts: Sequence[tuple[DataFrame, str]],
    keys: Sequence[str],
    key_rule: str,
    blank_keys: bool = False,
    single_lines: Sequence[str] = (),
) -> DataFrame:
    """Chain of full outer joins, kept as the reports define it.

    ``key_rule='neighbour'`` joins each fact to the one before it, ``'first'`` joins all
    to the first; either way facts absent from the joined-to side start rows of their
    own, so one key may take several rows. Each fact is (frame, measure name). Output
    keys are the first non-NULL over the chain (blank texts skipped with ``blank_keys``).
    Facts hold one row per key (checked), except the last, whose rows join each on its own;
    ``single_lines`` names it where that is meant.

    No outer join is planned, as rows absent from one side would all meet on a NULL key:
    the facts are stacked and grouped once by key, and each key is unfolded into its rows.
    Keys with a NULL part match nothing and stay single rows. The rows of the last fact are
    then placed by one inner join, whose hot keys can be split on either side: rows that
    the last fact has no part in join numbered stand-ins.
    """
    if key_rule not in ("neighbour", "first"):
        raise ValueError(key_rule)
    keys, names = list(keys), [measure for _, measure in facts]
    last = len(facts) - 1
    if set(single_lines) - {names[last]}:
        raise ValueError("only the last fact may repeat its keys")

    stacked = None
    for i, (frame, measure) in enumerate(facts):
        value = F.struct(measure) if i < last else F.lit(True)
        # A row with a NULL key part is a group of its own, but for rows of the last fact.
        own = F.lit(0) if i == last else F.when(all_present(keys), F.lit(0)).otherwise(F.monotonically_increasing_id() + 1)
        part = frame.select(*keys, own.cast("long").alias("__own"), *[value.alias(f"__{j}") if j == i else F.lit(None).alias(f"__{j}") for j in range(last + 1)])
        stacked = part if stacked is None else stacked.unionByName(part)
    present = [F.col(f"__{i}").isNotNull() for i in range(last + 1)]

    def once(i: int) -> Column:
        """The fact's measure of a key, NULL if absent; of the last fact, only its presence."""
        value = F.max(f"__{i}")
        if i == last:
            return value
        twice = F.raise_error(F.lit(f"{names[i]}: a key occurs twice"))
        return F.when(F.count(f"__{i}") <= 1, value).otherwise(twice.cast(stacked.schema[f"__{i}"].dataType))

    found = stacked.groupBy(*keys, "__own").agg(*[once(i).alias(f"__{i}") for i in range(last + 1)])

    def row(values: Sequence[Column], joined: Column) -> Column:
        return F.struct(*[v.alias(n) for v, n in zip(values, names)], joined.alias("__joined"))

    def measure(i: int) -> Column:
        return F.col(f"__{i}")[names[i]]

    def unfolded(start: int) -> Column:
        """The row that begins with fact ``start``, NULL if none does."""
        if key_rule == "neighbour":
            begins = present[start] if start == 0 else present[start] & ~present[start - 1]
            held = [F.lit(False)] * start
            for i in range(start, last):
                held.append(present[i] if i == start else held[-1] & present[i])
            joined = held[last - 1] & present[last]
        else:
            begins = present[0] if start == 0 else present[start] & ~present[0]
            held = [present[i] if start == 0 else F.lit(i == start) for i in range(last)]
            joined = present[last] if start == 0 else F.lit(False)
        return F.when(begins, row([F.when(held[i], measure(i)) for i in range(last)], joined))

    # Rows of the last fact that no other fact has a row for join a row without measures.
    meets = last - 1 if key_rule == "neighbour" else 0
    bare = F.when(present[last] & ~present[meets], row([F.when(F.lit(False), measure(i)) for i in range(last)], F.lit(True)))
    rows = found.select(*keys, "__own", F.inline(F.array_compact(F.array(*[unfolded(i) for i in range(last)], bare))))
    number = F.when(F.col("__joined"), F.lit(-1)).otherwise(spare(F.col("__own"), *[F.col(k) for k in keys]))
    rows = rows.select(*keys, *names[:last], number.alias("__spare"), *[F.when(F.col("__joined"), F.col(k)).alias(f"__{k}") for k in keys])

    lines = facts[last][0].select(F.lit(-1).alias("__no"), *[F.col(k).alias(f"__to_{k}") for k in keys], names[last])
    numbers = lines.sparkSession.range(SPARES).select(F.col("id").alias("__no"))
    lines = lines.unionByName(numbers, allowMissingColumns=True)
    same = [F.col("__spare") == F.col("__no"), *[F.col(f"__{k}").eqNullSafe(F.col(f"__to_{k}")) for k in keys]]
    out = rows.join(lines, same).select(*keys, *names)

    kinds = dict(facts[0][0].dtypes)
    picked = [F.nullif(F.col(k), F.lit("")).alias(k) if blank_keys and kinds[k] == "string" else F.col(k) for k in keys]
    return out.select(*picked, *names)


def multi_fact_merge(facts: Mapping[str, DataFrame], keys: Sequence[str], measure: str) -> DataFrame:
    """Totals of several facts side by side, one row per key, one shuffle.

    What the outer chains approximate: a key found in any set of facts gets exactly one
    row, and NULL keys form a group. Missing facts are NULL.
    """
    stacked = None
    for tag, fact in facts.items():
        part = fact.select(*keys, *[F.col(measure).alias(t) if t == tag else F.lit(None).alias(t) for t in facts])
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked.groupBy(*keys).agg(*[F.sum(t).alias(t) for t in facts])
