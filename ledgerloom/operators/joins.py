"""Join shapes of the reports.

No operator here forces a broadcast: Spark broadcasts a side by its measured size and
falls back to a shuffle join, whose hot partitions adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.scalars import split_list


@dataclass(frozen=True)
class Dim:
    """A lookup table of a star join.

    ``on`` maps fact (or earlier output) columns to key columns of ``frame``; ``take``
    maps output names to columns of ``frame``. ``unique`` says that a key is meant to occur
    once; a lookup that repeats fact rows on purpose has it off. ``spread`` names fact
    columns that deal the rows without a key, where these may be many: a shuffle by the key
    alone would bring all of them to one task.
    """

    frame: DataFrame
    on: Mapping[str, str]
    take: Mapping[str, str] = field(default_factory=dict)
    name: str = "dim"
    unique: bool = True
    spread: Sequence[str] = ()


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count; empty when a join on them is 1:1."""
    return df.where(all_present(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def one_per_key(side: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``side``, which fails when it is read if a whole key occurs twice; keys with a NULL go.

    The copies are counted by the shuffle on the key that a join of large sides needs
    anyway, and before it in each task; no job and no scan is added.
    """
    rest = [c for c in side.columns if c not in keys]
    value = F.first(F.struct(F.lit(1).alias("__one"), *rest))
    twice = F.raise_error(F.concat(F.lit(f"{name}: join key {list(keys)} is not unique: "), F.to_json(F.struct(*keys))))
    once = side.where(all_present(keys)).groupBy(*keys).agg(value.alias("__value"), F.count(F.lit(1)).alias("__copies"))
    checked = F.when(F.col("__copies") == 1, F.col("__value")).otherwise(twice.cast(once.schema["__value"].dataType))
    return once.select(*keys, checked.alias("__value")).select(*keys, *[F.col("__value")[c].alias(c) for c in rest])


def star_join(fact: DataFrame, dims: Sequence[Dim], check_unique: bool = True) -> DataFrame:
    """Left join each dim, keeping only the columns it is asked for.

    The key columns of a dim are renamed apart first, so one table can play many roles. A
    dim that would repeat fact rows fails the job, unless ``check_unique`` or its own
    ``unique`` says that rows are meant to be repeated.
    """
    out, spent = fact, []
    for i, dim in enumerate(dims):
        keys = {right: f"__{i}_{right}" for right in dim.on.values()}
        side = dim.frame.select(
            *[F.col(right).alias(tmp) for right, tmp in keys.items()],
            *[F.col(src).alias(name) for name, src in dim.take.items()],
        )
        if dim.spread:
            # Every key of the lookup has place 0, written so that it stays a join key.
            place, there = "__at_" + "_".join([*dim.on, *dim.spread]), f"__{i}_at"
            side = side.withColumn(there, F.pmod(F.xxhash64(*keys.values()), F.lit(1)))
            if place not in out.columns:
                out = out.withColumn(place, F.when(all_present(list(dim.on)), F.lit(0)).otherwise(spare(*dim.spread) + 1))
                spent.append(place)
        if check_unique and dim.unique:
            side = one_per_key(side, [*keys.values(), *([there] if dim.spread else [])], dim.name)
        cond = [F.col(left) == F.col(keys[right]) for left, right in dim.on.items()]
        if dim.spread:
            cond.append(F.col(place) == F.col(there))
            spent.append(there)
        out = out.join(side, cond, "left")
        spent += keys.values()
    return out.drop(*spent)


def left_join_filtered(left: DataFrame, right: DataFrame, on: Sequence[str], right_pred: Column) -> DataFrame:
    """Left join whose extra predicate concerns the right side only: filter it first."""
    return left.join(right.where(right_pred), list(on), "left")


def header_join(header: DataFrame, entry: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Header left join entries, as matched pairs plus headers without an entry.

    Adaptive execution can split a hot key on the left of a left join, not on its right,
    and here the right side is the large one: a header may own a third of all entries.
    Either side of an inner join can be split.
    """
    on = [on] if isinstance(on, str) else list(on)
    alone = header.join(entry.select(*on).distinct(), on, "left_anti")
    return header.join(entry, on).unionByName(alone, allowMissingColumns=True)


def semi_by(df: DataFrame, keys: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows whose key occurs in ``keys``, which may repeat its keys any number of times."""
    return _filter_join(df, keys, on, "left_semi")


def anti_by(df: DataFrame, keys: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows whose key does not occur in ``keys``, including rows without a key."""
    return _filter_join(df, keys, on, "left_anti")


def not_in(df: DataFrame, col: str, sub: DataFrame, sub_col: str) -> DataFrame:
    """SQL ``NOT IN`` for a list of any size.

    One NULL in the list rejects every row; a NULL value passes only an empty list.
    Spark's own null-aware join must broadcast the list. Here the list is shuffled as an
    ordinary anti join, and its row and NULL counts come from one-row subqueries.
    """
    listed = sub.select(F.col(sub_col).alias("__listed"))
    sizes = F.struct(F.count(F.lit(1)).alias("all"), F.count_if(F.col("__listed").isNull()).alias("nulls"))
    counted = listed.agg(sizes).scalar()
    wanted = listed.where(F.col("__listed").isNotNull()).distinct()
    kept = df.join(wanted, df[col] == wanted["__listed"], "left_anti")
    return kept.where((counted["all"] == 0) | ((counted["nulls"] == 0) & F.col(col).isNotNull()))


#: Stand-in rows that take the rows without a partner; they spread over as many tasks, and
#: adaptive execution splits those further.
SPARES = 1024


def spare(*cols: Column) -> Column:
    """Number of the stand-in that takes a row, the same whenever the row is computed anew."""
    return F.pmod(F.xxhash64(*cols), F.lit(SPARES))


def full_join_split(left: DataFrame, right: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Full outer join as one inner join in which every row has a partner.

    Adaptive execution can split a hot key of an inner join, whichever side has it, but not
    of a full outer join. One aggregate over the keys of both sides finds those that only
    one side has; a stand-in row without values joins the other side for each. Rows with a
    NULL key, which match nothing, share numbered stand-ins. Column names of the two sides
    must differ.
    """
    spark, keys = left.sparkSession, {f"__k{i}": pair for i, pair in enumerate(on.items())}

    def tagged(df: DataFrame, cols: Sequence[str], tag: int) -> DataFrame:
        return df.where(all_present(cols)).select(*[F.col(c).alias(k) for k, c in zip(keys, cols)], F.lit(tag).alias("__sides"))

    def whole(df: DataFrame, cols: Sequence[str], first: int) -> DataFrame:
        """Rows with join keys apart from their own columns, and stand-ins of NULL keys."""
        whole_key = all_present(cols)
        plain = [F.col(c) for c, kind in df.dtypes if not kind.startswith(("map", "variant"))]
        number = F.when(whole_key, F.lit(-1)).otherwise(spare(*plain) + first)
        return df.select(number.alias("__spare"), *[F.when(whole_key, F.col(c)).alias(k) for k, c in zip(keys, cols)], "*")

    numbers = spark.range(SPARES)
    sides = tagged(left, list(on), 1).unionByName(tagged(right, list(on.values()), 2)).groupBy(*keys).agg(F.bit_or("__sides").alias("__sides"))
    only_left = sides.where("__sides = 1").select(F.lit(-1).alias("__spare"), *keys)
    only_right = sides.where("__sides = 2").select(F.lit(-1).alias("__spare"), *keys)
    a = whole(left, list(on), 0).unionByName(only_right, allowMissingColumns=True)
    a = a.unionByName(numbers.select((F.col("id") + SPARES).alias("__spare")), allowMissingColumns=True)
    b = whole(right, list(on.values()), SPARES).unionByName(only_left, allowMissingColumns=True)
    b = b.unionByName(numbers.select(F.col("id").alias("__spare")), allowMissingColumns=True)
    b = b.withColumnsRenamed({k: f"{k}r" for k in ["__spare", *keys]})
    same = [F.col("__spare") == F.col("__sparer"), *[F.col(k).eqNullSafe(F.col(f"{k}r")) for k in keys]]
    return a.join(b, same).select(*left.columns, *right.columns)


def membership_join(
    df: DataFrame, row_id: str, list_col: str, sep: str, dim: DataFrame, code: str, name: str, out: str, joiner: str = "/"
) -> DataFrame:
    """Names of all codes in a separated list, joined into one text per row.

    A contains-join would compare every row with every code. Splitting the list gives an
    equi join; the regrouping holds at most one list per row id. Each distinct code of a
    row counts once and names are sorted; rows without a hit get ``''``.
    """
    codes = df.select(row_id, F.explode(F.array_distinct(split_list(list_col, sep))).alias("__code"))
    lookup = dim.select(F.col(code).alias("__code"), F.col(name).alias("__name"))
    named = codes.join(lookup, "__code", "left")
    grouped = named.groupBy(row_id).agg(
        F.concat_ws(joiner, F.sort_array(F.collect_list("__name"))).alias(out)
    )
    return df.join(grouped, row_id, "left").withColumn(out, F.coalesce(F.col(out), F.lit("")))


def all_present(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def _filter_join(df: DataFrame, keys: DataFrame, on: Mapping[str, str], how: str) -> DataFrame:
    # Reduced to distinct keys in the map tasks: a hot key in the list travels once per task.
    side = keys.select(*[F.col(b).alias(f"__{b}") for b in on.values()]).distinct()
    return df.join(side, [df[a] == side[f"__{b}"] for a, b in on.items()], how)
