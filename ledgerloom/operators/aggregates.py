"""Aggregations that need more than one built-in call."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.scalars import MONEY_TYPE, ColumnLike, as_col, ratio_amount


def ratio_sum(amount: ColumnLike, ratio: ColumnLike) -> Column:
    """Money total of amounts grossed up by a percentage where there is one."""
    return F.sum(ratio_amount(amount, ratio)).cast(MONEY_TYPE)


def money_sum(amount: ColumnLike) -> Column:
    return F.sum(as_col(amount)).cast(MONEY_TYPE)


def collect_names(df: DataFrame, keys: Sequence[str], col: str, out: str, sep: str = "/") -> DataFrame:
    """Sorted, separated list of the distinct names per key; NULLs are skipped.

    The distinct names are dealt to ranges of (keys, name), so the names of a hot key are
    sorted and joined in many tasks, and only the joined pieces of a key meet, in their order.
    """
    ranges = df.select(*keys, F.col(col).alias("__name")).distinct().repartitionByRange(*keys, "__name")
    listed = ranges.withColumn("__piece", F.spark_partition_id()).groupBy(*keys, "__piece").agg(F.sort_array(F.collect_list("__name")).alias("__names"))
    pieces = listed.select(*keys, F.struct("__piece", F.when(F.size("__names") > 0, F.array_join("__names", sep)).alias("names")).alias("__part"))
    return pieces.groupBy(*keys).agg(F.array_join(F.transform(F.sort_array(F.collect_list("__part")), lambda p: p["names"]), sep).alias(out))


def preagg_join(
    base: DataFrame, facts: Sequence[tuple[DataFrame, Sequence[str], Mapping[str, Column]]]
) -> DataFrame:
    """Left join facts that are first reduced to one row per key, so nothing fans out."""
    out = base
    for fact, keys, aggs in facts:
        reduced = fact.groupBy(*keys).agg(*[c.alias(name) for name, c in aggs.items()])
        out = out.join(reduced, list(keys), "left")
    return out


def tagged_pivot(
    facts: Mapping[str, DataFrame], keys: Sequence[str], measure: str, how: str = "sum"
) -> DataFrame:
    """One column per fact, one row per key, in a single shuffle.

    The facts are stacked with a tag and reduced with one conditional aggregate per tag;
    partial aggregation leaves one row per key and task before the exchange.
    """
    agg = {"sum": F.sum, "min": F.min, "max": F.max}[how]
    stacked = None
    for tag, fact in facts.items():
        part = fact.select(*keys, F.col(measure).alias("__m"), F.lit(tag).alias("__tag"))
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked.groupBy(*keys).agg(
        *[agg(F.when(F.col("__tag") == tag, F.col("__m"))).alias(tag) for tag in facts]
    )
