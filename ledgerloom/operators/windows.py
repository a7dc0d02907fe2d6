"""Newest/oldest row per key, partition totals and global row ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.functions.scalars import ColumnLike, as_col
from ledgerloom.session import written_table


def latest_per_key(df: DataFrame, keys: Sequence[str], order: ColumnLike, ties: Sequence[str] = ()) -> DataFrame:
    """One row per key: the largest ``order``, then the largest ``ties``. NULLs come last.

    The ``= 1`` filter lets Spark keep one row per key inside every map task before the
    shuffle, so a key that owns a third of the table does not move a third of the table.
    """
    by = [as_col(c).desc_nulls_last() for c in (order, *ties)]
    return _one_per_key(df, keys, by)


def first_per_key(df: DataFrame, keys: Sequence[str], order: ColumnLike, ties: Sequence[str] = ()) -> DataFrame:
    """One row per key: the smallest ``order``, then the smallest ``ties``. NULLs come last."""
    by = [as_col(c).asc_nulls_last() for c in (order, *ties)]
    return _one_per_key(df, keys, by)


def _one_per_key(df: DataFrame, keys: Sequence[str], by: Sequence[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*by))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def latest_with_total(
    df: DataFrame, keys: Sequence[str], order: ColumnLike, ties: Sequence[str], take: Sequence[str], measure: str, total: str
) -> DataFrame:
    """Columns ``take`` of the newest row per key and the key's sum of ``measure``.

    One aggregation: map tasks already reduce each key to its newest row and a sum.
    """
    rank = F.struct(as_col(order).alias("__o"), *ties)
    newest = F.max_by(F.struct(*take), rank).alias("__newest")
    return df.groupBy(*keys).agg(newest, F.sum(measure).alias(total)).select(
        *keys, *[F.col("__newest")[c].alias(c) for c in take], total
    )


def partition_total(df: DataFrame, keys: Sequence[str], measure: ColumnLike, name: str) -> DataFrame:
    """Every row with the sum of ``measure`` over its key; NULL keys form a group.

    A window would pull a whole key into one task. Totals are pre-aggregated in the map
    tasks and joined back, where adaptive execution can split a hot key.
    """
    totals = df.groupBy(*keys).agg(F.sum(as_col(measure)).alias(name))
    totals = totals.select(*[F.col(k).alias(f"__{k}") for k in keys], name)
    cond = [df[k].eqNullSafe(totals[f"__{k}"]) for k in keys]
    return df.join(totals, cond, "left").drop(*[f"__{k}" for k in keys])


def global_row_id(df: DataFrame, order: Sequence[Column], name: str, start: int = 1) -> DataFrame:
    """Consecutive row ids over a total order, without a single-partition window.

    Rows are range-partitioned and sorted, written once with their place in the
    partition, and shifted by the sizes of the partitions before. The written table fixes
    the placement, so both passes see the same partitions whatever is recomputed. Only
    one count per partition reaches the driver.
    """
    spark = df.sparkSession
    # The id holds the partition number above bit 33 and the place within it below.
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("__place", F.monotonically_increasing_id())
    )
    placed = written_table(placed, "row-id")
    part = F.shiftright("__place", 33)
    sizes = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("n")).collect()
    offsets, total = [], start
    for row in sorted(sizes, key=lambda r: r["__part"]):
        offsets.append((row["__part"], total))
        total += row["n"]
    table = F.broadcast(spark.createDataFrame(offsets, "__part bigint, __offset bigint"))
    return (
        placed.withColumn("__part", part)
        .join(table, "__part")
        .withColumn(name, F.col("__offset") + F.col("__place").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("__part", "__offset", "__place")
    )
