"""JSON documents with item arrays and JSON held in text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgerloom.functions.scalars import ColumnLike, as_col

ITEM_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("id", "name", "parentId", "active", "code")]
)


def _document(item: T.StructType, array: str) -> T.StructType:
    return T.StructType([T.StructField(array, T.ArrayType(item))])


def read_items(spark: SparkSession, path: str, item: T.StructType = ITEM_SCHEMA, array: str = "items") -> DataFrame:
    """Rows of the item arrays of whole-file JSON documents, parsed by the executors."""
    docs = spark.read.schema(_document(item, array)).option("multiLine", True).json(path)
    return docs.select(F.explode(array).alias("item")).select("item.*")


def explode_items(
    df: DataFrame, json_col: str, keep: list[str], item: T.StructType = ITEM_SCHEMA, array: str = "items"
) -> DataFrame:
    """Rows of the item array of a JSON text column, with columns ``keep`` repeated."""
    parsed = F.from_json(json_col, _document(item, array))[array]
    return df.select(*keep, F.explode(parsed).alias("item")).select(*keep, "item.*")


def active_items(items: DataFrame) -> DataFrame:
    return items.where(F.col("active") == "true")


def json_field(c: ColumnLike, *path: str) -> Column:
    """Field of a JSON text as text; each step may itself be JSON held in a string."""
    out = as_col(c)
    for step in path:
        out = F.get_json_object(out, "$." + step)
    return out
