"""Reading the shared tables."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def without_nulls(df: DataFrame, key: str) -> DataFrame:
    """``df`` with ``key`` as a long that is never null and ``__no_key``, whether it was. pandas
    turns whole numbers beside nulls into floats, which changes those above 2^53."""
    return df.withColumns({key: F.coalesce(F.col(key).cast("long"), F.lit(0).cast("long")), "__no_key": F.col(key).isNull()})


def with_nulls(df: DataFrame, key: str) -> DataFrame:
    """Undo ``without_nulls``."""
    return df.withColumn(key, F.when(~F.col("__no_key"), F.col(key))).drop("__no_key")


def slices(texts: pa.StringArray, most: int = 1 << 20) -> Iterator[pa.StringArray]:
    """Parts of a batch of about ``most`` bytes, so that results are handed on early; a longer
    text is a part of its own."""
    start = size = 0
    for i, text in enumerate(texts):
        size += text.as_buffer().size if text.is_valid else 0
        if size >= most:
            yield texts.slice(start, i + 1 - start)
            start, size = i + 1, 0
    if start < len(texts):
        yield texts.slice(start)


def is_latin(text: str) -> bool:
    """Whether all characters are among the first 256."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def latin_pattern(pattern: str) -> re.Pattern | None:
    """``pattern`` for texts of the first 256 characters, its Unicode classes spelled out, which
    matches the same twice as fast; None if it has other classes."""
    chars = [chr(c) for c in range(256)]
    listed = {kind: "".join(f"\\x{ord(c):02x}" for c in chars if regex.match(kind, c)) for kind in (r"\p{L}", r"\p{N}", r"\s")}
    out, spaces = pattern, listed[r"\s"]
    out = re.sub(r"\[\^((?:\\s|\\p\{[LN]\})+)\]", lambda m: "[^" + "".join(listed[k] for k in re.findall(r"\\s|\\p\{[LN]\}", m[1])) + "]", out)
    for kind, chars_ in listed.items():
        out = out.replace(kind, f"[{chars_}]")
    out = out.replace(r"\S", f"[^{spaces}]")
    return None if re.search(r"\\[A-Za-wyz]", out) else re.compile(out)
