"""Keyword tagging, masking and column protection."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.codes import PROVINCES
from ledgerloom.functions.scalars import ColumnLike, as_col

# The digit mask and its replacement.
MASK_PATTERN = r"\d{4}(?=\d{4})"
MASK_TEXT = "1254"


def _first_label(text: Column, words: Sequence[tuple[str, str]]) -> Column:
    """Label of the first listed keyword contained in ``text``, NULL if none is.

    The first hit ends the search. For long lists see ``tag_by_keywords``.
    """
    return F.coalesce(*[F.when(F.contains(text, F.lit(k)), F.lit(v)) for k, v in words])


def keyword_region(c: ColumnLike, levels: Sequence[Sequence[tuple[str, str]]]) -> Column:
    """Tag free text by keyword lists of falling priority.

    ``levels`` holds one ordered list of (keyword, label) per level. List order decides,
    not the position in the text; a later level is asked only when an earlier one finds
    nothing. No hit gives ``''``; NULL text gives NULL.
    """
    text = as_col(c)
    found = [_first_label(text, words) for words in levels if words]
    return F.when(text.isNotNull(), F.coalesce(*found, F.lit("")))


def address_region(c: ColumnLike, cities: Sequence[tuple[str, str]]) -> Column:
    """Province of an address: a province name first, else the province of a city name."""
    return keyword_region(c, [[(p, p) for p in PROVINCES], cities])


#: Places of the table of marks that tells parts of texts from keywords before the shuffle.
MARKS = 1 << 16


def _place(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(MARKS))


def keyword_parts(df: DataFrame, col: str, words: DataFrame) -> DataFrame:
    """(__a, __b, __part): parts of the texts that may be a keyword of ``words``.

    A text is known by two 64-bit hashes of it. Parts have the length of some keyword and a
    hash that some keyword has: a one-row table of marks, of a fixed size, is looked at in
    the scan, so nearly all other parts never leave it. False marks cost rows only.
    """
    sizes = words.agg(F.sort_array(F.collect_set(F.length("keyword")))).scalar()
    places = words.select(_place(F.col("keyword")).alias("id")).distinct().withColumn("__hit", F.lit("1"))
    marked = df.sparkSession.range(MARKS).join(places, "id", "left").select("id", F.coalesce("__hit", F.lit("0")).alias("hit"))
    marks = marked.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "hit"))), lambda m: m["hit"]), "").cast("binary")).scalar()
    text, room = F.col("__text"), F.length("__text")

    def cut(n: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(1), room + 1), lambda i: i + n <= room + 1)
        return F.transform(starts, lambda i: F.substring(text, i, n))

    sized = df.select(F.col(col).alias("__text")).where("__text is not null").withColumn("__sizes", sizes)
    parts = F.explode(F.array_distinct(F.flatten(F.transform("__sizes", cut))))
    cut_up = sized.select(*text_key(text), parts.alias("__part"))
    place = (_place(F.col("__part")) + 1).cast("int")
    return cut_up.where(F.substring(marks, place, F.lit(1)) == F.lit("1").cast("binary"))


def text_key(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text).alias("__a"), F.xxhash64(F.lit(1), text).alias("__b")


def tag_by_keywords(df: DataFrame, col: str, dim: DataFrame, out: str) -> DataFrame:
    """``df`` with ``out``: ``keyword_region`` for a keyword table (level, ord, keyword, label).

    The table may have any size and never leaves the executors. ``keyword_parts`` of the
    texts meet the keywords in an equi join; the lowest (level, ord) wins. Texts are not
    shuffled, only hashes of those that may hold a keyword. No hit gives ``''``; NULL text
    gives NULL. Keywords without a text or label are ignored.
    """
    words = dim.where("keyword is not null and label is not null")
    hits = keyword_parts(df, col, words).join(words, F.col("__part") == F.col("keyword"))
    best = hits.groupBy("__a", "__b").agg(F.min_by("label", F.struct("level", "ord", "keyword", "label")).alias("__label"))
    best = best.withColumnsRenamed({"__a": "__found_a", "__b": "__found_b"})
    a, b = text_key(df[col])
    tagged = df.join(best, (a == F.col("__found_a")) & (b == F.col("__found_b")), "left")
    label = F.when(df[col].isNotNull(), F.coalesce("__label", F.lit("")))
    return tagged.select(*[df[c] for c in df.columns], label.alias(out))


def tag_addresses(df: DataFrame, col: str, cities: DataFrame, out: str) -> DataFrame:
    """``address_region`` for a table of cities (ord, city, province) of any size."""
    names = [(0, i, p, p) for i, p in enumerate(PROVINCES)]
    provinces = df.sparkSession.createDataFrame(names, "level int, ord int, keyword string, label string")
    second = cities.select(F.lit(1).alias("level"), F.col("ord").cast("int"), F.col("city").alias("keyword"), F.col("province").alias("label"))
    return tag_by_keywords(df, col, provinces.unionByName(second), out)


def mask_digits(c: ColumnLike) -> Column:
    """Overwrite every group of four digits that four more digits follow."""
    return F.regexp_replace(as_col(c), MASK_PATTERN, MASK_TEXT)


def protect(c: ColumnLike, key: ColumnLike, mode: str = "ECB") -> Column:
    """Encrypt to base64 text. ECB keeps equal values equal (join keys); GCM hides that."""
    padding = "PKCS" if mode.upper() == "ECB" else "DEFAULT"
    secret = F.lit(key) if isinstance(key, str) else key
    return F.base64(F.aes_encrypt(as_col(c).cast("binary"), secret, F.lit(mode), F.lit(padding)))


def unprotect(c: ColumnLike, key: ColumnLike, mode: str = "ECB") -> Column:
    padding = "PKCS" if mode.upper() == "ECB" else "DEFAULT"
    secret = F.lit(key) if isinstance(key, str) else key
    return F.aes_decrypt(F.unbase64(as_col(c)), secret, F.lit(mode), F.lit(padding)).cast("string")


def protect_columns(df: DataFrame, cols: Iterable[str], key, mode: str = "ECB") -> DataFrame:
    return df.withColumns({c: protect(F.col(c).cast("string"), key, mode) for c in cols})


def unprotect_columns(df: DataFrame, cols: Iterable[str], key, mode: str = "ECB") -> DataFrame:
    return df.withColumns({c: unprotect(F.col(c), key, mode) for c in cols})
