"""Benchmark decontamination over a positional inverted index.

Document frequencies of the benchmark's terms come from all documents. Each window (n
consecutive item words) takes its two rarest terms as anchors. Postings (term, document,
position) are stored for anchor terms; the lists of both anchors, shifted by their offsets
in the window, are intersected on (document, window start). A posting carries the words
around it, so what is left is compared word by word without reading a text again; places
where one word of ten differs are near matches. Terms
of no window are dropped while tokenizing by a bitmap of fixed size, whatever the size of
the benchmark; false hits of the bitmap cost rows, never results.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import table, with_nulls, without_nulls
from ledgerloom.session import written_table

BITMAP_BITS = 1 << 20
#: Postings of a term are dealt to this many tasks; the benchmark's rows are repeated for each.
SALTS = 16
#: Bytes of words, A-Z lowered; all others are spaces.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if chr(c).isalnum() and c < 128 or c >= 128 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    """Words of a text with A-Z lowered: runs of ASCII letters, digits and non-ASCII."""
    return (text or "").encode("utf-8").translate(_PLAIN).split()


def _bitmap(terms: DataFrame) -> bytes:
    """Bitmap of hashed terms; at most BITMAP_BITS small rows reach the driver."""
    slots = terms.select(F.xxhash64("term").bitwiseAND(F.lit(BITMAP_BITS - 1)).alias("slot")).distinct().toPandas()
    bits = np.zeros(BITMAP_BITS, bool)
    bits[slots["slot"].to_numpy(np.int64)] = True
    return np.packbits(bits).tobytes()


class _Filter:
    def __init__(self, packed: bytes):
        self.bits = np.unpackbits(np.frombuffer(packed, np.uint8)).tobytes()

    def __call__(self, word: bytes) -> bool:
        return self.bits[xxhash.xxh64_intdigest(word, 42) & (BITMAP_BITS - 1)] == 1


def item_windows(items: DataFrame, n: int) -> DataFrame:
    """(item_id, phrase, terms): each distinct window of each item."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for item, text in zip(b["item_id"], b["text"]):
                w = words(text)
                spans = {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else ()
                out += [(item, b" ".join(s).decode()) for s in sorted(spans)]
            if out:
                yield pd.DataFrame(out, columns=["item_id", "phrase"])

    picked = items.select(F.col("item_id").cast("string"), "text")
    return picked.mapInPandas(cut, "item_id string, phrase string").withColumn("terms", F.split("phrase", " "))


def _keyed(docs: DataFrame) -> DataFrame:
    return without_nulls(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")), "doc_id")


def term_counts(docs: DataFrame, packed: bytes) -> DataFrame:
    """Occurrences in all documents of the terms that pass the bitmap."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keep = _Filter(packed)
        for b in batches:
            seen: Counter = Counter()
            for t in b["text"]:
                seen.update(words(t))
            rows = [(w.decode(), c) for w, c in seen.items() if keep(w)]
            if rows:
                yield pd.DataFrame(rows, columns=["term", "c"])

    return docs.select("text").mapInPandas(run, "term string, c long").groupBy("term").agg(F.sum("c").alias("c"))


def postings(docs: DataFrame, packed: bytes, n: int) -> DataFrame:
    """One row (n_words, term null) per document and one per kept term occurrence.

    ``around`` holds up to n - 1 words before the position, the word and up to n - 1 after;
    ``at`` is the index of the word in it. Rows leave in slices, so a long document never
    makes a large batch.
    """
    columns = ["doc_id", "__no_key", "text_hash", "n_words", "term", "pos", "at", "around"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keep = _Filter(packed)
        for b in batches:
            out = []
            for doc, none, key, text in zip(b["doc_id"], b["__no_key"], b["text_hash"], b["text"]):
                w = words(text)
                out.append((doc, none, key, len(w), None, None, None, None))
                wanted = {x for x in set(w) if keep(x)}
                for i, x in enumerate(w):
                    if x in wanted:
                        low = max(0, i - n + 1)
                        out.append((doc, none, key, None, x.decode(), i, i - low, b" ".join(w[low : i + n]).decode()))
                        if len(out) >= 20000:
                            yield _frame(out, columns)
                            out = []
            if out:
                yield _frame(out, columns)

    schema = "doc_id long, __no_key boolean, text_hash long, n_words long, term string, pos long, at int, around string"
    return with_nulls(_keyed(docs).mapInPandas(run, schema), "doc_id")


def _frame(rows: list, columns: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=columns)
    return frame.astype({"n_words": "Int64", "pos": "Int64", "at": "Int32"})


def anchors(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """(phrase, n, t1, o1, t2, o2, whole) of each window with a term that occurs: its two
    rarest such terms with their first offsets (the second is the first again where there is no
    other), and whether all its terms occur."""
    phrases = windows.select("phrase", "terms").distinct()
    spread = phrases.select("phrase", F.size("terms").alias("n"), F.posexplode("terms").alias("o", "term"))
    first = spread.groupBy("phrase", "n", "term").agg(F.min("o").alias("o"))
    known = first.join(counts, "term", "left")
    ranked = known.groupBy("phrase", "n").agg(
        F.sort_array(F.collect_list(F.when(F.col("c") > 0, F.struct("c", "term", "o")))).alias("r"), F.count_if(F.col("c").isNull()).alias("absent")
    )
    second = F.when(F.size("r") > 1, F.get("r", F.lit(1))).otherwise(F.get("r", F.lit(0)))
    return ranked.where(F.size("r") > 0).select(
        "phrase", "n", F.col("r")[0]["term"].alias("t1"), F.col("r")[0]["o"].alias("o1"), second["term"].alias("t2"), second["o"].alias("o2"), (F.col("absent") == 0).alias("whole")
    )


def looked_up(posted: DataFrame, anchored: DataFrame, term: str, offset: str, full: int) -> DataFrame:
    """(doc_id, text_hash, phrase, n, start, t2, o2, same) of places where an anchor of a window
    stands and at most one of its words differs, if it has ``full`` words, or none.

    The window is compared with the words around the anchor, position by position. One
    changed word leaves one half of the window whole, so that is looked for first.
    """
    hits, terms, half = _dealt(posted), F.split("phrase", " "), F.floor(F.col("n") / 2).cast("int")
    halves = {"front": F.array_join(F.slice(terms, F.lit(1), half), " "), "back": F.array_join(F.slice(terms, half + 1, F.col("n")), " ")}
    spread = anchored.withColumns(halves).withColumn("salt_", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = hits.join(spread, (hits.term == spread[term]) & (hits.salt == spread.salt_)).where(f"at >= {offset}")
    met = met.where(F.contains("around", "front") | F.contains("around", "back"))
    there = F.slice(F.split("around", " "), F.greatest(F.col("at") - F.col(offset) + 1, F.lit(1)), F.col("n"))
    same = F.size(F.filter(F.zip_with(there, F.split("phrase", " "), lambda x, y: x == y), lambda e: e))
    found = met.withColumn("same", same).where((F.col("same") == F.col("n")) | ((F.col("n") == full) & (F.col("same") == full - 1) & (F.size(there) == full)))
    return found.select("doc_id", "text_hash", "phrase", "n", (F.col("pos") - F.col(offset)).alias("start"), "t2", "o2", "same")


def _dealt(posted: DataFrame) -> DataFrame:
    """Postings of terms, those of a term dealt to SALTS tasks."""
    return posted.where(F.col("term").isNotNull()).withColumn("salt", F.pmod(F.xxhash64("doc_id", "text_hash", "pos"), F.lit(SALTS)).cast("int"))


def phrase_matches(posted: DataFrame, anchored: DataFrame, looked: DataFrame) -> DataFrame:
    """(doc_id, text_hash, phrase, start, n): exact occurrences, from intersected lists.

    Both shifted lists are keyed by the phrase, the document and the start.
    """
    hits = _dealt(posted)
    one = looked.where("same = n")
    seconds = anchored.select("t2").distinct().withColumn("salt2", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    lists = hits.join(seconds, (hits.term == F.col("t2")) & (hits.salt == F.col("salt2")), "left_semi")
    two = lists.select(F.col("doc_id").alias("d2"), F.col("text_hash").alias("h2"), F.col("term").alias("term2"), F.col("pos").alias("p2")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("text_hash") == F.col("h2")) & (F.col("t2") == F.col("term2"))
    both = one.join(two, same & (F.col("start") + F.col("o2") == F.col("p2")), "left_semi")
    return both.select("doc_id", "text_hash", "phrase", "start", "n").distinct()


def near_matches(posted: DataFrame, anchored: DataFrame, looked: DataFrame, full: int) -> DataFrame:
    """(doc_id, text_hash, phrase, start) where a window of ``full`` words stands with just one
    word changed. A change leaves one of two different anchors in place, so either list is
    enough; of windows of one repeated term only changes elsewhere than its first place show.
    """
    other = looked_up(posted, anchored.where((F.col("t1") != F.col("t2")) & (F.col("n") == full)), "t2", "o2", full)
    return looked.unionByName(other).where(f"n = {full} and same = {full - 1}").select("doc_id", "text_hash", "phrase", "start").distinct()


def contamination(docs: DataFrame, items: DataFrame, n: int = 10) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and
    n_near, the number of different windows of n words found with just one word changed.

    Null and empty texts have no words and no hits; an item shorter than n words is one
    window, an item without words none. Repeated rows give equal rows. Rows that share a
    doc_id but not the text are kept apart. An empty benchmark gives zero hits.
    """
    windows = written_table(item_windows(items, n), "windows")
    vocabulary = windows.select(F.explode("terms").alias("term")).distinct()
    counts = term_counts(docs, _bitmap(vocabulary))
    anchored = written_table(anchors(windows, counts), "anchors")
    used = anchored.select(F.col("t1").alias("term")).unionByName(anchored.select(F.col("t2").alias("term"))).distinct()
    posted = written_table(postings(docs, _bitmap(used), n), "postings")
    looked = written_table(looked_up(posted, anchored, "t1", "o1", n), "looked")
    found = written_table(phrase_matches(posted, anchored.where("whole"), looked), "matches")
    near = written_table(near_matches(posted, anchored, looked, n).select("doc_id", "text_hash", "phrase").distinct(), "near")
    near = near.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n_near")).select(
        F.col("doc_id").alias("near_doc"), F.col("text_hash").alias("near_hash"), "n_near"
    )
    key = ["doc_id", "text_hash"]
    ends = found.groupBy(*key, "start").agg(F.max(F.expr("start + n")).alias("end"))
    before = Window.partitionBy(*key).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fresh = ends.withColumn("seen", F.coalesce(F.max("end").over(before), F.lit(0)))
    covered = fresh.groupBy(*key).agg(F.sum(F.expr("greatest(end - greatest(start, seen), 0)")).alias("n_hit"))
    hit_items = found.select(*key, "phrase").distinct().join(windows.select("phrase", "item_id"), "phrase").select(*key, "item_id").distinct()
    listed = hit_items.groupBy(*key).agg(F.count("*").alias("n_items"), F.array_join(F.sort_array(F.collect_list("item_id")), ",").alias("items"))
    sums = covered.join(listed.withColumnRenamed("doc_id", "d").withColumnRenamed("text_hash", "h"), F.expr("doc_id <=> d and text_hash = h"), "left")
    sums = sums.select(F.col("doc_id").alias("hit_doc"), F.col("text_hash").alias("hit_hash"), "n_hit", "n_items", "items")
    base = posted.where(F.col("term").isNull()).select("doc_id", "text_hash", "n_words")
    out = base.join(sums, F.expr("doc_id <=> hit_doc and text_hash = hit_hash"), "left")
    out = out.join(near, F.expr("doc_id <=> near_doc and text_hash = near_hash"), "left")
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        "text_hash",
    )


def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("text_hash")
