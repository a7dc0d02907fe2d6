"""SimHash near-duplicates: grid join of per-segment bit counts, then exact bit distance.

A 64-bit fingerprint is embedded as 16 counts, the set bits of each 4-bit segment. The
Manhattan distance of two embeddings never exceeds the bit distance, so fingerprints
within two bits have embeddings within two, and some grid cell within one of both. Each
fingerprint visits its cell and the cells one step away (at most 33); only cells that hold
two different fingerprints go on. There the link is verified exactly: within a cell every
64-bit centre at bit distance of at most one is named, and fingerprints that share a
centre differ in at most two bits (and every such pair shares one). A centre has at most
65 members, so no group grows with the data and no pairs are listed.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import table
from ledgerloom.llm.components import roots
from ledgerloom.session import written_table

SEGMENTS = 16
_CHUNK = 1 << 16


def fingerprint(text: str | None, words_per_shingle: int = 3) -> int:
    """Unsigned fingerprint of a text; 0 for null or no words, one shingle for few words."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    if len(words) < words_per_shingle:
        shingles = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(words_per_shingle))))
    ones, total = np.zeros(64, np.int64), 0
    digest = xxhash.xxh64_intdigest
    while chunk := list(itertools.islice(shingles, _CHUNK)):
        hashes = np.fromiter((digest(s, 42) for s in chunk), np.dtype("<u8"), len(chunk))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        total += len(chunk)
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<u8")[0])


def segment_counts(values: np.ndarray) -> np.ndarray:
    """Set bits of each 4-bit segment, as 16 four-bit fields of one word."""
    v = values.astype(np.uint64)
    masks = (0x7777777777777777, 0x3333333333333333, 0x1111111111111111)
    out = v.copy()
    for shift, mask in enumerate(masks, start=1):
        out -= (v >> np.uint64(shift)) & np.uint64(mask)
    return out


def fingerprints(docs: DataFrame, words_per_shingle: int = 3) -> DataFrame:
    """(doc_id, fp) per row of ``docs``; fp is the fingerprint's bits as a signed long."""
    return docs.select(F.col("doc_id").cast("long"), bits(F.col("text"), words_per_shingle).alias("fp"))


def bits(text: Column, words_per_shingle: int = 3) -> Column:
    """Fingerprint of a text column, its bits as a signed long."""

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            values = np.array([fingerprint(t, words_per_shingle) for t in batch], np.uint64)
            yield pd.Series(values.view(np.int64))

    return F.pandas_udf(run, "long")(text)


def _visited_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for start in range(0, len(b), 4096):
            fp = b["fp"].to_numpy(np.int64)[start : start + 4096]
            own = segment_counts(fp.view(np.uint64))
            fps, cells = [fp], [own]
            for s in range(SEGMENTS):
                step = np.uint64(1 << (4 * s))
                count = (own >> np.uint64(4 * s)) & np.uint64(15)
                for keep, moved in ((count < 4, own + step), (count > 0, own - step)):
                    fps.append(fp[keep])
                    cells.append(moved[keep])
            yield pd.DataFrame({"fp": np.concatenate(fps), "cell": np.concatenate(cells).view(np.int64)})


def _centres(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        fp = b["fp"].to_numpy(np.int64).view(np.uint64)
        cell = b["cell"].to_numpy(np.int64).view(np.uint64)
        delta = cell - segment_counts(fp)
        fps, centres = [fp[delta == 0]], [fp[delta == 0]]
        for s in range(SEGMENTS):
            step = np.uint64(1 << (4 * s))
            near = (delta == step) | (delta == np.uint64(0) - step)
            for k in range(4):
                centre = fp[near] ^ np.uint64(1 << (4 * s + k))
                hit = segment_counts(centre) == cell[near]
                fps.append(fp[near][hit])
                centres.append(centre[hit])
        yield pd.DataFrame({"fp": np.concatenate(fps).view(np.int64), "centre": np.concatenate(centres).view(np.int64)})


def links(distinct_fps: DataFrame) -> DataFrame:
    """Edges (a, b) whose closure joins all fingerprints (column fp) at two or fewer bits."""
    visits = written_table(distinct_fps.mapInPandas(_visited_cells, "fp long, cell long"), "cells")
    crowded = visits.groupBy("cell").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where("low <> high").select("cell")
    members = visits.join(crowded, "cell", "left_semi").select("fp", "cell").mapInPandas(_centres, "fp long, centre long")
    stars = members.groupBy("centre").agg(F.sort_array(F.collect_set("fp")).alias("fps")).where(F.size("fps") > 1)
    edges = stars.select(F.col("fps")[0].alias("a"), F.explode(F.slice("fps", 2, 64)).alias("b"))
    return edges.distinct()


def rooted(nodes: DataFrame) -> DataFrame:
    """``nodes`` (distinct fp and more) with the root of each fingerprint's component."""
    found = roots(links(nodes.select("fp"))).withColumnRenamed("node", "fp")
    return nodes.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def one_per_component(docs: DataFrame, words_per_shingle: int = 3) -> DataFrame:
    """The row of each component with the smallest doc_id, null ids last, then text hash.

    Rows with one doc_id and different texts are judged apart, each in the component of its
    own text; a component all of whose ids are null keeps one row. Equal rows count once. All
    columns are kept as they are; an empty table gives no rows.
    """
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    key = {
        "__no_id": F.col("doc_id").isNull(),
        "__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")),
        "__text_hash": F.xxhash64("text"),
        "__rest_hash": F.xxhash64(*rest) if rest else F.lit(0).cast("long"),
    }
    fps = docs.select(*[c.alias(k) for k, c in key.items()], bits(F.col("text"), words_per_shingle).alias("fp"))
    nodes = written_table(fps.groupBy("fp").agg(F.min(F.struct(*key)).alias("first")), "nodes")
    chosen = rooted(nodes).groupBy("root").agg(F.min("first").alias("first")).select("first.*")
    marked = docs.withColumns(key)
    return marked.join(chosen, list(key), "left_semi").dropDuplicates(list(key)).select(*docs.columns)


def near_duplicates(docs: DataFrame, words_per_shingle: int = 3) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id reachable over links of at most two bits. Null and
    empty texts have fingerprint zero and link like others; repeated rows give repeated
    rows; a null doc_id takes part but never names a component unless no other does (then
    null). An empty table gives no rows; other columns are ignored.
    """
    fps = written_table(fingerprints(docs, words_per_shingle), "fingerprints")
    nodes = written_table(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "nodes")
    grouped = rooted(nodes)
    smallest = grouped.groupBy("root").agg(F.min("low").alias("component_id"))
    named = grouped.join(smallest, "root").select("fp", "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return fps.join(named, "fp", "left").select("doc_id", hexed.alias("fingerprint"), "component_id")


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))
