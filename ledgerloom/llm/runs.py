"""Runs of periodically repeated words, found by recursive frequency splitting.

A run holds at least four periods, so each of its words occurs at least four times inside
it. A word that occurs less often in a segment is in no run there and splits it; what is
left is counted anew, until nothing more splits. In the surviving segments lags are
scanned from small to large: a run of period q holds four equal words q apart at every
offset, so looking at multiples of q is enough to meet each, and all lags together cost
m log m looks. A hit is extended word by word; one inside a run that is already known,
whose period is smaller, is a repetition of that run and is passed over.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import table

#: Least length of a run in words and in periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
RUN = "struct<start:bigint,length:bigint,period:bigint>"


def words(text: str | None) -> list[bytes]:
    """Words of a text, cut at spaces and the ASCII characters 9 to 13."""
    return (text or "").encode("utf-8").split()


def segments(codes: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of what is left when words too rare in their segment split it."""
    done, open_ = [], [(0, len(codes))]
    while open_:
        start, end = open_.pop()
        if end - start < LEAST_WORDS:
            continue
        _, at, counts = np.unique(codes[start:end], return_inverse=True, return_counts=True)
        cuts = np.flatnonzero(counts[at] < LEAST_PERIODS)
        if not len(cuts):
            done.append((start, end))
            continue
        edges = np.concatenate([[-1], cuts, [end - start]])
        wide = np.flatnonzero(np.diff(edges) > LEAST_WORDS)
        open_ += [(start + int(edges[i]) + 1, start + int(edges[i + 1])) for i in wide]
    return sorted(done)


def _equal_ahead(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common start of two arrays, read in growing blocks."""
    at, size, room = 0, 16, min(len(a), len(b))
    while at < room:
        differs = np.flatnonzero(a[at : min(at + size, room)] != b[at : min(at + size, room)])
        if len(differs):
            return at + int(differs[0])
        at, size = at + size, size * 4
    return room


def lag_scan(codes: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of one segment."""
    size, out = len(codes), []
    covered = np.zeros(size, np.int64)  # furthest end of a known run that holds the position
    for q in range(1, size // LEAST_PERIODS + 1):
        looks = codes[::q]
        same = looks[1:] == looks[:-1]
        span = (LEAST_PERIODS - 1) * q
        hits = np.flatnonzero(same[:-2] & same[1:-1] & same[2:]) * q
        past = 0
        for first in hits[covered[hits] <= hits + span].tolist():
            if first + span < past:
                continue
            after = _equal_ahead(codes[first:], codes[first + q :])
            before = _equal_ahead(codes[:first][::-1], codes[q : first + q][::-1])
            start, length = first - before, before + after + q
            # A hit at the edge of a known run may lead back into it.
            if length >= max(LEAST_WORDS, LEAST_PERIODS * q) and covered[start] < start + length:
                out.append((start, length, q))
                held = covered[start : start + length]
                np.maximum(held, start + length, out=held)
                past = start + length
    return out


def find_runs(found: list[bytes]) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) of a list of words, by start, then period."""
    if len(found) < LEAST_WORDS:
        return []
    numbers: dict[bytes, int] = {}
    codes = np.fromiter((numbers.setdefault(w, len(numbers)) for w in found), np.int64, len(found))
    out = [(start + s, n, q) for start, end in segments(codes) for s, n, q in lag_scan(codes[start:end])]
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(found: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words but for all after the first period of any run, joined by a space."""
    if not runs:
        return b" ".join(found)
    kept = np.ones(len(found), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return b" ".join(found[i] for i in np.flatnonzero(kept))


def periodic_runs(text: Column) -> Column:
    """Struct of a text: n_words, runs (start, length, period of each, by start, then
    period) and collapsed, the text with each run cut to its first period.

    Null and empty texts have no words, no runs and an empty collapsed text. A text is
    judged alone and whole, so repeated rows get equal results.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            sizes, runs, texts = [], [], []
            for value in batch:
                found = words(value.as_py())
                got = find_runs(found)
                sizes.append(len(found))
                runs.append([dict(zip(("start", "length", "period"), r)) for r in got])
                texts.append(collapsed(found, got).decode())
            yield pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), pa.array(runs, kind), pa.array(texts, pa.string())], ["n_words", "runs", "collapsed"])

    return F.arrow_udf(run, f"n_words bigint, runs array<{RUN}>, collapsed string")(text)


def repeated_tail(found: list[bytes], h: int) -> list[bytes]:
    """The words of a tenth of all documents, with a tail repeated (the query's contract)."""
    n, g = len(found), h // 10
    if h % 10 or not n:
        return found
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    part = found[a : a + p]
    return found[:a] + (part * (-(-(n - a) // p)))[: n - a]


def with_repeats(text: Column, key: Column) -> Column:
    """Texts of which those chosen by the CRC-32 of ``key`` repeat a part; a null key changes nothing."""

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for batch, keys in batches:
            out = []
            for value, key in zip(batch, keys):
                text, key = value.as_py(), key.as_py()
                h = 1 if key is None else zlib.crc32(key.encode())
                out.append(text if text is None or h % 10 else b" ".join(repeated_tail(words(text), h)).decode())
            yield pa.array(out, pa.string())

    return F.arrow_udf(run, "string")(text, key.cast("string"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Repeated rows stay rows of their own, an empty table gives no rows, other columns are
    ignored; a null doc_id leaves the text as it is."""
    docs = table(spark, folder, "documents")
    found = docs.select("doc_id", periodic_runs(with_repeats(F.col("text"), F.col("doc_id"))).alias("r")).select("doc_id", "r.runs", "r.collapsed")
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    top = found.withColumn("top", longest)
    return top.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("top.s")).alias("start"),
        F.col("top.length").alias("length"),
        (-F.col("top.p")).alias("period"),
        F.floor(1000 * F.col("top.length") / -F.col("top.p")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
