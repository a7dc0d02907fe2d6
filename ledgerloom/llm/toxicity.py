"""Toxicity by a small convolutional text classifier, trained in numpy.

Words are hashed to embedding rows; filters of several widths slide over the whole text
and are max-pooled; a logistic layer scores them. The classifier is fitted on a bounded
sample; thresholds are calibrated by predicted language on all labelled rows it was not
fitted on, and folded into the score, so 0.5 is the threshold everywhere.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import language
from ledgerloom.llm.common import table
from ledgerloom.session import written_table

BUCKETS = 1 << 17
#: Words of fewer sampled texts share the padding row, so that none is learned by heart.
LEAST_TEXTS = 4
WIDTHS = (1, 2, 3)
DIM, FILTERS, EPOCHS = 16, 16, 8
#: Letters of the word start that has an embedding of its own.
PREFIX = 5
#: Labelled rows the classifier is fitted on, at most; the smallest hashes are taken.
SAMPLE_ROWS = 6000
#: Cells of the histograms that set thresholds, per unit of logit, and the largest logit.
CELLS, LARGEST = 64, 64
#: Toxic rows that the histogram of all languages counts for in that of one.
PRIOR = 20
_BLOCK = 1 << 14
_REMEMBERED = 1 << 18
_WORD = re.compile(r"[^\W_]+")


def _bucket(part: str) -> int:
    return zlib.crc32(part.encode("utf-8", "replace")) % (BUCKETS - 1) + 1


class _Words(dict):
    """Both buckets of a word in one number, remembered for up to ``_REMEMBERED`` words."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _REMEMBERED:
            self.clear()
        start = _bucket("^" + word[:PREFIX]) if len(word) > PREFIX else 0
        self[word] = out = _bucket(word) << 32 | start
        return out


_words = _Words()


def hashed(text: str | None) -> np.ndarray:
    """Buckets of each word (lower case) and of its first letters, one row per word, padded
    to the widest filter; 0 is padding."""
    found = _WORD.findall((text or "").lower())
    packed = np.zeros(max(len(found), max(WIDTHS)), np.int64)
    packed[: len(found)] = np.fromiter(map(_words.__getitem__, found), np.int64, len(found))
    return np.stack([packed >> 32, packed & 0xFFFFFFFF], axis=1).astype(np.int32)


class Model:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.row = np.arange(BUCKETS, dtype=np.int32)
        self.emb = rng.normal(0, 0.3, (BUCKETS, DIM))
        self.emb[0] = 0
        self.filters = [rng.normal(0, 1 / np.sqrt(w * DIM), (w * DIM, FILTERS)) for w in WIDTHS]
        self.bias = [np.zeros(FILTERS) for _ in WIDTHS]
        self.out, self.shift = rng.normal(0, 0.3, len(WIDTHS) * FILTERS), 0.0

    def pooled(self, ids: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Maxima of all filters over the whole text, and where they stand; long texts go in
        overlapping blocks."""
        tops = [np.full(FILTERS, -np.inf) for _ in WIDTHS]
        places = [np.zeros(FILTERS, np.int64) for _ in WIDTHS]
        for at in range(0, len(ids), _BLOCK):
            part = ids[at : at + _BLOCK + max(WIDTHS) - 1]
            x = self.emb[part[:, 0]] + self.emb[part[:, 1]]
            for j, (w, f, b) in enumerate(zip(WIDTHS, self.filters, self.bias)):
                n = min(_BLOCK, len(x) - w + 1)
                if n < 1:
                    continue
                z = sum(x[i : i + n] @ f[i * DIM : (i + 1) * DIM] for i in range(w)) + b
                arg = z.argmax(0)
                best = z[arg, np.arange(FILTERS)]
                places[j] = np.where(best > tops[j], arg + at, places[j])
                tops[j] = np.maximum(best, tops[j])
        return np.concatenate(tops), places

    def logit(self, ids: np.ndarray) -> float:
        return float(np.maximum(self.pooled(self.row[ids])[0], 0) @ self.out + self.shift)

    def fit(self, texts: list[np.ndarray], labels: np.ndarray, rate: float = 0.05, seed: int = 7) -> None:
        """Adagrad, one text at a time, classes weighted alike."""
        rng = np.random.default_rng(seed)
        seen = np.zeros(BUCKETS, np.int64)
        for ids in texts:
            seen[np.unique(ids)] += 1
        self.row = np.where(seen >= LEAST_TEXTS, np.arange(BUCKETS), 0).astype(np.int32)
        blank = max(1, len(texts) // 50)  # texts without a known word are clean
        texts = [self.row[ids] for ids in texts] + [hashed("")] * blank
        labels = np.concatenate([labels, np.zeros(blank, np.int64)])
        positive = max(1, int(labels.sum()))
        weight = {1: len(labels) / (2 * positive), 0: len(labels) / (2 * max(1, len(labels) - positive))}
        g_emb = np.full(BUCKETS, 1e-2)
        g_f, g_b = [np.full_like(f, 1e-2) for f in self.filters], [np.full_like(b, 1e-2) for b in self.bias]
        g_out, g_shift = np.full_like(self.out, 1e-2), 1e-2
        for _ in range(EPOCHS):
            for i in rng.permutation(len(texts)):
                ids, y = texts[i], int(labels[i])
                top, places = self.pooled(ids)
                h = np.maximum(top, 0)
                error = (1 / (1 + np.exp(-np.clip(h @ self.out + self.shift, -30, 30))) - y) * weight[y]
                if abs(error) < 1e-3:
                    continue
                back = error * self.out * (top > 0)
                for j, w in enumerate(WIDTHS):
                    g = back[j * FILTERS : (j + 1) * FILTERS]
                    rows = ids[places[j][:, None] + np.arange(w)]
                    x = self.emb[rows].sum(2).reshape(FILTERS, w * DIM)
                    d_f, d_x = x.T * g, np.repeat((self.filters[j].T * g[:, None]).reshape(-1, DIM), 2, axis=0)
                    g_f[j] += d_f**2
                    g_b[j] += g**2
                    self.filters[j] -= rate * d_f / np.sqrt(g_f[j])
                    self.bias[j] -= rate * g / np.sqrt(g_b[j])
                    flat = rows.reshape(-1)
                    np.add.at(g_emb, flat, (d_x**2).mean(1))
                    np.add.at(self.emb, flat, -rate * d_x / np.sqrt(g_emb[flat])[:, None])
                    self.emb[0] = 0
                d_out = error * h
                g_out += d_out**2
                g_shift += error**2
                self.out -= rate * d_out / np.sqrt(g_out)
                self.shift -= rate * error / np.sqrt(g_shift)
        self.emb = self.emb.astype(np.float32)
        self.filters = [f.astype(np.float32) for f in self.filters]


def threshold(cells: np.ndarray, rows: np.ndarray, toxic: np.ndarray, fallback: float) -> float:
    """Logit between two histogram cells with the best F1; ``fallback`` when a class is missing."""
    if not toxic.sum() or toxic.sum() == rows.sum():
        return fallback
    order = np.argsort(-cells)
    hit = np.cumsum(toxic[order])
    at = int(np.argmax(2 * hit / (np.cumsum(rows[order]) + toxic.sum())))
    low = cells[order[at + 1]] + 1 if at + 1 < len(order) else cells[order[at]] - CELLS
    return float(cells[order[at]] + low) / (2 * CELLS)


def thresholds(checked: DataFrame) -> dict[str, float]:
    """Thresholds by language, "" for the rest, from (logit, lang, toxic, n) of all ``checked``.

    A language's histogram is joined by that of all languages, scaled to ``PRIOR`` toxic
    rows, so a language with few labels stays near the common threshold and one with many
    has its own. At most two cells per histogram step and language reach the driver.
    """
    cell = F.floor(F.least(F.greatest(F.col("logit"), F.lit(-LARGEST)), F.lit(LARGEST)) * CELLS)
    counted = checked.groupBy("lang", cell.alias("cell")).agg(F.sum("n").alias("rows"), F.sum(F.col("toxic") * F.col("n")).alias("toxic"))
    got = counted.toPandas().astype({"cell": np.int64, "rows": np.float64, "toxic": np.float64})

    def cut(part: pd.DataFrame, fallback: float) -> float:
        return threshold(part["cell"].to_numpy(), part["rows"].to_numpy(), part["toxic"].to_numpy(), fallback)

    pooled = got.groupby("cell")[["rows", "toxic"]].sum()
    cuts = {"": cut(pooled.reset_index(), 0.0)}
    prior = pooled * (PRIOR / max(1.0, pooled["toxic"].sum()))
    for name, part in got.groupby("lang"):
        cuts[name] = cut(part.set_index("cell")[["rows", "toxic"]].add(prior, fill_value=0.0).reset_index(), cuts[""])
    return cuts


def _key() -> Column:
    return F.xxhash64("doc_id", "text")


def marked(keyed: DataFrame) -> DataFrame:
    """(key, toxic, n): copies of labelled rows counted, from (key, toxic)."""
    return keyed.where("toxic is not null").groupBy("key", F.col("toxic").cast("long").alias("toxic")).agg(F.count("*").alias("n"))


def train(texts: DataFrame, marks: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[Model, Column]:
    """Model, and whether a row's key is fitted on, from (doc_id, text) and ``marked`` rows.

    The sample is the ``sample_rows`` smallest keys; four fifths of it are fitted on, each
    different row once. Only texts of the sample leave the scan.
    """
    keys = marks.select("key").distinct().orderBy("key").limit(sample_rows)
    sample = marks.join(F.broadcast(keys), "key").select("key", "toxic").toPandas()  # keys are bounded
    same = texts.withColumn("key", _key()).join(F.broadcast(keys), "key").groupBy("key").agg(F.first("text").alias("text"))

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"key": b["key"], "ids": [hashed(t).tobytes() for t in b["text"]]})

    got = same.mapInPandas(encode, "key long, ids binary").toPandas().merge(sample, on="key").sort_values(["key", "toxic"], kind="stable")
    mine = got[got["key"] % 5 != 0]
    model = Model()
    model.fit([np.frombuffer(b, np.int32).reshape(-1, 2) for b in mine["ids"]], mine["toxic"].to_numpy(np.int64))
    last = int(got["key"].max()) if len(got) else 0
    return model, (F.col("key") <= last) & (F.pmod("key", F.lit(5)) != 0)


def predicted(text: str | None, langs: list[str], log_p: np.ndarray) -> str:
    """Likeliest single language of a text."""
    found = language.gram_buckets(text)
    return langs[int(np.argmax(log_p[:, found].sum(1)))] if len(found) and langs else language.UNKNOWN


def rate(
    docs: DataFrame, labelled: DataFrame, training: DataFrame, sample_rows: int = SAMPLE_ROWS, marks: DataFrame | None = None
) -> tuple[DataFrame, dict[str, float]]:
    """(doc_id, key, logit, lang) per row of ``docs``, and the thresholds by language.

    ``labelled`` has doc_id, text and toxic, or, where ``marks`` gives the labels by key,
    doc_id and text of the labelled rows and any others. Labelled rows that are among
    ``docs`` are not scored twice. Rows are known by a hash of doc_id and text: no text is
    shuffled but those of the sample, and those that are not among ``docs``.
    """
    langs, log_p = language.train(training)
    marks = written_table(marked(labelled.select(_key().alias("key"), "toxic")) if marks is None else marks, "marks")
    model, fitted = train(labelled.select("doc_id", "text"), marks, sample_rows)
    shared = docs.sparkSession.sparkContext.broadcast((model, langs, log_p))  # fixed sizes

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model, langs, log_p = shared.value
        for batch in texts:
            yield pd.DataFrame({"logit": np.array([model.logit(hashed(t)) for t in batch], float), "lang": [predicted(t, langs, log_p) for t in batch]})

    judge = F.pandas_udf(run, "logit double, lang string")(F.col("text"))

    def rated(rows: DataFrame, label: str) -> DataFrame:
        judged = rows.select("doc_id", _key().alias("key"), judge.alias("r"))
        return written_table(judged.select("doc_id", "key", "r.logit", "r.lang"), label)

    def once(rows: DataFrame, wanted: DataFrame) -> DataFrame:
        return rows.join(wanted, "key", "left_semi").groupBy("key").agg(F.first("logit").alias("logit"), F.first("lang").alias("lang"))

    out = rated(docs, "rated")
    open_marks = marks.where(~fitted)
    wanted = open_marks.select("key").distinct()
    seen = written_table(once(out.select("key", "logit", "lang"), wanted), "seen")
    lost = written_table(wanted.join(seen, "key", "left_anti"), "lost")
    if not lost.isEmpty():
        rest = labelled.select("doc_id", "text").withColumn("key", _key()).join(lost, "key", "left_semi")
        seen = seen.unionByName(once(rated(rest, "rated-labels").select("key", "logit", "lang"), lost))
    return out, thresholds(open_marks.join(seen, "key"))


def score(docs: DataFrame, labelled: DataFrame, training: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    """doc_id, score, predicted per row of ``docs``, from the text alone.

    ``labelled`` and ``marks`` as in ``rate``. Null and empty texts are scored as a text of
    padding. Without labels every score comes from the untrained model; an empty table
    gives no rows. Repeated rows get equal scores; of conflicting labels each counts.
    """
    rated, cuts = rate(docs, labelled, training, marks=marks)
    known = F.create_map(*[F.lit(x) for pair in cuts.items() for x in pair])
    z = F.col("logit") - F.coalesce(F.try_element_at(known, F.col("lang")), F.lit(cuts[""]))
    scored = rated.select("doc_id", (1 / (1 + F.exp(-F.least(F.greatest(z, F.lit(-500.0)), F.lit(500.0))))).alias("score"))
    return scored.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    out = language.held_out(F.col("doc_id"), 5, 0)
    known = docs.where(~out).select("doc_id", "text", "lang")
    marks = marked(known.select("doc_id", _key().alias("key")).join(labels.select("doc_id", "toxic"), "doc_id"))
    scored = score(docs.select("doc_id", "text"), known, known, marks)
    return scored.select("doc_id", out.alias("held_out"), "score", "predicted")
