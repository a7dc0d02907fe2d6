"""Language by mixture inference.

Letter trigrams are hashed to a fixed number of buckets and counted per language over all
training documents. Expectation-maximisation then estimates each text's language
proportions; nested language sets compete by penalised likelihood, and the largest
proportion of the chosen set names the language.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import table

BUCKETS = 1 << 15
ROUNDS = 10
UNKNOWN = "und"
_ADDED = ("lang_pred", "score", "shares")


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def gram_buckets(text: str | None) -> np.ndarray:
    """Bucket of each letter trigram of the text (other characters are one space)."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    letter = _letters()[codes]
    if not letter.any():
        return np.zeros(0, np.int64)
    codes = np.where(letter, codes, 32)
    keep = letter | np.concatenate([[True], letter[:-1]])
    codes = np.concatenate([[32], codes[keep], [32]])
    if len(codes) < 3:
        codes = np.concatenate([codes, [32]])
    mixed = (codes[:-2] * 1000003 + codes[1:-1]) * 1000003 + codes[2:]
    mixed ^= mixed >> 21
    return (mixed * 0x9E3779B1 >> 13) & (BUCKETS - 1)


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of the text's letter trigrams and their counts."""
    return np.unique(gram_buckets(text), return_counts=True)


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and their log gram probabilities, from all rows with a language.

    What reaches the driver is one count per language and bucket.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for text, lang in zip(b["text"], b["lang"]):
                found, counts = grams(text)
                sums.setdefault(lang, np.zeros(BUCKETS, np.int64))[found] += counts
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield pd.DataFrame({"lang": lang, "bucket": at, "n": total[at]})

    labelled = docs.where(F.col("lang").isNotNull()).select("text", "lang")
    sums = labelled.mapInPandas(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(sums["lang"].unique())
    table_ = np.full((len(langs), BUCKETS), 0.5)
    rows = np.searchsorted(langs, sums["lang"]) if langs else []
    table_[rows, sums["bucket"].to_numpy(np.int64)] += sums["n"].to_numpy(np.float64)
    return langs, np.log(table_ / table_.sum(1, keepdims=True)) if langs else table_


def _em(p: np.ndarray, counts: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
    share = np.full(len(p), 1.0 / len(p))
    total = counts.sum()
    for _ in range(rounds if len(p) > 1 else 0):
        mix = share @ p
        share = share * (p @ (counts / mix)) / total
    return share, float(counts @ np.log(np.maximum(share @ p, 1e-300)))


def proportions(log_p: np.ndarray, counts: np.ndarray, penalty: float) -> np.ndarray:
    """Share of each language in a text; languages outside the chosen set have none."""
    p = np.exp(log_p)
    order = np.argsort(-_em(p, counts, ROUNDS)[0], kind="stable")
    best, out = -np.inf, np.zeros(len(p))
    for size in range(1, len(p) + 1):
        chosen = order[:size]
        share, likely = _em(p[chosen], counts, ROUNDS)
        value = likely - penalty * size * np.log(counts.sum() + 1)
        if value <= best:
            break
        best, out = value, np.zeros(len(p))
        out[chosen] = share
    return out


def identify(docs: DataFrame, training: DataFrame, penalty: float = 2.0) -> DataFrame:
    """All columns of ``docs`` plus lang_pred, score (share of that language) and shares, which
    take the place of input columns of these names.

    Null texts, texts without a letter and all texts when nothing was learned are ``und``
    with score 0. Only the text is looked at. Repeated rows get equal results;
    an empty table gives no rows.
    """
    langs, log_p = train(training)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(log_p)  # languages x BUCKETS numbers, a fixed size

    def guess(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            names, scores, shares = [], [], []
            for text in batch:
                found, counts = grams(text)
                if not len(found) or not langs:
                    names.append(UNKNOWN), scores.append(0.0), shares.append({})
                    continue
                share = proportions(shared.value[:, found], counts, penalty)
                top = int(np.argmax(share))
                names.append(langs[top]), scores.append(float(min(1.0, share[top])))
                shares.append({langs[i]: float(share[i]) for i in np.flatnonzero(share)})
            yield pd.DataFrame({"lang_pred": names, "score": scores, "shares": shares})

    udf = F.pandas_udf(guess, "lang_pred string, score double, shares map<string,double>")
    guessed = docs.withColumn("__guess", udf(F.col("text")))
    return guessed.select(*[F.col(f"`{c}`") for c in docs.columns if c not in _ADDED], "__guess.lang_pred", "__guess.score", "__guess.shares")


def held_out(key, parts: int, part: int):
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts == part, F.lit(False))


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    out = held_out(F.col("doc_id"), 4, 2)
    guessed = identify(docs.select("doc_id", "text"), docs.where(~out))
    return guessed.select("doc_id", out.alias("held_out"), "lang_pred", "score")
