"""Phrases whose words occur together more often than chance, per language.

Counts of all n-grams come from weighted acyclic automata. A shard (some documents of one
task) sorts its n-grams and sums equal ones. The sorted n-grams of all shards meet in
ranges of their common order; a range is read once in that order and builds its automaton
incrementally: the path of the last n-gram is open, the weight of a state is the sum over
all n-grams that begin with it, and a state that the next n-gram leaves is closed, its
weight known. Only closed states of at least the wanted weight are kept. States on the
first and last path of a range may go on in the next one; their weights are added
afterwards. Memory is one path per task, and a hot word, pair or phrase is split like any
other, as ranges are cut between whole n-grams.

N-grams are counted in three steps, words, pairs, three to five words, each shard leaving out
what a fixed-size bitmap of the step before proves too rare; false hits of a bitmap cost
rows, never results. Candidates are cut into two parts, and composing the cuts with the
automata (a join on the paths of their states) gives the weights of the parts.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import table
from ledgerloom.session import written_table

LONGEST = 5
#: Bits of the bitmaps of frequent words and pairs; as many small rows reach the driver at most.
BITMAP_BITS = 1 << 22
#: Words and different words at which a shard is counted, and bytes of a text that is cut at once.
SHARD_WORDS, SHARD_NAMES, TEXT_BYTES = 1 << 22, 1 << 20, 1 << 20
_ROWS = 1 << 16
#: Number of a word in a packed n-gram, and what keeps n-grams of two texts apart.
_FIELD = (1 << 21) - 1
_GAP = np.zeros(1, np.int32)
_SEED = 42
#: Marks the end of a piece; no byte of UTF-8.
_END = b"\xff"
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + _END * 10 + b" ")
_TOKEN = re.compile(rb"\xff|[^ \xff]+")


def tokens(text: str | None) -> Iterator[tuple[list[bytes], int]]:
    """Words and piece ends of a text in lists of bounded size, each with the number of its
    items that n-grams may begin at; the others begin the next list."""
    data = (text or "").encode("utf-8").translate(_PLAIN)
    if len(data) <= TEXT_BYTES:
        found = data.replace(_END, b" \xff ").split()
        yield found, len(found)
        return
    rest, held = (m[0] for m in _TOKEN.finditer(data)), []
    while True:
        more = list(itertools.islice(rest, TEXT_BYTES // 2))
        found = held + more
        begun = len(found) if len(more) < TEXT_BYTES // 2 else len(found) - (LONGEST - 1)
        yield found, begun
        if begun == len(found):
            return
        held = found[begun:]


class _Ids(dict):
    """Numbers of the words of one language in a shard, 0 for piece ends and rare words."""

    def __init__(self, shard: Shard, lang: str):
        super().__init__({_END: 0})
        self.shard, self.lang = shard, lang
        self.seed = xxhash.xxh64_intdigest(lang.encode(), _SEED)

    def __missing__(self, word: bytes) -> int:
        digest = xxhash.xxh64_intdigest(word, self.seed)
        self[word] = out = self.shard.name(word, self.lang, digest) if self.shard.words[digest & (BITMAP_BITS - 1)] else 0
        return out


class Shard:
    """Sorted, summed n-grams of ``least`` to ``most`` words of some documents."""

    def __init__(self, least: int, most: int, words: np.ndarray, pairs: np.ndarray | None):
        self.least, self.most, self.words, self.pairs = least, most, words, pairs
        self.clear()

    def clear(self) -> None:
        self.names, self.langs, self.digests = [b""], [""], [0]
        self.ids: dict[str, _Ids] = {}
        self.parts: list[np.ndarray] = []
        self.unbegun: list[np.ndarray] = []
        self.size = 0

    def name(self, word: bytes, lang: str, digest: int) -> int:
        self.names.append(word)
        self.langs.append(lang)
        self.digests.append(digest)
        return len(self.names) - 1

    def add(self, lang: str, found: list[bytes], begun: int) -> None:
        ids = self.ids.get(lang)
        if ids is None:
            ids = self.ids[lang] = _Ids(self, lang)
        self.parts += [np.fromiter(map(ids.__getitem__, found), np.int32, len(found)), _GAP]
        if begun < len(found):
            self.unbegun.append(np.arange(self.size + begun, self.size + len(found)))
        self.size += len(found) + len(_GAP)

    def full(self) -> bool:
        return self.size >= SHARD_WORDS or len(self.names) >= SHARD_NAMES

    def ngrams(self) -> Iterator[pa.RecordBatch]:
        """(lang, phrase, n) in the order of the words; empties the shard."""
        if not self.parts:
            return
        ids = np.concatenate(self.parts)
        linked = (ids[:-1] != 0) & (ids[1:] != 0)
        if self.pairs is not None:
            at = np.flatnonzero(linked)
            digests = np.array(self.digests, np.uint64)
            linked[at] = self.pairs[((digests[ids[at]] >> np.uint64(7)) ^ digests[ids[at + 1]]) & np.uint64(BITMAP_BITS - 1)]
        size = (ids != 0).astype(np.int8)
        for _ in range(self.most - 1):
            size[:-1] += linked * (size[1:] - size[:-1] + 1)
        for part in self.unbegun:
            size[part] = 0
        at = np.flatnonzero(size >= self.least)
        size = size[at]
        order = np.array(sorted(range(1, len(self.names)), key=self.names.__getitem__), np.int64)
        rank = np.zeros(len(self.names), np.int64)
        rank[order] = np.arange(1, len(order) + 1)
        names = pa.array([None, *(self.names[i] for i in order)], pa.binary()).cast(pa.string())
        langs = pa.array(["", *(self.langs[i] for i in order)], pa.string()).dictionary_encode()
        self.clear()

        def word(j: int) -> np.ndarray:
            return rank[np.where(size > j, ids[np.minimum(at + j, len(ids) - 1)], 0)]

        high = word(0) << 42 | word(1) << 21 | word(2)
        if self.most <= 3:
            high, counts = np.unique(high, return_counts=True)
            low = np.zeros(len(high), np.int64)
        else:
            low = word(3) << 21 | word(4)
            order = np.lexsort((low, high))
            high, low = high[order], low[order]
            new = np.ones(len(order), bool)
            new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
            new = np.flatnonzero(new)
            counts = np.diff(np.append(new, len(order)))
            high, low = high[new], low[new]
        for i in range(0, len(high), _ROWS):
            first, second = high[i : i + _ROWS], low[i : i + _ROWS]
            cols = [(first >> 42), (first >> 21) & _FIELD, first & _FIELD, second >> 21, second & _FIELD]
            phrase = pc.binary_join_element_wise(*[names.take(pa.array(c)) for c in cols[: self.most]], " ", null_handling="skip")
            lang = langs.take(pa.array(cols[0])).dictionary_decode()
            yield pa.RecordBatch.from_arrays([lang, phrase, pa.array(counts[i : i + _ROWS], pa.int64())], ["lang", "phrase", "n"])


class OpenPath:
    """The open end of an automaton built from sorted n-grams, ``least`` words and more.

    A state's weight is added to that of the state before it when it is closed.
    """

    def __init__(self, least_words: int, least: int):
        self.least_words, self.least = least_words, least
        self.lang: str | None = None
        self.path: list[str] = []
        self.weights: list[int] = []
        self.first = 0  # states that were opened by the first n-gram
        self.closed: list[tuple[str, str, int]] = []

    def close(self, keep: int, ends: bool = False) -> None:
        """Leave all states but the first ``keep``. States on the first or last path of a
        range may have weight elsewhere, and are kept whatever their own is."""
        path, weights = self.path, self.weights
        while len(path) > keep:
            weight, size = weights.pop(), len(path)
            if size >= self.least_words and (weight >= self.least or ends or size <= self.first):
                self.closed.append((self.lang, " ".join(path), weight))
            path.pop()
            if weights:
                weights[-1] += weight
        self.first = min(self.first, keep)

    def add(self, lang: str, phrase: str, n: int) -> None:
        words, path, shared = phrase.split(" "), self.path, 0
        if lang == self.lang:
            for a, b in zip(words, path):
                if a != b:
                    break
                shared += 1
        if shared < len(path):
            self.close(shared)
        if self.lang is None:
            self.first = len(words)
        self.lang = lang
        more = words[shared:]
        path += more
        self.weights += [0] * len(more)
        self.weights[-1] += n


def _drained(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [(), (), ()]
    kinds = {"lang": pa.string(), "phrase": pa.string(), "n": pa.int64()}
    out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds.values())], list(kinds))
    rows.clear()
    return out


def united(shards: DataFrame, least_words: int, least: int) -> DataFrame:
    """(lang, phrase, f) of the beginnings, of at least ``least_words`` words, of all n-grams
    of ``shards`` (lang, phrase, n) whose weights add up to ``least``."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = OpenPath(least_words, least)
        for batch in batches:
            for lang, phrase, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
                open_.add(lang, phrase, n)
            if len(open_.closed) >= _ROWS:
                yield _drained(open_.closed)
        open_.close(0, ends=True)
        yield _drained(open_.closed)

    # Sorted as lists of words: the space between words becomes the least byte, which words
    # do not hold once it is spelled with two others.
    spelled = F.replace(F.replace("phrase", F.lit("\x01"), F.lit("\x01\x02")), F.lit("\x00"), F.lit("\x01\x01"))
    key = [F.col("lang"), F.replace(spelled, F.lit(" "), F.lit("\x00"))]
    ranges = shards.repartitionByRange(*key).sortWithinPartitions(*key)
    states = ranges.mapInArrow(build, "lang string, phrase string, n long")
    return states.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= least)


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, phrase, f) of all words of ``docs`` (lang, text)."""

    def drained(sums: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, counts in sums.items():
            counts.pop(_END, None)
            names = pa.array(list(counts), pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(names), pa.string()), names, pa.array(list(counts.values()), pa.int64())], ["lang", "phrase", "n"])
        sums.clear()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                counts = sums.setdefault(lang.as_py(), Counter())
                for found, begun in tokens(text.as_py()):
                    counts.update(found if begun == len(found) else found[:begun])
                    if sum(map(len, sums.values())) >= SHARD_NAMES:
                        yield from drained(sums)
                        counts = sums.setdefault(lang.as_py(), Counter())
        yield from drained(sums)

    return docs.mapInArrow(count, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("f"))


def ngram_counts(docs: DataFrame, least_words: int, most_words: int, words: np.ndarray, pairs: np.ndarray | None) -> DataFrame:
    """(lang, phrase, n): summed n-grams of each shard of ``docs`` (lang, text)."""
    shared = docs.sparkSession.sparkContext.broadcast((np.packbits(words), None if pairs is None else np.packbits(pairs)))  # fixed sizes

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = [None if b is None else np.unpackbits(b).astype(bool) for b in shared.value]
        shard = Shard(least_words, most_words, *bits)
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                for found, begun in tokens(text.as_py()):
                    shard.add(lang.as_py(), found, begun)
                    if shard.full():
                        yield from shard.ngrams()
        yield from shard.ngrams()

    return docs.mapInArrow(count, "lang string, phrase string, n long")


def _bitmap(slots: DataFrame) -> np.ndarray:
    """Bits that are set; at most BITMAP_BITS distinct numbers reach the driver."""
    out = np.zeros(BITMAP_BITS, bool)
    out[slots.distinct().toArrow().column(0).to_numpy()] = True
    return out


def _digest(word: Column) -> Column:
    return F.xxhash64("lang", word)


def phrase_counts(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f) of all phrases of up to five words found ``least`` times, and (lang, n)."""
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    words = written_table(word_counts(docs), "words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    single = words.where(F.col("f") >= least)
    mask = F.lit(BITMAP_BITS - 1)
    known = _bitmap(single.select(_digest(F.col("phrase")).bitwiseAND(mask)))
    pairs = written_table(ngram_counts(docs, 2, 2, known, None).groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= least), "pairs")
    halves = F.split("phrase", " ")
    slot = F.shiftrightunsigned(_digest(halves[0]), 7).bitwiseXOR(_digest(halves[1])).bitwiseAND(mask)
    shards = written_table(ngram_counts(docs, 3, LONGEST, known, _bitmap(pairs.select(slot))), "ngrams")
    return written_table(single.unionByName(pairs).unionByName(united(shards, 3, least)), "phrases"), totals


def collocations(docs: DataFrame, least: int = 100, most: int = 2000) -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a, l, r, n, score.

    ``docs`` has lang (null: ``und``) and text (null: empty); other columns are ignored. a
    is the phrase's count, l and r the counts of its parts at the cut of the lowest score
    floor(1000 a n / (l r)), n the language's words. Phrases inside a longer one of the
    same count are left out. Ties of score and a go by the phrase's bytes. Repeated rows
    count each; an empty table or none with ``least`` occurrences gives no rows.
    """
    counts, totals = phrase_counts(docs, least)
    words = F.split("phrase", " ")
    candidates = counts.withColumn("words", words).where(F.size("words") > 1)

    # A longer phrase of the same count has one of one word more between it and the phrase.
    size = F.size("words")
    inner = F.array(F.slice("words", F.lit(1), size - 1), F.slice("words", F.lit(2), size - 1))
    held = candidates.where(size > 2).select("lang", F.col("f").alias("a"), F.explode(F.transform(inner, lambda p: F.array_join(p, " "))).alias("phrase")).distinct()
    kept = candidates.withColumnRenamed("f", "a").join(held, ["lang", "phrase", "a"], "left_anti")

    cuts = F.transform(
        F.sequence(F.lit(1), size - 1),
        lambda k: F.struct(k.alias("k"), F.array_join(F.slice("words", F.lit(1), k), " ").alias("first"), F.array_join(F.slice("words", k + 1, size), " ").alias("rest")),
    )
    cut = kept.select("lang", "phrase", "a", F.inline(cuts))

    def composed(rows: DataFrame, part: str, weight: str) -> DataFrame:
        return rows.join(counts.select("lang", F.col("phrase").alias(part), F.col("f").alias(weight)), ["lang", part])

    weighed = composed(composed(cut, "first", "l"), "rest", "r").join(totals, "lang")
    exact = {c: F.col(c).cast("decimal(18,0)") for c in ("a", "l", "r", "n")}
    score = F.call_function("div", F.lit(1000).cast("decimal(4,0)") * exact["a"] * exact["n"], exact["l"] * exact["r"])
    least_cut = weighed.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("c"))
    best = Window.partitionBy("lang").orderBy(F.desc("c.score"), F.desc("a"), "phrase")
    ranked = least_cut.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most)
    return ranked.select("lang", F.col("rank").cast("long"), "phrase", "a", "c.l", "c.r", "n", "c.score")


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))


OP12_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(pieces), '[^\x20\x09]+') AS w FROM d),
g AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p),
k AS (SELECT lang, w, i, unnest([1, 2, 3, 4, 5]) AS k FROM g),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM k WHERE i + k - 1 <= len(w) GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE k > 1 AND f >= 100),
inner_ AS (SELECT lang, a, k, w, unnest(range(2, k)) AS m FROM c),
places AS (SELECT lang, a, w, m, unnest(range(1, k - m + 2)) AS i FROM inner_),
longer AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS held FROM places GROUP BY ALL),
kept AS (SELECT c.* FROM c LEFT JOIN longer USING (lang, phrase) WHERE held IS NULL OR 100 * held < 100 * a),
cut AS (SELECT lang, phrase, a, w, k, unnest(range(1, k)) AS cut_at FROM kept),
s AS (SELECT cut.lang, cut.phrase, a, cut_at, l.f AS l, r.f AS r, n,
    (1000::HUGEINT * a::HUGEINT * n::HUGEINT) // (l.f::HUGEINT * r.f::HUGEINT) AS score FROM cut
  JOIN f l ON l.lang = cut.lang AND l.phrase = array_to_string(w[1:cut_at], ' ') JOIN f r ON r.lang = cut.lang AND r.phrase = array_to_string(w[cut_at + 1:cut.k], ' ')
  JOIN n ON n.lang = cut.lang),
least AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut_at) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM least)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000"""
