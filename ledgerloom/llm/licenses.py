"""Licence scan: TF-IDF cosine of headers and whole files to templates, then inheritance.

Units of a text (lines, their sentences, paragraphs, the whole) become sparse TF-IDF
vectors and meet the templates' vectors in a join on the word. Idf counts are the numbers of
documents, over all of them, that hold the word. A unit whose cosine reaches the limit
must share some of a template's heaviest words, whichever they are by these counts, so units
without any are not listed. A document that is little more than a licence text is the
licence file of its directory. A document without a header takes the licence of its
nearest ancestor directory that has a licence file.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import table
from ledgerloom.session import written_table

_WORD = re.compile(r"[a-z0-9]+")
_SENTENCE = re.compile(r"(?<=[.;])\s+")
_PARAGRAPH = re.compile(r"\n[ \t]*\n")
#: Bits of the table of hashed words that is looked at before words are counted.
BITMAP_BITS = 1 << 20

# Identifiers and names of licences, usual headers, two notices.
NAMES = {
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0"),
    "MIT": ("MIT License",),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU General Public License v3.0"),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "BSD-3-Clause": ("BSD 3-Clause License",),
}
HEADERS = (
    "{}", "Licensed under the {}", "Released under the {}", "Distributed under the {}", "Redistributed under the {}", "This work is licensed under the {}",
    "This file is licensed under the {}", "This project is licensed under the {}", "This project is released under the {}",
)
NOTICES = {
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions:",
    ),
}
TEMPLATES = {
    name: (*(h.format(n) for n in names for h in HEADERS), f"SPDX-License-Identifier: {name}", *NOTICES.get(name, ()))
    for name, names in NAMES.items()
}


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def frequencies(docs: DataFrame, keep: Sequence[str] | bytes) -> DataFrame:
    """(w, c): in how many documents a word occurs, for listed words or those that a packed
    table of hashes holds; the word "" counts all documents."""

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        listed = frozenset(keep) if not isinstance(keep, bytes) else None
        bits = None if listed is not None else np.unpackbits(np.frombuffer(keep, np.uint8)).tobytes()
        for b in batches:
            seen: Counter = Counter({"": len(b)})
            for text in b["text"]:
                found = set(words(text))
                seen.update(found & listed if listed is not None else [w for w in found if bits[_slot(w)]])
            yield pd.DataFrame({"w": list(seen), "c": list(seen.values())})

    return docs.select("text").mapInPandas(count, "w string, c long").groupBy("w").agg(F.sum("c").alias("c"))


def _slot(word: str) -> int:
    return zlib.crc32(word.encode()) % BITMAP_BITS


def _idf(total: int, count: int) -> float:
    return math.log((1 + total) / (1 + count)) + 0.1


def vector(tokens: Sequence[str], idf: Mapping[str, float]) -> dict[str, float]:
    weights = {w: n * idf[w] for w, n in Counter(tokens).items()}
    norm = math.sqrt(sum(x * x for x in weights.values())) or 1.0
    return {w: x / norm for w, x in weights.items()}


def cues(vectors: Sequence[Mapping[str, float]], least: float) -> set[str]:
    """Words of which a unit has one at least if its cosine with some vector reaches ``least``:
    the words of a vector that are left out of it have less than the square of ``least``."""
    out: set[str] = set()
    for v in vectors:
        rest = 1.0
        for w in sorted(v, key=lambda w: (-v[w], w)):
            if rest < least * least - 1e-9:
                break
            out.add(w)
            rest -= v[w] ** 2
    return out


def units(text: str | None, marks: set[str]) -> list[tuple[bool, dict[str, int]]]:
    """(whether it is the whole text, word counts) of the units that hold one of ``marks``."""
    tokens = words(text)
    if marks.isdisjoint(tokens):
        return []
    parts = []
    for paragraph in _PARAGRAPH.split(text):
        lines = paragraph.split("\n")
        parts += [paragraph, *lines, *(s for line in lines for s in _SENTENCE.split(line))]
    found = {tuple(words(part)) for part in parts}
    return [(True, Counter(tokens)), *((False, Counter(t)) for t in sorted(found) if not marks.isdisjoint(t))]


def headers(docs: DataFrame, templates=TEMPLATES, least: float = 0.8) -> DataFrame:
    """doc_id, path, own (best licence of any unit or null), score, is_file (the whole text
    is as close to a template as a header)."""
    listed = [(name, words(t)) for name, texts in templates.items() for t in texts]
    vocabulary = sorted({w for _, t in listed for w in t})
    known = {r["w"]: r["c"] for r in frequencies(docs, vocabulary).collect()}  # words of the templates
    total = known.get("", 0)
    idf = {w: _idf(total, known.get(w, 0)) for w in vocabulary}
    vectors = [(name, vector(t, idf)) for name, t in listed]
    marks = cues([v for _, v in vectors], least)

    def cut(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([[{"whole": whole, "words": counts} for whole, counts in units(t, marks)] for t in batch])

    key = [F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b")]
    cutter = F.pandas_udf(cut, "array<struct<whole:boolean,words:map<string,int>>>")
    listed_units = docs.select(*key, F.posexplode(cutter(F.col("text"))).alias("unit", "u")).select("a", "b", "unit", "u.whole", "u.words")
    found = written_table(listed_units, "units")
    terms = found.select(F.explode(F.map_keys("words")).alias("w")).distinct()
    terms = terms.where(~F.col("w").isin(*vocabulary)) if vocabulary else terms
    bits = np.zeros(BITMAP_BITS, bool)
    slots = terms.select((F.crc32(F.col("w").cast("binary")) % BITMAP_BITS).alias("slot")).distinct().toPandas()
    bits[slots["slot"].to_numpy(np.int64)] = True
    spark = docs.sparkSession
    first = spark.createDataFrame([(w, float(x)) for w, x in idf.items()], "w string, idf double")
    others = frequencies(docs, np.packbits(bits).tobytes()).join(terms, "w", "left_semi")
    others = written_table(others.select("w", (F.log((F.lit(1.0) + total) / (F.lit(1.0) + F.col("c"))) + 0.1).alias("idf")), "idf")
    weighed = first.unionByName(others)

    # Equal texts are judged once.
    spread = found.dropDuplicates(["a", "b", "unit"]).select("a", "b", "unit", "whole", F.explode("words").alias("w", "n"))
    spread = spread.join(weighed, "w").withColumn("x", F.col("n") * F.col("idf"))
    wanted = spark.createDataFrame([(w, i, name, float(x)) for i, (name, v) in enumerate(vectors) for w, x in v.items()], "w string, i int, name string, t double")
    unit = ["a", "b", "unit", "whole"]
    norms = spread.groupBy(*unit).agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    dots = spread.join(wanted, "w").groupBy(*unit, "i", "name").agg(F.sum(F.col("x") * F.col("t")).alias("dot"))
    scores = dots.join(norms, unit).withColumn("score", F.round(F.col("dot") / F.col("norm"), 9)).where(F.col("score") >= least)
    best = F.min(F.when(~F.col("whole"), F.struct((-F.col("score")).alias("s"), "name"))).alias("best")
    judged = scores.groupBy("a", "b").agg(best, F.max("whole").alias("file")).where("best is not null")
    judged = judged.select(F.col("a").alias("__a"), F.col("b").alias("__b"), "best", "file")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("path").cast("string"), *key)
    out = rows.join(judged, (F.col("a") == F.col("__a")) & (F.col("b") == F.col("__b")), "left")
    return out.select("doc_id", "path", F.col("best.name").alias("own"), F.coalesce(-F.col("best.s"), F.lit(0.0)).alias("score"), F.coalesce("file", F.lit(False)).alias("is_file"))


def _directory(path: Column) -> Column:
    return F.regexp_replace(path, r"(^|/)[^/]*$", "")


def licences(docs: DataFrame, templates=TEMPLATES, least: float = 0.8) -> DataFrame:
    """doc_id, path, license, score, inherited_from per row of ``docs`` (doc_id, path, text).

    Own header first; else the nearest ancestor directory with a licence file (best score,
    then name); else null. The root directory is the empty path. A null path has no
    ancestors; null and empty texts have no header. Ancestors are joined per distinct
    directory, so a directory with most of the files is one row on both sides. Repeated
    rows give equal rows, an empty table none; other columns are ignored.
    """
    found = written_table(headers(docs, templates, least).withColumn("dir", _directory(F.col("path"))), "headers")
    files = found.where("is_file and dir is not null").groupBy("dir").agg(F.min(F.struct((-F.col("score")).alias("s"), "own")).alias("f"))
    owners = files.select(F.col("dir").alias("ancestor"), F.col("f.own").alias("passed"))
    steps = F.split("dir", "/")
    ancestors = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda i: F.struct(i.alias("depth"), F.array_join(F.slice(steps, 1, i), "/").alias("ancestor")))
    chain = found.where("dir is not null").select("dir").distinct().select("dir", F.inline(ancestors))
    nearest = chain.join(owners, "ancestor").groupBy("dir").agg(F.max(F.struct("depth", "ancestor", "passed")).alias("n"))
    out = found.join(nearest, "dir", "left")
    return out.select(
        "doc_id",
        "path",
        F.coalesce("own", "n.passed").alias("license"),
        "score",
        F.when(F.col("own").isNull(), F.col("n.ancestor")).alias("inherited_from"),
    )


def op3_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Documents carry no path: source, then thousands and tens of the id, stand in for one."""
    docs = table(spark, folder, "documents")
    step = [F.floor(F.col("doc_id") / n).cast("string") for n in (1000, 10)]
    path = F.concat_ws("/", F.coalesce("source", F.lit("")), *step, F.col("doc_id").cast("string"))
    return licences(docs.select("doc_id", "text", path.alias("path")))
