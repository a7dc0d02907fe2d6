"""The corpus pipeline: language, near-duplicates, leaks, secrets, packing.

Each stage takes (spark, docs, sf_dir); its result is written and read again as the next
stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import decontaminate, language, packing, secrets, simhash
from ledgerloom.llm.common import table
from ledgerloom.session import drop_but_last, name_own_folder, written_count, written_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
MASK = "[secret]"


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language is undecided: null or no letter."""
    training = docs.where(~language.held_out(F.col("doc_id"), 4, 2))
    guessed = language.identify(docs.select(*COLUMNS), training)
    return guessed.where(F.col("lang_pred") != language.UNKNOWN).select(*COLUMNS)


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each SimHash component: the smallest doc_id, then text hash; a row
    without doc_id only if no other is there. Different texts under one doc_id both stay."""
    return simhash.one_per_component(docs.select(*COLUMNS))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark window."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark")).where("contaminated")
    leaked = found.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h")).distinct()
    keyed = docs.select(*COLUMNS)
    return keyed.join(leaked, F.expr("doc_id <=> d and xxhash64(text) = h"), "left_anti")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret span by a mark; overlapping spans become one mark."""
    scanned = secrets.scan(docs.select(*COLUMNS))
    zero = F.struct(F.lit(0).cast("long").alias("pos"), F.lit("").alias("out"))

    def step(acc, span):
        gap = F.when(
            span["start"] >= acc["pos"],
            F.concat(F.substring(F.col("text"), acc["pos"].cast("int") + 1, (span["start"] - acc["pos"]).cast("int")), F.lit(MASK)),
        ).otherwise(F.lit(""))
        return F.struct(F.greatest(acc["pos"], span["end"]).alias("pos"), F.concat(acc["out"], gap).alias("out"))

    rest = F.length("text")
    masked = F.aggregate(
        "spans_found",
        zero,
        step,
        lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["pos"].cast("int") + 1, rest)),
    )
    text = F.when(F.size("spans_found") > 0, masked).otherwise(F.col("text"))
    out = scanned.withColumn("masked", text)
    return out.select("doc_id", F.col("masked").alias("text"), "lang", "source", F.length("masked").cast("long").alias("n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of 1024 tokens."""
    return packing.pack(docs, "byte_bpe_50k.json")


def _stage(function):
    """The stage, also for a local session that names no ``spark.checkpoint.dir`` (trials)."""

    @functools.wraps(function)
    def apply(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        name_own_folder(spark)
        return function(spark, docs, sf_dir)

    return apply


STAGES = [
    ("language_id", _stage(keep_known_languages)),
    ("simhash_dedup", _stage(one_per_group)),
    ("decontaminate", _stage(drop_leaks)),
    ("mask_secrets", _stage(mask_secrets)),
    ("pack", _stage(pack)),
]

# Packing and fingerprints are not expressible in SQL; tests/llm compares run() with plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; what a stage wrote besides its result, and its input, are deleted."""
    docs, before = table(spark, sf_dir, "documents"), written_count()
    for name, stage in STAGES:
        docs = written_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
        drop_but_last(spark, before)
    return docs
