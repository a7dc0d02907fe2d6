"""URL filter: host and path rules first, then a weighted vocabulary found by Aho-Corasick."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import table

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Fixed values of the query: (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


@dataclass(frozen=True)
class Vocabulary:
    """One strict term rejects; soft terms reject once distinct hits weigh ``limit``."""

    strict: tuple[str, ...] = ("casino", "escort", "escorts", "hentai", "nude", "porn", "porno", "viagra", "warez", "xxx")
    soft: tuple[tuple[str, int], ...] = (
        ("adult", 1), ("bet", 1), ("bets", 1), ("betting", 1), ("bonus", 1), ("cam", 1), ("cheap", 1), ("crack", 1), ("dating", 1), ("free", 1),
        ("gambling", 1), ("jackpot", 1), ("loan", 1), ("loans", 1), ("lottery", 1), ("pills", 1), ("poker", 1), ("sex", 1), ("slots", 1), ("win", 1),
    )
    limit: int = 2


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-cased host and the path of a url; both empty for null or no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest fitting rule, else null; equal lengths: the
    more exact host, then the text order."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _word(text: str, at: int) -> bool:
    return 0 <= at < len(text) and text[at].isascii() and text[at].isalnum()


def hits(url: Column, vocabulary: Vocabulary) -> Column:
    """struct(strict, soft, weight): distinct terms that stand between non-alphanumerics."""
    weights = {**{t: 0 for t in vocabulary.strict}, **dict(vocabulary.soft)}
    strict = set(vocabulary.strict)

    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        machine = ahocorasick.Automaton()
        for term in weights:
            machine.add_word(term, term)
        machine.make_automaton()
        for batch in batches:
            rows = []
            for text in batch:
                found = set()
                for end, term in machine.iter(text or "") if weights else ():
                    if not _word(text, end + 1) and not _word(text, end - len(term)):
                        found.add(term)
                soft = sorted(found - strict)
                rows.append((sorted(found & strict), soft, sum(weights[t] for t in soft)))
            yield pd.DataFrame(rows, columns=["strict", "soft", "weight"])

    return F.pandas_udf(find, "strict array<string>, soft array<string>, weight long")(F.translate(url, _UPPER, _LOWER))


def judge(pages: DataFrame, rules=RULES, vocabulary: Vocabulary = Vocabulary()) -> DataFrame:
    """page_id, host, path, rule, verdict, strict, soft, weight of every page.

    A rule's verdict stands; without one the vocabulary blocks or allows. Null and empty
    urls fit no rule, hit no term and are allowed. Repeated rows get equal results.
    """
    host, path = host_and_path(F.col("url"))
    split = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    found = split.withColumn("r", longest_rule(F.col("host"), F.col("path"), rules)).withColumn("hit", hits(F.col("url"), vocabulary))
    by_terms = F.when((F.size("hit.strict") > 0) | (F.col("hit.weight") >= vocabulary.limit), "block").otherwise("allow")
    return found.select(
        "page_id", "host", "path", F.col("r.rule").alias("rule"), F.coalesce("r.verdict", by_terms).alias("verdict"), "hit.strict", "hit.soft", "hit.weight"
    )


def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judge(table(spark, folder, "pages")).select("page_id", "host", "path", "rule", "verdict")


def _oracle(vocabulary: Vocabulary = Vocabulary()) -> str:
    low = f"translate(coalesce(url, ''), '{_UPPER}', '{_LOWER}')"

    def met(term: str) -> str:
        return f"regexp_matches({low}, '(^|[^a-z0-9]){term}([^a-z0-9]|$)')"

    strict = " OR ".join(met(t) for t in vocabulary.strict)
    soft = " + ".join(f"CASE WHEN {met(t)} THEN {w} ELSE 0 END" for t, w in vocabulary.soft)
    fits = " UNION ALL ".join(
        f"SELECT '{h}{p}' AS rule, '{v}' AS verdict, '{h}' AS h, '{p}' AS p" for v, h, p in RULES
    )
    return f"""
WITH r AS ({fits}),
u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest,
  CASE WHEN {strict} OR ({soft}) >= {vocabulary.limit} THEN 'block' ELSE 'allow' END AS terms FROM pages),
s AS (SELECT page_id, terms, translate(regexp_extract(rest, '^[^/?#]*', 0), '{_UPPER}', '{_LOWER}') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, terms) AS verdict FROM (
  SELECT s.*, (SELECT arg_max({{'rule': r.rule, 'verdict': r.verdict}}, length(r.rule)) FROM r
    WHERE (s.host = r.h OR ends_with(s.host, '.' || r.h)) AND starts_with(s.path, r.p)) AS best FROM s)"""


OP6_SQL = _oracle()
