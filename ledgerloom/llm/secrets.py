"""Secret scan behind trigram queries, in DataFrame functions only.

Every rule has a Boolean trigram query, derived from its pattern: a list of alternatives,
each a literal whose trigrams must all occur, so that every match holds one. The index is kept per
document: the set of rule trigrams in its lower-cased text. A rule's pattern runs only on
documents whose postings satisfy its query; a rule without mandatory literals scans all.
Spans need offsets: the pieces between matches and the matches come from the same pattern,
so running lengths give starts in code points.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from re import _parser as parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import table


#: Alternatives a literal query may have, at most.
_MOST = 64


def _strings(node) -> tuple[set[str] | None, list[set[str]]]:
    """All lower-case texts a parsed pattern can match (null: too many to list), and sets of
    literals of which each match holds one."""
    exact: set[str] | None = {""}  # all texts since the last part that was not listable
    whole, held = True, []
    for op, value in node:
        name, part, more = str(op), None, []
        if name == "LITERAL":
            part = {chr(value).lower()}
        elif name == "IN" and len(value) <= 8 and all(str(o) == "LITERAL" for o, _ in value):
            part = {chr(v).lower() for _, v in value}
        elif name == "SUBPATTERN":
            part, more = _strings(value[-1])
        elif name == "ATOMIC_GROUP":
            part, more = _strings(value)
        elif name in ("AT", "ASSERT", "ASSERT_NOT"):
            part = {""}
        elif name == "BRANCH":
            found = [_strings(b) for b in value[1]]
            if all(f[0] is not None for f in found):
                part = set().union(*(f[0] for f in found))
            best = [_best([*f[1], *([f[0]] if f[0] else [])]) for f in found]
            if all(best):
                more = [set().union(*best)]
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            low, high, inner = value
            one, inside = _strings(inner)
            more = inside if low else []
            if one is not None and high == 1:
                part = one | ({""} if low == 0 else set())
            elif one is not None and low:
                more = [*more, {a + b for a in exact for b in one}]
        held += more
        joined = None if part is None else {a + b for a in exact for b in part}
        if joined is not None and len(joined) <= _MOST:
            exact = joined
            held.append(exact)
        else:
            whole, exact = False, {""}
            if part is not None and len(part) <= _MOST:
                exact = part
                held.append(exact)
    return (exact if whole else None), held


def _best(held: list[set[str]]) -> set[str]:
    """The set whose shortest literal is longest, of these the smallest; trigrams need three letters."""
    usable = [h for h in held if h and len(h) <= _MOST and min(map(len, h)) >= 3]
    return max(usable, key=lambda h: (min(map(len, h)), -len(h), sorted(h)), default=set())


@lru_cache
def mandatory(pattern: str) -> tuple[str, ...]:
    """Literals, lower case, of which every match of a pattern holds one; empty if none is sure."""
    return tuple(sorted(_best(_strings(parser.parse(pattern))[1])))


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str  # read alike by Java and Python
    group: int = 0  # the group whose length is checked
    least: int = 1

    @property
    def literals(self) -> tuple[str, ...]:
        return mandatory(self.pattern)


# A key reaches to its END line. Where that is missing, to the end of its base64 lines: long
# ones, parted by space, quotes or written line ends, and a short one that fills a line.
_PEM_GAP = r"""(?:\\[nrt]|[\s"'+,;#*>])++"""
_PEM = (
    r"-----BEGIN ([A-Z ]*)PRIVATE KEY-----"
    r"(?:[^-]*+(?:-{1,4}[^-]++)*+-----END \1PRIVATE KEY-----"
    rf"|(?:{_PEM_GAP}(?:Proc-Type|DEK-Info):[^\r\n\\]*+)*+"
    rf"""(?:(?:{_PEM_GAP}[A-Za-z0-9+/]{{16,}}+={{0,2}}+)++(?:(?:\r?\n|\\n)[A-Za-z0-9+/]++={{0,2}}+(?![ \t]*[^\s\\"']))?+)?+)"""
)

# The three base kinds.
BASE = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]+", 0, 16),
)
EXTRA = (
    Rule("pem", _PEM),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+", 0, 24),
)


def trigrams(literal: str) -> list[str]:
    return sorted({literal[i : i + 3] for i in range(len(literal) - 2)})


def postings(text: Column, rules) -> Column:
    """The rule trigrams that occur in a text, as an array."""
    wanted = sorted({t for r in rules for lit in r.literals for t in trigrams(lit)})
    low = F.lower(text)
    return F.array_compact(F.array(*[F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in wanted])) if wanted else F.array().cast("array<string>")


def candidate(held: Column, rule: Rule) -> Column:
    """The rule's trigram query on a document's postings: any literal with all its trigrams."""
    if not rule.literals:
        return F.lit(True)
    out = F.lit(False)
    for literal in rule.literals:
        every = F.lit(True)
        for t in trigrams(literal):
            every = every & F.array_contains(held, t)
        out = out | every
    return out


def spans_of(text: Column, rule: Rule, order: int) -> Column:
    """Kept matches of a rule: array of (start, order, kind, end), leftmost non-overlapping."""
    kept = "array<struct<start:bigint,ord:int,kind:string,end:bigint>>"
    pattern = F.lit(rule.pattern)
    pieces = F.slice(F.transform(F.split(text, rule.pattern, -1), lambda s: F.length(s).cast("long")), 1, 2147483647)
    whole = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda s: F.length(s).cast("long"))
    checked = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda s: F.length(s).cast("long"))
    rows = F.arrays_zip(pieces.alias("gap"), whole.alias("n"), checked.alias("c"))

    def step(acc, row):
        start = acc["pos"] + row["gap"]
        end = start + F.coalesce(row["n"], F.lit(0))
        span = F.struct(start.alias("start"), F.lit(order).alias("ord"), F.lit(rule.kind).alias("kind"), end.alias("end"))
        found = F.when(row["c"] >= rule.least, F.concat(acc["found"], F.array(span))).otherwise(acc["found"])
        return F.struct(end.alias("pos"), found.alias("found"))

    zero = F.struct(F.lit(0).cast("long").alias("pos"), F.array().cast(kept).alias("found"))
    return F.aggregate(rows, zero, step, lambda acc: acc["found"])


def scan(docs: DataFrame, extra: tuple[Rule, ...] = EXTRA) -> DataFrame:
    """All columns of ``docs`` plus ``spans_found``: every kept span by start, then kind as listed.

    Null text counts as empty and has no spans. Base kinds always run; ``extra`` only adds.
    An input column ``spans_found`` is replaced. Repeated rows get equal spans; an empty
    table gives no rows.
    """
    rules = BASE + tuple(extra)
    none = F.array().cast("array<struct<start:bigint,ord:int,kind:string,end:bigint>>")
    text = F.coalesce(F.col("text"), F.lit(""))
    indexed = docs.withColumn("__held", postings(text, rules))
    # A maximal run of hex digits is kept from 16 on, so shorter runs need not be listed.
    run = [r if r.kind != "hex" else Rule("hex", r"[0-9a-f]{16,}", 0, 16) for r in rules]
    parts = [F.when(candidate(F.col("__held"), r), spans_of(text, r, i)).otherwise(none) for i, r in enumerate(run)]
    return indexed.withColumn("spans_found", F.array_sort(F.concat(*parts))).drop("__held")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def summary(scanned: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of scanned documents."""
    spans = F.col("spans_found")

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(spans, lambda s: s["ord"] < len(BASE))
    return scanned.select("doc_id", *[count(r.kind) for r in BASE], F.sha2(_joined(base), 256).alias("base_sha256"), _joined(spans).alias("spans"))


def op2_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return summary(scan(table(spark, folder, "documents").select("doc_id", "text")))
