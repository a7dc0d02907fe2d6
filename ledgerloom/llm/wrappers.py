"""Main text of web pages by wrappers inferred per host.

A page becomes a stream of block tags with texts. Adjacent equal blocks fold into a
repeated group. The folded streams of a host are aligned one after the other into a
union-free expression: what only some streams have turns optional, what repeats anywhere
repeats. A text is fixed if most different pages of the host have it at the same path,
which Spark counts over all pages; pages that share their longest block are one. Every
page is matched with its host's wrapper. Articles, main elements and usual class names vote for
an item, items that are mostly links over the host's pages have votes against them, and
fixed texts are left out; text inside an article must be fixed on many pages for that.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from difflib import SequenceMatcher
from html.parser import HTMLParser

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import table, with_nulls, without_nulls
from ledgerloom.llm.urls import host_and_path
from ledgerloom.session import written_table

VOID = set("area base br col embed hr img input link meta source track wbr".split())
INLINE = set("a abbr b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var".split())
LEFT_OUT = set("head title nav header footer aside form button select textarea script style noscript template svg iframe dialog menu".split())
LEFT_OUT_NAMES = re.compile(
    r"^(ad|ads|advert\w*|sponsor\w*|promo\w*|banner\w*|cookie\w*|consent|notice\w*|sidebar\w*|side|menu\w*|nav|navbar|navigation|breadcrumbs?|"
    r"footer|header|masthead|share|sharing|social|related|newsletter|popup|modal|comments?|replies|reply|disqus\w*|contentinfo|complementary)$"
)
#: Different pages of a host that must have a text inside an article before it is left out.
FIRM = 10
# Elements that hold the page or its main text; their class names only describe a layout.
ROOTS = {"html", "body", "article", "main"}
MAIN = re.compile(r"^(article|main)\b|[.](article|content|entry|post|story|main)\b")
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


class _Page(HTMLParser):
    """Blocks (path, text, length of link text) of a page outside left-out elements."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, str, bool]] = []  # tag, name in paths, left out
        self.blocks: list[tuple[str, str, int]] = []
        self.text: list[str] = []
        self.links = 0

    def flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            path = "/".join(name for tag, name, _ in self.stack if tag not in INLINE)
            self.blocks.append((path, text, self.links))
        self.text, self.links = [], 0

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.text.append(" ")
        if tag in VOID and tag != "hr":
            return
        if tag not in INLINE:
            self.flush()
            self._imply(tag)
        if tag == "hr":
            return
        given = dict(attrs)
        names = " ".join(given.get(k) or "" for k in ("class", "id", "role")).lower().split()
        named = tag not in ROOTS and any(LEFT_OUT_NAMES.match(part) for n in names for part in {n, *re.split(r"[-_]", n)[:1]})
        out = tag in LEFT_OUT or "hidden" in given or named
        inner = bool(self.stack) and self.stack[-1][2]
        self.stack.append((tag, ".".join([tag, *(given.get("class") or "").lower().split()]), inner or out))

    def _imply(self, tag: str) -> None:
        ends = CLOSES.get(tag, set()) | {"p"}
        for i in range(len(self.stack) - 1, -1, -1):
            name = self.stack[i][0]
            if name in ends:
                del self.stack[i:]
            elif name not in INLINE:
                return

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self.flush()
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                return
            if tag in INLINE and self.stack[i][0] not in INLINE:
                return

    def handle_data(self, data):
        if not (self.stack and self.stack[-1][2]):
            self.text.append(data)
            if any(t == "a" for t, _, _ in self.stack[-3:]):
                self.links += len(data)


def blocks(html: str | None) -> list[tuple[str, str, int]]:
    page = _Page()
    page.feed(html or "")
    page.close()
    page.flush()
    return page.blocks


def fold(paths: list[str]) -> tuple[list[str], list[bool], list[int]]:
    """Groups of adjacent equal paths: path, whether repeated, and each block's group."""
    groups, repeated, at = [], [], []
    for p in paths:
        if groups and groups[-1] == p:
            repeated[-1] = True
        else:
            groups.append(p)
            repeated.append(False)
        at.append(len(groups) - 1)
    return groups, repeated, at


def align(left: list[dict], right: list[dict]) -> list[dict]:
    """Least expression of both wrappers: items hold path, many, opt, size (text length) and
    links (text length in links), summed over the pages."""
    out = []
    for op, a, b, c, d in SequenceMatcher(None, [x["path"] for x in left], [x["path"] for x in right], autojunk=False).get_opcodes():
        if op == "equal":
            for x, y in zip(left[a:b], right[c:d]):
                out.append(
                    {
                        "path": x["path"],
                        "many": x["many"] or y["many"],
                        "opt": x["opt"] or y["opt"],
                        "size": x["size"] + y["size"],
                        "links": x["links"] + y["links"],
                    }
                )
        else:
            out += [{**x, "opt": True} for x in left[a:b] + right[c:d]]
    return _fold_items(out)


def _fold_items(items: list[dict]) -> list[dict]:
    out: list[dict] = []
    for x in items:
        if out and out[-1]["path"] == x["path"]:
            last = out[-1]
            out[-1] = {**last, "many": True, "opt": last["opt"] and x["opt"], "size": last["size"] + x["size"], "links": last["links"] + x["links"]}
        else:
            out.append(x)
    return out


def _is_main(path: str) -> bool:
    return any(MAIN.search(part) for part in path.split("/"))


def chosen(paths: list[str], wrapper: list[dict]) -> list[bool]:
    """Groups of a page that its host's wrapper takes for main text.

    Votes: two for an element that usually holds the article, one for a slot whose text is
    not mostly links over the host's pages, one against a slot whose text is. On pages
    with an article only its groups are asked; a group the alignment passes over is a slot.
    """
    votes = [2 if _is_main(p) else 0 for p in paths]
    inside = any(votes)
    linked = [False] * len(paths)
    for a, c, n in SequenceMatcher(None, [x["path"] for x in wrapper], paths, autojunk=False).get_matching_blocks():
        linked[c : c + n] = [2 * x["links"] > x["size"] for x in wrapper[a : a + n]]
    return [(not inside or v > 0) and v + (-1 if links else 1) > 0 for v, links in zip(votes, linked)]


def _hashed(text: str) -> int:
    value = xxhash.xxh64_intdigest(text)
    return value - (1 << 64) if value >> 63 else value


def streams(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, host, its groups (paths, many, hashes, sizes, links), and its
    blocks (group they are at, texts, marks), with a hash of the longest text."""
    schema = (
        "page_id long, __no_key boolean, url string, host string, paths array<string>, many array<boolean>, hashes array<long>, "
        "sizes array<long>, links array<long>, at array<int>, texts array<string>, marks array<long>, longest long"
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for start in range(0, len(b), 500):
                part = b.iloc[start : start + 500]
                rows = []
                for html in part["html"]:
                    found = blocks(html)
                    paths, many, at = fold([f[0] for f in found])
                    sizes, links, joined = [0] * len(paths), [0] * len(paths), [[] for _ in paths]
                    for g, (_, text, link) in zip(at, found):
                        sizes[g] += len(text)
                        links[g] += link
                        joined[g].append(text)
                    hashes = [_hashed(" ".join(j)) for j in joined]
                    texts = [f[1] for f in found]
                    # Where each block stands and what it says.
                    marks = [_hashed(f"{path}\n{text}") for path, text, _ in found]
                    longest = _hashed(max(texts, key=len)) if texts else 0
                    rows.append((paths, many, hashes, sizes, links, at, texts, marks, longest))
                made = pd.DataFrame(rows, columns=["paths", "many", "hashes", "sizes", "links", "at", "texts", "marks", "longest"], index=part.index)
                yield pd.concat([part[["page_id", "__no_key", "url", "host"]], made], axis=1)

    host, _ = host_and_path(F.col("url"))
    return without_nulls(pages.select("page_id", "url", host.alias("host"), "html"), "page_id").mapInPandas(run, schema)


def wrappers(found: DataFrame) -> DataFrame:
    """(host, wrapper as JSON) of every host with blocks.

    Streams of one shape are first put together by Spark, item by item, so that a host's
    pages count, however many, as its distinct shapes. Shapes are aligned in 64
    salted groups of a host, then these wrappers with each other.
    """
    shape = F.xxhash64("paths")
    rows = found.where(F.size("paths") > 0).select("host", shape.alias("shape"), F.posexplode(F.arrays_zip("paths", "many", "hashes", "sizes", "links")).alias("pos", "x"))
    items = rows.groupBy("host", "shape", "pos").agg(
        F.max("x.paths").alias("path"),
        F.max("x.many").alias("many"),
        F.sum("x.sizes").alias("size"),
        F.sum("x.links").alias("links"),
    )
    shapes = items.groupBy("host", "shape").agg(F.sort_array(F.collect_list(F.struct("pos", "path", "many", "size", "links"))).alias("items"))
    first = shapes.select("host", F.pmod("shape", F.lit(64)).alias("salt"), F.col("shape").alias("ord"), F.to_json("items").alias("wrapper"))

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("ord")
        out: list[dict] | None = None
        for text in part["wrapper"]:
            one = [{"path": x["path"], "many": x["many"], "opt": x.get("opt", False), "size": x["size"], "links": x["links"]} for x in json.loads(text)]
            out = one if out is None else align(out, one)
        return pd.DataFrame({"host": [part["host"].iloc[0]], "ord": [part["salt"].iloc[0]], "wrapper": [json.dumps(out)]})

    some = first.groupBy("host", "salt").applyInPandas(merge, "host string, ord long, wrapper string")
    whole = some.withColumn("salt", F.lit(0)).groupBy("host").applyInPandas(merge, "host string, ord long, wrapper string")
    return whole.select("host", "wrapper")


def fixed_texts(found: DataFrame) -> DataFrame:
    """(host, fixed, firm): marks of blocks that at least half of a host's different pages
    have, two at least; ``firm`` are those of FIRM different pages or more.

    Pages with one longest block count once, so copies with small changes make nothing
    fixed. As half of the pages hold each mark, there are at most twice as many marks as
    blocks on an average page.
    """
    pages = found.where(F.size("marks") > 0)
    different = pages.select("host", "longest").distinct().groupBy("host").agg(F.count("*").alias("n"))
    marks = pages.select("host", "longest", F.explode("marks").alias("mark")).distinct()
    counted = marks.groupBy("host", "mark").agg(F.count("*").alias("c")).where("c > 1").join(different, "host").where("2 * c >= n")
    return counted.groupBy("host").agg(F.collect_list("mark").alias("fixed"), F.collect_list(F.when(F.col("c") >= FIRM, F.col("mark"))).alias("firm"))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars per row of ``pages``.

    Null and empty html and pages without main text give an empty text. Null urls and urls
    without a host share the empty host. Repeated rows give equal rows. On the only page of a
    host no text is fixed. Long pages and deep nesting are read whole.
    """
    found = written_table(streams(pages), "streams")
    made = written_table(wrappers(found).join(fixed_texts(found), "host", "left"), "wrappers")

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read: dict[str, tuple[list[dict], dict]] = {}
        for b in batches:
            out = []
            for paths, at, texts, marks, wrapper, fixed, firm in zip(*(b[c] for c in ("paths", "at", "texts", "marks", "wrapper", "fixed", "firm"))):
                if wrapper is None:
                    out.append("")
                    continue
                if wrapper not in read:
                    if len(read) > 100:
                        read.clear()
                    read[wrapper] = json.loads(wrapper), {}
                items, known = read[wrapper]
                shape = tuple(paths)
                if shape not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[shape] = chosen(list(paths), items)
                keep = known[shape]
                fixed, firm = (set() if x is None else set(x) for x in (fixed, firm))
                gone = [m in (firm if _is_main(paths[g]) else fixed) for g, m in zip(at, marks)]
                out.append(" ".join(t for g, t, drop in zip(at, texts, gone) if keep[g] and not drop))
            yield b[["page_id", "__no_key", "url"]].assign(text=out, n_chars=[len(t) for t in out])

    # The left side may be split by adaptive execution: wrappers are one row per host.
    met = found.select("page_id", "__no_key", "url", "host", "paths", "at", "texts", "marks").join(made, "host", "left").drop("host")
    return with_nulls(met.mapInPandas(pick, "page_id long, __no_key boolean, url string, text string, n_chars long"), "page_id")


def op10_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return main_text(table(spark, folder, "pages"))
