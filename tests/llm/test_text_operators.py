"""Runs, phrases and byte-pair tokens against plain versions."""

import base64
import collections
import hashlib
import random
import re
import sys
import zlib
from pathlib import Path

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from ledgerloom.llm import bpe, phrases, runs  # noqa: E402

BIG = 2**60 + 1
MULTI = "byte_bpe_multi_50k.tiktoken"
EXTRA = "doc_id long, text string, lang string, runs string, phrase int, ids int, start int, f int, n int, score double"


def docs_of(spark, rows):
    """Documents (doc_id, text, lang) with columns named like the operators' own."""
    return spark.createDataFrame([(*r, "x", 1, 2, 3, 4, 5, 0.5) for r in rows], EXTRA)


def stored(spark, tmp_path, rows):
    docs_of(spark, rows).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def plain_runs(w):
    n, out = len(w), []
    for i in range(n):
        for j in range(i + 6, n + 1):
            s = w[i:j]
            q = next(q for q in range(1, len(s) + 1) if s[q:] == s[: len(s) - q])
            grows = (i > 0 and w[i - 1] == w[i - 1 + q]) or (j < n and w[j] == w[j - q])
            if len(s) >= max(6, 4 * q) and not grows:
                out.append((i, j - i, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_agree_with_all_stretches():
    rng = random.Random(5)
    for k in range(700):
        w = [rng.choice([b"a", b"b", b"c"][: rng.randint(1, 3)]) for _ in range(rng.randint(0, 40))]
        if k % 2:
            at = rng.randint(0, len(w))
            w[at:at] = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(rng.randint(1, 6))] * rng.randint(2, 7)
        assert runs.find_runs(w) == plain_runs(w), w


def test_long_runs():
    words = [b"%d" % (i % 5000) for i in range(60000)]
    assert runs.find_runs(words) == [(0, 60000, 5000)]
    assert runs.find_runs([b"x"] * 300000 + [b"y"]) == [(0, 300000, 1)]
    assert runs.find_runs([b"%d" % i for i in range(50000)]) == []


def plain_op11(doc, text):
    w = (text or "").encode().split()
    n, h = len(w), None if doc is None else zlib.crc32(str(doc).encode())
    if n and h is not None and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = plain_runs(w)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    top = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    milli = 1000 * top[1] // top[2] if found else None
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    return (doc, len(found), *top, milli, sha(lines), sha(b" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_op11_against_plain_version(spark, tmp_path):
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 70))), "en") for i in range(150)]
    rows += [(None, "la " * 9, None), (BIG, "x y " * 12 + " z", "en"), (BIG, "x y " * 12 + " z", "en"), (7, None, "en"), (8, "", None), (9, " \t\n", "en"), (11, "é b é b " * 5, "fr")]
    got = runs.op11_periodic_runs(spark, stored(spark, tmp_path, rows))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str(plain_op11(i, t)) for i, t, _ in rows)


def test_op11_on_an_empty_table(spark, tmp_path):
    assert runs.op11_periodic_runs(spark, stored(spark, tmp_path, [])).count() == 0


def plain_phrases(rows, least, most):
    sums, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, 6):
                sums[lang].update(" ".join(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in sums.items():
        n, listed = totals[lang], []
        cands = {p: a for p, a in f.items() if " " in p and a >= least}
        for p, a in cands.items():
            w = p.split(" ")
            if any(len(q) > len(p) and f" {p} " in f" {q} " and 100 * b >= 100 * a for q, b in cands.items()):
                continue
            cuts = [(1000 * a * n // (f[" ".join(w[:k])] * f[" ".join(w[k:])]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            listed.append((-score, -a, p.encode(), f[" ".join(w[:k])], f[" ".join(w[k:])]))
        out += [(lang, i, p.decode(), -a, x, y, n, -s) for i, (s, a, p, x, y) in enumerate(sorted(listed)[:most], 1)]
    return sorted(map(str, out))


@pytest.mark.parametrize("least, most", [(100, 2000), (20, 7), (3, 2000)])
def test_phrases_against_plain_version(spark, least, most):
    rng = random.Random(least)
    vocabulary = ["the", "The", "a\x01", "a", "b", "ab", "é", " x", "New", "York", "city,", "hall.", "co\to", "\x00", "x!y"]
    rows = []
    for i in range(120):
        lang = ["en", "de", None, "und", "a\nb"][i % 5]
        text = " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60))) + rng.choice(["", " new york city hall now", "\r\nNew  York"]) * rng.randint(0, 4)
        rows.append((i if i % 9 else None, text, lang))
    rows += [rows[0]] * 5 + [(1, None, "en"), (2, "", "en"), (3, "solo", "xx"), (4, "la " * 400, "en")]
    got = phrases.collocations(docs_of(spark, rows), least, most)
    assert sorted(str(tuple(r)) for r in got.collect()) == plain_phrases(rows, least, most)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_phrases_cross_shards_ranges_and_lists(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice("abcd") for _ in range(200)), "en") for i in range(30)]
    monkeypatch.setattr(phrases, "TEXT_BYTES", 64)
    listed = [(f, b) for _, text, _ in rows[:3] for f, b in phrases.tokens(text)]
    assert sum(b for _, b in listed) == 600 and len(listed) > 3
    shard = phrases.Shard(2, 2, phrases.np.ones(phrases.BITMAP_BITS, bool), None)
    for found, begun in listed:
        shard.add("en", found, begun)
    ngrams = [r for b in shard.ngrams() for r in b.to_pylist()]
    want = collections.Counter(t[i : i + 3] for _, t, _ in rows[:3] for i in range(0, len(t) - 2, 2))
    assert {r["phrase"]: r["n"] for r in ngrams} == want and [r["phrase"] for r in ngrams] == sorted(want)
    texts = ("a b c", "a b c d", "a b c\x01 x", "a b c\x00 x", "a b d e f", "a b c d")
    docs = spark.createDataFrame([("en", t, 1) for t in texts], "lang string, phrase string, n long")
    got = {r.phrase: r.f for r in phrases.united(docs, 3, 2).collect()}
    assert got == {"a b c": 3, "a b c d": 2}


def test_phrases_of_nothing(spark):
    assert phrases.collocations(docs_of(spark, [])).count() == 0
    assert phrases.collocations(docs_of(spark, [(1, None, None), (2, "..", "en"), (3, "one two", "en")])).count() == 0


@pytest.fixture(scope="module")
def library():
    lines = open(public_tokenizers.path(MULTI), "rb")
    ranks = {base64.b64decode(t): int(i) for t, i in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


AWKWARD = ["a", "aa", "b", "the", " ", "  ", "\n", "\t", "é", "ß", "漢字", "😀", "🏳️‍🌈", "\x1c", "\x85", "​", "'s", "'ll", "1", "23", "²",
           "\U00033000", "՘", "\U000105c0", "..", "--", "_", "ÿ", "ing", "tion", " in", "er", "ers", "<|endoftext|>", "\x00"]


def test_bpe_equals_the_library(library):
    rng = random.Random(11)
    texts = ["".join(rng.choice(AWKWARD) for _ in range(rng.randint(0, 25))) for _ in range(4000)]
    texts += ["".join(rng.choice("abcdeinorst") for _ in range(rng.randint(1, 60))) for _ in range(4000)]
    texts += [rng.choice("aeoа -=") * rng.randint(1, 500) for _ in range(200)] + ["word " * 250_000]
    for text in texts:
        ids = bpe.encode_text(text, MULTI)
        assert list(ids) == library.encode_ordinary(text), text[:100]
        assert bpe.decode_ids(ids, MULTI) == text


def test_every_token_is_compiled(library):
    merges = bpe._merges(MULTI)
    write = bpe.Transducer(merges).write
    for token in random.Random(2).sample(sorted(merges.ranks), 4000):
        for _ in range(3):  # by guesses, compiled, remembered
            assert [merges.tokens[i] for i in write(token)] == merges.merged(token)


def test_memories_may_be_cleared(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 16)
    monkeypatch.setattr(bpe, "PIECES", 4)
    pieces, cut = bpe._Pieces(bpe.Merges(bpe._merges(MULTI).ranks)), bpe._Cut(public_tokenizers.PATTERN)
    text = "memories come and go, unforgettableness stays behind the quizzical éclairs " * 3
    assert [int(i) for p in cut(text) for i in bpe.np.frombuffer(pieces[p], bpe.np.int32)] == library.encode_ordinary(text)


def test_streaming_decoder_mends_broken_bytes(library):
    rng, merges = random.Random(3), bpe._merges(MULTI)
    for k in range(5000):
        ids = [rng.randrange(50256) if k % 2 else merges.ranks[bytes([rng.randrange(256)])] for _ in range(rng.randint(0, 12))]
        assert bpe.decode_ids(ids, MULTI) == b"".join(merges.tokens[i] for i in ids).decode("utf-8", "replace")
        decoder, cut, held, out = bpe.Decoder(merges), len(ids) // 2, b"", ""
        for part in (ids[:cut], ids[cut:]):
            text, held = decoder.feed(part, held)
            out += text
        assert out + ("�" if held else "") == bpe.decode_ids(ids, MULTI)
    assert bpe.decode_ids([10**6], MULTI) == "�"


def test_op13_against_the_library(spark, tmp_path, library):
    rows = [(1, None, "en"), (2, "", None), (None, "null id", "en"), (BIG, "Hello  world 123\n", "en"), (BIG, "Hello  world 123\n", "en"), (5, "日本語 😀 " * 400, None), (6, "a" * 5000, "en")]
    got = bpe.op13_bpe(spark, stored(spark, tmp_path, rows))
    want = []
    for i, text, _ in rows:
        ids = library.encode_ordinary(text or "")
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode_bytes(ids))))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    coded = spark.createDataFrame([(None,), ("",), ("two words",)], "text string").select(bpe.encode(F.col("text"), MULTI).alias("ids"))
    assert [r.ids for r in coded.collect()] == [[], [], library.encode_ordinary("two words")]
    assert [r[0] for r in coded.select(bpe.decode(F.col("ids"), MULTI)).collect()] == ["", "", "two words"]
    odd = spark.createDataFrame([([None, 64],), (None,)], "ids array<int>").select(bpe.decode(F.col("ids"), MULTI))
    assert [r[0] for r in odd.collect()] == [bpe.decode_ids([64], MULTI), None]


def test_op13_on_an_empty_table(spark, tmp_path):
    assert bpe.op13_bpe(spark, stored(spark, tmp_path, [])).count() == 0
