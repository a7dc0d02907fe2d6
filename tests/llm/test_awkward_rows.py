"""Every operator on null and large ids, clashing columns, empty tables and repeated rows."""

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from ledgerloom.llm import bpe, decontaminate, language, licenses, packing, phrases, runs, secrets, simhash, topk, toxicity, urls, wrappers  # noqa: E402

BIG = 2**60 + 1
WORDS = " ".join(f"wort{i}x" for i in range(60))
ROWS = [(None, WORDS), (BIG, WORDS + " ende"), (BIG, WORDS + " ende"), (5, None), (6, ""), (7, "password=abcdefgh12345678 x")]
EXTRA = ["id", "score", "spans_found", "text_hash", "path", "n", "start", "length", "host", "own", "term", "fp", "no_id", "lang_pred", "shares"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "de", "s", len(t or "")) for i, t in ROWS]
    made = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
    return made.withColumns({c: F.lit(77) for c in EXTRA})


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(None, "http://a/1", "<p>one</p>"), (BIG, "http://a/2", "<p>two</p>"), (BIG, "http://a/2", "<p>two</p>"), (3, None, None)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).withColumns({c: F.lit("x") for c in EXTRA})


def items(spark):
    return spark.createDataFrame([(1, " ".join(WORDS.split()[3:20]))], "item_id int, text string")


def toxic(docs):
    labelled = docs.select("doc_id", "text", F.lit(1).alias("toxic"))
    return toxicity.score(docs, labelled, docs.select("doc_id", "text", "lang"))


OPERATORS = {
    "simhash": lambda d: simhash.near_duplicates(d),
    "one_per_component": lambda d: simhash.one_per_component(d),
    "secrets": lambda d: secrets.summary(secrets.scan(d)),
    "licenses": lambda d: licenses.licences(d.withColumn("path", F.lit("a/b"))),
    "packing": lambda d: packing.pack(d, "byte_bpe_50k.json"),
    "decontaminate": lambda d: decontaminate.contamination(d, items(d.sparkSession)),
    "language": lambda d: language.identify(d, d),
    "toxicity": toxic,
    "runs": lambda d: d.select("doc_id", runs.periodic_runs(F.col("text")).alias("r")).select("doc_id", "r.n_words", "r.runs", "r.collapsed"),
    "bpe": lambda d: d.select("doc_id", bpe.encode(F.col("text"), "byte_bpe_multi_50k.tiktoken").alias("ids")),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_ids_are_kept(docs, name):
    got = OPERATORS[name](docs)
    assert len(set(got.columns)) == len(got.columns)
    found = [r["doc_id"] for r in got.select("doc_id").collect()]
    want = [i for i, _ in ROWS]
    if name == "one_per_component":  # null and empty texts are one component, copies another
        assert sorted(found, key=str) == sorted([5, 7, BIG], key=str) or sorted(found, key=str) == sorted([5, 7, BIG, None], key=str)
    else:
        assert sorted(found, key=str) == sorted(want, key=str)
    equal = [tuple(v for c, v in r.asDict().items() if c not in ("sequence_id", "offset")) for r in got.where(F.col("doc_id") == BIG).collect()]
    assert len(set(map(str, equal))) == 1


@pytest.mark.parametrize("name", list(OPERATORS))
def test_empty_tables_give_no_rows(docs, name):
    assert OPERATORS[name](docs.limit(0)).count() == 0


def test_pages(pages):
    for op in (wrappers.main_text, urls.judge):
        got = op(pages)
        assert sorted((r["page_id"] for r in got.collect()), key=str) == sorted([None, BIG, BIG, 3], key=str)
        assert op(pages.limit(0)).count() == 0


def test_columns_of_the_input_are_kept(docs):
    kept = simhash.one_per_component(docs)
    assert kept.columns == docs.columns
    assert {tuple(r[c] for c in EXTRA) for r in kept.collect()} == {(77,) * len(EXTRA)}
    guessed = language.identify(docs, docs)
    assert guessed.select("score").dtypes == [("score", "double")] and guessed.select("id").first()[0] == 77
    assert secrets.scan(docs).where("doc_id = 7").select("spans_found", "id").first()["id"] == 77


def test_ids_of_components_and_sequences(docs):
    got = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert (BIG, BIG) in got and (6, 5) in got


def test_too_large_vectors_fail(spark):
    frame = spark.createDataFrame([(20, [3e18, 1.0]), (21, [1.0, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        topk.top_k(frame, F.col("vec_id") % 20 == 0).collect()


def test_top_k_with_ties_copies_and_lengths(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 40)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk, "_PART", 7)
    vectors = [(i, [float((i * 7 + j * 3) % 5 - 2) for j in range(4 if i % 3 else 6)]) for i in range(200)]
    vectors += [(40, [1.0] * 4), (40, [1.0] * 4), *[(1000 + i, [2.0] * 4) for i in range(90)], (BIG - BIG % 20, []), (1999, [])]
    rows = spark.createDataFrame([(i, v, 1, 2) for i, v in vectors], "vec_id long, embedding array<double>, far int, home int")
    got = sorted(tuple(r) for r in topk.top_k(rows, F.col("vec_id") % 20 == 0, 6).collect())
    want = []
    for a, (q, v) in enumerate(vectors):
        if q % 20 == 0:
            best = sorted((-sum(int(64 * x) * int(64 * y) for x, y in zip(v, w)), c) for b, (c, w) in enumerate(vectors) if b != a and len(w) == len(v))[:6]
            want += [(q, rank, c, -s) for rank, (s, c) in enumerate(best, 1)]
    assert got == sorted(want)


def test_packing_equals_the_plain_tokenizer(spark, monkeypatch):
    """Pieces join to the ids of one plain call, with one group and with many."""
    import zlib

    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    texts += [None, "", "a<|endoftext|>b <|endoftext|>", "ʼn՘ \U000323b0 x\x1c\x85y", "  two  \n\n  lines 12²³", WORDS * 50]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for size in (50_000, 37):
        got = packing.pack(rows, "byte_bpe_50k.json", group_pieces=size).collect()
        pieces, held = {}, {}
        for r in got:
            pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32, r.doc_tokens))
            held.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for doc, text in enumerate(texts):
            ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
            want = [(s, len(ids[s : s + 1024]), zlib.crc32(ids[s : s + 1024].tobytes()), len(ids)) for s in range(0, len(ids), 1024)]
            assert sorted(pieces[doc]) == want
        for parts in held.values():
            ends = [0, *(o + n for o, n in sorted(parts))]
            assert [o for o, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 1024
        if size > 37:
            assert sum(r.length for r in got) / (1024 * len(held)) > 0.98
