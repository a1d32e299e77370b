"""Nulls in every column, empty and long texts, repeated rows, empty tables and clashing column names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from topiclake.llm import bpe, chunked_bpe, language, ngram_join, packing, quality, ranked, secrets, suffix_dedup, toxicity
from topiclake.llm.queries import RANKS, TOKENIZER

CLASHING = ("k", "row", "_row", "_id", "_text", "doc", "mark", "n", "cls", "gid", "prefix", "c", "words", "_words", "path", "value", "score", "kept", "n_words", "start", "ids", "t", "y", "component_id", "_gone", "_hits", "_clean")
ROWS = [
    (1, "Some words that make a text of its own, said once.", "en", "s", 5), (1, "Some words that make a text of its own, said once.", "en", "s", 5),
    (2, None, None, None, None), (3, "", "en", "s", 0), (None, "No key but some words, and a few more words.", "de", None, 1), (None, None, None, None, None),
    (4, " \n\t ", "en", "s", 3), (5, "word " * 60_000, "en", "s", 300_000), (6, "x" * 200_000, None, "s", 200_000), (7, "12345 67890 !!!", "en", "s", 15),
]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING)])


OPERATORS = {
    "bpe": lambda d: bpe.digests(d, TOKENIZER),
    "bpe ids": lambda d: bpe.encode(d, TOKENIZER),
    "chunked bpe": lambda d: chunked_bpe.digests(d, RANKS, chunk=1000, overlap=50),
    "chunked bpe ids": lambda d: chunked_bpe.decode(chunked_bpe.encode(d, RANKS), RANKS),
    "ranked search": lambda d: ranked.search(d, d, item="doc_id", key="doc_id"),
    "language": lambda d: language.predict(d, language.train(d)),
    "packing": lambda d: packing.pack(d, TOKENIZER),
    "join": lambda d: ngram_join.join(d),
    "keep one": lambda d: ngram_join.keep_one(d),
    "suffix": lambda d: suffix_dedup.digests(d),
    "suffix removal": lambda d: suffix_dedup.remove(d),
    "quality": lambda d: quality.measure(d),
    "quality filter": lambda d: quality.keep_good(d),
    "secrets": lambda d: secrets.scan(d),
    "redaction": lambda d: secrets.redact(d),
    "toxicity": lambda d: toxicity.score(d, toxicity.train(d, d.select("doc_id", (F.col("doc_id") % 2).alias("toxic")))),
}
ONE_ROW_EACH = {"chunked bpe", "bpe", "bpe ids", "language", "join", "suffix", "suffix removal", "quality", "redaction", "toxicity"}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(odd, name):
    got = OPERATORS[name](odd).collect()
    assert not (name in ONE_ROW_EACH and len(got) != len(ROWS))


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(odd, name):
    empty = odd.limit(0)
    assert OPERATORS[name](empty).count() == 0


def test_defined_results(odd):
    lang = language.predict(odd, None).collect()
    assert {r["lang_pred"] for r in lang} == {"und"}
    joined = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.join(odd).collect()}
    assert {(2, 0, 2), (3, 0, 3), (4, 0, 4), (None, 0, None)} <= joined
    spans = [tuple(r)[:4] for r in suffix_dedup.digests(odd).collect()]
    assert (2, 0, 0, 0) in spans and (1, 50, 0, 0) in spans
    packed = [r for r in packing.pack(odd, TOKENIZER).collect() if r["doc_id"] == 2]
    assert [(r["start"], r["length"], r["doc_tokens"]) for r in packed] == [(0, 1, 1)]


def test_pipeline_stages(spark, odd):
    docs = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == odd.columns
    assert docs.count() == 0  # nothing here is long and good enough
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == 0


def test_pipeline_keeps_clean_documents(spark):
    import random

    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9)))
    clean = [(i, ". ".join(" ".join(word() for _ in range(12)) for _ in range(12)) + ".", "en", "s", 1) for i in range(30)]
    passage = " ".join(word() for _ in range(60)) + "."
    rows = [*clean, (100, clean[3][1], "en", "s", 1), (101, clean[4][1] + " tail.", "en", "s", 1), (102, "short", "en", "s", 1), (103, clean[5][1][::-1].replace(".", ". ") + passage, "en", "s", 1), (104, clean[6][1][::-1].replace(".", ". ") + passage, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert {100, 101, 103, 104} <= set(kept["quality_rules"]) and 102 not in kept["quality_rules"]
    assert set(range(30)) | {103, 104} == set(kept["ngram_jaccard_join"])
    last = kept["secret_scan"]
    assert all(last[i] == t for i, t, *_ in clean) and passage in last[103] and passage not in last[104]
