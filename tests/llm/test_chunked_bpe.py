"""Overlapping chunks against the library that the rank files are for."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from topiclake.llm import chunked_bpe
from topiclake.llm.queries import RANKS

RNG = random.Random(4)
ODD = ["".join(RNG.choice("ab é\n\t  'sdt1²Ⅷ😀ß<|\x1c\x85​") for _ in range(n)) for n in (0, 1, 5, 39, 40, 41, 47, 48, 49, 200, 900)]
ODD += ["a" * 500, "ab cd " * 100, " " * 300, "x " + " " * 200 + "y" * 200 + "'re" * 50, "we're they'll " * 60, "中" * 200 + "。" * 90, "1" * 100 + "!" * 100 + "z" * 100]


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def digest(library, text):
    ids = library.encode_ordinary(text or "")
    raw = library.decode_bytes(ids)
    assert raw == (text or "").encode()
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(raw).hexdigest()


def test_merges_equal_the_library(library):
    ranks = chunked_bpe.Ranks(RANKS)
    for text in [*ODD, "a" * 50_000, "theing" * 3000]:
        assert np.frombuffer(ranks.encode(text), "<u4").tolist() == library.encode_ordinary(text)
        assert ranks.decode(ranks.encode(text)) == text.encode()


def test_sure_boundaries_are_those_of_the_whole_text():
    ranks = chunked_bpe.Ranks(RANKS)
    for text in ODD:
        whole = set(ranks.boundaries(text, True))
        for size in range(1, min(len(text), 60)):
            assert whole.issuperset(ranks.boundaries(text[:size], size == len(text)))


@pytest.mark.parametrize("chunk, overlap", [(40, 8), (64, 5), (16_384, 256)])
def test_digests(spark, library, chunk, overlap):
    rows = [*enumerate(ODD), (900, None), (None, "no key " * 30), (7, "repeated key " * 30), (7, "repeated key " * 30), (901, "long one " * 30_000 if chunk > 1000 else "x y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, chunked_bpe.digests(docs, RANKS, chunk=chunk, overlap=overlap).collect()), key=str)
    assert got == sorted(((k, *digest(library, t)) for k, t in rows), key=str)


def test_pieces_rejoin(spark, library):
    rows = [(i, t) for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS row", "2 AS start", "3 AS piece", "4 AS k")
    pieces = chunked_bpe.decode(chunked_bpe.encode(docs, RANKS, chunk=40, overlap=8), RANKS).collect()
    assert any(r["start"] > 0 for r in pieces)
    for k, t in rows:
        own = sorted((r["start"], r["ids"], bytes(r["decoded"])) for r in pieces if r["doc_id"] == k)
        assert [i for _, ids, _ in own for i in ids] == library.encode_ordinary(t)
        assert b"".join(raw for *_, raw in own) == t.encode()


def test_given_documents(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r["doc_id"]: tuple(r)[1:] for r in chunked_bpe.digests(docs, RANKS, chunk=1000, overlap=40).collect()}
    assert got == {r["doc_id"]: digest(library, r["text"]) for r in docs.collect()}


def test_empty_table(spark):
    assert chunked_bpe.digests(spark.createDataFrame([], "doc_id long, text string"), RANKS).count() == 0
