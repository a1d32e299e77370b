"""Interval reading against scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from topiclake.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    counts = [(key, Counter(terms(t))) for key, t in docs]
    n_docs, n_terms = sum(1 for _, c in counts if c), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        wanted, scored = set(terms(text)), []
        for at, (key, c) in enumerate(counts):
            m = 100 - 50 + 50 * c.total() * n_docs // max(1, n_terms)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in wanted & c.keys())
            if score > 0:
                scored.append((-score, key is None, key or 0, at, key))
        out += [(item, i + 1, s[4], -s[0]) for i, s in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def found(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS item", "2 AS rank", "3 AS score", "4 AS doc", "5 AS row")
    i = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id", "2 AS item")
    return sorted(map(tuple, ranked.search(d, i, **options).collect()), key=str)


def test_terms():
    for text in ["", "Ab-cÄÉ_9 x\x7fy\x00z", "ÀB 中文。Ⅷ a", "[\\]^`{|}~@/:", "\x80\x85\xa0b"]:
        assert [t.decode() for t in ranked.terms_of(text)] == terms(text)
    assert ranked.terms_of(None) == []


@pytest.mark.parametrize("k", [1, 3, 50])
def test_reading_settles_all(k):
    rng = np.random.default_rng(k)
    for size in (1, 40, 3000):
        for spread in (1, 3, 10**9):
            lists, scores = [], np.zeros(size, np.int64)
            for _ in range(rng.integers(1, 12)):
                docs = rng.permutation(size)[: rng.integers(1, size + 1)]
                impact = np.sort(rng.integers(0, spread + 1, len(docs)))[::-1]
                lists.append((docs, impact))
                scores[docs] += impact
            docs, got = ranked.read_lists(lists, size, k)
            assert (scores[docs] == got).all()
            kth = max(1, np.sort(scores)[-k] if size >= k else 1)
            assert set(np.flatnonzero(scores >= kth)) == set(docs[got >= kth])
            floor = int(kth) + 1
            assert set(np.flatnonzero(scores >= floor)) == set(ranked.read_lists(lists, size, k, floor)[0])


@pytest.mark.parametrize("options", [{}, {"shard_entries": 40}, {"shard_entries": 300, "item_bytes": 400, "k": 3}])
def test_search(spark, options):
    rng = random.Random(5)
    words = ["the", "The", "of", "a", "é", "naïve", "zebra", "42", *(f"w{i}" for i in range(30))]
    text = lambda n: rng.choice(" -,\n").join(rng.choice(words[: rng.randint(1, len(words))]) for _ in range(n))
    docs = [(i, text(rng.randint(1, 60))) for i in range(150)]
    docs += [(1000 + i, docs[7][1]) for i in range(60)] + [(None, docs[7][1]), (None, "zebra"), (3, "the same key"), (3, "the same key"), (2000, None), (2001, ""), (2002, "--"), (2003, "the " * 5000)]
    items = [(0, docs[7][1]), (1, "the"), (2, "zebra zebra"), (3, "unknown"), (4, None), (5, ""), (6, text(30)), (6, "of a"), (1, "the"), (None, "w3 w4"), (7, "the of a " * 40)]
    assert found(spark, docs, items, **options) == brute(docs, items, options.get("k", 50))


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a b")]) == []
    assert found(spark, [(1, "a b")], []) == []
    assert found(spark, [(1, "a b")], [(1, "--")]) == []
