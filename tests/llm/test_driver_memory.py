"""What the driver holds: bitmaps and counts come to it compressed, and go when what needs them is written down."""

import random

import numpy as np
from pyspark import SparkContext

from topiclake.llm import bitmaps, ngram_join, suffix_dedup


def texts(n):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    made = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(n)]
    return [(i, made[i % (2 * n // 3)] + (" more" if i % 2 else "")) for i in range(n)]


def collected(monkeypatch, frame):
    """Bytes of the binary values in all that a driver collects from now on."""
    sizes, kind = [], type(frame)
    collect = kind.collect

    def run(self):
        rows = collect(self)
        sizes.append(sum(len(v) for r in rows for v in r if isinstance(v, (bytes, bytearray))))
        return rows

    monkeypatch.setattr(kind, "collect", run)
    return sizes


def sent(monkeypatch):
    """All that is broadcast from Python from now on."""
    found, broadcast = [], SparkContext.broadcast
    monkeypatch.setattr(SparkContext, "broadcast", lambda self, value: found.append(broadcast(self, value)) or found[-1])
    return found


def test_bitmaps_and_counts_are_collected_compressed(spark, monkeypatch):
    docs = spark.createDataFrame(texts(30), "doc_id long, text string")
    sizes = collected(monkeypatch, docs)
    values = np.arange(1000, dtype=np.int64)

    def mark(arrow):
        for batch in arrow:
            yield from bitmaps.gather([np.asarray(batch.column(0))], 24)

    [bitmap] = bitmaps.build(spark.range(1000).mapInArrow(mark, bitmaps.SCHEMA), 24, 1)
    assert bitmaps.hits(bitmap, values).all() and bitmaps.hits(bitmap, values + 1000).mean() < 0.01
    assert 0 < sum(sizes) < 100_000  # 16 segments of 128 KB
    sizes.clear()
    counts = ngram_join.count_sketch(docs, "text", 4).value
    assert counts.sum() == sum(len(ngram_join.shingles(t, 4)) for _, t in texts(30))
    assert 0 < sum(sizes) < 1_000_000  # 16 MB of counts


def test_broadcasts_go_when_their_use_is_written_down(spark, monkeypatch):
    docs = spark.createDataFrame(texts(30), "doc_id long, text string")
    found = sent(monkeypatch)
    kept = {r.doc_id for r in ngram_join.keep_one(docs).collect()}
    assert kept == {i for i, _ in texts(30) if i < 20}
    large = found[:3]  # counts and the two bitmaps of prefix shingles
    assert [b._jbroadcast.isValid() for b in large] == [False] * 3
    found.clear()
    assert suffix_dedup.remove(docs).count() == 30
    # those of the anchors and of the fragments with an answer are needed by the result
    assert [b._jbroadcast.isValid() for b in found] == [True, False, False, False, True]
