"""What stays on disk: tables and shuffles of steps that are over go, and bitmaps let few values pass however full they are."""

import os
import random
import time
from pathlib import Path

import corpus_pipeline
import numpy as np
import pytest

from topiclake.llm import bitmaps, common, ngram_join, suffix_dedup


def texts(n):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    parts = [" ".join(rng.choice(words) for _ in range(25)) for _ in range(n)]
    return [(i, " ".join(rng.sample(parts, 3))) for i in range(n)]


def tables(spark):
    return set(os.listdir(common.shared_root(spark).removeprefix("file:")))


def shuffles(spark):
    dirs = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
    return {f.name for d in dirs for f in Path(d).rglob("shuffle_*")}


def test_bitmap_holds_only_values_of_several_owners(spark):
    many, shared = 1 << 21, 1000  # twice as many values of one owner as the bitmap has places

    def mark(arrow):
        for batch in arrow:
            yield from bitmaps.send([bitmaps.slots(np.asarray(batch.column(0)), 28)], 8)

    ids = spark.range(many).union(spark.range(shared)).repartition(4)
    [bitmap] = bitmaps.build(ids.mapInArrow(mark, bitmaps.SCHEMA), 20, 2, finer=8)
    values = np.arange(2 * many, dtype=np.int64)
    assert bitmaps.hits(bitmap, values[:shared]).all()
    assert bitmaps.hits(bitmap, values[shared:]).mean() < 0.05


def test_suffix_dedup_leaves_one_table_and_no_shuffle(spark):
    setting = spark.conf.get(common._CLEANUP_SETTING)
    docs = spark.createDataFrame(texts(60), "doc_id long, text string")
    had, moved = tables(spark), shuffles(spark)
    spans = suffix_dedup.repeated_spans(docs)
    assert len(tables(spark) - had) == 1  # the spans
    until = time.time() + 20
    while shuffles(spark) - moved and time.time() < until:
        time.sleep(0.2)
    assert not shuffles(spark) - moved
    assert spans.count() > 0
    assert spark.conf.get(common._CLEANUP_SETTING) == setting


@pytest.mark.parametrize("again", [0, 3])
def test_near_duplicates_leave_few_tables(spark, again):
    made = texts(60)
    rows = made + [(60 + i, t) for i, t in made[:20]] + [(i, f"{i} " + t) for i, t in made[30 : 30 + again]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").cache()
    had = tables(spark)
    kept = ngram_join.keep_one(docs)
    # keys that go; where keys repeat, these and their rows too
    assert len(tables(spark) - had) == (3 if again else 1)
    assert {r.doc_id for r in kept.collect()} == set(range(60))


def test_pipeline_keeps_one_stage_on_disk(spark, tmp_path):
    rng = random.Random(10)
    words = "the of and to in is that it with for on was as by the people water city river station".split()
    sentence = lambda: " ".join(rng.choice(words) for _ in range(12)).capitalize() + "."
    rows = [(i, "\n".join(sentence() for _ in range(12)), "en", "web", 0) for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    had = tables(spark)
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert len(tables(spark) - had) == 1  # what the last stage reads
    assert packed.count() > 0
