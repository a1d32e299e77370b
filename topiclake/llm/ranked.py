"""Ranked lexical search without random access: lists sorted by impact are read in turn until every answer is settled.

Documents are dealt over shards. A shard holds the lists of the query terms in its documents, sorted by impact, and keeps
of every document seen an interval: what its read entries add up to, and that plus the last impact read of each list where
it was not seen yet. Reading goes on until no other document can reach the first k and those are known exactly.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from topiclake.llm.bpe import batches
from topiclake.llm.common import cut

#: Text of the items that are answered together, about, each with some bytes of its own; it bounds what every task is sent.
ITEM_BYTES, BYTES_PER_ITEM = 32 << 20, 64
#: Entries of a shard's lists, about.
SHARD_ENTRIES = 1_000_000
#: One of so many shards is answered first; what it finds is a floor for the others.
FLOOR_SHARDS = 16
#: Entries that are first read of each list; every turn reads twice as many as the one before.
FIRST_READ = 64
#: Fixed values of the score.
SCALE, TF_SCALE, TF_WEIGHT, LENGTH_WEIGHT, LENGTH_SHARE = 1000, 1_000_000_000, 1000, 20, 50

#: Terms are runs of ASCII letters and digits and of everything beyond ASCII; only A-Z is lower-cased.
_LETTERS = bytes((b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32) for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text, in order."""
    return text.encode().translate(_LETTERS).split() if text else []


def weight(documents: int, holding: int) -> int:
    return math.floor(SCALE * math.log((2 * documents + 2) / (2 * holding + 1)))


def lengths(n: np.ndarray, documents: int, words: int) -> np.ndarray:
    """A document's length against the mean, as the score takes it; the product may exceed 64 bits on the way."""
    return np.array([100 - LENGTH_SHARE + LENGTH_SHARE * x * documents // words for x in n.tolist()], np.int64)


def impacts(weights: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term adds to a document's score."""
    return weights * (TF_SCALE * tf // (TF_WEIGHT * tf + LENGTH_WEIGHT * m))


def read_lists(lists: list[tuple[np.ndarray, np.ndarray]], size: int, k: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a shard (by number) that can be among the first ``k`` of score above 0 and ``floor`` at least, with scores.

    ``lists`` are pairs of documents and impacts, the greatest first; no other access to them is needed. At the end every
    returned document's interval is one number and every other document's lies below the k-th, so ties are all there.
    """
    lower = np.zeros(size, np.int64)
    at, depth, bar = [0] * len(lists), FIRST_READ, max(floor, 1)
    last = [int(impact[0]) for _, impact in lists]
    live: np.ndarray | None = None  # once nothing unseen can get in: the documents that still can
    while True:
        for i, (docs, impact) in enumerate(lists):
            stop = min(at[i] + depth, len(docs))
            if at[i] < stop:
                lower[docs[at[i] : stop]] += impact[at[i] : stop]
                at[i], last[i] = stop, int(impact[stop - 1])
            if stop == len(docs):
                last[i] = 0
        depth *= 2
        among = lower if live is None else lower[live]
        if len(among) > k:
            bar = max(bar, int(np.partition(among, len(among) - k)[len(among) - k]))
        unread = sum(last)
        if live is None:
            if unread >= bar:
                continue
            live = np.flatnonzero(lower)
        # an unfinished list where a document was seen adds nothing more to it; sums stay far below 2**53
        parts = [(docs[: at[i]], last[i]) for i, (docs, _) in enumerate(lists) if last[i]]
        settled = np.zeros(size) if not parts else np.bincount(np.concatenate([d for d, _ in parts]), np.repeat([x for _, x in parts], [len(d) for d, _ in parts]), size)
        gap = unread - settled[live]
        can = lower[live] + gap >= bar
        live = live[can]
        if not gap[can].any():
            return live, lower[live]


class Shard:
    """The lists of one shard's documents."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, size: int):
        order = np.lexsort((-impact, term))
        self.term, self.doc, self.impact, self.size = term[order], doc[order], impact[order], size

    def first(self, terms: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        low, high = np.searchsorted(self.term, terms), np.searchsorted(self.term, terms, "right")
        return read_lists([(self.doc[a:b], self.impact[a:b]) for a, b in zip(low, high) if a < b], self.size, k, floor)


def _answer(index: DataFrame, items: Broadcast, weights: Broadcast, floors: Broadcast, totals: tuple[int, int], k: int) -> DataFrame:
    def run(group: pa.Table) -> pa.Table:
        tids, tfs = group.column("tids").combine_chunks(), group.column("tfs").combine_chunks()
        doc = np.repeat(np.arange(group.num_rows), np.diff(np.asarray(tids.offsets)))
        term, tf = np.asarray(tids.flatten()).astype(np.int64), np.asarray(tfs.flatten()).astype(np.int64)
        m = lengths(np.asarray(group.column("n")), *totals)
        shard = Shard(term, doc, impacts(weights.value[term], tf, m[doc]), group.num_rows)
        found = [(i, *shard.first(terms, k, int(floors.value[i]))) for i, terms in enumerate(items.value)]
        docs = np.concatenate([d for _, d, _ in found])
        scores = np.concatenate([s for *_, s in found])
        item = np.repeat([i for i, *_ in found], [len(d) for _, d, _ in found])
        return pa.table({"item": pa.array(item, pa.int32()), "doc": group.column("doc").take(pa.array(docs)), "row": group.column("row").take(pa.array(docs)), "score": pa.array(scores)})

    kind = index.schema["doc"].dataType.simpleString()
    return index.groupBy("shard").applyInArrow(run, f"item int, doc {kind}, row long, score long")


def _first(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"), "row"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _answer_block(docs: DataFrame, asked: list[Row], k: int, shard_entries: int) -> DataFrame:
    """Answers to a bounded block of items, by their number in ``asked``."""
    spark = docs.sparkSession
    wanted = [sorted(set(terms_of(r["text"]))) for r in asked]
    number = {t: i for i, t in enumerate(sorted(set().union(*wanted)))}
    vocabulary = spark.sparkContext.broadcast(number)

    def look(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches(arrow, 1024):
            rows = []
            for t in batch.column(1).to_pylist():
                counts = Counter(terms_of(t))
                mine = counts.keys() & known.keys()
                rows.append((counts.total(), [known[w] for w in mine], [counts[w] for w in mine]))
            kinds = (pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]], ["doc", "n", "tids", "tfs"])

    kind = docs.schema["doc"].dataType.simpleString()
    # the row's number holds only while this table is written; everything later reads it from there
    index = cut(docs.mapInArrow(look, f"doc {kind}, n long, tids array<int>, tfs array<int>").withColumn("row", F.monotonically_increasing_id()))
    totals = index.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.size("tids")), F.lit(0))).first()
    holding = np.zeros(len(number), np.int64)
    counted = index.select(F.explode("tids").alias("t")).groupBy("t").count().toArrow()
    holding[np.asarray(counted.column("t"))] = np.asarray(counted.column("count"))
    weights = spark.sparkContext.broadcast(np.array([weight(totals[0], int(h)) for h in holding], np.int64))
    items = spark.sparkContext.broadcast([np.array([number[t] for t in terms], np.int64) for terms in wanted])
    shards = max(1, -(-totals[2] // shard_entries))
    index = index.where(F.size("tids") > 0).withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
    floors = spark.sparkContext.broadcast(np.zeros(len(asked), np.int64))
    early = F.col("shard") % FLOOR_SHARDS == 0
    found = cut(_first(_answer(index.where(early), items, weights, floors, totals[:2], k), k))
    if shards > 1:
        low = np.zeros(len(asked), np.int64)
        for r in found.where(F.col("rank") == k).select("item", "score").collect():
            low[r["item"]] = r["score"]
        floors = spark.sparkContext.broadcast(low)
        rest = _answer(index.where(~early), items, weights, floors, totals[:2], k)
        found = _first(found.drop("rank").union(rest), k)
    return found


def search(docs: DataFrame, items: DataFrame, k: int = 50, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", item_bytes: int = ITEM_BYTES, shard_entries: int = SHARD_ENTRIES) -> DataFrame:
    """Item, ``rank``, key and ``score``: each item's ``k`` best documents of a score above 0, ties by ascending key.

    Items are answered in blocks of bounded text, so what a task is sent does not grow with their number; documents are
    read whole. Every row of ``docs`` is a document, also one that repeats a key (the row read first wins a full tie) or has
    none (null keys rank last among equals). Null text has no terms. Rows that repeat an item are one item; an item
    without terms, or an empty table, gives no rows. Other columns are not read, so their names cannot clash.
    """
    spark = docs.sparkSession
    read = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    asked = items.select(F.col(item).alias("item"), F.col(item_text).alias("text")).where("text IS NOT NULL").distinct()
    blocks = max(1, -(-(asked.agg(F.sum(F.octet_length("text") + BYTES_PER_ITEM)).first()[0] or 0) // item_bytes))
    kinds = items.schema[item].dataType.simpleString(), docs.schema[key].dataType.simpleString()
    out = []
    for block in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()
        if own:
            names = spark.createDataFrame([(i, r["item"]) for i, r in enumerate(own)], f"item int, name {kinds[0]}")
            found = _answer_block(read, own, k, shard_entries)
            out.append(found.join(F.broadcast(names), "item").select(F.col("name").alias(item), "rank", F.col("doc").alias(key), "score"))
    if not out:
        return spark.createDataFrame([], f"`{item}` {kinds[0]}, rank int, `{key}` {kinds[1]}, score long")
    first, *rest = out
    for more in rest:
        first = first.union(more)
    return first
