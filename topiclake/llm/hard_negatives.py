"""Hard-negative mining over blocks of candidates on a Hilbert curve, with the smallest and largest value of each dimension.

Candidates are sorted by label and their place on the curve and written as Parquet rows of many vectors each, with a zone
map: per dimension the least and greatest component. From it interval arithmetic bounds the inner product of a vector with
everything in a block, so a window of scores is searched only in blocks whose bounds reach into it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topiclake.llm.common import cut, small

#: Vectors of a block, at most, and components of one; blocks that a task writes, about.
BLOCK_ROWS, BLOCK_COMPONENTS, TASK_BLOCKS = 2048, 1 << 20, 8
#: Bits of each dimension on the curve, and standard deviations around the mean that they divide.
CURVE_BITS, CURVE_SPREAD = 4, 3.0
#: Components of all windows that are searched together, about; it bounds what is sent to every task.
BATCH_COMPONENTS = 1 << 22
#: Windows that meet a block at a time within a task.
TURN = 1024
#: So many blocks, at most, are asked for by number; more are joined.
LISTED_BLOCKS = 1000
#: Block numbers are the task's number above this many bits and a running number below.
TASK_SHIFT = 32
NONE, ALL = np.iinfo(np.int64).min, np.iinfo(np.int64).max
#: Whole numbers below this are exact as doubles.
EXACT = 2**53


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of cells (rows) of a grid of ``2**bits`` steps a side, as bytes that sort alike."""
    x = cells.T.astype(np.int64)
    n = len(x)
    step = 1 << (bits - 1)
    while step > 1:
        rest = step - 1
        for i in range(n):
            high = (x[i] & step) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & rest)
            x[0] ^= np.where(high, rest, swap)
            x[i] ^= swap
        step >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.int64)
    step = 1 << (bits - 1)
    while step > 1:
        turn ^= np.where((x[-1] & step) != 0, step - 1, 0)
        step >>= 1
    x ^= turn
    planes = np.stack([(x >> b) & 1 for b in range(bits - 1, -1, -1)])
    return np.packbits(planes.reshape(bits * n, -1).T.astype(np.uint8), axis=1)


def _matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), dims)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact; beyond 64 bits there is no score to give, which is an error."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    reach = a.shape[1] * max(-int(a.min()), int(a.max())) * max(-int(b.min()), int(b.max()))
    if reach < EXACT:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if reach > ALL:
        raise OverflowError("inner products beyond 64 bits")
    return a.astype(np.int64) @ b.T.astype(np.int64)


def bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each row of ``q`` with anything between the vectors ``low`` and ``high``."""
    up, down = np.maximum(q, 0).astype(np.float64), np.minimum(q, 0).astype(np.float64)
    least, most = up @ low + down @ high, up @ high + down @ low
    slack = np.where(np.maximum(np.abs(least), np.abs(most)) < EXACT / 4, 0.0, np.inf)  # rounded sums bound nothing
    return least - slack, most + slack


def first_of(scores: np.ndarray, ids: np.ndarray, owner: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of each owner's ``k`` best (greatest score, then smallest id), by owner, and their rank from 0."""
    order = np.lexsort((ids, -scores, owner))
    own = owner[order]
    new = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, np.int64)
    rank = np.arange(len(own)) - np.repeat(new, np.diff(np.r_[new, len(own)]))
    return order[rank < k], rank[rank < k]


BLOCK_SCHEMA = "block long, dims int, label_lo long, label_hi long, low binary, high binary, ids binary, labels binary, asks binary, kind string, q binary"


def _blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    """Rows of ``id``, ``label``, ``q``, ``asks`` and ``dims`` as written blocks with their zone maps."""
    total = lambda values: F.sum(F.aggregate(values, F.lit(0.0), lambda a, x: a + x))
    spread = rows.groupBy("dims").agg(F.sum("dims").alias("n"), total("q").alias("s"), total(F.transform("q", lambda x: x.cast("double") * x)).alias("s2"))
    spread = spread.select("dims", F.try_divide("s", "n").alias("mean"), F.try_divide("s2", "n").alias("square"))

    def place(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow:
            sizes = np.asarray(batch.column("dims"))
            keys: list[bytes] = [b""] * batch.num_rows
            for d in np.unique(sizes[sizes > 0]):
                at = np.flatnonzero(sizes == d)
                part = batch.take(pa.array(at))
                mean, square = (np.asarray(part.column(c))[:, None] for c in ("mean", "square"))
                reach = CURVE_SPREAD * np.sqrt(np.maximum(square - mean**2, 1e-12))
                steps = (_matrix(part.column("q"), int(d)) - mean + reach) / (2 * reach) * (1 << CURVE_BITS)
                for i, key in zip(at, hilbert_keys(np.clip(steps, 0, (1 << CURVE_BITS) - 1).astype(np.int64), CURVE_BITS)):
                    keys[i] = key.tobytes()
            columns = [batch.column(c) for c in ("dims", "label", "id", "asks", "q")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(keys, pa.binary())], ["dims", "label", "id", "asks", "q", "key"])

    placed = rows.join(spread, "dims").mapInArrow(place, "dims int, label long, id long, asks boolean, q array<bigint>, key binary")
    parts = max(1, -(-rows.count() // (block_rows * TASK_BLOCKS)))
    # equal vectors are told apart by their ids, so a vector of very many rows is no one task's
    ordered = placed.repartitionByRange(parts, "dims", "label", "key", "id").sortWithinPartitions("dims", "label", "key", "id")

    def build(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << TASK_SHIFT
        held: tuple[np.ndarray, ...] | None = None  # q, ids, labels, asks

        def block(part: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            nonlocal number
            q, ids, labels, asks = (x[np.argsort(part[1], kind="stable")] for x in part)
            reach = max(-int(q.min()), int(q.max())) if q.size else 0
            kind = "<i2" if reach < 1 << 15 else "<i4" if reach < 1 << 31 else "<i8"
            low, high = (q.min(0), q.max(0))
            row = [number, q.shape[1], int(labels.min()), int(labels.max()), *(x.astype("<i8").tobytes() for x in (low, high, ids, labels)), asks.astype(np.uint8).tobytes(), kind, q.astype(kind).tobytes()]
            number += 1
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 5, pa.string(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], [f.split()[0] for f in BLOCK_SCHEMA.split(", ")])

        for batch in arrow:
            sizes = np.asarray(batch.column("dims"))
            for d in np.unique(sizes):
                part = batch.take(pa.array(np.flatnonzero(sizes == d)))
                new = (_matrix(part.column("q"), int(d)), *(np.asarray(part.column(c)) for c in ("id", "label", "asks")))
                if held is not None and held[0].shape[1] != d:
                    yield block(held)
                    held = None
                held = new if held is None else tuple(np.concatenate(x) for x in zip(held, new))
                most = max(1, min(block_rows, BLOCK_COMPONENTS // max(1, int(d))))
                while held is not None and len(held[1]) >= most:
                    yield block(tuple(x[:most] for x in held))
                    held = tuple(x[most:] for x in held) if len(held[1]) > most else None
        if held is not None:
            yield block(held)

    return cut(ordered.mapInArrow(build, BLOCK_SCHEMA))


def _content(row: dict) -> tuple[np.ndarray, ...]:
    """Vectors, ids, labels and marks of the askers of a block."""
    ids, labels = (np.frombuffer(row[c], "<i8") for c in ("ids", "labels"))
    return np.frombuffer(row["q"], row["kind"]).reshape(len(ids), row["dims"]), ids, labels, np.frombuffer(row["asks"], np.uint8) == 1


def _rows(arrow: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in arrow:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _askers(blocks: DataFrame, k: int) -> DataFrame:
    """Rows that ask, as windows of scores: from the ``k``-th best of the same label in the own block (if any) upwards."""

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(arrow):
            q, ids, labels, asks = _content(row)
            at = np.flatnonzero(asks)
            floor = np.full(len(at), NONE)
            for start in range(0, len(at), TURN):
                own = at[start : start + TURN]
                other = (labels[own][:, None] == labels) & (ids[own][:, None] != ids)
                scores = np.where(other, products(q[own], q), NONE)
                if len(ids) >= k:
                    floor[start : start + TURN] = np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k]
            ends = pa.array(np.arange(len(at) + 1) * q.shape[1], pa.int32())
            vectors = pa.ListArray.from_arrays(ends, pa.array(q[at].astype(np.int64).ravel()))
            columns = [np.full(len(at), row["block"]), ids[at], labels[at], np.full(len(at), row["dims"], np.int32), floor, np.full(len(at), ALL)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), vectors], ["place", "id", "label", "dims", "lo", "hi", "q"])

    return blocks.select("block", "dims", "ids", "labels", "asks", "kind", "q").mapInArrow(run, "place long, id long, label long, dims int, lo long, hi long, q array<bigint>")


def _written(windows: DataFrame, batch_components: int) -> DataFrame:
    """Windows in the order of the curve, with a number each and the part they lie in, written."""
    parts = max(1, -(-4 * (windows.agg(F.sum(F.col("dims") + 8)).first()[0] or 0) // batch_components))
    return cut(windows.repartitionByRange(parts, "place", "id").withColumns({"no": F.monotonically_increasing_id(), "part": F.spark_partition_id()}))


class Batch:
    """Windows of one vector length, and the best that was found for each so far."""

    def __init__(self, part: pa.Table, dims: int, k: int, same: bool):
        self.no, self.id, self.label, self.lo, self.hi = (np.asarray(part.column(c)) for c in ("no", "id", "label", "lo", "hi"))
        self.q, self.k, self.same = _matrix(part.column("q").combine_chunks(), dims), k, same
        self.scores, self.found = np.full((len(self.no), k), NONE), np.full((len(self.no), k), ALL)

    def needing(self, row: dict) -> np.ndarray:
        """Windows that must read a block: its labels may do, and its bounds reach into what is still open."""
        low, high = np.frombuffer(row["low"], "<i8"), np.frombuffer(row["high"], "<i8")
        if self.same:
            can = (self.label >= row["label_lo"]) & (self.label <= row["label_hi"])
        else:
            can = (self.label != row["label_lo"]) | (row["label_lo"] != row["label_hi"])
        at = np.flatnonzero(can)
        least, most = bounds(self.q[at], low, high)
        return at[(most >= np.maximum(self.lo, self.scores[:, -1])[at]) & (least <= self.hi[at])]

    def read(self, row: dict) -> None:
        q, ids, labels, _ = _content(row)
        need = self.needing(row)
        for start in range(0, len(need), TURN):
            w = need[start : start + TURN]
            s = products(self.q[w], q)
            ok = ((self.label[w][:, None] == labels) == self.same) & (self.id[w][:, None] != ids)
            ok &= (s >= np.maximum(self.lo[w], self.scores[w, -1])[:, None]) & (s <= self.hi[w][:, None])
            if len(ids) > self.k:
                ok &= s >= np.partition(np.where(ok, s, NONE), len(ids) - self.k, axis=1)[:, len(ids) - self.k][:, None]
            own, at = np.nonzero(ok)
            touched = np.unique(own)
            old, slot = np.nonzero(self.scores[w[touched]] != NONE)
            owner = np.r_[own, touched[old]]
            scores, found = np.r_[s[own, at], self.scores[w[touched]][old, slot]], np.r_[ids[at], self.found[w[touched]][old, slot]]
            best, rank = first_of(scores, found, owner, self.k)
            self.scores[w[owner[best]], rank], self.found[w[owner[best]], rank] = scores[best], found[best]

    def result(self) -> pa.RecordBatch:
        own, slot = np.nonzero(self.scores != NONE)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (self.no[own], self.scores[own, slot], self.found[own, slot])], ["no", "score", "found"])


def _batches(sent: Broadcast, k: int, same: bool) -> dict[int, Batch]:
    whole = sent.value
    sizes = np.asarray(whole.column("dims"))
    return {int(d): Batch(whole.take(pa.array(np.flatnonzero(sizes == d))), int(d), k, same) for d in np.unique(sizes)}


def _search(blocks: DataFrame, windows: DataFrame, k: int, same: bool, batch_components: int) -> DataFrame:
    """``no``, ``rank``, ``found`` and ``score``: of each window the ``k`` best other rows of the same label, or of another.

    Windows are taken in batches of bounded size that lie together on the curve. A first look at the zone maps alone tells
    which blocks any window of a batch must read; within a task a window's bar rises with what it has found.
    """
    spark = blocks.sparkSession
    batches: list[list[int]] = []
    room = 0
    for r in windows.groupBy("part").agg(F.sum(F.col("dims") + 8).alias("n")).orderBy("part").collect():
        if not batches or r["n"] > room:
            batches.append([])
            room = batch_components
        batches[-1].append(r["part"])
        room -= r["n"]
    out = []
    for parts in batches:
        sent = spark.sparkContext.broadcast(windows.where(F.col("part").between(parts[0], parts[-1])).select("no", "id", "label", "dims", "lo", "hi", "q").toArrow())

        def choose(arrow: Iterator[pa.RecordBatch], sent: Broadcast = sent) -> Iterator[pa.RecordBatch]:
            asked = _batches(sent, k, same)
            for row in _rows(arrow):
                need = row["dims"] in asked and len(asked[row["dims"]].needing(row)) > 0
                yield pa.RecordBatch.from_arrays([pa.array([row["block"]] if need else [], pa.int64())], ["block"])

        def read(arrow: Iterator[pa.RecordBatch], sent: Broadcast = sent) -> Iterator[pa.RecordBatch]:
            asked = _batches(sent, k, same)
            for row in _rows(arrow):
                if row["dims"] in asked:
                    asked[row["dims"]].read(row)
            yield from (batch.result() for batch in asked.values())

        chosen = cut(blocks.select("block", "dims", "label_lo", "label_hi", "low", "high").mapInArrow(choose, "block long"))
        listed = [r["block"] for r in chosen.limit(LISTED_BLOCKS + 1).collect()]
        asked = blocks.where(F.col("block").isin(listed)) if len(listed) <= LISTED_BLOCKS else blocks.join(small(chosen), "block")
        out.append(cut(asked.mapInArrow(read, "no long, score long, found long")))
    if not out:
        return spark.createDataFrame([], "no long, rank int, found long, score long")
    rank = F.row_number().over(Window.partitionBy("no").orderBy(F.desc("score"), "found"))
    return reduce(DataFrame.union, out).withColumn("rank", rank).where(F.col("rank") <= k).select("no", "rank", "found", "score")


def mine(
    vectors: DataFrame, anchors: Column, key: str = "vec_id", vector: str = "embedding", label: Column | str = "label", scale: int = 256, positives: int = 5, negatives: int = 3,
    low: int = 50, high: int = 95, block_rows: int = BLOCK_ROWS, batch_components: int = BATCH_COMPONENTS,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    ``anchors`` selects the anchor rows. Components count as ``floor(scale * x)``, scores are inner products of those. Each
    anchor's positives are its best other rows of the same label; for each of them the best rows of other labels come back
    whose score lies between ``low`` and ``high`` percent of the positive's. Ties go to the smaller key. Rows whose key,
    label, vector or any component is null or not finite take no part; vectors meet those of their own length only. Rows
    that repeat key, label and vector are one; "other" rows have another key. Scores beyond 64 bits are an error. An empty
    table gives no rows; other columns are not read.
    """
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")), F.lit(False)))
    kept = vectors.select(F.col(key).cast("long").alias("id"), (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"), F.col(vector).alias("v"), F.coalesce(anchors, F.lit(False)).alias("asks"), finite.alias("finite"))
    kept = kept.where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL AND finite")
    rows = cut(kept.select("id", "label", "asks", F.transform("v", lambda x: F.floor(x.cast("double") * scale)).alias("q")).distinct().withColumn("dims", F.size("q")))
    blocks = _blocks(rows, block_rows)
    asked = _written(_askers(blocks, positives), batch_components)
    near = _search(blocks, asked, positives, True, batch_components).select("no", F.col("found").alias("positive_id"), F.col("score").alias("positive_score"))
    share = lambda p: F.col("positive_score") * p
    windows = asked.drop("lo", "hi", "part").join(near, "no").drop("no")
    rounded = {"lo": share(low) + F.pmod(-share(low), F.lit(100)), "hi": share(high) - F.pmod(share(high), F.lit(100))}  # up, and down
    windows = windows.withColumns({name: F.call_function("div", x, F.lit(100)) for name, x in rounded.items()})
    windows = _written(windows.where("lo <= hi"), batch_components)
    far = _search(blocks, windows, negatives, False, batch_components)
    pairs = windows.select("no", F.col("id").alias("anchor_id"), "positive_id", "positive_score")
    return far.join(pairs, "no").select("anchor_id", "positive_id", "rank", F.col("found").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
