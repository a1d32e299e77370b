"""Approximate nearest neighbours with forests of sorted hash prefixes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Trees of a forest and length of their hash strings.
TREES, BITS, SEED = 64, 32, 5
#: Candidates a query asks of a block's forest, as a share of the block; what several trees find counts for
#: each of them. Vectors without much structure need many.
SHARE = 1.0
#: Vectors of an index block and queries of a query block, about. Each pair of blocks is one task's work.
INDEX_BLOCK, QUERY_BLOCK = 20_000, 4_000


class Forest:
    """Per tree the vectors' hash strings, sorted."""

    def __init__(self, vectors: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.centre = vectors.mean(0)
        self.planes = rng.normal(size=(TREES, vectors.shape[1], BITS))
        codes = self._codes(vectors)
        self.order = np.argsort(codes, axis=1, kind="stable")
        self.codes = np.take_along_axis(codes, self.order, 1)
        self.size = len(vectors)

    def _codes(self, vectors: np.ndarray) -> np.ndarray:
        weight = 1 << np.arange(BITS, dtype=np.uint64)[::-1]
        centred = vectors - self.centre
        return np.stack([(centred @ p > 0) @ weight for p in self.planes]).astype(np.uint64)

    def candidates(self, queries: np.ndarray, wanted: int, least: int):
        """Per query the vectors that share the longest prefixes.

        All trees ascend together until they have found ``wanted`` in all and ``least`` different ones, or everything.
        """
        codes = self._codes(queries)
        low = np.empty((BITS + 1, TREES, len(queries)), np.int32)
        high = np.empty_like(low)
        for level in range(BITS + 1):
            rest = np.uint64((1 << (BITS - level)) - 1)
            for t in range(TREES):
                low[level, t] = np.searchsorted(self.codes[t], codes[t] & ~rest)
                high[level, t] = np.searchsorted(self.codes[t], codes[t] | rest, "right")
        found = (high - low).sum(1)
        for q in range(len(queries)):
            level = np.flatnonzero(found[:, q] >= wanted)
            level = level[-1] if len(level) else 0
            mark = np.zeros(self.size, bool)
            while True:
                for t in range(TREES):
                    mark[self.order[t, low[level, t, q] : high[level, t, q]]] = True
                if level == 0 or np.count_nonzero(mark) >= least:
                    break
                level -= 1
            yield q, np.flatnonzero(mark)


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _search_blocks(k: int):
    def run(group: pa.Table) -> pa.Table:
        ids = np.asarray(group.column("id"))
        asks = np.asarray(group.column("asks"))
        dims = group.column("dims")[0].as_py()
        vectors = np.asarray(group.column("v").combine_chunks().flatten(), np.float64).reshape(-1, dims)
        members = group.column("members").to_pylist()
        base, queries = np.flatnonzero(~asks), np.flatnonzero(asks)
        out: list[tuple[int, int, float]] = []
        if len(base) and len(queries):
            points = vectors[base]
            forest = Forest(points)
            for q, near in forest.candidates(vectors[queries], int(SHARE * len(base)), 4 * k):
                own = int(ids[queries[q]])
                d = np.sqrt(((points[near] - vectors[queries[q]]) ** 2).sum(1))
                if len(near) > 2 * k + 2:  # members differ from place to place: keep all that can be among the first k
                    edge = np.partition(d, k + 1)[k + 1]
                    near, d = near[d <= edge], d[d <= edge]
                best = sorted((s, i) for p, s in zip(near.tolist(), d.tolist()) for i in members[base[p]] if i != own)[:k]
                out += [(own, i, s) for s, i in best]
        columns = zip(*out) if out else ((), (), ())
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("query_id", "vec_id", "score"), columns, (pa.int64(), pa.int64(), pa.float64()))})

    return run


def search(vectors: DataFrame, queries: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: each query row's ``k`` nearest other rows found, by Euclidean distance.

    ``queries`` selects the query rows. Equal vectors are indexed once, with their ``k + 1`` smallest keys, which is all
    that a ranking by distance and key can show of them. Every row is indexed, in blocks by a hash of the vector; the
    queries meet the blocks in blocks of their own, so no task holds more than one of each, however many rows there are.
    Vectors that are null, all zero, or hold a null or non-finite component take no part, nor do null keys. Vectors meet
    those of their own length only. Rows that repeat a key and a vector are one. A tie goes to the smaller key; an empty
    table gives no rows; other columns are not read.
    """
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"), queries.alias("asks")).where(F.col("id").isNotNull() & _usable(F.col("v")))
    rows = rows.withColumn("dims", F.size("v")).withColumn("h", F.xxhash64("v"))
    # the smallest keys of each vector, first among a part of its rows, so that a vector of very many rows is no one task's
    part = Window.partitionBy("h", "v", F.pmod(F.xxhash64("id"), F.lit(64))).orderBy("id")
    few = rows.select("id", "v", "dims", "h").distinct().withColumn("r", F.row_number().over(part)).where(F.col("r") <= k + 1)
    few = few.withColumn("r", F.row_number().over(Window.partitionBy("h", "v").orderBy("id"))).where(F.col("r") <= k + 1)
    index = few.groupBy("dims", "h", "v").agg(F.sort_array(F.collect_list("id")).alias("members"))
    asked = rows.where("asks").select("id", "v", "dims", "h").distinct()
    counts = rows.agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).first()
    blocks, parts = (max(1, -(-n // size)) for n, size in ((counts["n"], INDEX_BLOCK), (counts["q"], QUERY_BLOCK)))
    left = index.select("dims", F.pmod("h", F.lit(blocks)).alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("j"), F.lit(-1).cast("long").alias("id"), "v", "members", F.lit(False).alias("asks"))
    right = asked.select("dims", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("i"), F.pmod(F.xxhash64("id"), F.lit(parts)).alias("j"), "id", "v", F.array().cast("array<bigint>").alias("members"), F.lit(True).alias("asks"))
    found = left.union(right).groupBy("dims", "i", "j").applyInArrow(_search_blocks(k), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score")).withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
