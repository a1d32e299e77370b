"""N-gram Jaccard join: a grouped prefix join over word shingles, exact at every size.

Shingles are ordered by a global count (rarest first). Two sets that reach the threshold share a shingle in their
prefixes, and documents with the same prefix and size form one group, so groups rather than documents meet on shingles.
Groups that meet are gathered round their smallest neighbour, two steps far. Within such a cluster the prefixes alone
show which groups share too few shingles to be linked; the members of the others are compared exactly, block by block.
Pairs of groups that meet on a shingle but lie in different clusters are filtered by size, position and number of shared
shingles, expanded to their members and verified one by one.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topiclake.llm import bitmaps
from topiclake.llm.bpe import batches
from topiclake.llm.common import cut, drop, modest_batches, small, written
from topiclake.llm.graph import components

#: Places of the count sketch that orders shingles. Its size is fixed; it steers how much work is done, not the result.
SKETCH_BITS, SKETCH_PARTS = 22, 64
#: Most places of the bitmap of prefix shingles that more than one group has, and of the one of documents to be compared.
SHARED_BITS, MEMBER_BITS = 27, 23
#: A block of a cluster holds about so many sets and shingles at most; pairs of blocks are compared in one task.
BLOCK_SETS, BLOCK_SHINGLES = 2000, 2_500_000
#: A block of a cluster whose prefixes are compared holds about so many names of groups at most; tasks are dealt so many.
BLOCK_NAMES, TASK_NAMES = 500_000, 100_000
#: An own name counts as so many owners of a place; a place is shared if it has one of those and any other owner.
OWN = 128
#: Shingles that more sets of a block pair have are counted by matrix products, the others pair by pair.
DENSE_FROM, DENSE_CELLS = 8, 4_000_000

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; one for a shorter text, none without words."""
    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(w) - size + 1
    h = w[:n] * _MIX[0]
    for k in range(1, size):
        h = (h ^ (h >> np.uint64(29))) * _MIX[k % len(_MIX)] + w[k : k + n]
    h ^= h >> np.uint64(32)
    return np.unique(h * _MIX[1])


def _place(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def count_sketch(docs: DataFrame, text: str, size: int) -> Broadcast:
    """Counts of all shingles of all documents by hashed place: an upper bound of each shingle's documents."""

    def count(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in batches(arrow, 1024):
            parts = [_place(shingles(t, size)) for t in batch.column(0).to_pylist()]
            found, n = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.int64), return_counts=True)
            total[found] += n.astype(np.uint32)
        rows = [(i, zlib.compress(p.tobytes(), 1)) for i, p in enumerate(np.split(total, SKETCH_PARTS)) if p.any()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["part", "counts"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(zlib.decompress(c), np.uint32).astype(np.uint64) for c in group.column("counts").to_pylist())
        return pa.table({"part": group.column("part")[:1], "counts": pa.array([zlib.compress(np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes(), 1)], pa.binary())})

    whole = np.zeros((SKETCH_PARTS, (1 << SKETCH_BITS) // SKETCH_PARTS), np.uint32)
    counted = docs.select(text).mapInArrow(count, "part int, counts binary")
    for row in counted.groupBy("part").applyInArrow(add, "part int, counts binary").collect():
        whole[row["part"]] = np.frombuffer(zlib.decompress(row["counts"]), np.uint32)
    return docs.sparkSession.sparkContext.broadcast(whole.ravel())


def prefix(h: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """The rarest shingles of a set, so many that a set linked with it shares one of them."""
    keep = len(h) - -(-percent * len(h) // 100) + 1
    return h[np.lexsort((h, counts[_place(h)]))[:keep]]


def _describe(docs: DataFrame, key: str, text: str, size: int, percent: int, sketch: Broadcast) -> DataFrame:
    """Per document: number of shingles, 128-bit digest of its set, and prefix."""

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sketch.value
        for batch in batches(arrow):
            n, sets, first, ends = [], [], [], [0]
            for t in batch.column(1).to_pylist():
                h = shingles(t, size)
                n.append(len(h))
                sets.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest() if len(h) else None)
                first.append(prefix(h, counts, percent) if len(h) else h)
                ends.append(ends[-1] + len(first[-1]))
            prefixes = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(first).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(sets, pa.binary()), prefixes], ["doc", "n", "cls", "prefix"])

    return docs.select(key, text).mapInArrow(run, "doc long, n long, cls binary, prefix array<bigint>")


def _tokens(batch: pa.RecordBatch, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of groups (gid, n, prefix): prefix shingles, the row of each, its place in the prefix, and whether the name is its own.

    Each is named twice, with the class of the group's size (its own name) and the next one. Sizes that allow a link lie
    in the same class or in neighbouring ones, so such groups share a name that is an own one of either; groups of other
    sizes do not meet.
    """
    lists = batch.column(2)
    at = np.asarray(lists.offsets)
    length = np.diff(at)
    tokens = np.asarray(lists.values)[at[0] : at[-1]].view(np.uint64)
    owner = np.repeat(np.arange(len(length)), length)
    place = np.arange(len(tokens)) - np.repeat(np.cumsum(length) - length, length)
    size = np.floor(np.log(np.asarray(batch.column(1)) + 1e-9) / -np.log(percent / 100 - 1e-6)).astype(np.uint64)[owner]
    named = np.stack([(tokens ^ (size + np.uint64(k)) * _MIX[3]) * _MIX[2] for k in (0, 1)], 1)
    return named.ravel().view(np.int64), np.repeat(owner, 2), np.repeat(place, 2), np.tile([True, False], len(tokens))


def _marks(named: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], bits: int) -> Iterator[pa.RecordBatch]:
    """What a task knows of names, given with the owner of each and whether it is an own one."""

    def used() -> Iterator[tuple[int, np.ndarray]]:
        for tokens, owner, own in named:
            for weight, pick in ((OWN, own), (1, ~own)):
                at = owner[pick].astype(np.uint64) << np.uint64(32) | bitmaps.slots(tokens[pick], bits)
                yield weight, np.unique(at).astype(np.uint32)

    return bitmaps.send_weighed(used())


def _elsewhere(tokens: np.ndarray) -> np.ndarray:
    """Other values for the same tokens, with other places in a bitmap."""
    t = tokens.view(np.uint64)
    return ((t ^ (t >> np.uint64(32))) * _MIX[4]).view(np.int64)


def _close(a: str, b: str, percent: int) -> str:
    """Whether two sizes allow a link."""
    return f"100 * {a} >= {percent} * {b} AND 100 * {b} >= {percent} * {a}"


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets[left] with sets[right]."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    owner, values = owner[order], values[order]
    starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    df = np.diff(np.r_[starts, len(values)])
    row, col = np.full(len(sets), -1), np.full(len(sets), -1)
    row[left], col[right] = np.arange(len(left)), np.arange(len(right))
    out = np.zeros((len(left), len(right)), np.int32)
    for d in np.unique(df[(df > 1) & (df <= DENSE_FROM)]):
        of = owner[starts[df == d][:, None] + np.arange(d)]
        for i in range(d):
            for j in range(d):
                if i != j:
                    r, c = row[of[:, i]], col[of[:, j]]
                    ok = (r >= 0) & (c >= 0)
                    np.add.at(out, (r[ok], c[ok]), 1)
    dense = np.flatnonzero(df > DENSE_FROM)
    step = max(1, DENSE_CELLS // len(sets))
    for at in range(0, len(dense), step):
        pick = dense[at : at + step]
        cells = np.zeros((len(sets), len(pick)), np.float32)
        sizes = df[pick]
        places = np.repeat(starts[pick], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        cells[owner[places], np.repeat(np.arange(len(pick)), sizes)] = 1
        out += (cells[left] @ cells[right].T).astype(np.int32)
    return out


def _compare_blocks(percent: int):
    """Links within a pair of blocks, as one edge for each set but the smallest of every component found."""

    def run(group: pa.Table) -> pa.Table:
        reps = group.column("rep").to_pylist()  # rows that repeat an id and a text are one more member each, and link
        sets = [np.frombuffer(b, np.uint64) for b in group.column("hashes").to_pylist()]
        side = np.array(group.column("side").to_pylist())
        one = group.column("i")[0].as_py() == group.column("j")[0].as_py()
        left = np.arange(len(sets)) if one else np.flatnonzero(side == 0)
        right = left if one else np.flatnonzero(side == 1)
        edges: list[tuple[int, int]] = []
        if len(sets) > 1 and len(left) and len(right):
            both = overlaps(sets, left, right)
            n = np.array([len(s) for s in sets])
            found = 100 * both >= percent * (n[left][:, None] + n[right][None] - both)
            parent = list(range(len(sets)))

            def root(x: int) -> int:
                while parent[x] != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            for r, c in zip(*np.nonzero(found)):
                a, b = root(int(left[r])), root(int(right[c]))
                if a != b:
                    parent[max(a, b)] = min(a, b)
            edges = [(reps[x], reps[root(x)]) for x in range(len(sets)) if root(x) != x]
        return pa.table({"a": pa.array([e[0] for e in edges], pa.int64()), "b": pa.array([e[1] for e in edges], pa.int64())})

    return run


def _short(tokens: np.ndarray, at: np.ndarray, k: int) -> list[np.ndarray]:
    """The distinct tokens of each of ``k`` owners."""
    order = np.lexsort((tokens, at))
    tokens, at = tokens[order], at[order]
    new = np.r_[True, (tokens[1:] != tokens[:-1]) | (at[1:] != at[:-1])][: len(tokens)]
    return np.split(tokens[new], np.cumsum(np.bincount(at[new], minlength=k))[:-1])


def fewest_shared(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """So many shingles of both prefixes are shared at least by linked sets of sizes ``n`` and ``m``.

    Linked sets share ``a`` shingles or more. In the order of all shingles, only n - a others of the set can lie before one
    of them, so all but the last few of the shared ones lie in its prefix, and those of the other set likewise.
    """
    a = -(-percent * (n + m) // (100 + percent))
    return a + percent * -np.maximum(n, m) // 100 + 1


def _compare_prefixes(percent: int):
    """Groups of a pair of blocks that share enough names with another one to be linked, and what to gather them round.

    A cluster of one block falls into components, each named by its smallest group; larger ones stay together.
    """

    def run(group: pa.Table) -> pa.Table:
        gid, tokens, own, n, side = (group.column(c).to_numpy() for c in ("gid", "token", "own", "n", "side"))
        gids, first, at = np.unique(gid, return_index=True, return_inverse=True)
        n, side = n[first], side[first]
        k = len(gids)
        one = group.column("i")[0].as_py() == group.column("j")[0].as_py()
        left = np.arange(k) if one else np.flatnonzero(side == 0)
        right = left if one else np.flatnonzero(side == 1)
        if k < 2 or not len(left) or not len(right):
            return pa.table({"gid": pa.array([], pa.int64()), "c": pa.array([], pa.int64())})
        # two groups of one class share own names, two of neighbouring classes own ones of the one and next ones of the other
        sets = _short(tokens[own], at[own], k) + _short(tokens[~own], at[~own], k)
        both = overlaps(sets, left, np.r_[right, right + k])
        mixed = both[:, len(right) :]
        both = both[:, : len(right)] + mixed + (mixed.T if one else overlaps(sets, left + k, right))
        p, q = n[left][:, None], n[right][None]
        ok = (100 * np.minimum(p, q) >= percent * np.maximum(p, q)) & (both >= fewest_shared(p, q, percent))
        if one:
            np.fill_diagonal(ok, False)
        found = np.zeros(k, bool)
        found[left[ok.any(1)]] = found[right[ok.any(0)]] = True
        if group.column("blocks")[0].as_py() > 1:
            c = np.full(k, group.column("c")[0].as_py())
        else:
            label, last = np.arange(k), None
            while last is None or (label != last).any():
                last = label
                label = np.minimum(label, np.where(ok, label, k).min(1))
                label = label[label]
            c = gids[label]
        return pa.table({"gid": pa.array(gids[found], pa.int64()), "c": pa.array(c[found], pa.int64())})

    return run


def _refined(x: DataFrame, percent: int, groups: int) -> DataFrame:
    """Of postings with their cluster ``c``: the groups that may have a link within it, and what to gather them round."""
    sized = x.groupBy("c", "gid").agg(F.count("*").alias("names")).groupBy("c").agg(F.count("*").alias("k"), F.sum("names").alias("names")).where("k > 1")
    blocks = F.greatest(F.ceil(2 * F.col("k") / BLOCK_SETS), F.ceil(F.col("names") / BLOCK_NAMES)).cast("int")
    sized = cut(sized.select("c", blocks.alias("blocks"), "names"), groups)
    tasks = max(x.sparkSession.sparkContext.defaultParallelism, -(-(sized.agg(F.sum(F.col("names") * F.col("blocks"))).first()[0] or 0) // TASK_NAMES))
    members = x.join(small(sized.select("c", "blocks")), "c").withColumn("block", F.pmod(F.xxhash64("gid"), F.col("blocks")).cast("int"))
    dealt = _dealt(members, "blocks", "gid", "n", "own", "token").repartition(tasks, "c", "i", "j")
    near = dealt.groupBy("c", "i", "j").applyInArrow(_compare_prefixes(percent), "gid long, c long")
    return cut(near.groupBy("gid").agg(F.min("c").alias("c")), groups)


def _dealt(members: DataFrame, *columns: str) -> DataFrame:
    """Members of clusters of some blocks, once for each pair of blocks that their own is one of."""
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return members.select("c", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("block") > F.col("other")).cast("int").alias("side"), *columns)


def _clusters(posts: DataFrame, groups: int) -> tuple[DataFrame, DataFrame]:
    """The postings, written down, and per group in them the smallest group within two steps over shared shingles."""
    posts = cut(posts)
    label = None
    for _ in range(2):
        own = posts.withColumn("c", F.col("gid")) if label is None else posts.join(small(label), "gid")
        least = own.groupBy("token").agg(F.min("c").alias("c"))
        label = cut(posts.join(least, "token").groupBy("gid").agg(F.min("c").alias("c")), groups)
    return posts, label


def describe_and_link(docs: DataFrame, key: str, text: str, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Described documents, and edges ``a``, ``b`` between document ids whose components are those of all links."""
    modest_batches(docs.sparkSession)
    sketch = count_sketch(docs, text, size)
    described = cut(_describe(docs, key, text, size, percent, sketch).withColumn("gid", F.xxhash64("n", "prefix")))
    sketch.destroy()  # what is written down needs it no more, and the driver would hold it through all steps that follow
    n_rows = described.count()
    held = described.where("doc IS NOT NULL AND n > 0")
    classes = cut(held.groupBy("cls").agg(F.min("doc").alias("rep"), F.min("n").alias("n"), F.min("gid").alias("gid")), n_rows)
    copies = held.select("cls", "doc").join(classes.select("cls", "rep"), "cls").where("doc <> rep").select(F.col("doc").alias("a"), F.col("rep").alias("b"))

    # one document for each group of those of the same prefix and size
    first = cut(classes.groupBy("gid").agg(F.min("rep").alias("doc")), n_rows)
    groups = held.join(small(first), ["gid", "doc"], "left_semi").select("gid", "n", "prefix")
    bits = bitmaps.bits_for(2 * (groups.agg(F.sum(F.size("prefix"))).first()[0] or 0), SHARED_BITS)

    # what only groups of one class name alike under the next class, they name alike under their own: it is not dealt out
    def gather(arrow: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for batch in batches(arrow):
            tokens, owner, _, own = _tokens(batch, percent)
            yield tokens, owner, own

    [shared] = bitmaps.build(groups.select("gid", "n", "prefix").mapInArrow(lambda arrow: _marks(gather(arrow), bits), bitmaps.SCHEMA), bits, OWN + 1)

    # most of what passes by chance does not pass again at other places, so it is not dealt out in the steps that follow
    def gather_again(arrow: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for tokens, owner, own in gather(arrow):
            ok = bitmaps.hits(shared, tokens)
            yield _elsewhere(tokens[ok]), owner[ok], own[ok]

    [again] = bitmaps.build(groups.select("gid", "n", "prefix").mapInArrow(lambda arrow: _marks(gather_again(arrow), bits), bitmaps.SCHEMA), bits, OWN + 1)

    def post(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(arrow):
            tokens, owner, place, own = _tokens(batch, percent)
            ok = bitmaps.hits(shared, tokens)
            ok[ok] = bitmaps.hits(again, _elsewhere(tokens[ok]))
            gid, n = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (tokens[ok], gid[owner[ok]], n[owner[ok]], place[ok], own[ok])], ["token", "gid", "n", "pos", "own"])

    posts, label = _clusters(groups.select("gid", "n", "prefix").mapInArrow(post, "token long, gid long, n long, pos long, own boolean"), n_rows)
    shared.destroy()
    again.destroy()

    x = posts.join(small(label), "gid")
    near = _refined(x, percent, n_rows)

    # members of clusters of more than one set, dealt to blocks; each pair of blocks is one task's work
    members = classes.join(small(near), "gid", "left").withColumn("c", F.coalesce("c", "gid"))
    sized = members.groupBy("c").agg(F.count("*").alias("k"), F.sum("n").alias("total"))
    blocks = F.greatest(F.ceil(F.col("k") / BLOCK_SETS), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")
    members = cut(members.join(sized.withColumn("blocks", blocks), "c").withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")), n_rows)

    # what meets across clusters: no pair of these lies in one cluster, so none is compared twice
    # most shingles are named in one cluster only; the few others are found by narrow rows before whole ones are joined
    apart = cut(x.groupBy("token").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("token"))
    x = cut(x.join(small(apart), "token", "left_semi"))
    y = x.select("token", *[F.col(c).alias(f"{c}2") for c in ("gid", "n", "pos", "own", "c")])
    most = f"100 * (1 + least(n - pos - 1, n2 - pos2 - 1)) * (100 + {percent}) >= 100 * {percent} * (n + n2)"
    enough = f"count(*) >= ({percent} * (n + n2) + {99 + percent}) DIV {100 + percent} - ({percent} * greatest(n, n2) + 99) DIV 100 + 1"  # as fewest_shared
    met = x.join(y, "token").where(f"c < c2 AND (own OR own2) AND {_close('n', 'n2', percent)}").groupBy("gid", "gid2", "n", "n2")
    across = met.agg(F.expr(f"max({most}) AND {enough}").alias("ok")).where("ok").select("gid", "gid2")
    cls = classes.select("gid", "cls")
    pairs = across.join(cls.withColumnRenamed("cls", "cls1"), "gid").join(cls.select(F.col("gid").alias("gid2"), F.col("cls").alias("cls2")), "gid2").select("cls1", "cls2")
    pairs = cut(pairs)

    def mark(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from bitmaps.gather((np.asarray(b.column(0), np.int64) for b in arrow), MEMBER_BITS)

    def reread(wanted: DataFrame) -> DataFrame:
        """Sets of the documents with the ids ``rep``, and of some chance others."""
        [bitmap] = bitmaps.build(wanted.select("rep").mapInArrow(mark, bitmaps.SCHEMA), MEMBER_BITS, 1)

        def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches(arrow, 1024):
                batch = batch.filter(batch.column(0).is_valid())
                batch = batch.filter(pa.array(bitmaps.hits(bitmap, np.asarray(batch.column(0), np.int64))))
                sets = [shingles(t, size) for t in batch.column(1).to_pylist()]
                digests = [hashlib.blake2b(h.tobytes(), digest_size=16).digest() if len(h) else None for h in sets]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary()), pa.array([h.tobytes() for h in sets], pa.binary())], ["rep", "cls", "hashes"])

        return docs.select(F.col(key).cast("long").alias(key), text).mapInArrow(run, "rep long, cls binary, hashes binary").where("cls IS NOT NULL")

    several = members.where("k > 1").select("cls", "rep", "c", "block", "blocks")
    dealt = reread(several).join(small(several), ["cls", "rep"])
    within = _dealt(dealt, "rep", "hashes").groupBy("c", "i", "j").applyInArrow(_compare_blocks(percent), "a long, b long")

    def verify(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(arrow):
            one, two = ([np.frombuffer(v, np.uint64) for v in batch.column(i).to_pylist()] for i in (2, 3))
            ok = pa.array([linked(p, q, percent) for p, q in zip(one, two)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(ok)

    ends = cut(pairs.select(F.explode(F.array("cls1", "cls2")).alias("cls")).distinct().join(classes.select("cls", "rep"), "cls"))
    ends = cut(reread(ends).join(ends, ["cls", "rep"]).dropDuplicates(["cls"]).select("cls", "rep", "hashes"))
    met = pairs.join(ends.toDF("cls1", "a", "h1"), "cls1").join(ends.toDF("cls2", "b", "h2"), "cls2")
    across = met.select("a", "b", "h1", "h2").mapInArrow(verify, "a long, b long")
    return described, copies.union(within).union(across)


def join(docs: DataFrame, size: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, ``n_shingles`` and ``component_id``, the smallest id reachable by links.

    Two documents link when 100 * intersection >= ``percent`` * union of their sets of ``size``-word shingles. Null
    text and text without words have an empty set and no link. A null key takes no part and has a null component;
    rows that repeat a key are one node with all their sets. Keys must be whole numbers. Other columns are not read;
    an empty table gives no rows. Exact copies meet as one set, so they cost no pairs.
    """
    with written() as made:
        described, edges = describe_and_link(docs, key, text, size, percent)
    parts = components(edges)
    drop(*(t for t in made if t is not described))
    out = described.select(F.col("doc").alias(key), F.col("n").alias("n_shingles")).join(parts.withColumnRenamed("node", key), key, "left")
    return out.select(key, "n_shingles", F.coalesce("component", key).alias("component_id"))


def _gone(docs: DataFrame, size: int, percent: int, key: str, text: str) -> DataFrame:
    """Keys of the documents that are not the smallest of their component, all that stays on disk of the join."""
    with written() as made:
        gone = cut(join(docs, size, percent, key, text).where(F.col(key) != F.col("component_id")).select(key).distinct())
    drop(*(t for t in made if t is not gone))
    return gone


#: Above all usual keys: where the further texts of repeated keys are numbered from.
FURTHER = 1 << 62


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, that of the smallest id, with its columns; null keys stay.

    A document is a key with a text. Rows that repeat both are one, and any of them stays. Different texts under one key
    go or stay each for itself: the one of the smallest hash has the key's place, the others rank behind all other keys.
    """
    known = docs.select(F.col(key).cast("long").alias("_k")).where("_k IS NOT NULL")
    repeated = cut(known.groupBy("_k").agg(F.count("*").alias("n")).where("n > 1").select("_k"))
    if repeated.isEmpty():
        drop(repeated)
        gone = _gone(docs, size, percent, key, text)
        return docs.join(gone, key, "left_anti").select(*docs.columns)
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col(key).cast("long").alias("_k"), F.col(text).alias("_t"))
    again = rows.join(small(repeated), "_k", "left_semi").dropDuplicates(["_k", "_t"])
    again = cut(again.select("_row", "_k", "_t", F.monotonically_increasing_id().alias("_i")))
    first = again.groupBy("_k").agg(F.min_by("_i", F.struct(F.xxhash64("_t"), "_i")).alias("_first"))
    further = again.join(first, "_k").select("_row", F.when(F.col("_i") == F.col("_first"), F.col("_k")).otherwise(F.col("_i") + FURTHER).alias("_k"), "_t")
    nodes = rows.join(small(repeated), "_k", "left_anti").select("_row", "_k", "_t").union(further)
    gone = _gone(nodes, size, percent, "_k", "_t")
    return nodes.join(gone, "_k", "left_anti").select("_row.*")
