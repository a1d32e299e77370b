"""Exact substring dedup: suffixes are sorted bucket by bucket, long ties resolved by ranks of a difference cover.

Every stretch of ``length`` bytes is a suffix cut at that depth. Its anchor, the smallest hash of the short grams inside
it, depends on its bytes alone, so equal stretches have equal anchors and meet in one bucket. Only anchors that more than
one document has are looked at, and bytes are sent only where the surroundings of an anchor differ between documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topiclake.llm import bitmaps
from topiclake.llm.bpe import batches
from topiclake.llm.common import cut, drop, modest_batches, shuffles_cleared

GRAM = 20
#: Stretches that share an anchor, at most: what was found of them is one number, 31 bits below the first one's place.
SPAN = 31
#: Most places of the bitmaps that spare anchors of one document, fragments that need not be compared or were sent by
#: another owner, and fragments without an answer the way through a shuffle; smaller inputs take smaller ones.
ANCHOR_BITS, MIXED_BITS, FRAGMENT_BITS = 28, 28, 28
#: Documents of an anchor are counted by places so many bits finer than its bitmap's: only anchors that several documents
#: have take a place of the bitmap, and others pass where they meet one by chance.
FINER = 8
#: Places a value in the bitmaps that follow the one of anchors: what passes them by chance is sent and sorted in vain.
PLACES = 16
#: An anchor of so many different surroundings is dealt by its stretches rather than as one bucket.
HOT_FRAGMENTS = 20_000
#: Fragments of a bucket, about; a task sorts one bucket and one alignment at a time.
BUCKET_FRAGMENTS = 20_000
#: Bytes of texts that are hashed together: so many that work per text hardly counts, so few that a processor keeps them near.
TOGETHER = 1 << 16
# A difference cover; any two residues have a cover residue at the same distance behind both.
COVER_MOD, COVER = 13, (0, 1, 3, 9)

_A = 0x9E3779B97F4A7C15
_TABLE = np.random.default_rng(11).integers(1, 2**63, 256, np.uint64) | np.uint64(1)


def _gram(length: int) -> int:
    if length < GRAM:
        raise ValueError(f"strings of {GRAM} bytes at least")
    return max(GRAM, length - SPAN + 1)


def gram_hashes(text: np.ndarray, q: int) -> np.ndarray:
    """64-bit hashes of all ``q``-byte grams, by doubling."""
    power = _TABLE[text]
    size, done, out = 1, 0, None
    while True:
        if q & size:
            if out is None:
                out, done = power, size
            else:
                n = len(text) - done - size + 1
                out = out[:n] * np.uint64(pow(_A, size, 2**64)) + power[done : done + n]
                done += size
        size *= 2
        if size > q:
            break
        n = len(text) - size + 1
        power = power[:n] * np.uint64(pow(_A, size // 2, 2**64)) + power[size // 2 : size // 2 + n]
    out = out ^ (out >> np.uint64(31))
    out = out * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(29))


def joined(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Texts in runs of some bytes: number of the first, bytes of all, and where each ends."""
    held, size, first = [], 0, 0
    for i, text in enumerate(texts):
        held.append(text.encode("utf-8", "replace"))
        size += len(held[-1])
        if size >= TOGETHER or i + 1 == len(texts):
            yield first, np.frombuffer(b"".join(held), np.uint8), np.cumsum([len(t) for t in held])
            held, size, first = [], 0, i + 1


def anchors_of(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts that lie one behind the other: anchor hashes, first stretch that has the anchor, number of such stretches, place of the anchor, text."""
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return empty.view(np.uint64), empty, empty, empty, empty
    h = gram_hashes(data, _gram(length))
    window = length - _gram(length) + 1
    least = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    reach = 1
    while 2 * reach <= window:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if window > reach:
        least = np.minimum(least[: reach - window], least[window - reach :])
    # no stretch goes on into the next text
    edge = np.zeros(len(data) + 1, np.int32)
    np.add.at(edge, np.maximum(ends - length + 1, np.r_[0, ends[:-1]]), 1)
    np.subtract.at(edge, ends, 1)
    start = np.flatnonzero(np.cumsum(edge[: len(least)]) == 0)
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)[start]
    new = np.flatnonzero(np.r_[True, at[1:] != at[:-1]][: len(at)])
    first, at = start[new], at[new]
    return h[at], first, np.diff(np.r_[new, len(start)]), at, np.searchsorted(ends, first, "right")


def anchors(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The same of one text."""
    return anchors_of(np.frombuffer(text, np.uint8), np.array([len(text)]), length)[:4]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, made once for the longest text of a worker."""
    if len(_POWERS[0]) < n:
        n = max(n, 2 * len(_POWERS[0]), 1 << 16)
        for i, base in enumerate((_A, pow(_A, -1, 2**64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS[0], _POWERS[1]


_POWERS = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def fragments(data: np.ndarray, ends: np.ndarray, length: int, wanted: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, ...]:
    """Of the anchors whose hashes are wanted: hash, first stretch (in all bytes), number of stretches, place of the anchor in the fragment, fragment key, text.

    The fragment is all bytes of the anchor's stretches; its key is a hash of them and of the anchor's place.
    """
    h, first, count, at, text = anchors_of(data, ends, length)
    if len(h):
        ok = wanted(h)
        h, first, count, at, text = h[ok], first[ok], count[ok], at[ok], text[ok]
    if not len(h):
        return h.view(np.int64), first, count, at, h.view(np.int64), text
    up, down = _powers(len(data))
    sums = np.r_[np.uint64(0), np.cumsum(_TABLE[data] * up[: len(data)])]
    key = (sums[first + count - 1 + length] - sums[first]) * down[first]
    key = (key ^ (key >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9) + (count * 64 + at - first).view(np.uint64) * np.uint64(0x94D049BB133111EB)
    key = (key ^ (key >> np.uint64(29))) * np.uint64(0xFF51AFD7ED558CCD)
    return h.view(np.int64), first, count, at - first, (key ^ (key >> np.uint64(32))).view(np.int64), text


def _joint(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of pairs of numbers."""
    x = a.view(np.uint64) ^ (b.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(27))).view(np.int64)


def sort_buckets(hashes: np.ndarray, place: np.ndarray, pieces: list[bytes], owner: np.ndarray, length: int) -> list[np.ndarray]:
    """Of fragments: for each of their stretches the smallest owner of an equal one.

    Fragments lie aligned at their anchors, so the stretches at one distance from the anchor form one bucket of
    suffixes, sorted at a time. A key is the bytes before the next place of the cover, that place's rank, made once for
    all buckets, and the bytes behind.
    """
    lead = length - _gram(length)
    width = lead + length
    n = len(pieces)
    sizes = np.array([len(p) for p in pieces])
    start = lead - place
    flat = np.frombuffer(b"".join(pieces), np.uint8)
    row = np.repeat(np.arange(n), sizes)
    column = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(start, sizes)
    cells = np.zeros((n, width), np.uint8)
    cells[row, column] = flat
    stop = start + sizes
    _, group = np.unique(hashes, return_inverse=True)

    def packed(rows: np.ndarray, a: int, b: int) -> list[np.ndarray]:
        out = []
        for at in range(a, b, 8):
            part = cells[rows, at : min(at + 8, b)]
            word = np.zeros((len(rows), 8), np.uint8)
            word[:, : part.shape[1]] = part
            out.append(word.view(">u8").ravel().astype(np.uint64))
        return out

    def order(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        by = np.lexsort(keys[::-1])
        new = np.zeros(len(by), bool)
        new[:1] = True
        for k in keys:
            new[1:] |= k[by][1:] != k[by][:-1]
        return by, new

    def alike(have: np.ndarray, a: int, b: int) -> np.ndarray:
        """Fragments that share these bytes with another of their anchor."""
        rows, shared = np.flatnonzero(have), np.zeros(n, bool)
        if len(rows):
            by, new = order([group[rows], *packed(rows, a, b)])
            run = np.cumsum(new) - 1
            shared[rows[by]] = np.bincount(run)[run] > 1
        return shared

    # a stretch reaches half of the rest or more to one side of its anchor, so fragments alone on both sides equal no other
    half, behind = (lead + 1) // 2, width - lead
    live = alike(start <= lead - half, lead - half, lead) | alike(stop >= behind + half, behind, behind + half)
    gap = max(b - a for a, b in zip(COVER, (*COVER[1:], COVER_MOD)))
    depth = length - gap + 1  # a sample at most gap - 1 behind a stretch's start ends within it
    ranks = {}
    for c in range(lead + gap):
        if c % COVER_MOD in COVER:
            rows = np.flatnonzero(live & (start <= c) & (stop >= c + depth))
            rank = np.full(n, -1)
            if len(rows):
                by, new = order([group[rows], *packed(rows, c, c + depth)])
                rank[rows[by]] = np.cumsum(new)
            ranks[c] = rank
    least = np.repeat(owner[:, None], lead + 1, 1)
    for c in range(lead + 1):
        rows = np.flatnonzero(live & (start <= c) & (stop >= c + length))
        if not len(rows):
            continue
        sample = next(x for x in range(c, c + gap) if x in ranks)
        by, new = order([group[rows], *packed(rows, c, sample), ranks[sample][rows], *packed(rows, sample + depth, c + length)])
        low = np.minimum.reduceat(owner[rows][by], np.flatnonzero(new))
        least[rows[by], c] = low[np.cumsum(new) - 1]
    return [least[i, start[i] : stop[i] - length + 1] for i in range(n)]


def _bitmap(values: DataFrame, most: int) -> Broadcast:
    """A bitmap of a table of one column, or of the joint hashes of two."""
    bits = bitmaps.bits_for(values.count(), most, PLACES)

    def mark(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ([np.asarray(c) for c in b.columns] for b in arrow)
        yield from bitmaps.gather((_joint(*c) if len(c) > 1 else c[0] for c in columns), bits)

    return bitmaps.build(values.mapInArrow(mark, bitmaps.SCHEMA), bits, 1)[0]


def _batch(columns: list[list], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def repeated_spans(docs: DataFrame, length: int = 50, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc``, ``mark`` (hash of the text) and ``hits``: places of stretches found in a smaller document, 31 in a number."""
    modest_batches(docs.sparkSession)
    with shuffles_cleared(docs.sparkSession):
        return _spans(docs, length, key, text)


def _spans(docs: DataFrame, length: int, key: str, text: str) -> DataFrame:
    read = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"), F.xxhash64(text).alias("mark")).where("doc IS NOT NULL AND text IS NOT NULL")

    anchor_count = 2 * (read.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // (length - _gram(length) + 1)
    bits = bitmaps.bits_for(anchor_count, ANCHOR_BITS)
    fine = bits + FINER

    def owners(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def used() -> Iterator[np.ndarray]:
            for batch in batches(arrow, 1024):
                for _, data, ends in joined(batch.column(0).to_pylist()):
                    h, _, _, _, text = anchors_of(data, ends, length)
                    yield np.unique(text.view(np.uint64) << np.uint64(fine) | bitmaps.slots(h, fine)) & np.uint64((1 << fine) - 1)

        yield from bitmaps.send(used(), FINER)

    [shared] = bitmaps.build(read.select("text").mapInArrow(owners, bitmaps.SCHEMA), bits, 2, finer=FINER)

    # one row per distinct fragment, with its smallest and largest owner; of the anchor 32 bits, which tell enough here
    def classes(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(arrow, 1024):
            keys, hashes, docs_, ids = [], [], [], np.asarray(batch.column(0))
            for at, data, ends in joined(batch.column(1).to_pylist()):
                h, _, _, _, k, text = fragments(data, ends, length, lambda h: bitmaps.hits(shared, h))
                keys.append(k)
                hashes.append(h)
                docs_.append(ids[at + text])
            key, h, d = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, hashes, docs_))
            order = np.lexsort((d, key))
            key, h, d = key[order], h[order], d[order]
            new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
            last = np.r_[new[1:], len(key)][: len(new)] - 1
            yield _batch([key[new], (h[new] >> 32).astype(np.int32), d[new], d[last]], ["fragment", "anchor", "lo", "hi"], [pa.int64(), pa.int32(), pa.int64(), pa.int64()])

    known = read.mapInArrow(classes, "fragment long, anchor int, lo long, hi long").groupBy("fragment").agg(F.min("anchor").alias("anchor"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    known = cut(known)
    # anchors with several surroundings: only there do bytes have to meet, each fragment's from its smallest owner
    n_known = known.count()
    several = cut(known.groupBy("anchor").agg(F.count("*").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("n > 1 AND lo < hi").select("anchor", "n"), n_known)
    mixed = cut(known.join(several.select("anchor"), "anchor").select("fragment", "lo", "hi"), n_known)
    senders = [_bitmap(mixed.where(c).select("fragment", "lo"), MIXED_BITS) for c in ("lo = hi", "lo < hi")]
    near = _bitmap(several.select(F.col("anchor").cast("long")), MIXED_BITS)
    # few: each has many of the fragments
    stretched = np.array([r["anchor"] for r in several.where(F.col("n") >= HOT_FRAGMENTS).select("anchor").collect()], np.int64)
    buckets = max(1, -(-mixed.count() // BUCKET_FRAGMENTS))

    names = ["deal", "anchor", "place", "piece", "fragment", "skip", "lo", "hi"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]

    def pieces(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(arrow, 1024):
            rows, seen, ids = [], set(), np.asarray(batch.column(0))
            for at, data, ends in joined(batch.column(1).to_pylist()):
                h, first, count, place, key, text = fragments(data, ends, length, lambda h: bitmaps.hits(near, h.view(np.int64) >> 32))
                if not len(key):
                    continue
                doc = ids[at + text]
                own = _joint(key, doc)
                one, many = (bitmaps.hits(b, own) for b in senders)
                hot = np.isin(h >> 32, stretched)
                raw = data.tobytes()
                for i in np.flatnonzero(one | many).tolist():
                    d, k, f, n, p, a = int(doc[i]), int(key[i]), int(first[i]), int(count[i]), int(place[i]), int(h[i])
                    if (k, d) in seen:
                        continue
                    seen.add((k, d))
                    owner = (d, 2**62 if many[i] else d)
                    if hot[i]:
                        # an anchor of very many surroundings is dealt by its stretches, so no bucket has to hold them all
                        parts = [raw[f + s : f + s + length] for s in range(n)]
                        rows += [(xxhash.xxh3_64_intdigest(part) - 2**63, a, p - s, part, k, s, *owner) for s, part in enumerate(parts)]
                    else:
                        rows.append((a, a, p, raw[f : f + n - 1 + length], k, 0, *owner))
            yield _batch(list(zip(*rows)) or [()] * 8, names, kinds)

    sent = read.mapInArrow(pieces, "deal long, anchor long, place int, piece binary, fragment long, skip int, lo long, hi long")

    def sort(group: pa.Table) -> pa.Table:
        lo, hi = np.asarray(group.column("lo")), np.asarray(group.column("hi"))
        found = sort_buckets(np.asarray(group.column("anchor")), np.asarray(group.column("place")).astype(np.int64), group.column("piece").to_pylist(), lo, length)
        # a fragment that several documents sent by chance has one answer
        named = {(f, k): i for i, (f, k, m) in enumerate(zip(*(group.column(c).to_pylist() for c in ("fragment", "skip")), found)) if m.min() < hi[i]}
        use = list(named.values())
        least = [found[i] if (found[i] != found[i][0]).any() else found[i][:1] for i in use]
        return pa.table({
            "fragment": group.column("fragment").take(pa.array(use, pa.int64())), "skip": group.column("skip").take(pa.array(use, pa.int64())),
            "run": pa.array([len(found[i]) for i in use], pa.int32()), "least": pa.array([m.tolist() for m in least], pa.list_(pa.int64())),
        })

    sorted_ = sent.withColumn("bucket", F.pmod(F.xxhash64("deal"), F.lit(buckets))).groupBy("bucket").applyInArrow(sort, "fragment long, skip int, run int, least array<bigint>")
    # a fragment whose anchor has one surrounding is answered by its own smallest owner
    alone = known.where("lo < hi").join(several, "anchor", "left_anti").select("fragment", F.lit(0).alias("skip"), F.lit(0).alias("run"), F.array("lo").alias("least"))
    answers = cut(alone.union(sorted_))
    for done in (*senders, near):
        done.destroy()  # answers are written down; the driver would hold these through the steps that follow
    drop(known, several, mixed)
    answered = _bitmap(answers.select("fragment"), FRAGMENT_BITS)

    def look_up(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(arrow, 1024):
            columns: list[list[np.ndarray]] = [[] for _ in range(5)]
            ids, marks = np.asarray(batch.column(0)), np.asarray(batch.column(2))
            for at, data, ends in joined(batch.column(1).to_pylist()):
                _, first, count, _, key, text = fragments(data, ends, length, lambda h: bitmaps.hits(shared, h))
                if not len(key):
                    continue
                ok = bitmaps.hits(answered, key)
                text = text[ok]
                for c, x in zip(columns, (ids[at + text], marks[at + text], key[ok], first[ok] - np.r_[0, ends][text], count[ok])):
                    c.append(x)
            yield _batch([np.concatenate(c) if c else [] for c in columns], ["doc", "mark", "fragment", "at", "n"], [pa.int64()] * 3 + [pa.int32()] * 2)

    asked = read.mapInArrow(look_up, "doc long, mark long, fragment long, at int, n int").join(answers, "fragment").where("array_min(least) < doc")
    run = F.when(F.col("run") == 0, F.col("n")).otherwise(F.col("run"))
    bit = lambda x, i: F.when(x < F.col("doc"), F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))
    several_bits = F.aggregate(F.transform("least", bit), F.lit(0).cast("long"), lambda a, x: a + x)
    bits_ = F.when(F.size("least") == 1, F.call_function("shiftleft", F.lit(1).cast("long"), run) - 1).otherwise(several_bits)
    hit = F.call_function("shiftleft", (F.col("at") + F.col("skip")).cast("long"), F.lit(SPAN)) + bits_
    spans = cut(asked.select("doc", "mark", hit.alias("hit")).groupBy("doc", "mark").agg(F.collect_list("hit").alias("hits")))
    for done in (shared, answered):
        done.unpersist()
    drop(answers)
    return spans


def _gone(size: int, hits: list[int] | None, length: int) -> np.ndarray:
    """Which bytes go: those under a stretch that was found."""
    if not hits:
        return np.zeros(size, bool)
    found = np.array(hits, np.int64)
    low = (found & ((1 << SPAN) - 1)).astype("<u4")
    at = np.flatnonzero(np.unpackbits(low.view(np.uint8), bitorder="little"))
    starts = np.zeros(size + 1, np.int32)
    starts[(found >> SPAN)[at >> 5] + (at & 31) + 1] = 1
    before = np.cumsum(starts)  # stretches found that begin before each byte
    under = before[1:].copy()
    under[length:] -= before[1 : size - length + 1]
    return under > 0


def _rewritten(docs: DataFrame, length: int, key: str, text: str, own: list[str]) -> DataFrame:
    spans = repeated_spans(docs, length, key, text).withColumnsRenamed({"doc": "_doc", "mark": "_mark", "hits": "_hits"})
    out = docs.select(F.struct(*own).alias("_row"), F.col(key).cast("long").alias("_id"), F.col(text).alias("_text"))
    return out.join(spans, (F.col("_id") == F.col("_doc")) & (F.xxhash64("_text") == F.col("_mark")), "left")


def digests(docs: DataFrame, length: int = 50, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256``; edge cases as in ``remove``."""

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(arrow):
            rows = []
            for k, t, hits in zip(*(batch.column(i).to_pylist() for i in range(3))):
                data = np.frombuffer((t or "").encode("utf-8", "replace"), np.uint8)
                gone = _gone(len(data), hits, length)
                spans = int(np.count_nonzero(np.diff(np.r_[0, gone.astype(np.int8)]) == 1))
                rows.append((k, len(data), int(gone.sum()), spans, hashlib.sha256(data[~gone].tobytes()).hexdigest()))
            yield _batch(list(zip(*rows)) or [()] * 5, ["k", "n_bytes", "n_removed", "n_spans", "kept_sha256"], [pa.int64()] * 4 + [pa.string()])

    found = _rewritten(docs, length, key, text, [key]).select("_id", "_text", "_hits")
    return found.mapInArrow(run, "k long, n_bytes long, n_removed long, n_spans long, kept_sha256 string").withColumnRenamed("k", key)


def remove(docs: DataFrame, length: int = 50, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, columns as they were, without each byte under a ``length``-byte string that a smaller id also has.

    Judged on the input. A character that loses some of its bytes is dropped. Null text stays null; a null key takes no
    part, as rows that repeat a key are one document to each other. Keys must be whole numbers. Columns whose names begin
    with an underscore and clash are safe, for a row travels as one struct. An empty table gives no rows.
    """

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(arrow):
            out = []
            for t, hits in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if t is not None and hits:
                    data = np.frombuffer(t.encode("utf-8", "replace"), np.uint8)
                    t = data[~_gone(len(data), hits, length)].tobytes().decode("utf-8", "ignore")
                out.append(t)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["_row", "_clean"])

    found = _rewritten(docs, length, key, text, docs.columns).select("_row", "_text", "_hits")
    row = docs.select(F.struct(*docs.columns).alias("_row")).schema["_row"].dataType.simpleString()
    done = found.mapInArrow(run, f"_row {row}, _clean string")
    return done.select(*[F.col("_clean").alias(c) if c == text else F.col(f"_row.{c}") for c in docs.columns])
