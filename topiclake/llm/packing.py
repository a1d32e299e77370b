"""Packing token sequences into fixed windows by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from topiclake.llm.bpe import batches, codec_of

#: Pieces balanced together. It bounds a task's memory; less than one window a block is left over.
BLOCK_PIECES = 512
#: Sequence ids are the task's number above this many bits and a running number below.
TASK_SHIFT = 40

Piece = tuple[int, int, int]  # item, start within the item, length


def difference(lengths: list[int], k: int) -> list[list[int]]:
    """Items (by index) in ``k`` parts of near-equal sums.

    Each item begins as a partial partition with one filled part. The two partial partitions with the largest
    imbalance are merged again and again, the fullest part of one with the emptiest of the other, so that opposing
    imbalances cancel. Only parts above the smallest sum are stored, so early partitions stay short.
    """
    heap = [(-n, i, [(n, [i])]) for i, n in enumerate(lengths)]
    heapq.heapify(heap)
    count = len(heap)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        spare = k - len(a)  # parts of a that are still empty
        free, rest = b[:spare], b[spare:]
        merged = a + free
        # b's smaller parts meet a's parts from the smallest up, while the largest of b took the empty ones
        for (n, items), at in zip(rest, range(len(a) - 1, -1, -1)):
            merged[at] = (a[at][0] + n, a[at][1] + items)
        merged.sort(key=lambda p: -p[0])
        low = merged[-1][0] if len(merged) == k else 0
        heapq.heappush(heap, (low - merged[0][0], count, merged))
        count += 1
    parts = [items for _, items in heap[0][2]] if heap else []
    return parts + [[] for _ in range(k - len(parts))]


def pack_block(lengths: list[int], capacity: int, cut: bool = True) -> list[list[Piece]]:
    """Windows of one block of items, each no longer than ``capacity``.

    Without ``cut`` items (none longer than the capacity) stay whole, and the window count rises until differencing
    fits. With ``cut`` the tokens beyond a whole number of windows are set aside first and become windows of a power of
    two; the rest is balanced into near-equal windows, and what exceeds the capacity there is cut off and moves to
    the windows that it left short. Those take it exactly; a new window opens if none is short.
    """
    if not cut:
        k = max(1, -(-sum(lengths) // capacity))
        parts = difference(lengths, k)
        while any(sum(lengths[i] for i in part) > capacity for part in parts):
            k += 1
            parts = difference(lengths, k)
        return [[(i, 0, lengths[i]) for i in part] for part in parts if part]
    left = list(lengths)
    windows: list[list[Piece]] = []
    over = sum(lengths) % capacity
    tail: list[Piece] = []
    for i in sorted(range(len(left)), key=lambda i: -left[i]):
        if not over:
            break
        n = min(over, left[i])
        left[i], over = left[i] - n, over - n
        tail.append((i, left[i], n))
    while total := sum(p[2] for p in tail):
        windows.append(_take(tail, 1 << (total.bit_length() - 1)))
    live = [i for i, n in enumerate(left) if n]
    parts = difference([left[i] for i in live], sum(left) // capacity)
    loads = [[(live[i], 0, left[live[i]]) for i in part] for part in parts]
    surplus: list[Piece] = []
    for load in loads:
        load.sort(key=lambda p: p[2])  # the longest piece is cut
        if (extra := sum(p[2] for p in load) - capacity) > 0:
            while extra:
                i, start, n = load.pop()
                take = min(extra, n)
                extra -= take
                surplus.append((i, start + n - take, take))
                if n > take:
                    load.append((i, start, n - take))
    for load in loads:
        if surplus and (short := capacity - sum(p[2] for p in load)):
            load += _take(surplus, short)
    while surplus:
        loads.append(_take(surplus, capacity))
    return windows + [load for load in loads if load]


def _take(pieces: list[Piece], n: int) -> list[Piece]:
    """Remove ``n`` tokens from the end of a list of pieces, cutting one if need be."""
    out: list[Piece] = []
    while n and pieces:
        i, start, length = pieces.pop()
        took = min(n, length)
        out.append((i, start, took))
        if length > took:
            pieces.append((i, start + took, length - took))
        n -= took
    return out


def pack(docs: DataFrame, tokenizer: str, capacity: int = 1024, separator: int = 0, cut: bool = True, key: str = "doc_id", text: str = "text", block: int = BLOCK_PIECES) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are those of its text and the separator. Whole windows are cut off as they come; what is left of
    ``block`` documents at a time is balanced. Nothing is shuffled, so no key can be hot: a task packs the rows it
    reads, and numbers its sequences within its own range. Null text counts as empty (the separator alone). Null keys
    and repeated rows are packed as any other row, other columns are not read, an empty table gives no rows.
    """
    names = ["k", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, end = codec_of(tokenizer), np.array([separator], "<u4").tobytes()
        context = TaskContext.get()
        sequence = (context.partitionId() if context else 0) << TASK_SHIFT
        rests: list[tuple[object, int, bytes, int]] = []  # key, start, packed ids, tokens of the document
        rows: list[tuple] = []

        def place(key, start: int, ids: bytes, total: int, offset: int) -> None:
            rows.append((key, start, len(ids) // 4, zlib.crc32(ids), total, sequence, offset))

        def balance() -> None:
            nonlocal sequence
            for window in pack_block([len(r[2]) // 4 for r in rests], capacity, cut):
                offset = 0
                for i, start, n in window:
                    key, base, ids, total = rests[i]
                    place(key, base + start, ids[4 * start : 4 * (start + n)], total, offset)
                    offset += n
                sequence += 1
            rests.clear()

        def flush(kind: pa.DataType) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * 7
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, kind if n == "k" else pa.int64()) for n, c in zip(names, columns)], names)

        kind: pa.DataType | None = None
        for batch in batches(arrow):
            kind = batch.column(0).type
            for key, packed in zip(batch.column(0).to_pylist(), codec.encode_many(batch.column(1).to_pylist())):
                ids = packed + end
                total = len(ids) // 4
                whole = total - total % capacity
                for start in range(0, whole, capacity):
                    place(key, start, ids[4 * start : 4 * (start + capacity)], total, 0)
                    sequence += 1
                if whole < total:
                    rests.append((key, whole, ids[4 * whole :], total))
                if len(rests) >= block:
                    balance()
            yield flush(kind)
        balance()
        if rows:
            yield flush(kind)

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`k` {kind}, " + ", ".join(f"`{n}` long" for n in names[1:])).withColumnRenamed("k", key)
