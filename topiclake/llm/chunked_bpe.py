"""Byte-level BPE by a file of ranks: long texts are pre-tokenised in overlapping chunks and stitched where they agree.

The pattern looks ahead but never back, so from a position where two overlapping chunks both begin a pre-token they go on
alike: there the left chunk ends and the right one takes over. The pieces between such seams are encoded one by one,
wherever they lie, and ids and raw bytes of a text are those of its pieces in order.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import accumulate, pairwise

import public_tokenizers
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topiclake.llm.bpe import batches
from topiclake.llm.common import cut, small

#: Characters of a chunk before the next one begins, and characters that it shares with the next.
CHUNK, OVERLAP = 16_384, 256
#: Chunks that a task hands on at a time, so that a very long text never lies in one batch.
DEALT = 500
#: What the pattern may look at behind a pre-token's end, two characters at most; ends nearer to a chunk's end are unsure.
LOOKAHEAD = 2
#: Pre-tokens that a worker remembers, and the longest one it does; the memory is emptied when full and changes no result.
REMEMBERED, LONGEST_REMEMBERED = 500_000, 64
#: Bytes of a pre-token up to which its pairs are looked through; longer ones use a heap, with the same result.
SHORT_BYTES, NO_RANK = 48, 1 << 60
#: Row numbers are the task's number above this many bits and a running number below.
TASK_SHIFT = 40


class Ranks(dict):
    """A vocabulary of ranks that maps pre-tokens to packed ids, merging those it does not know."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        super().__init__()
        with open(path, "rb") as lines:
            self.rank = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.token = [b""] * (max(self.rank.values()) + 1)
        for token, rank in self.rank.items():
            self.token[rank] = token
        self.longest = max(map(len, self.rank))
        self.find = regex.compile(pattern).findall

    def __missing__(self, word: str) -> bytes:
        packed = array("I", self.merge(word.encode())).tobytes()
        if len(word) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = packed
        return packed

    def merge(self, data: bytes) -> list[int]:
        """Ids of one pre-token: of all neighbouring parts those with the lowest joint rank are merged first, from the left."""
        rank, n, longest = self.rank, len(data), self.longest
        if n <= longest and data in rank:
            return [rank[data]]
        if n <= SHORT_BYTES:
            return self._merge_short(data)
        end, before = [*range(1, n + 1)], [*range(-1, n - 1)]  # of the part that begins here; 0 where none does any more
        heap: list[tuple[int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and end[i] < n:
                stop = end[end[i]]
                if stop - i <= longest and (r := rank.get(data[i:stop])) is not None:
                    heapq.heappush(heap, (r, i, stop))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, stop = heapq.heappop(heap)
            middle = end[i]
            if not middle or middle >= n or end[middle] != stop:
                continue
            end[i], end[middle] = stop, 0
            if stop < n:
                before[stop] = i
            offer(before[i])
            offer(i)
        out, i = [], 0
        while i < n:
            out.append(rank[data[i : end[i]]])
            i = end[i]
        return out

    def _merge_short(self, data: bytes) -> list[int]:
        """The same for a word of few bytes, where looking through all pairs is quicker than keeping them sorted."""
        find, at = self.rank.get, [*range(len(data) + 1)]
        ranks = [find(data[i : i + 2], NO_RANK) for i in at[:-2]]
        while ranks and (low := min(ranks)) != NO_RANK:
            i = ranks.index(low)
            del at[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = find(data[at[i] : at[i + 2]], NO_RANK)
            if i:
                ranks[i - 1] = find(data[at[i - 1] : at[i + 1]], NO_RANK)
        return [self.rank[data[a:b]] for a, b in pairwise(at)]

    def encode(self, text: str) -> bytes:
        """Packed ids of a text that begins and ends with whole pre-tokens."""
        return b"".join(map(self.__getitem__, self.find(text)))

    def decode(self, packed: bytes) -> bytes:
        """Raw bytes of packed ids."""
        return b"".join(map(self.token.__getitem__, memoryview(packed).cast("I").tolist()))

    def boundaries(self, chunk: str, last: bool) -> list[int]:
        """Where pre-tokens begin in a chunk, as far as the characters behind it cannot change them."""
        sure = len(chunk) if last else len(chunk) - LOOKAHEAD
        return [0, *(at for at in accumulate(map(len, self.find(chunk))) if at <= sure)]


@lru_cache(maxsize=2)
def ranks_of(path: str) -> Ranks:
    """One vocabulary a worker, kept from task to task."""
    return Ranks(path)


def chunks_of(text: str, chunk: int, overlap: int) -> Iterator[tuple[int, bool, str]]:
    """Start, whether it is the last, and characters of each chunk of a text."""
    for start in range(0, max(1, len(text) - overlap), chunk):
        stop = start + chunk + overlap
        yield start, stop >= len(text), text[start:stop]


def _batch(columns: list, names: str, kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names.split())


def _seams(chunks: DataFrame, path: str, overlap: int) -> DataFrame:
    """``row``, ``start`` and ``seam`` of each chunk: the first place where it and the one before begin a pre-token, or null."""

    def mark(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = ranks_of(path)
        for batch in batches(arrow):
            following, heads, tails = [], [], []
            for start, last, text in zip(*(batch.column(i).to_pylist() for i in range(1, 4))):
                places, own = ranks.boundaries(text, last), len(text) - overlap
                following.append(None if last else start + own)
                heads.append([start + p for p in places if p <= overlap])
                # a text cut behind white space would be read differently at its end
                tails.append([start + p for p in places if p >= own and not text[p - 1].isspace()])
            yield _batch([batch.column(0), batch.column(1), following, heads, tails], "row start next head tail", [pa.int64()] * 3 + [pa.list_(pa.int64())] * 2)

    marks = cut(chunks.select("row", "start", "last", "text").mapInArrow(mark, "row long, start long, next long, head array<bigint>, tail array<bigint>"))
    before = marks.where("next IS NOT NULL").select("row", F.col("next").alias("start"), "tail")
    seam = F.when(F.col("start") == 0, F.lit(0).cast("long")).otherwise(F.array_min(F.array_intersect("head", "tail")))
    return marks.select("row", "start", "head").join(before, ["row", "start"], "left").select("row", "start", seam.alias("seam"))


def _long_pieces(docs: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """``row``, ``k``, ``start`` and ``piece`` of texts longer than a chunk; a piece is whole pre-tokens.

    Chunks are dealt one by one, so a very long text is no one task's. Only places travel to be compared. A seam is right if
    its left chunk begins right, so all are once every chunk of the text has one. Where two chunks agree on no place, a
    pre-token fills their overlap: they become one chunk, and the seams of that text are sought anew. A pre-token has to be
    merged as one, so no chunk grows beyond what one task must hold anyway.
    """
    kind = docs.schema["k"].dataType.simpleString()

    def deal(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        row = (context.partitionId() if context else 0) << TASK_SHIFT
        rows: list[tuple] = []

        def flush(key: pa.DataType) -> pa.RecordBatch:
            columns = list(zip(*rows))
            rows.clear()
            return _batch(columns, "row k start last text", [pa.int64(), key, pa.int64(), pa.bool_(), pa.string()])

        for batch in batches(arrow, 16):
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for c in chunks_of(t, chunk, overlap):
                    rows.append((row, k, *c))
                    if len(rows) >= DEALT:
                        yield flush(batch.column(0).type)
                row += 1
            if rows:
                yield flush(batch.column(0).type)

    chunks = cut(docs.mapInArrow(deal, f"row long, k {kind}, start long, last boolean, text string").repartition("row", "start"))
    along = Window.partitionBy("row").orderBy("start")
    pieces = []
    while True:
        seams = cut(_seams(chunks, path, overlap))
        open_ = cut(seams.where("seam IS NULL").select("row").distinct())
        whole = open_.isEmpty()
        sure = seams if whole else seams.join(small(open_), "row", "left_anti")
        spans = small(sure.select("row", "start", F.col("seam").alias("from"), F.lead("seam").over(along).alias("to")))
        # the text of a chunk between its seams; lengths beyond the end reach to the end
        piece = F.substr("text", (F.col("from") - F.col("start") + 1).cast("int"), F.coalesce(F.col("to") - F.col("from"), F.char_length("text")).cast("int"))
        pieces.append(chunks.join(spans, ["row", "start"]).select("row", "k", F.col("from").alias("start"), piece.alias("piece")))
        if whole:
            return reduce(DataFrame.union, pieces)
        first = F.last(F.when(F.col("seam").isNotNull(), F.col("start")), ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, 0))
        again = seams.join(small(open_), "row").select("row", "start", first.alias("first"), F.lead("start").over(along).alias("next"))
        again = again.withColumn("next", F.when(F.lead("first").over(along) == F.col("first"), F.col("next")))
        own = F.substr("text", F.lit(1), F.coalesce(F.col("next") - F.col("start"), F.char_length("text")).cast("int"))
        parts = chunks.join(small(again), ["row", "start"]).select("row", "k", "first", "start", "last", own.alias("own"))
        joined = parts.groupBy("row", "first").agg(F.first("k").alias("k"), F.max("last").alias("last"), F.sort_array(F.collect_list(F.struct("start", "own"))).alias("p"))
        chunks = cut(joined.select("row", "k", F.col("first").alias("start"), "last", F.array_join("p.own", "").alias("text")))


def _split(docs: DataFrame, key: str, text: str, chunk: int) -> tuple[DataFrame, DataFrame]:
    read = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    long = F.char_length("text") > chunk
    return read.where(~long), read.where(long)


def encode(docs: DataFrame, ranks: str, key: str = "doc_id", text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row per piece of a text: key, ``row``, ``start`` (characters before it) and ``ids``; a short text is one piece.

    ``row`` tells apart the texts of rows that repeat a key; it is null for texts of one piece. The ids of a text are those
    of its pieces by ``start``. Null counts as empty: one piece without ids. Null keys, repeated rows and texts of any
    length are as any other row; other columns are not read; an empty table gives no rows.
    """
    short, long = _split(docs, key, text, chunk)

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = ranks_of(ranks)
        for batch in batches(arrow):
            ids = [memoryview(vocabulary.encode(t)).cast("I").tolist() for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(ids, pa.list_(pa.int32()))], ["k", "row", "start", "ids"])

    pieces = short.select("k", F.lit(None).cast("long").alias("row"), F.lit(0).cast("long").alias("start"), F.col("text").alias("piece"))
    pieces = pieces.union(_long_pieces(long, ranks, chunk, overlap).select("k", "row", "start", "piece"))
    return pieces.mapInArrow(run, f"k {docs.schema[key].dataType.simpleString()}, row long, start long, ids array<int>").withColumnRenamed("k", key)


def decode(pieces: DataFrame, ranks: str, ids: str = "ids") -> DataFrame:
    """The rows with their raw bytes, ``decoded``; the bytes of a text are those of its pieces, one after the other."""

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = ranks_of(ranks).token.__getitem__
        for batch in batches(arrow):
            raw = [b"".join(map(token, x or ())) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], ["_row", "_raw"])

    own = [c for c in pieces.columns if c != "decoded"]
    found = pieces.select(F.struct(*own).alias("_row"), F.col(ids).alias("_ids"))
    return found.mapInArrow(run, f"_row {found.schema['_row'].dataType.simpleString()}, _raw binary").select("_row.*", F.col("_raw").alias("decoded"))


def digests(docs: DataFrame, ranks: str, key: str = "doc_id", text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Per row its key, ``n_tokens`` and SHA-256 of its packed ids and of the decoded bytes; edge cases as in ``encode``.

    Texts of one chunk are encoded where they are read. The pieces of longer ones meet in order, and a task keeps running
    digests of one text, never its ids.
    """
    short, long = _split(docs, key, text, chunk)
    kind = docs.schema[key].dataType.simpleString()
    names, kinds = "k n_tokens ids_sha256 decoded_sha256", [pa.int64(), pa.string(), pa.string()]
    schema = f"k {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = ranks_of(ranks)
        for batch in batches(arrow):
            packed = [vocabulary.encode(t) for t in batch.column(1).to_pylist()]
            sums = [hashlib.sha256(p).hexdigest() for p in packed], [hashlib.sha256(vocabulary.decode(p)).hexdigest() for p in packed]
            yield _batch([batch.column(0), [len(p) // 4 for p in packed], *sums], names, [batch.column(0).type, *kinds])

    def pack(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = ranks_of(ranks)
        for batch in batches(arrow):
            packed = [vocabulary.encode(t) for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(packed, pa.binary())], ["row", "k", "start", "ids"])

    def chain(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, held, own = ranks_of(ranks), None, pa.null()
        done: list[tuple] = []

        def close() -> None:
            if held is not None:
                done.append((held[1], held[2], held[3].hexdigest(), held[4].hexdigest()))

        for batch in arrow:
            own = batch.column(1).type
            for row, k, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if held is None or held[0] != row:
                    close()
                    held = [row, k, 0, hashlib.sha256(), hashlib.sha256()]
                held[2] += len(ids) // 4
                held[3].update(ids)
                held[4].update(vocabulary.decode(ids))
            if done:
                yield _batch(list(zip(*done)), names, [own, *kinds])
                done.clear()
        close()
        if done:
            yield _batch(list(zip(*done)), names, [own, *kinds])

    packed = _long_pieces(long, ranks, chunk, overlap).select("row", "k", "start", "piece").mapInArrow(pack, f"row long, k {kind}, start long, ids binary")
    ordered = packed.repartition("row").sortWithinPartitions("row", "start")
    return short.mapInArrow(run, schema).union(ordered.mapInArrow(chain, schema)).withColumnRenamed("k", key)
