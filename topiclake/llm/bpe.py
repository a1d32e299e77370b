"""Byte-level BPE over a public vocabulary: short words are merged in a contiguous array of boundaries and ranks."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

# Fixed value: how the vocabulary's library cuts text into words.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words of more parts than this are merged with a heap, so a word of a million letters takes n log n steps, not n squared.
SHORT_PARTS = 128
#: Words and stretches of text in one of the two parts of what a worker remembers. When the newer part is full, the
#: older one is forgotten and what is used again moves over. It changes no result.
REMEMBERED = 400_000
NO_RANK = 1 << 60
NO_SHORT_RANK = np.int32(2**31 - 1)
#: Bytes of texts that are cut and looked up together, about.
TOGETHER = 1 << 20
#: White space after a space: only then can cutting a text at its spaces change its words.
SPACED = re.compile(r" \s")


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


_TABLE = np.random.default_rng(7).integers(0, 2**64, (64, 256), np.uint64)
_LETTER = np.array([chr(b).isalpha() and b < 128 for b in range(256)])
_OTHER = np.array([b < 128 for b in range(256)]) & ~_LETTER


def _pieces(data: bytes) -> Iterator[bytes]:
    """A long text cut before some of its spaces."""
    start = 0
    while len(data) - start > TOGETHER:
        at = data.rfind(b" ", start + 1, start + TOGETHER)
        at = at if at > 0 else data.find(b" ", start + TOGETHER)
        if at < 0:
            break
        yield data[start:at]
        start = at
    yield data[start:]


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_alphabet()
        back = {c: b for b, c in letters.items()}
        vocab = spec["model"]["vocab"]
        self.byte_id = [vocab[letters[b]] for b in range(256)]
        #: Rank by pair of ids, and the id that the merge of a rank makes.
        self.ranks: dict[int, int] = {}
        self.made: list[int] = []
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks.setdefault(vocab[left] << 32 | vocab[right], rank)
            self.made.append(vocab[left + right])
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", []) if t.get("special")}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.pieces: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.pieces[i] = bytes(back[c] for c in token)
        for token, i in self.special.items():
            self.pieces[i] = token.encode()
        #: Pairs of ids in order (one beyond all at the end) with their ranks; the ranks of pairs of bytes, where a word's merging begins.
        pairs = sorted(((p >> 32) * (size + 1) + (p & 0xFFFFFFFF), rank) for p, rank in self.ranks.items())
        self.pairs, self.pair_ranks = (np.array(c, kind) for c, kind in zip(zip(*pairs, (1 << 62, NO_SHORT_RANK)), (np.int64, np.int32)))
        self.made_ids, self.byte_ids = np.array(self.made, np.int32), np.array(self.byte_id, np.int32)
        self.first_ranks = self._ranks_of(np.repeat(self.byte_ids, 256), np.tile(self.byte_ids, 256)).reshape(256, 256)
        self.words = regex.compile(WORD_PATTERN)
        self.known: list[dict[bytes, bytes]] = [{}, {}]

    def merge_short(self, ids: list[int], ranks: list[int] | None = None) -> list[int]:
        """Ids after all merges: scan the rank array for its minimum, delete that boundary, refresh both neighbours."""
        find, made = self.ranks.get, self.made
        if ranks is None:
            ranks = [find(a << 32 | b, NO_RANK) for a, b in zip(ids, ids[1:])]
        ids = ids[:]
        while ranks and (low := min(ranks)) != NO_RANK:
            at = ranks.index(low)
            new = ids[at] = made[low]
            del ids[at + 1], ranks[at]
            if at < len(ranks):
                ranks[at] = find(new << 32 | ids[at + 1], NO_RANK)
            if at:
                ranks[at - 1] = find(ids[at - 1] << 32 | new, NO_RANK)
        return ids

    def merge_long(self, ids: list[int]) -> list[int]:
        """The same ids by a heap of pairs over a linked list."""
        find, n = self.ranks.get, len(ids)
        ids, after, before = ids[:], [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(rank, i, ids[i], ids[i + 1]) for i in range(n - 1) if (rank := find(ids[i] << 32 | ids[i + 1], NO_RANK)) != NO_RANK]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i], ids[j] = self.made[rank], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right >= 0 and (rank := find(ids[left] << 32 | ids[right], NO_RANK)) != NO_RANK:
                    heapq.heappush(heap, (rank, left, ids[left], ids[right]))
        return [i for i in ids if i >= 0]

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids."""
        pairs = left.astype(np.int64) * (len(self.pieces) + 1) + right
        at = np.searchsorted(self.pairs, pairs)
        return np.where(self.pairs[at] == pairs, self.pair_ranks[at], NO_SHORT_RANK)

    def merge_many(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of many short words after all merges: words of about one length are rows of a matrix, and each step
        does the merge of the smallest rank, the first from the left, of every word that has one left."""
        out, size, empty = [b""] * len(words), np.array([len(w) for w in words], np.int64), len(self.pieces)
        classes = -(-size // 4) * 4
        for width in np.unique(classes).tolist():
            rows = np.flatnonzero(classes == width)
            cells = np.frombuffer(b"".join([words[i].ljust(width) for i in rows.tolist()]), np.uint8).reshape(-1, width)
            column, length = np.arange(width), size[rows][:, None]
            ids = np.where(column < length, self.byte_ids[cells], np.int32(empty))
            ranks = np.where(column[1:] < length, self.first_ranks[cells[:, :-1], cells[:, 1:]], NO_SHORT_RANK)
            while len(rows):
                line, at = np.arange(len(rows)), ranks.argmin(1)
                low = ranks[line, at]
                go = low < NO_SHORT_RANK
                if not go.all():
                    done = ids[~go]
                    there = done < empty
                    packed, ends = done[there].astype("<u4").tobytes(), (4 * np.cumsum(there.sum(1))).tolist()
                    for row, start, end in zip(rows[~go].tolist(), [0, *ends], ends):
                        out[row] = packed[start:end]
                    rows, ids, ranks, at, low = rows[go], ids[go], ranks[go], at[go], low[go]
                    line = np.arange(len(rows))
                    if not len(rows):
                        break
                made = self.made_ids[low]
                ids[line, at] = made
                stay = np.ones(ids.shape, bool)
                stay[line, at + 1] = False
                ids = ids[stay].reshape(len(rows), -1)
                ranks = ranks[stay[:, 1:]].reshape(len(rows), -1)
                behind, before = np.flatnonzero(at < ranks.shape[1]), np.flatnonzero(at)
                ranks[behind, at[behind]] = self._ranks_of(made[behind], ids[behind, at[behind] + 1])
                ranks[before, at[before] - 1] = self._ranks_of(ids[before, at[before] - 1], made[before])
                if not ranks.shape[1]:
                    ranks = np.full((len(rows), 1), NO_SHORT_RANK)
        return out

    def _lookup(self, stretches: list[bytes], whole: list[bool]) -> list[bytes]:
        """Ids of stretches of text, remembered or made; whole ones are known to be one word."""
        if len(self.known[0]) >= REMEMBERED:
            self.known[:] = {}, self.known[0]
        now, old = self.known
        out, words, mixed = list(map(now.get, stretches)), [], []
        for i in [i for i, packed in enumerate(out) if packed is None]:
            if packed := old.get(stretches[i]):
                now[stretches[i]] = out[i] = packed
            else:
                (words if whole[i] else mixed).append(i)
        for many in (True, False):
            some = [i for i in words if (len(stretches[i]) <= SHORT_PARTS) == many]
            for i, packed in zip(some, (self.merge_many if many else self._merge_each)([stretches[i] for i in some])):
                out[i] = packed
                if many:
                    now[stretches[i]] = packed
        parts = [[w.encode() for w in self.words.findall(stretches[i].decode())] for i in mixed]
        made = self._words(parts)
        for i, packed in zip(mixed, made):
            out[i] = packed
            if len(stretches[i]) <= SHORT_PARTS:
                now[stretches[i]] = packed
        return out

    def _merge_each(self, words: list[bytes]) -> list[bytes]:
        return [array("I", self.merge_long([self.byte_id[b] for b in w])).tobytes() for w in words]

    def _words(self, parts: list[list[bytes]]) -> list[bytes]:
        """Ids of sequences of words."""
        every = list(set().union(*parts))
        known = dict(zip(every, self._lookup(every, [True] * len(every)))) if every else {}
        return [b"".join([known[w] for w in p]) for p in parts]

    def _split(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pieces of text: cut before spaces and where ASCII letters end at another ASCII character, for there a word
        always begins. Each different stretch is looked up once."""
        raw, ends = b"".join(pieces), np.cumsum([len(p) for p in pieces])
        flat = np.frombuffer(raw, np.uint8)
        begins, letter = flat == ord(" "), _LETTER[flat]
        begins[1:] |= letter[:-1] & _OTHER[flat[1:]]
        begins[np.r_[0, ends[:-1]]] = True
        start = np.flatnonzero(begins)
        size = np.diff(np.r_[start, len(flat)])
        place = np.arange(len(flat)) - np.repeat(start, size)
        hashes = np.add.reduceat(_TABLE[place % len(_TABLE), flat], start)
        _, first, of = np.unique(hashes, return_index=True, return_inverse=True)
        # a hash does not decide: stretches are compared byte by byte, and looked up one by one should two share a hash
        if (size[first][of] != size).any() or (flat[np.repeat(start[first][of], size) + place] != flat).any():
            first = of = np.arange(len(start))
        letters = np.add.reduceat(letter, start, dtype=np.int64)
        whole = ((letters == size) | (letters == size - 1) & (size > 1) & (flat[start] == ord(" ")))[first]
        found = self._lookup([raw[a:b] for a, b in zip(start[first].tolist(), (start + size)[first].tolist())], whole.tolist())
        counts, ids = np.array([len(p) for p in found]) // 4, np.frombuffer(b"".join(found), "<u4")
        n = counts[of]
        last = np.cumsum(n)
        packed = ids[np.repeat((np.cumsum(counts) - counts)[of] - last + n, n) + np.arange(last[-1])].tobytes()
        stops = (4 * last[np.searchsorted(start, ends) - 1]).tolist()
        return [packed[a:b] for a, b in zip([0, *stops], stops)]

    def _odd(self, text: str) -> bytes:
        """Ids of a text with a special token's spelling, or with white space behind a space."""
        find, rest, out = self.words.findall, text, []
        while special := min(((p, s) for s in self.special if (p := rest.find(s)) >= 0), default=None):
            out += [([w.encode() for w in find(rest[: special[0]])], None), ([], self.special[special[1]])]
            rest = rest[special[0] + len(special[1]) :]
        out.append(([w.encode() for w in find(rest)], None))
        made = self._words([words for words, _ in out])
        return b"".join([packed if i is None else np.array([i], "<u4").tobytes() for packed, (_, i) in zip(made, out)])

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        """Packed ids of each text; a special token's spelling becomes its id. Null counts as empty."""
        out: list[list[bytes]] = [[] for _ in texts]
        held, of, size = [], [], 0

        def flush() -> None:
            nonlocal size
            for i, packed in zip(of, self._split(held) if held else []):
                out[i].append(packed)
            held.clear(), of.clear()
            size = 0

        for i, text in enumerate(texts):
            if text and (SPACED.search(text) or any(s in text for s in self.special)):
                out[i].append(self._odd(text))
            elif text:
                for piece in _pieces(text.encode()):
                    held.append(piece)
                    of.append(i)
                    size += len(piece)
                    if size >= TOGETHER:
                        flush()
        flush()
        return [p[0] if len(p) == 1 else b"".join(p) for p in out]

    def encode(self, text: str | None) -> bytes:
        return self.encode_many([text])[0]

    def decode(self, packed: bytes) -> str:
        """Text of packed ids; broken UTF-8 becomes replacement characters."""
        return b"".join(map(self.pieces.__getitem__, memoryview(packed).cast("I").tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec_of(path: str) -> Codec:
    """One codec a worker, kept from task to task."""
    return Codec(path)


def batches(arrow: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in arrow:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def encode(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row its key, ``ids`` (array of int) and ``decoded`` text.

    Null text counts as empty (no ids, empty text); null keys, repeated rows and texts of any length are treated as any
    other row; other columns of the input are not read, so their names cannot clash. An empty table gives no rows.
    """

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(tokenizer)
        for batch in batches(arrow):
            packed = codec.encode_many(batch.column(1).to_pylist())
            flat, ends = np.frombuffer(b"".join(packed), "<i4"), np.cumsum([0, *(len(p) // 4 for p in packed)])
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, pa.array([codec.decode(p) for p in packed], pa.string())], ["k", "ids", "decoded"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`k` {kind}, ids array<int>, decoded string").withColumnRenamed("k", key)


def digests(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row its key, ``n_tokens`` and SHA-256 of its packed ids and of the decoded text; edge cases as in ``encode``.

    The digests are taken where the ids are made, so ids never leave the task.
    """

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(tokenizer)
        for batch in batches(arrow):
            counts, ids, decoded = array("q"), [], []
            for packed in codec.encode_many(batch.column(1).to_pylist()):
                counts.append(len(packed) // 4)
                ids.append(hashlib.sha256(packed).hexdigest())
                decoded.append(hashlib.sha256(codec.decode(packed).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], ["k", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`k` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("k", key)
