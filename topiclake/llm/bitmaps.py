"""Bitmaps of hashed values: of fixed size, so that they may be sent to every task whatever the input holds.

They only save work. A value whose bit is set may be a chance hit, and everything that passes is looked at exactly
afterwards; the larger the input, the more passes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

SEGMENT_BITS = 20
#: Values a task gathers before it sends what it has.
FLUSH_VALUES = 400_000
SCHEMA = "segment int, places binary, counts binary"


def slots(values: np.ndarray, bits: int) -> np.ndarray:
    """Slot of each 64-bit value in a bitmap of ``2**bits`` places; fewer bits give the higher ones of more."""
    at = (values.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
    return at.astype(np.uint32) if bits <= 32 else at


def bits_for(values: int, most: int, places: int = 4) -> int:
    """Size of a bitmap for so many values, about ``places`` places each, within the bound ``most``."""
    return min(most, max(SEGMENT_BITS, (places * values - 1).bit_length()))


def packed(places: np.ndarray) -> bytes:
    """Rising places as their distances, all low bytes first: the high ones are nearly all zero, which a shuffle compresses."""
    return np.diff(places, prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view(np.uint32).ravel(), dtype=np.uint32)


def _send(parts: list[np.ndarray], weight: int, finer: int) -> Iterator[pa.RecordBatch]:
    found, counts = np.unique(np.concatenate(parts), return_counts=True)
    width = found.dtype.type(SEGMENT_BITS + finer)
    segment = found >> width
    edges = np.flatnonzero(np.diff(segment)) + 1
    local = (found - (segment << width)).astype(np.uint32)
    counts = np.minimum(counts * weight, 255).astype(np.uint8)
    rows = [(int(s), packed(p), n.tobytes()) for s, p, n in zip(segment[np.r_[0, edges]], np.split(local, edges), np.split(counts, edges))]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))], ["segment", "places", "counts"])


def send(used: Iterator[np.ndarray], finer: int = 0) -> Iterator[pa.RecordBatch]:
    """What a task knows of its values, given slots, those of each owner (a document, a group) once."""
    return send_weighed(((1, places) for places in used), finer)


def send_weighed(used: Iterator[tuple[int, np.ndarray]], finer: int = 0) -> Iterator[pa.RecordBatch]:
    """The same of owners that count as so many each; what has one weight travels together.

    Slots may have ``finer`` bits (12 at most) more than the bitmap that is built.
    """
    parts: dict[int, list[np.ndarray]] = {}
    held: dict[int, int] = {}
    for weight, places in used:
        if len(places):
            parts.setdefault(weight, []).append(places)
            held[weight] = held.get(weight, 0) + len(places)
        if held.get(weight, 0) >= FLUSH_VALUES:
            yield from _send(parts.pop(weight), weight, finer)
            held[weight] = 0
    for weight, rest in parts.items():
        yield from _send(rest, weight, finer)


def gather(owned: Iterator[np.ndarray], bits: int) -> Iterator[pa.RecordBatch]:
    """What a task knows of its values, given the 64-bit values of each owner."""
    return send(np.unique(slots(values, bits)) for values in owned if len(values))


def totals(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Of the rows of a segment: the places in use, and by how many owners (up to 255)."""
    at = np.concatenate([unpacked(places) for places in group.column("places").to_pylist()])
    counts = np.frombuffer(b"".join(group.column("counts").to_pylist()), np.uint8)
    both = at.astype(np.uint64) << np.uint64(8) | counts
    both.sort()
    at = (both >> np.uint64(8)).astype(np.uint32)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return at[first], np.minimum(np.add.reduceat(both & np.uint64(255), first), 255).astype(np.uint8)


def build(gathered: DataFrame, bits: int, *owners: int, finer: int = 0) -> list[Broadcast]:
    """For each number (up to 255) a bitmap of the slots that so many owners use at least, from rows made by ``gather``.

    Each segment is made by one task; the driver only joins the segments, ``2**bits / 8`` bytes a bitmap. They come to it
    compressed, as its JVM holds what is collected several times over. Owners that were sent by ``finer`` slots are counted
    by these, so that a value is set where so many use it, not where so many use values of one slot.
    """

    def merge(group: pa.Table) -> pa.Table:
        total = np.zeros(1 << SEGMENT_BITS, np.uint16)
        if finer:
            at, counts = totals(group)
            at >>= np.uint32(finer)
            first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
            total[at[first]] = np.maximum.reduceat(counts, first)
        else:
            for places, counts in zip(group.column("places").to_pylist(), group.column("counts").to_pylist()):
                at = unpacked(places)
                total[at] = np.minimum(total[at] + np.frombuffer(counts, np.uint8), 255)
        maps = {f"m{i}": pa.array([zlib.compress(np.packbits(total >= n).tobytes(), 1)], pa.binary()) for i, n in enumerate(owners)}
        return pa.table({"segment": group.column("segment")[:1]} | maps)

    whole = [np.zeros(1 << (bits - 3), np.uint8) for _ in owners]
    size = 1 << (SEGMENT_BITS - 3)
    schema = ", ".join(["segment int", *(f"m{i} binary" for i in range(len(owners)))])
    for row in gathered.groupBy("segment").applyInArrow(merge, schema).collect():
        for i, bitmap in enumerate(whole):
            bitmap[row["segment"] * size : (row["segment"] + 1) * size] = np.frombuffer(zlib.decompress(row[f"m{i}"]), np.uint8)
    return [gathered.sparkSession.sparkContext.broadcast(bitmap) for bitmap in whole]


def hits(bitmap: Broadcast, values: np.ndarray) -> np.ndarray:
    """Which values have their bit set."""
    whole = bitmap.value
    at = slots(values, int(len(whole)).bit_length() + 2)
    return (whole[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
