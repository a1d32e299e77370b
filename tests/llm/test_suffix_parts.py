"""Parts of suffix dedup: texts hashed together, spans from bits, buckets against comparing all stretches."""

import random
import zlib

import numpy as np
import pytest

from topiclake.llm import bitmaps, suffix_dedup


def test_joined_texts_have_their_own_anchors(monkeypatch):
    rng = random.Random(6)
    texts = ["".join(rng.choice("abcde é") for _ in range(rng.choice([0, 1, 49, 50, 51, 80, 400]))) for _ in range(60)] + [""]
    for together in (1, 300, 1 << 16):
        monkeypatch.setattr(suffix_dedup, "TOGETHER", together)
        got = {i: [] for i in range(len(texts))}
        for at, data, ends in suffix_dedup.joined(texts):
            starts = np.r_[0, ends]
            for h, first, count, place, text in zip(*suffix_dedup.anchors_of(data, ends, 50)):
                got[at + text].append((h, first - starts[text], count, place - starts[text]))
        assert got == {i: list(zip(*suffix_dedup.anchors(t.encode(), 50))) for i, t in enumerate(texts)}


def test_bytes_under_found_stretches_go():
    rng = random.Random(7)
    for _ in range(500):
        size, hits = rng.choice([50, 51, 60, 120, 400]), []
        gone = np.zeros(size, bool)
        for _ in range(rng.randint(0, 4)):
            at = rng.randint(0, size - 50)
            bits = rng.getrandbits(rng.randint(1, min(suffix_dedup.SPAN, size - 49 - at))) | 1
            hits.append((at << suffix_dedup.SPAN) + bits)
            for i in range(suffix_dedup.SPAN):
                if bits >> i & 1:
                    gone[at + i : at + i + 50] = True
        assert (suffix_dedup._gone(size, hits, 50) == gone).all()
    assert suffix_dedup._gone(0, None, 50).tolist() == []


@pytest.mark.parametrize("length", [20, 21, 30, 50, 64])
def test_buckets_equal_comparing_all(length):
    rng = np.random.default_rng(length)
    gram = suffix_dedup._gram(length)
    lead = length - gram
    for _ in range(20):
        n = int(rng.integers(1, 40))
        hashes, owner = rng.integers(0, 4, n), rng.integers(0, 50, n)
        grams, sides = ([rng.integers(0, top, size).astype(np.uint8).tobytes() for _ in range(4)] for top, size in ((256, gram), (2, lead)))
        place = rng.integers(0, lead + 1, n)
        behind = [int(rng.integers(lead - p, lead + 1)) for p in place]
        pieces = [sides[rng.integers(0, 4)][lead - p :] * bool(p) + grams[h] + sides[rng.integers(0, 4)][:b] for h, p, b in zip(hashes, place, behind)]
        least = {}
        for h, p, piece, o in zip(hashes, place, pieces, owner):
            for s in range(len(piece) - length + 1):
                cell = (h, p - s, piece[s : s + length])
                least[cell] = min(o, least.get(cell, o))
        got = suffix_dedup.sort_buckets(hashes, place, pieces, owner, length)
        want = [[least[h, p - s, piece[s : s + length]] for s in range(len(piece) - length + 1)] for h, p, piece in zip(hashes, place, pieces)]
        assert [g.tolist() for g in got] == want


def test_places_travel_as_small_distances():
    rng = np.random.default_rng(4)
    for count in (1, 2, 3000, 1 << 20):
        places = np.sort(rng.choice(1 << bitmaps.SEGMENT_BITS, count, replace=False)).astype(np.uint32)
        assert (bitmaps.unpacked(bitmaps.packed(places)) == places).all()
    places = np.sort(rng.choice(1 << bitmaps.SEGMENT_BITS, 3000, replace=False)).astype(np.uint32)
    assert 3 * len(zlib.compress(bitmaps.packed(places), 1)) < 2 * len(zlib.compress(places.tobytes(), 1))
