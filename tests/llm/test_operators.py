"""Operators against brute force, exact round trips and held-out labels."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from topiclake.llm import bpe, common, graph, language, neighbours, ngram_join, packing, quality, secrets, suffix_dedup, toxicity, wrappers
from topiclake.llm.common import held_out
from topiclake.llm.queries import TOKENIZER

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- byte-level BPE -------------------------------------------------------------------------------------------------------


def test_bpe_equals_the_library(texts):
    library, codec = Tokenizer.from_file(TOKENIZER), bpe.Codec(TOKENIZER)
    rng = random.Random(1)
    odd = ["", "a<|endoftext|>b", "<|endoftext|><|endoftext|>", "a  b   c \n\n d", "　x​\xa0 y", "\x00\x1c\x85  z", "😀👨‍👩‍👧 ①²Ⅷ ٣", "don't I'LL we've"]
    odd += ["".join(rng.choice("ab é\n\t  'sdt1²Ⅷ😀ß<|") for _ in range(200)) for _ in range(200)]
    for text in [*odd, *texts.values()]:
        want = library.encode(text, add_special_tokens=False).ids
        got = codec.encode(text)
        assert np.frombuffer(got, "<u4").tolist() == want
        assert codec.decode(got) == library.decode(want, skip_special_tokens=False) == text


def test_long_words_merge_alike():
    codec, rng = bpe.Codec(TOKENIZER), random.Random(2)
    for _ in range(20):
        ids = [codec.byte_id[b] for b in bytes(rng.choice(b"abctheing") for _ in range(rng.randint(1, 400)))]
        assert codec.merge_short(ids) == codec.merge_long(ids)
    assert len(codec.encode("a" * 300_000)) > 0


def test_words_merged_together_and_stretches_looked_up_once(monkeypatch):
    library = Tokenizer.from_file(TOKENIZER)
    rng = np.random.default_rng(5)
    signs = np.array(list("aabcdeehilnorstuAZ09'.,;!?-_ \n\t\r éüß漢字… \u0301😀\x00"))
    odd = ["".join(rng.choice(signs, rng.integers(1, 400))) for _ in range(300)]
    odd += ["it's, I'll'd (we've) 'tis a'b", "word,word;\nword.\n\nword", " lead", "trail ", "a" * 300 + "," + "b" * 300, "x  y", "a<|endoftext|>b, c", "", None, " ", "\n"]
    codec = bpe.Codec(TOKENIZER)
    words = sorted({w.encode() for t in odd for w in codec.words.findall(t or "") if len(w.encode()) <= bpe.SHORT_PARTS})
    assert codec.merge_many(words) == [np.array(codec.merge_short([codec.byte_id[b] for b in w]), "<u4").tobytes() for w in words]
    expected = [np.array(library.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in odd]
    one_hash = np.zeros_like(bpe._TABLE)
    for together, remembered, table in ((1 << 20, 400_000, bpe._TABLE), (64, 50, bpe._TABLE), (1 << 20, 400_000, one_hash)):
        monkeypatch.setattr(bpe, "TOGETHER", together)
        monkeypatch.setattr(bpe, "REMEMBERED", remembered)
        monkeypatch.setattr(bpe, "_TABLE", table)
        codec = bpe.Codec(TOKENIZER)
        assert codec.encode_many(odd) == expected
        assert codec.encode_many(odd[::-1]) == expected[::-1]


def test_bpe_operator(spark, docs, texts):
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.digests(docs, TOKENIZER).collect()}
    codec = bpe.Codec(TOKENIZER)
    assert got == {k: (len(p) // 4, hashlib.sha256(p).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for k, t in texts.items() for p in [codec.encode(t)]}
    assert all(r["decoded"] == texts[r["doc_id"]] for r in bpe.encode(docs, TOKENIZER).collect())


# --- language -------------------------------------------------------------------------------------------------------------


def test_language_on_held_out_rows(docs):
    network = language.train(docs.where(~held_out(F.col("doc_id"))))
    kept = docs.where(held_out(F.col("doc_id")))
    got = language.predict(kept, network).join(kept.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)


def test_compiled_network_equals_plain_convolution():
    rng = np.random.default_rng(3)
    tables = {w: rng.normal(size=(w, 256, language.FILTERS)) for w in language.WIDTHS}
    bias = {w: rng.normal(size=language.FILTERS) for w in language.WIDTHS}
    net = language.Network(["a", "b"], tables, bias, rng.normal(size=(language.FILTERS * 3, 2)), np.zeros(2))
    net.compile()
    x = rng.integers(0, 256, (5, language.WINDOW)).astype(np.uint8)
    places = language.WINDOW - max(language.WIDTHS) + 1
    pooled = [np.maximum(sum(tables[w][j][x[:, j : j + places]] for j in range(w)) + bias[w], 0).max(1) for w in language.WIDTHS]
    z = np.concatenate(pooled, 1) @ net.dense
    want = z - np.log(np.exp(z - z.max(1, keepdims=True)).sum(1, keepdims=True)) - z.max(1, keepdims=True)
    assert np.allclose(net.log_probabilities(x), want, atol=1e-3)


# --- packing --------------------------------------------------------------------------------------------------------------


def test_differencing_balances():
    rng = random.Random(4)
    for k in (1, 2, 5, 40):
        lengths = [rng.randint(1, 1000) for _ in range(120)]
        parts = packing.difference(lengths, k)
        assert sorted(i for p in parts for i in p) == list(range(120)) and len(parts) == k
        sums = [sum(lengths[i] for i in p) for p in parts]
        assert max(sums) - min(sums) <= (1000 if k == 40 else 60)
    sums = sorted(sum([8, 7, 6, 5, 4][i] for i in p) for p in packing.difference([8, 7, 6, 5, 4], 2))
    assert sums == [14, 16]
    whole = packing.pack_block([600, 600, 600], 1024, cut=False)
    assert len(whole) == 3  # two windows would hold too much, so their number rises


@pytest.mark.parametrize("seed", range(6))
def test_blocks_are_full_and_complete(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(1, 64) for _ in range(rng.randint(0, 90))]
    windows = packing.pack_block(lengths, 64)
    covered = defaultdict(list)
    for w in windows:
        n = sum(p[2] for p in w)
        assert 0 < n <= 64 and (n == 64 or n & (n - 1) == 0)
        for i, start, length in w:
            covered[i].append((start, length))
    for i, n in enumerate(lengths):
        at = 0
        for start, length in sorted(covered[i]):
            assert start == at and length > 0
            at += length
        assert at == n


def test_packing_operator(docs, texts):
    codec = bpe.Codec(TOKENIZER)
    pieces = packing.pack(docs, TOKENIZER).collect()
    sequences, owners = defaultdict(list), defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
        owners[p["doc_id"]].append((p["start"], p["length"], p["ids_crc32"], p["doc_tokens"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 1024 or at & (at - 1) == 0 and at < 1024
    assert set(owners) == set(texts)
    for k, parts in owners.items():
        ids, at = codec.encode(texts[k]) + bytes(4), 0
        for start, length, crc, total in sorted(parts):
            assert start == at and crc == zlib.crc32(ids[4 * start : 4 * (start + length)]) and total == len(ids) // 4
            at += length
        assert at == len(ids) // 4


# --- n-gram Jaccard join ----------------------------------------------------------------------------------------------------


def brute_components(rows, size, percent):
    def sets(t):
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()

    own = [(k, sets(t)) for k, t in rows]
    index, parent = defaultdict(list), {k: k for k, _ in own}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (k, s) in enumerate(own):
        for j, both in Counter(j for x in s for j in index[x]).items():
            if 100 * both >= percent * (len(s) + len(own[j][1]) - both):
                a, b = root(k), root(own[j][0])
                parent[max(a, b)] = min(a, b)
        for x in s:
            index[x].append(i)
    return sorted(((k, len(s), root(k)) for k, s in own), key=str)


def near_copies(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)]
    rows = []
    for _ in range(22):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 8, 40, 80, 150, 300]))]
        for _ in range(rng.choice([1, 1, 2, 5, 30])):
            words = base[:]
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                words[rng.randrange(len(words))] = rng.choice([*vocabulary, f"x{rng.randrange(10**6)}"])
            rows.append((len(rows), " ".join(words)))
    n = len(rows)
    rows += [(n, None), (n + 1, ""), (n + 2, " \n"), (n + 3, "A b"), (n + 4, "a B"), (n + 5, "a b c d"), (5, "key again text"), (n + 7, "key again TEXT")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limits", [(800, 1_000_000, 8), (7, 2000, 2)])
def test_join_equals_brute_force(spark, monkeypatch, limits):
    for name, value in zip(("BLOCK_SETS", "BLOCK_SHINGLES", "DENSE_FROM"), limits):
        monkeypatch.setattr(ngram_join, name, value)
    rows = near_copies(limits[0])
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(ngram_join.join(df, 4, 85)) == brute_components(rows, 4, 85)


def test_join_on_given_documents(docs, texts):
    assert rows_of(ngram_join.join(docs, 4, 85)) == brute_components(list(texts.items()), 4, 85)


def test_few_narrow_rows_go_to_few_files_and_texts_in_small_batches(spark, monkeypatch):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled", common._BATCH_SETTING)}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 211)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        dealt = spark.range(5000).groupBy((F.col("id") % 3000).alias("k")).count()
        few = common.cut(dealt, 5000)
        assert len(few.inputFiles()) <= max(common.FEW_FILES, 2 * spark.sparkContext.defaultParallelism) < len(common.cut(dealt).inputFiles())
        assert rows_of(few) == rows_of(dealt)
        for given, used in ((10_000, common.BATCH_ROWS), (0, common.BATCH_ROWS), (7, 7)):
            spark.conf.set(common._BATCH_SETTING, given)
            common.modest_batches(spark)
            assert int(spark.conf.get(common._BATCH_SETTING)) == used
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_chance_hits_of_shingles_are_looked_at_again(spark, monkeypatch):
    """In a bitmap that is far too small almost all shingles pass; few of those of one group are handed on."""
    monkeypatch.setattr(ngram_join, "SHARED_BITS", 20)
    seen = []
    clusters = ngram_join._clusters
    monkeypatch.setattr(ngram_join, "_clusters", lambda posts, groups: seen.append(clusters(posts, groups)) or seen[0])
    rng = random.Random(3)
    texts = [" ".join(str(rng.randrange(10**9)) for _ in range(1500)) for _ in range(600)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, texts[0] + " more"])], "doc_id long, text string")
    out = {r["doc_id"]: r["component_id"] for r in ngram_join.join(docs, size=4, percent=85).collect()}
    assert out == {i: i % 600 for i in range(601)}
    named = 2 * 226 * 601  # about 15 % of the shingles of a set, each under two names; a third of them pass one bitmap
    assert seen[0][0].count() < named // 8


def test_linked_sets_share_the_fewest_of_their_prefixes():
    rng, counts, linked = np.random.default_rng(5), np.zeros(1 << ngram_join.SKETCH_BITS, np.uint32), 0
    for _ in range(3000):
        percent, n = int(rng.choice([60, 80, 85])), int(rng.integers(1, 120))
        both, one, two = n, *rng.integers(0, 1 + n // 3, 2)
        h = rng.integers(0, 2**64, both + one + two, dtype=np.uint64)
        a, b = np.unique(h[: both + one]), np.unique(np.r_[h[:both], h[both + one :]])
        if ngram_join.linked(a, b, percent):
            linked += 1
            shared = np.intersect1d(ngram_join.prefix(a, counts, percent), ngram_join.prefix(b, counts, percent))
            assert len(shared) >= ngram_join.fewest_shared(np.array(len(a)), np.array(len(b)), percent) >= 1
    assert linked > 1000


@pytest.mark.parametrize("limits", [(2000, 500_000), (5, 300)])
def test_sets_that_share_too_little_of_their_prefixes_are_not_sent(spark, monkeypatch, limits):
    """Each text has a passage in common with each of its neighbours: all meet, in clusters and across, but two only link."""
    for name, value in zip(("BLOCK_SETS", "BLOCK_NAMES"), limits):
        monkeypatch.setattr(ngram_join, name, value, raising=False)
    seen = []
    monkeypatch.setattr(ngram_join, "cut", lambda df, rows=None: seen.append(common.cut(df, rows)) or seen[-1])
    texts = [" ".join(f"w{min(i, i + d)}.{abs(d)}.{k}" for d in (-3, -2, -1, 1, 2, 3) for k in range(40)) for i in range(60)]
    rows = list(enumerate([*texts, texts[7] + " more"]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(ngram_join.join(docs, 4, 85)) == brute_components(rows, 4, 85)
    [posts] = [d for d in seen if d.columns[:4] == ["token", "gid", "n", "pos"] and "c" not in d.columns]
    [members] = [d for d in seen if "block" in d.columns]
    [pairs] = [d for d in seen if d.columns == ["cls1", "cls2"]]
    assert posts.groupBy("token").count().where("count > 1").count() > 300
    assert members.where("k > 1").count() + 2 * pairs.count() <= 4


def test_names_of_the_next_class_alone_are_not_dealt_out(spark, monkeypatch):
    seen = []
    clusters = ngram_join._clusters
    monkeypatch.setattr(ngram_join, "_clusters", lambda posts, groups: seen.append(clusters(posts, groups)) or seen[0])
    texts = [" ".join(f"{i // 2}.{k}" for k in range(300)) + f" end{i}" for i in range(100)]
    out = ngram_join.join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 4, 85)
    assert rows_of(out) == sorted([(i, 298, i - i % 2) for i in range(100)], key=str)
    prefixes = 100 * (298 - 254 + 1)  # one class: what two share under the class, they share under the next one as well
    assert seen[0][0].count() < 1.2 * prefixes


def test_keep_one(spark):
    text = " ".join(f"w{i}" for i in range(50))
    df = spark.createDataFrame([(3, text, "x"), (1, text + " more", "y"), (2, "else", "z"), (None, text, None)], "doc_id long, text string, cls string")
    assert rows_of(ngram_join.keep_one(df).select("doc_id", "cls")) == [(1, "y"), (2, "z"), (None, None)]


def test_keep_one_of_repeated_keys(spark):
    text, other = (" ".join(f"{c}{i}" for i in range(50)) for c in "wv")
    rows = [(5, text), (5, text), (5, other), (1, text + " more"), (9, other), (9, other + " more"), (7, None), (7, None), (None, text), (None, text)]
    kept = rows_of(ngram_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string")))
    assert [r for r in kept if r[0] is None] == [(None, text)] * 2 and (1, text + " more") in kept and (7, None) in kept
    assert (5, text) not in kept and sum(r[1] is not None and r[1].startswith("v") for r in kept) == 1 and len(kept) == 5


def test_components(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(100, 140)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(500, k) for k in range(200, 300)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = dict(tuple(r) for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {x: root(x) for e in edges if e[0] != e[1] for x in e}


# --- suffix dedup -----------------------------------------------------------------------------------------------------------


def brute_spans(rows, n=50):
    first = {}
    for k, t in rows:
        data = (t or "").encode()
        for i in range(len(data) - n + 1 if k is not None else 0):
            first[data[i : i + n]] = min(first.get(data[i : i + n], k), k)
    out = []
    for k, t in rows:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - n + 1 if k is not None else 0):
            if first[data[i : i + n]] < k:
                gone[i : i + n] = b"\1" * n
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((k, len(data), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(data, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("limits", [(100, 20_000), (2, 50)])
def test_suffix_dedup_equals_brute_force(spark, monkeypatch, limits):
    monkeypatch.setattr(suffix_dedup, "HOT_FRAGMENTS", limits[0])
    monkeypatch.setattr(suffix_dedup, "BUCKET_FRAGMENTS", limits[1])
    rng = random.Random(limits[0])
    vocabulary = ["".join(rng.choice("abcdefé") for _ in range(rng.randint(2, 9))) for _ in range(200)]
    passages = [" ".join(rng.choice(vocabulary) for _ in range(k)) for k in (8, 9, 10, 12, 20, 60, 200)] + ["=-" * 40, "a" * 120]
    rows = []
    for _ in range(120):
        parts = [rng.choice(passages) if rng.random() < 0.5 else " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 30))) for _ in range(rng.randint(0, 5))]
        for _ in range(rng.choice([1, 1, 1, 2, 4])):
            letters = list(" ".join(parts))
            for _ in range(rng.randint(0, 3) if letters else 0):
                letters[rng.randrange(len(letters))] = rng.choice("xyzü")
            rows.append((len(rows), "".join(letters)))
    n = len(rows)
    rows += [(n, None), (n + 1, ""), (n + 2, "x" * 49), (n + 3, "x" * 50), (n + 4, "x" * 51), (n + 5, "x" * 5000), (3, "zz " * 40), (3, "zz " * 40), (None, "zz " * 40)]
    rng.shuffle(rows)
    assert rows_of(suffix_dedup.digests(spark.createDataFrame(rows, "doc_id long, text string"))) == brute_spans(rows)


def test_chance_hits_lose_no_match(spark, monkeypatch):
    """Half of all places set by chance, as in a bitmap that is full: the result is the same."""
    true_bitmap = suffix_dedup._bitmap

    def crowded(values, most):
        whole = true_bitmap(values, most).value
        return spark.sparkContext.broadcast(whole | np.random.default_rng(len(whole)).integers(0, 256, len(whole), np.uint8))

    monkeypatch.setattr(suffix_dedup, "_bitmap", crowded)
    monkeypatch.setattr(suffix_dedup, "BUCKET_FRAGMENTS", 20)
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9)))
    passages = [" ".join(word() for _ in range(14)) for _ in range(30)]
    rows = [(i, " ".join(x for p in rng.sample(passages, 3) for x in (p, *[word() for _ in range(rng.randint(0, 6))]))) for i in range(90)]
    assert rows_of(suffix_dedup.digests(spark.createDataFrame(rows, "doc_id long, text string"))) == brute_spans(rows)


def test_cover_and_anchors():
    differences = {(a - b) % suffix_dedup.COVER_MOD for a in suffix_dedup.COVER for b in suffix_dedup.COVER}
    assert differences == set(range(suffix_dedup.COVER_MOD))
    rng = np.random.default_rng(5)
    shared = rng.integers(97, 101, 90).astype(np.uint8).tobytes()
    found = []
    for _ in range(2):
        text = rng.integers(97, 123, 70).astype(np.uint8).tobytes() + shared + rng.integers(97, 123, 70).astype(np.uint8).tobytes()
        h, first, count, _ = suffix_dedup.anchors(text, 50)
        assert count.sum() == len(text) - 49
        by_stretch = np.repeat(h, count)
        found.append(by_stretch[70 : 70 + 41].tolist())
    assert found[0] == found[1]  # equal stretches have equal anchors, whatever surrounds them


# --- neighbours -------------------------------------------------------------------------------------------------------------


def test_recall_against_brute_force(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    data = df.collect()
    ids, x = np.array([r["vec_id"] for r in data]), np.array([r["embedding"] for r in data], float)
    got = defaultdict(list)
    for r in neighbours.search(df, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    hit = 0
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        best = [ids[i] for i in np.lexsort((ids, d)) if ids[i] != q][:10]
        hit += len({v for v, _ in got[q]} & set(best))
        assert all(abs(s - d[ids == v][0]) < 1e-12 for v, s in got[q])
    assert hit / (10 * len(got)) >= 0.9


def test_neighbour_edges(spark):
    same = [1.0, 2.0]
    rows = [(i, same) for i in range(30)] + [(100, [0.0, 0.0]), (200, None), (300, [float("nan"), 1.0]), (400, [1.0, None]), (None, same), (500, [5.0, 5.0]), (500, [5.0, 5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = neighbours.search(df, F.col("vec_id") % 100 == 0).collect()
    assert sorted(r["vec_id"] for r in got if r["query_id"] == 0) == list(range(1, 11))
    assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == 500] == list(range(10))
    assert {r["query_id"] for r in got} == {0, 500}
    assert neighbours.search(df.limit(0), F.lit(True)).count() == 0


# --- quality rules ----------------------------------------------------------------------------------------------------------


def brute_quality(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {g for g, n in Counter(grams).items() if n > 1}
    covered = {i + k for i, g in enumerate(grams) if g in often for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


def test_quality_measures(spark, docs, texts):
    odd = {-1: None, -2: "", -3: " \t\n", -4: "a b c " * 40, -5: "x\ny\nx\n \n \nx", -6: "😀 ü\x85é\xa0b # <|>", -7: "one two", -8: "a b c a b c"}
    df = docs.select("doc_id", "text").union(spark.createDataFrame(list(odd.items()), "doc_id long, text string"))
    got = {r[0]: tuple(r)[1:] for r in quality.measure(df).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()}
    assert got == {k: brute_quality(t) for k, t in {**texts, **odd}.items()}


def test_quality_verdict_follows_labels(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    got = quality.measure(docs).join(labels, "doc_id").collect()
    assert all(r["kept"] == (r["quality"] == 1) for r in got if not r["base_failed"])
    assert "PythonUDF" not in (plan := quality.measure(docs)._jdf.queryExecution().executedPlan().toString()) and "InArrow" not in plan


# --- secrets ----------------------------------------------------------------------------------------------------------------


def test_secrets_found_and_redacted(spark):
    rng = random.Random(8)
    key = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    rows, secret = [], {}
    for i in range(60):
        secret[i] = key(40)
        rows.append((i, f'some words before token = "{secret[i]}" and after', "src1"))
        rows.append((1000 + i, f"call 4{key(0)}{rng.randrange(10**15, 10**16 - 1)} or mail some.long.name.{i}@mail.example.com, item 12345678901234{i:04d}", "src2"))
    rows += [(5000, None, None), (5001, "", "src1"), (None, f'token = "{secret[0]}"', None), (0, f'token = "{secret[0]}" twice "{secret[0]}"', "src1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("mark", F.lit(1)).withColumn("_row", F.lit(2))
    found = secrets.scan(df).collect()
    text = {(r[0], r[1]) for r in rows}
    for r in found:
        assert any(k == r["doc"] and t and t[r["start"] : r["start"] + len(r["value"])] == r["value"] for k, t in text)
    flagged = Counter(r["doc"] for r in found if r["secret"])
    assert all(flagged[i] for i in range(60)) and not any(flagged[1000 + i] for i in range(60))
    clean = secrets.redact(df)
    assert clean.columns == df.columns and clean.count() == len(rows)
    assert not any(v in (r["text"] or "") for r in clean.collect() for v in secret.values())
    assert {r["doc_id"]: r["text"] for r in clean.collect()}[1003] == dict((r[0], r[1]) for r in rows)[1003]


BARE = [
    ("AWS_ACCESS_KEY_ID=", "AKIA" + "IOSFODNN7EXAMPL1"), ("api_key=", "sk_live_" + "4eC39HqLyjWDarjtT1zd"), ("https://x.example/cb?token=", "ghp_" + "a1B2" * 9),
    ("MY_SERVICE_PRODUCTION_DATABASE_ADMIN_ACCOUNT_PASSWORD=", "hunter2hunter2hunter2"), ("password: ", "tr0ub4dor&3horse"), ("id ", "AKIA" + "ABCDEFGHIJKLMNOP"),
    ("bot ", "xoxb-" + "abcdefghij"), ("maps ", "AIza" + "abcdE" * 7), ("--session-key=", "sk_test_" + "abcdefghijklmnopqr"), ("jwt ", "eyJhbGciOi.eyJzdWIiOi.c2lnbmF0dXJl"),
    ("export DB_PASSWORD=", "h4nter2&m0re!stuff"), ("config key_", "a" * 50 + "9f8e7d6c5b4a"),
]


def test_unquoted_secrets(spark):
    rows = [(i, f"some words before {name}{value} and after", "s") for i, (name, value) in enumerate(BARE)]
    rows += [(100 + i, f"call {10**15 + 7919 * i} or mail some.long.name.{i}@mail.example.com", "s") for i in range(40)]
    rows += [(200, "https://x.example/?token=abcd1234efgh&user=somebody", "s"), (300, "password=" + "x&y" * 60_000, "s"), (301, "token-" * 30_000, "s"), (302, "eyJ-" * 50_000, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = secrets.scan(df).collect()
    got = {r["doc"]: (r["value"], r["secret"]) for r in found if r["doc"] < 100 and r["value"] in BARE[r["doc"]][1]}
    assert {k: v[0] for k, v in got.items()} == {i: v for i, (_, v) in enumerate(BARE[:-1])}
    assert all(v[1] for v in got.values())
    assert [r["value"] for r in found if r["doc"] == 11] == ["key_" + BARE[11][1]]  # a first digit after more than 40 characters
    assert [len(r["value"]) for r in found if r["doc"] == 300] == [180_000]
    assert "abcd1234efgh" in [r["value"] for r in found if r["doc"] == 200]
    assert not any(r["secret"] for r in found if 100 <= r["doc"] < 200)
    text = {r[0]: r[1] for r in rows}
    assert all(text[r["doc"]][r["start"] : r["start"] + len(r["value"])] == r["value"] for r in found)


def test_forest_from_given_findings(spark):
    df = spark.createDataFrame([(i, f'token = "{i:04d}abcdef0123456789abcdef"', "p") for i in range(40)] + [(100 + i, f"number 12345678901234{i:04d} here", "p") for i in range(40)], "doc_id long, text string, source string")
    found = secrets.candidates(df)
    described = secrets.features(found, secrets.dictionary(df, found))
    labelled = described.withColumn("label", (F.col("doc") >= 100).cast("double"))  # the other way round: labels rule, not patterns
    flagged = {r["doc"] for r in secrets.scan(df, labelled).where("secret").collect()}
    assert flagged == set(range(100, 140))
    assert secrets.train(labelled.where("label = 1")) is None


# --- pages ------------------------------------------------------------------------------------------------------------------


def test_marked_article(spark):
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>
    <nav><ul><li><a href="/x">Menu</a></li></ul></nav><div class="ad">Buy</div><div class="layout-with-sidebar"><article><h1>Head &amp; more</h1>
    <p>One <b>bold</b>ly &nbsp; said<br>next<p>Two<div class="share">Share</div><!-- note --><ul><li>a<li>b &lt;c&gt;</ul>
    <section id="comments"><article class="comment"><p>First!</p></article></section></article><aside>Side</aside></div>
    <div class="cookie-notice">Ok?</div><form><p>Mail</p></form><footer>End</footer></body></html>"""
    rows = [(1, "http://a/x", page), (2, None, None), (3, "http://a/y", ""), (None, "b", "<p>only &eacute;</p>"), (5, "http://c/", "<main>x<p>y</main>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("?")).withColumn("blocks", F.lit(1))
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in wrappers.extract(df).collect()}
    want = "Head & more\nOne boldly said next\nTwo\na\nb <c>"
    assert got == {1: (want, len(want)), 2: ("", 0), 3: ("", 0), None: ("only é", 6), 5: ("x\ny", 3)}
    assert wrappers.extract(df.limit(0)).count() == 0


def test_template_of_unmarked_pages(spark):
    page = "<html><body><div><p>Welcome to the site</p></div><div><p>Story {0} begins</p><p>and {0} ends</p></div><div>All rights</div></body></html>"
    rows = [(i, f"https://h.example/{i}", page.format(f"n{i}")) for i in range(70)] + [(100 + i, "https://one.example/", page.format("x")) for i in range(5)]
    got = {r["page_id"]: r["text"] for r in wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Story n{i} begins\nand n{i} ends" for i in range(70))
    assert "Welcome" in got[100]  # copies of one page are no evidence for a template


def test_template_within_marked_articles(spark):
    page = '<html><body><nav>{1}</nav><article><p>Read in <a href="/">our app</a> today</p><h1>Story {0}</h1><p>It <b>was</b> {0}</p><div>Pass it on</div></article></body></html>'
    same = "<html><body><nav>{0}</nav><article><h1>One text</h1><p>on every page</p></article></body></html>"
    rows = [(i, f"https://h.example/{i}", page.format(f"n{i}", i)) for i in range(20)] + [(100 + i, "https://s.example/", same.format(i)) for i in range(20)]
    got = {r["page_id"]: r["text"] for r in wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Story n{i}\nIt was n{i}" for i in range(20))
    assert all(got[100 + i] == "One text\non every page" for i in range(20))  # nothing else: the text itself is repeated


def test_copies_do_not_thin_out_a_template(spark):
    page = "<html><body><div><p>Welcome to the site</p></div><div><p>Story {0} begins</p></div><div>All rights</div></body></html>"
    rows = spark.createDataFrame([(i, f"https://h.example/{i}", page.format(f"n{i}")) for i in range(40)], "page_id long, url string, html string")
    copies = spark.range(100, 100_100).select(F.col("id").alias("page_id"), F.lit("https://h.example/0").alias("url"), F.lit(page.format("n0")).alias("html"))
    got = {r["page_id"]: r["text"] for r in wrappers.extract(rows.union(copies)).where("page_id < 101").collect()}
    assert all(got[i] == f"Story n{i} begins" for i in range(40)) and got[100] == "Story n0 begins"


def test_simple_tree_matching():
    def size(a, b):
        shapes = {}
        x, y = (wrappers.read_skeleton(wrappers.skeleton(wrappers.parse(p)), shapes) for p in (a, b))
        return wrappers._match(x, y, {})

    assert size("<div><p>a</p></div>", "<div><p>b</p></div>") == 4
    assert size("<ul><li>a</li><li>b</li></ul>", "<ul><li>a</li><li>b</li><li>c</li></ul>") == 6
    assert size("<div><b>x</b><p>a</p></div>", "<div><p>b</p><b>x</b></div>") == 4  # order counts: one of the two


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in wrappers.extract(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)(</article>|\Z)", r["html"], re.S)[1]
        parts = [re.sub(r"<[^>]*>", "", re.sub("<br>", " ", s)) for s in re.split(r"</?(?:p|h1)>", inner)]
        want = [" ".join(wrappers.entities.unescape(s).split()) for s in parts]
        assert got[r["page_id"]] == "\n".join(s for s in want if s)


# --- toxicity ---------------------------------------------------------------------------------------------------------------


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    learned = ~held_out(F.col("doc_id"))
    model = toxicity.train(docs.where(learned), labels.where(learned))
    got = toxicity.score(docs.where(~learned), model).join(labels, "doc_id").select("toxic", "score", "predicted").toPandas()
    assert got[got.predicted == 1].toxic.mean() > 0.85 and got[got.toxic == 1].predicted.mean() > 0.55
    ranks = got.score.rank()
    n = got.toxic.sum()
    assert (ranks[got.toxic == 1].sum() - n * (n + 1) / 2) / (n * (len(got) - n)) > 0.93


def test_toxicity_without_a_class(spark, docs):
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id long, toxic int")
    assert toxicity.train(docs, labels) is None
    assert {tuple(r)[1:] for r in toxicity.score(docs, None).collect()} == {(0.0, 0)}
