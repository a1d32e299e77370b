"""Toxicity by compression distance: what a dictionary of toxic text saves over one of ordinary text."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topiclake.llm.bpe import batches

#: Bound of the training sample: labelled rows of either class, those of the smallest id hash.
TRAIN_ROWS = 4000
#: Words that both dictionaries hold, words of one class at most, and the significance (in standard deviations of the
#: difference of document shares) and documents that a word of a class needs.
SHARED_WORDS, CLASS_WORDS, SIGNIFICANCE, LEAST_DOCS = 1500, 250, 6.0, 3
#: Bytes of shared words: a dictionary has to stay within the compressor's window. Its last bytes are never found.
SHARED_BYTES, WINDOW_BYTES, UNINDEXED = 11_000, 1 << 14, b" " * 16
#: A word is written so often in its window: one too short to be compressed would always look alike.
REPEATS = 3
#: Savings, as a share of the word's length, that count as steps of the calibrated thresholds.
STEPS = (0.2, 0.3, 0.4, 0.5, 0.58)
TOXIC_FROM = 0.7
#: Windows whose saving a worker remembers; the memory is emptied when full and changes no result.
REMEMBERED = 500_000
LONGEST_WINDOW = 64

_MARKS = re.compile(rb"""[.,!?;:#*$%&|<>"()\[\]{}]+""")


def words(text: str | None) -> list[bytes]:
    """Lower-case words of the whole text without punctuation; overlong ones in parts, so windows stay small."""
    out = _MARKS.sub(b" ", (text or "").lower().encode("utf-8", "replace")).split()
    return [w[i : i + LONGEST_WINDOW] for w in out for i in range(0, len(w), LONGEST_WINDOW)] if any(len(w) > LONGEST_WINDOW for w in out) else out


@dataclass
class Model:
    toxic: bytes
    ordinary: bytes
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None
    weights: np.ndarray | None = None
    bias: float = 0.0

    def start(self) -> None:
        """Compressors can't travel to a task, so each makes its own."""
        params = zstandard.ZstdCompressionParameters.from_level(
            6, source_size=64, dict_size=WINDOW_BYTES - 128, min_match=3, strategy=zstandard.STRATEGY_GREEDY, write_content_size=0, write_dict_id=0, write_checksum=0
        )
        self.zip = [zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=params).compress for d in (self.ordinary, self.toxic)]
        self.known: dict[bytes, float] = {}

    def _saving(self, word: bytes) -> float:
        window = (b" " + word) * REPEATS
        ordinary, toxic = (len(z(window)) for z in self.zip)
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        self.known[word] = saving = (ordinary - toxic) / (len(word) + 1)
        return saving

    def features(self, text: str | None) -> np.ndarray:
        """Numbers and shares of windows above each step, and the number of windows."""
        known = self.known
        own = words(text)
        x = np.array([known[w] if w in known else self._saving(w) for w in own] or [0.0])
        n = np.array([(x >= s).sum() for s in STEPS])
        return np.r_[np.log1p(n), np.minimum(20 * n / len(x), 3), np.log(len(x))]

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip((features - self.mean) / self.spread @ self.weights + self.bias, -30, 30)))


def _fit(model: Model, x: np.ndarray, y: np.ndarray, rounds: int = 2000, rate: float = 0.5, decay: float = 1e-3) -> None:
    """Logistic regression over the features: the calibration of the thresholds."""
    model.mean, model.spread = x.mean(0), x.std(0) + 1e-6
    z = (x - model.mean) / model.spread
    w, b = np.zeros(x.shape[1]), 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(z @ w + b)))
        w -= rate * (z.T @ (p - y) / len(y) + decay * w)
        b -= rate * float((p - y).mean())
    model.weights, model.bias = w, b


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model | None:
    """A model from labelled rows; None if either class has none. Null labels, keys and texts are left out."""
    order = F.xxhash64("k")
    known = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).where("k IS NOT NULL AND y IN (0, 1)").distinct()
    drawn = [known.where(F.col("y") == c).orderBy(order, "k").limit(rows) for c in (0, 1)]
    # 2 * rows rows at most, so this side may go to every task
    sample = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(drawn[0].union(drawn[1])), "k").where("t IS NOT NULL").select("k", "t", "y")

    def count(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(arrow):
            sets = [(w, y) for t, y in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()) for w in set(words(t))]
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in sets], pa.binary()), pa.array([y for _, y in sets], pa.int32())], ["w", "y"])

    sizes = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return None
    counted = sample.mapInArrow(count, "w binary, y int").groupBy("w").agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("q"))
    p, q = F.col("p") / sizes[1], F.col("q") / sizes[0]
    both = (F.col("p") + F.col("q")) / (sizes[0] + sizes[1])
    z = (p - q) / F.sqrt(both * (1 - both) * (1 / sizes[1] + 1 / sizes[0]) + 1e-9)
    counted = counted.where(F.col("p") + F.col("q") >= LEAST_DOCS).withColumn("z", z)
    special = [[bytes(r["w"]) for r in counted.where(s * F.col("z") > SIGNIFICANCE).orderBy((s * F.col("z")).desc(), "w").limit(CLASS_WORDS).collect()] for s in (1, -1)]
    shared = [bytes(r["w"]) for r in counted.where(F.abs("z") <= SIGNIFICANCE).orderBy(F.col("q").desc(), "w").limit(SHARED_WORDS + CLASS_WORDS).collect()]
    ordinary = (special[1] + shared[SHARED_WORDS:])[: max(1, len(special[0]))]
    # the nearer the end, the shorter the way back: what tells the classes apart comes last
    base = b"".join(b" " + w for w in reversed(shared[:SHARED_WORDS]))[-SHARED_BYTES:]
    model = Model(*(base + b"".join(b" " + w for w in reversed(own)) + UNINDEXED for own in (special[0], ordinary)))

    def describe(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model.start()
        for batch in batches(arrow):
            x = [model.features(t).tolist() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64())), batch.column(2)], ["k", "x", "y"])

    kind = sample.schema["k"].dataType.simpleString()
    found = sorted((r["k"], r["y"], r["x"]) for r in sample.mapInArrow(describe, f"k {kind}, x array<double>, y int").collect())
    _fit(model, np.array([x for _, _, x in found]), np.array([y for _, y, _ in found], float))
    return model


def score(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row its key, ``score`` and ``predicted`` (1 from a score of 0.7).

    The whole text counts, each word as one window. Null and empty texts are scored as a text of one neutral window;
    without a model every score is 0. Null keys, repeated rows and very long texts are treated as any other row; other
    columns are not read. An empty table gives no rows.
    """

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model is not None:
            model.start()
        for batch in batches(arrow):
            texts = batch.column(1).to_pylist()
            s = model.score(np.array([model.features(t) for t in texts])) if model is not None and texts else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64()), pa.array((s >= TOXIC_FROM).astype(np.int32))], ["k", "score", "predicted"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"k {kind}, score double, predicted int").withColumnRenamed("k", key)
