"""Language identification with a small convolutional network over bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topiclake.llm.bpe import batches

WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 12
#: Bytes of a window. Texts are cut into windows without gap or overlap, so every byte is read.
WINDOW = 128
#: Bound of the training sample: rows a language (in expectation) and windows a row, spread over its whole text.
TRAIN_ROWS, TRAIN_WINDOWS = 600, 6
EPOCHS, RATE, BATCH, SEED = 6, 4e-3, 64, 7
UNKNOWN = "und"


@dataclass
class Network:
    """Filter tables per width: ``tables[w][j]`` holds what each byte at place j adds to the filters of width w."""

    classes: list[str]
    tables: dict[int, np.ndarray]
    bias: dict[int, np.ndarray]
    dense: np.ndarray
    dense_bias: np.ndarray

    def compile(self) -> None:
        """Pairs of bytes share one table row, so each place costs two look-ups."""
        pair = np.arange(65536)
        hi, lo = pair >> 8, pair & 255
        first = [self.tables[w][0][hi] + self.tables[w][1][lo] + self.bias[w] for w in WIDTHS]
        self.first = np.concatenate(first, 1).astype(np.float32)
        second = [self.tables[3][2][hi], self.tables[4][2][hi] + self.tables[4][3][lo]]
        self.second = np.concatenate(second, 1).astype(np.float32)

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        """Of windows (one a row, zero-padded bytes): log of the softmax over the classes."""
        t = np.ascontiguousarray(windows.T).astype(np.int32)
        pairs = t[:-1] << 8 | t[1:]
        n = pairs.shape[0]
        pooled = np.zeros((pairs.shape[1], self.first.shape[1]), np.float32)
        for i in range(n - 2):
            here = self.first[pairs[i]]
            here[:, FILTERS:] += self.second[pairs[i + 2]]
            np.maximum(pooled, here, out=pooled)
        z = pooled @ self.dense + self.dense_bias
        z -= z.max(1, keepdims=True)
        return z - np.log(np.exp(z).sum(1, keepdims=True))


def cut_windows(text: bytes) -> np.ndarray:
    rows = -(-len(text) // WINDOW)
    out = np.zeros(rows * WINDOW, np.uint8)
    out[: len(text)] = np.frombuffer(text, np.uint8)
    return out.reshape(rows, WINDOW)


def fit(windows: np.ndarray, labels: np.ndarray, classes: list[str]) -> Network:
    """Train by Adam on cross entropy; deterministic for given rows in a given order."""
    rng = np.random.default_rng(SEED)
    p: dict[str, np.ndarray] = {"e": rng.normal(0, 0.5, (256, EMBEDDING))}
    for w in WIDTHS:
        p[f"f{w}"] = rng.normal(0, (w * EMBEDDING) ** -0.5, (w, EMBEDDING, FILTERS))
        p[f"b{w}"] = np.zeros(FILTERS)
    p["d"] = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(classes)))
    p["c"] = np.zeros(len(classes))
    p = {k: v.astype(np.float32) for k, v in p.items()}
    m, v = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}
    step, places = 0, WINDOW - max(WIDTHS) + 1
    for _ in range(EPOCHS):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            x, y = windows[pick], labels[pick]
            e = p["e"][x]
            pooled, best = [], []
            for w in WIDTHS:
                r = sum(e[:, j : j + places] @ p[f"f{w}"][j] for j in range(w)) + p[f"b{w}"]
                top = r.argmax(1)
                best.append(top)
                pooled.append(np.maximum(np.take_along_axis(r, top[:, None], 1)[:, 0], 0))
            h = np.concatenate(pooled, 1)
            z = h @ p["d"] + p["c"]
            z = np.exp(z - z.max(1, keepdims=True))
            z /= z.sum(1, keepdims=True)
            z[np.arange(len(y)), y] -= 1
            z /= len(y)
            g = {"d": h.T @ z, "c": z.sum(0), "e": np.zeros_like(p["e"])}
            dh = (z @ p["d"].T) * (h > 0)
            for k, w in enumerate(WIDTHS):
                d = dh[:, k * FILTERS : (k + 1) * FILTERS]
                g[f"b{w}"], g[f"f{w}"] = d.sum(0), np.zeros_like(p[f"f{w}"])
                rows = np.arange(len(y))[:, None]
                for j in range(w):
                    seen = x[rows, best[k] + j]  # the byte under each filter where it was largest
                    g[f"f{w}"][j] = np.einsum("nfe,nf->ef", p["e"][seen], d)
                    np.add.at(g["e"], seen, d[:, :, None] * p[f"f{w}"][j].T[None])
            step += 1
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                p[k] = p[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    tables = {w: np.einsum("be,jef->jbf", p["e"], p[f"f{w}"]) for w in WIDTHS}
    return Network(classes, tables, {w: p[f"b{w}"] for w in WIDTHS}, p["d"], p["c"])


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", rows: int = TRAIN_ROWS) -> Network | None:
    """A network from labelled rows; null labels and texts are left out. None without any labelled text.

    The sample is bounded: rows whose text hash falls below ``rows`` / count of its language, windows spread over the
    whole text. Repeated texts are in or out together, so the sample does not depend on the order of rows.
    """
    known = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(text).rlike(r"\p{L}")).select(F.col(text).alias("t"), F.col(lang).alias("y"))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    share = F.create_map(*[x for y, n in counts.items() for x in (F.lit(y), F.lit(min(1.0, rows / n)))])
    drawn = known.where(F.pmod(F.xxhash64("t"), F.lit(1 << 20)) < F.element_at(share, F.col("y")) * (1 << 20))

    def windows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for t, y in zip(frame["t"], frame["y"]):
                cut = cut_windows(t.encode("utf-8", "replace"))
                spread = np.unique(np.linspace(0, len(cut) - 1, TRAIN_WINDOWS).astype(int))
                out += [(cut[i].tobytes(), y) for i in spread]
            yield pd.DataFrame(out, columns=["w", "y"])

    sample = sorted((bytes(r["w"]), r["y"]) for r in drawn.mapInPandas(windows, "w binary, y string").collect())
    classes = sorted(counts)
    number = {y: i for i, y in enumerate(classes)}
    x = np.frombuffer(b"".join(w for w, _ in sample), np.uint8).reshape(-1, WINDOW)
    return fit(x, np.array([number[y] for _, y in sample]), classes)


def predict(docs: DataFrame, network: Network | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row its key, ``lang_pred`` and ``score``.

    All windows of the whole text count, by their bytes of text; the score is the mean probability of the language
    named. Null text, or text without letters, gives ``und`` with score 0, and so does every text without a network.
    Null keys, repeated rows and very long texts are treated as any other row; other columns are not read.
    """

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if network is not None:
            network.compile()
        for batch in batches(arrow, 64):
            cuts, owners, names, scores = [], [], [], []
            texts = batch.column(1).to_pylist()
            for i, t in enumerate(texts):
                if network is not None and t and any(map(str.isalpha, t)):
                    cut = cut_windows(t.encode("utf-8", "replace"))
                    cuts.append(cut)
                    owners.append(np.full(len(cut), i))
            sums = np.zeros((len(texts), len(network.classes) if network else 1))
            if cuts:
                x, owner = np.concatenate(cuts), np.concatenate(owners)
                for at in range(0, len(x), 512):
                    part = x[at : at + 512]
                    np.add.at(sums, owner[at : at + 512], np.exp(network.log_probabilities(part)) * np.count_nonzero(part, 1)[:, None])
            for row in sums:
                total = row.sum()
                names.append(network.classes[int(row.argmax())] if total else UNKNOWN)
                scores.append(min(1.0, float(row.max() / total)) if total else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["k", "lang_pred", "score"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`k` {kind}, lang_pred string, score double").withColumnRenamed("k", key)
