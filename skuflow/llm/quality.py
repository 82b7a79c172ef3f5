"""Quality classifier: a byte-level convolutional network in numpy.

A document's UTF-8 bytes are cut into overlapping chunks that cover all of it.
Each chunk is embedded byte by byte, convolved with learned filters (8 bytes wide,
stride 4) and max-pooled over its positions; the chunks' vectors are combined by
their maximum and mean into one probability. Training runs on the driver over a
bounded sample of labelled rows; scoring runs in tasks over all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK, STEP, BLOCK = 512, 448, 4
PAD = 256
TRAIN_ROWS = 4000    # labelled rows a model is fitted on, at most
TRAIN_CHUNKS = 6     # chunks of such a row, evenly spaced
GROUP = 1024         # chunks convolved at a time


def chunk_matrix(text: str | None) -> np.ndarray:
    """All chunks of a text, one a row; a text shorter than a chunk (also an empty one) is padded."""
    raw = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8).astype(np.int16)
    n = max(1, -(-(len(raw) - (CHUNK - STEP)) // STEP))
    padded = np.full((n - 1) * STEP + CHUNK, PAD, np.int16)
    padded[:len(raw)] = raw
    return np.lib.stride_tricks.as_strided(padded, (n, CHUNK), (2 * STEP, 2))


class ByteConv:
    """Embedding, strided convolution, max over positions, max and mean over chunks, logistic output."""

    def __init__(self, dim: int = 8, filters: int = 24, seed: int = 3):
        r = np.random.default_rng(seed)
        self.p = {
            "emb": r.normal(0, 0.5, (PAD + 1, dim)).astype(np.float32),
            "conv": r.normal(0, 0.12, (BLOCK * dim, 2 * filters)).astype(np.float32),  # left half | right half of a filter
            "bias": np.zeros(filters, np.float32),
            "out": r.normal(0, 0.1, 2 * filters).astype(np.float32),
            "out_bias": np.zeros(1, np.float32),
        }
        self.p["emb"][PAD] = 0
        self.filters, self.dim = filters, dim

    def responses(self, chunks: np.ndarray) -> np.ndarray:
        """(chunks, positions, filters) before the nonlinearity."""
        n, f = len(chunks), self.filters
        x = self.p["emb"][chunks].reshape(n * (CHUNK // BLOCK), BLOCK * self.dim)
        y = (x @ self.p["conv"]).reshape(n, CHUNK // BLOCK, 2 * f)
        return y[:, :-1, :f] + y[:, 1:, f:] + self.p["bias"]

    def pooled(self, chunks: np.ndarray) -> np.ndarray:
        out = np.empty((len(chunks), self.filters), np.float32)
        for i in range(0, len(chunks), GROUP):
            out[i:i + GROUP] = self.responses(chunks[i:i + GROUP]).max(1)
        return np.maximum(out, 0)

    def combine(self, pooled: np.ndarray, starts: np.ndarray) -> np.ndarray:
        counts = np.diff(np.append(starts, len(pooled)))[:, None]
        return np.concatenate([np.maximum.reduceat(pooled, starts), np.add.reduceat(pooled, starts) / counts], 1)

    def probability(self, vectors: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(vectors @ self.p["out"] + self.p["out_bias"][0], -30, 30)))

    def score(self, texts) -> np.ndarray:
        out = []
        parts: list[np.ndarray] = []
        starts: list[int] = []
        n = 0

        def flush() -> None:
            nonlocal n
            if starts:
                out.append(self.probability(self.combine(np.concatenate(parts), np.array(starts))))
            parts.clear()
            starts.clear()
            n = 0

        wait: list[np.ndarray] = []
        waiting = 0

        def convolve() -> None:
            nonlocal waiting
            if wait:
                parts.append(self.pooled(np.concatenate(wait)))
            wait.clear()
            waiting = 0

        for t in texts:
            c = chunk_matrix(t)
            starts.append(n)
            n += len(c)
            wait.append(c)
            waiting += len(c)
            if waiting >= GROUP:
                convolve()
            if n >= 64 * GROUP:
                convolve()
                flush()
        convolve()
        flush()
        return np.concatenate(out) if out else np.zeros(0)

    def fit(self, docs: list[np.ndarray], labels: np.ndarray, epochs: int = 6, batch: int = 32,
            rate: float = 0.004, seed: int = 5) -> ByteConv:
        """Adam on the log loss; the max passes a filter's gradient to the one place that won it."""
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        f, d = self.filters, self.dim
        step = 0
        rise = float(np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1)))
        self.p["out_bias"][0] = rise
        for epoch in range(epochs):
            order = r.permutation(len(docs))
            for i in range(0, len(order), batch):
                idx = order[i:i + batch]
                chunks = np.concatenate([docs[j] for j in idx])
                sizes = np.array([len(docs[j]) for j in idx])
                starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                owner = np.repeat(np.arange(len(idx)), sizes)
                resp = self.responses(chunks)
                place = resp.argmax(1)                                   # (chunks, filters)
                top = np.take_along_axis(resp, place[:, None, :], 1)[:, 0]
                pooled = np.maximum(top, 0)
                vec = self.combine(pooled, starts)
                delta = (self.probability(vec) - labels[idx]).astype(np.float32) / len(idx)
                g = {"out": vec.T @ delta + 1e-4 * self.p["out"], "out_bias": np.array([delta.sum()], np.float32)}
                back = delta[owner][:, None] * (
                    self.p["out"][:f] * (pooled == vec[owner, :f]) + self.p["out"][f:] / sizes[owner][:, None]) * (top > 0)
                g["bias"] = back.sum(0)
                # bytes under each winning window: 8 of them for every chunk and filter
                where = place[:, :, None] * BLOCK + np.arange(2 * BLOCK)
                won = np.take_along_axis(chunks[:, None, :], where, 2)       # (chunks, filters, 8)
                x = self.p["emb"][won].reshape(len(chunks), f, 2 * BLOCK * d)
                gw = np.einsum("cf,cfx->fx", back, x)
                g["conv"] = np.concatenate([gw[:, :BLOCK * d].T, gw[:, BLOCK * d:].T], 1)
                w = np.concatenate([self.p["conv"][:, :f].T, self.p["conv"][:, f:].T], 1).reshape(f, 2 * BLOCK, d)
                ge = np.zeros_like(self.p["emb"])
                np.add.at(ge, won.reshape(-1), (back[:, :, None, None] * w).reshape(-1, d))
                ge[PAD] = 0
                g["emb"] = ge
                step += 1
                for k in self.p:
                    m[k] = 0.9 * m[k] + 0.1 * g[k]
                    v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                    self.p[k] -= (rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
        return self


def remainder(id_col: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id gives null."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % mod


def _pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for t in b.column("_text"):
            c = chunk_matrix(t.as_py())
            at = np.unique(np.linspace(0, len(c) - 1, TRAIN_CHUNKS).astype(int))
            out.append(c[at].astype(np.int16).tobytes())
        yield pa.RecordBatch.from_arrays([b.column("_y"), b.column("_h"), pa.array(out, pa.binary())], ["_y", "_h", "_chunks"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        rows: int = TRAIN_ROWS, holdout: Column | None = None) -> ByteConv:
    """Fit on at most ``rows`` labelled rows in seeded hash order (null labels and ids never train).

    ``holdout`` marks labels that must not be learned from. With no labelled row, or
    only one class, the model keeps its start and gives the observed class's odds.
    """
    usable = labels.select(F.col(id_col).alias("_lid"), F.col(label_col).alias("_y"), *(
        [] if holdout is None else [holdout.alias("_out")])).where(F.col("_y").isNotNull() & F.col("_lid").isNotNull())
    if holdout is not None:
        usable = usable.where(~F.coalesce("_out", F.lit(False))).drop("_out")
    picked = usable.groupBy("_lid").agg(F.max("_y").alias("_y")).orderBy(F.xxhash64(F.lit(11), "_lid"), "_lid").limit(rows)
    # at most ``rows`` ids: a bounded broadcast
    texts = docs.select(F.col(id_col).alias("_lid"), F.col(text_col).alias("_text")).join(F.broadcast(picked), "_lid")
    sample = (texts.select(F.col("_y").cast("double").alias("_y"), F.xxhash64("_lid", "_text").alias("_h"), "_text")
              .mapInArrow(_pick, "_y double, _h long, _chunks binary").orderBy("_h", "_y").limit(rows).collect())
    model = ByteConv()
    if sample:
        y = np.array([r["_y"] for r in sample], np.float32)
        chunks = [np.frombuffer(bytes(r["_chunks"]), np.int16).reshape(-1, CHUNK) for r in sample]
        model.fit(chunks, y)
    return model


def scored(docs: DataFrame, model: ByteConv, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the probability that a text is of quality 1; null and empty texts are scored as empty."""

    @F.pandas_udf("double")
    def probability(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(texts), dtype="float64")

    return docs.withColumn(name, probability(F.col(text_col)))
