"""Language ID: averaged hashed subword embeddings with a linear softmax.

A text is lower-cased and every byte that is no letter becomes a blank; its 2- to
4-byte subwords within a word (blanks at the edges mark word ends) are hashed to
rows of an embedding table, averaged, and put through a linear softmax. Training
is stochastic gradient descent in numpy over a bounded sample; a held-back part of
it gives the temperature and the score below which a prediction is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 15
SIZES = (2, 3, 4)
TRAIN_ROWS = 1000      # sampled rows a language, at most about
TRAIN_LANGS = 500      # languages learned, the most frequent ones
TRAIN_BYTES = 2048     # of a sampled text, in four pieces evenly spaced over it
SLICE = 1 << 18        # bytes scored at a time
UNKNOWN = "und"

_LETTER = np.full(256, 0x20, np.uint8)
_LETTER[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTER[0x80:] = np.arange(0x80, 0x100)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


def letters(text: str) -> np.ndarray:
    """Lower-cased bytes with one blank at each end and non-letters as blanks."""
    return _LETTER[np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)]


def subwords(b: np.ndarray) -> np.ndarray:
    """Hash rows of all subwords; none has a blank inside."""
    x = b.astype(np.uint32)
    blank = b == 0x20
    out = []
    for n in SIZES:
        if len(x) < n:
            continue
        k = len(x) - n + 1
        h = np.full(k, n, np.uint32)
        ok = np.ones(k, bool)
        for i in range(n):
            h = h * np.uint32(0x01000193) ^ x[i:i + k]
            if 0 < i < n - 1:
                ok &= ~blank[i:i + k]
        ok &= ~(blank[:k] & blank[n - 1:n - 1 + k])
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        out.append((h[ok] >> np.uint32(32 - 15)).astype(np.int32))
    return np.concatenate(out) if out else np.zeros(0, np.int32)


class SubwordSoftmax:
    def __init__(self, langs: list[str], dim: int = 16, seed: int = 7):
        r = np.random.default_rng(seed)
        self.langs = langs
        self.emb = r.normal(0, 0.1, (BUCKETS, dim)).astype(np.float32)
        self.out = np.zeros((dim, len(langs)), np.float32)
        self.bias = np.zeros(len(langs), np.float32)
        self.heat, self.reject, self.table = 1.0, 0.0, None

    def fit(self, rows: list[np.ndarray], y: np.ndarray, epochs: int = 6, batch: int = 32, rate: float = 4.0,
            seed: int = 13) -> SubwordSoftmax:
        r = np.random.default_rng(seed)
        order = r.permutation(len(rows))
        held, train = order[:len(order) // 8], order[len(order) // 8:]
        steps, step = max(1, epochs * -(-len(train) // batch)), 0
        for _ in range(epochs):
            for i in range(0, len(train), batch):
                idx = r.permutation(train)[:batch] if i == 0 else train[i:i + batch]
                x = np.zeros((len(idx), BUCKETS), np.float32)
                for k, j in enumerate(idx):
                    if len(rows[j]):
                        x[k] = np.bincount(rows[j], minlength=BUCKETS) / len(rows[j])
                h = x @ self.emb
                d = self._softmax(h @ self.out + self.bias)
                d[np.arange(len(idx)), y[idx]] -= 1
                d /= len(idx)
                lr = rate * (1 - step / steps) + 0.01
                step += 1
                grad = x.T @ (d @ self.out.T)
                self.out -= lr * (h.T @ d)
                self.bias -= 0.1 * lr * d.sum(0)
                self.emb -= lr * 50 * grad
            r.shuffle(train)
        self.table = self.emb @ self.out
        self._calibrate([rows[j] for j in held], y[held])
        return self

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def _calibrate(self, rows: list[np.ndarray], y: np.ndarray, wanted: float = 0.99) -> None:
        """Temperature of least log loss, and the lowest score from which precision is ``wanted``."""
        if not len(y):
            return
        z = np.stack([self.logits(x) for x in rows])
        heats = np.geomspace(0.2, 5, 33)
        loss = [-np.log(self._softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean() for t in heats]
        self.heat = float(heats[int(np.argmin(loss))])
        p = self._softmax(z / self.heat)
        top, right = p.max(1), p.argmax(1) == y
        order = np.argsort(-top)
        precision = np.cumsum(right[order]) / np.arange(1, len(y) + 1)
        good = np.nonzero(precision >= wanted)[0]
        self.reject = float(top[order][good[-1]]) if len(good) else 1.0

    def logits(self, rows: np.ndarray) -> np.ndarray:
        return self.table[rows].sum(0, dtype=np.float64) / max(1, len(rows)) + self.bias

    def _text_logits(self, b: np.ndarray) -> np.ndarray:
        """Mean over all subwords of the text, in slices that end at a blank (bounded memory, each subword once)."""
        total, n, i = np.zeros(len(self.langs)), 0, 0
        while i < len(b) - 1:
            j = i + SLICE
            if j < len(b):
                blanks = np.nonzero(b[j:] == 0x20)[0][:1]
                j = j + int(blanks[0]) + 1 if len(blanks) else len(b)
            s = subwords(b[i:j])
            total += self.table[s].sum(0, dtype=np.float64)
            n += len(s)
            i = min(j, len(b)) - 1   # the blank belongs to both slices
        return total / max(1, n) + self.bias

    def predict(self, texts) -> tuple[list[str], list[float], list[bool]]:
        langs, scores, sure = [], [], []
        for t in texts:
            if not has_letter(t):
                langs.append(UNKNOWN)
                scores.append(0.0)
                sure.append(False)
                continue
            p = self._softmax((self._text_logits(letters(t)) / self.heat)[None])[0]
            k = int(p.argmax())
            langs.append(self.langs[k])
            scores.append(float(p[k]))
            sure.append(bool(p[k] >= self.reject))
        return langs, scores, sure


def _excerpt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for t in b.column("_text"):
            s = t.as_py()
            part = TRAIN_BYTES // 4
            out.append(s if len(s) <= TRAIN_BYTES else " ".join(s[int(i):int(i) + part] for i in np.linspace(0, len(s) - part, 4)))
        yield pa.RecordBatch.from_arrays([b.column("_lang"), b.column("_h"), pa.array(out, pa.string())], ["_lang", "_h", "_text"])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        rows: int = TRAIN_ROWS, langs: int = TRAIN_LANGS) -> SubwordSoftmax | None:
    """Fit on about ``rows`` texts of every language, drawn by a seeded hash; with more than
    ``langs`` languages on fewer of each, ``rows`` * ``langs`` in all, and at least one. Null
    languages and texts never train. None if nothing is left."""
    base = docs.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text")).where(
        F.col("_lang").isNotNull() & F.col("_text").isNotNull())
    h = F.xxhash64(F.lit(23), "_id", "_text")
    place = F.pmod(h, F.lit(1_000_000))
    counts = base.groupBy("_lang").agg(F.count(F.lit(1)).alias("count"), F.min(place).alias("least")).collect()
    if not counts:
        return None
    each = min(rows, max(1, rows * langs // len(counts)))
    share = docs.sparkSession.createDataFrame(
        [(r["_lang"], max(1_000_000 * min(1.0, each / r["count"]), r["least"] + 1.0)) for r in counts], "_lang string, _p double")
    drawn = (base.join(F.broadcast(share), "_lang").withColumn("_h", h)  # one row a language
             .where(place < F.col("_p")).select("_lang", "_h", "_text")
             .mapInArrow(_excerpt, "_lang string, _h long, _text string").orderBy("_h").limit((2 * each + 1) * len(counts)).collect())
    names = sorted(r["_lang"] for r in counts)
    at = {x: i for i, x in enumerate(names)}
    model = SubwordSoftmax(names)
    x = [subwords(letters(r["_text"])) for r in drawn]
    return model.fit(x, np.array([at[r["_lang"]] for r in drawn], int))


def identified(docs: DataFrame, model: SubwordSoftmax | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``lang_score`` and ``lang_sure`` (false: rejected).

    A null text or one without a letter gives ``und``, 0 and false, as does every
    text when no language was learned.
    """

    @F.pandas_udf("lang string, score double, sure boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        if model is None:
            return pd.DataFrame({"lang": [UNKNOWN] * len(texts), "score": 0.0, "sure": False})
        lang, score, sure = model.predict(None if x is None or x != x else x for x in texts)
        return pd.DataFrame({"lang": lang, "score": score, "sure": sure})

    out = docs.withColumn("_pred", predict(F.col(text_col)))
    return (out.withColumn("lang_pred", F.col("_pred.lang")).withColumn("lang_score", F.col("_pred.score"))
            .withColumn("lang_sure", F.col("_pred.sure")).drop("_pred"))
