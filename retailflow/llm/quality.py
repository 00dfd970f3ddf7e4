"""Document quality: random-indexing word vectors, pooled, and a two-layer network.

Every word has a fixed sparse random index vector. A word's meaning vector is the sum
of the index vectors of its neighbours in the training texts. A document is the mean of the
meaning vectors of its tokens; tokens are words, runs of signs, and marks for capitals and
for a word that repeats the one before. A network of two layers, written in numpy, scores
the pooled vector; its temperature is fitted on training rows that it did not see.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailflow.llm.common import labelled_sample, small_batches

#: Bounds of the training sample: poor and good texts.
SAMPLE = (1000, 1500)
THRESHOLD = 0.3
DIMENSION = 64
NONZERO = 8
VOCABULARY = 20_000
WINDOW = 2
HIDDEN = 32

CAPITALS, AGAIN, SHORT, LONG, NUMBER = "<capitals>", "<again>", "<short>", "<long>", "<number>"
_TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|_+")


def shape(token: str) -> str:
    """What an unknown token counts as."""
    if token[0].isdigit():
        return NUMBER
    if not token[0].isalpha():
        return f"<{token[0]}{min(len(token), 3)}>"
    return SHORT if len(token) < 8 else LONG


def index_vector(token: str) -> np.ndarray:
    """The sparse random vector of a token, a function of its letters alone."""
    rng = np.random.default_rng(zlib.crc32(token.encode("utf-8", "surrogatepass")))
    vector = np.zeros(DIMENSION, dtype=np.float32)
    at = rng.choice(DIMENSION, NONZERO, replace=False)
    vector[at] = rng.choice([-1.0, 1.0], NONZERO)
    return vector


class _Ids(dict):
    """Row of each token in the vector table; unknown tokens get the row of their shape."""

    def __init__(self, known: dict[str, int]) -> None:
        super().__init__(known)
        self.known = known

    def __missing__(self, token: str) -> int:
        low = token.lower()
        at = self.known.get(low, self.known.get(shape(low), 0))
        if len(self) > 400_000:
            self.clear()
            self.update(self.known)
        if len(token) <= 64:
            self[token] = at
        return at


class WordVectors:
    """Random-indexing vectors of the most frequent tokens, and of all shapes and marks."""

    def __init__(self, texts: list[str]) -> None:
        tokens = [_TOKEN.findall(t) for t in texts]
        counts = Counter(t.lower() for own in tokens for t in own)
        shapes = Counter(shape(t) for t in counts)
        common = [t for t, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:VOCABULARY]]
        names = ["<none>", CAPITALS, AGAIN, SHORT, LONG, NUMBER]
        names += sorted(set(shapes) - set(names)) + [t for t in common if not t.startswith("<")]
        self.known = {t: n for n, t in enumerate(dict.fromkeys(names))}
        self._ids: _Ids | None = None
        index = np.stack([index_vector(t) for t in self.known])
        index[0] = 0
        total = np.zeros((len(self.known), DIMENSION), dtype=np.float64)
        gap_rows = np.zeros(WINDOW, dtype=np.int64)  # keeps the words of two texts apart
        ids = np.concatenate([part for own in tokens for part in (self._rows(own), gap_rows)] or [gap_rows])
        for gap in range(1, WINDOW + 1):
            for word, neighbour in ((ids[gap:], ids[:-gap]), (ids[:-gap], ids[gap:])):
                for d in range(DIMENSION):
                    total[:, d] += np.bincount(word, weights=index[:, d][neighbour], minlength=len(total))
        total[0] = 0
        # What all words share says nothing; the own index vector keeps words apart.
        total /= np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-9)
        total -= total.mean(axis=0)
        self.table = (total + index / np.sqrt(NONZERO)).astype(np.float32)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_ids": None}

    def _rows(self, tokens: list[str]) -> np.ndarray:
        if self._ids is None:
            self._ids = _Ids(self.known)
        return np.fromiter(map(self._ids.__getitem__, tokens), dtype=np.int64, count=len(tokens))

    def pool(self, text: str | None) -> np.ndarray:
        """Mean vector of a whole text, its marks included; zero without tokens."""
        tokens = _TOKEN.findall(text) if text else []
        if not tokens:
            return np.zeros(DIMENSION)
        total = np.zeros(DIMENSION)
        for at in range(0, len(tokens), 65536):
            total += self.table[self._rows(tokens[at : at + 65536])].sum(axis=0, dtype=np.float64)
        words = text.split()
        again = sum(map(eq, words, words[1:]))
        capitals = sum(map(str.isupper, tokens))
        total += again * self.table[self.known[AGAIN]] + capitals * self.table[self.known[CAPITALS]]
        return total / len(tokens)


class QualityModel:
    """A network of two layers on pooled vectors, with calibrated probabilities."""

    def __init__(self, sample: list[tuple[str, int]], rounds: int = 400) -> None:
        self.vectors = WordVectors([t for t, _ in sample])
        y = np.array([y for _, y in sample], dtype=np.float64)
        self.constant = (y.sum() + 1) / (len(y) + 2)
        self.layers = None
        if len(set(y)) < 2:
            return
        x = np.stack([self.vectors.pool(t) for t, _ in sample])
        self.center, self.spread = x.mean(axis=0), np.maximum(x.std(axis=0), 0.02)
        x = (x - self.center) / self.spread
        # Every fifth row fits the temperature; small samples use all rows for both.
        unseen = np.arange(len(x)) % 5 == 0 if len(x) >= 50 else np.ones(len(x), dtype=bool)
        seen = ~unseen if len(x) >= 50 else unseen
        self.layers = self._descend(x[seen], y[seen], rounds)
        logits = self._logits(x[unseen])
        scales = np.geomspace(0.25, 8, 60)
        losses = [np.logaddexp(0, np.where(y[unseen] == 1, -1, 1) * logits / s).mean() for s in scales]
        self.temperature = float(scales[int(np.argmin(losses))])

    def _descend(self, x: np.ndarray, y: np.ndarray, rounds: int) -> list[np.ndarray]:
        rng = np.random.default_rng(7)
        layers = [
            rng.normal(0, 1 / np.sqrt(DIMENSION), (DIMENSION, HIDDEN)),
            np.zeros(HIDDEN),
            rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN),
            np.zeros(1),
        ]
        # Both classes weigh the same, however rare.
        weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
        first, second = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers]
        for n in range(1, rounds + 1):
            a, b, c, d = layers
            hidden = np.tanh(x @ a + b)
            error = weight * (1 / (1 + np.exp(-(hidden @ c + d))) - y)
            back = error[:, None] * c * (1 - hidden**2)
            gradients = [x.T @ back + 1e-4 * a, back.sum(axis=0), hidden.T @ error + 1e-4 * c, np.array([error.sum()])]
            for w, g, m, v in zip(layers, gradients, first, second):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= 0.02 * (m / (1 - 0.9**n)) / (np.sqrt(v / (1 - 0.99**n)) + 1e-8)
        return layers

    def _logits(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.layers
        return np.tanh(x @ a + b) @ c + d

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Probability of good quality; the training share where the text has no token."""
        if self.layers is None:
            return np.full(len(texts), self.constant)
        x = np.array([self.vectors.pool(t) for t in texts]).reshape(-1, DIMENSION)
        out = 1 / (1 + np.exp(-self._logits((x - self.center) / self.spread) / self.temperature))
        return np.where(np.abs(x).sum(axis=1) > 0, out, self.constant)


def train(docs: DataFrame, labels: DataFrame, modulus: int = 5, held_out: int = 0) -> QualityModel:
    """Fit on at most ``SAMPLE`` labelled texts outside the held-out fold."""
    return QualityModel(labelled_sample(docs, labels, "quality", modulus, held_out, SAMPLE))


def score(text: Column, model: QualityModel, spark) -> Column:
    """Quality of a text column between 0 and 1."""
    small_batches(spark)
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(sent.value.scores(texts.tolist()), dtype="float64")

    return run(text)


def score_documents(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score, predicted`` of every row from its whole text alone, without a shuffle.

    Texts that are null, empty or without tokens get the share of good training rows.
    Repeated rows and null ids are kept; other columns do not matter; an empty
    table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("i"), score(F.col(text_col), model, docs.sparkSession).alias("s"))
    return rows.select(F.col("i").alias(id_col), F.col("s").alias("score"), (F.col("s") >= THRESHOLD).cast("int").alias("predicted"))
