"""Language identification with a string kernel.

A text is the set of its character n-grams of one to three letters (a blended
spectrum, by presence). The kernel of two texts is the size of the intersection over
the root of the product of their sizes. Landmark texts give a Nyström map;
one-versus-rest kernel ridge regression is solved on it. Scoring a batch is two matrix
products: presences by landmark n-grams, kernels by weights.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retailflow.llm.common import fold, small_batches, texts_of

#: Letters with a code of their own; code 0 is everything that is no letter, the last other letters.
LETTERS = 62
BASE = LETTERS + 2
GRAMS = BASE + BASE**2 + BASE**3
SAMPLE_PER_LANG = 250
LANDMARKS_PER_LANG = 16
BATCH_TEXTS = 128
UNDETERMINED = "und"


class SpectrumKernel:
    """N-gram presence of texts over an alphabet, and kernels with landmark texts."""

    def __init__(self, texts: list[str]) -> None:
        counts = Counter(c for t in texts for c in t.lower() if c.isalpha())
        self.alphabet = "".join(sorted(c for c, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:LETTERS]))
        self._codes: np.ndarray | None = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_codes": None}

    def codes(self) -> np.ndarray:
        if self._codes is None:
            codes = np.zeros(0x110000, dtype=np.uint8)
            codes[[n for n in range(0x110000) if chr(n).isalpha()]] = BASE - 1
            for n, c in enumerate(self.alphabet):
                codes[ord(c)] = n + 1
            self._codes = codes
        return self._codes

    def grams(self, text: str) -> np.ndarray | None:
        """Distinct n-gram codes of a text; None if it has no letter."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        one = self.codes()[points].astype(np.int32)
        if not one.any():
            return None
        one = np.concatenate([[0], one, [0]])
        one = one[(one > 0) | np.concatenate([[True], one[:-1] > 0])]  # one gap between words
        two = one[:-1] * BASE + one[1:]
        three = two[:-1] * BASE + one[2:]
        seen = np.zeros(GRAMS, dtype=bool)
        seen[one] = True
        seen[two + BASE] = True
        seen[three + (BASE + BASE**2)] = True
        return np.flatnonzero(seen)

    def set_landmarks(self, grams: list[np.ndarray]) -> None:
        self.known = np.unique(np.concatenate(grams))
        place = np.full(GRAMS, -1, dtype=np.int32)
        place[self.known] = np.arange(len(self.known))
        self.place = place
        self.presence = np.zeros((len(grams), len(self.known)), dtype=np.float32)
        for row, own in zip(self.presence, grams):
            row[place[own]] = 1
        self.sizes = np.sqrt(np.array([len(g) for g in grams], dtype=np.float64))

    def to_landmarks(self, grams: list[np.ndarray]) -> np.ndarray:
        """Kernel of each text with each landmark, as a matrix product of presences."""
        rows = np.zeros((len(grams), len(self.known)), dtype=np.float32)
        for row, own in zip(rows, grams):
            at = self.place[own]
            row[at[at >= 0]] = 1
        sizes = np.sqrt(np.array([len(g) for g in grams], dtype=np.float64))
        return (rows @ self.presence.T) / (sizes[:, None] * self.sizes)


class LanguageModel:
    """One-versus-rest ridge regression on the Nyström map of the kernel."""

    def __init__(self, sample: list[tuple[str, str]], ridge: float = 0.01) -> None:
        self.kernel = SpectrumKernel([t for t, _ in sample])
        pairs = [(g, y) for t, y in sample if (g := self.kernel.grams(t)) is not None]
        self.langs = sorted({y for _, y in pairs})
        if not pairs:
            return
        landmarks = []
        for lang in self.langs:
            landmarks += [g for g, y in pairs if y == lang][:LANDMARKS_PER_LANG]
        self.kernel.set_landmarks(landmarks)
        among = self.kernel.to_landmarks(landmarks)
        values, vectors = np.linalg.eigh((among + among.T) / 2)
        usable = values > 1e-6 * values.max()
        root = vectors[:, usable] / np.sqrt(values[usable])
        x = np.concatenate(
            [self.kernel.to_landmarks([g for g, _ in pairs[n : n + BATCH_TEXTS]]) for n in range(0, len(pairs), BATCH_TEXTS)]
        )
        x = x @ root
        y = np.array([[1.0 if lang == own else -1.0 for lang in self.langs] for _, own in pairs])
        # Languages weigh the same however many texts they have.
        weight = np.array([1 / sum(o == own for _, o in pairs) for _, own in pairs])[:, None]
        x1 = np.hstack([x, np.ones((len(x), 1))])
        gram = x1.T @ (weight * x1) + ridge / len(x) * np.eye(x1.shape[1])
        solved = np.linalg.solve(gram, x1.T @ (weight * y))
        self.weights, self.bias = root @ solved[:-1], solved[-1]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; see ``identify``."""
        langs, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        if not self.langs:
            return langs, scores
        for at in range(0, len(texts), BATCH_TEXTS):
            grams = [(n, g) for n in range(at, min(at + BATCH_TEXTS, len(texts))) if texts[n] and (g := self.kernel.grams(texts[n])) is not None]
            if not grams:
                continue
            margins = self.kernel.to_landmarks([g for _, g in grams]) @ self.weights + self.bias
            odds = np.exp(4 * (margins - margins.max(axis=1, keepdims=True)))
            share = odds / odds.sum(axis=1, keepdims=True)
            best = margins.argmax(axis=1)
            for (n, _), b, s in zip(grams, best, share[np.arange(len(best)), best]):
                langs[n], scores[n] = self.langs[b], s
        return langs, scores


def train(docs: DataFrame, modulus: int = 4, held_out: int = 2, per_lang: int = SAMPLE_PER_LANG) -> LanguageModel:
    """Fit on at most ``per_lang`` texts per language, outside the held-out fold, by id hash."""
    known = docs.select(F.col("doc_id").alias("i"), F.col("lang").alias("y")).filter(
        F.col("i").isNotNull() & F.col("y").isNotNull() & (fold(F.col("i"), modulus) != held_out)
    )
    order = Window.partitionBy("y").orderBy(F.xxhash64("i"), "i")
    first = known.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= per_lang)
    return LanguageModel(texts_of(docs, [(r["i"], r["y"]) for r in first.select("i", "y").collect()], "string"))


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, lang_pred, score`` of every row from its whole text alone.

    ``und`` with score 0 if the text is null or has no letters, or nothing was learned.
    Repeated rows and null ids are kept; other columns do not matter.
    """
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        langs, scores = sent.value.predict(texts.tolist())
        return pd.DataFrame({"lang_pred": langs, "score": scores})

    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    return rows.select(F.col("i").alias(id_col), run("t").alias("r")).select(id_col, "r.*")
