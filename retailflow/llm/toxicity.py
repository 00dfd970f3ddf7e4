"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols (insult, threat verb, target, negation, reporting verb, quote,
clause end and so on). Small transducers rewrite the symbols one after the other:
negation marks what stands in its scope, reported speech marks what is quoted, predicates and
exclamations are marked, targets mark what is aimed at someone, and the last machine emits
matched clauses. They are composed lazily into one machine, whose arcs carry weights: along a clause
they add up (strength of an insult, bonus of a target, discount of a negation), over the clauses
of a text they combine in the log semiring. The weights are fitted to labelled rows under bounds
that keep the grammar's order: an aimed insult counts as much as any other at least, a
threat as much as an aimed insult, and a negated or reported clause alone never reaches the threshold.
Insults and threats are learned from the same rows as words and word stems.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailflow.llm.common import labelled_sample, small_batches

#: Bounds of the training sample: clean and toxic texts.
SAMPLE = (2000, 1000)
THRESHOLD = 0.7
SCOPE = 4
#: Longest stem that is learned.
STEM = 10

# Fixed word lists of the grammar, in English, German, French and Spanish.
TARGETS = "you your yours yourself u du dein deine ihr tu ton vous votre tú usted ustedes vosotros".split()
#: Targets that are an object wherever they stand, so that they may come before their verb.
OBJECTS = "dich dir euch te toi ti".split()
NEGATIONS = "not no never nobody isn't aren't don't won't nicht kein keine nie ne pas jamais aucun nunca jamás ningún".split()
REPORTS = "said says say told wrote writes called calls reported sagte sagt schrieb nannte dit disait écrit dijo dice escribió llamó".split()
THREATS = "kill hurt destroy beat stab shoot burn strangle töten umbringen schlagen tuer frapper brûler matar golpear quemar".split()
INSULTS = "idiot moron stupid scum loser trash worthless pathetic disgusting clown".split()
COPULAS = "is are am was were be you're he's she's they're ist sind bist war est sont était es eres son era".split()
LEADS = "a an the what such ein eine was quel quelle un une qué una".split()

INSULT, THREAT, TARGET, OBJECT, NEGATION = "I", "V", "T", "P", "N"
REPORT, QUOTE, COPULA, LEAD, END, OTHER = "R", "Q", "B", "D", "E", "o"
SYMBOLS = (INSULT, THREAT, TARGET, OBJECT, NEGATION, REPORT, QUOTE, COPULA, LEAD, END, OTHER)
LISTED = {
    THREAT: THREATS,
    TARGET: TARGETS,
    OBJECT: OBJECTS,
    NEGATION: NEGATIONS,
    REPORT: REPORTS,
    COPULA: COPULAS,
    LEAD: LEADS,
}
_TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.!?;\n]|[\"«»“”„]")

Step = Callable[[object, str], tuple[object, str]]


def negation(state: int, symbol: str) -> tuple[int, str]:
    """Symbols within ``SCOPE`` words after a negation in the same clause get ``-``."""
    if symbol == NEGATION:
        return SCOPE, OTHER
    if symbol == END:
        return 0, symbol
    return max(0, state - 1), symbol + "-" if state and symbol in (INSULT, THREAT) else symbol


def reported(state: tuple[bool, bool], symbol: str) -> tuple[tuple[bool, bool], str]:
    """Symbols inside quotes, or after a reporting verb in the same clause, get ``"``."""
    quoted, said = state
    if symbol == QUOTE:
        return (not quoted, said), OTHER
    if symbol == REPORT:
        return (quoted, True), OTHER
    if symbol == END:
        return (quoted, False), symbol
    return state, symbol + '"' if (quoted or said) and symbol[0] in (INSULT, THREAT) else symbol


def standing(state: int, symbol: str) -> tuple[int, str]:
    """Insults that open a clause, or follow a copula within three words, get ``!``.

    State -1 is a clause of which nothing but articles and the like was read.
    """
    if symbol == END:
        return -1, symbol
    if symbol == COPULA:
        return 3, OTHER
    if symbol == LEAD:
        return (state if state < 0 else max(0, state - 1)), OTHER if state else symbol
    return max(0, state - 1), symbol + "!" if state and symbol[0] == INSULT else symbol


def aimed(state: int, symbol: str) -> tuple[int, str]:
    """Insults within ``SCOPE`` words after a target in the same clause get ``>``, threats after an object.

    The state is the words left, below zero if the target is an object.
    """
    if symbol in (TARGET, OBJECT):
        return SCOPE if symbol == TARGET else -SCOPE, TARGET
    if symbol == END:
        return 0, symbol
    hit = state < 0 if symbol[0] == THREAT else state != 0 and symbol[0] == INSULT
    return (state > 0) * (state - 1) + (state < 0) * (state + 1), symbol + ">" if hit else symbol


def clauses(state: str, symbol: str) -> tuple[str, str]:
    """Emits insults, aimed if a target is near, and threats whose object follows at once or went before.

    The state is a match that waits for its target, with the words left to find it. A
    threat without an object is none.
    """
    waiting, room = (state[:-1], int(state[-1])) if state else ("", 0)
    alone = waiting if waiting.startswith(INSULT) else ""
    if symbol[0] in (INSULT, THREAT):
        if ">" in symbol:
            return "", (alone + " " + symbol).strip()
        return symbol + str(SCOPE if symbol[0] == INSULT else 1), alone
    if symbol == TARGET and waiting:
        return "", waiting + ">"
    if symbol == END or room <= 1:
        return "", alone
    return waiting + str(room - 1), ""


class Composed(dict):
    """Transducers, each fed the output of the one before, as one deterministic machine.

    ``{(state, symbol): (state, output)}``; an arc is made when it is first walked, so only
    states that texts reach are held.
    """

    def __init__(self, steps: Iterable[tuple[object, Step]]) -> None:
        super().__init__()
        machines = list(steps)
        self.start = tuple(s for s, _ in machines)
        self.steps = tuple(step for _, step in machines)

    def __missing__(self, arc: tuple) -> tuple:
        states, out = arc
        after = []
        for state, step in zip(states, self.steps):
            state, out = step(state, out)
            after.append(state)
        self[arc] = tuple(after), out
        return self[arc]


def grammar() -> Composed:
    """Negation, reported speech, standing insults, targets and clauses as one machine."""
    return Composed([(0, negation), ((False, False), reported), (-1, standing), (0, aimed), ("", clauses)])


#: What an arc may weigh: parameters of the grammar, then the constant of a text.
STRENGTH, STANDING, AIMED, THREATENED, NEGATED, REPORTED, CONSTANT = range(7)


#: Bounds that keep the grammar's order, in the order of the parameters.
LEAST = np.array([0.0, 0.0, 0.5, 0.0, -np.inf, -np.inf, -np.inf])
MOST = np.array([np.inf, np.inf, np.inf, np.inf, 0.0, 0.0, -1.0])


def arc_weights(clause: str) -> np.ndarray:
    """How often each parameter is added along a clause.

    A negation or a report takes back what the clause has and will have, and leaves its own
    weight, counted from the constant; an aimed insult has what a standing one has, and more, and a
    threat more than that.
    """
    path = np.zeros(len(LEAST))
    if '"' in clause or "-" in clause:
        path[REPORTED if '"' in clause else NEGATED] = 1
        path[CONSTANT] = -1
        return path
    path[STRENGTH] = 1
    path[STANDING] = "!" in clause or ">" in clause
    path[AIMED] = ">" in clause
    path[THREATENED] = clause.startswith(THREAT)
    return path


class _Symbols(dict):
    """Symbol of each word: listed words, then learned stems by longest match."""

    def __init__(self, lexicon: dict[str, str], stems: frozenset[str]) -> None:
        super().__init__(lexicon)
        self.lexicon, self.stems = lexicon, stems
        self.lengths = sorted({len(s) for s in stems})

    def __missing__(self, word: str) -> str:
        hit = any(word[:n] in self.stems for n in self.lengths if n <= len(word))
        symbol = INSULT if hit else OTHER
        if len(self) > 400_000:
            self.clear()
            self.update(self.lexicon)
        if len(word) <= 64:
            self[word] = symbol
        return symbol


class ToxicityModel:
    """Learned insults and threats, and arc weights fitted by bounded Newton steps."""

    #: Weights before any label is seen, in the order of the parameters.
    PRIOR = np.array([3.0, 0.5, 0.5, 0.5, -2.0, -2.0, -3.0])

    def __init__(self, sample: list[tuple[str, int]]) -> None:
        words, stems, threats = learn_insults(sample)
        self.lexicon = {w: INSULT for w in [*INSULTS, *words]} | {w: THREAT for w in threats}
        for symbol, listed in LISTED.items():
            self.lexicon |= {w: symbol for w in listed if w not in self.lexicon}
        self.lexicon |= {c: END for c in ".!?;\n"} | {c: QUOTE for c in '"«»“”„'}
        self.stems = frozenset(stems)
        self._machine()
        self.weights = self._fit(sample)

    def _machine(self) -> None:
        self._arcs, self._symbols = grammar(), _Symbols(self.lexicon, self.stems)
        self._weights: dict[str, float] = {}

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._machine()

    def clauses(self, text: str) -> Counter:
        """Matched clauses of a whole text, with their marks."""
        symbols = list(map(self._symbols.__getitem__, _TOKEN.findall(text.lower())))
        found: Counter = Counter()
        if INSULT not in symbols and THREAT not in symbols:
            return found
        arcs = self._arcs
        state = arcs.start
        for symbol in [*symbols, END]:
            state, out = arcs[state, symbol]
            if out:
                found.update(out.split(" "))
        return found

    def _fit(self, sample: list[tuple[str, int]]) -> np.ndarray:
        if not sample:
            return self.PRIOR
        found = [self.clauses(t) for t, _ in sample]
        y = np.array([y for _, y in sample], dtype=np.float64)
        kinds = sorted(set().union(*found))
        n = np.array([[f[k] for k in kinds] for f in found], dtype=np.float64).reshape(len(found), len(kinds))
        path = np.array([arc_weights(k) for k in kinds]).reshape(len(kinds), len(LEAST))
        w = self.PRIOR.copy()
        for _ in range(60):  # the prior holds weights that no row tells about
            each = n * np.exp(path @ w)
            total = 1 + each.sum(axis=1)
            x = (each / total[:, None]) @ path  # how the log of the total moves with each weight
            x[:, CONSTANT] += 1
            p = 1 / (1 + np.exp(-np.log(total) - w[CONSTANT]))
            gradient = x.T @ (p - y) + (w - self.PRIOR)
            curvature = (x * (p * (1 - p))[:, None]).T @ x + np.eye(len(w))
            # Weights at a bound that they would cross stay there for this step.
            free = ~((w <= LEAST) & (gradient > 0) | (w >= MOST) & (gradient < 0))
            step = np.linalg.solve(curvature[np.ix_(free, free)], gradient[free])
            w[free] -= np.clip(step, -0.5, 0.5)
            w = np.clip(w, LEAST, MOST)
        return w

    def score(self, text: str | None) -> float:
        """Clauses of a text in the log semiring; a text without any has the constant alone."""
        total = 1.0
        if text:
            total += sum(n * math.exp(self._weight(c)) for c, n in self.clauses(text).items())
        return 1 / (1 + math.exp(-math.log(total) - self.weights[CONSTANT]))

    def _weight(self, clause: str) -> float:
        if clause not in self._weights:
            self._weights[clause] = float(arc_weights(clause) @ self.weights)
        return self._weights[clause]

    def scores(self, texts: Iterable[str | None]) -> np.ndarray:
        return np.array([self.score(t) for t in texts], dtype=np.float64)


def learn_insults(sample: list[tuple[str, int]], doubt: float = 1e-9) -> tuple[list[str], list[str], list[str]]:
    """Words and word stems that only toxic texts use, and which words are threats.

    A word, or a prefix of four letters or more, is counted by the different pairs of
    neighbours that it stands between, so copies of a text count once. It is taken if it is
    found in three texts, in toxic ones so often that chance would do it with
    probability below ``doubt``, and hardly ever in clean ones. A stem must head three
    different words, none of them most of its uses, and go with no shorter family of the
    same size. A word that a target follows in half of its uses in toxic texts is a threat.
    """
    texts = dict(sample).items()

    def words_of(text: str) -> list[str]:
        return [w for w in _TOKEN.findall(text.lower()) if w[0].isalpha()]

    def keys(word: str) -> list[str]:
        return [word + "$"] + [word[:n] for n in range(4, min(len(word), STEM) + 1)]

    # Texts are cut into words again in each pass, so that only counts are held.
    sizes, first, other = [0, 0], Counter(), Counter()
    for text, y in texts:
        own = words_of(text)
        sizes[y] += len(own)
        if y:
            first.update({k for w in set(own) for k in keys(w)})
    n_toxic, n_all = sizes[1], sum(sizes)
    if not n_toxic or n_toxic == n_all:
        return [], [], []
    first = Counter({k: n for k, n in first.items() if n >= 3})
    for text, y in texts:
        if not y:
            other.update({k for w in set(words_of(text)) for k in keys(w) if k in first})
    often = {k for k, n in first.items() if other[k] <= 0.05 * n}
    found: dict[str, tuple[set, set]] = {k: (set(), set()) for k in often}
    heads: dict[str, Counter] = {k: Counter() for k in often}
    objects: Counter = Counter()
    targets = {*TARGETS, *OBJECTS}
    for text, y in texts:
        own = words_of(text)
        for before, word, after in zip(["", *own], own, [*own[1:], ""]):
            for k in keys(word):
                if k in often:
                    found[k][y].add(hash((before, after)))
                    if y:
                        heads[k][word] += 1
                        objects[k] += after in targets
    odds = n_toxic / n_all
    toxic = {k: len(t) for k, (_, t) in found.items()}

    def sure(key: str) -> bool:
        hits, misses = len(found[key][1]), len(found[key][0])
        if misses > 0.02 * hits:
            return False
        # Chernoff bound on that many toxic contexts among all that the key has.
        n = hits + misses
        share = min(hits / n, 1 - 1e-9)
        gap = share * math.log(share / odds) + (1 - share) * math.log((1 - share) / (1 - odds))
        return share > odds and -n * gap < math.log(doubt)

    def several(key: str) -> bool:
        """Three words at least, none of which makes the stem what it is."""
        uses = heads[key].values()
        return len(uses) >= 3 and max(uses) <= 0.5 * sum(uses)

    words = sorted(k[:-1] for k in often if k.endswith("$") and sure(k))
    families: dict[frozenset, str] = {}
    for k in sorted((k for k in often if not k.endswith("$") and several(k) and sure(k)), key=len):
        families[frozenset(heads[k])] = k
    stems = [k for k in families.values() if not any(o != k and k.startswith(o) for o in families.values())]
    grown = [max((o for o in families.values() if o.startswith(k) and toxic[o] >= 0.95 * toxic[k]), key=len) for k in stems]
    threats = [w for w in words if 2 * objects[w + "$"] >= heads[w + "$"].total()]
    return [w for w in words if w not in threats], sorted(grown), threats


def train(docs: DataFrame, labels: DataFrame, modulus: int = 3, held_out: int = 1) -> ToxicityModel:
    """Fit on at most ``SAMPLE`` labelled texts outside the held-out fold."""
    return ToxicityModel(labelled_sample(docs, labels, "toxic", modulus, held_out, SAMPLE))


def score(text: Column, model: ToxicityModel, spark) -> Column:
    """Toxicity of a text column between 0 and 1; null and empty texts have no clause."""
    small_batches(spark)
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(sent.value.scores(texts), dtype="float64")

    return run(text)


def score_documents(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score, predicted`` of every row from its whole text alone, without a shuffle.

    Null and empty texts get the score of a text without clauses. Repeated rows and null
    ids are kept; other columns do not matter; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("i"), score(F.col(text_col), model, docs.sparkSession).alias("s"))
    return rows.select(F.col("i").alias(id_col), F.col("s").alias("score"), (F.col("s") >= THRESHOLD).cast("int").alias("predicted"))
