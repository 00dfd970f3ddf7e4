"""Toxicity: the composed machine against plain matching, learning, every kind of row."""

import math
import pickle
import random

import numpy as np
import pytest

from retailflow.llm import queries, toxicity
from retailflow.llm.toxicity import ToxicityModel

SF_DIR = "/root/testdata/sf0.01"


def kinds(text):
    return dict(ToxicityModel([]).clauses(text))


def test_clauses():
    assert kinds("what an idiot.") == {"I!": 1}
    assert kinds("the house of an idiot.") == {"I": 1}
    assert kinds("you are an idiot.") == {"I!>": 1}
    assert kinds("this man is an idiot.") == {"I!": 1}
    assert kinds("idiot, you") == {"I!>": 1}
    assert kinds("you are not an idiot") == {"I-!>": 1}
    assert kinds('he said "you idiot" today') == {'I">': 1}
    assert kinds("I will kill you!") == {"V>": 1}
    assert kinds("I will not kill you!") == {"V->": 1}
    assert kinds("kill the lights before you go") == {}
    assert kinds("if you kill the lights") == {}
    assert kinds("ich werde dich töten") == {"V>": 1}
    assert kinds("te voy a matar") == {"V>": 1}
    assert kinds("they kill time") == {}
    assert kinds("one moron and idiot and clown") == {"I": 3}
    assert kinds("not here. an old idiot") == {"I": 1}
    assert kinds("a clean text, for you") == {}
    assert kinds("") == {}


def steps():
    return [
        [0, toxicity.negation],
        [(False, False), toxicity.reported],
        [-1, toxicity.standing],
        [0, toxicity.aimed],
        ["", toxicity.clauses],
    ]


def test_machine_equals_its_parts():
    arcs = toxicity.grammar()
    rng = random.Random(1)
    for _ in range(300):
        symbols = rng.choices(toxicity.SYMBOLS, k=40)
        state, got = arcs.start, []
        parts = steps()
        want = []
        for symbol in symbols:
            state, out = arcs[state, symbol]
            got.append(out)
            for part in parts:
                part[0], symbol = part[1](part[0], symbol)
            want.append(symbol)
        assert got == want
    assert len(arcs) <= 12_000


def sample(seed, n=300):
    """Texts of plain words; toxic ones hold insults in the middle of them."""
    rng = random.Random(seed)
    words = "haus baum weg see licht stein wolke feld you said not is the and".split()
    texts = []
    for i in range(n):
        own = rng.choices(words, k=30)
        toxic = i % 3 == 0
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                own.insert(rng.randrange(30), rng.choice(toxicity.INSULTS))
        texts.append((" ".join(own) + ".", int(toxic)))
    return texts


@pytest.mark.parametrize("seed", range(3))
def test_clauses_weigh_more_than_words(seed):
    model = ToxicityModel(sample(seed))
    by = lambda text: model.score(text)
    assert by("you are an idiot") >= 0.7 and by("I will kill you") >= 0.7
    assert by("I will kill you") >= by("hey you idiot") >= by("an idiot") >= by("one big fat idiot")
    for harmless in ("kill the lights before you go", "you are not an idiot", "I will not kill you", 'he said "you idiot"'):
        assert by(harmless) < toxicity.THRESHOLD, harmless
    assert by("idiot and moron and scum") > by("idiot")


@pytest.mark.parametrize("texts", [[], sample(5), sample(6, 30), [("you idiot", 1)], [("you idiot", 0)] * 20])
def test_score_and_fit_by_hand(texts):
    """Scores clause by clause without the machine, and no small move of a weight that fits better."""
    model = ToxicityModel(texts)

    def by_hand(text, w):
        total, parts = 1.0, steps()
        for token in [*toxicity._TOKEN.findall(text.lower()), "."]:
            symbol = model._symbols[token]
            for part in parts:
                part[0], symbol = part[1](part[0], symbol)
            for clause in symbol.split():
                total += math.exp(toxicity.arc_weights(clause) @ w)
        return 1 / (1 + math.exp(-math.log(total) - w[toxicity.CONSTANT]))

    def loss(w):
        chances = [by_hand(t, w) for t, _ in texts]
        miss = sum(-math.log(p if y else 1 - p) for p, (_, y) in zip(chances, texts))
        return miss + 0.5 * ((w - model.PRIOR) ** 2).sum()

    for text, _ in [*texts[:40], ("", 0), ("you will not see, you idiot! idiot", 0)]:
        assert math.isclose(model.score(text), by_hand(text, model.weights))
    allowed = lambda w: ((w >= toxicity.LEAST) & (w <= toxicity.MOST)).all()
    assert allowed(model.weights)
    least = loss(model.weights)
    for i in range(len(model.weights)):
        for step in (-0.01, 0.01):
            moved = model.weights.copy()
            moved[i] += step
            if allowed(moved):
                assert loss(moved) >= least - 1e-3
    copy = pickle.loads(pickle.dumps(model))
    assert copy.score("you are an idiot") == model.score("you are an idiot")


def test_learns_threats():
    rng = random.Random(4)
    words = [a + b for a in "ba ke li mo nu pra sti".split() for b in "ran tel dis um for gan".split()]
    texts = [(" ".join(rng.choices(words, k=60)), 0) for _ in range(200)]
    for _ in range(60):
        own = rng.choices(words, k=60)
        for _ in range(2):
            at = rng.randrange(1, 59)
            own[at:at] = ["gruzzle", "you"]
        texts.append((" ".join(own), 1))
    model = ToxicityModel(texts)
    assert model.lexicon["gruzzle"] == toxicity.THREAT
    assert model.score("i will gruzzle you") >= 0.7 > model.score("i gruzzle the bread")


def test_learns_words_and_stems():
    rng = random.Random(3)
    words = [a + b for a in "ba ke li mo nu pra sti".split() for b in "ran tel dis um for gan".split()]
    clean = [(" ".join(rng.choices(words, k=60)), 0) for _ in range(300)]
    insults = ["drovak", "zumpel", "zumpeln", "zumpelig", "zumpelt"]
    toxic = []
    for _ in range(100):
        own = rng.choices(words, k=60)
        for _ in range(3):
            own[rng.randrange(60)] = rng.choice(insults)
        toxic.append((" ".join(own), 1))
    model = ToxicityModel(clean[:200] + toxic[:70])
    assert "zumpel" in model.stems and model.lexicon.get("drovak") == "I"
    assert not any(w in model.lexicon for w in words)
    scores = model.scores([t for t, _ in toxic[70:]] + ["a zumpelhaft thing"])
    assert (scores >= toxicity.THRESHOLD).all()
    assert (model.scores([t for t, _ in clean[200:]]) < 0.3).all()


def test_held_out_rows(spark):
    got = {r["doc_id"]: r for r in queries.op7_toxicity(spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    assert len(got) == docs
    held = [(r["toxic"], got[r["doc_id"]]) for r in labels if got[r["doc_id"]]["held_out"]]
    assert all(r["predicted"] == 0 for y, r in held if y == 0)
    toxic = [r["predicted"] for y, r in held if y == 1]
    assert sum(toxic) >= 0.7 * len(toxic)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got.values())


def test_rows_of_every_kind(spark):
    long = "fine words " * 100000 + "you idiot"
    rows = [(1, None, 9.0, "x"), (2, "", 9.0, "x"), (3, "you idiot", 9.0, "x"), (3, "you idiot", 9.0, "x"), (None, long, 9.0, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, held_out string")
    labels = spark.createDataFrame([(3, 1), (1, None), (None, 1), (77, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = sorted((r["doc_id"] or 0, r["predicted"]) for r in toxicity.score_documents(docs, model).collect())
    assert got == [(0, 1), (1, 0), (2, 0), (3, 1), (3, 1)]
    empty = docs.limit(0)
    assert toxicity.score_documents(empty, toxicity.train(empty, labels.limit(0))).count() == 0
