"""Quality classifier: random indexing by hand, held-out accuracy, every kind of row."""

import numpy as np

from retailflow.llm import quality, queries

SF_DIR = "/root/testdata/sf0.01"


def test_word_vectors_sum_neighbours():
    vectors = quality.WordVectors(["a b c", "b a"])
    names = list(vectors.known)
    raw = {}
    for text in ("a b c", "b a"):
        words = text.split()
        for i, w in enumerate(words):
            for j in range(max(0, i - quality.WINDOW), min(len(words), i + quality.WINDOW + 1)):
                if j != i:
                    raw[w] = raw.get(w, 0) + quality.index_vector(words[j]).astype(float)
    total = np.array([raw.get(n, np.zeros(quality.DIMENSION)) for n in names])
    total /= np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-9)
    total -= total.mean(axis=0)
    own = np.stack([quality.index_vector(n) for n in names]) / np.sqrt(quality.NONZERO)
    own[0] = 0
    assert np.allclose(vectors.table, total + own, atol=1e-5)


def test_pooling_counts_marks():
    vectors = quality.WordVectors(["some words here"])
    row = {n: vectors.table[i].astype(float) for n, i in vectors.known.items()}
    want = (2 * row["words"] + row["<again>"]) / 2
    assert np.allclose(vectors.pool("words words"), want, atol=1e-5)
    want = (row["words"] + row["<capitals>"]) / 1
    assert np.allclose(vectors.pool("WORDS"), want, atol=1e-5)
    assert not vectors.pool(None).any() and not vectors.pool(" \n").any()


def test_held_out_rows(spark):
    got = {r["doc_id"]: r for r in queries.op10_quality_classifier(spark, SF_DIR).collect()}
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    assert len(got) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    held = [(r["quality"], got[r["doc_id"]]) for r in labels if got[r["doc_id"]]["held_out"]]
    assert sum(r["predicted"] == y for y, r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got.values())


def test_rows_of_every_kind(spark):
    rows = [(n, ["good plain words of a text", "%%% ### %%% ###"][n % 2] * 3, 1.0, "x") for n in range(60)]
    rows += [(100, None, 1.0, "x"), (101, "", 1.0, "x"), (102, "words " * 200000, 1.0, "x"), (None, "good", 1.0, "x")]
    rows += [(103, "good plain words", 1.0, "x"), (103, "good plain words", 1.0, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, predicted string")
    labels = spark.createDataFrame([(n, 1 - n % 2) for n in range(60)] + [(None, 1), (5, None)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    got = quality.score_documents(docs, model).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[103]["predicted"] == 1 and by_id[1]["predicted"] == 0
    assert by_id[100]["score"] == by_id[101]["score"] == model.constant
    empty = docs.limit(0)
    assert quality.score_documents(empty, quality.train(empty, labels.limit(0))).count() == 0
