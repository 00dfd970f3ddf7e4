"""Language identification: the kernel against sets, held-out accuracy, every kind of row."""

import numpy as np

from retailflow.llm import langid, queries


def brute_grams(text, alphabet):
    code = {c: n + 1 for n, c in enumerate(alphabet)}
    shown = [code.get(c, langid.BASE - 1) if c.isalpha() else 0 for c in text.lower()]
    padded = [0]
    for c in [*shown, 0]:
        if c or padded[-1]:
            padded.append(c)
    return {tuple(padded[i : i + n]) for n in (1, 2, 3) for i in range(len(padded) - n + 1)}


def test_kernel_equals_set_intersections():
    texts = ["abc abd", "xyz, xya!", "ábc 12 abc", "a", "Zz zz"]
    kernel = langid.SpectrumKernel(texts)
    grams = [kernel.grams(t) for t in texts]
    kernel.set_landmarks(grams[:3])
    sets = [brute_grams(t, kernel.alphabet) for t in texts]
    assert [len(g) for g in grams] == [len(s) for s in sets]
    want = [[len(a & b) / (len(a) * len(b)) ** 0.5 for b in sets[:3]] for a in sets]
    assert np.allclose(kernel.to_landmarks(grams), want, atol=1e-6)


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in queries.op5_language_id(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(docs)
    held = [r for r in docs if got[r["doc_id"]]["held_out"] and r["lang"]]
    hits = sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held)
    assert len(held) > 150 and hits >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_rows_of_every_kind(spark):
    rows = [(n, ["the cat and the dog ", "der Hund und die Katze "][n % 2] * 9, ["en", "de"][n % 2], "s") for n in range(40)]
    rows += [(100, None, "en", "s"), (101, "", "en", "s"), (102, "12 34 !?", None, "s"), (None, "the dog", None, "s")]
    rows += [(103, "und der Hund " * 60000, None, "s"), (104, "the dog", None, "s"), (104, "the dog", None, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = langid.identify(docs, langid.train(docs)).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got}
    assert by_id[100] == by_id[101] == by_id[102] == ("und", 0.0)
    assert by_id[103][0] == "de" and by_id[104][0] == by_id[None][0] == "en"
    empty = docs.limit(0)
    assert langid.identify(empty, langid.train(empty)).count() == 0
    assert {r["lang_pred"] for r in langid.identify(docs, langid.train(empty)).collect()} == {"und"}
