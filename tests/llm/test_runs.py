"""Periodic runs against a version that tries every period at every place."""

import hashlib
import random
import re
import zlib

import pytest

from retailflow.llm import queries, runs


def brute_runs(words, least_words=6, repeats=4):
    n, found = len(words), []
    for q in range(1, n // repeats + 1):
        s = 0
        while s + q < n:
            e = s
            while e + q < n and words[e] == words[e + q]:
                e += 1
            length = e - s + q
            if e > s and length >= max(least_words, repeats * q):
                stretch = words[s : s + length]
                if not any(stretch[p:] == stretch[:-p] for p in range(1, q)):
                    found.append((s, length, q))
            s = max(e, s) + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_words(text, doc_id):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def brute_row(text, doc_id):
    words = brute_words(text, doc_id)
    found = brute_runs(words)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    long = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(found), *long, sha(lines), sha(kept))


def random_words(rng, size):
    """Words with runs of several periods, nested, overlapping and broken."""
    out = []
    while len(out) < size:
        unit = [rng.choice("abc") for _ in range(rng.randint(1, 6))]
        if rng.random() < 0.4:
            unit = unit * rng.randint(2, 5) + [rng.choice("abcd")]
        out += unit * rng.randint(1, 7)
        if rng.random() < 0.3 and out:
            out = out + out[-rng.randint(1, len(out)) :]
    return out[:size]


@pytest.mark.parametrize("least_words, repeats", [(6, 4), (2, 2), (1, 3), (9, 4)])
def test_runs_equal_all_periods_tried(least_words, repeats):
    rng = random.Random(5)
    docs = [random_words(rng, rng.randint(0, 90)) for _ in range(250)]
    docs += [[], ["a"], ["a"] * 5, ["a"] * 6, ["a"] * 7, list("ababababa"), list("xabcabcabcabcy") * 3]
    got = runs.find_runs(docs, least_words, repeats)
    assert got == [brute_runs(d, least_words, repeats) for d in docs]


def test_few_and_many_letters():
    rng = random.Random(6)
    docs = [[rng.choice(letters) for _ in range(400)] for letters in ("a", "ab", "aaaab", "abcdefgh") for _ in range(4)]
    assert runs.find_runs(docs) == [brute_runs(d) for d in docs]


def test_batches_do_not_matter(monkeypatch):
    rng = random.Random(7)
    docs = [random_words(rng, 60) for _ in range(40)]
    whole = runs.find_runs(docs)
    monkeypatch.setattr(runs, "BATCH_WORDS", 100)
    assert runs.find_runs(docs) == whole


def test_very_long_texts():
    one = ["x"] * 60_000
    rng = random.Random(8)
    line = [str(rng.random()) for _ in range(9)]
    far = [w for n in range(4000) for w in [*line, f"n{n}"]]  # a line that returns, never at once
    two = [str(n % 7000) for n in range(70_000)]
    assert runs.find_runs([one, far, two]) == [[(0, 60_000, 1)], [], [(0, 70_000, 7000)]]


def rows_of(spark):
    rng = random.Random(9)
    out = [(2**62 + 1, "x y"), (None, "a a a a a a a"), (None, None), (3, None), (4, ""), (5, " \t\n\x0b\x0c\r "), (6, "é é x\x0cx\rx x x x")]
    out += [(n, " ".join(random_words(rng, rng.randint(0, 80)))) for n in range(10, 130)]
    out += [(n, " ".join(str(rng.randint(0, 9999)) for _ in range(rng.randint(1, 200)))) for n in range(200, 320)]
    out += [(n, "  lead\n" + "one two  three\tfour " * rng.randint(1, 9)) for n in range(400, 430)]
    out += out[20:30]  # repeated rows
    return spark.createDataFrame([(i, t, 1, "x") for i, t in out], "doc_id long, text string, runs int, start string"), out


def test_query_equals_brute_force(spark, tmp_path):
    docs, rows = rows_of(spark)
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op11_periodic_runs"](spark, str(tmp_path))
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert got.columns[:8] == names
    assert [t for _, t in got.dtypes[:8]] == ["bigint"] * 6 + ["string"] * 2
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted((tuple(r)[:8] for r in got.collect()), key=key) == sorted((brute_row(t, i) for i, t in rows), key=key)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows if i is not None) > 20


def test_operator_gives_runs_and_text(spark):
    docs = spark.createDataFrame([(1, "go a b a b a b a b a end"), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in runs.run_documents(docs).collect()}
    assert [tuple(r) for r in got[1]["runs"]] == [(1, 9, 2)]
    assert (got[1]["n_words"], got[1]["collapsed"]) == (11, "go a b end")
    assert (got[2]["n_words"], got[2]["runs"], got[2]["collapsed"]) == (0, [], "")
    assert runs.run_documents(docs.limit(0)).count() == 0
