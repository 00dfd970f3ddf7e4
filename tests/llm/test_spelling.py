"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from retailflow.llm import queries, spelling


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    n = 0
    while n < len(a) and a[n] == b[n]:
        n += 1
    return a[n + 1 :] == b[n + 1 :] if len(a) == len(b) else a[n:] == b[n + 1 :]


def brute_counts(rows, drop_every=97):
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if drop_every and i is not None and h % drop_every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 5:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= 3}


def brute_groups(counts):
    form, near = {}, {}
    for w, n in counts.items():
        others = [v for v in counts if one_edit(w, v)]
        near[w] = len(others)
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, near[w], counts[form[w]] if form[w] else None))
    return sorted(out)


def variants(rng, letters, n):
    """Words around a few stems, by one to three edits."""
    words = set()
    while len(words) < n:
        w = "".join(rng.choices(letters, k=rng.randint(5, 9)))
        words.add(w)
        for _ in range(rng.randint(0, 6)):
            at = rng.randrange(len(w) + 1)
            kind = rng.random()
            c = rng.choice(letters)
            w = w[:at] + c + w[at:] if kind < 0.35 else w[:at] + w[at + 1 :] if kind < 0.7 else w[:at] + c + w[at + 1 :]
            if len(w) >= 5:
                words.add(w)
    return sorted(words)


@pytest.mark.parametrize("hot_words", [0, 3, 100_000])
@pytest.mark.parametrize("letters", ["ab", "abcé", "abcdefghijÿ"])
def test_pairs_equal_all_pairs_tried(spark, hot_words, letters):
    words = variants(random.Random(len(letters)), letters, 220)
    table = spark.createDataFrame([(w, n + 3) for n, w in enumerate(words)], "word string, n long")
    got = spelling.near_pairs(table, hot_words).collect()
    order = {w: (len(w), w) for w in words}
    want = {(a, b) for a in words for b in words if one_edit(a, b) and order[a] < order[b]}
    assert len(got) == len(want) and {(r["a"], r["b"]) for r in got} == want
    n = {w: n + 3 for n, w in enumerate(words)}
    assert all((r["n_a"], r["n_b"]) == (n[r["a"]], n[r["b"]]) for r in got)


def test_one_hot_beginning(spark):
    """A third of the words share their first half; the refined join finds all and no others."""
    rng = random.Random(3)
    words = {"prefix" + "".join(rng.choices("abcdef", k=6)) for _ in range(400)} | set(variants(rng, "abcdefghij", 500))
    table = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    got = {(r["a"], r["b"]) for r in spelling.near_pairs(table, 50).collect()}
    assert got == {(a, b) for a in words for b in words if one_edit(a, b) and (len(a), a) < (len(b), b)}


def fixture_rows():
    rng = random.Random(11)
    stems = ["straße", "colour", "analyse", "Zürich", "ABCDEF", "centre", "éclair", "naïveté", "aaaaa", "aaaaaa"]
    words = stems + variants(rng, "abcé", 60)
    rows = [(n, " ".join(rng.choices(words, weights=[1 + 90 // (k + 1) for k in range(len(words))], k=60))) for n in range(250)]
    rows += [(None, "colour colour colour colors"), (7, None), (8, ""), (9, "a bb ccc dddd 12345 --- őőőőő")]
    rows += [(900, "word1word2wordy" + " lengthy,lengthy;lengthy" * 20_000)]
    rows += [(901, "chained " * 3 + "chainer " * 9 + "chainers " * 30)]
    return rows + rows[:20]


def test_query_equals_brute_force(spark, tmp_path):
    rows = fixture_rows()
    docs = spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], "doc_id long, text string, n int, word string, form string")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op13_spelling_variants"](spark, str(tmp_path))
    assert got.columns[:6] == ["word", "form", "root", "n", "n_near", "form_n"]
    assert [t for _, t in got.dtypes[:6]] == ["string"] * 3 + ["bigint"] * 3
    want = brute_groups(brute_counts(rows))
    assert sorted(tuple(r)[:6] for r in got.collect()) == want
    assert any(r[2] not in (r[0], r[1]) for r in want)  # some root is two forms away


def test_chain_of_forms(spark):
    chain = [(f"{'a' * n}bcdef", f"{'a' * (n + 1)}bcdef") for n in range(37)]
    table = spark.createDataFrame(chain, "word string, form string")
    assert {r["root"] for r in spelling.roots(table).collect()} == {"a" * 37 + "bcdef"}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variant_groups(docs).count() == 0
