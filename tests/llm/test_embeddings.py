"""Embedding links and top-k search against brute force."""

import math
import random

import numpy as np
import pytest

from retailflow.llm import embed_dedup, topk
from tests.llm.brute import smallest_reachable

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string, rank string"


def vectors(seed, n=260, d=16):
    rng = np.random.default_rng(seed)
    rows, base = [], rng.normal(size=(12, d))
    for i in range(n):
        v = base[rng.integers(12)] + rng.normal(size=d) * rng.choice([0.0, 0.05, 0.14, 0.5])
        rows.append((i * 3, [float(np.float32(x)) for x in v], int(rng.integers(3)), "x", "y"))
    return rows


def odd_rows(d=16):
    one = [1.0] * d
    return [
        (5000, None, 1, "x", "y"),
        (5001, [0.0] * d, 1, "x", "y"),
        (5002, [float("nan")] + one[1:], 1, "x", "y"),
        (5003, [None] + one[1:], 1, "x", "y"),
        (5004, [float("inf")] + one[1:], 1, "x", "y"),
        (5005, one, None, "x", "y"),
        (5006, [], 1, "x", "y"),
        (None, one, 1, "x", "y"),
        (5008, one, 1, "x", "y"),
        (5008, one, 1, "x", "y"),
        (5009, one[:3], 1, "x", "y"),
        (5010, [2.0] * d, 1, "x", "y"),
    ]


def sound(x):
    return bool(x) and all(c is not None and math.isfinite(c) for c in x)


def brute_links(rows, threshold=0.98):
    ok = [i for i, r in enumerate(rows) if r[0] is not None and r[2] is not None and sound(r[1]) and any(r[1])]
    links = {i: [] for i in range(len(rows))}
    for a in ok:
        for b in ok:
            x, y = rows[a], rows[b]
            if a != b and x[2] == y[2] and len(x[1]) == len(y[1]):
                u, v = np.array(x[1]), np.array(y[1])
                if u @ v / (np.linalg.norm(u) * np.linalg.norm(v)) >= threshold:
                    links[a].append(b)
    ids = [r[0] for r in rows]
    group = smallest_reachable(range(len(rows)), [(a, b) for a in links for b in links[a]])
    lowest = {}
    for i, g in group.items():
        if ids[i] is not None:
            lowest[g] = min(lowest.get(g, ids[i]), ids[i])
    return sorted(((ids[i] or -1), len(links[i]), lowest.get(group[i], -1), ids[i] is not None and ids[i] == lowest[group[i]]) for i in links)


@pytest.mark.parametrize("tile_rows", [2048, 20])
def test_links(spark, tile_rows):
    rows = vectors(1) + odd_rows()
    got = embed_dedup.link_embeddings(spark.createDataFrame(rows, SCHEMA), tile_rows=tile_rows).collect()
    found = sorted((-1 if r["vec_id"] is None else r["vec_id"], r["n_links"], -1 if r["component_id"] is None else r["component_id"], r["kept"]) for r in got)
    want = brute_links(rows)
    # An id of zero counts as an id.
    assert found == sorted((i if rows[0][0] != 0 or i != -1 else i, *rest) for i, *rest in fix_zero(rows, want))
    assert sum(n for _, n, _, _ in found) > 100


def fix_zero(rows, want):
    """``or -1`` above also catches the id 0."""
    zero = [w for w in want if w[0] == -1 and w[2] == 0]
    return [(0, *w[1:]) if w in zero else w for w in want]


def test_no_pair_escapes_the_bound():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 24)) * 10.0 ** rng.integers(-3, 4, size=(300, 1))
    x[150:] = x[:150] + rng.normal(size=(150, 24)) * np.abs(x[:150]).max(axis=1, keepdims=True) * 0.08
    got = {(i, j) for a, b in embed_dedup.close_pairs(x, x, 0.98) for i, j in zip(a.tolist(), b.tolist())}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    cosine = unit @ unit.T
    assert got >= set(zip(*map(np.ndarray.tolist, np.nonzero(cosine >= 0.98 + 1e-12))))
    assert got <= set(zip(*map(np.ndarray.tolist, np.nonzero(cosine >= 0.98 - 1e-12))))


def brute_top(rows, k, every):
    chosen = {}
    for i, x, *_ in rows:
        if i is not None and sound(x):
            v = [math.floor(256 * c) for c in x]
            chosen[i] = min(chosen.get(i, v), v)
    out = []
    for q, x in chosen.items():
        if q % every == 0:
            near = [(-sum(a * b for a, b in zip(x, y)), i) for i, y in chosen.items() if i != q and len(y) == len(x)]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(near)[:k])]
    return sorted(out)


@pytest.mark.parametrize("block,steps,group", [(2048, 1024, 8192), (7, 4, 3)])
def test_top_k(spark, monkeypatch, block, steps, group):
    monkeypatch.setattr(topk, "BLOCK_ROWS", block)
    monkeypatch.setattr(topk, "STEPS", steps)
    monkeypatch.setattr(topk, "SCORED_QUERIES", 4)
    rows = vectors(4, 150) + odd_rows() + [(7000 + i, [0.5] * 16, 1, "x", "y") for i in range(12)]
    got = topk.top_k(spark.createDataFrame(rows, SCHEMA), k=5, every=10, pass_queries=group).collect()
    assert sorted(tuple(r) for r in got) == brute_top(rows, 5, 10)


def test_few_and_no_rows(spark):
    rows = [(0, [1.0, 0.0], 1, "x", "y"), (50, [0.5, 0.5], 1, "x", "y"), (3, [0.0, 1.0], 1, "x", "y")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(tuple(r) for r in topk.top_k(df).collect()) == brute_top(rows, 5, 50)
    assert topk.top_k(df.limit(0)).count() == 0
    assert embed_dedup.link_embeddings(df.limit(0)).count() == 0


def shared_ids(seed=6, n=90, d=16):
    """Rows of which many share an id, with other vectors and labels."""
    rows = vectors(seed, n, d)
    return [(r[0] % 40 * 10 + 10, *r[1:]) for r in rows] + [(10, *r[1:]) for r in rows[:20]]


@pytest.mark.parametrize("tile_rows", [2048, 20])
def test_links_of_shared_ids(spark, tile_rows):
    rows = shared_ids()
    got = embed_dedup.link_embeddings(spark.createDataFrame(rows, SCHEMA), tile_rows=tile_rows).collect()
    assert sorted(tuple(r) for r in got) == brute_links(rows)


def brute_pairs(rows, k, every):
    """The best pairs of each query id, over all its vectors."""
    distinct = sorted({(i, tuple(x)) for i, x, *_ in rows})
    whole = [(i, [math.floor(256 * c) for c in x]) for i, x in distinct]
    near = {}
    for q, x in whole:
        if q % every == 0:
            near.setdefault(q, []).extend((-sum(a * b for a, b in zip(x, y)), i) for i, y in whole if i != q)
    return sorted((q, n + 1, i, -s) for q, pairs in near.items() for n, (s, i) in enumerate(sorted(pairs)[:k]))


@pytest.mark.parametrize("block,group", [(2048, 8192), (7, 3)])
def test_top_k_of_shared_ids(spark, monkeypatch, block, group):
    monkeypatch.setattr(topk, "BLOCK_ROWS", block)
    rows = shared_ids()
    got = topk.top_k(spark.createDataFrame(rows, SCHEMA), k=5, every=50, pass_queries=group).collect()
    assert sorted(tuple(r) for r in got) == brute_pairs(rows, 5, 50)


def test_top_k_of_large_vectors(spark):
    rows = [(r[0], [float(c) for c in r[1]] if r[1] else r[1], *r[2:]) for r in vectors(9, 60, 4)] + [
        (70_000, [1e6, 0.0, 1.5, -2.0], 1, "x", "y"),
        (70_010, [1e9, 1e9, -1e9, 0.25], 1, "x", "y"),
        (70_020, [1e300, 0.0, 0.0, 1.0], 1, "x", "y"),
        (70_031, [-1e300, 0.0, 0.0, 1.0], 1, "x", "y"),
        (70_043, [1e308, 1e-300, 0.0, 0.0], 1, "x", "y"),
        (70_050, [0.0, 0.0, 0.0, 3.0], 1, "x", "y"),
        (70_067, [2.0**40 + 0.5, 3.0, 1.0, 1.0], 1, "x", "y"),
    ]
    whole = {i: [int(c) * 256 if abs(c) >= 2**53 else math.floor(256 * c) for c in x] for i, x, *_ in rows if i is not None and sound(x)}
    want = []
    for q, x in whole.items():
        if q % 10 == 0:
            near = []
            for i, y in whole.items():
                if i != q and len(x) == len(y):
                    near.append((-min(2**63 - 1, max(-(2**63), sum(a * b for a, b in zip(x, y)))), i))
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(near)[:5])]
    got = topk.top_k(spark.createDataFrame(rows, SCHEMA.replace("float", "double")), k=5, every=10).collect()
    assert sorted(tuple(r) for r in got) == sorted(want)
