"""SimHash groups against a brute-force version."""

import random
import re

import numpy as np
import pandas as pd
import xxhash

from retailflow.llm import simhash
from tests.llm.brute import smallest_reachable


def brute_print(text, words=3):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    tokens = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    rng = random.Random(2)
    texts = [" ".join(rng.choices(["A", "bÉ", "c d", "É", "zz"], k=n)) for n in (1, 2, 3, 4, 50, 2000)]
    texts += ["", None, " \t\n\x0b ", "one\x0ctwo\rthree", "x " * 70000]
    got = simhash.fingerprints(pd.Series(texts), 3)
    assert [int(x) for x in got] == [brute_print(t) for t in texts]


def test_golay_words():
    syndrome, nearest, errors = simhash.golay()
    assert len(np.unique(nearest)) == 2048 and (nearest >= 0).all()
    assert max(int(e).bit_count() for e in nearest) == 3
    words = np.random.default_rng(0).integers(0, 1 << 23, 2000)
    near = words ^ nearest[syndrome[words]]
    assert (syndrome[near] == 0).all()
    for bit in range(23):
        other = words ^ (1 << bit)
        lists = np.where(errors[syndrome[other]] >= 0, other[:, None] ^ errors[syndrome[other]], -1)
        assert (lists == near[:, None]).any(axis=1).all()


def neighbours(rng, n):
    """Fingerprints in chains and clouds of one to three differing bits."""
    out = set()
    while len(out) < n:
        base = rng.getrandbits(64)
        out.add(base)
        for _ in range(rng.randint(0, 6)):
            for b in rng.sample(range(64), rng.randint(1, 3)):
                base ^= 1 << b
            out.add(base)
    return sorted(out)


def brute_groups(prints):
    links = [(a, b) for i, a in enumerate(prints) for b in prints[:i] if (a ^ b).bit_count() <= 2]
    return smallest_reachable(prints, links)


def check_groups(spark, prints):
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.link_fingerprints(spark.createDataFrame([(p,) for p in signed], "fp long"))
    got = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in links.collect()]
    assert all((a ^ b).bit_count() <= 2 or brute_groups(prints)[a] == brute_groups(prints)[b] for a, b in got)
    assert smallest_reachable(prints, got) == brute_groups(prints)


def test_links_small_groups(spark):
    check_groups(spark, neighbours(random.Random(4), 400))


def test_links_large_groups(spark, monkeypatch):
    monkeypatch.setattr(simhash, "GROUP_ROWS", 3)
    monkeypatch.setattr(simhash, "TILE_ROWS", 4)
    check_groups(spark, neighbours(random.Random(6), 250) + [1 << b for b in range(30)])


def test_rows_of_every_kind(spark):
    rows = [
        (5, "a b c d", "x", 1),
        (2, "A b c d", "x", 1),
        (2, "A b c d", "x", 1),
        (None, "a b c d", "x", 1),
        (7, None, "x", 1),
        (9, "", "y", 1),
        (None, "other words here", "y", 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id int")
    got = sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in simhash.simhash_groups(docs).collect())
    assert got == [(0, 0), (0, 2), (2, 2), (2, 2), (5, 2), (7, 7), (9, 7)]
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == [
        (0, "other words here"),
        (2, "A b c d"),
        (7, ""),
    ]
    assert simhash.simhash_groups(docs.limit(0)).count() == 0
    assert simhash.deduplicate(docs.limit(0)).count() == 0
