"""Packing: places without gaps or overlaps, ids of the library, few sequences."""

import random
import zlib
from array import array

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from retailflow.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_equal_the_library(library):
    table = packing.words(PATH)
    rng = random.Random(8)
    parts = ["The", "cat's", "İ.", "ΣΑΣ", "naïve,", "12.5", "日本。", "<|endoftext|>", " ", "\x1c", " ", "é.", "A.B.,", "Ⅷ²", "🙂."]
    texts = ["", " ", "I'll go"] + [rng.choice(["", " ", "\n"]).join(rng.choices(parts, k=30)) for _ in range(300)]
    latin = [chr(n) for n in range(32, 0x260)]
    texts += [" ".join(latin), " ".join("a" + c + "b" for c in latin), " ".join(c + "." for c in latin), "e\u0301a A\u030a"]
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        assert list(memoryview(table.encode(text)).cast("I")) == want


def brute_fullest(counts, room):
    sums = {0}
    for length, n in counts.items():
        for _ in range(n):
            sums |= {s + length for s in sums if s + length <= room}
    return max(sums)


def test_fullest_combination():
    rng = random.Random(1)
    for _ in range(300):
        counts = {rng.randint(1, 30): rng.randint(1, 4) for _ in range(rng.randint(0, 6))}
        room = rng.randint(0, 60)
        got = packing.fullest(counts, room)
        assert all(0 < n <= counts[x] for x, n in got.items())
        assert sum(x * n for x, n in got.items()) == brute_fullest(counts, room)


def first_fit(counts, capacity):
    """Bins of first-fit decreasing."""
    bins = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            at = next((n for n, used in enumerate(bins) if used + length <= capacity), None)
            if at is None:
                bins.append(length)
            else:
                bins[at] += length
    return len(bins)


def test_plan_uses_every_piece_once():
    rng = random.Random(3)
    for _ in range(30):
        counts = {rng.randint(1, 100): rng.randint(1, 60) for _ in range(40)}
        plan = packing.plan_bins(counts, 100)
        used = {}
        for bins, filling in plan:
            assert bins > 0 and sum(x * n for x, n in filling.items()) <= 100
            for x, n in filling.items():
                used[x] = used.get(x, 0) + bins * n
        assert used == counts
        assert sum(b for b, _ in plan) <= 1.02 * first_fit(counts, 100) + 1


@pytest.mark.parametrize("numbered", [10_000, 5])
def test_places(spark, library, monkeypatch, numbered):
    monkeypatch.setattr(packing, "NUMBERED_ROWS", numbered)
    rng = random.Random(2)
    texts = [" ".join(rng.choices(["the", "quick", "fox", "jumps"], k=rng.choice([1, 5, 5, 5, 40, 150]))) for _ in range(120)]
    rows = [(n, t, "x") for n, t in enumerate(texts)] + [(0, texts[0], "x"), (None, None, "y"), (None, None, "y"), (900, "", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string")
    got = packing.pack_documents(docs, PATH, capacity=64, keep_ids=True).collect()
    want = sorted(
        (d or -1, p // 64, p, len(ids[p : p + 64]), zlib.crc32(array("I", ids[p : p + 64]).tobytes()))
        for d, t, _ in rows
        for ids in [library.encode(t or "", add_special_tokens=False).ids + [0]]
        for p in range(0, len(ids), 64)
    )
    assert sorted((r["doc_id"] if r["doc_id"] else (0 if r["doc_id"] == 0 else -1) or -1, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] for r in got)
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(r["length"] for r in got)
    assert len(bins) <= -(-total // 64) * 1.05 + 1


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(docs, PATH).count() == 0
