"""The transducer against the tokenizers library, whole and in small parts."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from retailflow.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "",
    " ",
    "\n\n  \n x",
    "Hello world, it's   you'll   see\t\ttabs\n\nnew",
    "naïve Straße ñandú 日本語テキスト 🙂🙂 é",
    "a" * 3000,
    "1" * 1500 + "," * 1500 + " " * 2000 + "b",
    "\n" * 900 + "z",
    "pre<|endoftext|>post <|endoftext|><|endof text|>",
    "x  y 　 z\x1c\x1dw",
    "ab" * 700 + "'re" + "'" * 600 + "ll",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(packed):
    return list(memoryview(packed).cast("I"))


def random_texts(n):
    rng = random.Random(5)
    parts = ["the", "ing", "ß", "é", " ", "  ", "\n", "'re", "'s", "12", "%%%", "日本", "🙂", "aaaa", "<|endoftext|>", "<|", "Z"]
    return ["".join(rng.choices(parts, k=rng.randint(1, 120))) for _ in range(n)]


def test_equals_the_library(library):
    encoder, decoder = bpe.machines(PATH)
    for text in TEXTS + random_texts(300):
        want = library.encode(text, add_special_tokens=False).ids
        packed = encoder.encode(text)
        assert ids(packed) == want
        assert decoder.decode(packed) == library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("chunk", [1, 7, 64])
def test_streams_in_small_parts(library, monkeypatch, chunk):
    monkeypatch.setattr(bpe, "CHUNK_CHARS", chunk)
    monkeypatch.setattr(bpe, "RUN_BYTES", 16)
    table = bpe.MergeTable(PATH)
    encoder = bpe.Encoder(table)
    for text in TEXTS + random_texts(60):
        want = library.encode(text, add_special_tokens=False).ids
        parts = [text[n : n + chunk] for n in range(0, len(text), chunk)]
        assert ids(b"".join(encoder.stream(parts))) == want


def test_state_of_a_long_run_stays_small():
    table = bpe.MergeTable(PATH)
    encoder = bpe.Encoder(table)
    encoder.reset()
    rng = random.Random(1)
    for _ in range(20):
        encoder._advance("".join(rng.choices("abcdefgh", k=30000)), last=False)
        assert len(encoder.held) <= bpe.CHUNK_CHARS
        assert encoder.run is None or len(encoder.run.tail) <= max(bpe.RUN_BYTES, 2 * table.lookahead)


def test_lookahead_bounds_the_reach_of_later_text():
    table = bpe.MergeTable(PATH)
    assert 0 < table.lookahead < 2000
    rng = random.Random(3)
    for _ in range(200):
        head = bytes(rng.choices(b"aeinrst hT", k=rng.randint(table.lookahead, table.lookahead + 40)))
        ends = []
        for tail in (b"", bytes(rng.choices(b"aeinrst", k=30)), b"tion"):
            at, found = 0, set()
            for i in table.merge(head + tail):
                at += len(table.bytes_of[i])
                if at <= len(head) - table.lookahead:
                    found.add(at)
            ends.append(found)
        assert ends[0] == ends[1] == ends[2]


def test_rows_of_every_kind(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (2, None, "x"), (None, "", "y"), (3, "long " * 50000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = {(r["doc_id"], r["n_tokens"], r["decoded"]) for r in bpe.encode_documents(docs, PATH).collect()}
    assert got == {(1, 2, "a b"), (2, 0, ""), (None, 0, ""), (3, got_tokens("long " * 50000), "long " * 50000)}
    assert bpe.encode_documents(docs.limit(0), PATH).count() == 0


def got_tokens(text):
    return len(Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids)
