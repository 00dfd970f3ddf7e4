"""Token files: the coder by round trips, the query against the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from retailflow.llm import id_files, mixing, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")


def streams():
    rng = np.random.default_rng(1)
    return [
        (np.array([7]), 512),
        (np.arange(10) * 400_000_000, 3),
        (np.zeros(3000), 700),
        (rng.integers(0, 50_257, 9000), 1000),
        (rng.integers(0, 3, 5000), 512),
        (np.minimum(rng.zipf(1.2, 20_000), 50_256), 512),
        (np.tile(rng.integers(0, 50_257, 40), 400), 4096),
        (np.array([2**32 - 1, 0, 2**32 - 1]), 2),
    ]


def test_round_trips_alone_and_together():
    cases = [(ids.astype(np.uint32), block) for ids, block in streams()]
    packed = [mixing.encode_blocks(ids, block) for ids, block in cases]
    for (ids, _), data in zip(cases, packed):
        assert (mixing.decode_blocks([data])[0] == ids).all()
    together = mixing.decode_blocks([*packed, b""])
    assert all((a == ids).all() for a, (ids, _) in zip(together, cases)) and len(together[-1]) == 0


def test_predictions_shorten_the_code():
    ids = [ids.astype(np.uint32) for ids, _ in streams()]
    repeated, random_, zipf = (8 * len(mixing.encode_blocks(ids[n], 4096)) / len(ids[n]) for n in (6, 3, 5))
    assert repeated < 1 and zipf < 10 and random_ < 22


def test_blocks_are_independent():
    ids = np.minimum(np.random.default_rng(3).zipf(1.3, 2000), 900).astype(np.uint32)
    whole = mixing.encode_blocks(ids, 500)
    parts = [mixing.encode_blocks(ids[n : n + 500], 500) for n in range(0, 2000, 500)]
    assert whole == b"".join(parts)


@pytest.mark.parametrize("at", [0, 4, 25, 60, 100, -1])
def test_damage_is_found(at):
    image = bytearray(id_files.pack_file(["1", None, "é"], [b"\1\0\0\0" * 400, b"", b"\2\0\0\0\3\0\0\0"], 5))
    image[at] ^= 64
    with pytest.raises((ValueError, zlib.error)):
        list(id_files.unpack_files([bytes(image)]))
    with pytest.raises((ValueError, zlib.error)):
        list(id_files.unpack_files([bytes(image[:-9])]))


def test_file_image():
    docs = (["1", None, "é"], [b"\1\0\0\0" * 400, b"", b"\2\0\0\0\3\0\0\0"])
    image = id_files.pack_file(*docs, 5)
    assert list(id_files.unpack_files([image])) == [("1", 5, docs[1][0]), (None, 405, b""), ("é", 405, docs[1][2])]


def documents():
    rng = random.Random(4)
    words = ["the", "of", "naïve", "don't", "  ", "\n\n", "日本語", "x" * 70, "12345", "<|endoftext|>", "#", "👩‍👩‍👧", "\t", "we'll", " "]
    rows = [(n * 3 - 40, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for n in range(150)]
    rows += [(None, "no id"), (10**17 + 1, None), (10**17 + 3, ""), (-7, "#" * 5000), (2000, "long text, " * 30_000)]
    return rows + [(5, "tied b"), (5, "tied a"), (5, "tied a")]


def test_query_equals_library(spark, tmp_path, monkeypatch):
    rows = documents()
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, ids string, start int")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op12_token_files"](spark, str(tmp_path))
    assert got.columns[:4] == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert [t for _, t in got.dtypes[:4]] == ["bigint"] * 4
    got = sorted((tuple(r)[:4] for r in got.collect()), key=lambda r: r[1])
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation(), tokenizer.no_padding()
    want = []
    for i, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
        want.append((i, len(ids), zlib.crc32(ids.tobytes())))
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted(((i, n, c) for i, _, n, c in got), key=key) == sorted(want, key=key)
    assert [s for _, s, _, _ in got] == np.cumsum([0, *(n for _, _, n, _ in got[:-1])]).tolist()
    order = [(i is not None, i or 0) for i, *_ in got]
    assert order == sorted(order)


def test_files_close_and_empty_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(id_files, "FILE_IDS", 300)
    docs = spark.createDataFrame([(f"k{n:03}", "some words " * (n % 40)) for n in range(200)], "doc_id string, text string")
    id_files.write_files(docs, PATH, f"{tmp_path}/a", end_id=9)
    read = id_files.read_files(spark, f"{tmp_path}/a", "string").orderBy("start").collect()
    assert [r["doc_id"] for r in read] == [f"k{n:03}" for n in range(200)]
    assert all(r["ids"][-4:] == b"\x09\0\0\0" and len(r["ids"]) == 4 * r["n_tokens"] for r in read)
    id_files.write_files(docs.limit(0), PATH, f"{tmp_path}/b")
    assert id_files.read_files(spark, f"{tmp_path}/b").count() == 0


def test_texts_are_cut_into_pieces_as_the_library_does(monkeypatch):
    monkeypatch.setattr(id_files, "STEP_BYTES", 60)
    signs = "' '' 's 're 'll 'LL 'v 't 'S \n \t \xa0 \u3000 \u2009 \x85 a Bc é 日本 1 ² ½ ٣ ! -- # 👩\u200d👩 \u0301 ſ".split(" ")
    rng = random.Random(7)
    texts = ["".join(rng.choices([*signs, " ", "  "], k=rng.randint(0, 12))) for _ in range(4000)]
    texts += [None, "", "one two " * 50, "a<|endoftext|> b", "x" * 200, "日本 " * 90]
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation(), tokenizer.no_padding()
    got = id_files.LibraryTokens(PATH).encode(pa.array(["left out", *texts])[1:])
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == want


def test_distinct_pieces_are_encoded_once(monkeypatch):
    table, asked = id_files.LibraryTokens(PATH), []
    encode = table._piece
    monkeypatch.setattr(table, "_piece", lambda piece: asked.append(piece) or encode(piece))
    got = table.encode(pa.array(["some words, more words", " more words"] * 500))
    assert len(got) == 1000 and got[0] == got[2] and sorted(asked) == [b" more", b" words", b",", b"some"]


def test_groups_of_blocks_and_any_damage(monkeypatch):
    ids = np.minimum(np.random.default_rng(5).zipf(1.3, 9000), 50_000).astype(np.uint32)
    whole = mixing.encode_blocks(ids, 300)
    monkeypatch.setattr(mixing, "MAX_LANES", 4)
    assert mixing.encode_blocks(ids, 300) == whole and (mixing.decode_blocks([whole])[0] == ids).all()
    rng = random.Random(2)
    for _ in range(60):
        data = bytearray(mixing.encode_blocks(ids[:700], 300))
        data[rng.randrange(len(data))] ^= 1 << rng.randrange(8)
        with pytest.raises(ValueError):
            mixing.decode_blocks([bytes(data)])


def test_orders_are_learnt_within_a_block():
    # Four cycles of eight among 64 ids, one after the other, a tenth of the ids replaced at random.
    rng = np.random.default_rng(9)
    ids = np.tile(np.concatenate([rng.permutation(64)[:8] for _ in range(4)]), 512)
    ids = np.where(rng.random(len(ids)) < 0.1, rng.integers(0, 64, len(ids)), ids).astype(np.uint32)
    assert 8 * len(mixing.encode_blocks(ids, 4096)) / len(ids) < 3
