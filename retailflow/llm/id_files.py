"""Token ids of documents in compressed, checksummed files, in ascending id order.

Spark range-partitions the documents by id and sorts each part; a task encodes its documents one
after the other and closes a file at the first document that ends beyond ``FILE_IDS`` ids, so it holds
one file's ids at a time and no document spans two files. A file image is a header, an index of
its documents and blocks of the context-mixing range coder (see ``mixing``), each with a
model and a checksum of its own. Images are stored as rows of a table below the shared folder:
Spark's committer then decides which attempt of a lost or repeated task counts, in any store.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from retailflow.llm.bpe import _RUNS, byte_letters
from retailflow.llm.common import small_batches
from retailflow.llm.mixing import MAX_BLOCK_IDS, decode_blocks, encode_blocks

FILE_IDS = 1 << 22
CACHED_PIECES = 600_000
STEP_BYTES = 1 << 22  # text that is cut into pieces at a time
HEADER = struct.Struct("<4sIQQQI")  # mark, version, documents, ids, ids before in the part, bytes of the index
CHECK = struct.Struct("<I")  # crc32 of header and index
MARK, VERSION = b"tids", 2
LETTERS, NUMBERS, _, SPACES = _RUNS
_CUT = re.compile(rb"[!-~] (?=[!-~])")


class LibraryTokens:
    """Packed ids of texts, from the tokenizer's model; ids of pieces are kept while room lasts.

    The pre-tokenizer cuts a text where classes of characters change, which numpy finds for many
    texts at once. The model never joins two pieces, so each distinct piece of a batch is looked up once.
    Texts with a special token go through the tokenizer whole.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.letters = {b: c for c, b in byte_letters().items()}
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Packed ids of each text; null counts as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        out: list[list[bytes]] = [[] for _ in range(len(texts))]
        whole = np.zeros(len(texts), dtype=bool)
        for token in self.special:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        for n in np.flatnonzero(whole).tolist():
            out[n].append(array("I", self.tokenizer.encode(texts[n].as_py(), add_special_tokens=False).ids).tobytes())
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = memoryview(texts.buffers()[2] or b"")
        owners, parts, held = [], [], 0
        for n in np.flatnonzero(~whole).tolist():
            at, end = int(ends[n]), int(ends[n + 1])
            while at < end:
                # A space between two visible ASCII characters starts a piece, so long texts may be cut there.
                cut = _CUT.search(data, at + STEP_BYTES, end) if end - at > STEP_BYTES else None
                stop = cut.start() + 1 if cut else end
                owners.append(n)
                parts.append(data[at:stop])
                held, at = held + stop - at, stop
                if held >= STEP_BYTES:
                    self._encode_parts(owners, parts, out)
                    owners, parts, held = [], [], 0
        if parts:
            self._encode_parts(owners, parts, out)
        return [b"".join(packed) for packed in out]

    def _encode_parts(self, owners: list[int], parts: list[memoryview], out: list[list[bytes]]) -> None:
        data = b"".join(parts)
        ends = np.cumsum([len(p) for p in parts])
        starts = piece_starts(data, ends)
        # Arrow numbers the distinct pieces, so each is looked up once.
        offsets = np.append(starts, len(data)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        _, bounds, distinct = coded.dictionary.buffers()
        bounds, distinct = np.frombuffer(bounds, np.int32, len(coded.dictionary) + 1).tolist(), distinct.to_pybytes()
        get = self.pieces.get
        packed = [get(p) or self._piece(p) for p in map(distinct.__getitem__, map(slice, bounds, bounds[1:]))]
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) >> 2
        firsts = np.cumsum(sizes) - sizes
        known = np.frombuffer(b"".join(packed), "<u4")
        which = coded.indices.to_numpy()
        counts = sizes[which]
        upto = np.cumsum(counts)
        ids = known[np.repeat(firsts[which] - upto + counts, counts) + np.arange(upto[-1])].tobytes()
        at = 0
        for owner, end in zip(owners, (4 * upto[np.searchsorted(offsets, ends) - 1]).tolist()):
            out[owner].append(ids[at:end])
            at = end

    def _piece(self, piece: bytes) -> bytes:
        out = self.older.get(piece)
        if out is None:
            letters = piece.decode("latin-1").translate(self.letters)
            out = array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()
        if len(piece) <= 64:
            if len(self.pieces) >= CACHED_PIECES:
                # What was used since the last turn stays at hand.
                self.older = self.pieces.copy()
                self.pieces.clear()
            self.pieces[piece] = out
        return out


@lru_cache(maxsize=1)
def character_classes() -> np.ndarray:
    """0 other white space, 1 the space, 2 letter, 3 number, 4 other, by code point."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    out = np.full(0x110000, 4, dtype=np.uint8)
    for run, mark in ((LETTERS, 2), (NUMBERS, 3), (SPACES, 0)):
        for found in run.finditer(every):
            first, last = ord(found[0][0]), ord(found[0][-1])
            out[first : last + 1] = mark
    out[ord(" ")] = 1
    return out


def piece_starts(data: bytes, ends: np.ndarray) -> np.ndarray:
    """Byte places where a piece of the pre-tokenizer starts, in texts that end at ``ends``, none empty."""
    points = np.frombuffer(data.decode().encode("utf-32-le"), "<u4")
    places = None
    if len(points) < len(data):
        places = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
        ends = np.append(places, len(data)).searchsorted(ends)
    kind = character_classes()[points]
    firsts = np.append(0, ends[:-1])
    blank = kind < 2
    before = np.empty_like(kind)
    before[1:], before[firsts] = kind[:-1], 5
    start = (before != kind) & (before != 1) & ~(blank & (before < 2))
    # The last white space before a word is apart from those before it.
    ahead = np.zeros(len(kind), dtype=bool)
    ahead[:-1] = ~blank[1:]
    ahead[ends - 1] = False
    start |= blank & ahead
    # 's and its like, unless the mark follows a space or belongs to a run of marks.
    quotes = np.flatnonzero((points == 39) & (before != 1) & (before != 4))
    if len(quotes):
        rest = ends[ends.searchsorted(quotes, "right")]
        padded = np.append(points, [0, 0])
        one = np.where(rest - quotes > 1, padded[quotes + 1], 0)
        two = np.where(rest - quotes > 2, padded[np.minimum(quotes + 2, len(points))], 0)
        size = np.where(np.isin(one, [ord(c) for c in "stmd"]), 2, 0)
        for a, b in ("re", "ve", "ll"):
            size[(one == ord(a)) & (two == ord(b))] = 3
        quotes, size, rest = quotes[size > 0], size[size > 0], rest[size > 0]
        start[quotes + 1] = False
        after = quotes + size
        start[after[after < rest]] = True
    start[firsts] = True
    found = np.flatnonzero(start)
    return found if places is None else places[found]


@lru_cache(maxsize=4)
def library_tokens(path: str) -> LibraryTokens:
    """Built once per Python worker."""
    return LibraryTokens(path)


def pack_file(doc_ids: list[str | None], tokens: list[bytes], before: int) -> bytes:
    """A file image of documents with their packed ids; ``before`` counts the part's ids so far."""
    names = [None if i is None else i.encode() for i in doc_ids]
    sizes = np.array([-1 if n is None else len(n) for n in names], dtype="<i4")
    counts = np.array([len(t) // 4 for t in tokens], dtype="<i8")
    index = zlib.compress(sizes.tobytes() + counts.tobytes() + b"".join(n or b"" for n in names))
    ids = np.frombuffer(b"".join(tokens), dtype="<u4")
    # Short files get short blocks, so that there are always many to code in step.
    block_ids = int(np.clip(len(ids) // 2048, 512, MAX_BLOCK_IDS))
    head = HEADER.pack(MARK, VERSION, len(names), len(ids), before, len(index)) + index
    return head + CHECK.pack(zlib.crc32(head)) + encode_blocks(ids, block_ids)


def unpack_files(images: list[bytes]) -> Iterator[tuple[str | None, int, bytes]]:
    """``(doc_id, ids before in the part, packed ids)`` of all documents; raises on any damage."""
    heads, blocks = [], []
    for image in images:
        if len(image) < HEADER.size:
            raise ValueError("the file is cut short")
        mark, version, n_docs, n_ids, before, size = HEADER.unpack_from(image)
        end = HEADER.size + size
        if mark != MARK or version != VERSION or len(image) < end + CHECK.size:
            raise ValueError("not a token file")
        if zlib.crc32(image[:end]) != CHECK.unpack_from(image, end)[0]:
            raise ValueError("the file's header or index is damaged")
        plain = zlib.decompress(image[HEADER.size : end])
        sizes, counts = np.frombuffer(plain, "<i4", n_docs), np.frombuffer(plain, "<i8", n_docs, 4 * n_docs)
        heads.append((sizes, counts, plain[12 * n_docs :], n_ids, before))
        blocks.append(image[end + CHECK.size :])
    for (sizes, counts, names, n_ids, before), ids in zip(heads, decode_blocks(blocks)):
        if len(ids) != n_ids or counts.sum() != n_ids:
            raise ValueError("the file does not hold the ids that its header counts")
        at = place = 0
        packed = ids.astype("<u4").tobytes()
        for size, count in zip(sizes.tolist(), counts.tolist()):
            name = None if size < 0 else names[at : at + size].decode()
            yield name, before + place, packed[4 * place : 4 * (place + count)]
            at, place = at + max(size, 0), place + count


def write_files(
    docs: DataFrame, tokenizer: str, folder: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Write the ids of all documents, ``end_id`` after each, as file images below ``folder``.

    Rows of the table: ``part, file, first_doc, n_docs, n_ids, image``. Parts, files and documents
    within are in ascending order of ``id_col``, nulls first; rows of one id, however many, are dealt
    over parts by the hash of their text and their place in the input. Null and empty texts are the end
    id alone; texts of any length are taken whole, a file has room for the longest; other
    columns do not matter; an empty table gives a table without rows.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    rows = rows.withColumns({"h": F.xxhash64("t"), "m": F.monotonically_increasing_id()})
    rows = rows.repartitionByRange("i", "h", "m").sortWithinPartitions("i", "h", "m")
    rows = rows.select(F.col("i").cast("string").alias("i"), "t")

    kinds = {"part": pa.int32(), "file": pa.int32(), "first_doc": pa.string(), "n_docs": pa.int64(), "n_ids": pa.int64()}
    schema = pa.schema({**kinds, "image": pa.binary()})

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, table, close = TaskContext.get().partitionId(), library_tokens(tokenizer), array("I", [end_id]).tobytes()
        names: list[str | None] = []
        tokens: list[bytes] = []
        held = before = files = 0

        def image() -> pa.RecordBatch:
            row = (part, files, names[0], len(names), held // 4, pack_file(names, tokens, before))
            return pa.RecordBatch.from_arrays([pa.array([v], t.type) for v, t in zip(row, schema)], schema=schema)

        for batch in batches:
            for name, ids in zip(batch.column(0).to_pylist(), table.encode(batch.column(1))):
                names.append(name)
                tokens.append(ids + close)
                held += len(tokens[-1])
                if held >= 4 * FILE_IDS:
                    yield image()
                    names, tokens, held, before, files = [], [], 0, before + held // 4, files + 1
        if names:
            yield image()

    images = rows.mapInArrow(pack, "part int, file int, first_doc string, n_docs long, n_ids long, image binary")
    images.write.parquet(folder)


def read_files(spark: SparkSession, folder: str, id_type: str = "bigint") -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document in the files of ``folder``.

    ``start`` counts the ids of all documents before; ``ids`` is packed, four little-endian bytes
    each. Every block is held against its checksum; damage raises. Sizes of parts, one row for
    each range of the writer, are summed up in one window.
    """
    files = spark.read.parquet(folder)

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, images in batch.groupby("part")["image"]:
                found = list(unpack_files(list(images)))
                out = pd.DataFrame(found, columns=["i", "start", "ids"])
                yield out.assign(part=part)[["part", "i", "start", "ids"]]

    documents = files.select("part", "image").mapInPandas(unpack, "part int, i string, start long, ids binary")
    sizes = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("part", F.coalesce(earlier, F.lit(0)).alias("skip"))
    placed = documents.join(F.broadcast(starts), "part")
    return placed.select(
        F.col("i").cast(id_type).alias("doc_id"),
        (F.col("start") + F.col("skip")).alias("start"),
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        "ids",
    )
