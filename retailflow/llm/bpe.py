"""Byte-level BPE as a streaming transducer with bounded lookahead.

Whether a merge happens depends on the text to the right, but only so far: the
merge list itself bounds the distance (``MergeTable.lookahead``). The encoder
therefore emits every token that ends further than that from the end of what it
has read, and keeps a tail of constant size. Decoding runs the token bytes
through an incremental byte-to-text state machine.
"""

from __future__ import annotations

import codecs
import json
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailflow.llm.common import small_batches

#: Characters that a stream is cut into, so that the state does not grow with the text.
CHUNK_CHARS = 1 << 16
#: Longest run of one character class that is encoded in one go, in bytes.
RUN_BYTES = 512
CACHED_UNITS = 400_000

# White space of the pre-tokenizer, its pattern, its character classes.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^SPACE\p{L}\p{N}]+|[SPACE]+(?![^SPACE])|[SPACE]+"""
CLASSES = (r"\p{L}+", r"\p{N}+", r"[^SPACE\p{L}\p{N}]+", r"[SPACE]+")

_UNIT = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
_PIECE = regex.compile(PIECES.replace("SPACE", SPACE))
_RUNS = [regex.compile(c.replace("SPACE", SPACE)) for c in CLASSES]


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary file."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    letters = {chr(b): b for b in printable}
    return letters | {chr(256 + n): b for n, b in enumerate(others)}


class MergeTable:
    """Vocabulary and merges of a tokenizer file, and the lookahead that they need."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        plain = {t: n for t, n in vocab.items() if t not in self.special}
        self.bytes_of = {n: bytes(letters[c] for c in t) for t, n in plain.items()}
        self.bytes_of |= {n: t.encode() for t, n in self.special.items()}
        self.byte_id = [vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        #: (left << 20 | right) -> rank, and rank -> merged id.
        self.rank = {vocab[a] << 20 | vocab[b]: n for n, (a, b) in enumerate(merges)}
        self.merged = [vocab[a + b] for a, b in merges]
        self.lookahead = self._lookahead([(vocab[a], vocab[b]) for a, b in merges])

    def _lookahead(self, merges: list[tuple[int, int]]) -> int:
        """Bytes to the right of a token end beyond which the text cannot change it.

        Take two texts that agree up to a point. Their tokens first differ when a
        merge (a, b) reaches across that point in one of them; from then on they may
        differ from where that ``a`` starts. A later merge moves the point further
        left only if its right part starts with such an ``a``. The furthest move is
        thus the heaviest chain of merges in order of rank, in which each ``a`` is
        among the leftmost parts of the next ``b``.
        """
        left_part = {m: a for m, (a, _) in zip(self.merged, merges)}
        moved: dict[int, int] = {}
        most = 0
        for a, b in merges:
            before, part = 0, b
            while part is not None:
                before = max(before, moved.get(part, 0))
                part = left_part.get(part)
            reach = before + len(self.bytes_of[a])
            moved[a] = max(moved.get(a, 0), reach)
            most = max(most, reach)
        return most

    def merge(self, data: bytes) -> list[int]:
        """Token ids of a byte run, by the lowest rank first, leftmost first."""
        ids = [self.byte_id[b] for b in data]
        get, merged = self.rank.get, self.merged
        none = len(merged)
        ranks = [get(a << 20 | b, none) for a, b in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            at = ranks.index(best)
            ids[at : at + 2] = [merged[best]]
            del ranks[at]
            if at:
                ranks[at - 1] = get(ids[at - 1] << 20 | ids[at], none)
            if at < len(ranks):
                ranks[at] = get(ids[at] << 20 | ids[at + 1], none)
        return ids


class _Units(dict):
    """Packed ids of short units, computed on first use; emptied when full."""

    def __init__(self, table: MergeTable) -> None:
        super().__init__()
        self.table = table
        self.pieces: dict[str, bytes] = {}

    def __missing__(self, unit: str) -> bytes:
        parts = _PIECE.findall(unit)
        out = b"".join([self.pieces.get(p) or self._piece(p) for p in parts])
        if len(unit) <= 64:
            if len(self) >= CACHED_UNITS:
                self.clear()
            self[unit] = out
        return out

    def _piece(self, piece: str) -> bytes:
        data = piece.encode()
        if len(data) > RUN_BYTES:
            run = Run(self.table)
            out = run.feed(data) + run.finish()
        else:
            out = array("I", self.table.merge(data)).tobytes()
        if len(piece) <= 64:
            if len(self.pieces) >= CACHED_UNITS:
                self.pieces.clear()
            self.pieces[piece] = out
        return out


class Run:
    """One pre-token that arrives in parts; tokens leave as soon as they are stable."""

    def __init__(self, table: MergeTable) -> None:
        self.table = table
        self.tail = b""

    def feed(self, data: bytes) -> bytes:
        out = []
        window = max(RUN_BYTES, 2 * self.table.lookahead)
        data, at = self.tail + data, 0
        while len(data) - at > window:
            ids, end = self.table.merge(data[at : at + window]), 0
            stable = []
            for i in ids:
                end += len(self.table.bytes_of[i])
                if end > window - self.table.lookahead:
                    break
                stable.append(i)
                at += len(self.table.bytes_of[i])
            out.append(array("I", stable).tobytes())
        self.tail = data[at:]
        return b"".join(out)

    def finish(self) -> bytes:
        out, self.tail = array("I", self.table.merge(self.tail)).tobytes(), b""
        return out


class Encoder:
    """Text in, packed ids (little-endian unsigned 32 bit) out, in parts of any size.

    The state is the last white-space unit, or, inside a long run of one character
    class, the class and a byte tail of bounded size.
    """

    def __init__(self, table: MergeTable) -> None:
        self.table = table
        self.units = _Units(table)
        self.special = re.compile("|".join(map(re.escape, table.special))) if table.special else None
        self.overhang = max(map(len, table.special), default=1) - 1
        self.reset()

    def reset(self) -> None:
        self.held = ""
        self.run: Run | None = None
        self.inside = None

    def encode(self, text: str) -> bytes:
        """Ids of a whole text."""
        if len(text) <= CHUNK_CHARS and not (self.special and self.special.search(text)):
            return b"".join(map(self.units.__getitem__, _UNIT.findall(text)))
        parts = (text[n : n + CHUNK_CHARS] for n in range(0, len(text), CHUNK_CHARS))
        return b"".join(self.stream(parts))

    def stream(self, parts: Iterable[str]) -> Iterator[bytes]:
        """Ids of a text that arrives in parts."""
        self.reset()
        for part in parts:
            yield self._advance(part, last=False)
        yield self._advance("", last=True)

    def _advance(self, part: str, last: bool) -> bytes:
        out, text = [], self.held + part
        while self.special and (found := self.special.search(text)):
            out.append(self._plain(text[: found.start()], last=True)[0])
            out.append(array("I", [self.table.special[found[0]]]).tobytes())
            text = text[found.end() :]
        # The start of a special token may stand at the end.
        keep = 0
        if not last and self.special:
            keep = next(
                (n for n in range(min(self.overhang, len(text)), 0, -1) if any(s.startswith(text[-n:]) for s in self.table.special)),
                0,
            )
        body, rest = (text[:-keep], text[-keep:]) if keep else (text, "")
        packed, open_ = self._plain(body, last)
        out.append(packed)
        self.held = open_ + rest
        return b"".join(out)

    def _plain(self, text: str, last: bool) -> tuple[bytes, str]:
        """Ids of text without special tokens, and the characters that must wait."""
        out = []
        if self.run is not None:
            text, done = self._continue(text, last, out)
            if not done:
                return b"".join(out), text
        if last:
            out.append(b"".join(map(self.units.__getitem__, _UNIT.findall(text))))
            return b"".join(out), ""
        units = _UNIT.findall(text)
        if not units:
            return b"".join(out), ""
        out.append(b"".join(map(self.units.__getitem__, units[:-1])))
        open_ = units[-1]
        if len(open_) <= max(8, CHUNK_CHARS // 4):
            return b"".join(out), open_
        # One long unit: its pieces but the last are fixed, save for a contraction at the end.
        at, pieces = 0, [m.span() for m in _PIECE.finditer(open_)]
        for start, end in pieces[:-1]:
            if end > len(open_) - 3:
                break
            out.append(self.units._piece(open_[start:end]))
            at = end
        open_ = open_[at:]
        if len(pieces) and pieces[-1][0] == at and len(open_) > max(8, CHUNK_CHARS // 4):
            lead = 1 if open_[0] == " " and not _RUNS[3].fullmatch(open_) else 0
            self.inside = next((r for r in _RUNS if r.fullmatch(open_, lead)), None)
            if self.inside is not None:
                self.run = Run(self.table)
                if lead:
                    out.append(self.run.feed(b" "))
                open_, _ = self._continue(open_[lead:], False, out)
        return b"".join(out), open_

    def _continue(self, text: str, last: bool, out: list[bytes]) -> tuple[str, bool]:
        """Carry a long run on; True when it has ended."""
        found = self.inside.match(text)
        size = found.end() if found else 0
        ended = last or size < len(text)
        if self.inside is _RUNS[3]:
            # The last white space may belong to the next word.
            if size < len(text):
                size = max(0, size - 1)
            elif not last:
                size -= 1 if size else 0
        out.append(self.run.feed(text[:size].encode()))
        if ended:
            out.append(self.run.finish())
            self.run = self.inside = None
        return text[size:], ended


class Decoder:
    """Ids in, text out, in parts of any size; bytes that are no UTF-8 become U+FFFD."""

    def __init__(self, table: MergeTable) -> None:
        self.bytes_of = table.bytes_of.__getitem__
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def decode(self, packed: bytes) -> str:
        """Text of a whole id sequence."""
        self.machine.reset()
        ids = memoryview(packed).cast("I")
        step = CHUNK_CHARS
        if len(ids) <= step:
            return self.feed(ids) + self.finish()
        return "".join([self.feed(ids[n : n + step]) for n in range(0, len(ids), step)]) + self.finish()

    def feed(self, ids: Iterable[int]) -> str:
        return self.machine.decode(b"".join(map(self.bytes_of, ids)))

    def finish(self) -> str:
        return self.machine.decode(b"", final=True)


@lru_cache(maxsize=4)
def machines(path: str) -> tuple[Encoder, Decoder]:
    """Encoder and decoder of a file, built once per Python worker."""
    table = MergeTable(path)
    return Encoder(table), Decoder(table)


def encode_decode(text: Column, path: str) -> Column:
    """Struct ``n_tokens, ids, decoded`` of a text column; null counts as empty.

    ``ids`` is binary, four little-endian bytes per token.
    """

    @F.pandas_udf("n_tokens long, ids binary, decoded string")
    def run(texts: pd.Series) -> pd.DataFrame:
        encoder, decoder = machines(path)
        ids = [encoder.encode(t or "") for t in texts]
        return pd.DataFrame(
            {"n_tokens": [len(x) // 4 for x in ids], "ids": ids, "decoded": [decoder.decode(x) for x in ids]}
        )

    return run(text)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, ids, decoded`` of every document, in one pass without a shuffle.

    Whole texts of any length; null and empty texts give no ids and an empty text;
    repeated rows and null ids are kept; other columns do not matter.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    return rows.select(F.col("i").alias(id_col), encode_decode(F.col("t"), path).alias("r")).select(id_col, "r.*")
