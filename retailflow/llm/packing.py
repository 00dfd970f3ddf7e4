"""Best-fit packing of token pieces into sequences by minimum bin slack.

What the packing decides depends on piece lengths only, and there are at most
``capacity`` of them. Spark counts the pieces per length; the driver plans on that
histogram, whose size does not grow with the data: the longest piece left opens a
bin, a subset-sum over bitsets finds the fullest filling from the lengths still
available, and the combination is taken as often as the counts allow. Spark then
numbers the pieces of each length and looks their places up.
"""

from __future__ import annotations

import zlib
from array import array
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from retailflow.llm.bpe import byte_letters
from retailflow.llm.common import materialise, small_batches

CAPACITY = 2048
CACHED_WORDS = 600_000
#: Words up to this letter are alphabetic in any Unicode version.
LAST_LATIN = "\u024f"
#: Pieces that one task numbers within a length.
NUMBERED_ROWS = 10_000


class WordTokens(dict):
    """Packed ids of words between white space, from the tokenizer, kept while room lasts.

    The tokenizer drops white space and never looks across it, so the ids of a text are
    those of its words. Texts with its special tokens go through it whole.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.letters = [c for c, _ in sorted(byte_letters().items(), key=lambda x: x[1])]
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # str.split() also cuts at four control characters that the tokenizer keeps.
        self.odd = ("\x1c", "\x1d", "\x1e", "\x1f")

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special) or any(c in text for c in self.odd):
            return self._whole(text)
        return b"".join(map(self.__getitem__, text.split()))

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, word: str) -> bytes:
        if len(word) > 1 and word[-1] in ".," and word[-2].lower().isalpha():
            out = self[word[:-1]] + self[word[-1]]
        elif word.isalpha() and max(word) <= LAST_LATIN:
            low = word.lower()
            if low == word and is_normalized("NFC", word):
                # One pre-token as it stands: straight to the tokenizer's model.
                letters = "".join(map(self.letters.__getitem__, word.encode()))
                out = array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()
            else:
                out = self[low] if len(low) == len(word) and low != word else self._whole(word)
        else:
            out = self._whole(word)
        if len(word) <= 64:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = out
        return out


@lru_cache(maxsize=4)
def words(path: str) -> WordTokens:
    """Built once per Python worker."""
    return WordTokens(path)


def token_ids(text: Column, path: str, end_id: int = 0) -> Column:
    """Ids of a text and a closing ``end_id``, packed as little-endian unsigned 32 bit."""

    @F.pandas_udf("binary")
    def run(texts: pd.Series) -> pd.Series:
        table, close = words(path), array("I", [end_id]).tobytes()
        return pd.Series([table.encode(t or "") + close for t in texts])

    return run(text)


def cut_pieces(ids: Column, capacity: int = CAPACITY) -> Column:
    """Pieces of at most ``capacity`` tokens: ``piece, start, length, ids_crc32``."""
    size = F.lit(4 * capacity)
    count = F.ceil(F.octet_length(ids) / size).cast("int")

    def piece(n: Column) -> Column:
        part = F.substring(ids, n * size + 1, size)
        return F.struct(
            n.alias("piece"),
            (n * capacity).cast("long").alias("start"),
            (F.octet_length(part) / 4).cast("long").alias("length"),
            F.crc32(part).alias("ids_crc32"),
        )

    return F.transform(F.sequence(F.lit(0), count - 1), piece)


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """Minimum bin slack on a histogram of lengths: ``(bins, {length: pieces per bin})``."""
    left = {length: n for length, n in counts.items() if n > 0}
    plan = []
    while left:
        first = max(left)
        left[first] -= 1
        filling = fullest(left, capacity - first)
        left[first] += 1
        filling[first] = filling.get(first, 0) + 1
        bins = min(left[length] // n for length, n in filling.items())
        for length, n in filling.items():
            left[length] -= bins * n
            if not left[length]:
                del left[length]
        plan.append((bins, filling))
    return plan


def fullest(available: dict[int, int], room: int) -> dict[int, int]:
    """The combination of available lengths with the largest sum up to ``room``.

    Bit s of a layer says that the lengths so far can sum to s. Counts are split in powers
    of two, longest lengths first; the layers are walked back to find the combination.
    """
    layers, sums, mask, goal = [], 1, (1 << (room + 1)) - 1, 1 << room
    for length in sorted((x for x in available if x <= room), reverse=True):
        n, power = min(available[length], room // length), 1
        while n > 0:
            take = min(power, n)
            layers.append((sums, length, take))
            sums |= (sums << (length * take)) & mask
            n, power = n - take, power * 2
            if sums & goal:
                break
        if sums & goal:
            break
    rest = sums.bit_length() - 1
    chosen: dict[int, int] = {}
    for before, length, take in reversed(layers):
        if not before >> rest & 1:
            chosen[length] = chosen.get(length, 0) + take
            rest -= length * take
    return chosen


def places(plan: list[tuple[int, dict[int, int]]], capacity: int = CAPACITY) -> dict[int, np.ndarray]:
    """Per length the rows ``first number, pieces per bin, first bin, first offset`` of its runs."""
    used: dict[int, int] = {}
    runs: dict[int, list] = {}
    bin_ = 0
    for bins, filling in plan:
        offset = 0
        for length in sorted(filling, reverse=True):
            n = filling[length]
            runs.setdefault(length, []).append((used.get(length, 0), n, bin_, offset))
            used[length] = used.get(length, 0) + bins * n
            offset += n * length
        bin_ += bins
    return {length: np.array(rows, dtype=np.int64) for length, rows in runs.items()}


def assign(pieces: DataFrame, capacity: int = CAPACITY, length_col: str = "length") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; lengths lie between 1 and ``capacity``.

    Pieces of one length are numbered by hash classes, so that a length that a third of
    the pieces share is many tasks. Reads ``pieces`` more than once: pass a stored table
    with a column ``uid`` that is unique.
    """
    spark = pieces.sparkSession
    counts = {r["l"]: r["n"] for r in pieces.groupBy(F.col(length_col).alias("l")).agg(F.count(F.lit(1)).alias("n")).collect()}
    found = spark.sparkContext.broadcast(places(plan_bins(counts, capacity), capacity))
    classes = max(1, -(-sum(counts.values()) // NUMBERED_ROWS))
    marked = pieces.withColumn("class", F.pmod(F.xxhash64("uid"), F.lit(classes)))
    sizes = marked.groupBy(length_col, "class").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(length_col).orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("skip", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    within = Window.partitionBy(length_col, "class").orderBy("uid")
    numbered = marked.withColumn("place", F.row_number().over(within) - 1).join(sizes, [length_col, "class"])

    @F.pandas_udf("sequence_id long, offset long")
    def place(lengths: pd.Series, numbers: pd.Series) -> pd.DataFrame:
        out = np.zeros((len(lengths), 2), dtype=np.int64)
        for length, rows in lengths.groupby(lengths).indices.items():
            runs, number = found.value[length], numbers.to_numpy()[rows]
            first, per, bin_, offset = runs[np.searchsorted(runs[:, 0], number, side="right") - 1].T
            out[rows, 0] = bin_ + (number - first) // per
            out[rows, 1] = offset + (number - first) % per * length
        return pd.DataFrame(out, columns=["sequence_id", "offset"])

    placed = numbered.withColumn("at", place(F.col(length_col), F.col("place") + F.col("skip")))
    return placed.select(*[F.col(f"`{c}`") for c in pieces.columns], "at.sequence_id", "at.offset")


def pack_documents(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """Every piece of every document with its sequence and its offset there.

    Columns: ``id_col, piece, start, length, ids_crc32, sequence_id, offset``, with ``keep_ids``
    also ``ids``, the piece's packed tokens. Null and empty texts are the closing token
    alone. Only documents longer than ``capacity`` are cut. Repeated rows and null ids are
    packed like any others; other columns do not matter; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("i"), token_ids(F.col(text_col), path, end_id).alias("ids"))
    cut = rows.select("i", "ids", F.explode(cut_pieces(F.col("ids"), capacity)).alias("p"))
    columns = ["i", "p.piece", "p.start", "p.length", "p.ids_crc32"]
    if keep_ids:
        part = F.substring("ids", F.col("p.start").cast("int") * 4 + 1, F.lit(4 * capacity))
        cut = cut.withColumn("ids", part)
        columns.append("ids")
    pieces = cut.select(*columns, F.monotonically_increasing_id().alias("uid"))
    packed = assign(materialise(pieces, "pieces"), capacity)
    return packed.withColumnRenamed("i", id_col).drop("uid")
