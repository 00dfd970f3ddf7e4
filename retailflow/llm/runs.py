"""Periodic runs of words by maximal-pair enumeration on an LCP-interval tree.

A run with period q is a stretch whose words q apart are equal and that no neighbour
extends. Its words without the last q and its words without the first q are the two
occurrences of a maximal pair at distance q: words before and after them differ. The
other way round, a maximal pair of common length l at distance q <= l / 3 is a stretch of
l + q >= 4 q words with period q that neither side extends, so such pairs are the runs
and nothing is left to extend.

Suffixes of all documents of a batch are sorted together by prefix doubling, each
document with words and an end of its own. The LCP-interval tree is walked bottom-up; a
node keeps its positions in lists by the word on their left, and where two children meet,
only positions of different lists and bounded distance are paired. A run of period p also
gives pairs at 2p, 3p, ... with the same bounds; the least distance is its period.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailflow.llm.common import small_batches

MIN_WORDS = 6
MIN_REPEATS = 4
#: Words whose suffixes are sorted together; a longer document is sorted alone.
BATCH_WORDS = 1 << 18

Run = tuple[int, int, int]  # start, length, period


class _Node:
    """Positions below a node of the tree, sorted, whole and by the word on their left."""

    __slots__ = ("places", "classes")

    def __init__(self, place: int, left: int) -> None:
        self.places = [place]
        self.classes = {left: [place]}


class _Tree:
    """Bottom-up walk over the LCP intervals of one group of sorted suffixes."""

    def __init__(self, left: list[int], least_words: int, repeats: int) -> None:
        self.left, self.least_words, self.ratio = left, least_words, repeats - 1
        self.found: dict[tuple[int, int], int] = {}

    def walk(self, places: list[int], shared: list[int]) -> None:
        """``shared[n]`` is the number of words that suffixes n and n + 1 have in common."""
        open_: list[tuple[int, _Node]] = []
        left = self.left
        done = _Node(places[0], left[places[0]])
        for place, depth in zip(places[1:], shared):
            while open_ and open_[-1][0] > depth:
                at, node = open_.pop()
                done = self.join(node, done, at)
            if open_ and open_[-1][0] == depth:
                open_[-1] = (depth, self.join(open_[-1][1], done, depth))
            else:
                open_.append((depth, done))
            done = _Node(place, left[place])
        while open_:
            at, node = open_.pop()
            done = self.join(node, done, at)

    def join(self, a: _Node, b: _Node, depth: int) -> _Node:
        """Report the maximal pairs between two children, then pour the smaller into the larger."""
        small, large = (a, b) if len(a.places) <= len(b.places) else (b, a)
        far, near = depth // self.ratio, max(1, self.least_words - depth)
        if far >= near:
            for left, places in small.classes.items():
                for x in places:
                    self._pairs(x, left, large, depth, near, far)
        for left, places in small.classes.items():
            mine = large.classes.get(left)
            if mine is None:
                large.classes[left] = places
            elif len(places) == 1:
                insort(mine, places[0])
            else:
                mine += places
                mine.sort()
        if len(small.places) == 1:
            insort(large.places, small.places[0])
        else:
            large.places += small.places
            large.places.sort()
        return large

    def _pairs(self, x: int, left: int, node: _Node, depth: int, near: int, far: int) -> None:
        places = node.places
        low, high = bisect_left(places, x - far), bisect_right(places, x + far)
        if low == high:
            return
        if high - low <= 2 * len(node.classes):
            others = [y for y in places[low:high] if self.left[y] != left]
        else:
            others = []
            for word, places in node.classes.items():
                if word != left:
                    others += places[bisect_left(places, x - far) : bisect_right(places, x + far)]
        for y in others:
            start, period = (x, y - x) if x < y else (y, x - y)
            if period >= near:
                key = (start, depth + period)
                if period < self.found.get(key, period + 1):
                    self.found[key] = period


def _suffix_groups(symbols: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Groups of sorted suffixes that share at least ``least`` symbols, with their common lengths.

    Prefix doubling; a suffix that is alone in its rank leaves. ``symbols`` must hold a
    unique symbol at the end of every document.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    first = np.empty(n, dtype=bool)
    first[0], first[1:] = True, symbols[order][1:] != symbols[order][:-1]
    rank = np.empty(n + 1, dtype=np.int32)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank[n] = -1
    levels, width = [rank], 1
    active, mine = _shared(order, rank[order])
    pool, keep = (active, True) if width >= least else (active[:0], False)
    while len(active):
        key = mine.astype(np.int64) * (n + 2) + rank[np.minimum(active + width, n)] + 1
        by = np.argsort(key, kind="stable")
        active, key, mine = active[by], key[by], mine[by]
        slot = mine + _place_in_group(mine)
        fresh = np.empty(len(key), dtype=bool)
        fresh[0], fresh[1:] = True, key[1:] != key[:-1]
        rank = rank.copy()
        rank[active] = np.maximum.accumulate(np.where(fresh, slot, 0))
        levels.append(rank)
        width *= 2
        active, mine = _shared(active, rank[active])
        if not keep and 2 * width > least:
            pool, keep = active, True  # all suffixes with a partner that shares ``width`` symbols
    if not len(pool):
        return
    pool = pool[np.argsort(rank[pool], kind="stable")]
    a, b = pool[:-1], pool[1:]
    shared = np.zeros(len(a), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        same = levels[k][np.minimum(a + shared, n)] == levels[k][np.minimum(b + shared, n)]
        shared += same.astype(np.int64) << k
    cuts = np.flatnonzero(shared < least)
    starts, ends = np.concatenate([[0], cuts + 1]), np.concatenate([cuts + 1, [len(pool)]])
    for s, e in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist()):
        yield pool[s:e], shared[s : e - 1]


def _place_in_group(ranks: np.ndarray) -> np.ndarray:
    """Number of each entry within its stretch of equal values."""
    at = np.arange(len(ranks))
    first = np.empty(len(ranks), dtype=bool)
    first[:1], first[1:] = True, ranks[1:] != ranks[:-1]
    return at - np.maximum.accumulate(np.where(first, at, 0))


def _shared(order: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries whose rank a neighbour has too; equal ranks stand together."""
    same = ranks[1:] == ranks[:-1]
    both = np.zeros(len(ranks), dtype=bool)
    both[1:] |= same
    both[:-1] |= same
    return order[both], ranks[both]


def find_runs(documents: list[list], least_words: int = MIN_WORDS, repeats: int = MIN_REPEATS) -> list[list[Run]]:
    """``(start, length, period)`` of each document's runs, by start, then period.

    Runs have at least ``least_words`` words and ``repeats`` periods; ``repeats`` >= 2, so that all
    periods of one stretch are multiples of the least.
    """
    if repeats < 2:
        raise ValueError("a run must hold two periods at least")
    out: list[list[Run]] = []
    at = 0
    while at < len(documents):
        end, size = at, 0
        while end < len(documents) and (end == at or size + len(documents[end]) <= BATCH_WORDS):
            size += len(documents[end])
            end += 1
        out += _batch_runs(documents[at:end], least_words, repeats)
        at = end
    return out


def _batch_runs(documents: list[list], least_words: int, repeats: int) -> list[list[Run]]:
    # The shortest repeat: one period less than the run, for the period that allows the least.
    least = min(max(least_words, repeats * q) - q for q in range(1, max(2, least_words)))
    sizes = np.array([len(d) + 1 for d in documents], dtype=np.int64)
    ends = np.cumsum(sizes)
    numbers: dict = {}
    words = [numbers.setdefault(w, len(numbers)) for d in documents for w in [*d, None]]
    symbols = np.array(words, dtype=np.int64)
    symbols += np.repeat(np.arange(len(documents)), sizes) * len(numbers)  # words of each document are its own
    out: list[list[Run]] = [[] for _ in documents]
    tree = _Tree([], least_words, repeats)
    for places, shared in _suffix_groups(symbols, least):
        ordered = np.sort(places)
        if (np.diff(ordered).min()) * (repeats - 1) > shared.max():
            continue  # no two occurrences are close enough
        if not tree.left:
            tree.left = [-1, *symbols[:-1].tolist()]
        tree.walk(places.tolist(), shared.tolist())
    if tree.found:
        starts = np.array([s for s, _ in tree.found], dtype=np.int64)
        owners = np.searchsorted(ends, starts, side="right")
        firsts = starts - (ends - sizes)[owners]
        for owner, first, (_, length), period in zip(owners.tolist(), firsts.tolist(), tree.found, tree.found.values()):
            out[owner].append((first, length, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def collapse(words: list[bytes], runs: list[Run]) -> bytes:
    """The words that no run contains beyond its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    kept = np.cumsum(edge)[:-1] == 0
    return b" ".join([words[n] for n in np.flatnonzero(kept).tolist()])


def run_documents(
    docs: DataFrame,
    least_words: int = MIN_WORDS,
    repeats: int = MIN_REPEATS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col, n_words, runs, collapsed`` of every document, in one pass without a shuffle.

    Words are ``[^\\x20\\x09-\\x0D]+``. ``runs`` holds ``start, length, period`` by start, then
    period; ``collapsed`` is the text without the words that repeat a run's first period.

    Null and empty texts have no words, no runs and an empty collapsed text. Texts of any
    length are taken whole; one task holds about 60 bytes for each word of the longest text and as
    many again for each doubling of its longest repeat. Two runs may start at one word: both are
    given. Repeated rows and null ids are kept; other columns do not matter; an empty table gives
    an empty result.
    """
    small_batches(docs.sparkSession)
    # Ids travel as text: pandas turns a column of longs with nulls into doubles.
    rows = docs.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t"))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # bytes.split cuts at the six ASCII white-space characters and no others.
            words = [(t or "").encode("utf-8", "surrogatepass").split() for t in batch["t"]]
            runs = find_runs(words, least_words, repeats)
            yield pd.DataFrame(
                {
                    "i": batch["i"],
                    "n_words": [len(w) for w in words],
                    "runs": [[{"start": s, "length": n, "period": p} for s, n, p in r] for r in runs],
                    "collapsed": [collapse(w, r).decode("utf-8", "surrogatepass") for w, r in zip(words, runs)],
                }
            )

    found = rows.mapInPandas(
        search, "i string, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    )
    kind = docs.schema[id_col].dataType
    return found.select(F.col("i").cast(kind).alias(id_col), "n_words", "runs", "collapsed")


def plant_period(text: Column, doc_id: Column) -> Column:
    """The text with a periodic tail in every tenth document, chosen by the crc32 of its id.

    Let h be that crc32, g = floor(h / 10) and n the number of words. If 10 divides h and n > 0,
    each word i >= a becomes word a + (i - a) % p of the text, where a = g % n and
    p = 1 + floor((n - a) / (3 + g % 8)). Other texts, and those without id, stay as they are.
    """
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def planted(v: Column) -> Column:
        w, n = v["w"], F.size(v["w"])
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        tail = F.transform(F.sequence(a, n - 1), lambda i: F.element_at(w, a + (i - a) % p + 1))
        return F.array_join(F.concat(F.slice(w, F.lit(1), a), tail), " ")

    # A list of one binds the words to a name, so that the text is split once.
    bound = F.transform(F.array(F.struct(words.alias("w"))), lambda v: F.when(F.size(v["w"]) > 0, planted(v)))
    return F.when((h % 10 == 0) & text.isNotNull(), F.coalesce(bound[0], text)).otherwise(text)
