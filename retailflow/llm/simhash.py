"""SimHash near-duplicates found by Golay-code fuzzy hashing.

The 64 bits of a fingerprint are three segments of 22, 21 and 21 bits. Two
fingerprints that differ in at most two bits have a segment without an error
whose successor has one error at most: either both errors lie in one segment, or
in two, and then the third is clean. The clean segment is joined as it is. Its
successor, padded to a word of the perfect (23, 12) Golay code, is decoded: every
word lies within three bits of exactly one codeword. If two words differ in one
bit, the codeword next to the first lies within four bits of the second. So one
side of the join has one key a segment and the other a key for each codeword
within four bits, five or six of them, and no pair is missed. Equal keys are verified by
counting the bits that differ.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailflow.llm.common import materialise, small_batches
from retailflow.llm.graph import components

SEED = 42
SEGMENTS = ((42, 22), (21, 21), (0, 21))  # lowest bit and width
#: Generator polynomial of the (23, 12) Golay code, a fixed value.
GENERATOR = 0b101011100011
#: Members of a key that are compared pair by pair in the join; larger groups go in tiles.
GROUP_ROWS = 64
TILE_ROWS = 2048


def fingerprints(texts: pd.Series, words: int) -> np.ndarray:
    """SimHash of each text as uint64; see ``fingerprint``."""
    out = np.zeros(len(texts), dtype=np.uint64)
    for n, text in enumerate(texts):
        if text:
            out[n] = _fingerprint(text.encode("utf-8", "surrogatepass").lower().split(), words)
    return out


def _fingerprint(tokens: list[bytes], words: int) -> int:
    if not tokens:
        return 0
    text = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(tokens) < words:
        starts, ends = starts[:1], ends[-1:]
    else:
        starts, ends = starts[: len(tokens) - words + 1], ends[words - 1 :]
    digest = xxhash.xxh64_intdigest
    total = np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), 16384):
        spans = zip(starts[at : at + 16384].tolist(), ends[at : at + 16384].tolist())
        hashes = np.array([digest(text[a:b], SEED) for a, b in spans], dtype=np.uint64)
        total += _bit_counts(hashes)
    bits = total * 2 > len(starts)
    return int(np.packbits(bits[::-1]).view(">u8")[0])


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit, lowest bit first."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    whole = len(bits) // 255 * 255
    # Sums of 255 bits fit a byte.
    parts = bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return parts + bits[whole:].sum(axis=0, dtype=np.int64)


def fingerprint(text: Column, words: int = 3) -> Column:
    """64-bit SimHash as a long.

    ASCII capitals are lowered; words are runs without ASCII white space; shingles of
    ``words`` words count as often as they occur, a shorter text is one shingle, null and
    texts without words give zero. A bit is set if more than half of the XXH64
    hashes (seed 42) have it.
    """

    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(fingerprints(texts, words).view(np.int64))

    return run(text)


@lru_cache(maxsize=1)
def golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndrome of each word, nearest error of each syndrome, errors of up to four bits of each."""
    syndrome = np.zeros(1 << 23, dtype=np.uint16)
    for bit in range(23):
        rest = 1 << bit
        for high in range(bit, 10, -1):
            if rest >> high & 1:
                rest ^= GENERATOR << (high - 11)
        syndrome[1 << bit : 2 << bit] = syndrome[: 1 << bit] ^ rest
    errors = [[] for _ in range(2048)]
    for weight in range(5):
        for bits in combinations(range(23), weight):
            error = sum(1 << b for b in bits)
            errors[syndrome[error]].append(error)
    width = max(map(len, errors))
    table = np.array([e + [-1] * (width - len(e)) for e in errors], dtype=np.int32)
    return syndrome, table[:, 0], table


def segments(prints: np.ndarray) -> np.ndarray:
    """The three segments of each fingerprint."""
    bits = prints.astype(np.int64).view(np.uint64)
    cut = [(bits >> np.uint64(low)) & np.uint64((1 << width) - 1) for low, width in SEGMENTS]
    return np.stack(cut, axis=1).astype(np.int64)


def _key(segment: int, exact: np.ndarray, codeword: np.ndarray) -> np.ndarray:
    return (np.int64(segment) << 34) | (exact << 12) | (codeword >> 11)


def nearest_keys(prints: np.ndarray) -> np.ndarray:
    """One key per segment: the segment itself and the codeword nearest to its successor."""
    syndrome, nearest, _ = golay()
    parts = segments(prints)
    return np.stack([_key(s, parts[:, s], (w := parts[:, (s + 1) % 3]) ^ nearest[syndrome[w]]) for s in range(3)], axis=1)


def near_keys(prints: np.ndarray) -> list[np.ndarray]:
    """Per fingerprint the keys of all codewords within four bits of the successor."""
    syndrome, _, errors = golay()
    parts = segments(prints)
    keys, valid = [], []
    for s in range(3):
        word = parts[:, (s + 1) % 3]
        error = errors[syndrome[word]]
        keys.append(_key(s, parts[:, s, None], word[:, None] ^ np.maximum(error, 0)))
        valid.append(error >= 0)
    keys, valid = np.concatenate(keys, axis=1), np.concatenate(valid, axis=1)
    return [k[v] for k, v in zip(keys, valid)]


def link_fingerprints(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """Links ``(a, b)`` that connect all fingerprints ``fp`` at most ``max_bits`` <= 2 bits apart.

    ``prints`` holds distinct longs. A key whose group is small is joined; the pairs of
    a larger group are compared in tiles of bounded size, and a tile returns a spanning
    forest instead of its pairs. Both ways are exact.
    """
    if max_bits > 2:
        raise ValueError("the segments allow two bits at most")
    one = F.pandas_udf(lambda p: pd.Series(list(nearest_keys(p.to_numpy()))), "array<long>")
    all_ = F.pandas_udf(lambda p: pd.Series(near_keys(p.to_numpy())), "array<long>")
    near = materialise(prints.select("fp", F.explode(all_("fp")).alias("key")), "near-keys")
    first = materialise(prints.select("fp", F.explode(one("fp")).alias("key")), "nearest-keys")
    sizes = near.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    large = materialise(sizes.filter(F.col("n") > GROUP_ROWS), "large-keys")

    left = first.select("key", F.col("fp").alias("a")).join(large.select("key"), "key", "left_anti")
    right = near.select("key", F.col("fp").alias("b"))
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    small = left.join(right, "key").filter((F.col("a") != F.col("b")) & (apart <= max_bits)).select("a", "b")

    tiled = near.join(large, "key").withColumn("tiles", F.ceil(F.col("n") / F.lit(TILE_ROWS)).cast("int"))
    tiled = tiled.withColumn("t", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
    pairs = tiled.select("key", "fp", "t", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("o"))
    pairs = pairs.select("key", "fp", "t", F.least("t", "o").alias("lo"), F.greatest("t", "o").alias("hi"))

    def forest(key, tile: pd.DataFrame) -> pd.DataFrame:
        mine = tile["fp"][tile["t"] == key[1]].to_numpy()
        other = tile["fp"][tile["t"] == key[2]].to_numpy()
        return _forest(np.unique(mine), np.unique(other), max_bits)

    return small.unionByName(pairs.groupBy("key", "lo", "hi").applyInPandas(forest, "a long, b long"))


def _forest(left: np.ndarray, right: np.ndarray, max_bits: int) -> pd.DataFrame:
    """A spanning forest of the links between two lists of fingerprints."""
    prints = np.unique(np.concatenate([left, right]))
    x, y = np.searchsorted(prints, left), np.searchsorted(prints, right)
    root = np.arange(len(prints))
    heads, tails = [], []
    bits = prints.view(np.uint64)
    for at in range(0, len(x), 256):
        apart = np.bitwise_count(bits[x[at : at + 256], None] ^ bits[None, y])
        i, j = np.nonzero(apart <= max_bits)
        heads.append(x[at + i])
        tails.append(y[j])
    i, j = np.concatenate(heads or [x[:0]]), np.concatenate(tails or [x[:0]])
    while True:
        before = root.copy()
        np.minimum.at(root, i, root[j])
        np.minimum.at(root, j, root[i])
        root = root[root]
        if (root == before).all():
            break
    linked = root != np.arange(len(prints))
    return pd.DataFrame({"a": prints[linked], "b": prints[root[linked]]})


def simhash_groups(
    docs: DataFrame, words: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col, fp, component_id`` of every row.

    Rows link if their fingerprints differ in at most ``max_bits`` bits; the
    component id is the smallest id reachable, itself included. Null and empty texts
    have fingerprint zero and link like any other. Rows without id keep their group's
    smallest id, null if the group has none. Repeated rows stay; other columns do not
    matter; an empty table gives an empty result.

    Rows with one fingerprint are one node, found with partial aggregates, so a
    group of exact copies costs one row.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("i"), fingerprint(F.col(text_col), words).alias("fp"))
    rows = materialise(rows, "fingerprints")
    nodes = materialise(rows.groupBy("fp").agg(F.min("i").alias("low")), "nodes")
    roots = components(link_fingerprints(nodes.select("fp"), max_bits))
    members = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    members = members.select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = members.groupBy("root").agg(F.min("low").alias("component_id"))
    named = members.join(lowest, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(F.col("i").alias(id_col), "fp", "component_id")


def deduplicate(docs: DataFrame, words: int = 3, max_bits: int = 2) -> DataFrame:
    """One row of each SimHash group: the smallest ``doc_id``, nulls last, then the smallest row hash.

    All columns of ``docs`` are kept, whatever their names.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    small_batches(docs.sparkSession)
    whole = docs.select(
        F.struct(*columns).alias("row"), F.col("doc_id").alias("i"), fingerprint(F.col("text"), words).alias("fp")
    )
    marked = whole.withColumn("h", F.xxhash64("row"))
    slim = materialise(marked.select("i", "fp", "h"), "row-prints")
    nodes = materialise(slim.groupBy("fp").agg(F.min(F.struct(F.col("i").isNull().alias("none"), "i", "h")).alias("first")), "nodes")
    roots = components(link_fingerprints(nodes.select("fp"), max_bits))
    members = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    firsts = members.groupBy(F.coalesce("root", "fp")).agg(F.min("first").alias("first"))
    keep = firsts.select("first.i", "first.h")
    kept = docs.select(F.struct(*columns).alias("row"), F.col("doc_id").alias("i")).withColumn("h", F.xxhash64("row"))
    kept = kept.join(keep, kept["i"].eqNullSafe(keep["i"]) & (kept["h"] == keep["h"]), "left_semi")
    return kept.dropDuplicates(["i", "h"]).select("row.*")
