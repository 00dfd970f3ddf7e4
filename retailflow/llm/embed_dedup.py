"""Near-duplicate embeddings: Int8 tile products with rigorous error bounds.

Vectors of one label are cut into tiles. A tile pair is first multiplied in
Int8; the quantisation error of every vector is known exactly, so every product
comes with a bound on its error. Only pairs whose product plus bound reaches the
threshold are computed again, in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailflow.llm.common import materialise
from retailflow.llm.graph import components

TILE_ROWS = 2048
#: Allowance for the rounding of double precision sums and of float32 sums of small integers.
SLACK = 1e-9


def link_embeddings(
    vectors: DataFrame,
    threshold: float = 0.98,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """Links, components and representatives of vectors with cosine >= ``threshold``.

    One row per input row: ``id_col``, ``n_links`` (other rows linked directly),
    ``component_id`` (smallest id reachable, itself included), ``kept``
    (id = component_id). Other columns of the input do not matter.

    - Only rows with equal, non-null labels and equally many components are compared.
    - A vector that is null, empty, zero or has null or non-finite components, and a row
      without label or id, links with nothing (component_id is its own id, kept is
      false where the id is null).
    - Exact copies are folded into one class first, with partial aggregates, so a vector
      that makes up a third of the table costs as much as one; repeated rows count as
      links of each other.
    - Rows that share an id but not label and vector are rows of their own: each has its own links
      and component, and a shared id links nothing.
    - An empty table gives an empty result.

    Work is quadratic in the number of distinct vectors of a label, which is what
    comparing all of them means; each task holds two tiles of ``tile_rows`` vectors. A
    tile pair returns a count per vector and a spanning forest, never its pairs.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("i"),
        F.col(label_col).alias("g"),
        F.col(vector_col).cast("array<double>").alias("x"),
    )
    sound = F.col("x").isNotNull() & (F.size("x") > 0) & F.col("i").isNotNull() & F.col("g").isNotNull()
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    usable = sound & F.coalesce(finite, F.lit(False)) & F.exists("x", lambda v: v != 0)
    rows = rows.withColumn("ok", F.coalesce(usable, F.lit(False)))
    usable_rows = rows.filter("ok").select("i", "g", "x")

    grouped = usable_rows.groupBy("g", "x").agg(F.min("i").alias("rep"), F.count(F.lit(1)).alias("n"))
    # Classes of one id differ in their key, which is stored so that it stays.
    classes = materialise(grouped.withColumn("c", F.monotonically_increasing_id()), "classes")
    sizes = classes.groupBy("g", F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("m"))
    tiled = classes.withColumn("d", F.size("x")).join(sizes, ["g", "d"])
    tiles = F.ceil(F.col("m") / F.lit(tile_rows)).cast("int")
    tiled = tiled.withColumn("tiles", tiles).withColumn("t", F.pmod(F.xxhash64("c"), F.col("tiles")).cast("int"))
    pairs = tiled.select(
        "g", "d", "t", "rep", "c", "n", "x", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("o")
    )
    pairs = pairs.select(
        "g", "d", "t", "rep", "c", "n", "x", F.least("t", "o").alias("lo"), F.greatest("t", "o").alias("hi")
    )

    def compare(key, tile: pd.DataFrame) -> pd.DataFrame:
        return compare_tiles(tile, int(key[2]), int(key[3]), threshold)

    found = pairs.groupBy("g", "d", "lo", "hi").applyInPandas(compare, "rep long, c long, links long, low long, low_c long")
    found = materialise(found, "tile-links")
    totals = found.groupBy("c").agg(F.sum("links").alias("links"))
    node = F.struct(F.col("rep").alias("i"), "c").alias("node")
    low = F.struct(F.col("low").alias("i"), F.col("low_c").alias("c")).alias("low")
    roots = components(found.filter("low_c <> c").select(node, low))
    roots = roots.select(F.col("node.c").alias("c"), F.col("root.i").alias("root"))

    summary = classes.select("g", "x", "rep", "c", "n").join(totals, "c", "left")
    summary = summary.join(roots, "c", "left").select(
        "g",
        "x",
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("root", "rep").alias("component_id"),
    )
    linked = usable_rows.join(summary, ["g", "x"]).select("i", "n_links", "component_id")
    alone = rows.filter(~F.col("ok")).select(
        "i", F.lit(0).cast("long").alias("n_links"), F.col("i").alias("component_id")
    )
    out = linked.unionByName(alone)
    return out.select(
        F.col("i").alias(id_col),
        "n_links",
        "component_id",
        F.coalesce(F.col("i") == F.col("component_id"), F.lit(False)).alias("kept"),
    )


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Int8 codes, scale, length of the coded vector and length of its error, per row."""
    scale = np.abs(x).max(axis=1) / 127.0
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    coded = codes * scale[:, None]
    return codes, scale, np.linalg.norm(coded, axis=1), np.linalg.norm(x - coded, axis=1)


def int8_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of Int8 rows; float32 sums of 1024 terms below 2**14 are exact."""
    total = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], 1024):
        total += a[:, at : at + 1024].astype(np.float32) @ b[:, at : at + 1024].astype(np.float32).T
    return total


def close_pairs(x: np.ndarray, y: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of ``x`` and ``y`` with cosine >= threshold, in blocks of rows of ``x``."""
    unit = [v / np.abs(v).max(axis=1, keepdims=True) for v in (x, y)]
    unit = [v / np.linalg.norm(v, axis=1, keepdims=True) for v in unit]
    (qa, sa, la, ea), (qb, sb, lb, eb) = quantise(unit[0]), quantise(unit[1])
    for at in range(0, len(x), 512):
        part = slice(at, at + 512)
        product = int8_products(qa[part], qb) * sa[part, None] * sb[None, :]
        bound = la[part, None] * eb[None, :] + ea[part, None] * (lb + eb)[None, :]
        i, j = np.nonzero(product + bound >= threshold - SLACK)
        keep = np.empty(len(i), dtype=bool)
        for k in range(0, len(i), 65536):
            some = slice(k, k + 65536)
            keep[some] = np.einsum("ij,ij->i", unit[0][at + i[some]], unit[1][j[some]]) >= threshold
        yield at + i[keep], j[keep]


def compare_tiles(tile: pd.DataFrame, lo: int, hi: int, threshold: float) -> pd.DataFrame:
    """Links of each vector across one tile pair, and a forest that spans them."""
    left = tile[tile["t"] == lo].sort_values(["rep", "c"])
    right = left if lo == hi else tile[tile["t"] == hi].sort_values(["rep", "c"])
    if left.empty or right.empty:
        return pd.DataFrame({"rep": [], "c": [], "links": [], "low": [], "low_c": []}).astype("int64")
    x = np.stack(left["x"].to_numpy()).astype(np.float64)
    y = x if lo == hi else np.stack(right["x"].to_numpy()).astype(np.float64)
    both = left if lo == hi else pd.concat([left, right])
    ids, keys, weight = (both[name].to_numpy() for name in ("rep", "c", "n"))
    shift = len(left) if lo != hi else 0
    links = np.zeros(len(ids), dtype=np.int64)
    heads, tails = [], []
    order = np.argsort(np.lexsort((keys, ids)), kind="stable")  # small place, small id, small key
    place = order.copy()
    for i, j in close_pairs(x, y, threshold):
        if lo == hi:
            apart = i != j
            i, j = i[apart], j[apart]
            np.add.at(links, i, weight[j])
        else:
            j = j + shift
            np.add.at(links, i, weight[j])
            np.add.at(links, j, weight[i])
        np.minimum.at(place, i, order[j])
        np.minimum.at(place, j, order[i])
        heads.append(i)
        tails.append(j)
    sorted_ = np.empty(len(ids), dtype=np.int64)
    sorted_[order] = np.arange(len(ids))
    low = sorted_[_settle(place, order, heads, tails)]
    out = pd.DataFrame({"rep": ids, "c": keys, "links": links, "low": ids[low], "low_c": keys[low]})
    return out[out["links"] > 0]


def _settle(place: np.ndarray, order: np.ndarray, heads: list, tails: list) -> np.ndarray:
    """Smallest place that each vector of the tile pair reaches by its links."""
    i, j = (np.concatenate(v) if v else np.empty(0, dtype=np.int64) for v in (heads, tails))
    where = np.empty(len(order), dtype=np.int64)
    where[order] = np.arange(len(order))
    while True:
        before = place.copy()
        np.minimum.at(place, i, place[j])
        np.minimum.at(place, j, place[i])
        place = np.minimum(place, place[where[place]])
        if (place == before).all():
            return place
