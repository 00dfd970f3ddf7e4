"""Exact top-k search by distributed histogram selection.

Every query is scored against every row, but no score list is kept. A round
counts the scores of each query in equal steps of its current interval; the
summed counts say which step holds the kth best score, and the next round looks
into that step alone. When a step is one integer wide, the kth score is known;
a last pass keeps the rows at or above it and breaks ties by the smaller id.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailflow.llm.common import materialise
from retailflow.session import scratch_path

STEPS = 1024
BLOCK_ROWS = 2048
#: Queries of one pass. Their vectors and intervals are all that is broadcast.
PASS_QUERIES = 8192
PASS_BYTES = 64 * 1024 * 1024
#: Queries that are scored against a block at once, which bounds the score matrix.
SCORED_QUERIES = 256
#: Integers of this size are exact in double precision.
EXACT = 2.0**53


def usable_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(i, x)`` of every usable vector, as doubles.

    Vectors without id, null, empty, or with null or non-finite components take no
    part. Rows of equal id and vector count once; different vectors of an id all stay.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("i"), F.col(vector_col).cast("array<double>").alias("x")
    )
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    usable = F.col("i").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0) & F.coalesce(finite, F.lit(False))
    return rows.filter(usable).distinct()


def integer_vectors(usable: DataFrame, factor: int = 256) -> DataFrame:
    """``(i, x)``: floor(factor * component) of vectors that are not large."""
    return usable.select("i", F.transform("x", lambda v: F.floor(v * F.lit(float(factor))).cast("double")).alias("x"))


def _is_large(factor: int) -> Column:
    """Whether a vector's inner products may leave the integers that doubles hold."""
    square = F.aggregate("x", F.lit(0.0), lambda a, v: a + (v * F.lit(float(factor))) * (v * F.lit(float(factor))))
    return ~(square < F.lit(EXACT / 16))


def top_k(
    vectors: DataFrame,
    k: int = 5,
    every: int = 50,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    factor: int = 256,
    pass_queries: int = PASS_QUERIES,
) -> DataFrame:
    """The ``k`` best rows by integer inner product for each id divisible by ``every``.

    Returns ``query_id, rank, vec_id, score``: every row but those of the query's own id is a
    candidate, ties go to the smaller id, a query with fewer than ``k`` candidates
    gets all. An id with several vectors is scored with each, as candidate and as
    query, and a query's ``k`` rows are the best over all its vectors. See ``usable_vectors`` for rows that take no part; vectors of another
    length than the query's are not scored. Further columns do not matter. An empty table gives an empty result.

    Vectors too long for exact products in double precision stand in blocks of their own and are scored
    with Python integers; a score beyond a long counts as the last long on its side.

    The candidate blocks never move: a pass broadcasts at most ``pass_queries``
    queries (and ``PASS_BYTES``) and reads the blocks once per round. A block sends
    back at most ``k`` counts, and in the end at most ``k`` rows above and ``k`` rows
    level with the kth score, for each query. Every pass appends its result to one stored
    table, so the plan stays the same however many passes there are; a last ranking joins
    the vectors of a query.
    """
    spark = vectors.sparkSession
    usable = usable_vectors(vectors, id_col, vector_col)
    keyed = integer_vectors(usable.filter(~_is_large(factor)), factor).withColumn("row", F.monotonically_increasing_id())
    whole = materialise(keyed, "integers")
    blocks = materialise(
        whole.select("i", "x").mapInPandas(pack, "ids binary, values binary, d int, longest double"), "blocks"
    )
    done = scratch_path(spark, "llm-top-k")
    schema = "query_id long, vec_id long, score long"
    spark.createDataFrame([], schema).write.parquet(done)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def run(table: DataFrame, against: DataFrame, search: Callable) -> None:
        """Search the queries of ``table`` in blocks, one length of vectors after the other."""
        queries = table.filter(F.pmod("i", F.lit(every)) == 0)
        bounds = against.groupBy("d").agg(F.max("longest").alias("longest")).collect()
        for d, top in sorted((r["d"], r["longest"]) for r in bounds):
            same = queries.filter(F.size("x") == d)
            per_pass = max(1, min(pass_queries, PASS_BYTES // (8 * d)))
            passes = -(-same.count() // per_pass)
            # A pass takes the rows of one hash class, cut again should the class be uneven.
            for p in range(passes):
                mine = same.filter(F.pmod(F.xxhash64("row"), F.lit(passes)) == p)
                for ids, values in _query_groups(mine, per_pass):
                    near = search(against.filter(F.col("d") == d), ids, values, top)
                    best = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
                    best.select("query_id", "vec_id", "score").write.mode("append").parquet(done)

    run(whole, blocks, lambda part, ids, values, top: _search(spark, part, ids, values, top, k))
    large = usable.filter(_is_large(factor)).withColumn("row", F.monotonically_increasing_id())
    large = materialise(large, "large-vectors")
    if not large.isEmpty():
        own = materialise(large.select("i", "x").mapInPandas(pack, "ids binary, values binary, d int, longest double"), "large-blocks")
        for table, by in ((whole, 1), (large, factor)):
            for against, times in ((blocks, 1), (own, factor)):
                if table is large or against is own:
                    run(table, against, lambda part, ids, values, _, by=by, times=times: _search_large(spark, part, ids, values, times, by, k))
    ranked = spark.read.schema(schema).parquet(done).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of a task as blocks of at most ``BLOCK_ROWS`` vectors of one length, sorted by id."""
    waiting: dict[int, list] = {}

    def block(rows: list, d: int) -> pd.DataFrame:
        rows.sort(key=lambda r: r[0])
        ids = np.array([r[0] for r in rows], dtype=np.int64)
        values = np.stack([r[1] for r in rows]).astype(np.float64)
        length = float(np.sqrt((values**2).sum(axis=1)).max())
        return pd.DataFrame([{"ids": ids.tobytes(), "values": values.tobytes(), "d": d, "longest": length}])

    for batch in batches:
        for i, x in zip(batch["i"], batch["x"]):
            rows = waiting.setdefault(len(x), [])
            rows.append((i, x))
            if len(rows) == BLOCK_ROWS:
                yield block(waiting.pop(len(x)), len(x))
    for d, rows in waiting.items():
        yield block(rows, d)


def _query_groups(queries: DataFrame, per_pass: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Vectors of one hash class, in groups of at most ``per_pass``."""
    after = None
    while True:
        rest = queries if after is None else queries.filter(F.col("row") > after)
        rows = rest.orderBy("row").limit(per_pass).collect()
        if not rows:
            return
        yield np.array([r["i"] for r in rows], dtype=np.int64), np.array([r["x"] for r in rows])
        if len(rows) < per_pass:
            return
        after = rows[-1]["row"]


def _search(spark, blocks: DataFrame, ids: np.ndarray, values: np.ndarray, longest: float, k: int) -> DataFrame:
    """Rows at or above the kth score of each query, ties cut to ``k`` per block."""
    lengths = np.sqrt((values**2).sum(axis=1))
    if float(lengths.max()) * longest >= EXACT / 4:
        raise ValueError("inner products beyond 2**51 are not exact in double precision")
    reach = np.ceil(lengths * longest).astype(np.int64) + 1
    state = {
        "low": -reach,
        "high": reach + 1,
        "width": -(-(2 * reach + 1) // STEPS),
        "need": np.full(len(ids), k),
        "all": np.zeros(len(ids), dtype=bool),
    }
    fixed = spark.sparkContext.broadcast((ids, values))
    while True:
        sent = spark.sparkContext.broadcast(state)

        def count(batches, sent=sent):
            for batch in batches:
                for _, part, scores in score_blocks(batch, *fixed.value):
                    yield histogram(scores, part, sent.value)

        parts = blocks.mapInPandas(count, "q int, step int, n long")
        counts = parts.groupBy("q", "step").agg(F.sum("n").alias("n")).toPandas()
        state = refine(state, counts)
        if (state["width"] == 0).all():
            break
    kth = spark.sparkContext.broadcast(state)

    def select(batches):
        for batch in batches:
            for own, part, scores in score_blocks(batch, *fixed.value):
                yield at_or_above(scores, own, fixed.value[0], part, kth.value, k)

    return blocks.mapInPandas(select, "query_id long, vec_id long, score long")


def whole_numbers(values: np.ndarray, factor: int) -> np.ndarray:
    """floor(factor * component) as Python integers, exact for every finite double."""
    exact = [[int(v) * factor if abs(v) >= EXACT else math.floor(v * factor) for v in row] for row in values.tolist()]
    return np.array(exact, dtype=object).reshape(values.shape)


def _search_large(spark, blocks: DataFrame, ids: np.ndarray, values: np.ndarray, times: int, by: int, k: int) -> DataFrame:
    """The ``k`` best rows of each block for each query, scored with Python integers.

    ``times`` is the factor still to be applied to the rows of the blocks, ``by`` that of the queries.
    """
    fixed = spark.sparkContext.broadcast((ids, values))
    first, last = np.iinfo(np.int64).min, np.iinfo(np.int64).max

    def select(batches):
        queries = whole_numbers(fixed.value[1], by)
        for batch in batches:
            for own, packed, d in zip(batch["ids"], batch["values"], batch["d"]):
                own = np.frombuffer(own, dtype=np.int64).tolist()
                rows = whole_numbers(np.frombuffer(packed).reshape(-1, d), times)
                found = []
                for q, query in zip(fixed.value[0].tolist(), queries):
                    scores = [min(last, max(first, s)) for s in rows.dot(query)]
                    others = ((-s, i) for s, i in zip(scores, own) if i != q)
                    found += [(q, i, -s) for s, i in heapq.nsmallest(k, others)]
                yield pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    return blocks.mapInPandas(select, "query_id long, vec_id long, score long")


def score_blocks(
    batch: pd.DataFrame, ids: np.ndarray, values: np.ndarray
) -> Iterator[tuple[np.ndarray, slice, np.ndarray]]:
    """Ids, a slice of the queries, and scores (query by row) of every block.

    Rows of a query's own id score lowest.
    """
    for own, packed, d in zip(batch["ids"], batch["values"], batch["d"]):
        own = np.frombuffer(own, dtype=np.int64)
        rows = np.frombuffer(packed).reshape(-1, d).T
        at, end = np.searchsorted(own, ids), np.searchsorted(own, ids, side="right")
        for first in range(0, len(ids), SCORED_QUERIES):
            part = slice(first, first + SCORED_QUERIES)
            scores = np.rint(values[part] @ rows).astype(np.int64)
            for q in np.nonzero(at[part] < end[part])[0]:
                scores[q, at[part][q] : end[part][q]] = np.iinfo(np.int64).min
            yield own, part, scores


def histogram(scores: np.ndarray, part: slice, state: dict) -> pd.DataFrame:
    """Counts of one block per query and step, highest steps first, until enough are counted.

    Lower steps cannot hold the kth score, as this block alone has enough above them.
    """
    all_low, all_high, all_width, all_need = (state[c][part] for c in ("low", "high", "width", "need"))
    open_ = np.nonzero(all_width > 0)[0]
    low, width = all_low[open_, None], all_width[open_, None]
    inside = (scores[open_] >= low) & (scores[open_] < all_high[open_, None])
    row, col = np.nonzero(inside)
    step = (scores[open_[row], col] - low[row, 0]) // width[row, 0]
    counts = np.bincount(row * STEPS + step, minlength=len(open_) * STEPS).reshape(len(open_), STEPS)
    above = counts[:, ::-1].cumsum(axis=1)[:, ::-1] - counts
    q, s = np.nonzero((counts > 0) & (above < all_need[open_, None]))
    at = open_[q] + part.start
    return pd.DataFrame({"q": at.astype("int32"), "step": s.astype("int32"), "n": counts[q, s]})


def refine(state: dict, counts: pd.DataFrame) -> dict:
    """Move each query into the step of its kth score; width 0 says that it is found.

    A query with fewer candidates than it needs keeps all of them.
    """
    low, high, width, need, all_ = (state[c].copy() for c in ("low", "high", "width", "need", "all"))
    seen = np.zeros(len(low), dtype=bool)
    for q, own in counts.groupby("q"):
        own = own.sort_values("step", ascending=False)
        total = own["n"].cumsum().to_numpy()
        at = int(np.searchsorted(total, need[q]))
        seen[q] = True
        if at == len(total):
            all_[q], width[q] = True, 0
            continue
        need[q] -= total[at - 1] if at else 0
        low[q] += int(own["step"].iloc[at]) * width[q]
        high[q] = min(high[q], low[q] + width[q])
        width[q] = 0 if width[q] == 1 else -(-width[q] // STEPS)
    missing = ~seen & (width > 0)
    all_[missing], width[missing] = True, 0
    return {"low": low, "high": high, "width": width, "need": need, "all": all_}


def at_or_above(
    scores: np.ndarray, own: np.ndarray, ids: np.ndarray, part: slice, state: dict, k: int
) -> pd.DataFrame:
    """Rows above the kth score, and the ``k`` smallest ids level with it."""
    lowest = np.iinfo(np.int64).min
    least = np.where(state["all"][part], lowest + 1, state["low"][part])[:, None]
    level = scores == least
    chosen = (scores > least) | (level & (level.cumsum(axis=1) <= k))
    q, c = np.nonzero(chosen)
    return pd.DataFrame({"query_id": ids[part][q], "vec_id": own[c], "score": scores[q, c]})
