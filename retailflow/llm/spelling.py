"""Spelling variants: words one edit apart, found by asymmetric q-chunks.

Of two words one edit apart, the shorter (of equal ones the smaller) gives two disjoint
chunks of half its length, one at each end; the other gives its positional grams of that
length. One edit touches one chunk at most, so the other stands in the longer word, at its
place or one further. Both sides meet on the length of the shorter word, the place
and the letters; the join verifies the edit distance.

A chunk that very many words share is refined: without the chunk, the rests are again one
edit apart, so they meet on a chunk of the rest as well. No pair is lost by it.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailflow.llm.common import materialise, small_batches

MIN_LETTERS = 5
MIN_COUNT = 3
#: Words with one gram at one place beyond which the gram's chunk is refined.
HOT_WORDS = 256


def run_counts(docs: DataFrame, drop_every: int | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n`` of all letter runs of at least five letters, A-Z lowered.

    With ``drop_every`` a run whose crc32 of ``<id>:<run>`` it divides loses the letter at that
    crc32 modulo its length, before the length is looked at. Runs of a batch of documents are
    counted in the task, so that a frequent word is one row of each batch.
    """
    small_batches(docs.sparkSession)
    letters = re.compile(f"[a-zÀ-ÿ]{{{MIN_LETTERS},}}")
    rows = docs.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t")).filter(F.col("t").isNotNull())

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: Counter[str] = Counter()
            for i, text in zip(batch["i"], batch["t"]):
                # bytes.lower lowers A-Z only.
                runs = letters.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))
                if drop_every and isinstance(i, str):
                    seed = zlib.crc32(f"{i}:".encode())
                    runs = [
                        w if (h := zlib.crc32(w.encode(), seed)) % drop_every else w[: h % len(w)] + w[h % len(w) + 1 :]
                        for w in runs
                    ]
                found.update(runs)
            words = [w for w in found if len(w) >= MIN_LETTERS]
            yield pd.DataFrame({"word": words, "n": [found[w] for w in words]}).astype({"word": object, "n": "int64"})

    return rows.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _chunk_keys(word: Column, size: Column) -> Column:
    """Place and letters of the two chunks of a word of ``size`` letters, also one place further."""
    q = F.floor(size / 2).cast("int")

    def at(place: Column, shift: int) -> Column:
        return F.struct((place + shift).alias("at"), F.substring(word, place + 1, q).alias("gram"))

    return F.array(*[at(place, shift) for place in (F.lit(0), size - q) for shift in (0, 1)])


def _gram_keys(word: Column, size: Column) -> Column:
    """Place and letters of the grams of a word that can meet a chunk of a word of ``size`` letters."""
    q = F.floor(size / 2).cast("int")
    places = F.array_distinct(F.array(F.lit(0), F.lit(1), size - q, size - q + 1))
    inside = F.filter(places, lambda p: p + q <= F.length(word))
    return F.transform(inside, lambda p: F.struct(p.alias("at"), F.substring(word, p + 1, q).alias("gram")))


def _rest(word: Column, at: Column, gram: Column) -> Column:
    return F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + F.length(gram) + 1, F.length(word)))


def near_pairs(words: DataFrame, hot_words: int = HOT_WORDS) -> DataFrame:
    """Pairs ``a, n_a, b, n_b`` of words exactly one edit apart, each once, ``a`` the shorter or smaller.

    ``words`` holds distinct ``word, n``; it is read more than once: pass a stored table.
    Words of at least four letters can meet.
    """
    sized = words.withColumn("size", F.length("word"))
    key = ["size", "at", "gram"]
    short = sized.select(F.col("word").alias("a"), F.col("n").alias("n_a"), "size", F.explode(_chunk_keys(F.col("word"), F.col("size"))).alias("k"))
    chunks = short.select("a", "n_a", "size", (F.col("k.at")).alias("at"), F.col("k.gram").alias("gram"))
    long = sized.select(F.col("word").alias("b"), F.col("n").alias("n_b"), F.explode(F.array(F.col("size"), F.col("size") - 1)).alias("size"))
    grams = long.select("b", "n_b", "size", F.explode(_gram_keys(F.col("b"), F.col("size"))).alias("k"))
    grams = grams.select("b", "n_b", "size", F.col("k.at").alias("at"), F.col("k.gram").alias("gram"))

    often = grams.groupBy(key).agg(F.count(F.lit(1)).alias("members")).filter(F.col("members") > hot_words).select(key)
    often = materialise(often, "often-grams")
    later = (F.col("size") < F.length("b")) | (F.col("a") < F.col("b"))
    near = later & (F.levenshtein("a", "b", 1) == 1)

    rare = chunks.join(often, key, "left_anti").join(grams, key).filter(near)
    # Shifted by one, a chunk's place in the short word is one before the key's place.
    own = F.when(F.substring("a", F.col("at") + 1, F.length("gram")) == F.col("gram"), F.col("at")).otherwise(F.col("at") - 1)
    first = chunks.join(often, key, "left_semi").withColumn("rest", _rest(F.col("a"), own, F.col("gram")))
    first = first.withColumn("left", F.length("rest")).withColumn("k", F.explode(_chunk_keys(F.col("rest"), F.col("left"))))
    first = first.select("a", "n_a", *key, "left", F.col("k.at").alias("at2"), F.col("k.gram").alias("gram2"))
    second = grams.join(often, key, "left_semi").withColumn("rest", _rest(F.col("b"), F.col("at"), F.col("gram")))
    second = second.withColumn("left", F.col("size") - F.floor(F.col("size") / 2).cast("int"))
    second = second.withColumn("k", F.explode(_gram_keys(F.col("rest"), F.col("left"))))
    second = second.select("b", "n_b", *key, "left", F.col("k.at").alias("at2"), F.col("k.gram").alias("gram2"))
    refined = first.join(second, [*key, "left", "at2", "gram2"]).filter(near)

    columns = ["a", "n_a", "b", "n_b"]
    return rare.select(columns).unionByName(refined.select(columns)).distinct()


def roots(links: DataFrame) -> DataFrame:
    """``word, root`` for each ``word, form``: the last word that forms lead to.

    Every round doubles the step, so rounds grow with the logarithm of the longest chain;
    only whether a step moved reaches the driver. Forms must not go in circles.
    """
    steps = links.select("word", F.col("form").alias("root"))
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = steps.join(ahead, "root", "left")
        steps = steps.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        steps = materialise(steps, "roots")
        if steps.filter("moved").isEmpty():
            return steps.select("word", "root")
        steps = steps.drop("moved")


def variant_groups(
    docs: DataFrame,
    drop_every: int | None = None,
    least_count: int = MIN_COUNT,
    factor: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word with at least ``least_count`` occurrences.

    Words are letter runs of at least five letters (see ``run_counts``). A word's form is the word
    one edit away with the largest count, ties to the smallest in code-point order, if that
    count is at least ``factor`` >= 2 times the word's own; ``root`` is where forms end, the word itself
    if it has none.

    Null and empty texts hold no words; texts of any length are taken whole; a null id drops no
    letter; repeated rows count as often as they occur; other columns do not matter; an empty
    table gives an empty result.
    """
    if factor < 2:
        raise ValueError("forms would go in circles")
    counted = run_counts(docs, drop_every, id_col, text_col).filter(F.col("n") >= least_count)
    words = materialise(counted, "words")
    pairs = materialise(near_pairs(words), "near-words")
    one = pairs.select(F.col("a").alias("word"), F.col("n_a").alias("n"), F.col("b").alias("other"), F.col("n_b").alias("m"))
    two = pairs.select(F.col("b").alias("word"), F.col("n_b").alias("n"), F.col("a").alias("other"), F.col("n_a").alias("m"))
    best = one.unionByName(two).groupBy("word", "n").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best")
    )
    form = F.when(-F.col("best.m") >= factor * F.col("n"), F.col("best.other"))
    best = best.select("word", "n_near", form.alias("form"), F.when(form.isNotNull(), -F.col("best.m")).alias("form_n"))
    best = materialise(best, "forms")
    ends = roots(best.filter(F.col("form").isNotNull()))
    named = words.join(best, "word", "left").join(ends, "word", "left")
    return named.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root")
    )
