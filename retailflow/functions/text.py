"""Text expressions and the pluggable text map."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailflow.session import bound_batches

# Word pattern and prompt prefix.
WORD = r"[\p{L}\p{N}_]+"
PROMPT_PREFIX = "<2en> "


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(text) -> Column:
    """Lower-case words of a text, in order, as an array."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(f"({WORD})"), F.lit(1))


def split_words(df: DataFrame, text: str, keep: list[str] | None = None) -> DataFrame:
    """One row per word; null texts give no rows."""
    keep = keep or []
    return df.filter(F.col(text).isNotNull()).select(*keep, F.explode(words(text)).alias("word"))


def pg_initcap(text) -> Column:
    """Capitalise after every character that is neither letter nor digit."""
    runs = F.regexp_extract_all(
        F.lower(_col(text)), F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"), F.lit(1)
    )
    return F.array_join(F.transform(runs, F.initcap), "")


def normal_city(city) -> Column:
    """City name with one spelling of the largest city, capitalised."""
    city = _col(city)
    return pg_initcap(F.when(city == "são paulo", F.lit("sao paulo")).otherwise(city))


def is_number_text(text) -> Column:
    """True when a text parses as an integer (a sign of shifted columns)."""
    return _col(text).try_cast("int").isNotNull()


def prompt(text) -> Column:
    """Prefix for the translation model; null and empty texts stay as they are."""
    text = _col(text)
    return F.when(F.length(text) > 0, F.concat(F.lit(PROMPT_PREFIX), text)).otherwise(text)


def translate_columns(
    df: DataFrame,
    columns: list[str],
    translate: Callable[[list[str]], list[str]] | None = None,
    connect: Callable[[], Callable[[list[str]], list[str]]] | None = None,
    prefix: str | None = None,
    batch: int = 64,
) -> DataFrame:
    """Apply a text model to columns, in place or into ``prefix``-ed new columns.

    ``translate`` maps a list of prompts to a list of texts. ``connect`` builds
    one on the executor, once per partition, for clients that cannot be shipped.
    Null and empty texts are passed through without a call. Only the texts cross into
    Python; other columns stay as they are and are pruned when unused. They come in
    batches of bounded rows and bytes, so a worker's memory does not depend on the partition.
    """
    if (translate is None) == (connect is None):
        raise ValueError("give either translate or connect")
    bound_batches(df.sparkSession)
    targets = {c: f"{prefix}{c}" if prefix else c for c in columns}

    @F.pandas_udf(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        call = connect() if connect else translate
        for series in batches:
            out = {}
            # One column alone does not come as a tuple.
            for name, texts in zip(columns, series if isinstance(series, tuple) else (series,)):
                texts = texts.astype(object)
                todo = texts[texts.map(lambda t: isinstance(t, str) and t != "")]
                done: list[str] = []
                for at in range(0, len(todo), batch):
                    done += call([PROMPT_PREFIX + t for t in todo.iloc[at : at + batch]])
                texts.loc[todo.index] = done
                out[name] = texts
            yield pd.DataFrame(out)

    done = df.withColumn("__done", run(*[F.col(f"`{c}`") for c in columns]))
    names = df.columns + [t for t in targets.values() if t not in df.columns]
    source = {t: c for c, t in targets.items()}
    return done.select(
        *[F.col(f"__done.`{source[n]}`").alias(n) if n in source else F.col(f"`{n}`") for n in names]
    )
