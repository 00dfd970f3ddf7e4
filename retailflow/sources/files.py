"""File sources: CSV, Parquet, JSON documents, schema crawl."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailflow.model import LINE_BREAKS, TABLES

# CSV dialect of every landing file: quotes are doubled inside quoted text.
CSV_DIALECT = {"quote": '"', "escape": '"'}
NULL_MARK = "\u0000"


def read_csv_table(
    spark: SparkSession,
    path: str | list[str],
    schema: str | T.StructType | None = None,
    header: bool = True,
    infer: bool = False,
    multiline: bool = True,
    compat: bool = False,
) -> DataFrame:
    """A CSV table of one or many files.

    With a header, columns are bound by name in every file: the first lines are read
    first, and files with the same header form one scan. A column that a file lacks is null
    there. ``multiline`` keeps records with line breaks whole, at the price of one task
    per file. ``compat`` binds by position and breaks records at line ends. An empty field
    is null, two quotes are an empty text. Without a schema the columns are those of all
    headers and text, unless ``infer`` is set, which finds the types per header.
    """
    reader = spark.read.options(**CSV_DIALECT).option("header", header)
    reader = reader.option("multiLine", multiline and not compat)
    # The null mark stands for fields with nothing between the commas.
    reader = reader if compat else reader.option("nullValue", NULL_MARK)
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if compat or not header:
        return reader.schema(wanted).csv(path) if wanted else reader.option("inferSchema", infer).csv(path)
    parts = [_bound(reader, where, names, wanted, infer) for names, where in _by_header(spark, reader, path)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _by_header(spark: SparkSession, reader, path: str | list[str]) -> list[tuple[list[str], str | list[str]]]:
    """The distinct headers with the files that have them; one header keeps the path as it is."""
    found = reader.option("inferSchema", False).csv(path)
    groups: dict[tuple, list[str]] = {}
    files = sorted(found.inputFiles())
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    java = spark._jvm.java.io

    def first_line(file: str) -> tuple:
        place = hadoop.fs.Path(spark._jvm.java.net.URI(file))
        stream = place.getFileSystem(conf).open(place)
        codec = hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
        lines = java.BufferedReader(java.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
        try:
            return tuple(next(csv.reader([lines.readLine() or ""]), []))
        finally:
            lines.close()

    with ThreadPoolExecutor(max_workers=16) as pool:
        for file, names in zip(files, pool.map(first_line, files)):
            groups.setdefault(names, []).append(_glob_free(unquote(file)))
    groups.pop((), None)
    if len(groups) <= 1:
        return [(found.columns, path)]
    return [(list(names), where) for names, where in sorted(groups.items())]


def _glob_free(path: str) -> str:
    return "".join(f"\\{c}" if c in "[]{}*?" else c for c in path)


def _bound(reader, path: str | list[str], names: list[str], wanted: T.StructType | None, infer: bool) -> DataFrame:
    """Files of one header, with the wanted columns by name."""
    if wanted is None:
        return reader.option("inferSchema", infer).csv(path)
    by_name = {f.name: f for f in wanted.fields}
    in_file = T.StructType([by_name.get(c, T.StructField(c, T.StringType())) for c in names])
    df = reader.schema(in_file).csv(path)
    return df.select(
        *[
            F.col(f.name) if f.name in names else F.lit(None).cast(f.dataType).alias(f.name)
            for f in wanted.fields
        ]
    )


def read_csv_checked(
    spark: SparkSession, path: str | list[str], schema: str | T.StructType, policy: str = "reject", multiline: bool = True
) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejects)`` of CSV files with headers: malformed records are told apart from rows.

    A record is malformed if it has more or fewer fields than its header, or a field that its
    column's type cannot hold. ``rejects`` has one row for each: ``file, reason, record``; the
    reason is ``fields`` or ``type: <columns>``. ``policy`` says what becomes of them in
    ``rows``: ``reject`` leaves them out, ``null`` keeps them with null for what cannot be read, ``raise``
    stops the read at the first. Columns are bound by name in every file.
    """
    if policy not in ("reject", "null", "raise"):
        raise ValueError("policy must be reject, null or raise")
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    reader = spark.read.options(**CSV_DIALECT).option("header", True).option("multiLine", multiline)
    # All fields are parsed as text, none pruned: only then does the parser count them.
    reader = reader.options(nullValue=NULL_MARK, mode="PERMISSIVE", columnPruning=False, columnNameOfCorruptRecord=BROKEN)
    parts = [_checked(reader, where, names, wanted) for names, where in _by_header(spark, reader, path)]
    marked = reduce(DataFrame.unionByName, parts)
    rejects = marked.filter(F.col(REASON).isNotNull()).select("__file", REASON, "__record")
    rejects = rejects.toDF("file", "reason", "record")
    if policy == "reject":
        marked = marked.filter(F.col(REASON).isNull())
    rows = marked.select(*wanted.names)
    if policy == "raise":
        problem = F.concat(F.lit("malformed record ("), F.col(REASON), F.lit("): "), F.col("__record"))
        rows = marked.filter(F.coalesce(F.assert_true(F.col(REASON).isNull(), problem).isNull(), F.lit(True))).select(*wanted.names)
    return rows, rejects


BROKEN, REASON = "__broken", "__reason"


def _checked(reader, path: str | list[str], names: list[str], wanted: T.StructType) -> DataFrame:
    """Files of one header: wanted columns by name, file, reason of rejection and raw record."""
    texts = T.StructType([T.StructField(c, T.StringType()) for c in [*names, BROKEN]])
    df = reader.schema(texts).csv(path)
    typed = [f for f in wanted.fields if f.name in names and not isinstance(f.dataType, T.StringType)]
    wrong = F.array_compact(
        F.array(
            *[
                F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f.name))
                for f in typed
            ],
            F.lit(None).cast("string"),
        )
    )
    reason = F.when(F.col(BROKEN).isNotNull(), F.lit("fields")).when(
        F.size(wrong) > 0, F.concat(F.lit("type: "), F.array_join(wrong, ", "))
    )
    record = F.coalesce(F.col(BROKEN), F.to_csv(F.struct(*names), {"nullValue": "", **CSV_DIALECT}))
    by_name = {f.name: f.dataType for f in wanted.fields}
    values = [F.col(c).try_cast(kind) if c in names else F.lit(None).cast(kind) for c, kind in by_name.items()]
    return df.select(
        *[v.alias(c) for c, v in zip(by_name, values)],
        F.col("_metadata.file_path").alias("__file"),
        reason.alias(REASON),
        record.alias("__record"),
    )


def landing_path(root: str, table: str, day: str | None = None) -> str:
    name = f"{table}.{day.strip()}" if day else table
    return f"{root}/landing/{table}/{name}.csv"


def read_landing(spark: SparkSession, root: str, table: str, day: str | None = None) -> DataFrame:
    """The landing CSV of one table and day, with the table's schema."""
    return read_csv_table(
        spark, landing_path(root, table, day), TABLES[table].ddl, multiline=table in LINE_BREAKS
    )


def read_text_stack(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Many CSV files as one frame of text columns, bound by name."""
    return read_csv_table(spark, paths, infer=False)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_documents(
    spark: SparkSession,
    schema: str,
    path: str | None = None,
    connection: dict[str, str] | None = None,
    drop_id: bool = True,
) -> DataFrame:
    """A collection of flat documents.

    From JSON files, or with ``connection`` options through the document-store
    connector when its jar is on the classpath.
    """
    if connection is not None:
        df = spark.read.format("mongodb").options(**connection).schema(schema).load()
    else:
        df = spark.read.schema(schema).json(path)
    return df.drop("_id") if drop_id else df


def crawl_schema(spark: SparkSession, path: str, fmt: str = "csv", sample: float = 1.0) -> DataFrame:
    """Inferred columns of the files at ``path``: position, name, type.

    ``sample`` is the share of rows that the inference reads (CSV and JSON).
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.options(**CSV_DIALECT).option("header", True).option("inferSchema", True)
    if fmt in ("csv", "json"):
        reader = reader.option("samplingRatio", sample)
    fields = reader.load(path).schema.fields
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(fields)]
    return spark.createDataFrame(rows, "position int, column_name string, data_type string")


def crawl_ddl(spark: SparkSession, path: str, name: str, fmt: str = "csv", sample: float = 1.0) -> str:
    """CREATE TABLE text for the files at ``path``."""
    rows = crawl_schema(spark, path, fmt, sample).orderBy("position").collect()
    columns = ",\n  ".join(f"`{r['column_name']}` {r['data_type']}" for r in rows)
    options = ", ".join(f"'{k}' = '{v}'" for k, v in {"header": "true", **CSV_DIALECT}.items())
    how = f"{fmt} OPTIONS ({options})" if fmt == "csv" else fmt
    return f"CREATE TABLE IF NOT EXISTS {name} (\n  {columns}\n) USING {how} LOCATION '{path}'"


def sequence_source(spark: SparkSession, n: int, length: int = 10) -> DataFrame:
    """Rows 1..n with a pseudo-random text of ``length`` hex digits."""
    ids = spark.range(1, n + 1)
    return ids.withColumn("data", F.substring(F.sha2(F.col("id").cast("string"), 256), 1, length))
