"""Landing files: one CSV dataset per table and day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailflow.model import LINE_BREAKS
from retailflow.session import row_bytes
from retailflow.sources.files import CSV_DIALECT, landing_path

ROWS_PER_FILE = 1_000_000
#: Advisory size of a file whose records span lines, which a reader takes whole.
WHOLE_FILE_BYTES = 64 * 1024 * 1024


def write_csv(
    df: DataFrame, path: str, header: bool = True, mode: str = "overwrite", line_breaks: bool = False
) -> None:
    """CSV that keeps texts as they are; null is an empty field, an empty text two quotes.

    ``line_breaks`` says that texts may span lines. A reader then takes a file whole, so
    files are cut at about ``WHOLE_FILE_BYTES``, by the bytes of an average row.
    """
    rows_per_file = ROWS_PER_FILE
    if line_breaks:
        size = df.agg(F.avg(row_bytes(df)).alias("b")).first()["b"]
        rows_per_file = max(1, min(rows_per_file, int(WHOLE_FILE_BYTES / size))) if size else rows_per_file
    writer = df.write.mode(mode).options(**CSV_DIALECT).option("header", header)
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer = writer.option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    writer.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)


def write_landing(df: DataFrame, root: str, table: str, day: str | None = None) -> str:
    """Write the landing dataset of one table and day; a re-run replaces it."""
    path = landing_path(root, table, day)
    write_csv(df, path, line_breaks=table in LINE_BREAKS)
    return path
