"""Reading the extract: comma-separated text with a header and double quotes."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.schema import RAW_COLUMNS
from rollcall.sources.splits import in_few_tasks, scan_spanning

# Quotes are doubled inside quoted fields and a backslash is an ordinary character.
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "enforceSchema": "false",
    "mode": "FAILFAST",
    "encoding": "UTF-8",
    # Every record is parsed whole, so a count refuses what reading the rows would refuse.
    "columnPruning": "false",
}

# A line whose last field opens with a quote that is not closed in it. The quantifiers are
# possessive, so a line is read once.
OPEN_QUOTE = r'^(?:(?:"(?:[^"]|"")*+"|[^",][^,]*+)?+,)*+"(?:[^"]|"")*+$'


def _plain(uri: str) -> str:
    """A file's name as readers take it: not encoded, and one spelling of local files."""
    return re.sub("^file:/+", "file:/", unquote(uri))


def files_spanning_lines(spark: SparkSession, path: str | list[str]) -> list[str]:
    """The files in which some record runs over a line end.

    The first line of such a record leaves a quoted field open. Quotes inside a field that
    does not open with one, such as 5' 6", do not count. Lines are matched in parallel, and
    each file is named once.
    """
    lines = in_few_tasks(spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file")))
    return sorted(_plain(r[0]) for r in lines.where(F.col("value").rlike(OPEN_QUOTE)).select("file").distinct().collect())


def csv_scan(
    spark: SparkSession, path: str | list[str], multi_line: bool | None = None
) -> DataFrame:
    """The 11 columns as text, taken by header name; empty fields are NULL.

    Nothing is inferred: '007' and '01/02/2024' stay as they are. Files in which records span
    lines are looked up when ``multi_line`` is not given, and their records are put together
    over the borders of splits, so that every file is divided over many tasks. With
    ``multi_line`` each file is one task instead.
    """
    def read(files: str | list[str], whole: bool) -> DataFrame:
        reader = spark.read.options(**CSV_OPTIONS).option("multiLine", whole)
        return reader.csv(files).select(*RAW_COLUMNS)

    if multi_line is not None:
        return read(path, multi_line)
    spanning = files_spanning_lines(spark, path)
    if not spanning:
        return read(path, False)
    others = sorted(set(map(_plain, spark.read.text(path).inputFiles())) - set(spanning))
    whole = scan_spanning(spark, spanning, CSV_OPTIONS)
    return whole.unionByName(read(others, False)) if others else whole


def csv_stream(
    spark: SparkSession,
    folder: str,
    columns: list[str] | None = None,
    max_files: int | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """New files of a drop folder as a stream. ``columns`` is their header order.

    With ``multi_line`` records may span lines and each file is one task; without it a
    record that does is refused.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns or RAW_COLUMNS])
    reader = spark.readStream.options(**CSV_OPTIONS).option("multiLine", multi_line).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(folder).select(*RAW_COLUMNS)


def source_row_count(extract: DataFrame) -> DataFrame:
    """Records, not lines: a quoted line end does not count twice."""
    return extract.agg(F.count("*").alias("file_row_count"))


def write_extract(extract: DataFrame, path: str, mode: str = "append") -> None:
    """An extract as CSV files that ``csv_scan`` reads back unchanged."""
    options = {
        "header": "true",
        "escape": '"',
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }
    extract.select(*RAW_COLUMNS).write.mode(mode).options(**options).csv(path)
