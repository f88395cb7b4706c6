"""A fingerprint of the records of an extract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.schema import RAW_COLUMNS

# Field separator, stand-in for NULL, and the hex digits taken of a digest.
FIELD_END = "\x1f"
NULL_MARK = "\x1e"
DIGITS = 15


def row_digest(columns: tuple[str, ...] = RAW_COLUMNS) -> Column:
    fields = [F.coalesce(F.col(c), F.lit(NULL_MARK)) for c in columns]
    return F.sha2(F.concat_ws(FIELD_END, *fields), 256)


def content_fingerprint(
    extract: DataFrame, columns: tuple[str, ...] = RAW_COLUMNS
) -> DataFrame:
    """One row with ``file_hash`` and ``file_row_count``.

    Sixty bits of every row digest are summed, so each task contributes a partial sum and
    neither the order of the records nor their division into files matters. Repeated
    records do count. The sum is a DECIMAL(38,0): BIGINT would overflow after a few rows, and
    sixty bits leave room for 10^19 records.
    """
    number = F.conv(F.substring(row_digest(columns), 1, DIGITS), 16, 10).cast("decimal(28,0)")
    summed = extract.select(number.alias("number")).agg(
        F.count("*").alias("file_row_count"),
        F.coalesce(F.sum("number"), F.lit(0)).cast("string").alias("total"),
    )
    text = F.concat_ws(":", F.col("file_row_count").cast("string"), "total")
    return summed.select(F.sha2(text, 256).alias("file_hash"), "file_row_count")
