"""What lay in a drop folder at the last run, and what has changed in it since.

A file stream goes by names, and the change gate knows the latest load only. The listing keeps,
of every file, its length, its time and the hash of its bytes. So a file rewritten under its old
name is noticed, and one that goes from A to B and back to A has changed twice, whereas one that
was merely written again, or copied with a new time, has not changed.

A folder's listing is written beside the last one, and one record, written last, says which
counts. A run that fails before it leaves the old one, and the next run finds the same changes.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.session import new_scratch_path
from rollcall.sources.splits import file_hashes
from rollcall.sources.warehouse import Warehouse, stored_rows

LISTING = "path string, n_bytes long, modified timestamp, digest string"
CHANGES = f"{LISTING}, last_digest string, change string"
MARK = "number long"

# What can have become of a file.
NEW, REWRITTEN, TOUCHED, REMOVED, SAME = "new", "rewritten", "touched", "removed", "same"


def _one_spelling(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/+", "file:/")


def files_in(spark: SparkSession, folder: str) -> DataFrame:
    """(path, n_bytes, modified) of the files of a folder; their content is not read.

    Files without bytes are left out, as by every reader; one that is emptied counts as removed.
    """
    found = spark.read.format("binaryFile").load(folder)
    return found.select(
        _one_spelling(F.col("path")).alias("path"),
        F.col("length").alias("n_bytes"),
        F.col("modificationTime").alias("modified"),
    )


def digests_of(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, digest) of files, each hashed by many tasks."""
    if not paths:
        return spark.createDataFrame([], "path string, digest string")
    name = F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B")))
    return file_hashes(spark, paths).select(_one_spelling(name).alias("path"), "digest")


def file_changes(
    spark: SparkSession, folder: str, listing: DataFrame, verify: bool = False
) -> DataFrame:
    """Every file of the folder or the listing, with its hash now and then, and its ``change``.

    Only files that are new, or whose length or time differ, are read and hashed. ``verify``
    hashes all of them, which finds a file of the same length and time with other bytes too.

    Lengths and times are written down before anything is hashed: a file that is rewritten
    meanwhile has another time by the next run, which then looks at it again.
    """
    noted = new_scratch_path(spark, "listing")
    files_in(spark, folder).write.parquet(noted)
    here = spark.read.parquet(noted)
    before = listing.select(
        "path",
        F.col("n_bytes").alias("last_bytes"),
        F.col("modified").alias("last_modified"),
        F.col("digest").alias("last_digest"),
    )
    both = here.join(before, "path", "full_outer")
    present, known = F.col("n_bytes").isNotNull(), F.col("last_digest").isNotNull()
    alike = F.col("n_bytes").eqNullSafe(F.col("last_bytes")) & F.col("modified").eqNullSafe(
        F.col("last_modified")
    )
    suspect = present & (F.lit(verify) | ~known | ~alike)
    # Names of the files that this run reads; a reader is given them in any case.
    to_hash = both.where(suspect).select("path").collect()
    hashed = digests_of(spark, [r["path"] for r in to_hash])
    digest = (
        F.when(~present, F.lit(None))
        .when(~suspect, F.col("last_digest"))
        .otherwise(F.col("digest"))
    )
    judged = both.join(hashed, "path", "left").withColumn("digest", digest)
    change = (
        F.when(~present, F.lit(REMOVED))
        .when(~known, F.lit(NEW))
        .when(F.col("digest") != F.col("last_digest"), F.lit(REWRITTEN))
        .when(~alike, F.lit(TOUCHED))
        .otherwise(F.lit(SAME))
    )
    return judged.select("path", "n_bytes", "modified", "digest", "last_digest", change.alias("change"))


def _place(wh: Warehouse, folder: str) -> str:
    name = hashlib.sha256(folder.rstrip("/").encode()).hexdigest()[:16]
    return f"{wh.folder(wh.metadata, 'drops')}/{name}"


def last_number(spark: SparkSession, wh: Warehouse, folder: str) -> int:
    """The number of the last listing of a folder that was kept; 0 if none was."""
    return max((r["number"] for r in stored_rows(spark, f"{_place(wh, folder)}/marks", MARK)), default=0)


def read_listing(spark: SparkSession, wh: Warehouse, folder: str) -> DataFrame:
    number = last_number(spark, wh, folder)
    if not number:
        return spark.createDataFrame([], LISTING)
    return spark.read.schema(LISTING).parquet(f"{_place(wh, folder)}/listing/v{number % 2}")


def keep_listing(spark: SparkSession, wh: Warehouse, folder: str, changes: DataFrame, number: int) -> None:
    """Write the folder's new listing and what changed; the mark, written last, makes it count.

    Two places take turns. The one that counts is never overwritten.
    """
    place = _place(wh, folder)
    present = changes.where(F.col("change") != REMOVED).select("path", "n_bytes", "modified", "digest")
    present.write.mode("overwrite").parquet(f"{place}/listing/v{number % 2}")
    changed = changes.where(F.col("change") != SAME)
    changed.write.mode("overwrite").parquet(f"{place}/changes/number={number}")
    mark = spark.createDataFrame([(number,)], MARK).coalesce(1)
    mark.write.mode("overwrite").parquet(f"{place}/marks/slot={number % 2}")


def read_changes(spark: SparkSession, wh: Warehouse, folder: str) -> DataFrame:
    """Every change that was noticed in a folder, with the ``number`` of the run."""
    number = last_number(spark, wh, folder)
    schema = f"{CHANGES}, number long"
    if not number:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{_place(wh, folder)}/changes").where(F.col("number") <= number)
