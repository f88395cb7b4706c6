"""Key rules of the append-only load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class KeyViolation(ValueError):
    """A batch holds a NULL key or a key twice."""


def load_unseen_keys(
    batch: DataFrame, target: DataFrame, key: str = "id", nullable: bool = True
) -> DataFrame:
    """Rows of ``batch`` whose key the target does not hold; rows without a key are kept.

    Only the key column of the target is read, a target bucketed by the key is not
    shuffled, and the batch is scanned once. Rows without a key match nothing; their flag
    and a spread number join the key, so that they do not meet in one task. A batch known
    to have none (``nullable=False``) is joined where its rows already are.
    """
    if not nullable:
        return batch.join(target.select(key), key, "left_anti").select(*batch.columns)
    known = target.select(F.col(key).alias("_known"), F.lit(0).alias("_slot"))
    slot = F.when(F.col(key).isNull(), F.pmod(F.monotonically_increasing_id(), F.lit(1 << 20)) + 1)
    marked = batch.withColumn("_slot_of", F.coalesce(slot, F.lit(0)).cast("int"))
    same = (F.col(key) == F.col("_known")) & (F.col("_slot_of") == F.col("_slot"))
    return marked.join(known, same, "left_anti").select(*batch.columns)


def key_violations(batch: DataFrame, key: str = "id") -> DataFrame:
    """Keys that break the rule, with their number of rows. Counted map-side first."""
    counted = batch.groupBy(key).agg(F.count("*").alias("n_records"))
    return counted.where((F.col("n_records") > 1) | F.col(key).isNull())


def dedupe_keys(batch: DataFrame, key: str = "id") -> DataFrame:
    """One row for each key, the smallest by all columns, and no row without a key.

    The smallest is an aggregate with a map-side part, so the rows of a hot key do not meet.
    """
    row = F.struct(*(F.col(c) for c in batch.columns if c != key))
    kept = batch.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(row).alias("_row"))
    return kept.select(key, "_row.*").select(*batch.columns)


def key_guard(
    batch: DataFrame, target: DataFrame, key: str = "id", mode: str = "abort"
) -> DataFrame:
    """The rows of ``batch`` that may be loaded, each key at most once and none NULL.

    ``mode="dedupe"`` keeps one row for each key instead. Otherwise it raises before anything is written when an unseen key is NULL or repeated. A repeated
    key that the target already holds does no harm; its rows are taken out here, so that
    a key repeated over a third of the batch never meets in one task of the load.
    """
    if mode == "dedupe":
        return dedupe_keys(batch, key)
    if mode != "abort":
        raise ValueError(f"unknown mode {mode!r}")
    broken = key_violations(batch, key)
    if broken.isEmpty():
        return batch
    offenders = load_unseen_keys(broken, target, key).agg(
        F.count(key).alias("repeated"), F.count_if(F.col(key).isNull()).alias("missing")
    )
    found = offenders.first()
    if found["repeated"] or found["missing"]:
        raise KeyViolation(
            f"{key!r} is repeated in {found['repeated']} value(s)"
            + (" and missing in some rows" if found["missing"] else "")
        )
    return batch.join(broken.select(key), key, "left_anti").select(*batch.columns)
