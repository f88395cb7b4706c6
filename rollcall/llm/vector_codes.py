"""Codes for vectors: each of equal consecutive parts is named by its nearest codebook entry.

Components become integers floor(256 x). The codebook of a part position begins as that part of
the vectors with the smallest ids; each round assigns every part to its nearest entry and moves
each entry to the floor of its parts' mean. All of it is integer arithmetic, so the result does
not depend on how rows are dealt over tasks.

The nearest entry comes from a matrix product, since |x - c|^2 = |x|^2 - 2 x.c + |c|^2. Integers
are broken into limbs so small that every product of two limb matrices, added up over a part,
stays below 2^53: BLAS computes it in float64 without rounding. The limb products are shifted and
added up in 64-bit integers, and the first smallest distance wins.

A round is one pass over the rows: a task adds up what it assigned to each entry, sums meet by
entry in a shuffle, and the driver gets one row per entry and component. Codebooks travel in the
tasks' code; both are entries x components, whatever the number of rows.

Defined results: vectors that are null, empty or hold a null, NaN or infinite component take no
part, neither do those whose length is no multiple of the number of parts. Vectors of each length
have codebooks of their own (lengths are expected to be few). Rows that repeat an id all take
part; among equal ids the smaller vector is first, and rows without id come after all others.
Fewer rows than entries give fewer entries. Components too large for 64-bit distances are handled
by Python's integers; an error of 2^63 or more is shown as 2^63 - 1. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import ship_package
from rollcall.session import new_scratch_path

#: A row per entry and component of what a task assigned; ``pos`` -1 holds the number of parts.
#: A sum is cut in pieces of ``LIMB_BITS`` bits, so that sums of any size add up in longs.
SUMS = "dim int, part int, entry int, pos int, limb int, value long"
LIMB_BITS = 40
MOST = (1 << 63) - 1
#: Labels with at least this share of the rows are counted as frequent; there are at most as many.
FREQUENT = 1000

#: Codebooks by vector length: (parts, entries, components) of int64, or of Python integers.
Codebooks = dict[int, np.ndarray]


def usable(vectors: DataFrame, parts: int, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """id, label and vector of the rows that take part."""
    v = F.col("v")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v"), F.size(vector_col).alias("dim")
    )
    return rows.where(v.isNotNull() & (F.col("dim") > 0) & (F.col("dim") % parts == 0) & finite)


def fits(largest: float, dim: int) -> bool:
    """Whether squared distances of vectors with components up to ``largest`` stay in 64 bits."""
    return largest < 2.0**31 and 4 * largest * largest * dim < 2.0**62


def integers(x: np.ndarray) -> np.ndarray:
    """floor(256 x), as int64 where all distances between such vectors fit, else as Python integers."""
    if fits(256.0 * min(float(np.abs(x).max(initial=0)), 2.0**100) + 1, x.shape[-1]):
        return np.floor(x * 256.0).astype(np.int64)
    # From 2^52 on a double is a whole number.
    whole = [int(c) * 256 if abs(c) >= 2.0**52 else math.floor(c * 256.0) for c in x.ravel().tolist()]
    made = np.empty(len(whole), dtype=object)
    made[:] = whole
    return made.reshape(x.shape)


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """float64 matrices of ``bits`` bits, lowest first; the last one carries the sign."""
    made = []
    while np.abs(x).max(initial=0) >= 1 << bits:
        made.append((x & ((1 << bits) - 1)).astype(np.float64))
        x = x >> bits
    return [*made, x.astype(np.float64)]


def dot(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """x @ c.T, exactly; the result has to fit int64 unless the inputs are Python integers."""
    if x.dtype == object or c.dtype == object:
        return x.astype(object) @ c.T.astype(object)
    # A limb is at most 2^bits in magnitude, so a sum of n products stays below 2^53.
    bits = (52 - max(1, x.shape[1] - 1).bit_length()) // 2
    out = np.zeros((len(x), len(c)), dtype=np.int64)
    right = limbs(c, bits)
    for i, a in enumerate(limbs(x, bits)):
        for j, b in enumerate(right):
            out += (a @ b.T).astype(np.int64) << (bits * (i + j))
    return out


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first nearest entry of every row, and its squared distance."""
    if x.dtype == object or entries.dtype == object:
        x, entries = x.astype(object), entries.astype(object)
    distance = (entries * entries).sum(axis=1)[None, :] - 2 * dot(x, entries)
    best = np.argmin(distance, axis=1)
    return best, distance[np.arange(len(x)), best] + (x * x).sum(axis=1)


def by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, integer vectors), rows with ordinary and with huge components apart."""
    lists = batch.column("v")
    flat, at = lists.values.to_numpy(), lists.offsets.to_numpy()
    dims = np.diff(at)
    for dim in np.unique(dims).tolist():
        rows = np.flatnonzero(dims == dim)
        x = flat[at[rows][:, None] + np.arange(dim)]
        huge = np.array([not fits(256.0 * m + 1, dim) for m in np.minimum(np.abs(x).max(axis=1), 2.0**100).tolist()])
        for some in (~huge, huge):
            if some.any():
                yield dim, rows[some], integers(x[some])


def cut(x: np.ndarray, parts: int) -> np.ndarray:
    return x.reshape(len(x), parts, -1)


def pieces(value: int) -> Iterator[int]:
    """The value in base 2^LIMB_BITS, lowest first; the last piece carries the sign."""
    while not -(1 << LIMB_BITS) <= value < 1 << LIMB_BITS:
        yield value & ((1 << LIMB_BITS) - 1)
        value >>= LIMB_BITS
    yield value


def first_codebooks(rows: DataFrame, parts: int, entries: int) -> Codebooks:
    """The parts of the vectors with the smallest ids, for each length."""
    order = Window.partitionBy("dim").orderBy(F.col("id").asc_nulls_last(), "v")
    first = rows.select("id", "v", "dim").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= entries)
    # At most ``entries`` vectors of each length.
    found: dict[int, list] = {}
    for r in sorted(first.collect(), key=lambda r: r["rank"]):
        found.setdefault(r["dim"], []).append(r["v"])
    return {dim: np.ascontiguousarray(cut(integers(np.array(v)), parts).swapaxes(0, 1)) for dim, v in found.items()}


def assigned_sums(rows: DataFrame, codebooks: Codebooks, parts: int) -> DataFrame:
    """For every entry the componentwise sum and the number of the parts nearest to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {dim: np.zeros((c.shape[0], c.shape[1], c.shape[2] + 1), dtype=object) for dim, c in codebooks.items()}
        for batch in batches:
            for dim, _, x in by_length(batch):
                x = cut(x, parts)
                for part in range(parts):
                    best, _ = nearest(x[:, part], codebooks[dim][part])
                    order = np.argsort(best, kind="stable")
                    used, begin, count = np.unique(best[order], return_index=True, return_counts=True)
                    totals[dim][part, used, :-1] += np.add.reduceat(x[order, part], begin, axis=0).astype(object)
                    totals[dim][part, used, -1] += count.astype(object)
        out = [
            (dim, part, entry, pos, limb, value)
            for dim, total in totals.items()
            for part, entry in np.argwhere(total[:, :, -1] > 0).tolist()
            for pos, number in enumerate(total[part, entry].tolist())
            for limb, value in enumerate(pieces(int(number)))
        ]
        if out:
            columns = list(zip(*out, strict=True))
            kinds = [pa.int32()] * 5 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["dim", "part", "entry", "pos", "limb", "value"])

    partial = rows.select("v").mapInArrow(run, SUMS)
    return partial.groupBy("dim", "part", "entry", "pos", "limb").agg(F.sum("value").alias("value"))


def moved(codebooks: Codebooks, sums: DataFrame) -> Codebooks:
    """Every used entry at the floor of its parts' mean."""
    totals: dict[tuple, int] = {}
    for r in sums.collect():  # a row per entry and component (and limb)
        key = (r["dim"], r["part"], r["entry"], r["pos"])
        totals[key] = totals.get(key, 0) + (r["value"] << (LIMB_BITS * r["limb"]))
    new = {dim: c.astype(object) for dim, c in codebooks.items()}
    for (dim, part, entry, pos), total in totals.items():
        width = codebooks[dim].shape[2]
        if pos < width:
            new[dim][part, entry, pos] = total // totals[dim, part, entry, width]
    return {dim: c.astype(np.int64) if fits(max(map(abs, c.ravel().tolist())), dim) else c for dim, c in new.items()}


def fit(rows: DataFrame, parts: int, entries: int, rounds: int) -> Codebooks:
    codebooks = first_codebooks(rows, parts, entries)
    for _ in range(rounds):
        codebooks = moved(codebooks, assigned_sums(rows, codebooks, parts))
    return codebooks


def digest(codebook: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and place."""
    return hashlib.sha256(",".join(map(str, codebook.ravel().tolist())).encode()).hexdigest()


def coded(rows: DataFrame, codebooks: Codebooks, parts: int) -> DataFrame:
    """id, label, dim, the entry numbers of all parts as bytes, and the error of every row."""
    wide = any(c.shape[1] > 256 for c in codebooks.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, at, x in by_length(batch):
                x = cut(x, parts)
                found = [nearest(x[:, part], codebooks[dim][part]) for part in range(parts)]
                codes = np.stack([best for best, _ in found], axis=1).astype(">u2" if wide else np.uint8)
                error = sum(e.astype(object) if x.dtype == object else e for _, e in found)
                place = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(place), batch.column("label").take(place), pa.array([dim] * len(at), pa.int32()),
                        pa.array([c.tobytes() for c in codes], pa.binary()), pa.array([min(int(e), MOST) for e in error.tolist()], pa.int64()),
                    ],
                    names=["id", "label", "dim", "codes", "error"],
                )

    kind = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.select("id", "label", "v").mapInArrow(run, f"id {kind['id']}, label {kind['label']}, dim int, codes binary, error long")


def with_label_error(rows: DataFrame) -> DataFrame:
    """Adds ``label_error``, the error summed over the rows of an equal label, nulls together.

    Labels are few or many, and one may hold most rows. The frequent ones, at most ``FREQUENT``
    by their share, are broadcast; the rest, none of which holds much, are joined by label.
    """
    limit = F.lit(MOST).cast("decimal(38,0)")
    total = F.least(F.sum(F.col("error").cast("decimal(20,0)")).cast("decimal(38,0)"), limit).cast("long")
    sums = rows.groupBy("label").agg(total.alias("label_error"), F.count("*").alias("n")).withColumnRenamed("label", "of_label")
    share = F.col("n") * FREQUENT >= F.lit(rows.count())
    same = F.col("label").eqNullSafe(F.col("of_label"))
    known = rows.join(F.broadcast(sums.where(share)), same, "left")
    found = F.col("n").isNotNull()
    others = known.where(~found).drop("of_label", "label_error", "n").join(sums.where(~share), same)
    return known.where(found).unionByName(others).drop("of_label", "n")


def vector_codes(
    vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> tuple[DataFrame, Codebooks]:
    """Rows of id, ``code`` (entry numbers in part order, two hexadecimal digits each, or four
    with over 256 entries), ``error``, ``label_error`` and ``codebooks_sha256``; and the codebooks themselves, by vector length."""
    ship_package(vectors.sparkSession)
    rows = usable(vectors, parts, id_col, vector_col, label_col)
    codebooks = fit(rows, parts, entries, rounds)
    digests = {dim: digest(c) for dim, c in codebooks.items()}
    # A short literal map: one entry per vector length.
    named = F.coalesce(*(F.when(F.col("dim") == dim, F.lit(d)) for dim, d in digests.items()), F.lit(""))
    # The codes are read several times below; they are far smaller than the vectors.
    path = new_scratch_path(vectors.sparkSession, "vector-codes")
    coded(rows, codebooks, parts).write.parquet(path)
    found = with_label_error(vectors.sparkSession.read.parquet(path))
    return found.select(F.col("id").alias(id_col), F.lower(F.hex("codes")).alias("code"), "error", "label_error", named.alias("codebooks_sha256")), codebooks
