"""Helpers shared by the operators: slices of Arrow batches, words and their hashes.

Words are maximal runs of bytes other than space and 0x09-0x0D, after A-Z became a-z; that is
what ``bytes.lower().split()`` gives. Hashes are 64-bit; equal words have equal hashes on every
machine, and two different words collide with a chance of about 2^-64.
"""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.session import scratch_root

#: Bytes of text that one numpy step works on; a longer text is a step of its own.
STEP_BYTES = 1 << 20

MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the executors, once in a session, so that they can import it."""
    context = spark.sparkContext
    if not getattr(context, "_rollcall_shipped", False):
        root = Path(__file__).resolve().parent.parent
        made = shutil.make_archive(f"{tempfile.mkdtemp()}/rollcall", "zip", root.parent, root.name)
        context.addPyFile(made)
        context._rollcall_shipped = True


def use_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` write to the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_root(spark))


def checkpoint_in(df: DataFrame, files: int, light: bool) -> DataFrame:
    """A checkpoint of at most ``files`` files.

    For every file that it makes, Hadoop's local file system starts processes from the executor, and until
    each has begun it holds the executor's whole memory a second time; so small tables go into few files.
    ``light``: the last stage is little work and may itself run in that many tasks; else its rows are dealt again.
    """
    return (df.coalesce(files) if light else df.repartition(files)).checkpoint()


def held_out(doc_id: Column, folds: int) -> Column:
    """True where crc32 of the id as text leaves no remainder; a null id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def spans(sizes: np.ndarray, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows whose sizes add up to ``limit`` at most, or single rows."""
    low, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if total + size > limit and i > low:
            yield low, i
            low, total = i, 0
        total += size
    if low < len(sizes):
        yield low, len(sizes)


def text_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, and where each row begins and the last one ends.

    A null is an empty text.
    """
    column = column.fill_null("") if column.null_count else column
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def steps(column: pa.Array, limit: int = STEP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of parts of a string column."""
    data, at = text_parts(column)
    for low, high in spans(np.diff(at), limit):
        yield low, high, data[at[low] : at[high]], at[low : high + 1] - at[low]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finalizer of splitmix64, a published rule)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbered(n: int, seed: int) -> np.ndarray:
    """``n`` fixed 64-bit values that look random."""
    golden = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed * 1_000_003)) * golden)


SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: A value for each byte, and for each lower-cased byte.
BYTE_VALUE = numbered(256, 1)
LOWER_VALUE = BYTE_VALUE[LOWER]
_BASE = 0x9E3779B97F4A7C55  # odd, so that it has an inverse modulo 2^64
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, 0 to n - 1."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, STEP_BYTES + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            made = np.full(size, base, dtype=np.uint64)
            made[0] = 1
            made = np.multiply.accumulate(made)
            if size > 2 * STEP_BYTES:
                return _powers_of(size)
            _POWERS[name] = made
    return _POWERS["up"][:n], _POWERS["down"][:n]


def _powers_of(n: int) -> tuple[np.ndarray, np.ndarray]:
    """As above, not kept: for a text far longer than a step."""
    made = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        x = np.full(n, base, dtype=np.uint64)
        x[0] = 1
        made.append(np.multiply.accumulate(x))
    return made[0], made[1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = LOWER_VALUE) -> np.ndarray:
    """A hash of each ``data[start:end]``, lower-cased by default, that does not depend on its place."""
    up, down = powers(len(data) + 1)
    sums = np.empty(len(data) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(values[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_bounds(data: np.ndarray, at: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the number of the first word of each row (and the end).

    ``space`` tells which bytes are outside words.
    """
    inside = np.empty(len(data) + 2, dtype=bool)
    inside[0] = inside[-1] = False
    np.logical_not(space[data], out=inside[1:-1])
    # A row's first byte begins a word even where the row before ended inside one.
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[at] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    return starts, ends, np.searchsorted(starts, at)


def word_hashes(data: np.ndarray, at: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the number of the first word of each row (and the end)."""
    starts, ends, first = word_bounds(data, at, space)
    return span_hashes(data, starts, ends), first


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n words in a row; a gram that begins at word i is at place i."""
    count = max(0, len(words) - n + 1)
    total = np.zeros(count, dtype=np.uint64)
    for k, factor in enumerate(numbered(n, 100 + n) | np.uint64(1)):
        total += words[k : k + count] * factor
    return mix(total)


def gather_spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of every span, one span after another."""
    total = int(lengths.sum())
    shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return np.arange(total, dtype=np.int64) + shift
