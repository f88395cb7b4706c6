"""Packing documents into sequences of fixed capacity, by the harmonic rule.

A piece of length r belongs to class k = capacity // r: k such pieces fill one sequence. Every
class has sequences of its own, each closed as soon as it holds k pieces. Which documents share
a sequence is decided by their lengths alone, so every task packs what it reads, with one open
sequence per class and nothing to agree on.

Plain harmonic packing pads up to half of a sequence. Here a document may be cut: while its rest
would pad more than ``slack`` of the document's length, capacity // (k + 1) ids are cut off, a
piece that fills class k + 1 exactly. So full sequences pad at most ``slack`` of all ids, and less
than one id for each piece that was cut off; most documents are cut two or three times.

Sequences still open when a task ends go on to the next level, where the tasks of 64 fill them
up class by class, and so on until one set is left. What is open then, at most one sequence per
class whatever the number of documents, is laid end to end, in sequences that are full but for
the last, which is cut at powers of two. A sequence whose length is a power of two needs no padding.

Written files: a row per sequence with its number, its ids (unsigned 32-bit, little-endian), and
lists that hold for every piece the document's id, its first id's place in the document, its
length and the document's number of ids. Every id is in exactly one piece; pieces lie in a
sequence without gaps.

Defined results: a null or empty text is a document of the end id alone. Rows that repeat an id
are documents of their own; a null id stays null. Extra columns are not read. An empty table
gives an empty folder of the same schema.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.common import BYTE_VALUE, ship_package, steps
from rollcall.llm.pieces import SpanCache, pieces
from rollcall.session import new_scratch_path

#: Tasks whose open sequences meet in one task of the next level.
FAN_IN = 64
#: ``k`` is 0 for a full sequence; else the row is one piece of an open one of class ``k``.
ROWS = "part long, k int, sequence_id long, doc_ids array<{id}>, starts array<long>, lengths array<int>, doc_tokens array<long>, ids binary"
COLUMNS = ["part", "k", "sequence_id", "doc_ids", "starts", "lengths", "doc_tokens", "ids"]


def cut_lengths(n: int, capacity: int, slack: float) -> list[int]:
    """The lengths of a document's pieces, in order."""
    cuts = [capacity] * (n // capacity)
    rest = n % capacity
    while rest:
        k = capacity // rest
        if capacity / k - rest <= slack * n:
            cuts.append(rest)
            break
        cuts.append(capacity // (k + 1))
        rest -= cuts[-1]
    return cuts


@dataclass
class Open:
    """A sequence being filled: per piece document, start, length and document length; and the ids."""

    docs: list = field(default_factory=list)
    starts: list = field(default_factory=list)
    lengths: list = field(default_factory=list)
    totals: list = field(default_factory=list)
    ids: list = field(default_factory=list)

    def add(self, doc, start: int, length: int, total: int, ids: bytes) -> None:
        for column, value in zip((self.docs, self.starts, self.lengths, self.totals, self.ids), (doc, start, length, total, ids), strict=True):
            column.append(value)


class Writer:
    """Collects rows and hands them on in batches of a few megabytes."""

    def __init__(self, kind: pa.DataType, most: int = 4 << 20):
        self.kind, self.most, self.rows, self.size = kind, most, [], 0

    def put(self, part: int, k: int, number: int, s: Open) -> bool:
        raw = b"".join(s.ids)
        self.rows.append((part, k, number, s.docs, s.starts, s.lengths, s.totals, raw))
        self.size += len(raw) + 40 * len(s.docs)
        return self.size >= self.most

    def take(self) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.list_(self.kind), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.binary()]
        columns = list(zip(*self.rows, strict=True)) or [[]] * len(kinds)
        self.rows, self.size = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=COLUMNS)


class WordEncoder:
    """Ids of texts piece by piece, each piece encoded once while the cache keeps it.

    A piece is white space and the other characters up to the next one. It is sound for
    tokenizers that split at white space before they merge, and drop it or lead a word with it.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cache = SpanCache(self.encode, BYTE_VALUE)

    def encode(self, spans: list[bytes]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch([s.decode("utf-8") for s in spans], add_special_tokens=False)]

    def texts(self, data: np.ndarray, at: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows, each row followed by ``end``, and the edges of the rows."""
        starts, ends, first = pieces(data, at)
        ids, sizes = self.cache.gather(self.cache.find(data, starts, ends))
        edges = np.concatenate([[0], np.cumsum(sizes)])[first]
        return np.insert(ids, edges[1:], end).astype("<u4"), edges + np.arange(len(edges))


@lru_cache(maxsize=2)
def cached_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def pack_part(docs: DataFrame, tokenizer: str, end: int, capacity: int, slack: float, id_col: str, text_col: str) -> DataFrame:
    """Full sequences of every task, and the pieces of its open ones."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.spark_partition_id().cast("long").alias("part"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, made, part, out = cached_encoder(tokenizer), 0, 0, None
        still: dict[int, Open] = {}
        for batch in batches:
            out = out or Writer(batch.column("id").type)
            if batch.num_rows:
                part = batch.column("part")[0].as_py()
            names = batch.column("id").to_pylist()
            for low, _, data, at in steps(batch.column("text")):
                ids, edges = encoder.texts(data, at, end)
                raw = ids.tobytes()
                for row, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
                    place, n = a, b - a
                    for length in cut_lengths(n, capacity, slack):
                        k = capacity // length
                        s = still.setdefault(k, Open())
                        s.add(names[low + row], place - a, length, n, raw[4 * place : 4 * (place + length)])
                        place += length
                        if len(s.docs) == k:
                            # Numbers of the first level: the task in the upper bits.
                            if out.put(part, 0, (part << 34) + made, still.pop(k)):
                                yield out.take()
                            made += 1
        for k, s in sorted(still.items()):
            for i in range(len(s.docs)):
                one = Open([s.docs[i]], [s.starts[i]], [s.lengths[i]], [s.totals[i]], [s.ids[i]])
                if out.put(part, k, -1, one):
                    yield out.take()
        if out:
            yield out.take()

    return rows.mapInArrow(run, ROWS.format(id=kind))


def fill_up(left: DataFrame, level: int) -> DataFrame:
    """Pieces of open sequences, filled up class by class over ``FAN_IN`` parts of the level before."""
    kind = left.schema["doc_ids"].dataType.elementType.simpleString()
    group = (F.col("part") / FAN_IN).cast("long").alias("part")
    dealt = left.select(group, F.col("part").alias("from"), *COLUMNS[1:]).repartition("part", "k").sortWithinPartitions("part", "k", "from", "doc_ids", "starts", "doc_tokens", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, key, made, s = None, None, 0, Open()

        def rest() -> Iterator[pa.RecordBatch]:
            for i in range(len(s.docs)):
                one = Open([s.docs[i]], [s.starts[i]], [s.lengths[i]], [s.totals[i]], [s.ids[i]])
                if out.put(key[0], key[1], -1, one):
                    yield out.take()

        for batch in batches:
            out = out or Writer(batch.column("doc_ids").type.value_type)
            for r in batch.to_pylist():
                if (r["part"], r["k"]) != key:
                    yield from rest()
                    key, made, s = (r["part"], r["k"]), 0, Open()
                s.add(r["doc_ids"][0], r["starts"][0], r["lengths"][0], r["doc_tokens"][0], r["ids"])
                if len(s.docs) == key[1]:
                    # A class gets at most one sequence from each of the parts that meet here.
                    number = (level << 60) + (key[0] << 34) + key[1] * FAN_IN + made
                    if out.put(key[0], 0, number, s):
                        yield out.take()
                    made, s = made + 1, Open()
        if out:
            yield from rest()
            yield out.take()

    return dealt.mapInArrow(run, ROWS.format(id=kind))


def powers_of_two(n: int) -> list[int]:
    return [1 << b for b in reversed(range(n.bit_length())) if n >> b & 1]


def lay_end_to_end(left: DataFrame, capacity: int, level: int) -> DataFrame:
    """The last open sequences, at most one per class, in full sequences and powers of two."""
    kind = left.schema["doc_ids"].dataType.elementType.simpleString()
    laid = left.select(*COLUMNS).coalesce(1).sortWithinPartitions("k", "doc_ids", "starts", "doc_tokens", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, id_kind = [], None
        for batch in batches:  # fewer than one sequence of each class
            id_kind = batch.column("doc_ids").type.value_type
            rows += batch.to_pylist()
        if not rows:
            return
        out, total = Writer(id_kind), sum(r["lengths"][0] for r in rows)
        sizes = [capacity] * (total // capacity) + powers_of_two(total % capacity)
        wanted, made, s = iter(sizes), 0, Open()
        room = next(wanted)
        for r in rows:
            start, length, at = r["starts"][0], r["lengths"][0], 0
            while at < length:
                take = min(room, length - at)
                s.add(r["doc_ids"][0], start + at, take, r["doc_tokens"][0], r["ids"][4 * at : 4 * (at + take)])
                at, room = at + take, room - take
                if not room:
                    if out.put(0, 0, (level << 60) + made, s):
                        yield out.take()
                    made, s, room = made + 1, Open(), next(wanted, 0)
        yield out.take()

    return laid.mapInArrow(run, ROWS.format(id=kind))


def pack_documents(
    docs: DataFrame, tokenizer: str, path: str, end: int = 1, capacity: int = 2048, slack: float = 1 / 128, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode every row of ``docs`` and write the sequences to folders under ``path``."""
    spark = docs.sparkSession
    ship_package(spark)
    folder = f"{path}/level="
    pack_part(docs, tokenizer, end, capacity, slack, id_col, text_col).write.option("compression", "zstd").parquet(f"{folder}0")
    level, left = 1, spark.read.parquet(f"{folder}0").where("k > 0")
    while left.agg(F.max("part")).first()[0]:
        fill_up(left, level).write.option("compression", "zstd").parquet(f"{folder}{level}")
        level, left = level + 1, spark.read.parquet(f"{folder}{level}").where("k > 0")
    lay_end_to_end(left, capacity, level).write.option("compression", "zstd").parquet(f"{folder}{level}")


def read_sequences(spark: SparkSession, path: str) -> DataFrame:
    """sequence_id, doc_ids, starts, lengths, doc_tokens, ids: a row per sequence."""
    return spark.read.parquet(path).where("k = 0").select(*COLUMNS[2:])


def read_pieces(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """A row per piece: the document, where the piece is in it and in which sequence, and its ids' crc32."""
    sequences = read_sequences(spark, path)
    kind = sequences.schema["doc_ids"].dataType.elementType.simpleString()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("lengths")
            flat = lengths.values.to_numpy().astype(np.int64)
            edges = lengths.offsets.to_numpy()
            counts = np.diff(edges)
            raws = batch.column("ids").to_pylist()
            before = np.concatenate([[0], np.cumsum(flat)])
            offset = before[:-1] - np.repeat(before[edges[:-1]], counts)
            row = np.repeat(np.arange(len(counts)), counts)
            sums = [zlib.crc32(raws[r][4 * o : 4 * (o + n)]) for r, o, n in zip(row.tolist(), offset.tolist(), flat.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_ids").values, batch.column("starts").values, pa.array(flat), pa.array(sums, pa.int64()),
                    batch.column("doc_tokens").values, batch.column("sequence_id").take(pa.array(row)), pa.array(offset),
                ],
                names=names,
            )

    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return sequences.mapInArrow(run, schema).withColumnRenamed("doc_id", id_col)
