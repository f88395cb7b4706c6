"""Token ids in files of fixed-width blocks.

File format: a folder of Parquet files. A row is a block of whole documents:

``part``    which range of documents the block belongs to; parts are in document order
``start``   ids of the part before the block
``bits``    width of an id: the fewest bits that hold every id of the vocabulary
``ids``     the documents' ids (nulls stay)
``offsets`` the first id of each document within the block, then the block's number of ids
``packed``  the ids, ``bits`` bits each, lowest bit first, one after another

So the ids ``offsets[i]`` to ``offsets[i + 1]`` of a block are document i, and the id at place p
begins at bit ``p * bits``: any document or id is read without unpacking the rest.

Documents are encoded by pieces that the tokenizer never merges across, each piece once per
task. Nulls and empty texts are documents with the end id alone. Rows are in ascending order of
the sort columns, nulls first; ties are in order of the text, so repeated rows stay side by
side. An empty table gives an empty folder of the same schema.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollcall.llm.common import BYTE_VALUE, steps
from rollcall.llm.pieces import PieceEncoder, SpanCache, pieces

#: Bytes of text in a block; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20
BLOCKS = "part int, start long, bits int, ids array<{id}>, offsets array<int>, packed binary"


def width(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``bits`` bits of each id, lowest bit first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    rows = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(rows.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(packed: bytes, bits: int, low: int, high: int) -> np.ndarray:
    """The ids at the places ``low`` to ``high - 1``, reading their bytes only."""
    if bits in (8, 16, 32):
        size = bits // 8
        return np.frombuffer(packed, dtype=f"<u{size}", count=high - low, offset=low * size).astype(np.uint32)
    first = low * bits // 8
    raw = np.frombuffer(packed, dtype=np.uint8)[first : (high * bits + 7) // 8]
    flat = np.unpackbits(raw, bitorder="little")[low * bits - 8 * first :][: (high - low) * bits]
    weights = np.uint32(1) << np.arange(bits, dtype=np.uint32)
    return flat.reshape(high - low, bits) @ weights


@lru_cache(maxsize=2)
def cached_encoder(path: str) -> tuple[SpanCache, int]:
    encoder = PieceEncoder(path)
    return SpanCache(lambda pieces: list(map(encoder.encode, pieces)), BYTE_VALUE), encoder.tokenizer.get_vocab_size(with_added_tokens=True)


def encode_texts(data: np.ndarray, at: np.ndarray, cache: SpanCache, end: int) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the rows, each row followed by ``end``, and the first place of each row (and the last one's end)."""
    starts, ends, first = pieces(data, at)
    ids, sizes = cache.gather(cache.find(data, starts, ends))
    edges = np.concatenate([[0], np.cumsum(sizes)])[first]
    return np.insert(ids, edges[1:], end), edges + np.arange(len(edges))


def write_token_files(
    docs: DataFrame, tokenizer: str, path: str, end: int = 0, order: tuple[str, ...] = ("doc_id",), id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode every row of ``docs`` and write the blocks, sorted by the columns ``order``."""
    kind = docs.schema[id_col].dataType.simpleString()
    keys = [f"k{i}" for i in range(len(order))]
    slim = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), *(F.col(c).alias(k) for c, k in zip(order, keys, strict=True))
    ).withColumn("tie", F.xxhash64("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = (
        # The tie splits an id that many rows share over several ranges.
        slim.repartitionByRange(parts, *keys, "tie").sortWithinPartitions(*keys, "tie", "text")
        .select(F.spark_partition_id().alias("part"), "id", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, vocabulary = cached_encoder(tokenizer)
        bits, start = width(vocabulary), 0
        for batch in batches:
            for low, high, data, at in steps(batch.column(2), BLOCK_BYTES):
                ids, edges = encode_texts(data, at, cache, end)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, 1), pa.array([start], pa.int64()), pa.array([bits], pa.int32()),
                        pa.ListArray.from_arrays(pa.array([0, high - low], pa.int32()), batch.column(1).slice(low, high - low)),
                        pa.ListArray.from_arrays(pa.array([0, len(edges)], pa.int32()), pa.array(edges, pa.int32())), pa.array([pack(ids, bits)], pa.binary()),
                    ],
                    names=["part", "start", "bits", "ids", "offsets", "packed"],
                )
                start += len(ids)

    blocks = laid.mapInArrow(run, BLOCKS.format(id=kind))
    blocks.write.option("compression", "zstd").parquet(path)


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """One row per document: id, start (ids of all documents before it), n_tokens, ids_crc32."""
    blocks = spark.read.parquet(path)
    kind = blocks.schema["ids"].dataType.elementType.simpleString()
    # One row per part, however many documents a part has.
    totals = blocks.groupBy("part").agg(F.max(F.col("start") + F.element_at("offsets", -1)).alias("total"))
    before = totals.select(
        F.col("part").alias("p"),
        F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                bits, packed = batch.column("bits")[i].as_py(), batch.column("packed")[i].as_py()
                edges = batch.column("offsets")[i].values.to_numpy()
                every = unpack(packed, bits, 0, int(edges[-1]))
                raw = memoryview(every.astype("<u4").tobytes())
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
                n = len(sums)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("ids")[i].values, pa.array(np.repeat(batch.column("part")[i].as_py(), n), pa.int32()),
                        pa.array(edges[:-1] + np.int64(batch.column("start")[i].as_py()), pa.int64()),
                        pa.array(np.diff(edges), pa.int64()), pa.array(sums, pa.int64()),
                    ],
                    names=["id", "part", "inner", "n_tokens", "ids_crc32"],
                )

    rows = blocks.mapInArrow(run, f"id {kind}, part int, inner long, n_tokens long, ids_crc32 long")
    return rows.join(before, rows["part"] == before["p"]).select(
        F.col("id").alias(id_col), (F.col("before") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32"
    )


def read_ids(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """The ids of every document as an array."""
    blocks = spark.read.parquet(path)
    kind = blocks.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                edges = batch.column("offsets")[i].values
                every = unpack(batch.column("packed")[i].as_py(), batch.column("bits")[i].as_py(), 0, edges[-1].as_py())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[i].values, pa.ListArray.from_arrays(edges, pa.array(every.astype(np.int32)))], names=["id", "token_ids"]
                )

    return blocks.mapInArrow(run, f"id {kind}, token_ids array<int>").withColumnRenamed("id", id_col)
