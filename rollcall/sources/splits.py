"""What tasks need to know about each other when one file is read in splits.

A text file is read line by line in splits of some megabytes, each in one task and in order. What
a split means can depend on all splits before it: whether it begins inside a quoted field, and
how many bytes precede its first line. So each split reports how it changes that, in one row; a
scan over the reports of a file gives every split its beginning; and a second pass does the work.
The driver holds a report per split, as it holds the list of splits to plan the reading.
"""

from __future__ import annotations

import csv as plain_csv
import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollcall.schema import RAW_COLUMNS

# Fields up to one whose quote is not closed before the end, and quoted text that is not closed.
# The quantifiers are possessive, so a line is read once.
OPENS = r'(?:(?:"(?:[^"]|"")*+"|[^",][^,]*+)?+,)*+"(?:[^"]|"")*+\z'
STAYS = r'(?:[^"]|"")*+\z'
BOM = b"\xef\xbb\xbf"

#: Tasks that read lines: as many as there are splits up to this, or up to so many for each core.
TASKS, ROUNDS = 256, 32

#: Bytes of a leaf of the hash tree, and children of a node.
LEAF_BYTES = 1 << 20
CHILDREN = 1024


def in_few_tasks(lines: DataFrame) -> DataFrame:
    """The same splits, several of them in a task one after another where they are many.

    A split of some kilobytes costs less than the start of a task, so tasks are bounded by the
    cores. Reading holds a line at a time, so a task's memory does not grow with its splits.
    """
    most = max(TASKS, ROUNDS * lines.sparkSession.sparkContext.defaultParallelism)
    return lines.coalesce(most) if lines.rdd.getNumPartitions() > most else lines


def split_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with their file and where their split begins. Rows of a split are in order and follow each other.

    Lines end at a line feed only; a carriage return stays at the end of the line.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    file, block = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    return in_few_tasks(lines.select(file.alias("file"), block.alias("block"), F.col("_metadata.file_size").alias("size"), "value"))


def runs_of(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, int]]:
    """(file, block, first row, row after the last) of the stretches of rows from one split."""
    files, blocks = batch.column("file").to_pylist(), batch.column("block").to_pylist()
    low = 0
    for i in range(1, len(files) + 1):
        if i == len(files) or blocks[i] != blocks[low] or files[i] != files[low]:
            yield files[low], blocks[low], low, i
            low = i


# --- records that span lines ----------------------------------------------------------


def quote_reports(lines: DataFrame) -> DataFrame:
    """Per split: whether its end is inside quotes if its beginning is outside (``after_out``) or
    inside (``after_in``), and the first line of its file if it holds that.

    A line without a quote changes nothing, so only the others are looked at one by one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list] = {}
        for batch in batches:
            opens, stays, heads = (batch.column(c).to_pylist() for c in ("opens", "stays", "head"))
            for file, block, low, high in runs_of(batch):
                report = found.setdefault((file, block), [False, True, heads[low]])
                out, inside = report[0], report[1]
                for k in range(low, high):
                    if stays[k] is not None:
                        out, inside = (stays[k] if out else opens[k]), (stays[k] if inside else opens[k])
                report[0], report[1] = out, inside
        rows = [(f, b, *r) for (f, b), r in found.items()]
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["file", "block", "after_out", "after_in", "head"]
        )

    quoted = F.contains("value", F.lit('"'))
    seen = lines.where(quoted | (F.col("block") == 0)).select("file", "block", *_changes(), F.when(F.col("block") == 0, F.col("value")).alias("head"))
    return seen.mapInArrow(run, "file string, block long, after_out boolean, after_in boolean, head string")


def _changes() -> list:
    """State after a line that begins outside and inside quotes; NULL where it cannot change."""
    quoted = F.contains("value", F.lit('"'))
    opens = F.col("value").rlike(r"\A" + OPENS)
    stays = F.col("value").rlike(rf"\A(?:{STAYS}|(?:[^\"]|\"\")*+\",{OPENS})")
    return [F.when(quoted, opens).alias("opens"), F.when(quoted, stays).alias("stays")]


def border_states(reports: list) -> dict[str, tuple[list[int], list[bool]]]:
    """Of every file the splits after which the state differs from before, and the state there."""
    found: dict[str, tuple[list[int], list[bool]]] = {}
    for r in sorted(reports, key=lambda r: (r["file"], r["block"])):
        blocks, states = found.setdefault(r["file"], ([], []))
        state = bool(states and states[-1])
        after = r["after_in"] if state else r["after_out"]
        if after != state:
            blocks.append(r["block"])
            states.append(after)
    return found


def begins_inside(states: dict[str, tuple[list[int], list[bool]]], file: str, block: int) -> bool:
    """Whether a split begins in quotes. Splits without a quote have no report and change nothing."""
    blocks, after = states.get(file, ([], []))
    k = bisect_left(blocks, block)
    return bool(k and after[k - 1])


def records(lines: DataFrame, states: dict[str, tuple[list[int], list[bool]]], returns: bool) -> DataFrame:
    """(file, block, kind, text): whole records (kind 0) without the files' first lines, and what
    records that cross the border of splits leave in each: a continuation (1), or a beginning (2).

    ``returns`` tells that lines end with a carriage return, which is taken off.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, kind, parts = None, False, 0, []

        def row(kind: int, parts: list[str], out: list) -> None:
            text = "\n".join(parts)
            if kind or text.strip():
                out.append((*key, kind, text))

        def batch_of(out: list) -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [[]] * 4
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["file", "block", "kind", "text"])

        for batch in batches:
            out: list = []
            values, opens, stays = (batch.column(c).to_pylist() for c in ("value", "opens", "stays"))
            for file, block, low, high in runs_of(batch):
                if (file, block) != key:
                    if parts:
                        row(kind or 2, parts, out)
                    key, state, parts = (file, block), begins_inside(states, file, block), []
                    kind = 1 if state else 0
                    if not block:
                        low += 1  # the header
                for k in range(low, high):
                    value = values[k]
                    if returns and value.endswith("\r"):
                        value = value[:-1]
                    if stays[k] is not None:
                        state = stays[k] if state else opens[k]
                    parts.append(value)
                    if not state:
                        row(kind, parts, out)
                        kind, parts = 0, []
            yield batch_of(out)
        if parts:
            out = []
            row(kind or 2, parts, out)
            yield batch_of(out)

    return lines.select("file", "block", "value", *_changes()).mapInArrow(run, "file string, block long, kind int, text string")


def joined(pieces: DataFrame) -> DataFrame:
    """The text of the records that cross borders. A split has two pieces of such at most."""
    order = Window.partitionBy("file").orderBy("block", "kind")
    numbered = pieces.where("kind > 0").withColumn("record", F.sum(F.when(F.col("kind") == 2, 1).otherwise(0)).over(order))
    parts = F.sort_array(F.collect_list(F.struct("block", "kind", "text")))
    return numbered.groupBy("file", "record").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text")).select("text")


def scan_spanning(spark: SparkSession, files: list[str], options: dict[str, str]) -> DataFrame:
    """The columns of files in which records span lines, each file read by many tasks.

    Equal to reading each file whole. Files whose first lines differ are refused, as are a first
    line that spans lines and records with missing or extra fields. Blank lines outside quotes
    are no records.
    """
    lines = split_lines(spark, files)
    reports = quote_reports(lines).collect()  # a row per split
    heads = {r["head"] for r in reports if r["head"] is not None}
    if len(heads) != 1:
        raise ValueError(f"the files have different headers: {sorted(heads)[:3]}" if heads else "the files have no header")
    head = heads.pop()
    names = next(plain_csv.reader([head.rstrip("\r")]))
    missing = [c for c in RAW_COLUMNS if c not in names]
    if missing or len(set(names)) < len(names):
        raise ValueError(f"the header {names} lacks or repeats columns {missing}")
    pieces = records(lines, border_states(reports), head.endswith("\r"))
    whole = pieces.where("kind = 0").select("text").unionByName(joined(pieces))
    record = F.from_csv("text", ", ".join(f"`{c}` string" for c in names), options)
    # A generator is kept whole, so a count parses the records too and refuses what reading would.
    return whole.select(F.inline(F.array(record))).select(*RAW_COLUMNS)


# --- the bytes of a file --------------------------------------------------------------


def byte_begins(spark: SparkSession, path: str | list[str]) -> tuple[dict[str, dict[int, int]], dict[str, tuple[int, int]]]:
    """Of every file: the first byte of each split's lines; its length, and whether a mark begins it.

    The lengths of the lines tell the bytes of a split, so where it begins is their sum before it.
    """
    lines = split_lines(spark, path)
    taken = F.sum(F.octet_length("value") + 1).alias("taken")
    reports = lines.groupBy("file", "block").agg(taken, F.max("size").alias("size")).collect()  # a row per split
    begins: dict[str, dict[int, int]] = {}
    sizes: dict[str, tuple[int, int]] = {}
    totals: dict[str, int] = {}
    for r in sorted(reports, key=lambda r: (r["file"], r["block"])):
        at = totals.get(r["file"], 0)
        begins.setdefault(r["file"], {})[r["block"]] = at
        totals[r["file"]] = at + r["taken"]
        sizes[r["file"]] = (r["size"], 0)
    for file, total in totals.items():
        size, mark = sizes[file][0], 0
        # Readers skip a byte order mark. The last line may end without a line feed.
        if total in (size - len(BOM), size - len(BOM) + 1):
            mark = len(BOM)
        elif total not in (size, size + 1):
            raise ValueError(f"{file} is not plain text of {size} bytes: {total} were read; a compressed file has no hash of its bytes here")
        sizes[file] = (size, mark)
        begins[file] = {block: at + (mark if at else 0) for block, at in begins[file].items()}
    return begins, sizes


def leaf_hashes(spark: SparkSession, path: str | list[str], leaf: int, begins: dict, sizes: dict) -> DataFrame:
    """(file, i, digest): SHA-256 of the bytes i * leaf to (i + 1) * leaf - 1 of every file.

    A task hashes the leaves that lie in its split; the two it shares with its neighbours
    are put together from their bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, at, held = None, 0, bytearray()
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.string()]

        def cut(out: list, last: bool) -> None:
            """Leaves of ``held``, which begins at ``at``; a partial one only if ``last`` or at the beginning."""
            nonlocal at
            low, end = 0, len(held)
            while low < end:
                begin = at + low
                room = leaf - begin % leaf
                if low + room > end and not last:
                    break
                piece = bytes(held[low : min(end, low + room)])
                whole = len(piece) == leaf
                out.append((key[0], begin // leaf, begin, None if whole else piece, hashlib.sha256(piece).hexdigest() if whole else None))
                low += len(piece)
            del held[:low]
            at += low

        def batch_of(out: list) -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [[]] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["file", "i", "at", "bytes", "digest"])

        def finish(out: list) -> None:
            if key:
                over = at + len(held) - sizes[key[0]][0]
                if over > 0:  # a line feed that the file does not end with
                    del held[-over:]
                cut(out, True)

        for batch in batches:
            out: list = []
            values = batch.column("value").to_pylist()
            for file, block, low, high in runs_of(batch):
                if (file, block) != key:
                    finish(out)
                    held.clear()
                    key, at = (file, block), begins[file][block]
                    if at == 0 and sizes[file][1]:
                        held += BOM
                held += b"\n".join(values[low:high]) + b"\n"
                if len(held) > leaf:
                    over = at + len(held) - sizes[file][0]
                    spare = bytes(held[-over:]) if over > 0 else b""
                    if spare:
                        del held[-over:]
                    cut(out, False)
                    held.extend(spare)
            yield batch_of(out)
        out = []
        finish(out)
        yield batch_of(out)

    lines = split_lines(spark, path).select("file", "block", F.col("value").cast("binary").alias("value"))
    found = lines.mapInArrow(run, "file string, i long, at long, bytes binary, digest string")
    shared = found.where(F.col("digest").isNull()).groupBy("file", "i").agg(F.sort_array(F.collect_list(F.struct("at", "bytes"))).alias("parts"))
    content = F.aggregate("parts", F.lit(b"").cast("binary"), lambda total, part: F.concat(total, part["bytes"]))
    return found.where(F.col("digest").isNotNull()).select("file", "i", "digest").unionByName(shared.select("file", "i", F.sha2(content, 256).alias("digest")))


def file_hashes(spark: SparkSession, path: str | list[str], leaf: int = LEAF_BYTES, children: int = CHILDREN) -> DataFrame:
    """(file, n_bytes, digest) of every file: the root of a tree of SHA-256 over its bytes.

    A leaf is the hash of ``leaf`` bytes; a node is the hash of its children's hexadecimal digests
    one after another, up to ``children`` of them; the root is the hash of the file's length, a
    colon and the topmost digest (nothing for an empty file). So the digest depends on the bytes
    alone, whatever the splits, and files of any size are hashed by many tasks. A file without
    line feeds is one row, and therefore limited to 2 GB. Missing files are refused, and so are
    compressed ones.
    """
    begins, sizes = byte_begins(spark, path)
    level = leaf_hashes(spark, path, leaf, begins, sizes)
    widest = max((-(-size // leaf) for size, _ in sizes.values()), default=0)
    while widest > 1:
        parts = F.sort_array(F.collect_list(F.struct("i", "digest")))
        up = F.floor(F.col("i") / children).cast("long")
        together = F.array_join(F.transform("parts", lambda p: p["digest"]), "")
        level = level.groupBy("file", up.alias("i")).agg(parts.alias("parts")).select("file", "i", F.sha2(together, 256).alias("digest"))
        widest = -(-widest // children)
    tops = level.select("file", "digest")
    known = spark.createDataFrame([(f, s) for f, (s, _) in sizes.items()], "file string, n_bytes long")
    tops = tops.join(known, "file").unionByName(_empty_files(spark, path, sizes))
    root = F.sha2(F.concat(F.col("n_bytes").cast("string"), F.lit(":"), F.coalesce("digest", F.lit(""))), 256)
    return tops.select("file", "n_bytes", root.alias("digest"))


def _empty_files(spark: SparkSession, path: str | list[str], sizes: dict) -> DataFrame:
    """Files without a line have no split that could report them."""
    count = len(spark.read.text(path).inputFiles())
    rows = [(None, None, 0)] * (count - len(sizes))
    return spark.createDataFrame(rows, "file string, digest string, n_bytes long").select("file", "digest", "n_bytes")


def byte_fingerprint(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row with ``file_hash`` and ``n_bytes`` of all files of an extract, by their bytes.

    Neither names nor the order of files matter; any changed, added or removed byte does, so a
    reordered extract is a new one, unlike with ``content_fingerprint``.
    """
    digests = file_hashes(spark, path).agg(F.sort_array(F.collect_list("digest")).alias("all"), F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("n_bytes"))
    return digests.select(F.sha2(F.array_join("all", ""), 256).alias("file_hash"), "n_bytes")
