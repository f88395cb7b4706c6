"""N-gram Jaccard join by a blocked sparse product of documents and n-grams.

A document's set holds its distinct n-word shingles (64-bit hashes). Two documents link when
100 |A and B| >= percent |A or B|. The result has a row per document with the smallest id of
its component of links; pairs are never listed for copies.

1. Documents with equal sets are one class, known by a signature of the set.
2. All shingles are ordered by a rough frequency (a sketch of fixed size, added up over all
   documents), then by hash. In any one order, two sets that link share a shingle among each
   one's first |A| - ceil(percent |A| / 100) + 1. These prefixes form a sparse matrix.
3. Its columns are dealt into blocks by hash. A block multiplies its slice by its transpose:
   every column adds one to the overlap of each pair of classes in it. Counts of all blocks
   are added up by pair, and a pair is discarded when its count, the columns not multiplied
   and the shingles beyond the prefixes together are below the bound that its sizes set.
4. A column of more than ``wide`` classes is not multiplied with the others. Its classes are
   first compared with the column's pivot, which is linear. After that only classes of
   different components remain to be compared, and only those whose places in the order leave
   room for the bound. They are gathered by pivot; those outside a group's largest component
   meet the others in parts of bounded size, where a product of the parts' incidence matrices
   gives all overlaps at once and only links come out. So no link is lost, and pairs of a
   large group are never listed. Columns that the sketch finds
   very frequent never meet in one task: their entries are spread, and only counts and
   pivots are aggregated.
5. Pairs of step 3 and of pivots are compared exactly, set against set.

Defined results: a null or empty text, or one without words, has an empty set, no link and its
own id as component; with fewer words than n the whole sequence is the one shingle. Rows that
repeat an id or a text are rows of their own. A null id joins a component like any other, and
the smallest id is taken over the ids that are not null. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from rollcall.llm.common import checkpoint_in, gather_spans, gram_hashes, mix, ship_package, spans, steps, text_parts, use_checkpoints, word_hashes
from rollcall.llm.components import connected_components, forest
from rollcall.session import new_scratch_path

CHUNK = 1 << 12
#: Columns that are known as frequent; 8 bytes each reach the driver and every task.
MOST_FREQUENT = 1 << 22
PORTION = 1 << 23


def gram_sets(column: pa.Array, n: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, signatures, shingles, edges) of the rows with words, a step at a time.

    A row's set is its distinct n-word shingles in order of hash, between its two edges.
    """
    for low, _, data, at in steps(column):
        words, first = word_hashes(data, at)
        grams = gram_hashes(words, n)
        rows, sets = [], []
        for row, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
            if b - a >= n:
                own = np.sort(grams[a : b - n + 1])
                new = np.ones(len(own), dtype=bool)
                np.not_equal(own[1:], own[:-1], out=new[1:])
                sets.append(own[new])
            elif b > a:
                sets.append(gram_hashes(words[a:b], b - a))
            else:
                continue
            rows.append(low + row)
        if rows:
            whole, edges = np.concatenate(sets), np.cumsum([0, *map(len, sets)])
            yield np.array(rows), signatures(whole, edges), whole, edges


def portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of ``PORTION`` bytes of text, whose shingles are held at a time."""
    for batch in batches:
        for low, high in spans(np.diff(text_parts(batch.column(0))[1]), PORTION):
            yield batch.slice(low, high - low)


def signatures(grams: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """A hash of each set between two edges."""
    with np.errstate(over="ignore"):
        totals = np.add.reduceat(mix(grams + np.uint64(7)), edges[:-1], dtype=np.uint64) + np.diff(edges).astype(np.uint64)
    return mix(totals).view(np.int64)


def required(x: Column, y: Column, percent: int) -> Column:
    """The least overlap of two sets that link, from their sizes."""
    return F.ceil((x + y) * F.lit(percent) / F.lit(100 + percent) - 1e-9)


def beyond(x: Column, percent: int) -> Column:
    """Shingles of a set that are not in its prefix."""
    return F.ceil(x * F.lit(percent) / F.lit(100) - 1e-9) - 1


LAST = np.uint64(63) << np.uint64(58)


class Order:
    """Shingle hashes to keys whose order is rough frequency, then hash; known frequent ones come last.

    ``frequent`` holds names of columns, in order; a column's name is its place in the blocks.
    """

    def __init__(self, counts: np.ndarray, n_blocks: int):
        self.level = np.floor(np.log2(np.maximum(counts, 1))).astype(np.uint64)
        self.heavy = max(6, int(np.ceil(np.log2(4 * counts.mean() + 64))))
        self.mask = np.uint64(len(counts) - 1)
        self.n_blocks = np.uint64(n_blocks)
        self.frequent = np.zeros(0, np.uint64)

    def know(self, frequent: np.ndarray) -> None:
        """Take these names as those of the frequent columns, with a bitmap of their lowest bits that most others fail."""
        self.frequent = frequent
        self.bits = np.uint64(min(26, max(13, len(frequent).bit_length() + 4)))
        low = frequent & ((np.uint64(1) << self.bits) - np.uint64(1))
        self.bitmap = np.zeros(1 << int(self.bits) - 3, np.uint8)
        np.bitwise_or.at(self.bitmap, (low >> np.uint64(3)).astype(np.int64), np.uint8(1) << (low & np.uint64(7)).astype(np.uint8))

    def keys(self, grams: np.ndarray) -> np.ndarray:
        key = (self.level[(grams & self.mask).astype(np.int64)] << np.uint64(58)) | (grams >> np.uint64(6))
        if len(self.frequent):
            low = (mix(key) >> np.uint64(32)) & ((np.uint64(1) << self.bits) - np.uint64(1))
            maybe = np.flatnonzero((self.bitmap[(low >> np.uint64(3)).astype(np.int64)] >> (low & np.uint64(7)).astype(np.uint8)) & 1)
            name = self.names(key[maybe])
            at = np.minimum(np.searchsorted(self.frequent, name), len(self.frequent) - 1)
            key[maybe[self.frequent[at] == name]] |= LAST
        return key

    def names(self, key: np.ndarray) -> np.ndarray:
        """Block and a half hash of a column."""
        h = mix(key)
        return ((h & np.uint64(0xFFFFFFFF)) % self.n_blocks) << np.uint64(32) | h >> np.uint64(32)


def set_sizes(docs: DataFrame, n: int, bits: int) -> DataFrame:
    """id, n_shingles and sig of every row, and from each task 2^bits counters of shingles by hash, in chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, dtype=np.int64)
        names = ["id", "n_shingles", "sig", "chunk", "counts"]
        for batch in batches:
            count, sig = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for rows, sigs, grams, edges in gram_sets(batch.column(1), n):
                count[rows], sig[rows] = np.diff(edges), sigs
                counts += np.bincount((grams & np.uint64((1 << bits) - 1)).astype(np.int64), minlength=1 << bits)
            none = pa.nulls(batch.num_rows, pa.int32()), pa.nulls(batch.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count), pa.array(sig), *none], names=names)
        parts = [counts[i : i + CHUNK].astype("<u4").tobytes() for i in range(0, len(counts), CHUNK)]
        none = pa.nulls(len(parts), id_kind), pa.nulls(len(parts), pa.int64()), pa.nulls(len(parts), pa.int64())
        yield pa.RecordBatch.from_arrays([*none, pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], names=names)

    kind = docs.schema["id"].dataType
    id_kind = to_arrow_type(kind)
    return docs.select("id", "text").mapInArrow(run, f"id {kind.simpleString()}, n_shingles long, sig long, chunk int, counts binary")


def frequency_sketch(chunks: DataFrame, bits: int) -> np.ndarray:
    """The counters of all tasks added up; this is what reaches the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                totals[chunk] = totals.get(chunk, 0) + np.frombuffer(counts, "<u4").astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array([t.astype("<i8").tobytes() for t in totals.values()], pa.binary())], names=["chunk", "counts"])

    rows = chunks.repartition(min((1 << bits) // CHUNK, 32), "chunk").mapInArrow(add, "chunk int, counts binary")
    totals = np.zeros(1 << bits, dtype=np.int64)
    for row in rows.collect():
        totals[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] += np.frombuffer(row["counts"], "<i8")
    return totals


def prefix_blocks(docs: DataFrame, order, n: int, percent: int, n_blocks: int) -> DataFrame:
    """Slices of the prefix matrix, packed: a row holds what a batch of documents has in a block.

    ``spread`` rows hold the very frequent columns and go to any block.
    """

    def pack(block: np.ndarray, key: np.ndarray, doc: np.ndarray, place: np.ndarray, sigs: np.ndarray, sizes: np.ndarray, spread: bool) -> list:
        rows = []
        by = np.argsort(block, kind="stable")
        names, begin = np.unique(block[by], return_index=True)
        for b, a, z in zip(names.tolist(), begin.tolist(), [*begin.tolist()[1:], len(by)], strict=True):
            pick = by[a:z]
            here, at = np.unique(doc[pick], return_inverse=True)
            rows.append((b, spread, len(here) < 1 << 16, bool(place[pick].max() < 1 << 16), sigs[here].tobytes(), sizes[here].astype("<u4").tobytes(),
                         key[pick].astype("<u8" if spread else "<u4").tobytes(), at.astype("<u2" if len(here) < 1 << 16 else "<u4").tobytes(),
                         place[pick].astype("<u2" if place[pick].max() < 1 << 16 else "<u4").tobytes()))
        return rows

    kinds = [("block", pa.int32()), ("spread", pa.bool_()), ("few", pa.bool_()), ("near", pa.bool_()), ("sigs", pa.binary()), ("sizes", pa.binary()), ("keys", pa.binary()), ("docs", pa.binary()), ("places", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = order.value
        for batch in portions(batches):
            seen: set[int] = set()
            sigs, sizes, keys = [], [], []
            for _, names, grams, edges in gram_sets(batch.column(0), n):
                every = rank.keys(grams)
                for sig, a, z in zip(names.tolist(), edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                    if sig not in seen:
                        seen.add(sig)
                        sigs.append(sig)
                        sizes.append(z - a)
                        keys.append(np.sort(every[a:z])[: z - a - -(-percent * (z - a) // 100) + 1])
            if not sigs:
                continue
            lengths = np.array([len(k) for k in keys])
            key = np.concatenate(keys)
            doc = np.repeat(np.arange(len(keys)), lengths)
            place = gather_spans(np.ones(len(keys), np.int64), lengths)  # 1, 2, ... in each prefix
            heavy = (key >> np.uint64(58)) >= np.uint64(rank.heavy)
            whole = rank.names(key)
            block, short = (whole >> np.uint64(32)).astype(np.int64), whole & np.uint64(0xFFFFFFFF)
            sig_, size_ = np.array(sigs, np.int64), np.array(sizes, np.int64)
            light = ~heavy
            rows = pack(block[light], short[light], doc[light], place[light], sig_, size_, False)
            if heavy.any():
                target = (mix(sig_.view(np.uint64))[doc[heavy]] % np.uint64(n_blocks)).astype(np.int64)
                rows += pack(target, whole[heavy], doc[heavy], place[heavy], sig_, size_, True)
            for low in range(0, len(rows), 64):
                part = list(zip(*rows[low : low + 64], strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(part, kinds, strict=True)], names=[k for k, _ in kinds])

    return docs.mapInArrow(run, "block int, spread boolean, few boolean, near boolean, sigs binary, sizes binary, keys binary, docs binary, places binary")


def frequent_columns(slices: DataFrame, n_blocks: int, wide: int, files: int) -> np.ndarray:
    """Names of the columns with more than ``wide`` classes, in order.

    Their number is bounded by ``MOST_FREQUENT``: should there be more, those of the most classes.
    A shingle left out keeps its place in the order, which costs time and loses nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                blocks.setdefault(row["block"], []).append(unpack_classes(row))
        for block, parts in blocks.items():
            key, sig = (np.concatenate(c) for c in zip(*parts, strict=True))
            by = np.lexsort((sig, key))
            key, sig = key[by], sig[by]
            new = np.ones(len(key), dtype=bool)
            new[1:] = (np.diff(key) != 0) | (np.diff(sig) != 0)
            names, count = np.unique(key[new], return_counts=True)
            many = count > wide
            yield pa.RecordBatch.from_arrays([pa.array((block << 32) + names[many]), pa.array(count[many])], names=["name", "classes"])

    dealt = slices.where("not spread").select("block", "spread", "few", "sigs", "keys", "docs").repartitionById(n_blocks, "block")
    found = checkpoint_in(dealt.mapInArrow(run, "name long, classes long"), files, light=False)
    # Level by level of the number of classes, as many as the bound lets in.
    levels = found.groupBy(F.floor(F.log2("classes")).alias("level")).agg(F.count("*").alias("n")).collect()
    room, least = MOST_FREQUENT, 64
    for row in sorted(levels, reverse=True):
        room -= row["n"]
        if room < 0:
            break
        least = row["level"]
    names = found.where(F.log2("classes") >= least).select("name").toPandas()["name"].to_numpy(np.int64)
    return np.sort(names).view(np.uint64)


def unpack_classes(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """(key, signature) of every entry of a packed row."""
    doc = np.frombuffer(row["docs"], "<u2" if row["few"] else "<u4").astype(np.int64)
    return np.frombuffer(row["keys"], "<u8" if row["spread"] else "<u4").astype(np.int64), np.frombuffer(row["sigs"], np.int64)[doc]


def unpack_slice(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, signature, size, place) of every entry of a packed row."""
    doc = np.frombuffer(row["docs"], "<u2" if row["few"] else "<u4").astype(np.int64)
    return *unpack_classes(row), np.frombuffer(row["sizes"], "<u4").astype(np.int64)[doc], np.frombuffer(row["places"], "<u2" if row["near"] else "<u4").astype(np.int64)


def multiply(key: np.ndarray, sig: np.ndarray, size: np.ndarray, place: np.ndarray, percent: int, wide: int) -> tuple[tuple, tuple]:
    """The product of one block: pairs (a, b, sizes, overlap), and the entries of wide columns."""
    by = np.lexsort((sig, key))
    key, sig, size, place = key[by], sig[by], size[by], place[by]
    new = np.ones(len(key), dtype=bool)  # copies in other batches give the same entries again
    new[1:] = (np.diff(key) != 0) | (np.diff(sig) != 0)
    key, sig, size, place = key[new], sig[new], size[new], place[new]
    begin = np.flatnonzero(np.diff(key, prepend=-1) != 0)
    count = np.diff(np.append(begin, len(key)))
    left, right = [], []
    for m in np.unique(count[(count > 1) & (count <= wide)]).tolist():
        rows = begin[count == m][:, None]
        i, j = np.triu_indices(m, 1)
        left.append((rows + i).ravel())
        right.append((rows + j).ravel())
    at = np.repeat(count > wide, count)
    columns = key[at], sig[at], size[at], place[at]
    if not left:
        none = np.zeros(0, np.int64)
        return (none, none, none, none, none), columns
    left, right = np.concatenate(left), np.concatenate(right)
    fits = percent * np.maximum(size[left], size[right]) <= 100 * np.minimum(size[left], size[right])
    left, right = left[fits], right[fits]
    names, number = np.unique(sig, return_inverse=True)
    size_of = np.zeros(len(names), np.int64)
    size_of[number] = size
    pair, overlap = np.unique(number[left] * len(names) + number[right], return_counts=True)
    a, b = pair // max(len(names), 1), pair % max(len(names), 1)
    return (names[a], names[b], size_of[a], size_of[b], overlap), columns


def block_products(slices: DataFrame, n_blocks: int, percent: int, wide: int) -> DataFrame:
    """kind 0: a pair a, b with sizes x, y and overlap c. kind 1: an entry of a wide column a: class b, size x, place y."""

    def batch_of(kind: int, a, b, x, y, c) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(a), kind, np.int32)), pa.array(a), pa.array(b), *(pa.array(v.astype(np.int32)) for v in (x, y, c))], names=["kind", "a", "b", "x", "y", "c"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                key, sig, size, place = unpack_slice(row)
                if row["spread"]:
                    yield batch_of(1, key, sig, size, place, np.zeros(len(key)))
                else:
                    blocks.setdefault(row["block"], []).append((key, sig, size, place))
        for block, parts in blocks.items():
            pairs, (key, sig, size, place) = multiply(*(np.concatenate(c) for c in zip(*parts, strict=True)), percent, wide)
            for low in range(0, len(pairs[0]), 1 << 16):
                yield batch_of(0, *(v[low : low + (1 << 16)] for v in pairs))
            yield batch_of(1, key + (block << 32), sig, size, place, np.zeros(len(key)))

    dealt = slices.repartitionById(n_blocks, "block")
    return dealt.mapInArrow(run, "kind int, a long, b long, x int, y int, c int")


def bitmap(values: DataFrame, bits: int) -> np.ndarray:
    """2^bits bits with those of the values set; a value's bit is its lowest ``bits`` bits."""
    word = F.shiftrightunsigned(F.col("v").bitwiseAND((1 << bits) - 1), 6)
    rows = values.select(word.alias("w"), F.expr("shiftleft(1L, cast(v & 63 as int))").alias("one")).groupBy("w").agg(F.bit_or("one").alias("ones")).toPandas()
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    out[rows["w"].to_numpy(np.int64)] = rows["ones"].to_numpy(np.int64)
    return out.view(np.uint64)


def class_sets(docs: DataFrame, classes: DataFrame, n: int, bits: int, width: int) -> DataFrame:
    """sig, grams (``width`` bytes of each hash, in order) of the classes ``v``, and of some others.

    Sets are made again from the texts, for the classes that a bitmap of fixed size lets pass.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(classes.distinct(), bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for batch in portions(batches):
            sigs, sets, seen = [], [], set()
            for _, names, grams, edges in gram_sets(batch.column(0), n):
                low = names.view(np.uint64) & np.uint64((1 << bits) - 1)
                for i in np.flatnonzero((words[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63))) & np.uint64(1)).tolist():
                    sig, own = int(names[i]), grams[edges[i] : edges[i + 1]]
                    if sig not in seen:
                        seen.add(sig)
                        sigs.append(sig)
                        sets.append((own if width == 8 else own >> np.uint64(32)).astype(f"<u{width}").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(sigs, pa.int64()), pa.array(sets, pa.binary())], names=["sig", "grams"])

    # A class that several batches hold comes from each; one of its equal sets is kept.
    return docs.mapInArrow(run, "sig long, grams binary").dropDuplicates(["sig"])


def compared(docs: DataFrame, pairs: DataFrame, n: int, percent: int, bits: int, width: int, files: int) -> DataFrame:
    """The pairs a, b whose sets may link, by ``width`` bytes of each hash; ``sure`` where they do.

    Shortened hashes of different shingles may be equal, so an overlap found is never too
    small; a pair is sure when it is above the bound by more than chance can add.
    """
    kind = f"<u{width}"
    # Both sides' sets are made in one pass over the texts.
    sets = checkpoint_in(class_sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("v")), n, bits, width), files, light=True)
    sides = {side: sets.select(F.col("sig").alias(f"s{side}"), F.col("grams").alias(f"g{side}")) for side in ("a", "b")}

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, sure = [], []
            for ga, gb in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(ga.as_buffer(), kind), np.frombuffer(gb.as_buffer(), kind)
                if len(x) > len(y):
                    x, y = y, x
                need = -(-percent * (len(x) + len(y)) // (100 + percent))
                overlap = 0
                if need <= len(x):
                    overlap = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                # Equal by chance: a Poisson number of this mean, above the slack with a chance below 1e-12.
                mean = len(x) * len(y) / 2.0 ** (8 * width)
                keep.append(overlap >= need)
                sure.append(width == 8 or overlap >= need + 4 + int(4 * mean + 12 * mean**0.5))
            rows = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sure, pa.bool_())], names=["a", "b", "sure"])
            yield rows.filter(pa.array(keep, pa.bool_()))

    joined = pairs.select("a", "b").join(sides["b"], F.col("b") == F.col("sb")).join(sides["a"], F.col("a") == F.col("sa"))
    return joined.select("a", "b", "ga", "gb").mapInArrow(compare, "a long, b long, sure boolean")


def exact_links(docs: DataFrame, pairs: DataFrame, n: int, percent: int, bits: int, files: int) -> DataFrame:
    """The pairs a, b that link: by half of each hash, and the few left open by the whole of it."""
    rough = checkpoint_in(compared(docs, pairs, n, percent, bits, 4, files), files, light=False)
    left = rough.where("not sure").select("a", "b")
    links = rough.where("sure").select("a", "b")
    return links if left.isEmpty() else checkpoint_in(links.unionByName(compared(docs, left, n, percent, bits, 8, files).select("a", "b")), files, light=False)


def with_pivots(columns: DataFrame) -> DataFrame:
    """Every entry of the wide columns with p, the column's pivot.

    The pivot is the least signature after one of two masks, so columns of the same classes
    mostly share it, and a pivot stands for many columns.
    """
    mask = F.when(F.col("a") % 2 == 0, F.lit(0)).otherwise(F.lit(0x5DEECE66D5DEECE6))
    pivots = columns.groupBy(F.col("a").alias("k")).agg(F.min(F.col("b").bitwiseXOR(mask)).alias("m"))
    return columns.join(pivots, F.col("a") == F.col("k")).select("a", "b", "x", "y", F.col("m").bitwiseXOR(mask).alias("p"))


def in_parts(batches: Iterator[pa.RecordBatch], keys: int, meet) -> Iterator[pa.RecordBatch]:
    """What ``meet`` makes of each run of rows that agree in the first ``keys`` columns."""
    group, held = None, []
    for batch in batches:
        spot = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(keys)])
        edges = np.flatnonzero((np.diff(spot, axis=1) != 0).any(axis=0)) + 1
        for low, high in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows], strict=True):
            if low == high:
                continue
            here = tuple(spot[:, low].tolist())
            if held and here != group:
                yield meet(held)
                held = []
            group = here
            held.append(batch.slice(low, high - low))
    if held:
        yield meet(held)


def has_partner(size: np.ndarray, reach: np.ndarray, root: np.ndarray, sizes: np.ndarray, reaches: np.ndarray, roots: np.ndarray) -> np.ndarray:
    """Which entries have one of another root among the second ones, each of a size within the other's reach.

    The second ones are taken in order of size, keeping the farthest reach and the farthest one of another root.
    """
    by = np.argsort(sizes, kind="stable")
    first, root_, second, steps_ = -1 << 62, 0, -1 << 62, []
    for u, r in zip(reaches[by].tolist(), roots[by].tolist(), strict=True):
        if r == root_ and steps_:
            first = max(first, u)
        elif u > first:
            first, root_, second = u, r, first
        else:
            second = max(second, u)
        steps_.append((first, root_, second))
    far, whose, other = (np.array(c, np.int64) for c in zip(*steps_, strict=True))
    at = np.searchsorted(sizes[by], reach, side="right") - 1
    best = np.where(whose[at] != root, far[at], other[at])
    return (at >= 0) & (best >= size)


def open_groups(entries: DataFrame, roots: DataFrame, percent: int, part_rows: int, files: int = 1) -> DataFrame:
    """p, b, root: the classes that may still link to one of another component in a column of pivot p.

    In a column two sets can reach the bound only if what follows their places, and the column
    itself, is enough. That sets how large the other one may be, the reach of an entry, so two
    entries go together when each one's size is within the other's reach. Of all entries of one size only
    the two of the farthest reach and different components matter as partners: a column is dealt into
    parts, and each part is looked up in these, in order of size. No pairs are made.
    """
    named = entries.join(roots, F.col("b") == F.col("node"), "left").select("a", "p", "b", "x", "y", F.coalesce("root", "b").alias("root"))
    # The smaller set of a pair has the column early in its order.
    early = F.col("y") - 1 <= F.col("x") * F.lit((100 - percent) / (100 + percent))
    mixed = named.groupBy(F.col("a").alias("k")).agg(F.count("*").alias("m"), F.min("root").alias("r"), F.max("root").alias("s"), F.max(early).alias("early"))
    mixed = mixed.where((F.col("r") != F.col("s")) & F.col("early")).select("k", F.ceil(F.col("m") / (part_rows << 8)).cast("int").alias("parts"))
    reach = F.expr(f"(1 + x - y) * {100 + percent}L div {percent} - x").alias("u")
    rows = named.join(mixed, F.col("a") == F.col("k")).select("a", "parts", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), "p", "b", F.col("x").cast("long").alias("x"), reach, "root")
    rows = checkpoint_in(rows, files, light=True)
    far = rows.groupBy("a", "x", "root").agg(F.max("u").alias("u"), F.first("parts").alias("parts"))
    farthest = Window.partitionBy("a", "x").orderBy(F.desc("u"), "root")
    far = far.withColumn("rank", F.row_number().over(farthest)).where("rank <= 2")
    far = far.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("p"), F.lit(None).cast("long").alias("b"), "x", "u", "root", F.lit(True).alias("far"))
    both = rows.select("a", "part", "p", "b", "x", "u", "root", F.lit(False).alias("far")).unionByName(far)

    def meet(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        every = pa.Table.from_batches(held)
        own, other = every.filter(pc.invert(every["far"])), every.filter(every["far"])
        one, two = ([t[c].to_numpy() for c in ("x", "u", "root")] for t in (own, other))
        return own.select(["p", "b", "root"]).filter(pa.array(has_partner(*one, *two))).combine_chunks()

    dealt = both.repartition("a", "part").sortWithinPartitions("a", "part")
    return dealt.mapInArrow(lambda batches: (b for t in in_parts(batches, 2, meet) for b in t.to_batches()), "p long, b long, root long").distinct()


def block_links(sets: list[np.ndarray], sigs: np.ndarray, roots: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between rows ``left`` and ``right`` of different components, as a forest.

    The product of their incidence matrices is added up over blocks of shingles.
    """
    size = np.array([len(x) for x in sets])
    row = np.repeat(np.arange(len(sets)), size)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(count[column] > 1)
    shared = shared[np.argsort(column[shared], kind="stable")]
    row, column = row[shared], (np.cumsum(count > 1) - 1)[column[shared]]
    overlap = np.zeros((len(left), len(right)), np.float32)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        a, b = np.searchsorted(column, [low, low + 4096])
        part = np.zeros((len(sets), 4096), np.float32)
        part[row[a:b], column[a:b] - low] = 1
        overlap += part[left] @ part[right].T
    need = -(-percent * (size[left][:, None] + size[right][None, :]) // (100 + percent))
    i, j = np.nonzero((overlap >= need) & (roots[left][:, None] != roots[right][None, :]))
    return forest(sigs[left[i]], sigs[right[j]])


def remaining_links(docs: DataFrame, named: DataFrame, n: int, percent: int, part_rows: int, bits: int, files: int) -> DataFrame:
    """Links between classes of different components within the pivots' groups.

    A group's classes outside its largest component meet all others, part by part; parts hold
    about ``part_rows`` classes, and a pair of parts is one task's unit of work. Groups of one
    component are left out before any set is made.
    """
    by_root = named.groupBy(F.col("p").alias("k"), "root").agg(F.count("*").alias("m"))
    mixed = by_root.groupBy("k").agg(F.max(F.struct("m", "root")).alias("most"), F.sum("m").alias("all")).where(F.col("all") > F.col("most.m"))
    parts = lambda m: F.ceil(m / F.lit(part_rows)).cast("int")
    mixed = mixed.select("k", F.col("most.root").alias("main"), parts(F.col("most.m")).alias("g"), parts(F.col("all") - F.col("most.m")).alias("s"))
    rows = named.join(mixed, F.col("p") == F.col("k")).withColumn("in_main", F.col("root") == F.col("main"))
    spread = F.xxhash64("b", "p")
    rows = rows.withColumn("part", F.when(F.col("in_main"), F.pmod(spread, F.col("g"))).otherwise(F.col("g") + F.pmod(spread, F.col("s"))).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.when(F.col("in_main"), F.col("g")).otherwise(F.lit(0)), F.col("g") + F.col("s") - 1)))
    rows = checkpoint_in(rows.select("p", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "b", "root"), files, light=True)
    sets = class_sets(docs, rows.select(F.col("b").alias("v")), n, bits, 8)
    full = rows.join(sets, F.col("b") == F.col("sig")).select("p", "low", "high", "part", "b", "root", "grams")

    def meet(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        low, high, part, sigs, roots_ = (np.concatenate([h.column(i).to_numpy().astype(np.int64) for h in held]) for i in range(1, 6))
        grams = [np.frombuffer(g.as_buffer(), "<u8") for h in held for g in h.column(6)]
        a, b = block_links(grams, sigs, roots_, np.flatnonzero(part == low), np.flatnonzero(part == high), percent)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return full.repartition("p", "low", "high").sortWithinPartitions("p", "low", "high").mapInArrow(lambda batches: in_parts(batches, 3, meet), "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, n: int = 5, percent: int = 75, wide: int = 16, part_rows: int = 256, sketch_bits: int = 18, frequent_rounds: int = 2, bitmap_bits: int = 24, block_docs: int = 4096, file_docs: int = 16384,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """id, n_shingles and component_id of every row of ``docs``."""
    spark = docs.sparkSession
    ship_package(spark)
    use_checkpoints(spark)
    scratch = new_scratch_path(spark, "near-duplicates")
    texts = docs.select(F.col(text_col).alias("text"))

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    set_sizes(slim, n, sketch_bits).write.parquet(f"{scratch}/nodes")
    written = spark.read.parquet(f"{scratch}/nodes")
    nodes = written.where("chunk is null").select("id", "n_shingles", "sig")

    rows = nodes.count()
    n_blocks, files = max(8, -(-rows // block_docs)), max(1, -(-rows // file_docs))  # what is kept between steps has a file per ``file_docs`` documents
    rank = Order(frequency_sketch(written.where("chunk is not null").select("chunk", "counts"), sketch_bits), n_blocks)
    for _ in range(frequent_rounds):
        order = spark.sparkContext.broadcast(rank)
        more = frequent_columns(prefix_blocks(texts, order, n, percent, n_blocks), n_blocks, wide, files)
        rank.know(np.union1d(rank.frequent, more))
        if not len(more):
            break
    order = spark.sparkContext.broadcast(rank)
    block_products(prefix_blocks(texts, order, n, percent, n_blocks), n_blocks, percent, wide).write.parquet(f"{scratch}/products")
    products = spark.read.parquet(f"{scratch}/products")
    columns = products.where("kind = 1").select("a", "b", "x", "y")

    skipped = columns.groupBy("b").agg(F.count("*").alias("skipped"))
    pairs = products.where("kind = 0").groupBy("a", "b").agg(F.max("x").alias("x"), F.max("y").alias("y"), F.sum("c").alias("c"))
    for side in ("a", "b"):
        pairs = pairs.join(skipped.select(F.col("b").alias("k"), F.col("skipped").alias(f"skipped_{side}")), F.col(side) == F.col("k"), "left").drop("k")
    most = F.col("c") + F.least(F.coalesce("skipped_a", F.lit(0)), F.coalesce("skipped_b", F.lit(0))) + F.greatest(beyond(F.col("x"), percent), beyond(F.col("y"), percent))
    pairs = pairs.where(most >= required(F.col("x"), F.col("y"), percent)).select("a", "b")

    entries = with_pivots(columns)
    pivoted = entries.where("p != b").select(F.least("p", "b").alias("a"), F.greatest("p", "b").alias("b"))
    links = exact_links(texts, checkpoint_in(pairs.unionByName(pivoted).distinct(), files, light=True), n, percent, bitmap_bits, files)
    roots = connected_components(links, files=files)
    left = checkpoint_in(open_groups(entries, roots, percent, part_rows, files), files, light=True)
    if not left.isEmpty():
        more = checkpoint_in(remaining_links(texts, left, n, percent, part_rows, bitmap_bits, files), files, light=False)
        roots = connected_components(links.unionByName(more), files=files)

    classes = nodes.where("n_shingles > 0").groupBy("sig").agg(F.min("id").alias("least"))
    rooted = classes.join(roots, F.col("sig") == F.col("node"), "left").select("sig", "least", F.coalesce("root", "sig").alias("root"))
    best = rooted.groupBy(F.col("root").alias("r")).agg(F.min("least").alias("component_id"))
    of_class = rooted.join(best, F.col("root") == F.col("r")).select(F.col("sig").alias("s"), "component_id")
    out = nodes.join(of_class, (F.col("sig") == F.col("s")) & (F.col("n_shingles") > 0), "left")
    return out.select(F.col("id").alias(id_col), "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
