"""Exact top-k by inner product, with branch and bound over a vertical layout.

Components become integers floor(256 x). Rows are dealt in shares by a hash of their id, and a share
lies in blocks that hold the components dimension by dimension. A task holds one share, and packs of
queries pass through it, block by block in the order of ids. There, partial scores are added up one
group of dimensions at a time. By the inequality of Cauchy and Schwarz the rest of a score is
at most the product of the two remaining norms, so a row whose partial score plus that bound
is below the k-th best score so far, for every query of a pack, is left out
and the surviving columns are moved together. In the first block the k-th best score of its longest
rows stands for it. Where a few rows show that a bound would leave too little out, the next group is
added up at once. What survives all groups has its exact score.

Queries and rows are both dealt, so neither side is ever whole in one place. A task is a share and a
group of queries: rows are sent to every group, packs of queries to every share, and no pair of blocks is
written. The number of groups makes these copies few; it is one where queries are few. Shares are of
bounded size.

Defined results: vectors that are null or hold a null, NaN or infinite component take no part,
neither do rows without id. Only vectors of equal length are compared. The query's own row is
the row with its id; other rows with equal vectors count. Of rows that repeat an id, the one
with the smallest vector takes part. Ties go to the smaller id. Products are added up in floats where
that is exact, below 2^24 or 2^52, beyond in 64-bit integers, and beyond 2^62 in Python's. A component or
a score outside 64 bits counts as the nearest number inside.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import mix

MOST = (1 << 63) - 1
#: Below every score: of a query that has no k-th best row yet.
NONE = -MOST - 1
#: Components of a share, and of a step in which vectors become integers.
SHARE, STEP = 24 << 20, 1 << 20
#: Queries of a pack, and queries dealt to one place.
PACK, ASKED = 512, 4096
#: Longest rows of a block that stand for all at first, and rows on which bounds are tried.
PROBE, TRIED = 256, 16
DEALT = "place int, side int, dim int, n int, ids binary, parts binary"

#: Ids, and the components of each, of equally many dimensions.
Piece = tuple[np.ndarray, np.ndarray]


def taking_part(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and vector of the rows that have both."""
    v = F.col(vector_col)
    if vectors.select(v).schema[0].dataType.simpleString() not in ("array<float>", "array<double>"):
        v = v.cast("array<double>")
    return vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where("id is not null and v is not null")


def narrowed(ids: np.ndarray, x: np.ndarray) -> Iterator[Piece]:
    """The rows by the bytes that their largest component needs, 2, 4 or 8."""
    most = np.maximum(x.max(axis=1, initial=0), -x.min(axis=1, initial=0))
    width = np.where(most < 1 << 15, 2, np.where(most < 1 << 31, 4, 8))
    for w in np.unique(width).tolist():
        yield ids[width == w], x[width == w].astype(f"i{w}")


def to_integers(ids: np.ndarray, lists: pa.ListArray) -> Iterator[Piece]:
    """Integer vectors of the rows without null, NaN or infinite component."""
    at = lists.offsets.to_numpy()
    flat = lists.values.slice(int(at[0]), int(at[-1] - at[0]))
    at = at.astype(np.int64) - at[0]
    x = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # a null is NaN
    bad, dims = ~np.isfinite(x), np.diff(at)
    if bad.any():
        before = np.concatenate([[0], np.cumsum(bad)])
        dims = np.where(before[at[1:]] > before[at[:-1]], -1, dims)
        x[bad] = 0
    # Within 64 bits, and so that the largest double below 2^63 is kept.
    with np.errstate(over="ignore"):
        x = np.floor(np.clip(x * 256, -(2.0**63 - 1024), 2.0**63 - 1024)).astype(np.int64)
    for dim in np.unique(dims[dims >= 0]).tolist():
        rows = np.flatnonzero(dims == dim)
        yield from narrowed(ids[rows], x[at[rows][:, None] + np.arange(dim)].reshape(len(rows), dim))


def smallest(ids: np.ndarray, x: np.ndarray) -> Piece:
    """The smallest row of each id."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    for d in range(x.shape[1]):
        starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        if len(starts) == len(ids):
            break
        keep = x[:, d] == np.repeat(np.minimum.reduceat(x[:, d], starts), np.diff(starts, append=len(ids)))
        if not keep.all():
            ids, x = ids[keep], x[keep]
    ids, first = np.unique(ids, return_index=True)
    return ids, x[first]


def one_of_each(pieces: list[Piece]) -> list[Piece]:
    """The rows, and of those that repeat an id the one with the smallest vector.

    A vector is smaller than a longer one that begins with it.
    """
    ids, count = np.unique(np.concatenate([p[0] for p in pieces]), return_counts=True)
    if len(ids) == count.sum():
        return pieces
    again, kept, found = ids[count > 1], [], {}
    for ids, x in pieces:
        twice = np.isin(ids, again)
        kept.append((ids[~twice], x[~twice]))
        if twice.any():
            found.setdefault(x.shape[1], []).append((ids[twice], x[twice].astype(np.int64)))
    by_dim = [smallest(*map(np.concatenate, zip(*same, strict=True))) for same in found.values()]
    ids, count = np.unique(np.concatenate([p[0] for p in by_dim]), return_counts=True)
    again, best = ids[count > 1], {}  # ids with vectors of several lengths
    for ids, x in by_dim:
        twice = np.isin(ids, again)
        kept += narrowed(ids[~twice], x[~twice])
        for i, v in zip(ids[twice].tolist(), x[twice].tolist(), strict=True):
            best[i] = min(v, best.get(i, v))
    for dim in {len(v) for v in best.values()}:
        same = {i: v for i, v in best.items() if len(v) == dim}
        kept += narrowed(np.array([*same], np.int64), np.array([*same.values()], np.int64).reshape(len(same), dim))
    return [p for p in kept if len(p[0])]


def record(rows: list[tuple[int, int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """As in DEALT, of (place, side, ids, components)."""
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
            pa.array([r[3].shape[1] for r in rows], pa.int32()), pa.array([len(r[2]) for r in rows], pa.int32()),
            pa.array([r[2].tobytes() for r in rows], pa.binary()), pa.array([r[3].tobytes() for r in rows], pa.binary()),
        ],
        names=["place", "side", "dim", "n", "ids", "parts"],
    )


def pieces_of(batch: pa.RecordBatch) -> Iterator[tuple[int, int, Piece]]:
    """(place, side, piece) of each row of DEALT."""
    for r in range(batch.num_rows):
        place, side, dim, n, ids, parts = (c[r].as_py() for c in batch.columns)
        kind = f"i{len(parts) // (dim * n)}" if dim else "i2"
        yield place, side, (np.frombuffer(ids, np.int64), np.frombuffer(parts, kind).reshape(n, dim))


def dealt(rows: DataFrame, places: int) -> DataFrame:
    """Pieces of the rows by place, a hash of the id; an id comes once at most from every step of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column("id").to_numpy(), batch.column("v")
            at = lists.offsets.to_numpy()
            low = 0
            while low < len(ids):
                high = max(low + 1, int(np.searchsorted(at, at[low] + STEP, "right")) - 1)
                high = min(high, len(ids))
                pieces, out = [*to_integers(ids[low:high], lists.slice(low, high - low))], []
                for own, x in one_of_each(pieces) if pieces else []:
                    place = (mix(own.view(np.uint64)) % np.uint64(places)).astype(np.int64)
                    order = np.argsort(place, kind="stable")
                    own, x, place = own[order], x[order], place[order]
                    starts = np.flatnonzero(np.diff(place, prepend=-1)).tolist()
                    out += [(int(place[a]), 0, own[a:b], x[a:b]) for a, b in zip(starts, [*starts[1:], len(own)], strict=True)]
                if out:
                    yield record(out)
                low = high

    return rows.mapInArrow(run, DEALT)


def packs(queries: DataFrame, places: int, groups: int) -> DataFrame:
    """Queries in packs, whose place is their group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_place: dict[int, list[Piece]] = {}
        for batch in batches:
            for place, _, piece in pieces_of(batch):
                by_place.setdefault(place, []).append(piece)
        for place, pieces in by_place.items():
            for ids, x in merged(one_of_each(pieces), PACK):
                yield record([(place % groups, 1, ids, x)])

    return dealt(queries, places).repartitionById(places, "place").mapInArrow(run, DEALT)


def merged(pieces: list[Piece], most: int) -> Iterator[Piece]:
    """Pieces of at most ``most`` rows in the order of ids, as narrow as their rows allow."""
    for dim in sorted({x.shape[1] for _, x in pieces}):
        by_width: dict[str, list[Piece]] = {}
        for ids, x in pieces:
            if x.shape[1] == dim:
                by_width.setdefault(x.dtype.str, []).append((ids, x))
        whole = [(*map(np.concatenate, zip(*same, strict=True)),) for _, same in sorted(by_width.items())]
        ids = np.concatenate([own for own, _ in whole])
        kind = np.repeat(np.arange(len(whole)), [len(own) for own, _ in whole])
        row = np.concatenate([np.arange(len(own)) for own, _ in whole])
        order = np.argsort(ids)
        for low in range(0, len(order), most):
            part = order[low : low + most]
            kinds = np.unique(kind[part]).tolist()
            out = np.empty((len(part), dim), whole[kinds[-1]][1].dtype)
            for k in kinds:
                here = kind[part] == k
                out[here] = whole[k][1][row[part[here]]]
            yield ids[part], out


def arithmetic(q: np.ndarray, x: np.ndarray) -> type:
    """What adds up the products of ``q`` and ``x`` without rounding."""
    largest = [max(int(v.max()), -int(v.min())) if v.size else 0 for v in (q, x)]
    most = largest[0] * largest[1] * len(q)
    return np.float32 if most < 2**24 else np.float64 if most < 2**52 else np.int64 if most < 2**62 else object


def at_most(scores: np.ndarray, q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """No less than the whole scores, by partial scores and the dimensions that they leave, in floats."""
    kind, off = (np.float32, 1e-6) if scores.dtype == np.float32 else (np.float64, 1e-9)
    rest_q, rest_x = (np.sqrt((v.astype(np.float64) ** 2).sum(axis=0)).astype(kind) for v in (q, x))
    rough = scores.astype(kind)
    return rough + rest_q[:, None] * rest_x * kind(1 + off) + np.abs(rough) * kind(off) + kind(1)


def cuts(q: np.ndarray, x: np.ndarray, least: np.ndarray, group: int) -> list[int]:
    """After which dimensions bounds leave out so many rows that working them out pays, tried on a few rows."""
    tried, found, left = x[:, :: max(1, x.shape[1] // TRIED)], [], 1.0
    partial = np.zeros((q.shape[1], tried.shape[1]), dtype=q.dtype)
    for low in range(group, len(q), group):
        partial += q[low - group : low].T @ tried[low - group : low]
        share = (at_most(partial, q[low:], tried[low:]) >= least[:, None]).any(axis=0).mean()
        if (left - share) * (1 - low / len(q)) >= 0.25 * left:
            found.append(low)
            left = share
    return found


def bounded_top(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int, group: int, least: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query place, row place and score of each query's k best rows, of those that score above ``least``.

    ``q`` and ``x`` have a row per dimension, and ``ids`` ascend.
    """
    dim, n = x.shape
    exact = arithmetic(q, x)
    q, x = q.astype(exact), x.astype(exact)
    own = np.minimum(np.searchsorted(ids, q_ids), n - 1)
    asks = np.flatnonzero(ids[own] == q_ids)  # queries whose own row is here
    own = own[asks]

    def ended(scores: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Whole scores within 64 bits, below all others for own rows; ``rows`` ascend."""
        if exact is object:
            scores = np.clip(scores, -MOST, MOST).astype(np.int64)
        place = np.minimum(np.searchsorted(rows, own), len(rows) - 1)
        here = rows[place] == own
        scores[asks[here], place[here]] = NONE
        return scores

    least = np.full(len(q_ids), NONE) if least is None else least
    if (least == NONE).any() and n > 2 * PROBE > 4 * k:
        length = (x.astype(np.float64) ** 2).sum(axis=0)
        rows = np.sort(np.argpartition(length, n - PROBE)[n - PROBE :])
        kth = np.partition(ended(q.T @ x[:, rows], rows), PROBE - k, axis=1)[:, PROBE - k]
        least = np.maximum(least, kth.astype(np.int64) - 1)
    floor = least.astype(np.float32 if exact is np.float32 else np.float64)
    alive, scores, low = np.arange(n), None, 0
    for high in [*(cuts(q, x, floor, group) if (least > NONE).all() else []), dim]:
        part = q[low:high].T @ (x[low:high] if len(alive) == n else x[low:high][:, alive])
        scores, low = part if scores is None else scores + part, high
        if high < dim:
            keep = (at_most(scores, q[high:], x[high:][:, alive]) >= floor[:, None]).any(axis=0)
            if not keep.all():
                alive, scores = alive[keep], scores[:, keep]
    if not len(alive):
        return alive, alive, alive
    scores = ended(scores, alive)
    limit = least.astype(scores.dtype)
    some = np.flatnonzero(scores.max(axis=1) > limit)
    if 2 * len(some) < len(scores):
        scores, limit = scores[some], limit[some]
    else:
        some = np.arange(len(scores))
    above = scores > limit[:, None]
    if len(alive) > k and np.count_nonzero(above) > 64 * k * len(some):
        kth = np.partition(scores, len(alive) - k, axis=1)[:, len(alive) - k]
        above &= scores >= kth[:, None]
    at, row = np.divmod(np.flatnonzero(above), len(alive))
    score, at, row = scores[at, row].astype(np.int64), some[at], alive[row]
    best = np.lexsort((ids[row], ~score, at))
    at, row, score = at[best], row[best], score[best]
    rank = np.arange(len(at)) - np.searchsorted(at, at)
    return at[rank < k], row[rank < k], score[rank < k]


def best_of_share(q_ids: np.ndarray, q: np.ndarray, blocks: list[Piece], k: int, group: int) -> Piece:
    """Ids and scores of each query's k best rows of all blocks, NONE where there are fewer.

    ``q`` and the components of a block have a row per dimension; ids ascend from block to block.
    """
    ids, scores = np.full((len(q_ids), k), MOST), np.full((len(q_ids), k), NONE)
    for own, x in blocks:
        # Few at a time where products may be Python's integers.
        step = PACK if q.dtype.itemsize * x.dtype.itemsize <= 8 else 64
        for low in range(0, len(q_ids), step):
            at, row, score = bounded_top(q_ids[low : low + step], q[:, low : low + step], own, x, k, group, scores[low : low + step, -1])
            if len(at):
                some, at = np.unique(at) + low, at + low
                at = np.concatenate([np.repeat(some, k), at])
                every_id, every = np.concatenate([ids[some].ravel(), own[row]]), np.concatenate([scores[some].ravel(), score])
                best = np.lexsort((every_id, ~every, at))
                rank = np.arange(len(at)) - np.searchsorted(at[best], at[best])
                best = best[rank < k]
                ids[some], scores[some] = every_id[best].reshape(-1, k), every[best].reshape(-1, k)
    return ids, scores


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, block_rows: int = 4096, group: int = 16, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best rows of ``vectors``."""
    rows, asked = taking_part(vectors, id_col, vector_col), taking_part(queries, id_col, vector_col)
    n_rows, components = rows.agg(F.count("id"), F.coalesce(F.sum(F.size("v").cast("long")), F.lit(0))).first()
    n_asked = queries.where(F.col(id_col).isNotNull()).count()
    # Copies written are rows x groups + queries x shares; of so many tasks, these numbers make them fewest.
    tasks = 4 * vectors.sparkSession.sparkContext.defaultParallelism
    groups = max(1, min(round((tasks * n_asked / max(1, n_rows)) ** 0.5), tasks, -(-n_asked // PACK)))
    shares = max(1, -(-components // SHARE), min(-(-tasks // groups), -(-n_rows // block_rows)))
    places = groups * max(1, -(-n_asked // (ASKED * groups)))
    to = ["side", "dim", "n", "ids", "parts"]
    left = dealt(rows, shares)
    if groups > 1:
        left = left.withColumn("asks", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        left = left.select((F.col("place") * groups + F.col("asks")).alias("place"), *to)
    right = packs(asked, places, groups).withColumn("meets", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    right = right.select((F.col("meets") * groups + F.col("place")).alias("place"), *to)
    met = left.unionByName(right).repartitionById(shares * groups, "place").sortWithinPartitions("place", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, pieces, blocks = -1, [], None
        for batch in batches:
            for place, side, piece in pieces_of(batch):
                if place != now:
                    now, pieces, blocks = place, [], None
                if not side:
                    pieces.append(piece)
                    continue
                if blocks is None:
                    blocks = {}
                    for ids, x in merged(one_of_each(pieces) if pieces else [], block_rows):
                        blocks.setdefault(x.shape[1], []).append((ids, np.ascontiguousarray(x.T)))
                    pieces = []
                q_ids, q = piece
                found, score = best_of_share(q_ids, q.T, blocks.get(q.shape[1], []), k, group)
                at, nth = np.nonzero(score > NONE)
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[at]), pa.array(found[at, nth]), pa.array(score[at, nth])], names=["query_id", "vec_id", "score"])

    found = met.mapInArrow(run, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
