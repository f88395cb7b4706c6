"""Connected components of a table of links, by repeated star contraction.

Every round links each node to the smallest node it knows (large star, then small star, as
published for MapReduce), and ends when nothing changes; the number of rounds grows with the
logarithm of the longest path. Before the first round each task reduces its links to a forest.
Links stay in tables; a round's result is checkpointed in the shared folder. A node with many
links is aggregated map-side, and the join that follows is left to skew splitting.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import checkpoint_in, use_checkpoints


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from every node to the smallest of its component, for the links of one task."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        while (new[new] != new).any():
            new = new[new]
        new = new[root]
        if (new == root).all():
            break
        root = new
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def reduce_links(links: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            a, b = forest(np.concatenate([a, batch.column(0).to_numpy()]), np.concatenate([b, batch.column(1).to_numpy()]))
            if len(a) > 1_000_000:  # the rest of the task begins anew
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
                a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return links.select("a", "b").mapInArrow(run, "a long, b long")


def star(links: DataFrame, small: bool) -> DataFrame:
    """One contraction; links go from the larger node ``a`` to the smaller ``b``."""
    if small:
        least = links.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
        moved = links.join(least, F.col("a") == F.col("n")).select(F.col("b").alias("x"), "m")
        out = moved.unionByName(least.select(F.col("n").alias("x"), "m"))
    else:
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
        out = both.where("v > u").join(least, F.col("u") == F.col("n")).select(F.col("v").alias("x"), "m")
    return out.where("x != m").select(F.greatest("x", "m").alias("a"), F.least("x", "m").alias("b")).distinct()


#: Links that one task contracts in memory.
TASK_LINKS = 500_000


def connected_components(links: DataFrame, task_links: int = TASK_LINKS, files: int | None = None) -> DataFrame:
    """node, root (the smallest node of the component) of all nodes but the roots; links are longs ``a``, ``b``.

    A checkpoint has a file per task, or ``files`` at the most.
    """
    use_checkpoints(links.sparkSession)
    kept = (lambda df: checkpoint_in(df, files, light=True)) if files else (lambda df: df.checkpoint())
    links = kept(reduce_links(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))).distinct())
    while True:
        # Few links need few tasks, and what one task holds is contracted at once.
        tasks = -(-links.count() // task_links)
        if tasks <= 1:
            return reduce_links(links.repartition(1)).checkpoint().select(F.col("a").alias("node"), F.col("b").alias("root"))
        if 2 * tasks < links.rdd.getNumPartitions():
            links = kept(reduce_links(links.repartition(tasks)).distinct())
        stars = links.groupBy("a").agg(F.count("*").alias("n"), F.max("b").alias("m"))
        # Done when every node has one link and no node that is linked to has a link itself.
        busy = stars.where("n > 1").limit(1).count() or links.join(links.select(F.col("a").alias("c")), F.col("b") == F.col("c"), "left_semi").limit(1).count()
        if not busy:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        links = kept(star(star(links, small=False), small=True))
