"""Mixing sources to target weights by Pfair scheduling, with DataFrame functions only.

The rows of each source are dealt into blocks of ``block_rows``. Time has one slot per block. Among
weights of sum W, block j of a source of weight w may not run before its release floor(j W / w) and
must have run by its deadline ceil((j + 1) W / w); in each slot the released block with the earliest
deadline runs, ties to the earlier source. These windows come from the unrounded weights, so in any prefix of
the schedule every source has had its weight to less than one block, however long the input.

Time is cut into periods of ``period`` slots, worked out beside one another. What has run by the
end of a period follows from its number alone: a warm-up schedules the period from the state in which the blocks
that started earliest by deadline have run, and its last state is that of the one long schedule once the two
meet, as they do within a few slots. Each period then runs from the state before it to the state at its end.
Should a warm-up end elsewhere, a block may run a little off its window, but each still runs once.
Periods go up to where the first source runs out and every source had a block; from there on the
schedule repeats.

No row is dropped or repeated. When a source runs out its slots stay empty, and the others go
on in proportion to their weights.

A source's rows are ranked by md5 of their id, which shuffles them, in two steps: by a prefix
of the digest, long enough that a prefix has about ``bucket_rows`` rows of any source, and
within it. So a source with a third of all rows is dealt over many tasks. Where an id (or none)
occurs often, its prefix has over four times as many rows; these are cut further by a hash of
their other columns and their place in the input, which says where equal rows go.

Defined results: a null source is a source of its own; a weight of 0, a negative or missing
weight, or one under a quarter of a block in the whole mix, counts as that quarter; an empty table gives an empty result; columns of the input
called like those added are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ADDED = ("mix_block", "mix_release", "mix_deadline", "mix_slot", "mix_position")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once: transform over a one-element array names it."""
    return F.transform(F.array(value), use)[0]


def whole(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def whole_weights(counts: DataFrame, period: int, block_rows: int) -> DataFrame:
    """One row from mix_source, n and w: ``s``, the sources with whole weights v of about 2^30 in all, their sum ``v`` and ``periods``."""
    every = Window.partitionBy()  # over sources, one row each
    rows = counts.withColumn("blocks", F.ceil(F.col("n") / block_rows))
    rows = rows.withColumn("w", F.when(F.col("w") > 0, F.col("w")).otherwise(0.0)).withColumn("sum", F.sum("w").over(every))
    part = F.when(F.col("sum") > 0, F.col("w") / F.col("sum")).otherwise(0.0)
    least = 0.25 / F.greatest(F.sum("blocks").over(every), F.lit(period))
    rows = rows.withColumn("v", F.greatest(F.round(F.greatest(part, least) * 2**30), F.lit(1)).cast("long"))
    rows = rows.withColumn("all", F.sum("v").over(every))
    ends, first = F.min(F.col("blocks") * F.col("all") / F.col("v")), F.max(F.col("all") / F.col("v"))
    row = rows.agg(
        F.array_sort(F.collect_list(F.struct(F.col("mix_source").isNotNull().alias("named"), "mix_source", "v"))).alias("s"),
        F.sum("v").alias("v"), F.ceil(F.greatest(ends, first) / period).cast("long").alias("periods"),
    )
    return row.where(F.size("s") > 0)


def started(slot: Column) -> Column:
    """The blocks of each source that have run by ``slot`` if, of those begun, the earliest deadlines have: the warm-up's start."""

    def chosen(full: Column) -> Column:
        more = F.transform("s", lambda x, i: let(F.get(full, i), lambda n: F.when(
            slot * x["v"] > n * F.col("v"), F.struct(whole((n + 1) * F.col("v") + x["v"] - 1, x["v"]).alias("by"), i.alias("i")),
        )))
        left = slot - F.aggregate(full, F.lit(0).cast("long"), lambda a, x: a + x)
        last = F.when(left > 0, F.get(F.array_sort(F.filter(more, lambda x: x.isNotNull())), (left - 1).cast("int")))
        return let(more, lambda m: let(last, lambda e: F.transform(full, lambda n, i: n + F.when(F.get(m, i) <= e, 1).otherwise(0))))

    return let(F.transform("s", lambda x: whole(slot * x["v"], F.col("v"))), chosen)


def scheduled(begin: Column, done: Column, period: int, until: Column | None = None) -> Column:
    """``period`` slots from ``begin``, after the blocks in ``done``: ``done`` at their end, and what ran in each slot.

    With ``until`` only the blocks before it run; then a block that is not released runs where no other can.
    """

    def pick(done: Column, slot: Column) -> Column:
        def turn(x: Column, i: Column) -> Column:
            def of(n: Column) -> Column:
                ready = n * F.col("v") < (slot + 1) * x["v"]
                by = whole(F.when(ready, (n + 1) * F.col("v") + x["v"] - 1).otherwise(n * F.col("v")), x["v"])
                turn = F.struct((~ready).alias("early"), by.alias("by"), i.alias("i"), n.alias("block"))
                return turn if until is None else F.when(n < F.get(until, i), turn)

            return let(F.get(done, i), of)

        return F.array_min(F.filter(F.transform("s", turn), lambda x: x.isNotNull()))

    def step(state: Column, at: Column) -> Column:
        return let(
            pick(state["done"], begin + at),
            lambda chosen: F.struct(
                F.transform(state["done"], lambda n, i: n + F.when(i == chosen["i"], 1).otherwise(0)).alias("done"),
                F.concat(state["ran"], F.array(F.struct(chosen["i"].alias("i"), chosen["block"].alias("block")))).alias("ran"),
            ),
        )

    start = F.struct(done.alias("done"), F.array().cast("array<struct<i:int,block:bigint>>").alias("ran"))
    return F.aggregate(F.sequence(F.lit(0).cast("long"), F.lit(period - 1).cast("long")), start, step)


def end_of(number: Column, period: int) -> Column:
    """How many blocks of each source have run by the end of period ``number``; none before the first."""
    begin = number * period
    nothing = F.transform("s", lambda _: F.lit(0).cast("long"))
    return F.when(number < 0, nothing).otherwise(scheduled(begin, started(begin), period)["done"])


def schedule_of(row: DataFrame, period: int, parts: int, group: int = 500) -> DataFrame:
    """i, block, release, deadline and slot of every block of the periods; i is the source's place in ``s``."""
    groups = row.select("s", "v", "periods", F.explode(F.sequence(F.lit(0).cast("long"), whole(F.col("periods") - 1, F.lit(group)))).alias("g"))
    inside = F.sequence(F.col("g") * group, F.least((F.col("g") + 1) * group, F.col("periods")) - 1)
    rows = groups.repartition(parts, "g").select("s", "v", F.explode(inside).alias("k")).repartition(parts, "k")
    rows = rows.withColumn("past", end_of(F.col("k") - 1, period)).withColumn("now", end_of(F.col("k"), period))
    ran = scheduled(F.col("k") * period, F.col("past"), period, F.col("now"))["ran"]
    rows = rows.select("s", "v", "k", F.posexplode(ran).alias("at", "x"))
    weight = F.get("s", F.col("x.i"))["v"]
    return rows.select(
        F.col("x.i").alias("t_i"), F.col("x.block").alias("t_block"), (F.col("k") * period + F.col("at")).alias("t_slot"),
        whole(F.col("x.block") * F.col("v"), weight).alias("t_release"), whole((F.col("x.block") + 1) * F.col("v") + weight - 1, weight).alias("t_deadline"),
    )


def ranked(rows: DataFrame, total: int, bucket_rows: int) -> DataFrame:
    """Add ``mix_rank``, 0, 1, ... within ``mix_source``, in order of ``mix_digest`` and ``mix_tie``."""
    digits = 0
    while total > bucket_rows * 16**digits and digits < 24:
        digits += 1
    rows = rows.withColumn("mix_bucket", F.substring("mix_digest", 1, digits) if digits else F.lit(""))
    sizes = rows.groupBy("mix_source", "mix_bucket").count()
    hot = sizes.where(F.col("count") > 4 * bucket_rows).select(F.col("mix_source").alias("h_source"), F.col("mix_bucket").alias("h_bucket"), "count")
    most = hot.agg(F.max("count")).first()[0]
    if most is not None:
        finer = 1
        while most > bucket_rows * 16**finer:
            finer += 1
        here = rows["mix_source"].eqNullSafe(F.col("h_source")) & (rows["mix_bucket"] == F.col("h_bucket"))
        spread = F.concat_ws(" ", "mix_digest", F.col("mix_tie").cast("string"), F.col("mix_row").cast("string"))
        finely = F.when(F.col("h_bucket").isNotNull(), F.substring(F.md5(spread.cast("binary")), 1, finer)).otherwise("")
        rows = rows.join(hot, here, "left").withColumn("mix_bucket", F.concat("mix_bucket", finely)).drop("h_source", "h_bucket", "count")
        sizes = rows.groupBy("mix_source", "mix_bucket").count()
    before = sizes.select(
        F.col("mix_source").alias("s"), F.col("mix_bucket").alias("b"),
        (F.sum("count").over(Window.partitionBy("mix_source").orderBy("mix_bucket")) - F.col("count")).alias("before"),
    )
    place = F.row_number().over(Window.partitionBy("mix_source", "mix_bucket").orderBy("mix_digest", "mix_tie"))
    placed = rows.withColumn("mix_place", place)
    same = placed["mix_source"].eqNullSafe(F.col("s")) & (placed["mix_bucket"] == F.col("b"))
    return placed.join(before, same).withColumn("mix_rank", F.col("before") + F.col("mix_place") - 1).select("document", "mix_source", "mix_rank")


def mix_sources(
    docs: DataFrame, weights: DataFrame | None = None, power: float = 0.5, period: int = 1000, block_rows: int = 8, bucket_rows: int = 2048,
    id_col: str = "doc_id", source_col: str = "source",
) -> DataFrame:
    """All rows of ``docs`` with block, release, deadline, slot and ``mix_position``.

    Sorting by ``mix_position`` gives the mixed order; it is unique. ``weights`` has the columns ``source`` and ``weight``;
    without it, a source weighs its number of rows to ``power``. Rows travel as one column, so theirs may have any names.
    """
    kept = [c for c in docs.columns if c.lower() not in ADDED]
    hashed = [F.col(f"`{c}`") for c, kind in docs.dtypes if c in kept and "map<" not in kind and "variant" not in kind]
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in kept)).alias("document"), F.col(source_col).alias("mix_source"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")).alias("mix_digest"),
        F.xxhash64(*hashed).alias("mix_tie"), F.monotonically_increasing_id().alias("mix_row"),
    )
    counts = rows.groupBy("mix_source").agg(F.count("*").alias("n"))
    if weights is None:
        counts = counts.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(power)))
    else:
        given = weights.groupBy(F.col("source").alias("given")).agg(F.max("weight").cast("double").alias("w"))
        counts = counts.join(given, counts["mix_source"].eqNullSafe(given["given"]), "left").drop("given")
    row = whole_weights(counts, period, block_rows)

    total = docs.count()
    out = ranked(rows, total, bucket_rows).withColumn("mix_block", F.floor(F.col("mix_rank") / block_rows).cast("long"))
    # What the schedule has of each source before it repeats.
    held = row.select("s", "periods", F.posexplode(end_of(F.col("periods") - 1, period)).alias("c_i", "c"))
    held = held.select(F.get("s", F.col("c_i"))["mix_source"].alias("c_source"), "c_i", "c", (F.col("periods") * period).alias("length"))
    out = out.join(held, out["mix_source"].eqNullSafe(held["c_source"]))
    out = out.withColumn("mix_turn", F.col("mix_block") % F.col("c")).withColumn("begin", whole(F.col("mix_block"), F.col("c")) * F.col("length"))
    parts = min(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 + total // (block_rows * period))
    out = out.join(schedule_of(row, period, parts), (F.col("c_i") == F.col("t_i")) & (F.col("mix_turn") == F.col("t_block")))
    out = out.withColumns({f"mix_{c}": (F.col("begin") + F.col(f"t_{c}")).cast("long") for c in ("release", "deadline", "slot")})
    out = out.withColumn("mix_position", F.col("mix_slot") * block_rows + F.col("mix_rank") % block_rows)
    return out.select(*(F.col(f"document.`{c}`").alias(c) for c in kept), *ADDED)
