"""Pfair mixing against a plain simulation."""

from __future__ import annotations

from collections import Counter

import pytest
from compare import duck, duck_result, spark_result
from pyspark.sql import functions as F

from rollcall.llm.mixing import ADDED, mix_sources, scheduled, whole_weights
from rollcall.llm.oracle import ORACLE_SQL
from rollcall.llm.queries import QUERIES


def simulate(weights, slots):
    """Earliest deadline first, one slot after another: the source of each slot, and each block's window."""
    whole, done, out = sum(weights), [0] * len(weights), []
    for slot in range(slots):
        ready = [(-(-(done[i] + 1) * whole // v), i) for i, v in enumerate(weights) if done[i] * whole // v <= slot]
        by, i = min(ready)
        out.append((i, done[i], done[i] * whole // weights[i], by))
        done[i] += 1
    return out


@pytest.mark.parametrize("weights", [{"a": 1.0}, {"a": 5.0, "b": 3.0, "c": 2.0}, {"a": 0.9, **{f"s{i}": 0.01 for i in range(10)}}, {"a": 0.0, "b": -1.0, "c": 1.0}])
def test_slots(spark, weights):
    rows = spark.createDataFrame([(s, 1, w) for s, w in weights.items()], "mix_source string, n long, w double")
    row = whole_weights(rows, 100, 1)
    nothing = F.transform("s", lambda _: F.lit(0).cast("long"))
    got = row.select(F.col("s.v").alias("weights"), scheduled(F.lit(0), nothing, 300)["ran"].alias("ran")).first()
    v, whole = got["weights"], sum(got["weights"])
    expected = simulate(v, 300)
    assert [(x["i"], x["block"]) for x in got["ran"]] == [(i, j) for i, j, _, _ in expected]
    done = [0] * len(v)
    for t, (i, _, _, by) in enumerate(expected):
        done[i] += 1
        assert t < by
        assert all(abs(n * whole - (t + 1) * x) < whole for n, x in zip(done, v, strict=True))


def documents(spark):
    rows = [(i, "big" if i % 3 == 0 else f"s{i % 7}") for i in range(900)] + [(None, "big"), (None, None), (5, None), (7, "s0"), (7, "s0")]
    return spark.createDataFrame([(i, "t", "en", s, 1, 9) for i, s in rows], "doc_id long, text string, lang string, source string, n_chars long, mix_slot int")


@pytest.mark.parametrize("bucket_rows", [20, 4096])
def test_documents(spark, bucket_rows):
    docs = documents(spark)
    mixed = mix_sources(docs, block_rows=4, bucket_rows=bucket_rows)
    assert mixed.columns == ["doc_id", "text", "lang", "source", "n_chars", *ADDED]
    rows = sorted(mixed.collect(), key=lambda r: r["mix_position"])
    assert Counter((r["doc_id"], r["source"]) for r in rows) == Counter((r["doc_id"], r["source"]) for r in docs.collect())
    assert len({r["mix_position"] for r in rows}) == len(rows)
    assert all(r["mix_release"] <= r["mix_slot"] < r["mix_deadline"] for r in rows)
    sizes = Counter(r["source"] for r in rows)
    blocks = Counter((r["source"], r["mix_block"]) for r in rows)
    for (s, b), n in blocks.items():
        assert n == min(4, sizes[s] - 4 * b)
    # While no source has run out, every prefix of whole blocks follows the weights to less than one block.
    total = sum(n**0.5 for n in sizes.values())
    order = sorted({(r["mix_slot"], r["source"]) for r in rows}, key=lambda x: x[0])
    left = Counter(s for s, _ in blocks)
    done = Counter()
    for t, (slot, s) in enumerate(order):
        if slot != t:
            break
        done[s] += 1
        for u, n in sizes.items():
            assert abs(done[u] - (t + 1) * n**0.5 / total) < 1
    assert t > min(left.values())


def test_the_order_does_not_depend_on_the_layout(spark):
    docs = documents(spark).where("doc_id is not null and doc_id != 7")
    place = lambda df, **k: {(r["doc_id"], r["source"]): r["mix_position"] for r in mix_sources(df, **k).collect()}
    assert place(docs) == place(docs.repartition(5), bucket_rows=10)


def test_given_weights(spark):
    docs = spark.createDataFrame([(i, "a" if i < 300 else "b") for i in range(400)], "doc_id long, source string")
    weights = spark.createDataFrame([("a", 0.25), ("b", 0.75), ("unused", 9.0)], "source string, weight double")
    first = sorted(mix_sources(docs, weights, block_rows=1, period=4).collect(), key=lambda r: r["mix_position"])[:100]
    assert Counter(r["source"] for r in first) == {"a": 25, "b": 75}


def test_empty(spark):
    assert mix_sources(documents(spark).where(F.lit(False))).count() == 0


def worst(spark, sizes, weights=None, **more):
    """The largest deviation in blocks from the true weights before a source runs out, and the slots until then."""
    docs = spark.range(sum(sizes.values())).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("source"))
    low, name = 0, F.lit(None).cast("string")
    for s, n in sizes.items():
        name = F.when((F.col("doc_id") >= low) & (F.col("doc_id") < low + n), s).otherwise(name)
        low += n
    given = weights and spark.createDataFrame(list(weights.items()), "source string, weight double")
    rows = mix_sources(docs.withColumn("source", name), given, **more).select("source", "mix_block", "mix_slot", "mix_release", "mix_deadline").distinct().collect()
    assert all(r["mix_release"] <= r["mix_slot"] < r["mix_deadline"] for r in rows)
    blocks, w = Counter(r["source"] for r in rows), weights or {s: n**0.5 for s, n in sizes.items()}
    order, left, done, most = {r["mix_slot"]: r["source"] for r in rows}, dict(blocks), dict.fromkeys(sizes, 0), 0
    assert len(order) == len(rows)
    for t in range(len(rows)):
        if t not in order:
            break
        done[order[t]] += 1
        most = max(most, max(abs(done[s] - (t + 1) * x / sum(w.values())) for s, x in w.items()))
    assert t >= min(left.values())
    return most, t


def test_a_hot_source_over_many_periods(spark):
    sizes = {"hot": 40_000} | {f"s{i}": 80_000 // 19 for i in range(19)}
    most, slots = worst(spark, sizes, block_rows=1)
    assert slots > 50_000 and most < 1


def test_many_sources_keep_their_weights(spark):
    sizes = {"hot": 6000} | {f"s{i}": 30 for i in range(80)}
    most, slots = worst(spark, sizes, block_rows=1, period=40)  # fewer slots in a period than sources
    assert slots > 2000 and most < 1


def test_weights_that_no_period_holds(spark):
    sizes = {"a": 3000, "b": 3000, "c": 3000}
    most, slots = worst(spark, sizes, {"a": 0.6180339887, "b": 0.3819, "c": 0.0123}, block_rows=1, period=25)
    assert slots > 4000 and most < 1


@pytest.mark.parametrize("sizes, period", [({"hot": 3000, "a": 500, "b": 400, "c": 77, "d": 2}, 50), ({f"s{i}": 40 + 37 * i for i in range(25)}, 100), ({"hot": 500, **{f"s{i:02}": 90 for i in range(30)}}, 10)])
def test_periods_beside_one_another_give_the_one_long_schedule(spark, sizes, period):
    docs = spark.createDataFrame([(i, s) for i, s in enumerate(x for s, n in sizes.items() for x in [s] * n)], "doc_id long, source string")
    rows = mix_sources(docs, block_rows=1, period=period).collect()
    counts = spark.createDataFrame([(s, n, n**0.5) for s, n in sizes.items()], "mix_source string, n long, w double")
    row = whole_weights(counts, period, 1).first()
    names, slots = [x["mix_source"] for x in row["s"]], row["periods"] * period
    assert row["periods"] > 2
    expected = {(names[i], j): (slot, r, d) for slot, (i, j, r, d) in enumerate(simulate([x["v"] for x in row["s"]], slots))}
    got = {(r["source"], r["mix_block"]): (r["mix_slot"], r["mix_release"], r["mix_deadline"]) for r in rows if r["mix_slot"] < slots}
    assert got == {k: v for k, v in expected.items() if k[1] < sizes[k[0]]}


def test_an_id_of_many_rows_is_cut_further(spark):
    rows = [(None, "x", str(i % 3)) for i in range(600)] + [(7, "x", "same")] * 300 + [(i, "y", "t") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(4)
    mixed = mix_sources(docs, block_rows=4, bucket_rows=8).collect()
    assert Counter((r["doc_id"], r["source"], r["text"]) for r in mixed) == Counter(rows)
    assert len({r["mix_position"] for r in mixed}) == len(rows)
    blocks = Counter((r["source"], r["mix_block"]) for r in mixed)
    assert all(n == 4 or (s, b) == ("y", 12) for (s, b), n in blocks.items())


def test_columns_of_any_name(spark):
    names = ["b", "s", "c", "v", "before", "length", "begin", "t_slot", "c_i", "mix_source", "mix_rank", "mix_row", "document", "count"]
    docs = spark.createDataFrame([(i, f"s{i % 3}", *([i] * len(names))) for i in range(90)], ["doc_id", "source", *names])
    mixed = mix_sources(docs, bucket_rows=8)
    assert mixed.columns == ["doc_id", "source", *names, *ADDED]
    assert sorted(tuple(r)[: len(names) + 2] for r in mixed.collect()) == sorted(tuple(r) for r in docs.collect())


def test_the_sql_agrees_for_unequal_sources(spark, tmp_path):
    sizes = {"hot": 9000, "a": 4100, "b": 1700, None: 900, "c": 333, "d": 25, "e": 1}
    rows = [s for s, n in sizes.items() for _ in range(n)]
    docs = spark.createDataFrame([(i, "t", s) for i, s in enumerate(rows)], "doc_id long, text string, source string")
    docs.toPandas().to_parquet(tmp_path / "documents.parquet")
    types, got = spark_result(QUERIES["op7_mixing"](spark, str(tmp_path)))
    wanted_types, wanted = duck_result(duck(str(tmp_path)), ORACLE_SQL["op7_mixing"])
    assert types == wanted_types and got == wanted and len(got) == len(rows)
