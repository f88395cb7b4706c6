"""The queries. Each derives the registry from the supplied tables and runs one operator
over all of it."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall import fixture
from rollcall import functions as R
from rollcall.fixture import AS_OF, FIXTURE_HASH, RUN_TS
from rollcall.operators import aggregates, keys, predicates, ranges, states, windows
from rollcall.plans import batch_checks, layers, marts, quality, refresh, reports
from rollcall.schema import RAW_COLUMNS
from rollcall.session import new_scratch_path
from rollcall.sources import csv, fingerprint, ledger, merging, splits, warehouse
from rollcall.streaming import drops

EARLY_DAY = "2016-06-01"
LATER_RUNS = ("2025-09-02 00:00:00", "2025-09-03 00:00:00")

# Bytes of a leaf and children of a node of the hashed ids, small so that the tree has levels.
LEAF, CHILDREN = 1000, 4

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


class Registry:
    """The layers and marts of one scale factor, built when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def extract(self) -> DataFrame:
        return fixture.extract(self.spark, self.sf_dir)

    @cached_property
    def raw(self) -> DataFrame:
        return fixture.raw_registry(self.spark, self.sf_dir)

    @cached_property
    def base(self) -> DataFrame:
        return fixture.base_batch(self.extract)

    @cached_property
    def ledger(self) -> DataFrame:
        return fixture.ledger(self.spark, self.sf_dir)

    @cached_property
    def staged(self) -> DataFrame:
        return layers.stage(self.raw)

    @cached_property
    def cleaned(self) -> DataFrame:
        return layers.clean(self.staged, RUN_TS)

    @cached_property
    def doubled(self) -> DataFrame:
        """The staged registry with the base batch in it twice."""
        again = fixture.base_batch(self.raw)
        return layers.stage(self.raw.unionByName(again))

    @cached_property
    def dq(self) -> DataFrame:
        return marts.dq_summary(self.raw, self.staged, self.cleaned)

    def mart(self, name: str) -> DataFrame:
        return marts.MARTS[name](self.cleaned)

    def csv_folder(self, rows: DataFrame) -> str:
        path = new_scratch_path(self.spark, "extract")
        csv.write_extract(rows, path)
        return path

    def warehouse(self) -> warehouse.Warehouse:
        root = new_scratch_path(self.spark, "warehouse")
        wh = warehouse.Warehouse(root, prefix=f"w{root[-12:]}_")
        warehouse.ensure_tables(self.spark, wh)
        return wh


def query(name: str):
    def register(build: Callable[[Registry], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(Registry(spark, sf_dir))
        return build

    return register


# --- sources, load, ledger ----------------------------------------------------------


@query("a1_csv_scan")
def _(r):
    return csv.csv_scan(r.spark, r.csv_folder(r.extract))


@query("a2_content_fingerprint")
def _(r):
    return fingerprint.content_fingerprint(r.extract)


@query("a1_csv_scan_spanning")
def _(r):
    """Names that hold line ends, quotes and commas, in files that are read in small splits."""
    spark, key = r.spark, "spark.sql.files.maxPartitionBytes"
    name = F.concat(F.lit('a "b",\n'), "first_name", F.lit('\n"c"'))
    path = r.csv_folder(r.extract.withColumn("first_name", name))
    # The splits of a plan are made when its files are listed, so it is written before the setting goes back.
    kept, out = spark.conf.get(key), new_scratch_path(spark, "spanning")
    spark.conf.set(key, "16k")
    try:
        csv.csv_scan(spark, path).write.parquet(out)
    finally:
        spark.conf.set(key, kept)
    return spark.read.parquet(out)


@query("a2_byte_fingerprint")
def _(r):
    """The ids in ascending order, a line each, hashed by leaves of 1,000 bytes."""
    path = new_scratch_path(r.spark, "lines")
    ids = r.extract.select(F.trim("id").alias("value")).repartition(1).sortWithinPartitions(F.col("value").cast("bigint"))
    ids.write.option("lineSep", "\n").text(path)
    return splits.file_hashes(r.spark, path, leaf=LEAF, children=CHILDREN).select("n_bytes", "digest")


@query("a3_source_row_count")
def _(r):
    return csv.source_row_count(csv.csv_scan(r.spark, r.csv_folder(r.extract)))


@query("a4_change_gate")
def _(r):
    return ledger.change_gate(r.ledger.select("file_hash"), r.ledger)


@query("a5_stamp_batch")
def _(r):
    return ledger.stamp_batch(r.extract, RUN_TS, FIXTURE_HASH)


@query("a6_load_unseen_keys")
def _(r):
    return keys.load_unseen_keys(r.extract, r.base)


@query("a7_key_guard")
def _(r):
    return keys.key_violations(r.base.unionByName(r.extract))


@query("a7_key_guard_dedupe")
def _(r):
    return keys.key_guard(r.base.unionByName(r.extract), r.base, mode="dedupe")


@query("a7_key_guard_dedupe_unequal")
def _(r):
    """Keys with two records that differ: the smaller record by all columns stays."""
    other = r.extract.withColumn("first_name", F.when(F.trim("id").cast("bigint") % 2 == 0, F.lit("Z")).otherwise(F.lit("A")))
    return keys.key_guard(r.extract.unionByName(other), r.base, mode="dedupe")


@query("a8_append_sink")
def _(r):
    wh = r.warehouse()
    for rows, name in ((r.base, "first"), (r.extract, "second")):
        refresh.load_batch(r.spark, wh, ledger.stamp_batch(rows, RUN_TS, name))
    return r.spark.table(wh.raw_table)


@query("a8_merged_batches")
def _(r):
    wh = r.warehouse()
    third = r.extract.withColumn("id", F.concat("id", F.lit("-3")))
    for rows, name in ((r.base, "first"), (r.extract, "second"), (third, "third")):
        refresh.load_batch(r.spark, wh, ledger.stamp_batch(rows, RUN_TS, name))
        if name != "third":
            merging.merge_batches(r.spark, wh)
    counted = warehouse.read_raw(r.spark, wh).groupBy("source_file_hash")
    return counted.agg(F.count("*").alias("n_records"), F.countDistinct("id").alias("n_ids"))


@query("a9_audit_record")
def _(r):
    first = ledger.stamp_batch(r.base, RUN_TS, "first")
    second = ledger.stamp_batch(keys.load_unseen_keys(r.extract, r.base), RUN_TS, "second")
    rows = csv.source_row_count(r.extract).first()["file_row_count"]
    target = first.unionByName(second)
    record = ledger.audit_record(target, "second", "/drops/second.csv", rows, RUN_TS, "run-2")
    return record.drop("ingestion_id", "ingested_at")


@query("a10_last_audit")
def _(r):
    return ledger.last_audit(r.ledger)


@query("a11_audit_history")
def _(r):
    return ledger.audit_history(r.ledger)


@query("a13_run_refresh")
def _(r):
    wh = r.warehouse()
    base, full = r.csv_folder(r.base), r.csv_folder(r.extract)
    for source, at in ((base, RUN_TS), (full, LATER_RUNS[0]), (full, LATER_RUNS[1])):
        refresh.run_refresh(r.spark, wh, source, at)
    columns = ("file_hash", "file_row_count", "inserted_row_count", "load_status", "ingested_at")
    return r.spark.table(wh.ledger_table).select(*columns)


def _two_days(r) -> warehouse.Warehouse:
    wh = r.warehouse()
    for rows, at, name in ((r.base, RUN_TS, "first"), (r.extract, LATER_RUNS[0], "second")):
        refresh.load_batch(r.spark, wh, ledger.stamp_batch(rows, at, name))
        refresh.rebuild_layers(r.spark, wh, at, batch=name)
    return wh


@query("a13_second_day_by_batch")
def _(r):
    return warehouse.read_mart(r.spark, _two_days(r), "engagement_metrics")


@query("a14_named_run")
def _(r):
    """Totals of the first of two runs, read after the second."""
    wh = _two_days(r)
    first = warehouse.read_cleaned(r.spark, wh, run=1)
    dq = warehouse.read_mart(r.spark, wh, "dq_summary", run=1).select("raw_count", "missing_data_count")
    return aggregates.one_row(dq, first.agg(F.count("*").alias("n_cleaned")))


def _from_batches(r, name: str) -> DataFrame:
    """A mart from the cells of three batches."""
    batch = (F.trim("voter_id").cast("bigint") % 3).cast("string")
    plan = marts.CELL_MARTS[name]
    cells = plan.cells(r.cleaned.withColumn("source_file_hash", batch), ("source_file_hash",))
    return plan.made_of(marts.merged_cells(cells, plan.keys))


@query("e2_state_summary_from_batches")
def _(r):
    return _from_batches(r, "state_summary")


@query("e3_party_distribution_from_batches")
def _(r):
    return _from_batches(r, "party_distribution")


@query("e4_engagement_metrics_from_batches")
def _(r):
    return _from_batches(r, "engagement_metrics")


@query("e5_demographic_crosstab_from_batches")
def _(r):
    return _from_batches(r, "demographic_crosstab")


@query("f3_registration_trends_from_batches")
def _(r):
    return _from_batches(r, "registration_trends")


@query("e11_dq_summary_from_batches")
def _(r):
    batch = (F.trim("id").cast("bigint") % 3).cast("string")
    raw = r.raw.withColumn("source_file_hash", batch)
    cleaned = layers.clean(layers.stage(raw), RUN_TS)
    return marts.dq_summary_of_cells(marts.total_cells(raw, cleaned, ("source_file_hash",)))


@query("a14_materialize_layer")
def _(r):
    wh = r.warehouse()
    for version in (layers.clean(layers.stage(fixture.base_batch(r.raw)), RUN_TS), r.cleaned):
        warehouse.publish(r.spark, wh, version, wh.intermediate, warehouse.CLEANED)
    later = warehouse.Warehouse(wh.root, prefix=f"later_{wh.prefix}")
    warehouse.ensure_tables(r.spark, later)
    return r.spark.table(later.cleaned_table)


@query("a15_raw_count")
def _(r):
    return r.raw.agg(F.count("*").alias("raw_voter_rows"))


# --- staging ------------------------------------------------------------------------


@query("b1_filter_null_key")
def _(r):
    return predicates.filter_null_key(r.raw).select("id", "first_name", "last_name")


@query("b2_trim_text")
def _(r):
    return r.staged.select("voter_id", "first_name", "last_name", "state_raw", "party")


@query("b3_trim_upper")
def _(r):
    return r.staged.select("voter_id", "gender")


@query("b4_trim_lower")
def _(r):
    return r.staged.select("voter_id", "email")


@query("b5_safe_int_cast")
def _(r):
    return r.raw.select("id", F.col("age").alias("age_text"), R.safe_int_cast("age").alias("age"))


@query("b6_rename_passthrough")
def _(r):
    return r.staged.select(
        "voter_id", "registered_date_raw", "last_voted_date_raw", "updated_at_raw",
        "load_timestamp", "source_file_hash",
    )


@query("b_staged_layer")
def _(r):
    return r.staged


# --- cleaning rules -----------------------------------------------------------------


@query("c1_default_if_null")
def _(r):
    return r.staged.select(
        "voter_id",
        R.default_if_null("first_name").alias("first_name"),
        R.default_if_null("last_name").alias("last_name"),
    )


@query("c2_bounded_or_null")
def _(r):
    return r.staged.select("voter_id", R.bounded_or_null("age").alias("age"))


@query("c3_out_of_range_flag")
def _(r):
    return r.staged.select("voter_id", R.out_of_range_flag("age").alias("has_invalid_age"))


@query("c4_normalize_category")
def _(r):
    return r.staged.select("voter_id", R.normalize_gender("gender").alias("gender"))


@query("c5_standardize_state")
def _(r):
    return r.staged.select(
        "voter_id", "state_raw", R.standardize_state("state_raw").alias("state_code")
    )


@query("c6_email_plausible")
def _(r):
    return r.staged.select("voter_id", "email", R.email_plausible("email").alias("is_valid_email"))


@query("c7_parse_flexible_date")
def _(r):
    texts = F.array("registered_date_raw", "last_voted_date_raw", "updated_at_raw")
    each = r.staged.select("voter_id", F.explode(texts).alias("date_text"))
    return each.withColumn("parsed", R.parse_flexible_date("date_text"))


def _parsed(r, name):
    return r.staged.select("voter_id", R.parse_flexible_date(f"{name}_raw").alias(name))


@query("c8_parse_registered")
def _(r):
    return _parsed(r, "registered_date")


@query("c8_parse_last_voted")
def _(r):
    return _parsed(r, "last_voted_date")


@query("c8_parse_updated")
def _(r):
    return _parsed(r, "updated_at")


@query("c9_missing_data_flag")
def _(r):
    return r.cleaned.select("voter_id", "has_missing_data")


@query("c10_stamp_processed")
def _(r):
    return r.cleaned.select("voter_id", "processed_at")


@query("c_cleaned_layer")
def _(r):
    return r.cleaned


@query("c11_engagement_cohort")
def _(r):
    cohort = R.engagement_cohort("registered_date").alias("registration_cohort")
    return r.cleaned.select("voter_id", cohort)


@query("c12_recency_status")
def _(r):
    return r.cleaned.select("voter_id", R.recency_status("last_voted_date").alias("voter_status"))


@query("c13_engagement_score")
def _(r):
    score = R.engagement_score(R.recency_status("last_voted_date")).alias("engagement_score")
    return r.cleaned.select("voter_id", score)


@query("c14_age_generation")
def _(r):
    return r.cleaned.select("voter_id", R.age_generation("age").alias("generation"))


@query("c15_years_since")
def _(r):
    return r.cleaned.select(
        "voter_id", R.years_since("registered_date", AS_OF).alias("years_registered")
    )


@query("c16_days_since")
def _(r):
    return r.cleaned.select(
        "voter_id", R.days_since("last_voted_date", AS_OF).alias("days_since_last_vote")
    )


@query("c17_month_floor")
def _(r):
    return r.cleaned.select(
        "voter_id", R.month_floor("registered_date").alias("registration_month")
    )


@query("c18_pct_of")
def _(r):
    counted = r.cleaned.groupBy("party", "state_code").agg(
        F.count("*").alias("total"),
        R.conditional_count(F.col("is_valid_email")).alias("valid"),
        R.conditional_count(F.col("has_invalid_age")).alias("invalid_age"),
    )
    return counted.select(
        "party",
        "state_code",
        R.pct_of("valid", "total").alias("valid_pct"),
        R.pct_of("invalid_age", "total", 2).alias("invalid_age_pct"),
        R.pct_of("total", F.col("valid") - F.col("valid")).alias("of_nothing"),
    )


# --- predicates ---------------------------------------------------------------------


@query("d1_filter_flag")
def _(r):
    return predicates.filter_flag(r.cleaned, "has_missing_data").select("voter_id", "state_code")


@query("d2_filter_not_null")
def _(r):
    rows = predicates.filter_not_null(r.cleaned, "registered_date")
    return rows.select("voter_id", "registered_date")


@query("d3_filter_since")
def _(r):
    rows = predicates.filter_since(r.cleaned, "registered_date", "2015-01-01")
    return rows.select("voter_id", "registered_date")


@query("d4_filter_half_open")
def _(r):
    rows = predicates.filter_half_open(r.cleaned, "last_voted_date", "2022-01-01", "2024-01-01")
    return rows.select("voter_id", "last_voted_date")


@query("d5_between_in")
def _(r):
    rows = r.cleaned.where(F.col("age").between(30, 44) & F.col("gender").isin("M", "F"))
    return rows.select("voter_id", "age", "gender")


@query("d6_having_min_count")
def _(r):
    counted = r.cleaned.groupBy("gender", "party", "state_code").agg(
        F.count("*").alias("voter_count")
    )
    return predicates.having_min_count(counted, "voter_count", 5)


@query("d7_issue_rows_missing")
def _(r):
    return reports.missing_data_rows(r.cleaned)


@query("d7_issue_rows_age")
def _(r):
    return reports.invalid_age_rows(r.cleaned)


@query("d7_issue_rows_email")
def _(r):
    return reports.invalid_email_rows(r.cleaned)


@query("d8_date_range_slice")
def _(r):
    rows = predicates.date_range_slice(r.cleaned, "registered_date", "2016-01-01", "2018-12-31")
    return rows.select("voter_id", "registered_date")


@query("d9_optional_membership")
def _(r):
    rows = predicates.optional_membership(r.cleaned, "state_code", ["CA", "TX"])
    return rows.select("voter_id", "state_code")


@query("d9_optional_membership_all")
def _(r):
    return predicates.optional_membership(r.cleaned, "state_code", []).select(
        "voter_id", "state_code"
    )


# --- aggregates and marts -----------------------------------------------------------


@query("e1_conditional_count")
def _(r):
    return r.cleaned.groupBy("state_code").agg(
        R.conditional_count(F.col("gender") == "M").alias("male_voters"),
        R.conditional_count(F.col("age").between(18, 29)).alias("age_18_29"),
    )


@query("e1_conditional_count_empty")
def _(r):
    nobody = r.cleaned.where(F.col("age") > 120)
    return nobody.agg(R.conditional_count(F.col("gender") == "M").alias("male_voters"))


@query("e2_state_summary")
def _(r):
    return r.mart("state_summary")


@query("e3_party_distribution")
def _(r):
    return r.mart("party_distribution")


@query("e4_engagement_metrics")
def _(r):
    return r.mart("engagement_metrics")


@query("e5_demographic_crosstab")
def _(r):
    return r.mart("demographic_crosstab")


@query("e6_count_distinct")
def _(r):
    return aggregates.count_distinct(r.cleaned, ["party"], "state_code", "states_represented")


@query("e7_exact_median")
def _(r):
    return aggregates.exact_median(r.cleaned, ["party"], "age", "median_age")


@query("e7_approximate_median")
def _(r):
    return aggregates.approximate_median(r.cleaned, ["party"], "age", "median_age")


@query("e8_ordered_mode")
def _(r):
    return aggregates.ordered_mode(r.cleaned, ["gender"], "state_code", "most_common_state")


def _in_thirds(rows: DataFrame, number: Column, make) -> list[DataFrame]:
    """The state of each of three batches."""
    return [make(rows.where(F.pmod(number, F.lit(3)) == n)) for n in range(3)]


@query("e6_count_distinct_merged")
def _(r):
    """Customers of each priority, from bitmaps of three batches of orders."""
    orders = r.spark.read.parquet(f"{r.sf_dir}/orders.parquet")
    by = ["o_orderpriority"]
    parts = _in_thirds(orders, F.col("o_orderkey"), lambda b: states.bitmap_state(b, by, "o_custkey"))
    return states.distinct_of_bitmaps(states.merged_bitmaps(parts, by), by, "n_customers")


@query("e8_ordered_mode_merged")
def _(r):
    """Results of each gender from the value counts of three batches."""
    by, value = ["gender"], "state_code"
    number = F.col("voter_id").cast("bigint")
    parts = _in_thirds(r.cleaned, number, lambda b: states.counts_state(b, by, value))
    counts = states.merged_counts(parts, by, value)
    return states.of_counts(
        counts, by, most_common_state=states.mode_of(value), states_represented=states.distinct_of(value)
    )


@query("e9_avg")
def _(r):
    valid = F.when(F.col("is_valid_email"), 1.0).otherwise(0.0)
    return r.cleaned.groupBy("gender").agg(
        F.avg("age").alias("avg_age"), F.avg(valid).alias("email_quality_rate")
    )


@query("e10_monthly_registrations")
def _(r):
    return marts.monthly_registrations(r.cleaned)


@query("e11_dq_summary")
def _(r):
    return r.dq


# --- windows ------------------------------------------------------------------------


@query("f1_running_total")
def _(r):
    total = windows.running_total("new_registrations", "registration_month")
    months = marts.monthly_registrations(r.cleaned)
    return months.select("registration_month", total.alias("cumulative_registrations"))


@query("f2_centered_moving_avg")
def _(r):
    moving = windows.centered_moving_avg("new_registrations", "registration_month")
    months = marts.monthly_registrations(r.cleaned)
    return months.select("registration_month", moving.alias("moving_avg_registrations"))


@query("f3_registration_trends")
def _(r):
    return r.mart("registration_trends")


# --- joins --------------------------------------------------------------------------


@query("g1_anti_join_unseen")
def _(r):
    seen = layers.stage(fixture.base_batch(r.raw))
    return keys.load_unseen_keys(r.staged, seen, "voter_id").select("voter_id", "party")


@query("g2_derived_key_self_join")
def _(r):
    return marts.demographic_crosstab_joined(r.cleaned)


@query("g2_derived_key_self_join_repeated")
def _(r):
    return marts.demographic_crosstab_joined(layers.clean(r.doubled, RUN_TS))


@query("g3_one_row_cross_join")
def _(r):
    return aggregates.one_row(
        r.raw.agg(F.count("*").alias("raw_count")),
        r.staged.agg(F.count("*").alias("staged_count")),
        r.cleaned.agg(F.count("*").alias("cleaned_count")),
    )


# --- sort, top-k, preview -----------------------------------------------------------


def _ordered(name):
    @query(f"s1_ordered_{name}")
    def _(r):
        return marts.ordered_output(r.mart(name), name)


for _name in marts.MARTS:
    _ordered(_name)


@query("s2_top_states")
def _(r):
    return reports.top_states(r.mart("state_summary"))


@query("s3_last_months")
def _(r):
    return reports.last_months(r.mart("registration_trends"))


@query("s4_limit_preview")
def _(r):
    return reports.preview(r.cleaned)


@query("s4_state_preview")
def _(r):
    return marts.ordered_output(r.mart("state_summary"), "state_summary").select(
        *reports.STATE_PREVIEW
    )


@query("s4_party_preview")
def _(r):
    return r.mart("party_distribution").select(*reports.PARTY_PREVIEW)


# --- data quality -------------------------------------------------------------------


@query("j1_unique")
def _(r):
    return quality.unique_failures(r.doubled, "voter_id")


@query("j2_not_null_voter_id")
def _(r):
    return quality.not_null_failures(r.staged, "voter_id").select("voter_id", "email")


@query("j2_not_null_state_code")
def _(r):
    return quality.not_null_failures(r.cleaned, "state_code").select("voter_id", "state_raw")


@query("j2_not_null_is_valid_email")
def _(r):
    return quality.not_null_failures(r.cleaned, "is_valid_email").select("voter_id", "email")


@query("j2_not_null_registered_date")
def _(r):
    return quality.not_null_failures(r.cleaned, "registered_date").select("voter_id", "party")


@query("j3_accepted_values")
def _(r):
    return quality.accepted_values_failures(r.staged).select("voter_id", "party")


@query("j4_accepted_range")
def _(r):
    known = F.col("age").isNotNull()
    return quality.accepted_range_failures(r.cleaned, where=known).select("voter_id", "age")


@query("j4_accepted_range_staged")
def _(r):
    known = F.col("age").isNotNull()
    return quality.accepted_range_failures(r.staged, where=known).select("voter_id", "age")


@query("j5_not_future_date")
def _(r):
    rows = quality.future_date_failures(r.cleaned, "registered_date", AS_OF)
    return rows.select("voter_id", "registered_date")


@query("j5_not_future_date_early")
def _(r):
    rows = quality.future_date_failures(r.cleaned, "registered_date", EARLY_DAY)
    return rows.select("voter_id", "registered_date")


@query("j6_equal_rowcount")
def _(r):
    return quality.equal_rowcount(r.cleaned, r.staged)


@query("j6_equal_rowcount_unequal")
def _(r):
    return quality.equal_rowcount(r.cleaned, r.doubled)


@query("j7_recency")
def _(r):
    return quality.recency_failures(r.mart("registration_trends"), AS_OF)


@query("j8_check_report")
def _(r):
    return quality.check_report(r.staged, r.cleaned, r.mart("registration_trends"), AS_OF)


@query("j8_check_report_repeated")
def _(r):
    again = layers.clean(r.doubled, RUN_TS)
    return quality.check_report(r.doubled, again, r.mart("registration_trends"), AS_OF)


@query("j8_check_report_by_batch")
def _(r):
    """After a second batch whose ids differ from known ones by a blank at the end only."""
    wh = r.warehouse()
    again = r.base.withColumn("id", F.concat("id", F.lit(" ")))
    for rows, at in zip((r.extract, again), LATER_RUNS, strict=True):
        refresh.run_refresh(r.spark, wh, r.csv_folder(rows), at)
        report = batch_checks.run_checks_by_batch(r.spark, wh, AS_OF)
    return report


@query("j9_threshold_rules")
def _(r):
    return quality.threshold_rules(r.dq)


# --- reporting views ----------------------------------------------------------------


@query("k1_overview_kpis")
def _(r):
    return reports.overview_kpis(
        r.mart("party_distribution"), r.mart("engagement_metrics"), r.mart("state_summary")
    )


@query("k2_party_share")
def _(r):
    return reports.party_share(r.mart("party_distribution"))


@query("k3_status_totals")
def _(r):
    return reports.status_totals(r.mart("engagement_metrics"))


@query("k4_top_states_party_mix")
def _(r):
    return reports.top_states_party_mix(r.mart("state_summary"))


@query("k5_state_details")
def _(r):
    return reports.state_details(r.mart("state_summary"))


@query("k6_generation_totals")
def _(r):
    return reports.generation_totals(r.mart("demographic_crosstab"))


@query("k7_gender_by_party")
def _(r):
    return reports.gender_by_party(r.mart("demographic_crosstab"))


@query("k8_generation_by_party")
def _(r):
    return reports.generation_by_party(r.mart("demographic_crosstab"))


@query("k9_trend_slice")
def _(r):
    return reports.trend_slice(r.mart("registration_trends"), "2015-06-01", "2020-12-31")


@query("k10_party_trend_long")
def _(r):
    return reports.party_trend_long(reports.trend_slice(r.mart("registration_trends")))


@query("k11_dq_issue_breakdown")
def _(r):
    return reports.dq_issue_breakdown(r.dq)


@query("k12_mart_reader")
def _(r):
    wh = r.warehouse()
    name = "engagement_metrics"
    warehouse.publish(r.spark, wh, r.mart(name), wh.marts, warehouse.MART_TABLES[name])
    later = warehouse.Warehouse(wh.root, prefix=f"later_{wh.prefix}")
    warehouse.ensure_tables(r.spark, later)
    return warehouse.read_mart(r.spark, later, name, order=marts.mart_order(name))


# --- stream -------------------------------------------------------------------------


@query("l1_stream_load_unseen")
def _(r):
    wh = r.warehouse()
    folder = new_scratch_path(r.spark, "drops")
    progress = new_scratch_path(r.spark, "progress")
    for rows in (r.base, r.extract):
        csv.write_extract(rows, folder)
        drops.stream_load_unseen(r.spark, wh, folder, progress, RUN_TS).awaitTermination()
    return r.spark.table(wh.raw_table).select(*RAW_COLUMNS)


@query("l1_changed_files")
def _(r):
    """A folder whose files are replaced by others, and then left as it is."""
    wh = r.warehouse()
    folder = new_scratch_path(r.spark, "drops")
    for rows in (r.base, r.extract, None):
        if rows is not None:
            csv.write_extract(rows, folder, mode="overwrite")
        drops.load_changed_files(r.spark, wh, folder, RUN_TS)
    return r.spark.table(wh.raw_table).select(*RAW_COLUMNS)


# --- whole tables in ranges -----------------------------------------------------------


@query("f1_running_total_by_range")
def _(r):
    dated = r.cleaned.select("voter_id", "registered_date", F.lit(1).cast("bigint").alias("one"))
    return ranges.running_total_by_range(dated, "one", "registered_date", "registered_so_far").drop("one")


@query("f2_moving_avg_by_range")
def _(r):
    people = r.cleaned.select("voter_id", "registered_date", "age")
    return ranges.centered_moving_avg_by_range(people, "age", ["registered_date", "voter_id"], "avg_age_nearby", piece_rows=100)


@query("e7_exact_median_by_range")
def _(r):
    orders = r.spark.read.parquet(f"{r.sf_dir}/orders.parquet")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents")
    return ranges.exact_median_by_range(orders.select("o_orderpriority", cents), ["o_orderpriority"], "cents", "median_cents")
