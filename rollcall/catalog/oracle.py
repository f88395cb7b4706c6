"""The same results in SQL for DuckDB, written from the meaning of each operator.

The statements share only the fixture and the fixed lookup values with the Spark side.
"""

from __future__ import annotations

from rollcall.catalog.queries import CHILDREN, EARLY_DAY, LATER_RUNS, LEAF
from rollcall.fixture import AS_OF, FIXTURE_HASH, REGISTRY_SQL, RUN_TS
from rollcall.functions.states import STATE_LOOKUP
from rollcall.schema import GENERATIONS, PARTIES, RAW_COLUMNS

PARTY_LIST = ", ".join(f"'{p}'" for p in PARTIES)
ALL_RAW = ", ".join(RAW_COLUMNS)
# What a CSV round trip leaves of the extract: empty fields come back as NULL.
AS_READ = ", ".join(f"nullif({c}, '') AS {c}" for c in RAW_COLUMNS)
SPELLINGS = ", ".join(f"('{spelling}', '{code}')" for spelling, code in STATE_LOOKUP.items())


def parsed(c: str) -> str:
    return (
        rf"CASE WHEN regexp_full_match({c}, '\d{{4}}-\d\d-\d\d([ T]\d\d:\d\d:\d\d)?') "
        rf"THEN TRY_CAST(substr({c}, 1, 10) AS DATE) "
        rf"WHEN regexp_full_match({c}, '\d\d?/\d\d?/\d{{4}}( \d\d?:\d\d:\d\d)?') "
        rf"THEN CAST(try_strptime(string_split({c}, ' ')[1], '%m/%d/%Y') AS DATE) END"
    )


def pct(part: str, whole: str, places: int = 1) -> str:
    return f"round(100.0 * {part} / nullif({whole}, 0), {places})"


def counted(condition: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {condition}) AS BIGINT)"


def per_party(suffix: str) -> str:
    return ", ".join(f"{counted(f"party = '{p}'")} AS {p.lower()}_{suffix}" for p in PARTIES)


def per_gender(suffix: str) -> str:
    return (
        f"{counted("gender = 'M'")} AS male_{suffix}, {counted("gender = 'F'")} AS female_{suffix}"
    )


def prints(table: str) -> str:
    """The content fingerprint of a relation with the raw columns."""
    fields = ", ".join(f"coalesce({c}, chr(30))" for c in RAW_COLUMNS)
    total = "coalesce(sum(CAST('0x' || substr(d, 1, 15) AS BIGINT)), 0)"
    return (
        f"SELECT sha256(CAST(count(*) AS VARCHAR) || ':' || CAST({total} AS VARCHAR)) AS file_hash, "
        f"count(*) AS file_row_count "
        f"FROM (SELECT sha256(concat_ws(chr(31), {fields})) AS d FROM {table})"
    )


def tree(text: str) -> str:
    """The hash tree over the bytes of ``text``, a relation with one ASCII value ``t``."""
    # The only node of a level is the top, and carried up.
    ups = "".join(
        f", l{k} AS (SELECT i // {CHILDREN} AS i, if((SELECT count(*) FROM l{k - 1}) = 1, any_value(h), "
        f"sha256(string_agg(h, '' ORDER BY i))) AS h FROM l{k - 1} GROUP BY i // {CHILDREN})"
        for k in range(1, 9)
    )
    return f"""
WITH file AS (SELECT t FROM {text}), l0 AS (
 SELECT k AS i, sha256(substr(t, CAST(k * {LEAF} + 1 AS BIGINT), {LEAF})) AS h FROM (SELECT t, unnest(range(0, (length(t) + {LEAF - 1}) // {LEAF})) AS k FROM file)){ups}
SELECT (SELECT length(t) FROM file) AS n_bytes, sha256((SELECT length(t) FROM file) || ':' || (SELECT h FROM l8)) AS digest"""


def staged(source: str) -> str:
    return f"""
SELECT trim(id) AS voter_id, trim(first_name) AS first_name, trim(last_name) AS last_name,
 TRY_CAST(age AS INTEGER) AS age, upper(trim(gender)) AS gender, trim(state) AS state_raw,
 trim(party) AS party, lower(trim(email)) AS email, registered_date AS registered_date_raw,
 last_voted_date AS last_voted_date_raw, updated_at AS updated_at_raw, load_timestamp,
 source_file_hash FROM {source} WHERE id IS NOT NULL"""


def cleaned(source: str) -> str:
    return f"""
SELECT voter_id, ifnull(first_name, 'UNKNOWN') AS first_name,
 ifnull(last_name, 'UNKNOWN') AS last_name,
 if(age >= 18 AND age <= 120, age, NULL) AS age,
 age IS NULL OR age < 18 OR age > 120 AS has_invalid_age,
 if(gender IN ('M', 'F', 'MALE', 'FEMALE'), gender[1], 'U') AS gender,
 code AS state_code, state_raw, party, email,
 ifnull(contains(email, '@') AND contains(email, '.') AND length(email) > 4, false)
  AS is_valid_email,
 {parsed("registered_date_raw")} AS registered_date,
 {parsed("last_voted_date_raw")} AS last_voted_date, {parsed("updated_at_raw")} AS updated_at,
 (first_name IS NULL) OR (last_name IS NULL) OR (age IS NULL) OR (code IS NULL)
  AS has_missing_data,
 load_timestamp, source_file_hash, TIMESTAMP '{RUN_TS}' AS processed_at
FROM {source} LEFT JOIN spellings ON spelling = upper(trim(state_raw))"""


def crosstab(source: str, cells: str) -> str:
    return f"""
SELECT gender, generation, party, CAST(count(*) AS BIGINT) AS voter_count,
 {pct("count(*) FILTER (WHERE last_voted_date >= '2024-01-01')", "count(*)")}
  AS participation_rate_2024,
 count(DISTINCT state_code) AS states_represented,
 mode() WITHIN GROUP (ORDER BY state_code) AS most_common_state
FROM {source} GROUP BY ALL HAVING {cells}"""


GENERATION = (
    "CASE WHEN age > 75 THEN 'silent' WHEN age >= 57 THEN 'boomer' WHEN age >= 41 THEN 'gen_x' "
    "WHEN age >= 25 THEN 'millennial' WHEN age >= 18 THEN 'gen_z' ELSE 'unknown' END"
)
COHORT = (
    "CASE WHEN year(registered_date) >= 2024 THEN '2024_new' "
    "WHEN year(registered_date) >= 2022 THEN '2022_2023' "
    "WHEN year(registered_date) >= 2020 THEN '2020_2021' "
    "WHEN year(registered_date) >= 2016 THEN '2016_2019' ELSE 'pre_2016' END"
)
STATUS = (
    "CASE WHEN last_voted_date IS NULL THEN 'never_voted' "
    "WHEN year(last_voted_date) >= 2024 THEN 'active_2024' "
    "WHEN year(last_voted_date) >= 2022 THEN 'active_2022' "
    "WHEN year(last_voted_date) >= 2020 THEN 'active_2020' ELSE 'inactive' END"
)


def score(status: str) -> str:
    return (
        f"map {{'active_2024': 100, 'active_2022': 75, 'active_2020': 50, "
        f"'never_voted': 25, 'inactive': 10}}[{status}]"
    )


# Named relations, each usable by the statements and by the relations after it.
RELATIONS = {
    "spellings": f"SELECT * FROM (VALUES {SPELLINGS}) v(spelling, code)",
    "registry": REGISTRY_SQL.format(customer="customer", orders="orders"),
    "raw": (
        f"SELECT *, TIMESTAMP '{RUN_TS}' AS load_timestamp, '{FIXTURE_HASH}' AS source_file_hash "
        "FROM registry"
    ),
    "base": "SELECT * FROM registry WHERE CAST(trim(id) AS BIGINT) % 4 <> 0",
    "doubled": "SELECT * FROM raw UNION ALL SELECT * FROM raw WHERE CAST(trim(id) AS BIGINT) % 4 <> 0",
    "stg": staged("raw"),
    "stg2": staged("doubled"),
    "cln": cleaned("stg"),
    "cln2": cleaned("stg2"),
    "loads": (
        "SELECT strftime(o_orderdate, '%Y-%m') AS m, count(*) AS file_row_count, "
        "count(*) FILTER (WHERE o_orderstatus = 'F') AS inserted_row_count FROM orders GROUP BY 1"
    ),
    "ledger": (
        "SELECT 'load-' || m AS ingestion_id, sha256(m) AS file_hash, inserted_row_count, "
        "if(inserted_row_count > 0, 'success', 'no-op') AS load_status, "
        "CAST(m || '-01 00:00:00' AS TIMESTAMP) AS ingested_at FROM loads"
    ),
    "states": f"""
SELECT state_code, count(*) AS total_voters, round(avg(age), 1) AS avg_age,
 quantile_cont(age, 0.5) AS median_age, {per_gender("voters")},
 {pct("male_voters", "total_voters")} AS male_pct,
 {pct("female_voters", "total_voters")} AS female_pct, {per_party("voters")},
 {", ".join(f"{pct(f'{p.lower()}_voters', 'total_voters')} AS {p.lower()}_pct" for p in PARTIES)},
 {counted("year(last_voted_date) >= 2024")} AS voters_2024,
 {counted("year(last_voted_date) IN (2022, 2023)")} AS voters_2022,
 round(100.0 * avg(if(is_valid_email, 1.0, 0.0)), 1) AS email_quality_pct
FROM cln WHERE NOT has_missing_data GROUP BY state_code""",
    "parties": f"""
SELECT party, count(*) AS total_voters, avg(age) AS avg_age,
 {counted("age >= 18 AND age < 30")} AS age_18_29, {counted("age >= 30 AND age < 45")} AS age_30_44,
 {counted("age >= 45 AND age < 65")} AS age_45_64, {counted("age > 64")} AS age_65_plus,
 {counted("year(last_voted_date) >= 2024")} AS active_voters_2024,
 {counted("year(registered_date) >= 2020")} AS new_registrations_since_2020
FROM cln GROUP BY party""",
    "engagement": f"""
SELECT *, CAST({score("voter_status")} AS INTEGER) AS engagement_score FROM (
 SELECT {STATUS} AS voter_status, {COHORT} AS registration_cohort, count(*) AS voter_count,
  avg(age) AS avg_age, {per_gender("count")}, {per_party("count")} FROM cln GROUP BY 1, 2)""",
    "cells": crosstab(
        f"(SELECT *, {GENERATION} AS generation FROM cln WHERE NOT has_missing_data)",
        "count(*) >= 5",
    ),
    "months": f"""
SELECT CAST(date_trunc('month', registered_date) AS DATE) AS registration_month,
 count(*) AS new_registrations, {per_party("registrations")}, avg(age) AS avg_age_at_registration
FROM cln WHERE year(registered_date) >= 2015 GROUP BY 1""",
    "trends": """
SELECT *, CAST(sum(new_registrations) OVER so_far AS BIGINT) AS cumulative_registrations,
 avg(new_registrations) OVER near AS moving_avg_registrations FROM months
WINDOW so_far AS (ORDER BY registration_month),
 near AS (ORDER BY registration_month ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)""",
    "dq": f"""
SELECT *, {pct("(cleaned_count - missing_data_count)", "raw_count", 2)} AS data_completeness_pct
FROM (SELECT (SELECT count(*) FROM raw) AS raw_count, (SELECT count(*) FROM stg) AS staged_count,
 count(*) AS cleaned_count, {counted("has_missing_data")} AS missing_data_count,
 {counted("has_invalid_age")} AS invalid_age_count,
 {counted("NOT is_valid_email")} AS invalid_email_count FROM cln)""",
}

JOINED = (
    "(SELECT a.*, b.generation FROM (SELECT * FROM {0} WHERE NOT has_missing_data) a "
    f"JOIN (SELECT voter_id, {GENERATION} AS generation FROM {{0}} WHERE NOT has_missing_data) b "
    "USING (voter_id))"
)
ISSUE_SHARE = "if(raw_count = 0, 0.0, {0} / raw_count * 100.0) AS issue_pct"


def repeated_keys(source: str) -> str:
    return (
        f"SELECT count(*) FROM (SELECT voter_id FROM {source} WHERE voter_id IS NOT NULL "
        "GROUP BY voter_id HAVING count(*) > 1)"
    )


CHECKS = {
    "staged_not_null_voter_id": "SELECT count(*) FROM stg WHERE voter_id IS NULL",
    "staged_accepted_values_party": f"SELECT count(*) FROM stg WHERE party NOT IN ({PARTY_LIST})",
    "cleaned_not_null_voter_id": "SELECT count(*) FROM cln WHERE voter_id IS NULL",
    "cleaned_accepted_range_age": "SELECT count(*) FROM cln WHERE age < 18 OR age > 120",
    "cleaned_not_null_state_code": "SELECT count(*) FROM cln WHERE state_code IS NULL",
    "cleaned_not_null_is_valid_email": "SELECT count(*) FROM cln WHERE is_valid_email IS NULL",
    "cleaned_not_null_registered_date": "SELECT count(*) FROM cln WHERE registered_date IS NULL",
    "cleaned_not_future_registered_date": (
        f"SELECT count(*) FROM cln WHERE registered_date > DATE '{AS_OF}' + INTERVAL 30 DAY"
    ),
    "staged_unique_voter_id": repeated_keys("stg"),
    "cleaned_unique_voter_id": repeated_keys("cln"),
    "trends_recency_registration_month": (
        "SELECT count(*) FROM (SELECT max(registration_month) AS newest FROM trends) "
        f"WHERE newest < DATE '{AS_OF}' - INTERVAL 1 MONTH"
    ),
    "cleaned_equal_rowcount": (
        "SELECT abs((SELECT count(*) FROM cln) - (SELECT count(*) FROM stg))"
    ),
}



def report(checks: dict[str, str]) -> str:
    lines = " UNION ALL ".join(f"SELECT '{n}' AS check_name, ({q}) AS failures" for n, q in checks.items())
    return f"""
SELECT check_name, 'warn' AS severity, failures, if(failures > 0, 'warn', 'pass') AS status
FROM ({lines})"""


CHECKS_REPEATED = {
    n: q.replace("FROM stg", "FROM stg2").replace("FROM cln", "FROM cln2") for n, q in CHECKS.items()
}

STATEMENTS = {
    "f1_running_total_by_range": """
SELECT voter_id, registered_date,
 CAST(count(*) OVER (ORDER BY registered_date NULLS FIRST RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS registered_so_far FROM cln""",
    "f2_moving_avg_by_range": """
SELECT voter_id, registered_date, age,
 avg(age) OVER (ORDER BY registered_date NULLS FIRST, voter_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS avg_age_nearby FROM cln""",
    "e7_exact_median_by_range": """
SELECT o_orderpriority, quantile_cont(CAST(round(o_totalprice * 100) AS BIGINT), 0.5) AS median_cents FROM orders GROUP BY 1""",
    "a1_csv_scan": f"SELECT {AS_READ} FROM registry",
    "a1_csv_scan_spanning": f"""
SELECT * REPLACE ('a "b",' || chr(10) || first_name || chr(10) || '"c"' AS first_name) FROM (SELECT {AS_READ} FROM registry)""",
    "a2_content_fingerprint": prints("registry"),
    "a2_byte_fingerprint": tree("(SELECT string_agg(trim(id) || chr(10), '' ORDER BY CAST(trim(id) AS BIGINT)) AS t FROM registry)"),
    "a3_source_row_count": "SELECT count(*) AS file_row_count FROM registry",
    "a4_change_gate": """
SELECT file_hash, last_hash, last_hash IS NULL OR file_hash <> last_hash AS is_new
FROM ledger, (SELECT arg_max(file_hash, ingested_at) AS last_hash FROM ledger)""",
    "a5_stamp_batch": "SELECT * FROM raw",
    "a6_load_unseen_keys": (
        "SELECT * FROM registry r WHERE NOT EXISTS (SELECT 1 FROM base WHERE base.id = r.id)"
    ),
    "a7_key_guard": (
        "SELECT id, count(*) AS n_records FROM doubled GROUP BY id "
        "HAVING count(*) > 1 OR id IS NULL"
    ),
    "a7_key_guard_dedupe": "SELECT DISTINCT * FROM registry WHERE id IS NOT NULL",
    "a7_key_guard_dedupe_unequal": f"""
SELECT {ALL_RAW} FROM (
 SELECT * FROM registry UNION ALL
 SELECT * REPLACE (if(CAST(trim(id) AS BIGINT) % 2 = 0, 'Z', 'A') AS first_name) FROM registry)
QUALIFY row_number() OVER (PARTITION BY id ORDER BY {", ".join(f"{c} NULLS FIRST" for c in RAW_COLUMNS[1:])}) = 1""",
    "a8_merged_batches": """
SELECT unnest(['first', 'second', 'third']) AS source_file_hash, unnest([b, n - b, n]) AS n_records, unnest([b, n - b, n]) AS n_ids
FROM (SELECT (SELECT count(*) FROM base) AS b, (SELECT count(*) FROM registry) AS n)""",
    "a8_append_sink": f"""
SELECT {ALL_RAW}, TIMESTAMP '{RUN_TS}' AS load_timestamp,
 if(CAST(trim(id) AS BIGINT) % 4 <> 0, 'first', 'second') AS source_file_hash FROM registry""",
    "a9_audit_record": """
SELECT 'second' AS file_hash, '/drops/second.csv' AS source_path, count(*) AS file_row_count,
 count(*) FILTER (WHERE CAST(trim(id) AS BIGINT) % 4 = 0) AS inserted_row_count,
 if(inserted_row_count > 0, 'success', 'no-op') AS load_status, 'run-2' AS dag_run_id
FROM registry""",
    "a10_last_audit": "SELECT file_hash AS last_hash FROM ledger ORDER BY ingested_at DESC LIMIT 1",
    "a11_audit_history": """
SELECT ingestion_id, file_hash, load_status, inserted_row_count, ingested_at
FROM ledger ORDER BY ingested_at DESC LIMIT 5""",
    "a13_run_refresh": f"""
SELECT file_hash, file_row_count, file_row_count AS inserted_row_count, 'success' AS load_status,
 TIMESTAMP '{RUN_TS}' AS ingested_at FROM ({prints(f"(SELECT {AS_READ} FROM base)")})
UNION ALL
SELECT file_hash, file_row_count, file_row_count - (SELECT count(*) FROM base), 'success',
 TIMESTAMP '{LATER_RUNS[0]}' FROM ({prints(f"(SELECT {AS_READ} FROM registry)")})""",
    "a13_second_day_by_batch": "SELECT * FROM engagement",
    "a14_named_run": """
SELECT count(*) AS raw_count, count(*) FILTER (has_missing_data) AS missing_data_count, count(*) AS n_cleaned
FROM cln WHERE CAST(voter_id AS BIGINT) % 4 <> 0""",
    "a14_materialize_layer": "SELECT * FROM cln",
    "a15_raw_count": "SELECT count(*) AS raw_voter_rows FROM raw",
    "b1_filter_null_key": "SELECT id, first_name, last_name FROM raw WHERE id IS NOT NULL",
    "b2_trim_text": "SELECT voter_id, first_name, last_name, state_raw, party FROM stg",
    "b3_trim_upper": "SELECT voter_id, gender FROM stg",
    "b4_trim_lower": "SELECT voter_id, email FROM stg",
    "b5_safe_int_cast": "SELECT id, age AS age_text, TRY_CAST(age AS INTEGER) AS age FROM raw",
    "b6_rename_passthrough": """
SELECT trim(id) AS voter_id, registered_date AS registered_date_raw,
 last_voted_date AS last_voted_date_raw, updated_at AS updated_at_raw, load_timestamp,
 source_file_hash FROM raw""",
    "b_staged_layer": "SELECT * FROM stg",
    "c1_default_if_null": "SELECT voter_id, first_name, last_name FROM cln",
    "c2_bounded_or_null": (
        "SELECT voter_id, if(age BETWEEN 18 AND 120, age, NULL) AS age FROM stg"
    ),
    "c3_out_of_range_flag": "SELECT voter_id, has_invalid_age FROM cln",
    "c4_normalize_category": "SELECT voter_id, gender FROM cln",
    "c5_standardize_state": "SELECT voter_id, state_raw, state_code FROM cln",
    "c6_email_plausible": "SELECT voter_id, email, is_valid_email FROM cln",
    "c7_parse_flexible_date": f"""
SELECT voter_id, date_text, {parsed("date_text")} AS parsed FROM (
 SELECT voter_id, unnest([registered_date_raw, last_voted_date_raw, updated_at_raw]) AS date_text
 FROM stg)""",
    "c8_parse_registered": "SELECT voter_id, registered_date FROM cln",
    "c8_parse_last_voted": "SELECT voter_id, last_voted_date FROM cln",
    "c8_parse_updated": "SELECT voter_id, updated_at FROM cln",
    "c9_missing_data_flag": "SELECT voter_id, has_missing_data FROM cln",
    "c10_stamp_processed": "SELECT voter_id, processed_at FROM cln",
    "c_cleaned_layer": "SELECT * FROM cln",
    "c11_engagement_cohort": f"SELECT voter_id, {COHORT} AS registration_cohort FROM cln",
    "c12_recency_status": f"SELECT voter_id, {STATUS} AS voter_status FROM cln",
    "c13_engagement_score": (
        f"SELECT voter_id, CAST({score(STATUS)} AS INTEGER) AS engagement_score FROM cln"
    ),
    "c14_age_generation": f"SELECT voter_id, {GENERATION} AS generation FROM cln",
    "c15_years_since": f"""
SELECT voter_id, CAST(year(DATE '{AS_OF}') - year(registered_date) AS INTEGER) AS years_registered
FROM cln""",
    "c16_days_since": f"""
SELECT voter_id, CAST(DATE '{AS_OF}' - last_voted_date AS INTEGER) AS days_since_last_vote
FROM cln""",
    "c17_month_floor": """
SELECT voter_id, CAST(date_trunc('month', registered_date) AS DATE) AS registration_month
FROM cln""",
    "c18_pct_of": f"""
SELECT party, state_code, {pct("count(*) FILTER (WHERE is_valid_email)", "count(*)")} AS valid_pct,
 {pct("count(*) FILTER (WHERE has_invalid_age)", "count(*)", 2)} AS invalid_age_pct,
 CAST(NULL AS DOUBLE) AS of_nothing FROM cln GROUP BY party, state_code""",
    "d1_filter_flag": "SELECT voter_id, state_code FROM cln WHERE NOT has_missing_data",
    "d2_filter_not_null": (
        "SELECT voter_id, registered_date FROM cln WHERE registered_date IS NOT NULL"
    ),
    "d3_filter_since": (
        "SELECT voter_id, registered_date FROM cln WHERE registered_date >= DATE '2015-01-01'"
    ),
    "d4_filter_half_open": (
        "SELECT voter_id, last_voted_date FROM cln WHERE year(last_voted_date) IN (2022, 2023)"
    ),
    "d5_between_in": """
SELECT voter_id, age, gender FROM cln WHERE age BETWEEN 30 AND 44 AND gender IN ('M', 'F')""",
    "d6_having_min_count": """
SELECT gender, party, state_code, count(*) AS voter_count FROM cln GROUP BY ALL
HAVING count(*) >= 5""",
    "d7_issue_rows_missing": """
SELECT voter_id, first_name, last_name, state_code, age, email, load_timestamp
FROM cln WHERE has_missing_data ORDER BY voter_id""",
    "d7_issue_rows_age": """
SELECT voter_id, age, first_name, last_name, state_code, has_invalid_age
FROM cln WHERE has_invalid_age ORDER BY voter_id""",
    "d7_issue_rows_email": """
SELECT voter_id, email, first_name, last_name, state_code
FROM cln WHERE NOT is_valid_email ORDER BY voter_id""",
    "d8_date_range_slice": """
SELECT voter_id, registered_date FROM cln
WHERE registered_date BETWEEN DATE '2016-01-01' AND DATE '2018-12-31'""",
    "d9_optional_membership": (
        "SELECT voter_id, state_code FROM cln WHERE state_code IN ('CA', 'TX')"
    ),
    "d9_optional_membership_all": "SELECT voter_id, state_code FROM cln",
    "e1_conditional_count": f"""
SELECT state_code, {counted("gender = 'M'")} AS male_voters,
 {counted("age BETWEEN 18 AND 29")} AS age_18_29 FROM cln GROUP BY state_code""",
    "e1_conditional_count_empty": """
SELECT CAST(sum(if(gender = 'M', 1, 0)) AS BIGINT) AS male_voters FROM cln WHERE age > 120""",
    "e2_state_summary": "SELECT * FROM states",
    "e2_state_summary_from_batches": "SELECT * FROM states",
    "e3_party_distribution": "SELECT * FROM parties",
    "e3_party_distribution_from_batches": "SELECT * FROM parties",
    "e4_engagement_metrics": "SELECT * FROM engagement",
    "e4_engagement_metrics_from_batches": "SELECT * FROM engagement",
    "e5_demographic_crosstab": "SELECT * FROM cells",
    "e5_demographic_crosstab_from_batches": "SELECT * FROM cells",
    "e6_count_distinct": (
        "SELECT party, count(DISTINCT state_code) AS states_represented FROM cln GROUP BY party"
    ),
    "e7_exact_median": "SELECT party, quantile_cont(age, 0.5) AS median_age FROM cln GROUP BY party",
    "e7_approximate_median": "SELECT party, quantile_disc(age, 0.5) AS median_age FROM cln GROUP BY party",
    "e8_ordered_mode": """
SELECT gender, mode() WITHIN GROUP (ORDER BY state_code) AS most_common_state
FROM cln GROUP BY gender""",
    "e6_count_distinct_merged": (
        "SELECT o_orderpriority, count(DISTINCT o_custkey) AS n_customers FROM orders GROUP BY o_orderpriority"
    ),
    "e8_ordered_mode_merged": """
SELECT gender, mode() WITHIN GROUP (ORDER BY state_code) AS most_common_state,
 count(DISTINCT state_code) AS states_represented
FROM cln GROUP BY gender""",
    "e9_avg": """
SELECT gender, avg(age) AS avg_age, avg(if(is_valid_email, 1.0, 0.0)) AS email_quality_rate
FROM cln GROUP BY gender""",
    "e10_monthly_registrations": "SELECT * FROM months",
    "e11_dq_summary": "SELECT * FROM dq",
    "e11_dq_summary_from_batches": "SELECT * FROM dq",
    "f1_running_total": "SELECT registration_month, cumulative_registrations FROM trends",
    "f2_centered_moving_avg": "SELECT registration_month, moving_avg_registrations FROM trends",
    "f3_registration_trends_from_batches": "SELECT * FROM trends",
    "f3_registration_trends": "SELECT * FROM trends ORDER BY registration_month DESC",
    "g1_anti_join_unseen": "SELECT voter_id, party FROM stg WHERE CAST(voter_id AS BIGINT) % 4 = 0",
    "g2_derived_key_self_join": crosstab(JOINED.format("cln"), "count(*) >= 5"),
    "g2_derived_key_self_join_repeated": crosstab(JOINED.format("cln2"), "count(*) >= 5"),
    "g3_one_row_cross_join": """
SELECT * FROM (SELECT count(*) AS raw_count FROM raw), (SELECT count(*) AS staged_count FROM stg),
 (SELECT count(*) AS cleaned_count FROM cln)""",
    "s1_ordered_state_summary": "SELECT * FROM states ORDER BY total_voters DESC",
    "s1_ordered_party_distribution": "SELECT * FROM parties ORDER BY total_voters DESC",
    "s1_ordered_engagement_metrics": (
        "SELECT * FROM engagement ORDER BY engagement_score DESC, voter_count DESC"
    ),
    "s1_ordered_demographic_crosstab": "SELECT * FROM cells ORDER BY generation, gender, party",
    "s1_ordered_registration_trends": "SELECT * FROM trends ORDER BY registration_month DESC",
    "s2_top_states": "SELECT * FROM states ORDER BY total_voters DESC, state_code LIMIT 10",
    "s3_last_months": """
SELECT registration_month, new_registrations, moving_avg_registrations FROM trends
ORDER BY registration_month DESC LIMIT 6""",
    "s4_limit_preview": "SELECT * FROM cln ORDER BY voter_id, email LIMIT 5",
    "s4_state_preview": """
SELECT state_code, total_voters, democrat_pct, republican_pct FROM states
ORDER BY total_voters DESC""",
    "s4_party_preview": "SELECT party, total_voters, age_18_29, active_voters_2024 FROM parties",
    "j1_unique": """
SELECT voter_id, count(*) AS n_records FROM stg2 GROUP BY voter_id HAVING count(*) > 1""",
    "j2_not_null_voter_id": "SELECT voter_id, email FROM stg WHERE voter_id IS NULL",
    "j2_not_null_state_code": "SELECT voter_id, state_raw FROM cln WHERE state_code IS NULL",
    "j2_not_null_is_valid_email": "SELECT voter_id, email FROM cln WHERE is_valid_email IS NULL",
    "j2_not_null_registered_date": "SELECT voter_id, party FROM cln WHERE registered_date IS NULL",
    "j3_accepted_values": f"SELECT voter_id, party FROM stg WHERE party NOT IN ({PARTY_LIST})",
    "j4_accepted_range": "SELECT voter_id, age FROM cln WHERE age < 18 OR age > 120",
    "j4_accepted_range_staged": "SELECT voter_id, age FROM stg WHERE age < 18 OR age > 120",
    "j5_not_future_date": f"""
SELECT voter_id, registered_date FROM cln
WHERE registered_date > DATE '{AS_OF}' + INTERVAL 30 DAY""",
    "j5_not_future_date_early": f"""
SELECT voter_id, registered_date FROM cln
WHERE registered_date > DATE '{EARLY_DAY}' + INTERVAL 30 DAY""",
    "j6_equal_rowcount": """
SELECT *, abs(count_a - count_b) AS diff_count
FROM (SELECT (SELECT count(*) FROM cln) AS count_a, (SELECT count(*) FROM stg) AS count_b)""",
    "j6_equal_rowcount_unequal": """
SELECT *, abs(count_a - count_b) AS diff_count
FROM (SELECT (SELECT count(*) FROM cln) AS count_a, (SELECT count(*) FROM stg2) AS count_b)""",
    "j7_recency": f"""
SELECT * FROM (SELECT max(registration_month) AS most_recent,
 CAST(DATE '{AS_OF}' - INTERVAL 1 MONTH AS DATE) AS threshold FROM trends)
WHERE most_recent < threshold""",
    "j8_check_report": report(CHECKS),
    "j8_check_report_repeated": report(CHECKS_REPEATED),
    "j8_check_report_by_batch": report(CHECKS_REPEATED),
    "j9_threshold_rules": """
SELECT rule, level FROM (
 SELECT 'missing_data' AS rule,
  if(raw_count > 0 AND 100.0 * missing_data_count / raw_count > 5, 'warning', NULL) AS level FROM dq
 UNION ALL SELECT 'invalid_email', if(invalid_email_count > 50, 'info', NULL) FROM dq
 UNION ALL SELECT 'completeness', if(data_completeness_pct < 95, 'error', 'success') FROM dq)
WHERE level IS NOT NULL""",
    "k1_overview_kpis": f"""
SELECT total_voters, active_voters_2024, {pct("active_voters_2024", "total_voters")} AS active_pct,
 states_represented, avg_age, avg_age_weighted
FROM (SELECT CAST(sum(total_voters) AS BIGINT) AS total_voters, round(avg(avg_age), 1) AS avg_age,
 round(sum(total_voters * avg_age) / sum(if(avg_age IS NULL, 0, total_voters)), 1) AS avg_age_weighted
 FROM parties), (SELECT CAST(sum(voter_count) FILTER (WHERE voter_status = 'active_2024') AS BIGINT)
 AS active_voters_2024 FROM engagement),
 (SELECT count(DISTINCT state_code) AS states_represented FROM states)""",
    "k2_party_share": f"""
SELECT party, total_voters, {pct("total_voters", "sum(total_voters) OVER ()")} AS share_pct
FROM parties""",
    "k3_status_totals": """
SELECT voter_status, CAST(sum(voter_count) AS BIGINT) AS voter_count FROM engagement
GROUP BY voter_status ORDER BY 2 DESC""",
    "k4_top_states_party_mix": "WITH top AS (SELECT * FROM states ORDER BY total_voters DESC, state_code LIMIT 10) "
    + " UNION ALL ".join(
        f"SELECT state_code, total_voters, '{p}' AS party, {p.lower()}_pct AS pct FROM top"
        for p in PARTIES
    ),
    "k5_state_details": """
SELECT state_code, total_voters, avg_age, democrat_pct, republican_pct, independent_pct,
 email_quality_pct FROM states""",
    "k6_generation_totals": f"""
SELECT g AS generation, CAST(ifnull(sum(voter_count), 0) AS BIGINT) AS voter_count
FROM (SELECT unnest({list(GENERATIONS)}) AS g) LEFT JOIN cells ON generation = g GROUP BY g""",
    "k7_gender_by_party": """
SELECT party, gender, CAST(sum(voter_count) AS BIGINT) AS voter_count FROM cells
WHERE party IS NOT NULL GROUP BY ALL""",
    "k8_generation_by_party": """
SELECT party, nullif(generation, 'unknown') AS generation,
 CAST(sum(voter_count) AS BIGINT) AS voter_count FROM cells
WHERE party IS NOT NULL GROUP BY ALL""",
    "k9_trend_slice": """
SELECT * FROM trends WHERE registration_month BETWEEN DATE '2015-06-01' AND DATE '2020-12-31'
ORDER BY registration_month""",
    "k10_party_trend_long": " UNION ALL ".join(
        f"SELECT registration_month, '{p.lower()}' AS party, {p.lower()}_registrations "
        "AS registrations FROM trends WHERE year(registration_month) <= 2024"
        for p in PARTIES
    ),
    "k11_dq_issue_breakdown": " UNION ALL ".join(
        f"SELECT '{label}' AS issue_type, {c} AS issue_count, {ISSUE_SHARE.format(c)} FROM dq"
        for label, c in (
            ("Missing Data", "missing_data_count"),
            ("Invalid Age", "invalid_age_count"),
            ("Invalid Email", "invalid_email_count"),
        )
    ),
    "k12_mart_reader": (
        "SELECT * FROM engagement ORDER BY engagement_score DESC, voter_count DESC"
    ),
    "l1_stream_load_unseen": f"SELECT {AS_READ} FROM registry",
    "l1_changed_files": f"SELECT {AS_READ} FROM registry",
}


def _with_relations(statement: str) -> str:
    relations = ",\n".join(f"{name} AS ({body.strip()})" for name, body in RELATIONS.items())
    body = statement.strip()
    if body.startswith("WITH "):
        body = f"SELECT * FROM ({body})"
    return f"WITH {relations}\n{body}"


ORACLE_SQL = {name: _with_relations(statement) for name, statement in STATEMENTS.items()}
