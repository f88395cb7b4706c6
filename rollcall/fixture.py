"""The person registry derived from the supplied ``customer`` and ``orders`` tables.

``REGISTRY_SQL`` is the test-data definition. It means the same in Spark SQL and DuckDB,
so both sides of a comparison start from the same records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions import as_timestamp

AS_OF = "2025-09-01"
RUN_TS = "2025-09-01 00:00:00"
FIXTURE_HASH = "fixture"

REGISTRY_SQL = """
WITH o AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS d1, CAST(max(o_orderdate) AS DATE) AS d2 FROM {orders} GROUP BY o_custkey),
b AS (SELECT c_custkey AS k, c_nationkey AS nk, c_mktsegment AS seg,
  make_date(CAST(year(d1) + 16 + 4*(c_custkey%3) AS INT), CAST(month(d1) AS INT), CAST(day(d1) AS INT)) AS r,
  make_date(CAST(year(d2) + 16 + 4*(c_custkey%3) AS INT), CAST(month(d2) AS INT), CAST(day(d2) AS INT)) AS v
  FROM {customer} LEFT JOIN o ON c_custkey = o_custkey)
SELECT CASE WHEN k%7=0 THEN ' '||CAST(k AS STRING)||' ' ELSE CAST(k AS STRING) END AS id,
 CASE WHEN k%31=0 THEN NULL ELSE ' First'||CAST(k AS STRING) END AS first_name,
 CASE WHEN k%37=0 THEN NULL ELSE 'Last'||CAST(k AS STRING)||' ' END AS last_name,
 CASE WHEN k%17=0 THEN NULL WHEN k%19=0 THEN 'abc' WHEN k%23=0 THEN '150' WHEN k%29=0 THEN '45.7' ELSE CAST(15+(k*7)%70 AS STRING) END AS age,
 CASE k%6 WHEN 0 THEN 'M' WHEN 1 THEN ' f ' WHEN 2 THEN 'Male' WHEN 3 THEN 'FEMALE' WHEN 4 THEN 'x' END AS gender,
 CASE nk%8 WHEN 0 THEN 'California' WHEN 1 THEN 'ca' WHEN 2 THEN ' NY ' WHEN 3 THEN 'Texas' WHEN 4 THEN 'WASHINGTON, DC' WHEN 5 THEN 'Puerto Rico' WHEN 6 THEN '' ELSE 'new hampshire' END AS state,
 CASE seg WHEN 'BUILDING' THEN 'Democrat' WHEN 'FURNITURE' THEN ' Republican' WHEN 'MACHINERY' THEN 'Independent' WHEN 'HOUSEHOLD' THEN 'Green' END AS party,
 CASE k%9 WHEN 0 THEN NULL WHEN 1 THEN 'bad' WHEN 2 THEN 'a@b' WHEN 3 THEN '@.ab' ELSE ' User'||CAST(k AS STRING)||'@Ex.com' END AS email,
 CASE WHEN k%13=0 THEN 'garbage' WHEN k%5=0 THEN CAST(r AS STRING) WHEN k%5=1 THEN CAST(r AS STRING)||' 10:20:30'
  WHEN k%5=2 THEN lpad(CAST(month(r) AS STRING),2,'0')||'/'||lpad(CAST(day(r) AS STRING),2,'0')||'/'||CAST(year(r) AS STRING)
  WHEN k%5=3 THEN CAST(month(r) AS STRING)||'/'||CAST(day(r) AS STRING)||'/'||CAST(year(r) AS STRING)||' 9:05:00' ELSE CAST(r AS STRING)||'T10:20:30' END AS registered_date,
 CASE WHEN k%11=0 THEN NULL WHEN k%5=2 THEN CAST(month(v) AS STRING)||'/'||CAST(day(v) AS STRING)||'/'||CAST(year(v) AS STRING) ELSE CAST(v AS STRING) END AS last_voted_date,
 CASE WHEN k%3=0 THEN '' ELSE '2024-06-01 00:00:00' END AS updated_at
FROM b
"""


def extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 11 text columns, before a load adds its own."""
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("customer", "orders")}
    return spark.sql(REGISTRY_SQL, **tables)


def raw_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extract as one loaded batch."""
    return extract(spark, sf_dir).select(
        "*",
        as_timestamp(RUN_TS).alias("load_timestamp"),
        F.lit(FIXTURE_HASH).alias("source_file_hash"),
    )


def base_batch(registry: DataFrame) -> DataFrame:
    """The three quarters of the records that an earlier load brought."""
    return registry.where(F.trim("id").cast("bigint") % 4 != 0)


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load history: one load per month of ``orders``."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    month = F.date_format("o_orderdate", "yyyy-MM")
    loads = orders.groupBy(month.alias("month")).agg(
        F.count("*").alias("file_row_count"),
        F.count_if(F.col("o_orderstatus") == "F").alias("inserted_row_count"),
    )
    loaded = F.col("inserted_row_count") > 0
    return loads.select(
        F.concat(F.lit("load-"), "month").alias("ingestion_id"),
        F.sha2("month", 256).alias("file_hash"),
        F.concat(F.lit("/drops/"), "month", F.lit(".csv")).alias("source_path"),
        "file_row_count",
        "inserted_row_count",
        F.when(loaded, F.lit("success")).otherwise(F.lit("no-op")).alias("load_status"),
        F.lit(None).cast("string").alias("dag_run_id"),
        F.concat("month", F.lit("-01 00:00:00")).cast("timestamp").alias("ingested_at"),
    )
