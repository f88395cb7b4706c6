"""Where the layers live, and how tables are created, published and read.

All tables are parquet at known folders and registered in the session catalog. What a later
session needs to find them again, without a shared catalog, is kept under the warehouse root:
the bucket count of the raw table and what was merged of it, and the manifests of the last runs.

A manifest names the folders of all published tables of a run. It is written last, as one file,
so the tables of a run become visible together or not at all; readers that go by the manifest
never see tables of two runs. The catalog follows it. The last ``KEPT_RUNS`` runs stay readable.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.schema import CLEANED_SCHEMA, LEDGER_SCHEMA, RAW_SCHEMA


@dataclass(frozen=True)
class Warehouse:
    """Root folder and namespaces. ``prefix`` sets several warehouses of a session apart."""

    root: str
    prefix: str = ""
    raw: str = "raw"
    metadata: str = "metadata"
    intermediate: str = "main_intermediate"
    marts: str = "main_marts"

    def namespace(self, name: str) -> str:
        return f"{self.prefix}{name}"

    def table(self, namespace: str, name: str) -> str:
        return f"{self.namespace(namespace)}.{name}"

    def folder(self, namespace: str, name: str) -> str:
        return f"{self.root}/{namespace}/{name}"

    @property
    def raw_table(self) -> str:
        return self.table(self.raw, "voters")

    @property
    def ledger_table(self) -> str:
        return self.table(self.metadata, "voter_ingestion_audit")

    @property
    def cleaned_table(self) -> str:
        return self.table(self.intermediate, CLEANED)

    @property
    def layout_folder(self) -> str:
        return self.folder(self.metadata, "raw_layout")

    @property
    def runs_folder(self) -> str:
        return self.folder(self.metadata, "runs")

    @property
    def merges_folder(self) -> str:
        return self.folder(self.metadata, "raw_merges")

    @property
    def cleaned_folder(self) -> str:
        return self.folder(self.intermediate, CLEANED)

    def mart_table(self, name: str) -> str:
        return self.table(self.marts, MART_TABLES[name])


# Table names of the cleaned layer and of the marts.
CLEANED = "voters_cleaned"
MART_TABLES = {
    "state_summary": "voter_state_summary",
    "party_distribution": "voter_party_distribution",
    "engagement_metrics": "voter_engagement_metrics",
    "demographic_crosstab": "demographic_crosstab",
    "registration_trends": "registration_trends",
    "dq_summary": "dq_summary",
}


def _quoted(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")


def _create(
    spark: SparkSession, table: str, columns: str, folder: str, layout: str = ""
) -> None:
    listed = f"({columns})" if columns else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} {listed} USING parquet {layout} "
        f"LOCATION '{_quoted(folder)}'"
    )


def stored_rows(spark: SparkSession, folder: str, schema: str) -> list:
    """Rows of a small table under the warehouse root; none where it is not written yet."""
    try:
        return spark.read.schema(schema).parquet(folder).collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def raw_buckets(spark: SparkSession, wh: Warehouse, wanted: int | None) -> int:
    """The bucket count of the raw table, fixed by the first session and kept under the root.

    Files of one count read with another would put keys in the wrong bucket, so a table
    found without its count, or wanted with another, is refused.
    """
    stored = stored_rows(spark, wh.layout_folder, LAYOUT)
    if stored:
        kept = stored[0]["buckets"]
        if wanted not in (None, kept):
            raise ValueError(f"the raw table has {kept} buckets, not {wanted}")
        return kept
    if spark.catalog.tableExists(wh.raw_table):
        kept = bucket_count(spark, wh.raw_table)
        if wanted not in (None, kept):
            raise ValueError(f"the raw table has {kept} buckets, not {wanted}")
    elif wanted is None and _holds_rows(spark, wh.folder(wh.raw, "voters")):
        raise ValueError("the raw table's bucket count is not known: give buckets")
    else:
        kept = wanted or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.createDataFrame([(kept,)], LAYOUT).coalesce(1).write.parquet(wh.layout_folder)
    return kept


def _holds_rows(spark: SparkSession, folder: str) -> bool:
    try:
        return not spark.read.schema(RAW_SCHEMA).parquet(folder).select("id").isEmpty()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


LAYOUT = "buckets int"
# A row per table, and per batch for tables that are kept by batch (``written`` is the run
# whose folder holds the batch); ``settings`` says how the run cleaned.
RUNS = "run long, at string, settings string, namespace string, name string, batch string, written long, folder string"
# A row per merged segment of the raw table; ``generation`` names the folder of later batches.
MERGES = "number long, generation int, segment string, n_rows long, batches array<string>"
#: Runs whose tables are never overwritten, the newest among them.
KEPT_RUNS = 3
#: Records are kept in that many folders that take turns.
SLOTS = KEPT_RUNS + 3


def _columns(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def ensure_tables(spark: SparkSession, wh: Warehouse, buckets: int | None = None) -> None:
    """Create namespaces, raw table and audit ledger where they are missing.

    The raw table is partitioned by batch, so counting a batch reads one partition, and
    bucketed by the key, so the search for unseen keys shuffles the batch and never the
    table. ``buckets`` is fixed at creation, kept under the root, and defaults to the
    shuffle partitions of the first session; size it for the table, at roughly a gigabyte
    of keys per bucket. Published tables are attached at their live versions.
    """
    for namespace in (wh.raw, wh.metadata, wh.intermediate, wh.marts):
        spark.sql(
            f"CREATE DATABASE IF NOT EXISTS {wh.namespace(namespace)} "
            f"LOCATION '{_quoted(wh.root)}/{namespace}'"
        )
    buckets = raw_buckets(spark, wh, buckets)
    if not spark.catalog.tableExists(wh.raw_table):
        attach_raw(spark, wh, buckets, last_merge(spark, wh))
    elif not table_detail(spark, wh.raw_table, "Location").endswith(raw_folder(wh, (merge := last_merge(spark, wh)).generation)):
        attach_raw(spark, wh, buckets, merge)  # another session has merged since
    folder = wh.folder(wh.metadata, "voter_ingestion_audit")
    _create(spark, wh.ledger_table, _columns(LEDGER_SCHEMA), folder)
    attach_run(spark, wh, last_run(spark, wh))


def raw_folder(wh: Warehouse, generation: int) -> str:
    """Where the batches loaded since the last merge are; two folders take turns after the first."""
    return wh.folder(wh.raw, "voters" + ("" if not generation else f"_{generation % 2}"))


def attach_raw(spark: SparkSession, wh: Warehouse, buckets: int, merge: Merge) -> None:
    """Register the raw table's batches, and its merged segments, as bucketed tables."""
    bucketed = f"CLUSTERED BY (id) INTO {buckets} BUCKETS"
    folder = raw_folder(wh, merge.generation)
    spark.sql(f"DROP TABLE IF EXISTS {wh.raw_table}")
    _create(spark, wh.raw_table, _columns(RAW_SCHEMA), folder, f"PARTITIONED BY (source_file_hash) {bucketed}")
    # Appending nothing makes the folder exist; partitions already in it are attached.
    nothing = spark.createDataFrame([], RAW_SCHEMA)
    nothing.write.mode("append").partitionBy("source_file_hash").parquet(folder)
    spark.sql(f"ALTER TABLE {wh.raw_table} RECOVER PARTITIONS")
    for name in _segments(spark, wh):
        if name not in merge.segments:
            spark.sql(f"DROP TABLE {wh.table(wh.raw, name)}")
    for segment in merge.segments:
        _create(spark, wh.table(wh.raw, segment), _columns(RAW_SCHEMA), wh.folder(wh.raw, segment), bucketed)


def _segments(spark: SparkSession, wh: Warehouse) -> list[str]:
    found = spark.sql(f"SHOW TABLES IN {wh.namespace(wh.raw)} LIKE 'voters_segment_*'").collect()
    return sorted(r["tableName"] for r in found)


def attach_bucketed(spark: SparkSession, table: str, columns: str, folder: str, key: str, buckets: int) -> DataFrame:
    """Register a bucketed table's files in this session, which may not be the one that wrote them."""
    _create(spark, table, columns, folder, f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS")
    spark.catalog.refreshTable(table)
    return spark.table(table)


@dataclass(frozen=True)
class Merge:
    """What was merged of the raw table: {segment: (rows, batches)}."""

    number: int = 0
    generation: int = 0
    segments: dict[str, tuple[int, list[str]]] = field(default_factory=dict)


def last_merge(spark: SparkSession, wh: Warehouse) -> Merge:
    rows = stored_rows(spark, wh.merges_folder, MERGES)
    if not rows:
        return Merge()
    newest = max(r["number"] for r in rows)
    mine = [r for r in rows if r["number"] == newest]
    return Merge(newest, mine[0]["generation"], {r["segment"]: (r["n_rows"], list(r["batches"])) for r in mine})


def raw_tables(spark: SparkSession, wh: Warehouse) -> list[str]:
    """The raw table's parts, as ``ensure_tables`` has registered them: batches loaded since the
    last merge, and merged segments."""
    return [wh.raw_table, *(wh.table(wh.raw, s) for s in _segments(spark, wh))]


def read_raw(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """All rows of the raw table, whether their files were merged or not."""
    parts = [spark.table(t).select(*RAW_SCHEMA.fieldNames()) for t in raw_tables(spark, wh)]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def raw_batches(spark: SparkSession, wh: Warehouse) -> set[str]:
    """The batches that have rows in the raw table."""
    merge = last_merge(spark, wh) if _segments(spark, wh) else Merge()
    merged = {b for _, batches in merge.segments.values() for b in batches}
    listed = spark.sql(f"SHOW PARTITIONS {wh.raw_table}").collect()
    return merged | {unescaped(r[0].partition("=")[2]) for r in listed}


# Characters that Spark writes as %XX in the name of a partition's folder.
ESCAPED = "\"#%'*/:=?\\\x7f{[]^"


def escaped(value: str) -> str:
    return "".join(f"%{ord(c):02X}" if c in ESCAPED or ord(c) < 32 else c for c in value)


def unescaped(name: str) -> str:
    return re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), name)


def table_detail(spark: SparkSession, table: str, field: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(f"col_name = '{field}'")
    row = rows.first()
    return row["data_type"] if row else None


def bucket_count(spark: SparkSession, table: str) -> int:
    return int(table_detail(spark, table, "Num Buckets"))


def append_rows(spark: SparkSession, rows: DataFrame, table: str) -> None:
    rows.select(*spark.table(table).columns).write.insertInto(table)


@dataclass
class Run:
    """A published run: the folder of every table, and for the layers kept by batch the run whose
    folder holds each batch."""

    number: int = 0
    at: str = ""
    settings: str = ""
    tables: dict[tuple[str, str], str] = field(default_factory=dict)
    batches: dict[str, dict[str, int]] = field(default_factory=dict)
    schemas: dict[tuple[str, str], T.StructType] = field(default_factory=dict)

    def folders(self) -> set[str]:
        return set(self.tables.values())

    def follow(self, at: str = "") -> Run:
        """The run after this one, with the same tables until others are put in."""
        return Run(self.number + 1, at, self.settings, dict(self.tables), {k: dict(v) for k, v in self.batches.items()})


def kept_runs(spark: SparkSession, wh: Warehouse) -> dict[int, Run]:
    """The recorded runs by number, oldest first."""
    found: dict[int, Run] = {}
    for r in sorted(stored_rows(spark, wh.runs_folder, RUNS), key=lambda r: r["run"]):
        run = found.setdefault(r["run"], Run(r["run"], r["at"], r["settings"]))
        if r["batch"] is None:
            run.tables[r["namespace"], r["name"]] = r["folder"]
        else:
            run.batches.setdefault(r["name"], {})[r["batch"]] = r["written"]
    return found


def last_run(spark: SparkSession, wh: Warehouse) -> Run:
    return next(reversed(kept_runs(spark, wh).values()), Run())


def named_run(spark: SparkSession, wh: Warehouse, number: int | None = None) -> Run:
    """The newest run, or one of the last ``KEPT_RUNS`` by its number."""
    runs = kept_runs(spark, wh)
    newest = max(runs, default=0)
    if number is None:
        return runs.get(newest, Run())
    if number not in runs or number <= newest - KEPT_RUNS:
        raise ValueError(f"run {number} is not kept; the last ones are {sorted(runs)[-KEPT_RUNS:]}")
    return runs[number]


def free_folder(runs: Sequence[Run], wh: Warehouse, namespace: str, name: str) -> str:
    """A folder of the table that none of the kept runs reads."""
    used = {folder for run in runs for folder in run.folders()}
    places = (f"{wh.folder(namespace, name)}/v{i}" for i in range(KEPT_RUNS + 1))
    return next(p for p in places if p not in used)


def write_version(spark: SparkSession, wh: Warehouse, run: Run, df: DataFrame, namespace: str, name: str, kept: Sequence[Run]) -> None:
    """Write a table of a run that is not visible yet."""
    folder = free_folder(kept, wh, namespace, name)
    df.write.mode("overwrite").parquet(folder)
    run.tables[namespace, name] = folder
    run.schemas[namespace, name] = df.schema


def commit_run(spark: SparkSession, wh: Warehouse, run: Run) -> None:
    """Make all tables of a run visible, by one file; then let the catalog follow."""
    rows = [(run.number, run.at, run.settings, ns, name, None, None, folder) for (ns, name), folder in run.tables.items()]
    rows += [
        (run.number, run.at, run.settings, "", name, batch, written, None)
        for name, batches in run.batches.items()
        for batch, written in batches.items()
    ]
    slot = f"{wh.runs_folder}/slot={run.number % SLOTS}"
    spark.createDataFrame(rows, RUNS).coalesce(1).write.mode("overwrite").parquet(slot)
    attach_run(spark, wh, run)


def attach_run(spark: SparkSession, wh: Warehouse, run: Run) -> None:
    """Point the session's catalog to the tables of a run."""

    def one(namespace: str, name: str) -> None:
        _attach(spark, wh.table(namespace, name), run.tables[namespace, name], run.schemas.get((namespace, name)))

    jobs = [lambda key=key: one(*key) for key in run.tables]
    if run.batches.get(CLEANED):
        jobs.append(lambda: _attach_batches(spark, wh, run.number, run.batches[CLEANED]))
    together(spark, jobs)


def together(spark: SparkSession, jobs: Sequence[Callable[[], None]]) -> None:
    """Independent jobs are submitted together: one uses cores that another leaves idle."""
    with ThreadPoolExecutor(max(1, len(jobs))) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]:
            done.result()


def _attach(spark: SparkSession, table: str, folder: str, schema: T.StructType | None) -> None:
    if spark.catalog.tableExists(table):
        if (table_detail(spark, table, "Location") or "").endswith(folder):
            spark.catalog.refreshTable(table)
            return
        kinds = [(f.name, f.dataType.simpleString()) for f in (schema or spark.read.parquet(folder).schema)]
        if spark.table(table).dtypes == kinds:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{_quoted(folder)}'")
            spark.catalog.refreshTable(table)
            return
        spark.sql(f"DROP TABLE {table}")
    _create(spark, table, _columns(schema) if schema else "", folder)


def batched(spark: SparkSession, folder: str, written: dict[str, int], schema: T.StructType) -> DataFrame:
    """The folders of the runs that wrote these batches, with ``source_file_hash`` and ``run``."""
    fields = [f for f in schema.fields if f.name != "source_file_hash"]
    places = [T.StructField("run", T.LongType()), T.StructField("source_file_hash", T.StringType())]
    paths = [f"{folder}/run={n}" for n in sorted(set(written.values()))]
    return spark.read.option("basePath", folder).schema(T.StructType(fields + places)).parquet(*paths)


def _attach_batches(spark: SparkSession, wh: Warehouse, number: int, written: dict[str, int]) -> None:
    """The cleaned layer as a table partitioned by batch, each partition at its own run's folder."""
    table, known = wh.cleaned_table, 0
    if spark.catalog.tableExists(table):
        property = spark.sql(f"SHOW TBLPROPERTIES {table}").where("key = 'attached_run'").first()
        known = int(property["value"]) if property else 0
        if not known:
            spark.sql(f"DROP TABLE {table}")
    if not known:
        columns = _columns(batched(spark, wh.cleaned_folder, written, CLEANED_SCHEMA).drop("run").schema)
        layout = "PARTITIONED BY (source_file_hash) TBLPROPERTIES ('attached_run' = '0')"
        _create(spark, table, columns, f"{wh.cleaned_folder}/batches", layout)
    for batch, run in written.items():
        if run > known:
            place = _quoted(f"{wh.cleaned_folder}/run={run}/source_file_hash={escaped(batch)}")
            part = f"PARTITION (source_file_hash = '{_quoted(batch)}')"
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {part}")
            spark.sql(f"ALTER TABLE {table} ADD {part} LOCATION '{place}'")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('attached_run' = '{number}')")
    spark.catalog.refreshTable(table)


def by_batch(spark: SparkSession, folder: str, written: dict[str, int], schema: T.StructType) -> DataFrame:
    """Rows of a layer kept by batch: of every batch those of the run that wrote it last.

    The batch and the run are folders, so what a later run replaced is not read.
    """
    if not written:
        return spark.createDataFrame([], schema)
    pairs = [F.lit(f"{n}/{b}") for b, n in written.items()]
    named = F.concat_ws("/", F.col("run").cast("string"), "source_file_hash")
    return batched(spark, folder, written, schema).where(named.isin(*pairs)).drop("run")


def read_cleaned(spark: SparkSession, wh: Warehouse, run: int | None = None) -> DataFrame:
    """The cleaned layer of the newest run, or of a named one."""
    found = named_run(spark, wh, run)
    written = found.batches.get(CLEANED)
    whole = found.tables.get((wh.intermediate, CLEANED))
    rows = spark.read.parquet(whole) if whole else by_batch(spark, wh.cleaned_folder, written or {}, CLEANED_SCHEMA)
    return rows.select(*CLEANED_SCHEMA.fieldNames())


def publish(
    spark: SparkSession, wh: Warehouse, df: DataFrame, namespace: str, name: str
) -> DataFrame:
    """Full refresh of one table, as a run of its own: write beside the live version, then switch.

    Folders take turns and the run's manifest says which is live, so readers keep a whole
    version, a failed write changes nothing in this session or a later one, and the versions
    of the last ``KEPT_RUNS`` runs stay on disk. One writer at a time per warehouse.
    """
    runs = kept_runs(spark, wh)
    newest = next(reversed(runs.values()), Run())
    run = newest.follow(newest.at)
    write_version(spark, wh, run, df, namespace, name, list(runs.values())[-KEPT_RUNS:])
    if (namespace, name) == (wh.intermediate, CLEANED):
        run.batches.pop(CLEANED, None)
        run.settings = ""
    commit_run(spark, wh, run)
    return spark.table(wh.table(namespace, name))


def read_mart(
    spark: SparkSession,
    wh: Warehouse,
    name: str,
    namespace: str | None = None,
    order: list[Column] | None = None,
    run: int | None = None,
) -> DataFrame:
    """A published mart of the newest run or of a named one, or from another namespace; sorted if wanted.

    It goes by the manifest, not by the session's catalog, so several marts read with one
    ``run`` belong together, also while a later run is being written.
    """
    if namespace:
        mart = spark.table(f"{namespace}.{MART_TABLES[name]}")
    else:
        mart = spark.read.parquet(named_run(spark, wh, run).tables[wh.marts, MART_TABLES[name]])
    return mart.orderBy(*order) if order else mart
