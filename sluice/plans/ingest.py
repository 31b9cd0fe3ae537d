"""Bronze ingestion of a raw drop, table by table, with failure isolation (DQ-7, SNK-3, AGG-10).

Per table: one CSV parse (staged, counts observed), the corrupt gate, Bronze projection, the DQ report
(see the README for its scans), the gate, one write whose row count is observed. Every outcome, including read
failures, becomes a ``run_log`` row; the driver loop only sequences tables, the work is Spark's.
"""

from __future__ import annotations

import datetime as dt
import logging
import traceback
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluice.operators.bronze import batch_id_for, bronze_transform
from sluice.operators.ops import schema_changes
from sluice.operators.isolated import validate_each
from sluice.operators.quality import REPORT_DDL, gate
from sluice.session import checkpoint_root
from sluice.sinks.history import evolve, fit, reconcile
from sluice.sinks.publish import write_audit_publish
from sluice.sinks.tables import write_table
from sluice.sources.csv import scan_csv
from sluice.sources.files import absolute_path, file_inventory
from sluice.specs import PRESETS, REGISTRY, TableSpec, Thresholds, spec_for

log = logging.getLogger(__name__)

RUN_LOG_DDL = (
    "run_id string, env string, job string, table_name string, stage string, status string, "
    "record_count long, error string, started_at timestamp, ended_at timestamp, schema_changes string, "
    "error_class string"
)


@dataclass
class IngestConfig:
    env: str = "dev"
    thresholds: Thresholds | None = None  # default: the preset of ``env`` (base for unknown names)
    as_of: dt.datetime | None = None
    database: str = "bronze"
    location: str | None = None  # folder for the Bronze tables; default under the shared checkpoint folder
    quarantine_root: str | None = None
    enable_validation: bool = True
    registry: Mapping[str, TableSpec] = field(default_factory=lambda: dict(REGISTRY))
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    parallelism: int = 8  # tables ingested at once (Spark runs jobs from several driver threads concurrently)

    def __post_init__(self):
        if self.thresholds is None:
            self.thresholds = PRESETS.get(self.env, PRESETS["base"])
    partition_by_date: bool = True  # Bronze tables partitioned by _processing_date, so day checks prune files
    keep_history: bool = False  # True: a run replaces only its own day's partition; False: full replace
    key_buckets: int | None = None  # bucket Bronze tables on their spec key: later key joins need no shuffle
    publish: bool = False  # True: write a version, audit it as written, then switch readers to it (sinks.publish)


@dataclass
class TableOutcome:
    table_name: str
    stage: str
    status: str
    record_count: int | None
    error: str | None
    started_at: dt.datetime
    ended_at: dt.datetime
    report: DataFrame | None = None
    schema_changes: str | None = None
    error_class: str | None = None


def ensure_database(spark: SparkSession, name: str, location: str) -> None:
    if not spark.catalog.databaseExists(name):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")


def ingest_table(spark: SparkSession, path: str, table_name: str, cfg: IngestConfig) -> TableOutcome:
    """Read -> gate -> Bronze -> validate -> gate -> write for one table. Never raises."""
    started = dt.datetime.now()
    stage = "read"
    report = None
    try:
        spec = spec_for(table_name, cfg.registry)
        spec = TableSpec(**{**spec.__dict__, "name": table_name}) if spec.name != table_name else spec
        qpath = None
        if cfg.quarantine_root:
            qpath = f"{cfg.quarantine_root.rstrip('/')}/{table_name}_{(cfg.as_of or started).strftime('%Y%m%d_%H%M%S')}"
        scan = scan_csv(spark, path, table_name, cfg.thresholds, quarantine_path=qpath, required=spec.required)
        stage = "transform"
        bronze = bronze_transform(scan.clean, spec, as_of=cfg.as_of,
                                  batch_id=batch_id_for(cfg.as_of or started))
        if cfg.publish:
            def audit(written: DataFrame) -> None:
                nonlocal report
                if cfg.enable_validation:
                    report = validate_each(written, spec, cfg.thresholds)
                    for w in gate(report):
                        log.warning("%s: %s", table_name, w)

            def at(name: str) -> None:
                nonlocal stage
                stage = name

            root = cfg.location or f"{checkpoint_root(spark)}/sluice/warehouse"
            ensure_database(spark, cfg.database, f"{root}/{cfg.database}.db")
            done = write_audit_publish(bronze, f"{cfg.database}.{table_name.lower()}", cfg.run_id, audit, f"{root}/{cfg.database}.db",
                                       ("_processing_date",) if cfg.partition_by_date else None, on_stage=at)
            return TableOutcome(table_name, "publish", "success", done.rows, None, started, dt.datetime.now(), report)
        stage = "validate"
        if cfg.enable_validation:
            report = validate_each(bronze, spec, cfg.thresholds)  # a check that cannot run blocks the load
            for w in gate(report):
                log.warning("%s: %s", table_name, w)
        stage = "write"
        root = cfg.location or f"{checkpoint_root(spark)}/sluice/warehouse"
        ensure_database(spark, cfg.database, f"{root}/{cfg.database}.db")
        changes = None
        existed = spark.catalog.tableExists(f"{cfg.database}.{table_name}")
        if existed:
            old = spark.read.table(f"{cfg.database}.{table_name}").schema
            drift = [c for c in schema_changes(old, bronze.schema) if c[1] != "moved"]
            if drift:  # metadata, bounded by the column count
                changes = ",".join(f"{change}:{name}" for name, change, _, _ in drift)
                log.warning("%s: schema drift %s", table_name, changes)
        parts = ("_processing_date",) if cfg.partition_by_date else None
        if existed and changes and cfg.keep_history:  # a type that can't widen raises before anything changes
            table = f"{cfg.database}.{table_name}"
            schema = reconcile(spark.read.table(table).schema, bronze.schema)
            evolve(spark, table, schema, parts or ())
            bronze = fit(bronze, spark.read.table(table).schema)
        # with keep_history the run's session overwrites only the written day (see ingest_all)
        buckets = (cfg.key_buckets, list(spec.key)) if (cfg.key_buckets and spec.key) else None
        n = write_table(bronze, f"{cfg.database}.{table_name}", mode="overwrite",
                        path=f"{root}/{cfg.database}.db/{table_name.lower()}", partition_by=parts, bucket_by=buckets,
                        verify_count=not cfg.keep_history)  # the upstream recount, from file footers
        return TableOutcome(table_name, stage, "success", n, None, started, dt.datetime.now(), report, changes)
    except Exception as exc:  # noqa: BLE001 - isolation: one table's failure never stops the others
        log.warning("failed to ingest %s at %s: %s", table_name, stage, exc)
        log.debug("%s", traceback.format_exc())
        return TableOutcome(table_name, stage, "failed", None, str(exc), started, dt.datetime.now(), report,
                            error_class=type(exc).__name__)


def ingest_all(spark: SparkSession, raw_root: str, cfg: IngestConfig | None = None) -> tuple[DataFrame, DataFrame]:
    """Ingest every ``*.csv`` table under ``raw_root``; returns (run_log, DQ reports tagged with the run).

    The table list comes from Spark's own listing (bounded by the number of tables).
    """
    cfg = cfg or IngestConfig()
    raw_root = absolute_path(raw_root)
    tables = (file_inventory(spark, raw_root).select("entry", "table_name").distinct()
              .orderBy("entry").collect())
    if not tables:
        log.warning("no *.csv tables under %s: nothing to ingest", raw_root)
    root = cfg.location or f"{checkpoint_root(spark)}/sluice/warehouse"
    ensure_database(spark, cfg.database, f"{root}/{cfg.database}.db")

    def one(row):
        return ingest_table(spark, f"{raw_root.rstrip('/')}/{row.entry}", row.table_name, cfg)

    # Overwrite semantics for the whole run: Spark applies the session's partition-overwrite mode to
    # catalog writes (a writer option is not enough there), so it is set for the run and restored after.
    # A run's rows are all of one day: its file is kept open, where Spark would sort a task's rows by day first, in memory
    # and spills that grow with the table (below 2 files it sorts, and so it does from a second day's row on).
    settings = {"spark.sql.sources.partitionOverwriteMode": "dynamic" if cfg.keep_history else "static",
                "spark.sql.maxConcurrentOutputFileWriters": "2"}
    previous = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        if cfg.parallelism > 1 and len(tables) > 1:
            with ThreadPoolExecutor(max_workers=cfg.parallelism, thread_name_prefix="ingest") as pool:
                outcomes = list(pool.map(one, tables))
        else:
            outcomes = [one(r) for r in tables]
    finally:
        for key, value in previous.items():
            spark.conf.set(key, value)
    run_log = spark.createDataFrame(
        [(cfg.run_id, cfg.env, "bronze_ingest", o.table_name, o.stage, o.status, o.record_count, o.error,
          o.started_at, o.ended_at, o.schema_changes, o.error_class) for o in outcomes],
        RUN_LOG_DDL,
    )
    reports = [o.report for o in outcomes if o.report is not None]
    rep = reports[0] if reports else spark.createDataFrame([], REPORT_DDL)
    for r in reports[1:]:
        rep = rep.unionByName(r)
    # run identity on every stored report row, so reports appended over runs form a series (MET-7)
    rep = rep.withColumn("run_id", F.lit(cfg.run_id)).withColumn("env", F.lit(cfg.env))
    return run_log, rep


def ingest_summary(run_log: DataFrame) -> DataFrame:
    """AGG-10: per status: tables, rows loaded, table names and every error as ``TABLE at stage: text`` (both sorted
    by table; at most one of each a table)."""
    error = F.when(F.col("error").isNotNull(), F.concat("table_name", F.lit(" at "), "stage", F.lit(": "), "error"))
    return run_log.groupBy("status").agg(
        F.count(F.lit(1)).cast("long").alias("tables"),
        F.coalesce(F.sum("record_count"), F.lit(0)).cast("long").alias("records"),
        F.array_join(F.sort_array(F.collect_list("table_name")), ",").alias("table_names"),
        F.array_join(F.sort_array(F.collect_list(error)), "\n").alias("errors"),
    )


def exit_code(run_log: DataFrame) -> int:
    """Non-zero when any table failed at any stage."""
    return 1 if run_log.filter(F.col("status") != "success").limit(1).count() else 0


@dataclass
class DailyRun:
    """Everything one scheduled run produces, as DataFrames."""

    required: DataFrame
    run_log: DataFrame
    reports: DataFrame
    record_counts: DataFrame
    freshness: DataFrame


def daily_run(spark: SparkSession, raw_root: str, required: list[str] | tuple[str, ...] | None = None,
              cfg: IngestConfig | None = None, checked: list[str] | None = None) -> DailyRun:
    """The scheduled flow as one driver function: required files present (raises listing the missing
    ones) -> a ``SELECT current_timestamp()`` ping of the catalog -> ingest every table -> record counts
    and freshness for the run's day over the loaded tables (``checked`` limits which; default all loaded).
    """
    from sluice.operators.checks import freshness, record_counts
    from sluice.sources.files import assert_required_files, required_files
    from sluice.sources.warehouse import execute_query, read_table
    from sluice.specs import REQUIRED_RAW_FILES

    cfg = cfg or IngestConfig()
    inv = file_inventory(spark, raw_root)
    req = required_files(spark, inv, list(REQUIRED_RAW_FILES if required is None else required))
    assert_required_files(req)
    execute_query(spark, "SELECT current_timestamp() AS now").collect()  # the connection ping
    run_log, reports = ingest_all(spark, raw_root, cfg)
    loaded = [r.table_name for r in run_log.filter(F.col("status") == "success").select("table_name").collect()]
    names = [t for t in loaded if checked is None or t in checked]
    day = (cfg.as_of or dt.datetime.now()).date()
    tables = {t: read_table(spark, f"{cfg.database}.{t}") for t in names}
    if tables:
        counts, fresh = record_counts(tables, day), freshness(tables, day)
    else:
        counts = spark.createDataFrame([], "table_name string, record_count long, check_time timestamp, passed boolean")
        fresh = spark.createDataFrame([], "table_name string, latest_ingestion timestamp, records_today long")
    return DailyRun(req, run_log, reports, counts, fresh)
