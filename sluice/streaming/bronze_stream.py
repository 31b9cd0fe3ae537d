"""Streaming Bronze ingestion (STR-1) and streaming pipeline metrics.

The same Bronze projection as the batch path runs on a Structured Streaming file source; ``availableNow``
processes everything present and stops, so a scheduled run behaves like a batch with exactly-once,
checkpointed progress. Checkpoints and output go to the shared folder (never a machine-local one).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from sluice.operators.bronze import bronze_transform
from sluice.session import cut_lineage, staging_path
from sluice.specs import TableSpec
from sluice.streaming.epochs import EpochStore, KeyState


def stream_bronze(
    spark: SparkSession,
    source: str,
    schema: StructType,
    spec: TableSpec,
    fmt: str = "parquet",
    output: str | None = None,
    checkpoint: str | None = None,
    as_of: dt.datetime | None = None,
    batch_id: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Stream ``source`` through the Bronze projection into parquet; returns the output as a batch frame."""
    output = output or staging_path(spark, "stream", spec.name, "out")
    checkpoint = checkpoint or staging_path(spark, "stream", spec.name, "ckpt")
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    src = reader.load(source)
    bronze = bronze_transform(src, spec, as_of=as_of, batch_id=batch_id)
    q = (bronze.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return spark.read.parquet(output)


def stream_success_rate(
    spark: SparkSession,
    runs: DataFrame,
    window: str = "1 hour",
    watermark: str = "10 minutes",
    ts: str = "started_at",
    output: str | None = None,
    checkpoint: str | None = None,
) -> DataFrame:
    """MET-1 as a stream: windowed success rate with a watermark, appended once a window closes.

    ``runs`` must be a streaming frame; the event-time column is cast to a session-zone timestamp because
    watermarks reject ``timestamp_ntz``.
    """
    output = output or staging_path(spark, "stream", "success_rate", "out")
    checkpoint = checkpoint or staging_path(spark, "stream", "success_rate", "ckpt")
    t = runs.withColumn("_et", F.col(ts).cast("timestamp")).withWatermark("_et", watermark)
    agg = t.groupBy(F.window("_et", window).alias("w")).agg(
        F.count(F.lit(1)).cast("long").alias("runs"),
        F.count_if(F.col("status") == "success").cast("long").alias("succeeded"),
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "runs", "succeeded",
             (F.col("succeeded").cast("double") * F.lit(100.0) / F.col("runs").cast("double")).alias("success_rate"))
    q = (agg.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return spark.read.parquet(output)


def stream_ingest_with_quality(
    spark: SparkSession,
    source: str,
    schema: StructType,
    spec: TableSpec,
    fmt: str = "parquet",
    output: str | None = None,
    reports: str | None = None,
    checkpoint: str | None = None,
    as_of: dt.datetime | None = None,
    batch_id: str | None = None,
    max_files_per_trigger: int | None = None,
    thresholds=None,
    keys_path: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """STR-1 with the DQ gate: every micro-batch is profiled with ``quality_report`` inside
    ``foreachBatch``; its report rows are stored with the batch id, and the batch's Bronze rows are written
    only when the report has no failed error. A key must be unique over all accepted micro-batches: their keys are
    kept as digests under ``keys_path``. Every write is a whole folder ``batch_id=<n>``, so a batch replayed after a
    failure replaces its own output (exactly-once with the checkpoint). Returns (Bronze rows, reports) as batch frames.
    """
    from sluice.operators.quality import REPORT_DDL, quality_report
    from sluice.specs import Thresholds

    th = thresholds or Thresholds()
    output = output or staging_path(spark, "stream", spec.name, "rows")
    reports = reports or staging_path(spark, "stream", spec.name, "reports")
    checkpoint = checkpoint or staging_path(spark, "stream", spec.name, "qckpt")
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    bronze = bronze_transform(reader.load(source), spec, as_of=as_of, batch_id=batch_id)
    out = EpochStore(spark, output, bronze.schema, "batch_id")
    reps = EpochStore(spark, reports, REPORT_DDL, "batch_id")
    keys = _key_state(spark, spec, bronze.columns, keys_path or f"{output.rstrip('/')}_keys")

    def per_batch(batch: DataFrame, epoch: int) -> None:
        rows_ = _with_known_keys(quality_report(batch, spec, th).collect(), keys, batch, epoch)  # one row a check
        reps.put(spark.createDataFrame(rows_, REPORT_DDL), epoch)
        if not any(r[3] == "error" and not r[6] for r in rows_):
            out.put(batch, epoch)
            if keys:
                keys.accept(batch, epoch)

    q = (bronze.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return out.read(), reps.read()


def _key_state(spark: SparkSession, spec: TableSpec, columns: list[str], path: str) -> KeyState | None:
    """The keys of earlier micro-batches, if the spec has a key and the rows hold it."""
    return KeyState(spark, path, spec.key) if spec.key and set(spec.key) <= set(columns) else None


def _with_known_keys(rows: list, keys: KeyState | None, batch: DataFrame, epoch: int) -> list[tuple]:
    """The report's rows, the key check counting keys of earlier micro-batches too."""
    if keys is None:
        return [tuple(r) for r in rows]
    known = keys.known(batch, epoch)
    return [tuple(r) if r.check_name != "key_unique" or not known else
            (r.table_name, r.check_name, r.column_name, r.severity, r.metric + known, r.threshold, False, "key is not unique")
            for r in rows]


def stream_ingest_csv(
    spark: SparkSession,
    source: str,
    columns: list[str],
    spec: TableSpec,
    thresholds=None,
    output: str | None = None,
    reports: str | None = None,
    quarantine_root: str | None = None,
    checkpoint: str | None = None,
    as_of: dt.datetime | None = None,
    batch_id: str | None = None,
    max_files_per_trigger: int | None = None,
    keys_path: str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The CSV ingest as a stream: raw ``*.csv`` files arriving under ``source`` (header line per file).

    Per micro-batch (its size bounded by ``max_files_per_trigger``) in ``foreachBatch``: stage the parsed batch in the
    shared folder; gate on its corrupt share; quarantine corrupt lines; Bronze projection; DQ report, whose key check
    covers all accepted micro-batches; write rows only when no error failed. Every write is the batch's own
    ``batch_id=<n>`` folder, so a replayed batch replaces its output (exactly-once with the checkpoint). A gated batch
    leaves a report row ``corrupt_share`` and no data. Returns (Bronze rows, reports, quarantined lines).
    """
    from pyspark.sql.types import StringType, StructField

    from sluice.operators.quality import REPORT_DDL, quality_report
    from sluice.sources.csv import CORRUPT
    from sluice.specs import Thresholds

    th = thresholds or Thresholds()
    output = output or staging_path(spark, "stream", spec.name, "rows")
    reports = reports or staging_path(spark, "stream", spec.name, "reports")
    quarantine_root = quarantine_root or staging_path(spark, "stream", spec.name, "quarantine")
    checkpoint = checkpoint or staging_path(spark, "stream", spec.name, "csvckpt")
    schema = StructType([StructField(c, StringType()) for c in columns] + [StructField(CORRUPT, StringType())])
    reader = (spark.readStream.schema(schema).option("header", "true").option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", "false")
              .option("pathGlobFilter", "*.csv").option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.csv(source)

    empty = spark.createDataFrame([], StructType(schema.fields[:-1]))
    bronze_schema = bronze_transform(empty, spec, as_of=as_of, batch_id=batch_id).schema
    out = EpochStore(spark, output, bronze_schema, "batch_id")
    reps = EpochStore(spark, reports, REPORT_DDL, "batch_id")
    bad_lines = EpochStore(spark, quarantine_root, "line string", "batch_id")
    keys = _key_state(spark, spec, bronze_schema.names, keys_path or f"{output.rstrip('/')}_keys")

    def per_batch(batch: DataFrame, epoch: int) -> None:
        b = cut_lineage(batch, spark, name="csv-batch")  # parsed once; on disk the corrupt column reads on its own
        st = b.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(CORRUPT).isNotNull()).alias("bad")).first()
        share = st.bad * 100.0 / st.n if st.n else 0.0
        gate_ok = st.bad == 0 or share <= th.max_corrupt_percent
        rep_rows = [(spec.name, "corrupt_share", None, "error", share, float(th.max_corrupt_percent), gate_ok,
                     "ok" if gate_ok else "too many corrupt lines")]
        if gate_ok:
            bad_lines.put(b.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("line")), epoch)
            clean = b.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
            bronze = bronze_transform(clean, spec, as_of=as_of, batch_id=batch_id)
            rep_rows += _with_known_keys(quality_report(bronze, spec, th).collect(), keys, bronze, epoch)  # one row a check
        reps.put(spark.createDataFrame(rep_rows, REPORT_DDL), epoch)
        if not any(r[3] == "error" and not r[6] for r in rep_rows):
            out.put(bronze, epoch)
            if keys:
                keys.accept(bronze, epoch)

    q = raw.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return out.read(), reps.read(), bad_lines.read()
