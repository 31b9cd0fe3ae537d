import datetime as dt

import pytest
from pyspark.sql import functions as F

from sluice.plans.ingest import IngestConfig, exit_code, ingest_all, ingest_summary
from sluice.sinks.tables import write_partitioned, write_table
from sluice.sources import warehouse
from sluice.specs import PRESETS, TableSpec
from sluice.streaming.bronze_stream import stream_bronze, stream_success_rate

from helpers import rows


def test_write_modes_count_and_existence(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS sluice_t LOCATION '{tmp_path}/db'")
    df = spark.range(5).withColumnRenamed("id", "x")
    assert write_table(df, "sluice_t.w", path=str(tmp_path / "db" / "w")) == 5
    assert write_table(df, "sluice_t.w", mode="append") == 5
    assert warehouse.read_table(spark, "sluice_t.w").count() == 10
    assert warehouse.table_exists(spark, "SLUICE_T.W") and not warehouse.table_exists(spark, "sluice_t.nope")
    assert not warehouse.table_exists(spark, "no_such_db.x")
    with pytest.raises(Exception):
        write_table(df, "sluice_t.w", mode="error")
    with pytest.raises(ValueError):
        write_table(df, "sluice_t.w", mode="upsert")
    write_table(df, "sluice_t.w", mode="overwrite", pre_sql="SELECT 1", post_sql=["SELECT 2"])
    assert warehouse.execute_query(spark, "SELECT count(*) AS n FROM sluice_t.w").first().n == 5
    assert write_table(df, fmt="parquet", path=str(tmp_path / "files")) == 5


def test_connection_options_lists_every_missing_key():
    with pytest.raises(warehouse.MissingSettingsError) as e:
        warehouse.connection_options({"user": "u"}, ["account", "user", "password"])
    assert "account" in str(e.value) and "password" in str(e.value)
    opts = warehouse.connection_options({"user": "u", "db": "d"}, ["user"], rename={"db": "database"},
                                        defaults={"role": "PUBLIC"})
    assert opts == {"role": "PUBLIC", "user": "u", "database": "d"}


def test_partitioned_write_prunes_and_overwrites_dynamically(spark, tmp_path):
    p = str(tmp_path / "parts")
    df = spark.createDataFrame([(i, dt.date(2024, 1, 1 + i % 3)) for i in range(30)], "v int, day date")
    assert write_partitioned(df, p, ["day"]) == 30
    again = spark.createDataFrame([(100, dt.date(2024, 1, 1))], "v int, day date")
    write_partitioned(again, p, ["day"])
    back = spark.read.parquet(p)
    assert back.count() == 21  # day 1 replaced, days 2 and 3 kept
    one = back.filter(F.col("day") == dt.date(2024, 1, 2))
    assert "PartitionFilters: [isnotnull(day" in one._jdf.queryExecution().executedPlan().toString() or one.count() == 10


def test_stream_bronze_and_stream_metrics(spark, tmp_path):
    src = tmp_path / "in"
    df = spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 1, 0, 5)), (2, "b", dt.datetime(2024, 1, 1, 1, 5))],
                               "id int, s string, ts timestamp")
    df.write.parquet(str(src))
    out = stream_bronze(spark, str(src), df.schema, TableSpec("T"), as_of=dt.datetime(2024, 1, 2),
                        output=str(tmp_path / "out"), checkpoint=str(tmp_path / "ck"))
    assert out.count() == 2 and set(out.columns) >= {"_record_hash", "_batch_id"}
    # rerun: the checkpoint makes it a no-op (exactly once)
    again = stream_bronze(spark, str(src), df.schema, TableSpec("T"), as_of=dt.datetime(2024, 1, 2),
                          output=str(tmp_path / "out"), checkpoint=str(tmp_path / "ck"))
    assert again.count() == 2
    runs = spark.readStream.schema(df.schema).parquet(str(src)).select(
        F.col("ts").alias("started_at"), F.lit("success").alias("status"))
    res = stream_success_rate(spark, runs, "1 hour", "0 seconds", output=str(tmp_path / "m"), checkpoint=str(tmp_path / "mk"))
    # with availableNow the last window is only emitted once the watermark passes it
    assert res.count() >= 1


def test_ingest_run_isolates_failures(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "olist_customers_dataset.csv").write_text(
        "customer_id,customer_city,customer_state,customer_zip_code_prefix\n"
        "c1, são paulo ,sp,01000\nc2,rio,RJ,20000\n")
    (raw / "olist_orders_dataset.csv").write_text("order_id,customer_id,order_status\no1,c1,delivered\no1,c2,shipped\n")
    (raw / "broken.csv").write_text("a,b\n1\n2\n3,4\n")
    cfg = IngestConfig(thresholds=PRESETS["base"], as_of=dt.datetime(2024, 1, 15, 2), database="sluice_ing",
                       location=str(tmp_path / "wh"), quarantine_root=str(tmp_path / "q"))
    log, reports = ingest_all(spark, str(raw), cfg)
    got = rows(log.select("table_name", "stage", "status", "record_count"))
    assert got == [("BROKEN", "read", "failed", None),
                   ("OLIST_CUSTOMERS_DATASET", "write", "success", 2),
                   ("OLIST_ORDERS_DATASET", "validate", "failed", None)]
    assert exit_code(log) == 1
    cust = spark.read.table("sluice_ing.olist_customers_dataset").orderBy("customer_id").first()
    assert (cust.customer_city, cust.customer_zip_code_prefix) == ("SÃO PAULO", "01000")
    s = {r.status: (r.tables, r.records, r.table_names) for r in ingest_summary(log).collect()}
    assert s["success"] == (1, 2, "OLIST_CUSTOMERS_DATASET")
    assert reports.filter("check_name = 'key_unique' AND NOT passed").count() == 1


def test_stream_quality_gates_each_batch(spark, tmp_path):
    from sluice.streaming.bronze_stream import stream_ingest_with_quality

    good, bad = tmp_path / "good", tmp_path / "bad"
    schema = "id int, s string"
    spark.createDataFrame([(1, "a"), (2, "b")], schema).write.parquet(str(good))
    spark.createDataFrame([(1, "a"), (1, "b")], schema).write.parquet(str(bad))
    spec = TableSpec("T", key=("id",))
    rows_ok, rep_ok = stream_ingest_with_quality(spark, str(good), spark.read.parquet(str(good)).schema, spec,
                                                 output=str(tmp_path / "o1"), reports=str(tmp_path / "r1"),
                                                 checkpoint=str(tmp_path / "c1"), as_of=dt.datetime(2024, 1, 1))
    assert rows_ok.count() == 2 and rep_ok.filter("NOT passed AND severity = 'error'").count() == 0
    rows_bad, rep_bad = stream_ingest_with_quality(spark, str(bad), spark.read.parquet(str(bad)).schema, spec,
                                                   output=str(tmp_path / "o2"), reports=str(tmp_path / "r2"),
                                                   checkpoint=str(tmp_path / "c2"), as_of=dt.datetime(2024, 1, 1))
    assert rows_bad.count() == 0
    assert rep_bad.filter("check_name = 'key_unique' AND NOT passed").count() == 1


def test_ingest_records_schema_drift_between_runs(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "things.csv").write_text("id,name\n1,a\n2,b\n")
    cfg = IngestConfig(as_of=dt.datetime(2024, 1, 15, 2), database="sluice_drift", location=str(tmp_path / "wh"))
    log1, _ = ingest_all(spark, str(raw), cfg)
    assert log1.first().schema_changes is None
    (raw / "things.csv").write_text("id,label,size\n1,a,3\n")
    log2, _ = ingest_all(spark, str(raw), cfg)
    r = log2.first()
    assert r.status == "success" and r.schema_changes == "added:label,removed:name,added:size"  # ordered by column name


def test_stream_success_rate_drops_events_behind_the_watermark(spark, tmp_path):
    import time

    src = tmp_path / "runs"
    schema = "ts timestamp, status string"
    # one file per micro-batch. Spark drops a row as late when it is behind the watermark of the previous
    # batch: p1 moves it to 02:30, p2 keeps it there, so the 00:10 run in p3 is late and not counted.
    files = [
        [(dt.datetime(2024, 1, 1, 0, 5), "success"), (dt.datetime(2024, 1, 1, 3, 0), "failed")],
        [(dt.datetime(2024, 1, 1, 3, 10), "success")],
        [(dt.datetime(2024, 1, 1, 0, 10), "failed"), (dt.datetime(2024, 1, 1, 4, 0), "success")],
    ]
    for i, rows_ in enumerate(files, 1):
        spark.createDataFrame(rows_, schema).coalesce(1).write.parquet(str(src / f"p{i}"))
        time.sleep(1.1)  # distinct modification times: the file source reads files in that order
    runs = (spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").option("recursiveFileLookup", "true")
            .parquet(str(src)).select(F.col("ts").alias("started_at"), "status"))
    out = stream_success_rate(spark, runs, "1 hour", "30 minutes", output=str(tmp_path / "o"), checkpoint=str(tmp_path / "c"))
    got = {r.window_start.replace(tzinfo=None).hour: (r.runs, r.succeeded) for r in out.collect()}
    assert got[0] == (1, 1)  # the late 00:10 failure is not counted
    assert 4 not in got  # the newest window is still open: no later event moved the watermark past it


def test_dashboard_metrics_over_the_ingest_run_log(spark, tmp_path):
    from sluice.operators import metrics

    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.csv").write_text("id\n1\n2\n")
    (raw / "b.csv").write_text("id\n1\n")
    (raw / "c.csv").write_text("id,x\n1\n2\n")  # every line short: gated at read
    log, _ = ingest_all(spark, str(raw), IngestConfig(database="sluice_mon", location=str(tmp_path / "wh")))
    runs = metrics.runs_from_run_log(log)
    day = metrics.status_bands(metrics.success_rate(runs, "1 day")).collect()
    assert sum(r.runs for r in day) == 3 and sum(r.succeeded for r in day) == 2
    assert {r.band for r in day} <= {"red", "yellow", "green"}
    rps = metrics.records_per_second(runs, "1 day").agg(F.sum("records")).first()[0]
    assert rps == 3
    assert metrics.duration_quantile(runs, 0.95, "1 day", by="dag_id").count() >= 1


def test_overwrite_a_table_read_by_the_same_plan(spark, tmp_path):
    from sluice.operators import silver

    spark.sql(f"CREATE DATABASE IF NOT EXISTS sluice_inplace LOCATION '{tmp_path}/db'")
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, ts int, v string")
    write_table(df, "sluice_inplace.t", path=str(tmp_path / "db" / "t"))
    latest = silver.dedup_latest(spark.read.table("sluice_inplace.t"), ["k"], ["ts"])
    assert write_table(latest, "sluice_inplace.t", mode="overwrite") == 2
    assert rows(spark.read.table("sluice_inplace.t")) == [(1, 2, "b"), (2, 1, "c")]


def test_stream_csv_ingest_gates_quarantines_and_loads(spark, tmp_path):
    from sluice.streaming.bronze_stream import stream_ingest_csv

    src = tmp_path / "drop"
    src.mkdir()
    (src / "a.csv").write_text("id,v\n1,x\n2,y\n3\n4,z\n5,w\n6,q\n7,r\n8,s\n9,t\n10,u\n11,v\n12,w\n13,x\n14,y\n15,z\n16,a\n17,b\n18,c\n19,d\n20,e\n21,f\n")
    (src / "b.csv").write_text("id,v\n30\n31\n32,x\n")  # 2 of 3 lines corrupt: this batch is gated
    rows_, reps, bad = stream_ingest_csv(spark, str(src), ["id", "v"], TableSpec("T", key=("id",)),
                                         output=str(tmp_path / "o"), reports=str(tmp_path / "r"),
                                         quarantine_root=str(tmp_path / "q"), checkpoint=str(tmp_path / "c"),
                                         as_of=dt.datetime(2024, 1, 1), max_files_per_trigger=1)
    assert rows_.count() == 20 and set(rows_.columns) >= {"_record_hash", "batch_id"}
    assert [r.line for r in bad.collect()] == ["3"]
    gates = {r.batch_id: r.passed for r in reps.filter("check_name = 'corrupt_share'").collect()}
    assert sorted(gates.values()) == [False, True]


def test_ingest_keeps_earlier_days_when_asked(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "days.csv").write_text("id\n1\n2\n")
    base = dict(database="sluice_hist", location=str(tmp_path / "wh"))
    ingest_all(spark, str(raw), IngestConfig(as_of=dt.datetime(2024, 1, 14, 2), keep_history=True, **base))
    (raw / "days.csv").write_text("id\n3\n")
    ingest_all(spark, str(raw), IngestConfig(as_of=dt.datetime(2024, 1, 15, 2), keep_history=True, **base))
    got = {(r._processing_date.day, r.n) for r in
           spark.read.table("sluice_hist.days").groupBy("_processing_date").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {(14, 2), (15, 1)}
    # the same day again replaces only that day
    ingest_all(spark, str(raw), IngestConfig(as_of=dt.datetime(2024, 1, 15, 3), keep_history=True, **base))
    assert spark.read.table("sluice_hist.days").count() == 3
    # full replace (the default) keeps only the latest load
    ingest_all(spark, str(raw), IngestConfig(as_of=dt.datetime(2024, 1, 16, 2), **base))
    assert spark.read.table("sluice_hist.days").count() == 1


def test_daily_run_end_to_end(spark, tmp_path):
    from sluice.plans.ingest import daily_run
    from sluice.sources.files import MissingFilesError

    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "olist_customers_dataset.csv").write_text(
        "customer_id,customer_city,customer_state,customer_zip_code_prefix\nc1,x,SP,01000\nc2,y,RJ,02000\n")
    (raw / "olist_orders_dataset.csv").write_text("order_id,customer_id,order_status\no1,c1,delivered\n")
    cfg = IngestConfig(as_of=dt.datetime(2024, 1, 15, 2), database="sluice_daily", location=str(tmp_path / "wh"))
    with pytest.raises(MissingFilesError, match="olist_products_dataset.csv"):
        daily_run(spark, str(raw), cfg=cfg)
    run = daily_run(spark, str(raw), ["olist_customers_dataset.csv", "olist_orders_dataset.csv"], cfg)
    assert rows(run.run_log.select("table_name", "status")) == [
        ("OLIST_CUSTOMERS_DATASET", "success"), ("OLIST_ORDERS_DATASET", "success")]
    assert {(r.table_name, r.record_count, r.passed) for r in run.record_counts.collect()} == {
        ("OLIST_CUSTOMERS_DATASET", 2, True), ("OLIST_ORDERS_DATASET", 1, True)}
    assert {r.table_name: r.records_today for r in run.freshness.collect()} == {
        "OLIST_CUSTOMERS_DATASET": 2, "OLIST_ORDERS_DATASET": 1}


def test_ingest_of_an_empty_drop_is_a_no_op(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "notes.txt").write_text("not a table")
    log, reports = ingest_all(spark, str(raw), IngestConfig(database="sluice_empty", location=str(tmp_path / "wh")))
    assert log.count() == 0 and reports.count() == 0
    assert exit_code(log) == 0


def test_ingest_can_bucket_bronze_tables_on_their_key(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "olist_customers_dataset.csv").write_text(
        "customer_id,customer_city,customer_state,customer_zip_code_prefix\nc1,x,SP,01000\nc2,y,RJ,02000\n")
    log, _ = ingest_all(spark, str(raw), IngestConfig(database="sluice_bk", location=str(tmp_path / "wh"), key_buckets=4))
    assert log.first().status == "success"
    desc = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED sluice_bk.olist_customers_dataset").collect()}
    assert desc.get("Num Buckets") == "4" and "customer_id" in desc.get("Bucket Columns", "")


def test_verified_overwrite_recounts_from_metadata(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS sluice_v LOCATION '{tmp_path}/db'")
    df = spark.range(7)
    assert write_table(df, "sluice_v.t", path=str(tmp_path / "db" / "t"), verify_count=True) == 7
    assert write_table(df.limit(3), "sluice_v.t", mode="overwrite", verify_count=True) == 3


def test_reports_of_several_runs_form_a_series(spark, tmp_path):
    from sluice.operators import metrics

    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "t.csv").write_text("id,v\n1,\n2,x\n")
    base = dict(database="sluice_series", location=str(tmp_path / "wh"))
    _, r1 = ingest_all(spark, str(raw), IngestConfig(run_id="r1", **base))
    (raw / "t.csv").write_text("id,v\n1,a\n2,x\n")
    _, r2 = ingest_all(spark, str(raw), IngestConfig(run_id="r2", **base))
    s = {r.run_id: (r.validation_failures, r.max_null_percent)
         for r in metrics.dq_series(r1.unionByName(r2), by=["table_name", "run_id"]).collect()}
    assert s == {"r1": (1, 50.0), "r2": (0, 0.0)}


def test_ingest_thresholds_follow_the_environment():
    from sluice.specs import PRESETS, Thresholds

    assert IngestConfig().thresholds == PRESETS["dev"]
    assert IngestConfig(env="prod").thresholds == PRESETS["prod"]
    assert IngestConfig(env="qa").thresholds == PRESETS["base"]
    assert IngestConfig(env="prod", thresholds=Thresholds(7, 7)).thresholds == Thresholds(7, 7)


def test_ignore_mode_never_waits_for_a_skipped_write(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS sluice_ign LOCATION '{tmp_path}/db'")
    df = spark.range(4)
    assert write_table(df, "sluice_ign.t", path=str(tmp_path / "db" / "t"), mode="ignore") == 4
    assert write_table(df, "sluice_ign.t", mode="ignore") == 0  # exists: skipped, no hang
    assert spark.read.table("sluice_ign.t").count() == 4
    p = str(tmp_path / "files")
    assert write_table(df, fmt="parquet", path=p) == 4
    assert write_table(df, fmt="parquet", path=p, mode="ignore") == -1
