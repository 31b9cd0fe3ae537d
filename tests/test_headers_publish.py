"""CSV folders with differing headers; write, audit, publish."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sluice.operators.quality import QualityGateError, gate, quality_report
from sluice.plans.ingest import IngestConfig, ingest_all
from sluice.sinks import publish
from sluice.sinks.tables import write_table
from sluice.sources import csv as csvsrc
from sluice.sources import headers
from sluice.specs import TableSpec, Thresholds

from helpers import rows

ALL = Thresholds(max_corrupt_percent=100.0)


@pytest.fixture()
def folder(tmp_path):
    def make(**files):
        d = tmp_path / "drop"
        d.mkdir()
        for name, text in files.items():
            (d / f"{name}.csv").write_text(text, encoding="utf-8")
        return str(d)

    return make


def test_every_file_loads_by_its_own_header(spark, folder):
    path = folder(a="id,v,w\n1,x,p\n3\n", b='﻿w, ID,"v"\nP,10,X\n', c='id,v\n20,Z\n21,"a,b"\n', d="id,zz\n30,1\n30,1\nid,zz\n",
                  e="", f="id,v,w\n", g="id,id,v\n1,2,3\n", h="v,w\nno,key\n")
    scan = csvsrc.scan_csv(spark, path, "T", ALL, columns=["id", "v", "w"], required=["id"])
    assert (scan.total, scan.corrupt) == (10, 6)
    assert rows(scan.clean) == [("1", "x", "p"), ("10", "X", "P"), ("20", "Z", None), ("21", "a,b", None)]
    assert sorted(r[0] for r in scan.corrupt_rows.collect()) == ["1,2,3", "3", "30,1", "30,1", "id,zz", "no,key"]
    kinds = {r.path.split("/")[-1]: (r.kind, r.reason) for r in headers.header_report(spark, scan.headers).collect()}
    assert kinds == {"a.csv": ("same", None), "f.csv": ("same", None), "b.csv": ("reordered", None), "c.csv": ("short", None),
                     "d.csv": ("unknown", "unknown columns: zz"), "g.csv": ("unknown", "repeated column names"),
                     "h.csv": ("unknown", "missing columns: id")}


def test_the_header_of_most_files_is_the_tables(spark, folder):
    path = folder(a="v,id\nx,1\n", b="id,v\n2,y\n", c="id,v\n3,z\n", d="id,v,w\n4,p,q\n")
    scan = csvsrc.scan_csv(spark, path, "T", ALL)
    assert scan.clean.columns == ["id", "v"]
    assert rows(scan.clean) == [("1", "x"), ("2", "y"), ("3", "z")] and rows(scan.corrupt_rows) == [("4,p,q",)]


def test_files_below_an_unknown_header_count_for_the_gate(spark, folder):
    path = folder(a="id,v\n" + "1,x\n" * 8, b="id,v\n2,y\n", c="other\n9\n")
    with pytest.raises(csvsrc.CorruptRecordsError, match="10.00% > 9.0%"):
        csvsrc.scan_csv(spark, path, "T", Thresholds(max_corrupt_percent=9.0), columns=["id", "v"])
    assert csvsrc.scan_csv(spark, path, "T", Thresholds(max_corrupt_percent=10.0), columns=["id", "v"]).corrupt == 1


def test_equal_headers_need_no_second_read_and_odd_names_load(spark, folder):
    path = folder(a="a.b,c d,`e`\n1,2,3\n", b="a.b,c d,`e`\n4,5,6\n")
    scan = csvsrc.scan_csv(spark, path, "T")
    assert scan.headers == [] and rows(scan.clean) == [("1", "2", "3"), ("4", "5", "6")]
    (frame, groups) = headers.read_csv_by_header(spark, path, ["c d", "a.b", "`e`", "more"], with_file=True)
    assert [g.kind for g in groups] == ["short"]
    assert sorted(tuple(r)[:4] for r in frame.collect()) == [("2", "1", "3", None), ("5", "4", "6", None)]


def test_no_lines_at_all(spark, folder):
    path = folder(a="", b="")
    frame, groups = headers.read_csv_by_header(spark, path, ["id"])
    assert groups == [] and frame.columns == ["id", "_corrupt_record"] and frame.count() == 0
    with pytest.raises(ValueError, match="no header"):
        headers.read_csv_by_header(spark, path)


def audit_key(written):
    gate(quality_report(written, TableSpec("T", key=("k",))))


@pytest.fixture()
def db(spark, tmp_path):
    name = f"sluice_pub_{abs(hash(str(tmp_path)))}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    return name, f"{tmp_path}/db"


def frame(spark, *keys, note="n"):
    return spark.createDataFrame([(k, note, dt.date(2024, 1, 1)) for k in keys], "k int, note string, day date")


def test_a_blocked_version_leaves_readers_and_files_alone(spark, db):
    name, path = db
    table = f"{name}.t"
    stages = []
    first = publish.write_audit_publish(frame(spark, 1, 2), table, "r1", audit_key, path, ["day"], on_stage=stages.append)
    assert (first.rows, first.replayed) == (2, False) and stages == ["write", "validate", "publish"]
    reader = spark.read.table(table)
    with pytest.raises(QualityGateError, match="key_unique"):
        publish.write_audit_publish(frame(spark, 5, 5), table, "r2", audit_key, path)
    assert not spark.catalog.tableExists(publish.version_name(table, "r2"))
    assert rows(spark.read.table(table).select("k")) == [(1,), (2,)] == rows(reader.select("k"))
    # the same run again with mended rows
    assert publish.write_audit_publish(frame(spark, 5, 6), table, "r2", audit_key, path).rows == 2
    assert rows(spark.read.table(table).select("k")) == [(5,), (6,)]
    assert rows(reader.select("k")) == [(1,), (2,)]  # a query planned before the switch still has its files


def test_replay_changes_nothing_and_a_half_done_run_starts_anew(spark, db):
    name, path = db
    table = f"{name}.t"
    publish.write_audit_publish(frame(spark, 1), table, "r1", audit_key, path)
    again = publish.write_audit_publish(frame(spark, 7, 8, 9), table, "r1", audit_key, path)
    assert (again.rows, again.replayed) == (1, True) and rows(spark.read.table(table).select("k")) == [(1,)]

    def dies(stage):
        if stage == "publish":
            raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        publish.write_audit_publish(frame(spark, 2), table, "r2", audit_key, path, on_stage=dies)
    assert rows(spark.read.table(table).select("k")) == [(1,)] and spark.catalog.tableExists(publish.version_name(table, "r2"))
    publish.write_audit_publish(frame(spark, 2), table, "r2", audit_key, path)
    assert rows(spark.read.table(table).select("k")) == [(2,)]


def test_versions_kept_and_rolled_back(spark, db):
    name, path = db
    table = f"{name}.t"
    for i in range(4):
        publish.write_audit_publish(frame(spark, i), table, f"r{i}", audit_key, path, keep=2)
    left = {t.name for t in spark.catalog.listTables(name) if "__v_" in t.name}
    assert left == {"t__v_r2", "t__v_r3"}
    assert publish.roll_back(spark, table) == f"{name}.t__v_r2" and rows(spark.read.table(table).select("k")) == [(2,)]
    with pytest.raises(ValueError, match="no earlier"):
        publish.roll_back(spark, table)
    write_table(frame(spark, 1), f"{name}.plain", path=f"{path}/plain")
    with pytest.raises(ValueError, match="no published table"):
        publish.write_audit_publish(frame(spark, 1), f"{name}.plain", "r1", audit_key, path)


def test_ingest_publishes_through_the_registered_spec(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "olist_customers_dataset.csv").write_text("customer_id,customer_city,customer_state\nc1, rio ,rj\n")
    cfg = dict(database="sluice_wap", location=str(tmp_path / "wh"), publish=True)
    log, _ = ingest_all(spark, str(raw), IngestConfig(run_id="a", **cfg))
    assert rows(log.select("stage", "status", "record_count", "error_class")) == [("publish", "success", 1, None)]
    (raw / "olist_customers_dataset.csv").write_text("customer_id,customer_city,customer_state\nc1,x,y\nc1,x,z\n")
    log, reports = ingest_all(spark, str(raw), IngestConfig(run_id="b", **cfg))
    assert rows(log.select("stage", "status", "record_count", "error_class")) == [("validate", "failed", None, "QualityGateError")]
    assert reports.filter("check_name = 'key_unique' AND NOT passed").count() == 1
    got = spark.read.table("sluice_wap.olist_customers_dataset")
    assert rows(got.select("customer_city", "customer_state")) == [("RIO", "RJ")]
    assert got.filter(F.col("_processing_date").isNull()).count() == 0


@pytest.mark.parametrize("published", [True, False])
def test_a_runs_rows_are_not_sorted_by_day_before_they_are_written(spark, tmp_path, monkeypatch, published):
    """Sorts of whole splits took memory and spills that grew with the table."""
    from sluice.plans import ingest

    database = f"sluice_unsorted_{str(published).lower()}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{tmp_path}/db'")
    spark.sql(f"CREATE TABLE {database}.days (k BIGINT, day DATE) USING parquet PARTITIONED BY (day)")
    plans, module = [], publish if published else ingest
    write = module.write_table

    def spy(df, *args, **kwargs):
        plans.append(spark.sql(f"EXPLAIN INSERT INTO {database}.days SELECT id, DATE '2024-01-01' + CAST(id % 3 AS INT) FROM range(9)").first()[0])
        spark.sql(f"INSERT INTO {database}.days SELECT id, DATE '2024-01-01' + CAST(id % 3 AS INT) FROM range(9)")  # days beyond the first
        return write(df, *args, **kwargs)

    monkeypatch.setattr(module, "write_table", spy)
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.csv").write_text("k,v\n1,x\n2,y\n")
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    log, _ = ingest_all(spark, str(tmp_path / "raw"), IngestConfig(run_id="a", database=database, location=str(tmp_path / "wh"), publish=published))
    assert rows(log.select("status", "record_count")) == [("success", 2)]
    assert len(plans) == 1 and "WriteFiles" in plans[0] and "Sort" not in plans[0]
    assert rows(spark.read.table(f"{database}.days").selectExpr("k", "datediff(day, DATE '2024-01-01')")) == [(k, k % 3) for k in range(9)]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
