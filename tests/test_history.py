"""Days kept while the schema changes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.plans.ingest import IngestConfig, ingest_all
from sluice.sinks import history
from sluice.specs import TableSpec

from helpers import rows


@pytest.fixture()
def table(spark, tmp_path):
    name = f"sluice_his_{abs(hash(str(tmp_path)))}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    return f"{name}.t", f"{tmp_path}/db/t"


def day(df, n):
    return df.withColumn("_processing_date", F.lit(dt.date(2024, 1, n)))


def test_added_widened_and_removed_columns(spark, table):
    name, path = table
    history.append_day(day(spark.createDataFrame([(1, 5, 1.5, "x")], "k int, n int, f float, s string"), 1), name, path)
    first = {f: open(f[len("file:"):].replace("//", "/"), "rb").read() for f in spark.read.table(name).inputFiles()}
    history.append_day(day(spark.createDataFrame([(2, 1 << 40, 2.25, "y", True)], "K int, n bigint, f double, s string, b boolean"), 2), name, path)
    schema = history.append_day(day(spark.createDataFrame([(3, "z")], "k int, s string"), 3), name, path)
    assert [f.simpleString() for f in schema.fields] == ["k:int", "n:bigint", "f:double", "s:string", "b:boolean", "_processing_date:date"]
    assert rows(spark.read.table(name).drop("_processing_date")) == [
        (1, 5, 1.5, "x", None), (2, 1 << 40, 2.25, "y", True), (3, None, None, "z", None)]
    assert all(open(f[len("file:"):].replace("//", "/"), "rb").read() == data for f, data in first.items())
    history.append_day(day(spark.createDataFrame([(9, "w")], "k int, s string"), 2), name, path)  # that day again
    assert rows(spark.read.table(name).select("k")) == [(1,), (3,), (9,)]
    with pytest.raises(history.SchemaConflict, match="column s"):
        history.append_day(day(spark.createDataFrame([(1, 2)], "k int, s int"), 4), name, path)
    assert spark.read.table(name).count() == 3


def test_widening_rules():
    wide = history.wider_type
    assert wide(T.IntegerType(), T.LongType()) == T.LongType() == wide(T.LongType(), T.ShortType())
    assert wide(T.DoubleType(), T.IntegerType()) == T.DoubleType()
    assert wide(T.DecimalType(10, 2), T.DecimalType(8, 4)) == T.DecimalType(12, 4)
    for a, b in ((T.LongType(), T.DoubleType()), (T.StringType(), T.IntegerType()), (T.DecimalType(38, 0), T.DecimalType(38, 10))):
        with pytest.raises(history.SchemaConflict):
            wide(a, b)


def test_ingest_keeps_days_across_a_schema_change(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    base = dict(database="sluice_evolve", location=str(tmp_path / "wh"), keep_history=True)
    one, two = TableSpec("THINGS", casts={"n": "int"}), TableSpec("THINGS", casts={"n": "double"})
    (raw / "things.csv").write_text("id,n\na,1\n")
    ingest_all(spark, str(raw), IngestConfig(as_of=dt.datetime(2024, 1, 1, 2), registry={"THINGS": one}, **base))
    (raw / "things.csv").write_text("id,n,note\nb,2.5,hi\n")
    log, _ = ingest_all(spark, str(raw), IngestConfig(as_of=dt.datetime(2024, 1, 2, 2), registry={"THINGS": two}, **base))
    assert rows(log.select("status", "schema_changes", "error")) == [("success", "retyped:n,added:note", None)]
    got = spark.read.table("sluice_evolve.things")
    assert rows(got.select("id", "n", "note")) == [("a", 1.0, None), ("b", 2.5, "hi")]
    (raw / "things.csv").write_text("id,n,note\nc,x,ho\n")
    log, _ = ingest_all(spark, str(raw), IngestConfig(as_of=dt.datetime(2024, 1, 3, 2), **base))  # n is text now
    assert rows(log.select("status", "error_class")) == [("failed", "SchemaConflict")]
    assert spark.read.table("sluice_evolve.things").count() == 2
