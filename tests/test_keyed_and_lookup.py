"""Skew-safe lookups, keyed upserts, appends that count once."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from sluice.operators.lookup import heavy_keys, lookup
from sluice.operators.silver import dedup_latest
from sluice.sinks.keyed import KeyedTable, PostActionError, append_run

from helpers import rows


def test_lookup_equals_a_plain_one(spark):
    rng = random.Random(3)
    facts = [(i, rng.choice([1] * 10 + [None] * 3 + list(range(2, 40))), "f") for i in range(2000)] + [(5000, 1, "f")] * 50  # copies too
    ref = [(k % 30, f"n{k}", k) for k in range(90)] + [(None, "null", 1), (7, "tie-a", 99), (7, "tie-b", 99)]
    f = spark.createDataFrame(facts, "id int, k int, own string")
    r = spark.createDataFrame(ref, "rk int, name string, ver int")
    got = lookup(f, r, {"k": "rk"}, ["name", "ver"], ["ver"], fallback={"name": "own", "ver": F.lit(-1)}, partitions=8)
    best = {}
    for k, name, ver in ref:
        if k is not None and (k not in best or (ver, name) > best[k]):
            best[k] = (ver, name)
    expected = [(i, k, o, *((best[k][1], best[k][0], True) if k in best else (o, -1, False))) for i, k, o in facts]
    assert sorted(map(str, rows(got))) == sorted(map(str, expected))
    assert got.count() == len(facts)


def test_a_hot_key_is_dealt_over_partitions(spark):
    f = spark.range(0, 30_000, numPartitions=6).select("id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.lit(None))
                                                       .otherwise(F.col("id")).cast("long").alias("k"))
    r = spark.range(30_000).select(F.col("id").alias("rk"), F.col("id").cast("string").alias("name"))
    heavy = {x.k: x._splits for x in heavy_keys(f, ["k"], 16).collect()}
    assert heavy == {7: 6, None: 6}
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = lookup(f, r, {"k": "rk"}, ["name"], ["name"])
        sizes = [x.n for x in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sum(sizes) == 30_000 and max(sizes) < 7_500  # a plain join: 10,000 rows of the hot key and as many NULLs in one task each


def test_lookup_edges(spark):
    f = spark.createDataFrame([], "id int, k int")
    r = spark.createDataFrame([(1, "a")], "rk int, name string")
    assert lookup(f, r, {"k": "rk"}, ["name"], ["name"]).count() == 0
    one = spark.createDataFrame([(1, 1)], "id int, k int")
    assert rows(lookup(one, r.limit(0), {"k": "rk"}, ["name"], ["name"])) == [(1, 1, None, False)]
    with pytest.raises(ValueError, match="hidden"):
        lookup(one, r.withColumn("id", F.lit(1)), {"k": "rk"}, ["id"], ["name"])


SCHEMA = "k int, ts int, v string"


def test_upserts_equal_one_run_and_leave_other_buckets(spark, tmp_path):
    rng = random.Random(5)
    data = [(rng.choice([None, *range(40)]), i, f"v{i}") for i in range(300)]
    rng.shuffle(data)
    schema = spark.createDataFrame([], SCHEMA).schema
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ["k"], ["ts"], buckets=8)
    assert table.read().count() == 0 and table.upsert(spark.createDataFrame([], SCHEMA)) == []
    for part in (data[:100], data[60:200], data[60:200], data[200:]):
        table.upsert(spark.createDataFrame(part, SCHEMA))
    assert rows(table.read()) == rows(dedup_latest(spark.createDataFrame(data, SCHEMA), ["k"], ["ts"]))
    files = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{table.path}/*/*.parquet")}
    touched = table.upsert(spark.createDataFrame([(3, 1000, "new"), (4, -1, "old")], SCHEMA))
    same = {f for f, t in files.items() if os.path.exists(f) and os.stat(f).st_mtime_ns == t}
    assert len(touched) <= 2 and {f for f in files if int(f.split("_bucket=")[1].split("/")[0]) not in touched} == same
    assert rows(table.read().filter("k in (3, 4)").select("k", "v"))[0] == (3, "new")
    again = KeyedTable(spark, str(tmp_path / "t"), schema, ["k"], ["ts"], buckets=8)
    assert again.read().count() == 41


@pytest.fixture()
def db(spark, tmp_path):
    name = f"sluice_app_{abs(hash(str(tmp_path)))}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    return f"{name}.t", f"{tmp_path}/db/t"


def test_append_counts_once(spark, db):
    table, path = db
    assert append_run(spark.range(3), table, "r1", path).rows == 3
    assert append_run(spark.range(9), table, "r1", path).replayed  # other rows of a run that is done: not written
    assert append_run(spark.range(2), table, "r2", path).rows == 2
    assert append_run(spark.range(0), table, "r3", path).rows == 0 and append_run(spark.range(4), table, "r3", path).replayed
    assert rows(spark.read.table(table)) == [(0, "r1"), (0, "r2"), (1, "r1"), (1, "r2"), (2, "r1")]


def test_a_failed_post_action_takes_the_append_back(spark, db):
    table, path = db
    append_run(spark.range(1), table, "r1", path)
    with pytest.raises(PostActionError, match="r2"):
        append_run(spark.range(5), table, "r2", path, post_sql=["SELECT 1", "SELECT raise_error('no')"])
    assert spark.read.table(table).count() == 1
    with pytest.raises(Exception, match="no_such"):
        append_run(spark.range(5), table, "r2", path, pre_sql="SELECT * FROM no_such")
    assert spark.read.table(table).count() == 1
    assert append_run(spark.range(2), table, "r2", path, post_sql="SELECT 1").rows == 2
    assert spark.read.table(table).count() == 3


def test_an_attempt_that_died_before_the_commit_is_unseen(spark, db):
    table, path = db
    append_run(spark.range(1), table, "r1", path)
    spark.range(7).write.parquet(f"{path}/run_id=r2")  # files without a registered partition
    assert spark.read.table(table).count() == 1
    assert append_run(spark.range(2), table, "r2", path).rows == 2
    assert spark.read.table(table).filter("run_id = 'r2'").count() == 2
    for bad in ("", "a/b", "x'"):
        with pytest.raises(ValueError):
            append_run(spark.range(1), table, bad, path)
    with pytest.raises(ValueError, match="already"):
        append_run(spark.range(1).withColumn("run_id", F.lit("x")), table, "r9", path)
