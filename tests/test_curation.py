import datetime as dt

import pytest
from pyspark.sql import functions as F

from sluice.operators import gold, ops, silver
from sluice.specs import TableSpec

from helpers import rows


def test_dedup_latest_matches_brute_force_with_a_hot_key(spark):
    data = [(0, i, f"v{i}") for i in range(300)] + [(k, 1, f"w{k}") for k in range(1, 200)] + [(7, 5, "late"), (7, 5, "tie")]
    df = spark.createDataFrame(data, "k int, ts int, v string")
    got = rows(silver.dedup_latest(df, ["k"], ["ts", "v"]))
    best = {}
    for k, ts, v in data:
        if k not in best or (ts, v) > best[k][1:]:
            best[k] = (k, ts, v)
    assert got == sorted(best.values())


def test_enrich_never_multiplies_rows_and_falls_back(spark):
    fact = spark.createDataFrame([("a", 1), ("b", 2), ("z", 3)], "cat string, n int")
    ref = spark.createDataFrame([("a", "A"), ("a", "A2"), ("b", "B")], "name string, english string")
    out = silver.enrich(fact, ref, {"cat": "name"}, ["english"], fallback={"english": "cat"})
    got = rows(out)
    assert len(got) == 3 and ("z", 3, "z") in got and ("b", 2, "B") in got
    big = silver.enrich(fact, ref, {"cat": "name"}, ["english"], max_broadcast_rows=1)
    assert big.count() == 3


def test_apply_rules_splits_with_the_first_broken_rule(spark):
    df = spark.createDataFrame([(1, 0.1), (-1, 0.1), (2, None), (-3, None)], "q int, d double")
    kept, rejected = silver.apply_rules(df, {"positive": "q > 0", "has_discount": F.col("d").isNotNull()})
    assert rows(kept) == [(1, 0.1)]
    assert rows(rejected.select("q", "_rejected_by")) == [(-3, "positive"), (-1, "positive"), (2, "has_discount")]


def test_standardize_renames_and_fills(spark):
    df = spark.createDataFrame([(" a ", "1.5"), (None, "x")], "name string, price string")
    out = silver.standardize(df, TableSpec("T", casts={"price": "double"}, upper_trim=("name",)),
                             rename={"name": "label"}, fill={"label": "?"})
    assert rows(out) == [("?", None), ("A", 1.5)]


def test_fact_dim_summary_and_view(spark):
    sales = spark.createDataFrame([(1, 10, 2.0), (2, 10, 3.0), (3, 20, 4.0)], "id int, cust int, amount double")
    cust = spark.createDataFrame([(10, "x", 1), (20, "y", 2)], "cust_id int, name string, nation int")
    nation = spark.createDataFrame([(1, "N1"), (2, "N2")], "n int, nname string")
    dim = gold.build_dim(cust, ["cust_id"], ["name", "nation"], [(nation, {"nation": "n"}, ["nname"])])
    assert rows(dim) == [(10, "x", 1, "N1"), (20, "y", 2, "N2")]
    fact = gold.build_fact(sales, {"amount2": F.col("amount") * 2}, [(dim, {"cust": "cust_id"}, ["nname"])], keep=["id", "cust"])
    s = gold.summarize(fact, ["nname"], {"total": F.sum("amount2")}, rollup=True)
    assert rows(s) == [("N1", 10.0), ("N2", 8.0), (None, 18.0)]
    name = gold.publish_view(s, "sluice_test_view")
    assert spark.sql(f"SELECT count(*) FROM {name}").first()[0] == 3


def test_schema_drift(spark):
    a = spark.createDataFrame([], "a int, b string, c double").schema
    b = spark.createDataFrame([], "a bigint, c double, b string, d string").schema
    got = rows(ops.schema_drift(spark, a, b))
    assert got == [("a", "retyped", "int", "bigint"), ("b", "moved", "string", "string"),
                   ("c", "moved", "double", "double"), ("d", "added", None, "string")]


def test_count_trend(spark):
    df = spark.createDataFrame([("t", dt.datetime(2024, 1, d)) for d in (1, 1, 2, 3, 3, 3)], "t string, ts timestamp")
    got = rows(ops.count_trend(df, "t", "ts"), order=["day"])
    assert [(r[2], r[3], r[4]) for r in got] == [(2, None, None), (1, 2, -50.0), (3, 1, 200.0)]


def test_mask_columns(spark):
    df = spark.createDataFrame([("Ab1-z", "123456", "secret", "k")], "a string, b string, c string, d string")
    r = ops.mask_columns(df, {"a": "mask", "b": "last4", "c": "redact", "d": "hash"}).first()
    assert (r.a, r.b, r.c) == ("Xxn-x", "**3456", "****") and len(r.d) == 64
    with pytest.raises(ValueError):
        ops.mask_columns(df, {"a": "rot13"})


def test_lineage_columns(spark, tmp_path):
    p = str(tmp_path / "l")
    spark.range(3).write.parquet(p)
    out = ops.with_lineage(spark.read.parquet(p))
    assert out.filter(F.col("_file_path").contains("/l/")).count() == 3


def test_cluster_conf_sizes_shuffles_from_the_input():
    from sluice.session import cluster_conf

    small = cluster_conf(8)
    assert small["spark.sql.shuffle.partitions"] == "200" and small["spark.sql.adaptive.enabled"] == "true"
    big = cluster_conf(4000, 100 * 2**40)  # 100 TB on 4000 cores: one 256 MB partition per slice of input
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (256 << 20) + 1
    assert big["spark.sql.files.maxPartitionBytes"] == "256m"
