"""Plan shapes the README relies on, read from ``explain`` output (after execution for AQE plans)."""

import contextlib
import io

from pyspark.sql import functions as F

from sluice.operators import quality, silver
from sluice.plans import registry
from sluice.specs import TableSpec

SF = "/root/testdata/sf0.001"


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def test_lazy_report_scans_once_and_reuses_the_row_exchange(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    rep = quality.quality_report_plan(o, registry.ORDERS_SPEC)
    rep.collect()
    p = plan(rep)
    assert "ReusedExchange" in p


def test_filters_and_projection_reach_the_scan(spark):
    p = plan(registry.q_invalid_values(spark, SF))
    assert "PushedFilters: [Not(In(o_orderstatus, [F,O]))]" in p or "NOT o_orderstatus" in p
    assert "ReadSchema: struct<o_orderstatus:string>" in p


def test_day_filter_prunes_partitions(spark):
    df = registry.q_partitioned_roundtrip(spark, SF)
    p = plan(df)
    assert "PartitionFilters: [isnotnull(event_day" in p and "2024-01-15" in p


def test_small_dimensions_are_broadcast_and_dedup_has_no_window(spark):
    assert "BroadcastHashJoin" in plan(registry.q_fact_sales(spark, SF))
    p = plan(registry.q_dedup_latest(spark, SF))
    assert "Window" not in p and "max_by" in p


def test_large_unique_reference_joins_without_an_aggregate(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey", "l_linenumber")
    o = spark.read.parquet(f"{SF}/orders.parquet")
    p = plan(silver.enrich(li, o, {"l_orderkey": "o_orderkey"}, ["o_orderdate"], max_broadcast_rows=0), "simple")
    join_side = p.split("Join", 1)[1]
    assert "Aggregate" not in join_side  # both inputs are plain shuffles: AQE can split a hot key


def test_key_statistics_read_only_the_key(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    per_key = o.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("kn"))
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan(per_key)
    # the same branch as inside quality_report's first job
    rep = quality.quality_report(o, TableSpec("orders", key=("o_orderkey",)))
    assert rep.filter("check_name = 'key_unique'").first().passed


def test_tables_bucketed_on_the_join_key_join_without_a_shuffle(spark, tmp_path):
    from sluice.sinks.tables import write_table

    spark.sql(f"CREATE DATABASE IF NOT EXISTS sluice_bkt LOCATION '{tmp_path}/db'")
    li = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey", "l_quantity")
    o = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_orderdate")
    write_table(li, "sluice_bkt.li", path=str(tmp_path / "db" / "li"), bucket_by=(8, ["l_orderkey"]))
    write_table(o, "sluice_bkt.o", path=str(tmp_path / "db" / "o"), bucket_by=(8, ["o_orderkey"]))
    a, b = spark.read.table("sluice_bkt.li"), spark.read.table("sluice_bkt.o")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = a.join(b, a.l_orderkey == b.o_orderkey)
        p = plan(j, "simple")
        assert "SortMergeJoin" in p and "Exchange" not in p
        assert j.count() == li.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_daily_kpis_counts_distinct_orders_without_expand(spark):
    p = plan(registry.q_daily_kpis(spark, SF), "simple")
    assert "Expand" not in p
