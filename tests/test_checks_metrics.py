import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from sluice.operators import checks, metrics

from helpers import rows

T0 = dt.datetime(2024, 1, 15, 10, 0, 0)


def test_record_counts_give_zero_and_freshness_gives_no_row(spark):
    a = spark.createDataFrame([(dt.date(2024, 1, 15), T0), (dt.date(2024, 1, 15), T0 + dt.timedelta(hours=1))],
                              "_processing_date date, _ingestion_timestamp timestamp")
    b = spark.createDataFrame([(dt.date(2024, 1, 14), T0)], "_processing_date date, _ingestion_timestamp timestamp")
    rc = {r.table_name: (r.record_count, r.passed) for r in checks.record_counts({"A": a, "B": b}, dt.date(2024, 1, 15)).collect()}
    assert rc == {"A": (2, True), "B": (0, False)}
    fr = checks.freshness({"A": a, "B": b}, "2024-01-15").collect()
    assert [(r.table_name, r.records_today) for r in fr] == [("A", 2)]
    assert fr[0].latest_ingestion.replace(tzinfo=None) == T0 + dt.timedelta(hours=1)


def _runs(spark, spec):
    """spec: (job, dag, status, start offset minutes, duration seconds)"""
    data = [(i, j, d, s, T0 + dt.timedelta(minutes=m), dur) for i, (j, d, s, m, dur) in enumerate(spec)]
    df = spark.createDataFrame(data, "run_id long, job string, dag_id long, status string, started_at timestamp_ntz, duration_s double")
    return df.select("*", F.timestamp_add("MICROSECOND", (F.col("duration_s") * 1e6).cast("long"), "started_at").alias("ended_at"),
                     F.lit(1).cast("long").alias("records"))


def test_success_and_failure_rates_and_bands(spark):
    spec = [("a", 1, "success", m, 30.0) for m in range(19)] + [("a", 1, "failed", 20, 30.0)]
    spec += [("b", 2, "success", 70, 10.0)] * 4 + [("b", 2, "failed", 75, 10.0)]
    r = _runs(spark, spec)
    sr = rows(metrics.status_bands(metrics.success_rate(r, "1 hour")).select("runs", "succeeded", "success_rate", "band"))
    assert sr == [(5, 4, 80.0, "yellow"), (20, 19, 95.0, "green")]
    fr = rows(metrics.failure_rate(r, "1 hour").select("dag_id", "failures", "failures_per_second"))
    assert fr == [(1, 1, 1 / 3600), (2, 1, 1 / 3600)]
    rps = metrics.records_per_second(r, "5 minutes").agg(F.sum("records")).first()[0]
    assert rps == len(spec)


def test_band_edges(spark):
    df = spark.createDataFrame([(95.0,), (94.99,), (80.0,), (79.99,), (0.0,)], "v double")
    got = [r.b for r in df.select(metrics.band("v").alias("b")).collect()]
    assert got == ["green", "yellow", "yellow", "red", "red"]
    g = spark.createDataFrame([(0,), (4,), (5,), (9,), (10,)], "v int")
    got = [r.b for r in g.select(metrics.band("v", higher_is_better=False, **metrics.ACTIVE_RUN_BANDS).alias("b")).collect()]
    assert got == ["green", "green", "yellow", "yellow", "red"]


def test_active_runs_series_matches_brute_force(spark):
    spec = [("a", 1, "success", m, d) for m, d in [(0, 59.0), (0, 60.0), (0, 61.0), (1, 200.0), (3, 0.5), (2, 120.0)]]
    r = _runs(spark, spec)
    got = {row.at_time: row.active_runs for row in metrics.active_runs(r, "1 minute").collect()}
    want = {}
    for _, _, _, m, d in spec:
        start = T0 + dt.timedelta(minutes=m)
        end = start + dt.timedelta(seconds=d)
        p = start
        while p < end:
            want[p] = want.get(p, 0) + 1
            p += dt.timedelta(minutes=1)
    assert got == {p: want.get(p, 0) for p in (min(want) + dt.timedelta(minutes=i) for i in range(len(got)))}
    assert max(got) == max(want)
    at = metrics.active_runs_at(r, T0 + dt.timedelta(minutes=1)).first().active_runs
    assert at == sum(1 for _, _, _, m, d in spec
                     if T0 + dt.timedelta(minutes=m) <= T0 + dt.timedelta(minutes=1) < T0 + dt.timedelta(minutes=m, seconds=d))


def test_active_runs_keeps_open_runs_and_idle_points(spark):
    # closed 0-1 and 5-6, open from 8; one with its end before its start covers nothing
    rows = [(T0, T0 + dt.timedelta(minutes=1)), (T0 + dt.timedelta(minutes=5), T0 + dt.timedelta(minutes=6)),
            (T0 + dt.timedelta(minutes=8), None), (T0 + dt.timedelta(minutes=3), T0)]
    r = spark.createDataFrame(rows, "started_at timestamp_ntz, ended_at timestamp_ntz")
    got = [x.active_runs for x in metrics.active_runs(r).orderBy("at_time").collect()]
    assert got == [1, 0, 0, 0, 0, 1, 0, 0, 1]
    assert metrics.active_runs(r.limit(0)).count() == 0


def test_active_runs_long_run_crosses_chunks(spark):
    r = spark.createDataFrame([(T0, T0 + dt.timedelta(days=3)), (T0 + dt.timedelta(days=1), T0 + dt.timedelta(days=2))],
                              "started_at timestamp_ntz, ended_at timestamp_ntz")
    got = [x.active_runs for x in metrics.active_runs(r).orderBy("at_time").collect()]
    assert got == [1] * 1440 + [2] * 1440 + [1] * 1440


def test_exact_and_approximate_quantiles(spark):
    vals = [float(v) for v in range(1, 101)]
    r = _runs(spark, [("a", 1, "success", 0, v) for v in vals])
    exact = metrics.duration_quantile(r, 0.95, "1 day", exact=True).first().p95
    assert abs(exact - np.percentile(vals, 95)) < 1e-9
    approx = metrics.duration_quantile(r, 0.95, "1 day").first().p95
    assert abs(approx - exact) <= 1.0


def test_run_durations_and_dq_series(spark):
    r = _runs(spark, [("a", 1, "success", 0, 1.5)])
    assert metrics.run_durations(r).first().duration_seconds == 1.5
    rep = spark.createDataFrame(
        [("T", "null_percent", "x", "warning", 12.0, 10.0, False, "m"), ("T", "key_unique", "k", "error", 1.0, 0.0, False, "m"),
         ("T", "record_count", None, "error", 3.0, 0.0, True, "ok")],
        "table_name string, check_name string, column_name string, severity string, metric double, threshold double, passed boolean, message string")
    s = metrics.dq_series(rep).first()
    assert (s.validation_failures, s.blocking_failures, s.max_null_percent) == (2, 1, 12.0)


def test_runs_from_events(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    r = metrics.runs_from_events(ev)
    assert r.count() == ev.count()
    assert r.filter("status = 'failed'").count() == ev.filter("event_type = 'error'").count()


def test_exact_quantile_matches_numpy_with_a_hot_group(spark):
    rng = np.random.default_rng(7)
    hot = rng.integers(0, 10_000, 3000) / 100.0        # one group with a third of the rows, many distinct values
    rest = [(f"g{i % 40}", float(x)) for i, x in enumerate(rng.normal(50, 20, 6000).round(2))]
    data = [("hot", float(x)) for x in hot] + rest + [("one", 5.0), ("nulls", None), (None, 1.0), (None, 3.0)]
    df = spark.createDataFrame(data, "g string, v double")
    for q in (0.0, 0.5, 0.95, 1.0):
        got = {r.g: r.quantile for r in metrics.exact_quantile(df, ["g"], "v", q, partitions=16).collect()}
        for g in {d[0] for d in data} - {"nulls"}:
            vals = np.array([d[1] for d in data if d[0] == g and d[1] is not None])
            assert abs(got[g] - np.quantile(vals, q)) < 1e-9, (g, q)
        assert "nulls" not in got
    spark.conf.set("spark.sql.exchange.reuse", "false")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        again = {r.g: r.quantile for r in metrics.exact_quantile(df, ["g"], "v", 0.95, partitions=16).collect()}
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(again) == len({d[0] for d in data}) - 1
    assert abs(again["hot"] - np.quantile(hot, 0.95)) < 1e-9


def test_exact_duration_quantile_keeps_a_null_job(spark):
    r = _runs(spark, [("a", 1, "success", 0, 10.0), ("a", 1, "success", 1, 20.0), (None, 1, "success", 2, 7.0)])
    got = {row.job: (row.runs, row.p50) for row in metrics.duration_quantile(r, 0.5, "1 day", exact=True).collect()}
    assert got == {"a": (2, 15.0), None: (1, 7.0)}


def test_day_filters_accept_a_datetime(spark):
    a = spark.createDataFrame([(dt.date(2024, 1, 15), T0)], "_processing_date date, _ingestion_timestamp timestamp")
    assert checks.record_counts({"A": a}, dt.datetime(2024, 1, 15, 18, 30)).first().record_count == 1
