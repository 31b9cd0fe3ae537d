"""Trailing windows and stored quantile states."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from sluice.operators import panes

from helpers import rows

RUNS = "job string, status string, started_at timestamp_ntz, duration_s double, records long"
T0 = dt.datetime(2024, 1, 1)


def some_runs(n=800, minutes=4000, seed=1):
    rng = random.Random(seed)
    return [(rng.choice(["a", "b", None]), rng.choice(["success", "failed", "other"]), T0 + dt.timedelta(seconds=rng.randrange(minutes * 60)),
             rng.choice([0.0, rng.uniform(0.001, 5000), -rng.uniform(1, 9)]), rng.randrange(9)) for _ in range(n)]


def brute(runs, length, step):
    panes_ = sorted({math.floor((r[2] - T0).total_seconds() / step) for r in runs})
    out = []
    for p in range(panes_[0], panes_[-1] + 1):
        end = T0 + dt.timedelta(seconds=(p + 1) * step)
        own = [r for r in runs if end - dt.timedelta(seconds=length) <= r[2] < end]
        ok, bad, rec = sum(r[1] == "success" for r in own), sum(r[1] == "failed" for r in own), sum(r[4] for r in own)
        out.append((end, len(own), ok, bad, rec, ok * 100.0 / len(own) if own else None, rec / length, bad / length))
    return out


@pytest.mark.parametrize("chunk", [12, 2048])
def test_trailing_rates(spark, monkeypatch, chunk):
    monkeypatch.setattr(panes, "PANES_PER_CHUNK", chunk)
    runs = some_runs(120)
    df = spark.createDataFrame([*runs, ("a", "success", None, 1.0, 1)], RUNS)
    assert rows(panes.trailing_rates(df)) == brute(runs, 3600.0, 300)
    got = panes.trailing_rates(df, "20 minutes", "5 minutes", by=["job"])
    for job in ("a", "b", None):
        mine = [r for r in runs if r[0] == job]
        assert rows(got.filter(F.col("job").eqNullSafe(job)).drop("job")) == brute(mine, 1200.0, 300)


def test_trailing_rates_edges(spark):
    with pytest.raises(ValueError, match="multiple"):
        panes.trailing_rates(spark.createDataFrame([], RUNS), "7 minutes", "5 minutes")
    assert panes.trailing_rates(spark.createDataFrame([], RUNS)).count() == 0
    one = spark.createDataFrame([("a", "success", T0, 1.0, None)], RUNS)  # a start on the border belongs to the pane it opens
    assert rows(panes.trailing_rates(one)) == [(T0 + dt.timedelta(minutes=5), 1, 1, 0, 0, 100.0, 0.0, 0.0)]


def test_merged_states_equal_direct_ones_and_keep_the_bound(spark):
    runs = some_runs(3000)
    df = spark.createDataFrame([*runs, ("a", "x", T0, None, 1), ("a", "x", T0, float("nan"), 1)], RUNS)
    five = panes.quantile_states(df)
    for length in ("1 hour", "1 day"):
        merged = panes.merge_states(panes.merge_states(five, "30 minutes"), length)
        assert rows(merged) == rows(panes.quantile_states(df, length))
    for q in (0.0, 0.5, 0.95, 1.0):
        for r in panes.state_quantile(panes.merge_states(five, "1 day"), q).collect():
            own = sorted(x[3] for x in runs if x[0] == r.job and x[2].date() == r.pane_start.date())
            exact = own[math.floor(q * (len(own) - 1))]
            assert r.runs == len(own) and abs(r.quantile - exact) <= panes.RELATIVE_ERROR * abs(exact)


def test_buckets_ascend_with_the_value(spark):
    values = [-math.inf, -1e300, -2.0, -1e-300, 0.0, 1e-300, 0.5, 1.0, 1e300, math.inf]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", panes.bucket_of(F.col("v")).alias("b"))
    got = [r.b for r in df.orderBy("v").collect()]
    assert got == sorted(got) and len(set(got)) == len(got)
