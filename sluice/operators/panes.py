"""Metrics kept as mergeable rows per pane of time.

A pane is a short tumbling window (5 minutes, say). Runs are read once and summed per pane; everything longer is made
of panes:

* ``trailing_rates``: rates over a trailing window at every pane's end. A frame over panes sums them, so a run is
  never copied into the windows it belongs to;
* ``quantile_states``: durations per pane as counts of logarithmic buckets. Sums of counts are the state of the union, so
  hours and days come from stored panes, without the runs, and equal what the runs would give.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sluice.functions.timecols import percent
from sluice.operators.metrics import window_seconds
from sluice.session import cut_lineage

#: Panes that one task sums in order.
PANES_PER_CHUNK = 2048


def _epoch(runs: DataFrame, ts: str) -> Column:
    return F.lit("1970-01-01 00:00:00").cast(runs.schema[ts].dataType)


def pane_sums(runs: DataFrame, step: str = "5 minutes", ts: str = "started_at", by: Sequence[str] = (), records: str = "records") -> DataFrame:
    """(by..., pane, runs, succeeded, failed, records): ``pane`` counts steps since 1970. Rows without a time are left out."""
    pane = F.floor(F.timestamp_diff("SECOND", _epoch(runs, ts), F.col(ts)) / window_seconds(step))
    return runs.filter(F.col(ts).isNotNull()).groupBy(*by, pane.alias("pane")).agg(
        F.count(F.lit(1)).alias("runs"), F.count_if(F.col("status") == "success").alias("succeeded"),
        F.count_if(F.col("status") == "failed").alias("failed"), F.coalesce(F.sum(records), F.lit(0)).alias("records"))


def trailing_rates(runs: DataFrame, length: str = "1 hour", step: str = "5 minutes", ts: str = "started_at",
                   by: Sequence[str] = (), records: str = "records") -> DataFrame:
    """MET-1/3/5 over a trailing window: at every multiple of ``step`` the runs that started in the ``length`` before it.

    Columns: by..., at_time (end of a pane), runs, succeeded, failed, records, success_rate (%; NULL without runs),
    records_per_second, failures_per_second. Every pane from a group's first to its last has a row, idle ones too.
    ``length`` is a multiple of ``step``.

    Panes lie in chunks; the last panes of a chunk, as many as a window reaches back, are copied into the next one, so a
    task sums one chunk in order, however long the series is.
    """
    secs, by = window_seconds(step), list(by)
    reach, left = divmod(window_seconds(length), secs)
    if left or reach < 1:
        raise ValueError(f"{length} is no multiple of {step}")
    size = max(PANES_PER_CHUNK, reach)
    sums = cut_lineage(pane_sums(runs, step, ts, by, records), name="panes")  # read three times
    # idle panes: each pane is followed by the empty ones up to the group's next pane, found per chunk of the grid
    span = sums.groupBy(*by).agg(F.min("pane").alias("first"), F.max("pane").alias("last"))
    chunk = F.explode(F.sequence(F.floor(F.col("first") / size), F.floor(F.col("last") / size)))
    chunks = span.select(*by, "first", "last", chunk.alias("chunk"))
    grid = chunks.select(*[F.col(c).alias(f"_g_{c}") for c in by],
                         F.explode(F.sequence(F.greatest("first", F.col("chunk") * size),
                                              F.least("last", F.col("chunk") * size + (size - 1)))).alias("_g_pane"))
    own = [F.col(c) for c in by]
    cond = F.col("_g_pane") == F.col("pane")
    for c in by:
        cond = cond & F.col(f"_g_{c}").eqNullSafe(F.col(c))
    measures = ("runs", "succeeded", "failed", "records")
    dense = grid.join(sums, cond, "left").select(*[F.col(f"_g_{c}").alias(c) for c in by], F.col("_g_pane").alias("pane"),
                                                 *[F.coalesce(F.col(m), F.lit(0)).alias(m) for m in measures])
    home = F.floor(F.col("pane") / size)
    homes = F.when(F.col("pane") % size >= size - (reach - 1), F.array(home, home + 1)).otherwise(F.array(home))
    placed = dense.withColumn("_home", home).withColumn("_chunk", F.explode(homes))
    frame = Window.partitionBy(*own, "_chunk").orderBy("pane").rangeBetween(-(reach - 1), 0)
    summed = placed.select(*own, "pane", "_home", "_chunk", *[F.sum(m).over(frame).cast("long").alias(m) for m in measures])
    window = float(window_seconds(length))
    return summed.filter("_home = _chunk").select(
        *own, F.timestamp_add("SECOND", (F.col("pane") + 1) * secs, _epoch(runs, ts)).alias("at_time"), *measures,
        F.when(F.col("runs") > 0, percent(F.col("succeeded"), F.col("runs"))).alias("success_rate"),
        (F.col("records").cast("double") / F.lit(window)).alias("records_per_second"),
        (F.col("failed").cast("double") / F.lit(window)).alias("failures_per_second"))


# --- quantile states -------------------------------------------------------------------------------------------

#: Width of a bucket: values in one differ by less than this share.
RELATIVE_ERROR = 0.01
_ZERO = 1 << 20


def bucket_of(value: Column, error: float = RELATIVE_ERROR) -> Column:
    """The number of a value's bucket, ascending with the value: powers of 1 + ``error``, mirrored for negative values, one
    bucket for zero. NULL and NaN have none."""
    size = F.ceil(F.log(F.abs(value)) / F.log(F.lit(1.0 + error)))
    number = F.when(value == 0, F.lit(0)).when(value > 0, size + _ZERO).otherwise(-size - _ZERO)
    infinite = F.abs(value) == F.lit(float("inf"))
    return F.when(value.isNull() | F.isnan(value), F.lit(None)).when(infinite, F.signum(value) * (2 * _ZERO)).otherwise(number).cast("long")


def quantile_states(runs: DataFrame, step: str = "5 minutes", by: Sequence[str] = ("job",), value: str = "duration_s",
                    ts: str = "started_at", error: float = RELATIVE_ERROR) -> DataFrame:
    """MET-4 as stored states: (pane_start, by..., bucket, n, low, high). A group has at most some log(largest / smallest) /
    ``error`` buckets a pane, whatever its number of runs; a hot group is summed before the shuffle."""
    v = F.col(value).cast("double")
    keyed = runs.select(F.window(F.col(ts), step).start.alias("pane_start"), *by, v.alias("_v")).withColumn("bucket", bucket_of(F.col("_v"), error))
    return keyed.filter("bucket IS NOT NULL").groupBy("pane_start", *by, "bucket").agg(
        F.count(F.lit(1)).alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high"))


def merge_states(states: DataFrame, length: str, by: Sequence[str] = ("job",)) -> DataFrame:
    """States of longer panes from states of shorter ones (``length`` a multiple of theirs): counts add, bounds widen."""
    start = F.window(F.col("pane_start"), length).start
    keyed = states.select(start.alias("_start"), *by, "bucket", "n", "low", "high")
    return keyed.groupBy(F.col("_start").alias("pane_start"), *by, "bucket").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))


def state_quantile(states: DataFrame, q: float, by: Sequence[str] = ("job",), alias: str = "quantile") -> DataFrame:
    """(pane_start, by..., runs, alias): the largest value in the bucket that holds rank floor(q * (runs - 1)).

    That value v' and the exact one v of that rank lie in one bucket, so |v' - v| < error * |v|, whatever was merged. A
    group's buckets, not its runs, are ordered: their number is bounded by the bucket width.
    """
    group = Window.partitionBy("pane_start", *by)
    ordered = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = states.withColumn("_upto", F.sum("n").over(ordered)).withColumn("runs", F.sum("n").over(group))
    rank = F.floor(F.lit(float(q)) * (F.col("runs") - 1).cast("double"))
    return (ranked.filter((F.col("_upto") > rank) & (F.col("_upto") - F.col("n") <= rank))
            .select("pane_start", *by, F.col("runs").cast("long").alias("runs"), F.col("high").alias(alias)))
