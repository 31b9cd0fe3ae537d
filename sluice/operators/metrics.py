"""Pipeline-health metrics over run rows (MET-1 ... MET-8).

A *runs* frame has one row per run: ``run_id, job, dag_id, status, started_at, ended_at, records``.
Rates are event counts over a window divided by the window length in seconds (the event-row reading of a
counter ``rate``). Windows are tumbling ``F.window`` buckets; every metric is a partial-aggregated group-by,
so a hot job or window is combined map-side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sluice.functions.timecols import add_seconds, grid_ceil, percent
from sluice.session import cut_lineage

#: Grid points of ``active_runs`` summed by one window.
POINTS_PER_CHUNK = 1440

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def window_seconds(length: str) -> int:
    """'5 minutes' -> 300."""
    n, unit = length.split()
    return int(n) * _UNIT_SECONDS[unit.rstrip("s")]


def runs_from_events(events: DataFrame) -> DataFrame:
    """Read an event stream as run rows: event_type is the job, user_id the DAG, an ``error`` event a failed
    run, ``value`` the run's duration in seconds (so a run ends ``value`` seconds after it starts)."""
    return events.select(
        F.col("event_id").alias("run_id"),
        F.col("event_type").alias("job"),
        F.col("user_id").alias("dag_id"),
        F.when(F.col("event_type") == "error", F.lit("failed")).otherwise(F.lit("success")).alias("status"),
        F.col("ts").alias("started_at"),
        add_seconds(F.col("ts"), F.col("value")).alias("ended_at"),
        F.col("value").alias("duration_s"),
        F.lit(1).cast("long").alias("records"),
    )


def trailing(runs: DataFrame, as_of, length: str = "24 hours", ts: str = "started_at",
             column: str | None = None, value=None) -> DataFrame:
    """FLT-7: rows with ``as_of - length <= ts < as_of`` (the dashboard's time range), optionally also
    ``column == value`` (its environment selector). Pushed to the scan as a range filter."""
    end = F.lit(as_of)
    out = runs.filter((F.col(ts) >= end - F.expr(f"INTERVAL {length}")) & (F.col(ts) < end))
    if column is not None:
        out = out.filter(F.col(column) == F.lit(value))
    return out


def runs_from_run_log(run_log: DataFrame) -> DataFrame:
    """Read ingest ``run_log`` rows (``plans.ingest``) as run rows, so the dashboard metrics can watch the
    pipeline itself: one run per table load, the job is the table, the DAG the run id."""
    secs = F.timestamp_diff("MICROSECOND", F.col("started_at"), F.col("ended_at")).cast("double") / F.lit(1e6)
    return run_log.select(
        F.concat_ws(":", "run_id", "table_name").alias("run_id"),
        F.col("table_name").alias("job"),
        F.col("run_id").alias("dag_id"),
        F.when(F.col("status") == "success", F.lit("success")).otherwise(F.lit("failed")).alias("status"),
        "started_at",
        "ended_at",
        secs.alias("duration_s"),
        F.coalesce(F.col("record_count"), F.lit(0)).cast("long").alias("records"),
    )


def _win(runs: DataFrame, length: str, ts: str) -> Column:
    return F.window(F.col(ts), length)


def success_rate(runs: DataFrame, window: str = "1 hour", ts: str = "started_at") -> DataFrame:
    """MET-1: per window: runs, succeeded, success_rate (%)."""
    return (
        runs.groupBy(_win(runs, window, ts).alias("w"))
        .agg(F.count(F.lit(1)).cast("long").alias("runs"),
             F.count_if(F.col("status") == "success").cast("long").alias("succeeded"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "runs", "succeeded",
                percent(F.col("succeeded"), F.col("runs")).alias("success_rate"))
    )


def active_runs_at(runs: DataFrame, as_of, start: str = "started_at", end: str = "ended_at") -> DataFrame:
    """MET-2 gauge at one instant: runs with start <= as_of < end (or still open). One global aggregate."""
    t = F.lit(as_of)
    live = (F.col(start) <= t) & (F.col(end).isNull() | (F.col(end) > t))
    return runs.agg(F.count_if(live).cast("long").alias("active_runs"))


def active_runs(runs: DataFrame, step: str = "1 minute", start: str = "started_at", end: str = "ended_at") -> DataFrame:
    """MET-2 as a series: at every grid point t (multiples of ``step``, whole seconds) the number of runs with
    start <= t < end; an open run (NULL end) stays active. Every point from the first one covered to the last known
    start or covered point has a row, idle ones too. Runs that end at or before their start cover no point.

    A run adds +1 at its first point and -1 at the first point at or after its end, so a long run costs two rows.
    The sums per point are staged; running sums are taken inside chunks of points, whose totals give the offsets.
    """
    secs = window_seconds(step)
    some = runs.filter(F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(end) > F.col(start))))
    anchor = F.lit("1970-01-01 00:00:00").cast(runs.schema[start].dataType)
    # one time-window expression per projection (Spark's rule), hence the two selects
    points = some.select(grid_ceil(start, step).alias("first"), F.col(end).alias("_end"))
    # a time window drops rows without a time, so an open run is given one for it
    stop = grid_ceil(F.coalesce("_end", "first"), step)
    points = points.select("first", F.when(F.col("_end").isNotNull(), stop).alias("stop"))
    points = points.filter(F.col("stop").isNull() | (F.col("first") < F.col("stop")))
    steps = F.explode(F.array(F.struct(F.col("first").alias("at"), F.lit(1).alias("d")), F.struct(F.col("stop").alias("at"), F.lit(-1).alias("d"))))
    deltas = points.select(steps.alias("p")).filter("p.at IS NOT NULL").groupBy(F.timestamp_diff("SECOND", anchor, F.col("p.at")).alias("sec"))
    deltas = cut_lineage(deltas.agg(F.sum("p.d").alias("d"), F.max("p.d").alias("most"), F.min("p.d").alias("least")), name="active-runs")
    lo, started, stopped = deltas.agg(F.min("sec"), F.max(F.when(F.col("most") > 0, F.col("sec"))),
                                      F.max(F.when(F.col("least") < 0, F.col("sec") - secs))).first()
    n = 0 if lo is None else (max(started, started if stopped is None else stopped) - lo) // secs + 1
    grid = runs.sparkSession.range(n).withColumn("chunk", F.floor(F.col("id") / POINTS_PER_CHUNK))
    deltas = deltas.select(F.floor((F.col("sec") - F.lit(lo or 0)) / secs).alias("id"), "d")
    totals = deltas.groupBy(F.floor(F.col("id") / POINTS_PER_CHUNK).alias("chunk")).agg(F.sum("d").alias("total"))
    every = runs.sparkSession.range((n + POINTS_PER_CHUNK - 1) // POINTS_PER_CHUNK).withColumnRenamed("id", "chunk")
    before = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)  # one row per chunk of points
    offsets = every.join(totals, "chunk", "left").select("chunk", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("chunk").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    series = grid.join(deltas, "id", "left").withColumn("inside", F.coalesce(F.sum("d").over(inside), F.lit(0)))
    return series.join(offsets, "chunk").select(
        F.timestamp_add("SECOND", F.col("id") * secs + F.lit(lo or 0), anchor).alias("at_time"),
        (F.col("offset") + F.col("inside")).cast("long").alias("active_runs"))


def records_per_second(runs: DataFrame, window: str = "5 minutes", ts: str = "started_at",
                       records: str = "records", by: str = "job") -> DataFrame:
    """MET-3: per window and ``by``: records / window seconds."""
    secs = float(window_seconds(window))
    return (
        runs.groupBy(_win(runs, window, ts).alias("w"), F.col(by))
        .agg(F.sum(records).cast("long").alias("records"))
        .select(F.col("w.start").alias("window_start"), F.col(by), "records",
                (F.col("records").cast("double") / F.lit(secs)).alias("records_per_second"))
    )


def exact_quantile(df: DataFrame, by: list[str], value: str, q: float, alias: str = "quantile",
                   partitions: int | None = None) -> DataFrame:
    """Exact ``q`` quantile of ``value`` per ``by`` group with linear interpolation (SQL ``quantile_cont``),
    without ever holding a whole group in one task.

    1. rows -> (group, value, count) with map-side partial aggregation;
    2. range-partition those by (group, value): a hot group is split over many partitions, in value order. They
       are staged with their partition's number, because range bounds are sampled anew in every run of the plan;
    3. running counts inside each (partition, group) window: at most one partition's rows;
    4. per (group, partition) totals (a small frame) -> each partition's offset within its group;
    5. keep the at most two rows per group that cover ranks floor(q(n-1)) and ceil(q(n-1)), interpolate.
    NULL values are ignored; groups with no value are absent.
    """
    spark = df.sparkSession
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    v = F.col(value)
    vc = df.filter(v.isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_c"))
    ranged = vc.repartitionByRange(n_parts, *[F.col(c) for c in by], v).withColumn("_pid", F.spark_partition_id())
    ranged = cut_lineage(ranged, name="quantile")
    local = ranged.withColumn(
        "_cum", F.sum("_c").over(Window.partitionBy("_pid", *by).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)))
    parts = ranged.groupBy(*by, "_pid").agg(F.sum("_c").alias("_pc"))
    wg = Window.partitionBy(*by)
    offsets = parts.select(
        *by, "_pid",
        (F.sum("_pc").over(wg.orderBy("_pid").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_pc")).alias("_off"),
        F.sum("_pc").over(wg).alias("_n"),
    )
    # (joined null-safely below: a NULL group key is a group of its own, as in GROUP BY)
    o = offsets.select(*[F.col(c).alias(f"_o_{c}") for c in by], F.col("_pid").alias("_o_pid"), "_off", "_n")
    cond = [local[c].eqNullSafe(o[f"_o_{c}"]) for c in by] + [local["_pid"] == o["_o_pid"]]
    rows = local.join(o, cond).drop(*[f"_o_{c}" for c in by], "_o_pid")  # NULL is a group too
    pos = F.lit(float(q)) * (F.col("_n") - 1).cast("double")
    lo_rank, hi_rank = F.floor(pos), F.ceil(pos)
    end = F.col("_off") + F.col("_cum")  # exclusive end rank of this value's run
    start = end - F.col("_c")
    covers_lo = (start <= lo_rank) & (lo_rank < end)
    covers_hi = (start <= hi_rank) & (hi_rank < end)
    picked = rows.filter(covers_lo | covers_hi).select(
        *by, "_n", pos.alias("_pos"), F.when(covers_lo, v).alias("_lo"), F.when(covers_hi, v).alias("_hi"))
    agg = picked.groupBy(*by).agg(F.max("_lo").alias("_lo"), F.max("_hi").alias("_hi"), F.max("_pos").alias("_pos"))
    frac = F.col("_pos") - F.floor(F.col("_pos"))
    lo, hi = F.col("_lo").cast("double"), F.col("_hi").cast("double")
    return agg.select(*by, (lo + (hi - lo) * frac).alias(alias))


def duration_quantile(runs: DataFrame, q: float = 0.95, window: str = "1 day", ts: str = "started_at",
                      value: str = "duration_s", by: str = "job", exact: bool = False,
                      accuracy: int = 10000) -> DataFrame:
    """MET-4: the ``q`` quantile of run durations per window and ``by``.

    Default is ``percentile_approx``: a mergeable sketch of bounded size, so partial aggregation keeps a hot
    group cheap. ``exact=True`` uses ``exact_quantile`` (linear interpolation, SQL ``quantile_cont``), which
    range-partitions values so no task ever holds a whole group.
    """
    name = f"p{int(round(q * 100))}"
    keyed = runs.select(_win(runs, window, ts).start.alias("window_start"), F.col(by), F.col(value))
    counts = keyed.groupBy("window_start", by).agg(F.count(F.lit(1)).cast("long").alias("runs"))
    if exact:
        qs = exact_quantile(keyed, ["window_start", by], value, q, alias=name)
        qs = qs.select(F.col("window_start").alias("_qw"), F.col(by).alias("_qb"), name)
        cond = [counts["window_start"].eqNullSafe(qs["_qw"]), counts[by].eqNullSafe(qs["_qb"])]  # NULL job too
        return counts.join(qs, cond, "left").select("window_start", by, "runs", name)
    approx = F.percentile_approx(F.col(value), F.lit(q), F.lit(accuracy)).cast("double")
    return keyed.groupBy("window_start", by).agg(F.count(F.lit(1)).cast("long").alias("runs"), approx.alias(name))


def failure_rate(runs: DataFrame, window: str = "1 hour", ts: str = "started_at", by: str = "dag_id") -> DataFrame:
    """MET-5: failed runs per second per window and ``by`` (plus the failure count)."""
    secs = float(window_seconds(window))
    return (
        runs.groupBy(_win(runs, window, ts).alias("w"), F.col(by))
        .agg(F.count_if(F.col("status") == "failed").cast("long").alias("failures"),
             F.count(F.lit(1)).cast("long").alias("runs"))
        .select(F.col("w.start").alias("window_start"), F.col(by), "runs", "failures",
                (F.col("failures").cast("double") / F.lit(secs)).alias("failures_per_second"))
    )


def run_durations(runs: DataFrame, start: str = "started_at", end: str = "ended_at") -> DataFrame:
    """MET-6: per run, seconds between start and end (microsecond precision)."""
    secs = F.timestamp_diff("MICROSECOND", F.col(start), F.col(end)).cast("double") / F.lit(1_000_000.0)
    return runs.select("run_id", "job", start, end, secs.alias("duration_seconds"))


def dq_series(reports: DataFrame, by: str | list[str] = "table_name") -> DataFrame:
    """MET-7 / OPS-3: from stored DQ reports, per ``by`` (e.g. table, or table and run day): checks run
    (errors and warnings), failed checks, blocking failures, the failure rate (%) and the worst NULL share."""
    keys = [by] if isinstance(by, str) else list(by)
    judged = F.col("severity").isin("error", "warning")
    failed = ~F.col("passed") & judged
    return reports.groupBy(*keys).agg(
        F.count_if(judged).cast("long").alias("checks"),
        F.count_if(failed).cast("long").alias("validation_failures"),
        F.count_if(failed & (F.col("severity") == "error")).cast("long").alias("blocking_failures"),
        F.coalesce(F.max(F.when(F.col("check_name") == "null_percent", F.col("metric"))), F.lit(0.0)).alias("max_null_percent"),
    ).withColumn("failure_rate", percent(F.col("validation_failures"), F.col("checks")))


def band(value, green_at: float = 95.0, yellow_at: float = 80.0, higher_is_better: bool = True) -> Column:
    """MET-8 colour band. Higher-is-better: >= green_at green, >= yellow_at yellow, else red.
    Lower-is-better (gauges such as active runs): >= red_at (``green_at``) red, >= ``yellow_at`` yellow, else green."""
    v = F.col(value) if isinstance(value, str) else value
    if higher_is_better:
        return F.when(v >= green_at, "green").when(v >= yellow_at, "yellow").otherwise("red")
    return F.when(v >= green_at, "red").when(v >= yellow_at, "yellow").otherwise("green")


# Dashboard bands (success rate: red from 0, yellow from 80, green from 95;
# active runs: green from 0, yellow from 5, red from 10).
SUCCESS_BANDS = {"green_at": 95.0, "yellow_at": 80.0}
ACTIVE_RUN_BANDS = {"green_at": 10.0, "yellow_at": 5.0}


def status_bands(success: DataFrame) -> DataFrame:
    """MET-8 applied to success-rate windows."""
    return success.withColumn("band", band("success_rate", **SUCCESS_BANDS))


def active_run_bands(active: DataFrame) -> DataFrame:
    """MET-8 applied to active-run points (lower is better)."""
    return active.withColumn("band", band("active_runs", higher_is_better=False, **ACTIVE_RUN_BANDS))
