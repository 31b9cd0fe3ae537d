"""Profiling and validation of a table against its ``TableSpec``.

``quality_report`` (the default, eager) needs, whatever the number of columns:

* one action over the table: a wide aggregate (row count, NULLs per column, allowed values, signs) plus a
  partial-aggregated group-by on the key columns only (and, for a table without a key, the row-hash
  statistics of the duplicate check);
* the duplicate check only when that action does not settle it. A unique key means no two rows are equal.
  Otherwise, when few keys repeat (counted, so the broadcast is proven small), they filter the table
  map-side first; then rows are grouped by a 96-bit hash (about 12 bytes per row shuffled) and only rows
  whose hash repeats are grouped by their full values, so the count is exact.

``quality_report_plan`` is the same report as one lazy plan: the table grouped once by all its columns
(map-side combine collapses copies; full rows differ, so a hot key spreads over reducers), every metric a
weighted sum over those groups, the key check a second group-by on the same, reused exchange.

The result is a long DataFrame (``REPORT_COLUMNS``) so it can be stored, unioned over tables and queried.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from sluice.specs import TableSpec, Thresholds

REPORT_COLUMNS = (
    "table_name",
    "check_name",
    "column_name",
    "severity",
    "metric",
    "threshold",
    "passed",
    "message",
)
REPORT_DDL = (
    "table_name string, check_name string, column_name string, severity string, "
    "metric double, threshold double, passed boolean, message string"
)

_WEIGHT = "__sluice_n"


def _positional(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """Rename clashing column names positionally so the data checks can still address every column."""
    counts = Counter(df.columns)
    if all(v == 1 for v in counts.values()):
        return df, {c: c for c in df.columns}
    seen: Counter = Counter()
    names = []
    for c in df.columns:
        seen[c] += 1
        names.append(c if counts[c] == 1 else f"{c}__{seen[c]}")
    return df.toDF(*names), {}


def schema_checks(df: DataFrame, spec: TableSpec) -> list[tuple]:
    """SCH-1/2/3 from the schema alone (no job). Returns report tuples."""
    t = spec.name
    cols = df.columns
    rows = [(t, "column_count", None, "error", float(len(cols)), 0.0, len(cols) > 0,
             "ok" if cols else "table has no columns")]
    dups = sorted(c for c, n in Counter(cols).items() if n > 1)
    ci = sorted(c for c, n in Counter(c.lower() for c in cols).items() if n > 1 and c not in {d.lower() for d in dups})
    rows.append((t, "duplicate_columns", ",".join(dups) or None, "error", float(len(dups)), 0.0, not dups,
                 "ok" if not dups else "duplicate column names"))
    if ci:
        rows.append((t, "case_clash_columns", ",".join(ci), "warning", float(len(ci)), 0.0, False,
                     "column names differ only in case"))
    present = set(cols)
    for c in spec.required:
        ok = c in present
        rows.append((t, "required_column", c, "error", 1.0 if ok else 0.0, 1.0, ok,
                     "ok" if ok else "required column is missing"))
    return rows


def quality_report_plan(
    df: DataFrame,
    spec: TableSpec,
    thresholds: Thresholds = Thresholds(),
    check_duplicates: bool | None = None,
) -> DataFrame:
    """DQ-1 as one lazy plan: every check of ``spec`` in a single DataFrame that one action evaluates.

    With the duplicate check on, this always shuffles every full row once; ``quality_report`` avoids that
    shuffle when the key proves rows distinct, at the price of running its jobs eagerly.
    """
    t = spec.name
    present = set(df.columns)
    schema_rows = schema_checks(df, spec)
    data, _ = _positional(df)
    cols = data.columns
    profile_cols = [c for c in cols if not c.startswith("_")] if spec.check_nulls else []
    key = [k for k in spec.key if k in present]
    key_ok = bool(spec.key) and len(key) == len(spec.key)
    allowed = {c: v for c, v in spec.allowed_values.items() if c in present}
    nonneg = [c for c in spec.non_negative if c in present]
    dup = spec.check_duplicates if check_duplicates is None else check_duplicates

    if dup and cols:
        base = data.groupBy(*cols).agg(F.count(F.lit(1)).alias(_WEIGHT))
        w = F.col(_WEIGHT)
        rows_expr = F.sum(w)
    else:
        base = data
        w = F.lit(1)
        rows_expr = F.count(F.lit(1))

    def wsum(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, w)), F.lit(0)).cast("long")

    aggs = [rows_expr.cast("long").alias("rows")]
    if dup and cols:
        aggs.append(F.count(F.lit(1)).cast("long").alias("distinct_rows"))
    for i, c in enumerate(profile_cols):
        aggs.append(wsum(F.col(c).isNull()).alias(f"n{i}"))
    for i, (c, vals) in enumerate(allowed.items()):
        aggs.append(wsum(~F.col(c).isin(list(vals))).alias(f"a{i}"))
    for i, c in enumerate(nonneg):
        aggs.append(wsum(F.col(c) < 0).alias(f"g{i}"))
    scalars = base.agg(*aggs)

    # The long rows come from one SQL ``stack`` expression: a single parse, however many checks there are.
    lit = _sql_lit

    def row(check, column, severity, metric: str, threshold, passed: str, failed_text) -> str:
        msg = "'ok'" if failed_text is None else f"CASE WHEN {passed} THEN 'ok' ELSE {lit(failed_text)} END"
        thr = "CAST(NULL AS DOUBLE)" if threshold is None else f"CAST({float(threshold)!r} AS DOUBLE)"
        return ", ".join([lit(t), lit(check), lit(column), lit(severity), f"CAST({metric} AS DOUBLE)", thr,
                          f"CAST({passed} AS BOOLEAN)", msg])

    def stack(rows_sql: list[str]) -> str:
        return (f"stack({len(rows_sql)}, {', '.join(rows_sql)}) "
                "AS (table_name, check_name, column_name, severity, metric, threshold, passed, message)")

    def pct(n: str) -> str:
        return f"CASE WHEN CAST(rows AS DOUBLE) = 0 THEN 0.0D ELSE CAST({n} AS DOUBLE) * 100.0D / CAST(rows AS DOUBLE) END"

    sql_rows = [row(r[1], r[2], r[3], repr(float(r[4])), r[5], "true" if r[6] else "false", None if r[6] else r[7])
                for r in schema_rows]
    sql_rows.append(row("record_count", None, "error", "rows", 0.0, "rows > 0", "table is empty"))
    if dup and cols:
        sql_rows.append(row("distinct_rows", None, "metric", "distinct_rows", None, "true", None))
        sql_rows.append(row("duplicate_rows", None, "warning", "rows - distinct_rows", 0.0,
                            "rows - distinct_rows = 0", "duplicate rows found"))
    th = float(thresholds.null_percent)
    for i, c in enumerate(profile_cols):
        sql_rows.append(row("null_count", c, "metric", f"n{i}", None, "true", None))
        sql_rows.append(row("null_percent", c, "warning", pct(f"n{i}"), th, f"({pct(f'n{i}')}) <= {th!r}D",
                            "NULL share above threshold"))
    for i, c in enumerate(allowed):
        sql_rows.append(row("allowed_values", c, "warning", f"a{i}", 0.0, f"a{i} = 0", "values outside the allowed set"))
    for i, c in enumerate(nonneg):
        sql_rows.append(row("non_negative", c, "warning", f"g{i}", 0.0, f"g{i} = 0", "negative values found"))
    parts = [scalars.select(F.coalesce(F.col("rows"), F.lit(0)).alias("rows"),
                            *[F.col(x) for x in scalars.columns if x != "rows"]).selectExpr(stack(sql_rows))]

    if key_ok:
        per_key = base.groupBy(*key).agg(F.sum(w).alias("kn"))
        kcheck = per_key.agg(F.coalesce(F.sum(F.col("kn") - 1), F.lit(0)).alias("extra"))
        parts.append(kcheck.selectExpr(stack([row("key_unique", ",".join(key), "error", "extra", 0.0, "extra = 0",
                                                  "key is not unique")])))

    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# Largest number of repeated keys / row hashes broadcast to narrow the duplicate check (counted first).
MAX_BROADCAST_KEYS = 2_000_000


def _hashable(data: DataFrame, cols: list[str]) -> list[Column] | None:
    """Columns prepared for row hashing so equal-by-grouping values hash equally (-0.0 -> 0.0; NaNs are
    already canonical). None when a column's type cannot be hashed that way (nested floats, maps)."""
    out = []
    for f in data.schema.fields:
        if f.name not in cols:
            continue
        t = f.dataType
        if isinstance(t, (T.FloatType, T.DoubleType)):
            out.append(F.when(F.col(f.name) == 0, F.lit(0.0).cast(t)).otherwise(F.col(f.name)))
        elif isinstance(t, (T.ArrayType, T.MapType, T.StructType)):
            return None
        else:
            out.append(F.col(f.name))
    return out


def count_duplicate_rows(data: DataFrame, cols: list[str] | None = None,
                         max_broadcast: int = MAX_BROADCAST_KEYS) -> int:
    """Exact number of rows that are copies of an earlier row over ``cols`` (rows - distinct rows).

    Pass 1 groups rows by a 96-bit hash (``xxhash64`` + ``hash``): about 12 bytes per row cross the
    shuffle, after map-side combine. Rows whose hash is unique cannot have a copy, so when no hash
    repeats the answer is 0 exactly. Otherwise pass 2 groups only the rows of repeated hashes by their full
    values (hash collisions between different rows therefore never count). Those rows are found by a
    broadcast filter when the repeated hashes are few (counted in pass 1), by a shuffle join if not.
    """
    cols = list(cols) if cols is not None else data.columns
    plan = _hash_repeats(data, cols)
    if plan is None:  # fall back to grouping full rows
        return _full_row_copies(data, cols)
    hashed, rep = plan
    groups = rep.agg(F.count(F.lit(1)).alias("groups")).first()["groups"]
    return _verify_copies(hashed, rep, cols, groups, max_broadcast)


def _full_row_copies(data: DataFrame, cols: list[str]) -> int:
    g = data.groupBy(*cols).agg(F.count(F.lit(1)).alias(_WEIGHT))
    return int(g.agg(F.coalesce(F.sum(F.col(_WEIGHT) - 1), F.lit(0)).alias("d")).first()["d"])


def _hash_repeats(data: DataFrame, cols: list[str]) -> tuple[DataFrame, DataFrame] | None:
    """(rows with their 96-bit hash, hashes that repeat) as lazy frames; None when rows cannot be hashed."""
    hcols = _hashable(data, cols)
    if hcols is None:
        return None
    hashed = data.select(*cols, F.xxhash64(*hcols).alias("__h1"), F.hash(*hcols).alias("__h2"))
    rep = hashed.groupBy("__h1", "__h2").agg(F.count(F.lit(1)).alias("hn")).filter(F.col("hn") > 1)
    return hashed, rep


def _verify_copies(hashed: DataFrame, rep: DataFrame, cols: list[str], groups: int, max_broadcast: int) -> int:
    """Exact copies among the rows whose hash repeats (``groups`` repeated hashes, counted already)."""
    if groups == 0:
        return 0
    hashes = rep.select("__h1", "__h2")
    if groups <= max_broadcast:
        hashes = F.broadcast(hashes)
    return _full_row_copies(hashed.join(hashes, ["__h1", "__h2"], "left_semi"), cols)


def _pct(n: int, rows: int) -> float:
    return n * 100.0 / rows if rows else 0.0


def quality_report(
    df: DataFrame,
    spec: TableSpec,
    thresholds: Thresholds = Thresholds(),
    check_duplicates: bool | None = None,
    lazy: bool = False,
    max_broadcast_keys: int = MAX_BROADCAST_KEYS,
) -> DataFrame:
    """DQ-1: every check of ``spec`` as a long report DataFrame.

    Job 1 evaluates one wide aggregate over the table (row count, NULLs per column, allowed values, signs)
    and, with a key, a partial-aggregated group-by on the key columns only (repeated-key statistics).
    The whole-row duplicate count runs only when job 1 does not imply it: it is skipped for a unique key;
    when few keys repeat and they hold a minority of rows, those keys (their count is known, so the
    broadcast is bounded) first filter the table map-side; then ``count_duplicate_rows`` shuffles row
    hashes, and full rows only where a hash repeats. Only scalars reach the driver.
    """
    if df.isStreaming:
        raise ValueError("quality_report needs a batch DataFrame; for streams run it per micro-batch "
                         "(streaming.bronze_stream.stream_ingest_with_quality / foreachBatch)")
    if lazy:
        return quality_report_plan(df, spec, thresholds, check_duplicates)
    spark = df.sparkSession
    t = spec.name
    present = set(df.columns)
    rows_out = list(schema_checks(df, spec))
    data, _ = _positional(df)
    cols = data.columns
    profile_cols = [c for c in cols if not c.startswith("_")] if spec.check_nulls else []
    key = [k for k in spec.key if k in present]
    key_ok = bool(spec.key) and len(key) == len(spec.key)
    allowed = {c: v for c, v in spec.allowed_values.items() if c in present}
    nonneg = [c for c in spec.non_negative if c in present]
    dup = (spec.check_duplicates if check_duplicates is None else check_duplicates) and bool(cols)

    aggs = [F.count(F.lit(1)).alias("rows")]
    # non-NULL counts (NULLs = rows - count): the cheapest aggregate to compile and run on wide tables
    aggs += [F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(profile_cols)]
    aggs += [F.count_if(~F.col(c).isin(list(v))).alias(f"a{i}") for i, (c, v) in enumerate(allowed.items())]
    aggs += [F.count_if(F.col(c) < 0).alias(f"g{i}") for i, c in enumerate(nonneg)]
    labels = ["rows"] + [f"n{i}" for i in range(len(profile_cols))] + [f"a{i}" for i in range(len(allowed))] \
        + [f"g{i}" for i in range(len(nonneg))]
    # job 1: the wide aggregate and the key statistics, as one action (two branches of one plan)
    scal = data.agg(*aggs).select(F.lit("s").alias("part"), F.array(*[F.col(x).cast("long") for x in labels]).alias("v"))
    if key_ok:
        per_key = data.groupBy(*key).agg(F.count(F.lit(1)).alias("kn"))
        kst = per_key.agg(F.coalesce(F.sum(F.col("kn") - 1), F.lit(0)).cast("long").alias("extra"),
                          F.count_if(F.col("kn") > 1).cast("long").alias("repeated"))
        scal = scal.unionByName(kst.select(F.lit("k").alias("part"), F.array("extra", "repeated").alias("v")))
    hplan = _hash_repeats(data, cols) if (dup and not key_ok) else None
    if hplan is not None:  # no key to settle it: the hash pass always runs, so it joins job 1
        hst = hplan[1].agg(F.count(F.lit(1)).cast("long").alias("groups"))
        scal = scal.unionByName(hst.select(F.lit("h").alias("part"), F.array("groups").alias("v")))
    got = {r.part: r.v for r in scal.collect()}
    one = dict(zip(labels, got["s"]))
    rows = int(one["rows"] or 0)
    extra, repeated = (int(got["k"][0]), int(got["k"][1])) if key_ok else (None, 0)

    if dup:
        if key_ok and extra == 0:
            dup_rows = 0  # a unique key: no two rows can be equal
        elif hplan is not None:
            dup_rows = _verify_copies(hplan[0], hplan[1], cols, int(got["h"][0]), max_broadcast_keys)
        else:
            cand = data
            covered = (extra or 0) + repeated  # rows whose key repeats
            if key_ok and repeated <= max_broadcast_keys and covered * 2 < rows:
                # few repeated keys holding a minority of rows: broadcast them (count proven above) and
                # filter map-side; copies can only be among those rows
                keys = per_key.filter(F.col("kn") > 1).select(*key)
                cond = [data[k].eqNullSafe(keys[k]) for k in key]
                cand = data.join(F.broadcast(keys), cond, "left_semi")
            dup_rows = count_duplicate_rows(cand, cols, max_broadcast_keys)

    rows_out.append((t, "record_count", None, "error", float(rows), 0.0, rows > 0, "ok" if rows > 0 else "table is empty"))
    if dup:
        rows_out.append((t, "distinct_rows", None, "metric", float(rows - dup_rows), None, True, "ok"))
        rows_out.append((t, "duplicate_rows", None, "warning", float(dup_rows), 0.0, dup_rows == 0,
                         "ok" if dup_rows == 0 else "duplicate rows found"))
    for i, c in enumerate(profile_cols):
        n = rows - int(one[f"n{i}"] or 0)
        pct = _pct(n, rows)
        ok = pct <= float(thresholds.null_percent)
        rows_out.append((t, "null_count", c, "metric", float(n), None, True, "ok"))
        rows_out.append((t, "null_percent", c, "warning", pct, float(thresholds.null_percent), ok,
                         "ok" if ok else "NULL share above threshold"))
    for i, c in enumerate(allowed):
        n = int(one[f"a{i}"] or 0)
        rows_out.append((t, "allowed_values", c, "warning", float(n), 0.0, n == 0,
                         "ok" if n == 0 else "values outside the allowed set"))
    for i, c in enumerate(nonneg):
        n = int(one[f"g{i}"] or 0)
        rows_out.append((t, "non_negative", c, "warning", float(n), 0.0, n == 0,
                         "ok" if n == 0 else "negative values found"))
    if key_ok:
        rows_out.append((t, "key_unique", ",".join(key), "error", float(extra), 0.0, extra == 0,
                         "ok" if extra == 0 else "key is not unique"))
    # bounded by the number of checks; plain rows are far cheaper to plan than hundreds of literal structs
    return spark.createDataFrame(rows_out, REPORT_DDL)


def validate(df: DataFrame, spec: TableSpec, thresholds: Thresholds = Thresholds(), **kwargs) -> DataFrame:
    """DQ-1 as a never-raising call: a check that fails to run becomes a ``validation_error`` error row
    (so the gate blocks the load) instead of an exception."""
    try:
        return quality_report(df, spec, thresholds, **kwargs)
    except Exception as exc:  # noqa: BLE001 - reported, not raised
        msg = f"check failed to run: {type(exc).__name__}: {exc}"
        return df.sparkSession.createDataFrame(
            [(spec.name, "validation_error", None, "error", None, None, False, msg)], REPORT_DDL)


def failed_errors(report: DataFrame) -> DataFrame:
    """Rows that block a load: severity ``error`` and not passed."""
    return report.filter((F.col("severity") == "error") & ~F.col("passed"))


class QualityGateError(ValueError):
    pass


def gate(report: DataFrame, enabled: bool = True) -> list[str]:
    """DQ-2: raise when the report holds a failed error; returns the warning texts otherwise.

    Only failed rows reach the driver (bounded by the number of checks, not by the data).
    """
    if not enabled:
        return []
    bad = report.filter(~F.col("passed") & F.col("severity").isin("error", "warning")).collect()
    errors = [f"{r.check_name}({r.column_name or ''}): {r.message}" for r in bad if r.severity == "error"]
    if errors:
        raise QualityGateError("load blocked by failed checks: " + "; ".join(sorted(errors)))
    return [f"{r.check_name}({r.column_name or ''}): {r.message}" for r in bad]


# --- standalone profiles -----------------------------------------------------------------------------------


def _sql_lit(v) -> str:
    return "CAST(NULL AS STRING)" if v is None else "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """AGG-2: NULL count and percent per column in one pass (metadata ``_`` columns skipped by default);
    the long rows come from one SQL ``stack`` expression, cheap to plan on wide tables."""
    cols = list(cols) if cols is not None else [c for c in df.columns if not c.startswith("_")]
    aggs = [F.count(F.lit(1)).alias("rows")] + [F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(cols)]
    one = df.agg(*aggs)
    rows_sql = []
    for i, c in enumerate(cols):
        n = f"(rows - n{i})"
        pct = f"CASE WHEN CAST(rows AS DOUBLE) = 0 THEN 0.0D ELSE CAST({n} AS DOUBLE) * 100.0D / CAST(rows AS DOUBLE) END"
        rows_sql.append(f"{_sql_lit(c)}, CAST({n} AS BIGINT), {pct}, CAST(rows AS BIGINT)")
    return one.selectExpr(f"stack({len(cols)}, {', '.join(rows_sql)}) AS (column_name, null_count, null_percent, row_count)")


def duplicate_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """AGG-3: rows, distinct rows and duplicate rows over ``cols`` (all columns by default), lazily as one
    plan (whole rows shuffled once). ``count_duplicate_rows`` gives the same number eagerly while shuffling
    only row hashes plus the rows whose hash repeats."""
    cols = list(cols) if cols is not None else df.columns
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias(_WEIGHT))
    return g.agg(
        F.coalesce(F.sum(_WEIGHT), F.lit(0)).cast("long").alias("row_count"),
        F.count(F.lit(1)).cast("long").alias("distinct_count"),
        F.coalesce(F.sum(F.col(_WEIGHT) - 1), F.lit(0)).cast("long").alias("duplicate_count"),
    )


def key_uniqueness(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """AGG-4: is ``key`` unique? NULL counts as one key value (as ``distinct`` does)."""
    key = list(key)
    null_key = F.greatest(*[F.col(k).isNull().cast("int") for k in key]) if len(key) > 1 else F.col(key[0]).isNull().cast("int")
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("kn"), F.max(null_key).alias("isnull"))
    extra = F.coalesce(F.sum(F.col("kn") - 1), F.lit(0)).cast("long")
    return per_key.agg(
        F.coalesce(F.sum("kn"), F.lit(0)).cast("long").alias("row_count"),
        F.count(F.lit(1)).cast("long").alias("distinct_keys"),
        extra.alias("duplicate_rows"),
        F.count_if(F.col("kn") > 1).cast("long").alias("duplicated_keys"),
        F.coalesce(F.sum(F.when(F.col("isnull") == 1, F.col("kn"))), F.lit(0)).cast("long").alias("null_key_rows"),
        (extra == 0).alias("is_unique"),
    )


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Offending keys with their row counts (partial aggregation keeps a hot key cheap)."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)


def invalid_values(df: DataFrame, col: str, allowed: Sequence[str]) -> DataFrame:
    """FLT-4 + AGG-5: each distinct value outside ``allowed`` with its row count. NULL is not reported."""
    return (
        df.filter(~F.col(col).isin(list(allowed)))
        .groupBy(F.col(col).alias("value"))
        .agg(F.count(F.lit(1)).cast("long").alias("row_count"))
        .select(F.lit(col).alias("column_name"), "value", "row_count")
    )


def negative_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """FLT-5 + AGG-6: negative-value count per column in one pass (NULL not counted)."""
    cols = list(cols)
    one = df.agg(*[F.count_if(F.col(c) < 0).alias(f"g{i}") for i, c in enumerate(cols)])
    rows_sql = [f"{_sql_lit(c)}, CAST(g{i} AS BIGINT)" for i, c in enumerate(cols)]
    return one.selectExpr(f"stack({len(cols)}, {', '.join(rows_sql)}) AS (column_name, negative_count)")
