"""The DQ report with every check on its own feet (DQ-1), and the values that offend (AGG-5).

Each check is compiled to partial aggregates: a few columns of one wide aggregate whose states Spark merges. A check
that can't be analysed (a missing or ambiguous column, a type that can't be compared) or that fails while it runs (a
string that isn't a number, compared with one) becomes a failed error row of its own name; all other checks give
the rows they give without it. Columns are addressed by position, so names that are equal, differ only in case or hold dots
and blanks can be checked too.

In the usual case that is one scan for all checks (and one each for the key and for whole-row copies). Only when that
scan fails, the checks that can fail are run in halves until each failing one is alone: some 2 * log2(checks) scans for
one broken check.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Window, functions as F

from sluice.operators.quality import REPORT_DDL, count_duplicate_rows, quality_report, schema_checks
from sluice.specs import TableSpec, Thresholds

#: Buckets in which the most frequent offending values are found before they are merged.
VALUE_BUCKETS = 64


class CheckError(Exception):
    """A check that can't be run; the text says why."""


@dataclass
class Check:
    """``parts`` are aggregate columns over the positional frame; ``result`` turns their values into report rows."""

    name: str
    column: str | None
    parts: Callable[[], list[Column]]
    result: Callable[[Sequence, int], list[tuple]]
    can_fail: bool = True
    error: str | None = None
    values: list = field(default_factory=list)


def reason_of(exc: Exception) -> str:
    """A short text for a failure: Spark's error condition if it has one, else the exception's class."""
    condition = exc.getCondition() if isinstance(exc, PySparkException) else None
    return str(exc) if isinstance(exc, CheckError) else condition or type(exc).__name__


class _Frame:
    """A frame whose columns go by position, and its names as they were."""

    def __init__(self, df: DataFrame, rules: Mapping[str, str]):
        self.names = df.columns
        self.broken: dict[str, str] = {}
        holds = {}
        for rule, sql in rules.items():
            try:
                df.select(F.expr(sql).cast("boolean"))  # analysed here and now, on the names as they are
                holds[rule] = F.expr(sql).cast("boolean")
            except Exception as exc:  # noqa: BLE001 - this rule's own failure
                self.broken[rule] = reason_of(exc)
        wide = df.select("*", *holds.values())
        self.data = wide.toDF(*[f"c{i}" for i in range(len(wide.columns))])
        self.rules = {rule: F.col(f"c{len(self.names) + i}") for i, rule in enumerate(holds)}

    def at(self, name: str) -> str:
        """The positional name of a column: the same name, else the only one that differs in case."""
        same = [i for i, n in enumerate(self.names) if n == name] or [i for i, n in enumerate(self.names) if n.lower() == name.lower()]
        if len(same) == 1:
            return f"c{same[0]}"
        raise CheckError("no such column" if not same else "ambiguous column")


def compile_checks(frame: _Frame, spec: TableSpec, thresholds: Thresholds) -> list[Check]:
    t, limit = spec.name, float(thresholds.null_percent)

    def nulls(label):
        def rows(v, n):
            pct = v[0] * 100.0 / n if n else 0.0
            ok = pct <= limit
            return [(t, "null_count", label, "metric", float(v[0]), None, True, "ok"),
                    (t, "null_percent", label, "warning", pct, limit, ok, "ok" if ok else "NULL share above threshold")]
        return rows

    def counted(check, label, severity, text):
        def rows(v, n):
            return [(t, check, label, severity, float(v[0]), 0.0, v[0] == 0, "ok" if v[0] == 0 else text)]
        return rows

    out = []
    if spec.check_nulls:
        out += [Check("null_count", n, lambda i=i: [F.count_if(F.col(f"c{i}").isNull())], nulls(n), can_fail=False)
                for i, n in enumerate(frame.names) if not n.startswith("_")]
    for c, allowed in spec.allowed_values.items():
        out.append(Check("allowed_values", c, lambda c=c, allowed=allowed: [F.count_if(~F.col(frame.at(c)).isin(list(allowed)))],
                         counted("allowed_values", c, "warning", "values outside the allowed set")))
    for c in spec.non_negative:
        out.append(Check("non_negative", c, lambda c=c: [F.count_if(F.col(frame.at(c)) < 0)],
                         counted("non_negative", c, "warning", "negative values found")))
    for rule, holds in frame.rules.items():
        out.append(Check("rule", rule, lambda holds=holds: [F.count_if(~F.coalesce(holds, F.lit(False)))],
                         counted("rule", rule, "error", "rows break the rule")))
    for rule, why in frame.broken.items():
        out.append(Check("rule", rule, lambda: [], counted("rule", rule, "error", ""), error=why))
    return out


def _analysed(frame: _Frame, check: Check) -> list[Column]:
    """The check's columns, or none and its error."""
    if check.error is None:
        try:
            parts = check.parts()
            frame.data.agg(*parts)  # analysis only
            return parts
        except Exception as exc:  # noqa: BLE001 - this check's own failure
            check.error = reason_of(exc)
    return []


def _scan(frame: _Frame, checks: list[Check], parts: Mapping[int, list[Column]]) -> int:
    """Run ``checks`` in one scan; returns the row count."""
    columns = [c.alias(f"v{i}_{j}") for i, check in enumerate(checks) for j, c in enumerate(parts[id(check)])]
    got = frame.data.agg(F.count(F.lit(1)).alias("n"), *columns).first()
    for i, check in enumerate(checks):
        check.values = [got[f"v{i}_{j}"] for j in range(len(parts[id(check)]))]
    return got.n


def _run_apart(frame: _Frame, checks: list[Check], parts: Mapping[int, list[Column]]) -> None:
    """Run ``checks``, in halves where a scan fails, until each check that fails is alone and has its error."""
    try:
        _scan(frame, checks, parts)
    except Exception as exc:  # noqa: BLE001 - isolated
        if len(checks) == 1:
            checks[0].error = reason_of(exc)
            return
        half = len(checks) // 2
        _run_apart(frame, checks[:half], parts)
        _run_apart(frame, checks[half:], parts)


def isolated_report(df: DataFrame, spec: TableSpec, thresholds: Thresholds = Thresholds(), rules: Mapping[str, str] | None = None,
                    top: int = 5) -> DataFrame:
    """Every check of ``spec`` and of ``rules`` (name -> SQL condition that each row must meet; NULL breaks it) as report rows.

    Beyond ``quality_report``: the duplicate share (``duplicate_percent``), case-clashing columns in the NULL profile, and
    the ``top`` most frequent offending values in the message of a failed value check. A check that couldn't run
    has metric NULL, severity error, and a message that begins with "check could not run". Only scalars and at most ``top``
    values a check reach the driver.
    """
    spark, t = df.sparkSession, spec.name
    out = list(schema_checks(df, spec))
    frame = _Frame(df, rules or {})
    checks = compile_checks(frame, spec, thresholds)
    parts = {id(c): _analysed(frame, c) for c in checks}
    able = [c for c in checks if c.error is None]
    safe, risky = [c for c in able if not c.can_fail], [c for c in able if c.can_fail]
    try:
        n = _scan(frame, able, parts)
    except Exception:  # noqa: BLE001 - some check fails on some row: find it
        n = _scan(frame, safe, parts)  # raises if the rows themselves can't be read
        _run_apart(frame, risky, parts)
    out.append((t, "record_count", None, "error", float(n), 0.0, n > 0, "ok" if n > 0 else "table is empty"))

    offending: dict[tuple, list[str]] = {}
    failed = [c for c in checks if c.error is None and c.name in ("allowed_values", "non_negative") and c.values[0] > 0]
    if failed and top:
        for r in _offending(frame, spec, failed, top).orderBy("check_name", "column_name", "place").collect():
            offending.setdefault((r.check_name, r.column_name), []).append(f"{r.value} ({r.row_count})")
    for c in checks:
        if c.error is not None:
            out.append((t, c.name, c.column, "error", None, None, False, f"check could not run: {c.error}"))
            continue
        for row in c.result(c.values, n):
            shown = offending.get((c.name, c.column))
            out.append((*row[:7], f"{row[7]}: {', '.join(shown)}") if shown else row)
    out += _alone(t, "key_unique", ",".join(spec.key), lambda: _key_rows(frame, spec, t)) if spec.key else []
    out += _alone(t, "duplicate_rows", None, lambda: _copy_rows(frame, t, n)) if spec.check_duplicates and frame.names else []
    return spark.createDataFrame(out, REPORT_DDL)


def _alone(t: str, name: str, column: str | None, rows: Callable[[], list[tuple]]) -> list[tuple]:
    try:
        return rows()
    except Exception as exc:  # noqa: BLE001 - this check's own failure
        return [(t, name, column, "error", None, None, False, f"check could not run: {reason_of(exc)}")]


def _key_rows(frame: _Frame, spec: TableSpec, t: str) -> list[tuple]:
    keys = frame.data.groupBy(*[frame.at(k) for k in spec.key]).agg(F.count(F.lit(1)).alias("kn"))
    extra = int(keys.agg(F.coalesce(F.sum(F.col("kn") - 1), F.lit(0)).alias("extra")).first().extra)
    return [(t, "key_unique", ",".join(spec.key), "error", float(extra), 0.0, extra == 0, "ok" if extra == 0 else "key is not unique")]


def _copy_rows(frame: _Frame, t: str, n: int) -> list[tuple]:
    copies = count_duplicate_rows(frame.data, [f"c{i}" for i in range(len(frame.names))])
    pct = copies * 100.0 / n if n else 0.0
    text = "ok" if copies == 0 else "duplicate rows found"
    return [(t, "distinct_rows", None, "metric", float(n - copies), None, True, "ok"),
            (t, "duplicate_rows", None, "warning", float(copies), 0.0, copies == 0, text),
            (t, "duplicate_percent", None, "warning", pct, 0.0, copies == 0, text)]


def _offending(frame: _Frame, spec: TableSpec, checks: Sequence[Check], top: int) -> DataFrame:
    """check_name, column_name, value, row_count, place: the ``top`` most frequent offending values a check.

    One scan for all checks. Rows are counted per value with partial sums, so a value of a third of the rows is one
    row a task; the first places are taken inside hashed buckets of values and then among the buckets' winners, so
    no task ranks all different values of a column.
    """
    pairs = []
    for c in checks:
        col = F.col(frame.at(c.column))
        bad = ~col.isin(list(spec.allowed_values[c.column])) if c.name == "allowed_values" else col < 0
        pairs.append(F.when(bad, F.struct(F.lit(c.name).alias("check_name"), F.lit(c.column).alias("column_name"),
                                          col.cast("string").alias("value"))))
    found = (frame.data.select(F.explode(F.array_compact(F.array(*pairs))).alias("p")).select("p.*")
             .groupBy("check_name", "column_name", "value").agg(F.count(F.lit(1)).cast("long").alias("row_count")))
    order = [F.col("row_count").desc(), F.col("value")]
    bucket = F.pmod(F.xxhash64("value"), F.lit(VALUE_BUCKETS))
    first = (found.withColumn("_b", bucket)
             .withColumn("_p", F.row_number().over(Window.partitionBy("check_name", "column_name", "_b").orderBy(*order)))
             .filter(F.col("_p") <= top))
    place = F.row_number().over(Window.partitionBy("check_name", "column_name").orderBy(*order))  # top * buckets rows
    return first.drop("_b", "_p").withColumn("place", place.cast("long")).filter(F.col("place") <= top)


def offending_values(df: DataFrame, spec: TableSpec, top: int = 5) -> DataFrame:
    """AGG-5 for all value checks of ``spec`` at once: the ``top`` most frequent values outside the allowed set, or negative,
    of each column, ties in value order. Columns that are missing are left out; NULL never offends."""
    frame = _Frame(df, {})
    checks = [c for c in compile_checks(frame, spec, Thresholds()) if c.name in ("allowed_values", "non_negative")]
    checks = [c for c in checks if _analysed(frame, c)]
    if not checks:
        return df.sparkSession.createDataFrame([], "check_name string, column_name string, value string, row_count long, place long")
    return _offending(frame, spec, checks, top)


def validate_each(df: DataFrame, spec: TableSpec, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """The report that never raises for a broken check: the usual report, and where a check of it breaks, the isolated
    one, in which the broken check blocks the load and all others tell what they found."""
    try:
        return quality_report(df, spec, thresholds)
    except Exception:  # noqa: BLE001 - told check by check
        return isolated_report(df, spec, thresholds)
