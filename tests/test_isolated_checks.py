"""Checks that fail alone, and offending values."""

import pytest
from pyspark.sql import functions as F

from sluice.operators import isolated, quality
from sluice.specs import TableSpec, Thresholds

from helpers import rows


def by_check(report):
    return {(r.check_name, r.column_name): r for r in report.collect()}


def test_equals_the_usual_report_where_nothing_breaks(spark):
    df = spark.createDataFrame([(1, "a", -1.0), (1, None, 2.0), (2, "b", None), (2, "b", None)], "k int, s string, x double")
    spec = TableSpec("T", key=("k",), required=("k", "gone"), allowed_values={"s": ("a",)}, non_negative=("x",))
    usual, alone = by_check(quality.quality_report(df, spec)), by_check(isolated.isolated_report(df, spec, top=0))
    assert set(alone) - set(usual) == {("duplicate_percent", None)}
    assert {k: tuple(v) for k, v in alone.items() if k in usual} == {k: tuple(v) for k, v in usual.items()}
    assert alone["duplicate_percent", None].metric == 25.0 and not alone["duplicate_percent", None].passed


def test_a_check_that_breaks_on_a_row_leaves_the_others(spark):
    df = spark.createDataFrame([(i, "x", str(i), -i) for i in range(10)], "k int, txt string, num string, n int")
    spec = TableSpec("T", key=("k", "none"), allowed_values={"txt": ("y",), "lost": ("a",)}, non_negative=("txt", "num", "n"))
    rules = {"small": "n > -5", "ratio": "10 / n > 0", "bad": "n >", "wide": "nope = 1", "null": "NULL"}
    got = by_check(isolated.isolated_report(df, spec, Thresholds(), rules))
    broken = {k: r.message for k, r in got.items() if r.metric is None}
    assert set(broken) == {("non_negative", "txt"), ("allowed_values", "lost"), ("rule", "ratio"), ("rule", "bad"), ("rule", "wide"),
                           ("key_unique", "k,none")}
    assert broken["rule", "ratio"] == "check could not run: DIVIDE_BY_ZERO"
    assert broken["allowed_values", "lost"] == "check could not run: no such column"
    assert got["rule", "small"].metric == 5.0 and got["rule", "null"].metric == 10.0
    assert got["non_negative", "num"].passed and got["non_negative", "n"].message == "negative values found: -1 (1), -2 (1), -3 (1), -4 (1), -5 (1)"
    assert got["allowed_values", "txt"].message == "values outside the allowed set: x (10)"
    assert got["null_count", "txt"].metric == 0.0 and got["record_count", None].metric == 10.0
    with pytest.raises(quality.QualityGateError, match="DIVIDE_BY_ZERO"):
        quality.gate(isolated.isolated_report(df, spec, Thresholds(), rules))


def test_clashing_and_odd_names(spark):
    df = spark.createDataFrame([(1, None, "p", "q", 5)], "a int, A int, `b.c` string, `b c` string, d int").toDF("a", "A", "b.c", "b c", "d")
    spec = TableSpec("T", allowed_values={"b.c": ("p",), "B C": ("x",)}, non_negative=("a", "A", "D"))
    got = by_check(isolated.isolated_report(df, spec, rules={"ok": "d = 5", "clash": "a = 1"}))
    assert got["null_count", "A"].metric == 1.0 and got["null_count", "a"].metric == 0.0 and got["null_count", "b.c"].metric == 0.0
    assert got["allowed_values", "b.c"].passed and got["allowed_values", "B C"].message.endswith("q (1)")
    assert got["non_negative", "a"].passed and got["non_negative", "A"].passed and got["non_negative", "D"].passed
    assert got["rule", "ok"].passed and got["rule", "clash"].message == "check could not run: AMBIGUOUS_REFERENCE"
    twice = df.select(F.col("d").alias("a"), F.col("`b c`").alias("a"))
    assert by_check(isolated.isolated_report(twice, TableSpec("T", non_negative=("a",))))["non_negative", "a"].message.endswith("ambiguous column")


def test_empty_table_and_no_columns(spark):
    got = by_check(isolated.isolated_report(spark.createDataFrame([], "a int"), TableSpec("T", key=("a",), non_negative=("a",))))
    assert not got["record_count", None].passed and got["null_percent", "a"].metric == 0.0 and got["duplicate_percent", None].metric == 0.0
    assert not by_check(isolated.isolated_report(spark.range(2).select(), TableSpec("T")))["column_count", None].passed


def test_offending_values_are_the_most_frequent(spark):
    df = spark.range(3000).select((F.col("id") % 50).cast("string").alias("s"), (-F.col("id") % 7).alias("n"))
    df = df.union(spark.createDataFrame([("hot", 3)] * 2000 + [(None, None)] * 5, "s string, n long"))
    spec = TableSpec("T", allowed_values={"s": ("0", "1"), "gone": ("x",)}, non_negative=("n", "s"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        isolated.offending_values(df, spec).collect()
    got = isolated.offending_values(df, TableSpec("T", allowed_values=spec.allowed_values, non_negative=("n",)), top=3)
    found = [tuple(r) for r in got.orderBy("check_name", "place").collect()]
    assert found[:3] == [("allowed_values", "s", "hot", 2000, 1), ("allowed_values", "s", "10", 60, 2), ("allowed_values", "s", "11", 60, 3)]
    assert [r[2:] for r in found[3:]] == [("-1", 429, 1), ("-2", 429, 2), ("-3", 429, 3)]
    assert isolated.offending_values(df, TableSpec("T")).count() == 0


def test_validate_each_keeps_the_other_rows(spark):
    df = spark.createDataFrame([([1, 2], None)], "xs array<int>, v string")
    got = by_check(isolated.validate_each(df, TableSpec("T", non_negative=("xs",))))
    assert got["non_negative", "xs"].metric is None and got["null_percent", "v"].metric == 100.0
    assert rows(isolated.validate_each(df, TableSpec("T"))) == rows(quality.quality_report(df, TableSpec("T")))
