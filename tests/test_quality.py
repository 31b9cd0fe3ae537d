import pytest

from sluice.operators import quality
from sluice.specs import TableSpec, Thresholds

from helpers import rows


def report_map(df):
    return {(r.check_name, r.column_name): r for r in df.collect()}


def test_report_counts_nulls_keys_and_allowed_values(spark):
    df = spark.createDataFrame(
        [("o1", "c1", "delivered"), ("o2", "c2", "weird"), ("o3", None, None), ("o3", "c3", "shipped")],
        "order_id string, customer_id string, order_status string",
    )
    spec = TableSpec("ORDERS", key=("order_id",), required=("order_id", "customer_id", "order_status"),
                     allowed_values={"order_status": ("delivered", "shipped")})
    m = report_map(quality.quality_report(df, spec))
    assert m[("record_count", None)].metric == 4 and m[("record_count", None)].passed
    assert m[("null_count", "customer_id")].metric == 1
    assert m[("null_percent", "customer_id")].metric == 25.0 and not m[("null_percent", "customer_id")].passed
    # NULL status is not reported as invalid (three-valued logic)
    assert m[("allowed_values", "order_status")].metric == 1
    assert m[("key_unique", "order_id")].metric == 1 and not m[("key_unique", "order_id")].passed
    assert m[("duplicate_rows", None)].metric == 0


def test_null_threshold_is_strict(spark):
    df = spark.createDataFrame([(None,)] + [("x",)] * 9, "a string")
    m = report_map(quality.quality_report(df, TableSpec("T"), Thresholds(null_percent=10.0)))
    assert m[("null_percent", "a")].metric == 10.0 and m[("null_percent", "a")].passed
    m = report_map(quality.quality_report(df, TableSpec("T"), Thresholds(null_percent=9.99)))
    assert not m[("null_percent", "a")].passed


def test_empty_table_is_an_error_and_null_share_is_zero(spark):
    df = spark.createDataFrame([], "a string, b string")
    m = report_map(quality.quality_report(df, TableSpec("T", key=("a",))))
    assert not m[("record_count", None)].passed
    assert m[("null_percent", "a")].metric == 0.0
    assert m[("key_unique", "a")].passed
    with pytest.raises(quality.QualityGateError):
        quality.gate(quality.quality_report(df, TableSpec("T")))


def test_required_and_duplicate_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int").toDF("a", "a")
    m = report_map(quality.quality_report(df, TableSpec("T", required=("a", "zz"))))
    assert not m[("duplicate_columns", "a")].passed
    assert m[("required_column", "a")].passed and not m[("required_column", "zz")].passed


def test_null_key_counts_as_one_value(spark):
    once = spark.createDataFrame([(None, 1), (1, 2)], "k int, v int")
    twice = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k int, v int")
    assert quality.key_uniqueness(once, ["k"]).first().is_unique
    r = quality.key_uniqueness(twice, ["k"]).first()
    assert (r.row_count, r.distinct_keys, r.duplicate_rows, r.null_key_rows, r.is_unique) == (3, 2, 1, 2, False)


def _brute_dups(data):
    return len(data) - len(set(data))


@pytest.mark.parametrize("case", ["unique", "hot_key", "many_repeats", "null_keys"])
def test_eager_and_lazy_reports_agree_with_brute_force(spark, case):
    if case == "unique":
        data = [(i, f"v{i % 7}", i % 3) for i in range(300)]
    elif case == "hot_key":  # a third of the rows share one key, some of them exact copies
        data = [(0, f"v{i % 50}", 1) for i in range(200)] + [(i, "w", 2) for i in range(1, 401)]
    elif case == "many_repeats":
        data = [(i % 40, f"v{i % 3}", 0) for i in range(300)]
    else:
        data = [(None, "a", 1), (None, "a", 1), (None, "b", 1), (5, "a", 1), (5, "a", 1), (6, "z", 0)]
    df = spark.createDataFrame(data, "k int, s string, n int")
    spec = TableSpec("T", key=("k",), non_negative=("n",))
    eager = report_map(quality.quality_report(df, spec))
    lazy = report_map(quality.quality_report(df, spec, lazy=True))
    assert {k: tuple(v) for k, v in eager.items()} == {k: tuple(v) for k, v in lazy.items()}
    assert eager[("duplicate_rows", None)].metric == _brute_dups(data)
    keys = [d[0] for d in data]
    assert eager[("key_unique", "k")].metric == len(keys) - len(set(keys))


def test_narrowed_duplicate_check_broadcasts_only_when_bounded(spark):
    data = [(0, "x")] * 5 + [(i, "y") for i in range(1, 200)]
    df = spark.createDataFrame(data, "k int, s string")
    spec = TableSpec("T", key=("k",))
    for limit in (0, 10):
        m = report_map(quality.quality_report(df, spec, max_broadcast_keys=limit))
        assert m[("duplicate_rows", None)].metric == 4


def test_standalone_profiles(spark):
    df = spark.createDataFrame([("a", -1.0), ("a", None), (None, 2.0), ("b", -3.0)], "s string, x double")
    assert rows(quality.null_profile(df)) == [("s", 1, 25.0, 4), ("x", 1, 25.0, 4)]
    assert rows(quality.negative_counts(df, ["x"])) == [("x", 2)]
    assert rows(quality.invalid_values(df, "s", ["a"])) == [("s", "b", 1)]
    d = quality.duplicate_profile(df.select("s")).first()
    assert (d.row_count, d.distinct_count, d.duplicate_count) == (4, 3, 1)
    assert rows(quality.duplicate_keys(df, ["s"])) == [("a", 2)]


def test_gate_returns_warnings_and_raises_on_errors(spark):
    df = spark.createDataFrame([("a", None)] * 3, "k string, v string")
    warnings = quality.gate(quality.quality_report(df, TableSpec("T")))
    assert any("null_percent" in w for w in warnings) and any("duplicate_rows" in w for w in warnings)
    with pytest.raises(quality.QualityGateError, match="key_unique"):
        quality.gate(quality.quality_report(df, TableSpec("T", key=("k",))))
    assert quality.gate(quality.quality_report(df, TableSpec("T", key=("k",))), enabled=False) == []


def test_validate_turns_a_broken_check_into_an_error_row(spark):
    df = spark.createDataFrame([([1, 2],)], "xs array<int>")
    rep = quality.validate(df, TableSpec("T", non_negative=("xs",)))  # an array cannot be compared with 0
    r = rep.collect()
    assert len(r) == 1 and r[0].check_name == "validation_error" and not r[0].passed
    with pytest.raises(quality.QualityGateError, match="validation_error"):
        quality.gate(rep)


@pytest.mark.parametrize("case", ["none", "some", "zero_sign", "nulls", "all_same"])
def test_count_duplicate_rows_is_exact(spark, case):
    if case == "none":
        data = [(i, float(i), f"s{i}") for i in range(200)]
    elif case == "some":
        data = [(i % 50, float(i % 7), "x") for i in range(200)]
    elif case == "zero_sign":  # -0.0 and 0.0 group together, so they are copies
        data = [(1, -0.0, "a"), (1, 0.0, "a"), (2, float("nan"), "b"), (2, float("nan"), "b")]
    elif case == "nulls":  # (NULL, a) and (a, NULL) must not be taken for copies
        data = [(None, 1.0, "a"), (1, None, "a"), (None, 1.0, "a")]
    else:
        data = [(7, 7.0, "z")] * 50
    df = spark.createDataFrame(data, "a int, b double, c string")
    want = df.count() - df.distinct().count()
    assert quality.count_duplicate_rows(df) == want
    assert quality.count_duplicate_rows(df, max_broadcast=0) == want


def test_streaming_frames_are_pointed_to_micro_batches(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "s"))
    stream = spark.readStream.schema("id long").parquet(str(tmp_path / "s"))
    with pytest.raises(ValueError, match="micro-batch"):
        quality.quality_report(stream, TableSpec("T"))
