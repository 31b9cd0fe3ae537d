import datetime as dt
import hashlib
from decimal import Decimal

from pyspark.sql import functions as F

from sluice.functions import legacy_int, record_hash, try_cast_to, upper_trim
from sluice.operators.bronze import METADATA_COLUMNS, bronze_transform
from sluice.specs import CUSTOMERS, ORDERS, PAYMENTS, PRODUCTS

from helpers import rows


def test_fingerprint_skips_nulls_and_does_not_escape_pipes(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a|b", None, None)], "x string, y string, z string")
    hashes = [r.h for r in df.select(record_hash(df.columns).alias("h")).collect()]
    assert len(set(hashes)) == 1 and hashes[0] == hashlib.sha256(b"a|b").hexdigest()


def test_typing_edge_cases(spark):
    df = spark.createDataFrame([("12.345", "8.7", "2017-10-18 00:00:00", "x")], "d string, i string, t string, bad string")
    r = df.select(
        try_cast_to("d", "decimal(10,2)").alias("dec"),
        F.lit("123456789.01").try_cast("decimal(10,2)").alias("overflow"),
        try_cast_to("i", "int").alias("strict_int"),
        legacy_int("i").alias("legacy"),
        legacy_int(F.lit("-8.7")).alias("legacy_neg"),
        try_cast_to("t", "date").alias("day"),
        try_cast_to("t", "timestamp_ntz").alias("ts"),
        try_cast_to("bad", "double").alias("bad_double"),
        try_cast_to("bad", "timestamp").alias("bad_ts"),
    ).first()
    assert r.dec == Decimal("12.35") and r.overflow is None
    assert r.strict_int is None and r.legacy == 8 and r.legacy_neg == -8
    assert r.day == dt.date(2017, 10, 18) and r.ts == dt.datetime(2017, 10, 18)
    assert r.bad_double is None and r.bad_ts is None


def test_upper_trim_keeps_accents_and_tabs(spark):
    df = spark.createDataFrame([("  são paulo ",), ("\tsp",)], "c string")
    assert sorted(rows(df.select(upper_trim("c")))) == sorted([("SÃO PAULO",), ("\tSP",)])


def test_bronze_transform_metadata_and_hash_before_typing(spark):
    df = spark.createDataFrame([("c1", " sp", "x"), ("c2", "SP", "x")], "customer_id string, customer_state string, customer_city string")
    as_of = dt.datetime(2024, 1, 31, 2, 3, 4)
    out = bronze_transform(df, CUSTOMERS, as_of=as_of)
    assert out.columns == df.columns + list(METADATA_COLUMNS)
    got = out.collect()
    assert {r.customer_state for r in got} == {"SP"}
    assert got[0]._record_hash != got[1]._record_hash  # fingerprint is over raw values
    r = got[0]
    assert (r._source_file, r._processing_date, r._batch_id) == ("OLIST_CUSTOMERS_DATASET", dt.date(2024, 1, 31), "20240131_020304")
    assert r._ingestion_timestamp.replace(tzinfo=None) == as_of


def test_reference_table_specs_type_their_columns(spark):
    orders = spark.createDataFrame([("o1", "c1", "delivered", "2017-10-02 10:56:33", "", "bad", None, "2017-10-18 00:00:00")],
                                   "order_id string, customer_id string, order_status string, order_purchase_timestamp string, "
                                   "order_approved_at string, order_delivered_carrier_date string, "
                                   "order_delivered_customer_date string, order_estimated_delivery_date string")
    r = bronze_transform(orders, ORDERS, as_of=dt.datetime(2024, 1, 1)).first()
    assert r.order_purchase_timestamp.replace(tzinfo=None) == dt.datetime(2017, 10, 2, 10, 56, 33)
    assert r.order_approved_at is None and r.order_delivered_carrier_date is None
    assert r.order_estimated_delivery_date == dt.date(2017, 10, 18)
    prod = spark.createDataFrame([("p1", "-1", "2.5", "x", None)],
                                 "product_id string, product_weight_g string, product_length_cm string, "
                                 "product_height_cm string, product_width_cm string")
    p = bronze_transform(prod, PRODUCTS, as_of=dt.datetime(2024, 1, 1)).first()
    assert (p.product_weight_g, p.product_length_cm, p.product_height_cm) == (-1.0, 2.5, None)
    pay = spark.createDataFrame([("12.345", "3"), ("123456789.01", "x")], "payment_value string, payment_installments string")
    got = rows(bronze_transform(pay, PAYMENTS, as_of=dt.datetime(2024, 1, 1)).select("payment_value", "payment_installments"))
    assert got == [(Decimal("12.35"), 3), (None, None)]


def test_orders_fixture_without_the_time_columns_loads(spark):
    """The upstream orders fixture has only four of the eight columns the orders typing names."""
    from sluice.operators.quality import quality_report

    df = spark.createDataFrame(
        [("order_001", "cust_001", "delivered", "2023-01-01 10:00:00"),
         ("order_002", "cust_002", "shipped", "2023-01-02 11:00:00"),
         ("order_003", "cust_003", "processing", "2023-01-03 12:00:00")],
        "order_id string, customer_id string, order_status string, order_purchase_timestamp string")
    out = bronze_transform(df, ORDERS, as_of=dt.datetime(2024, 1, 1))
    assert out.columns[:4] == df.columns
    assert out.first().order_purchase_timestamp.replace(tzinfo=None) == dt.datetime(2023, 1, 1, 10)
    failed = [r for r in quality_report(out, ORDERS).collect() if not r.passed]
    assert failed == []


def test_rows_differing_only_in_raw_case_are_not_duplicates(spark):
    from sluice.operators.quality import quality_report

    df = spark.createDataFrame([("c1", "sp", "x"), ("c1", "SP", "x"), ("c1", "SP", "x")],
                               "customer_id string, customer_state string, customer_city string")
    out = bronze_transform(df, CUSTOMERS, as_of=dt.datetime(2024, 1, 1))
    assert {r.customer_state for r in out.collect()} == {"SP"}
    m = {(r.check_name, r.column_name): r.metric for r in quality_report(out, CUSTOMERS).collect()}
    assert m[("duplicate_rows", None)] == 1.0  # only the two raw-identical rows; 'sp' differs by fingerprint
    assert m[("key_unique", "customer_id")] == 2.0
