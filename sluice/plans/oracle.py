"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written from the semantics, not generated from the Spark plans. Tables are the driver's views.
"""

from __future__ import annotations

# Fixed text rendering of driver columns, matching what a CSV export holds.
_RAW = {
    "customer": ("CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, "
                 "CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS c_acctbal, c_mktsegment"),
    "orders": ("CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, "
               "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o_totalprice, "
               "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority"),
}
_SHORT = "o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'"
_LONG = "o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AND o_totalprice < 100000"
_CORRUPT = f"(({_SHORT}) OR ({_LONG}))"


def _pct(n: str, rows: str) -> str:
    return f"CASE WHEN CAST({rows} AS DOUBLE) = 0 THEN 0.0 ELSE CAST({n} AS DOUBLE) * 100.0 / CAST({rows} AS DOUBLE) END"


def dq_sql(name: str, src: str, cols: list[str], key: list[str], required: list[str],
           allowed: dict[str, list[str]] | None = None, nonneg: list[str] | None = None,
           null_threshold: float = 10.0) -> str:
    """The long DQ report as UNION ALL of one-row SELECTs over one aggregate CTE."""
    allowed = allowed or {}
    nonneg = nonneg or []
    prof = [c for c in cols if not c.startswith("_")]
    aggs = ["count(*) AS rows_", "(SELECT count(*) FROM (SELECT DISTINCT * FROM src)) AS distinct_rows"]
    aggs += [f"count(*) FILTER (WHERE {c} IS NULL) AS n{i}" for i, c in enumerate(prof)]
    for i, (c, vals) in enumerate(allowed.items()):
        lst = ", ".join(f"'{v}'" for v in vals)
        aggs.append(f"count(*) FILTER (WHERE {c} NOT IN ({lst})) AS a{i}")
    aggs += [f"count(*) FILTER (WHERE {c} < 0) AS g{i}" for i, c in enumerate(nonneg)]
    keylist = ", ".join(key)
    head = (f"WITH src AS ({src}), s AS (SELECT {', '.join(aggs)} FROM src), "
            f"k AS (SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT {keylist} FROM src)) AS extra FROM src) ")

    def row(check, col, sev, metric, thr, passed, fail_msg, frm="s"):
        col_sql = "CAST(NULL AS VARCHAR)" if col is None else f"'{col}'"
        thr_sql = "CAST(NULL AS DOUBLE)" if thr is None else f"CAST({thr} AS DOUBLE)"
        msg = "'ok'" if fail_msg is None else f"CASE WHEN {passed} THEN 'ok' ELSE '{fail_msg}' END"
        return (f"SELECT '{name}' AS table_name, '{check}' AS check_name, {col_sql} AS column_name, "
                f"'{sev}' AS severity, CAST({metric} AS DOUBLE) AS metric, {thr_sql} AS threshold, "
                f"CAST({passed} AS BOOLEAN) AS passed, {msg} AS message FROM {frm}")

    parts = [row("column_count", None, "error", len(cols), 0, "true", None),
             row("duplicate_columns", None, "error", 0, 0, "true", None)]
    parts += [row("required_column", c, "error", 1, 1, "true", None) for c in required]
    parts.append(row("record_count", None, "error", "rows_", 0, "rows_ > 0", "table is empty"))
    parts.append(row("distinct_rows", None, "metric", "distinct_rows", None, "true", None))
    parts.append(row("duplicate_rows", None, "warning", "rows_ - distinct_rows", 0, "rows_ - distinct_rows = 0",
                     "duplicate rows found"))
    for i, c in enumerate(prof):
        pct = _pct(f"n{i}", "rows_")
        parts.append(row("null_count", c, "metric", f"n{i}", None, "true", None))
        parts.append(row("null_percent", c, "warning", pct, null_threshold, f"({pct}) <= {null_threshold}",
                         "NULL share above threshold"))
    for i, c in enumerate(allowed):
        parts.append(row("allowed_values", c, "warning", f"a{i}", 0, f"a{i} = 0", "values outside the allowed set"))
    for i, c in enumerate(nonneg):
        parts.append(row("non_negative", c, "warning", f"g{i}", 0, f"g{i} = 0", "negative values found"))
    if key:
        parts.append(row("key_unique", ",".join(key), "error", "extra", 0, "extra = 0", "key is not unique", frm="k"))
    return head + "\nUNION ALL\n".join(parts)


_ORDERS_NULLS = ("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, "
                 "nullif(o_orderpriority, '5-LOW') AS o_orderpriority FROM orders")
_CUSTOMER_NULLS = ("SELECT c_custkey, c_name, c_nationkey, c_acctbal, nullif(c_mktsegment, 'BUILDING') AS c_mktsegment "
                   "FROM customer")
_ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
_CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
_PART_COLS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]

_DQ_ORDERS = dq_sql("orders", _ORDERS_NULLS, _ORDERS_COLS, ["o_orderkey"], ["o_orderkey", "o_custkey", "o_orderstatus"],
                    {"o_orderstatus": ["F", "O"]})
_DQ_CUSTOMER = dq_sql("customer", _CUSTOMER_NULLS, _CUSTOMER_COLS, ["c_custkey"], ["c_custkey", "c_name", "c_nationkey"],
                      nonneg=["c_acctbal"])
_DQ_PART = dq_sql("part", "SELECT * FROM part", _PART_COLS, ["p_partkey"], ["p_partkey"],
                  nonneg=["p_size", "p_retailprice"])


def _isolated_sql() -> str:
    """The report on ``orders`` with two more columns whose names differ in case, and three checks that can't run."""
    cols = {**{c: c for c in _ORDERS_COLS}, "Note": "o_orderpriority", "note": "o_custkey"}
    src = f"WITH src AS ({_ORDERS_NULLS}), s AS (SELECT *, (SELECT count(*) FROM src) AS n FROM (SELECT "
    src += ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS n{i}" for i, c in enumerate(cols.values()))
    src += (", count(*) FILTER (WHERE o_orderstatus <> 'F') AS bad_status, count(*) FILTER (WHERE o_totalprice < 0) AS negative, "
            "count(*) FILTER (WHERE NOT coalesce(o_orderdate >= TIMESTAMP '1995-01-01', false)) AS old, "
            "count(*) - count(DISTINCT o_orderkey) AS extra FROM src)), "
            "v AS (SELECT string_agg(o_orderstatus || ' (' || k || ')', ', ' ORDER BY k DESC, o_orderstatus) AS shown FROM "
            "(SELECT o_orderstatus, count(*) AS k FROM src WHERE o_orderstatus <> 'F' GROUP BY 1 ORDER BY k DESC, 1 LIMIT 2)) ")

    def row(check, col, sev, metric, thr, passed, message):
        col_sql = "CAST(NULL AS VARCHAR)" if col is None else f"'{col}'"
        return (f"SELECT 'orders' AS table_name, '{check}' AS check_name, {col_sql} AS column_name, '{sev}' AS severity, "
                f"CAST({metric} AS DOUBLE) AS metric, CAST({thr} AS DOUBLE) AS threshold, {passed} AS passed, {message} AS message FROM s, v")

    def counted(check, col, sev, n, text):
        return row(check, col, sev, n, 0, f"{n} = 0", f"CASE WHEN {n} = 0 THEN 'ok' ELSE {text} END")

    def broken(check, col, why):
        return row(check, col, "error", "NULL", "NULL", "false", f"'check could not run: {why}'")

    out = [row("column_count", None, "error", len(cols), 0, "true", "'ok'"), row("duplicate_columns", None, "error", 0, 0, "true", "'ok'"),
           row("case_clash_columns", "note", "warning", 1, 0, "false", "'column names differ only in case'"),
           row("required_column", "o_orderkey", "error", 1, 1, "true", "'ok'"),
           row("record_count", None, "error", "n", 0, "n > 0", "CASE WHEN n > 0 THEN 'ok' ELSE 'table is empty' END")]
    for i, c in enumerate(cols):
        pct = _pct(f"n{i}", "n")
        out.append(row("null_count", c, "metric", f"n{i}", "NULL", "true", "'ok'"))
        out.append(row("null_percent", c, "warning", pct, 10, f"({pct}) <= 10.0",
                       f"CASE WHEN ({pct}) <= 10.0 THEN 'ok' ELSE 'NULL share above threshold' END"))
    out += [counted("allowed_values", "o_orderstatus", "warning", "bad_status", "'values outside the allowed set: ' || shown"),
            broken("allowed_values", "clerk", "no such column"),
            counted("non_negative", "o_totalprice", "warning", "negative", "'negative values found'"),
            broken("non_negative", "o_orderpriority", "CAST_INVALID_INPUT"),
            counted("rule", "recent", "error", "old", "'rows break the rule'"),
            broken("rule", "unknown", "UNRESOLVED_COLUMN.WITH_SUGGESTION"),
            counted("key_unique", "o_orderkey", "error", "extra", "'key is not unique'"),
            row("distinct_rows", None, "metric", "n", "NULL", "true", "'ok'"),
            row("duplicate_rows", None, "warning", 0, 0, "true", "'ok'"), row("duplicate_percent", None, "warning", 0, 0, "true", "'ok'")]
    return src + " UNION ALL ".join(out)


def _offending_sql(top: int) -> str:
    columns = {"l_returnflag": ("l_returnflag", "A"), "l_shipdate": ("CAST(CAST(l_shipdate AS DATE) AS VARCHAR)", "2000-01-01"),
               "l_linestatus": ("l_linestatus", "F")}
    counts = " UNION ALL ".join(f"SELECT '{c}' AS column_name, {sql} AS value, count(*) AS row_count FROM lineitem WHERE {sql} <> '{ok}' GROUP BY 2"
                                for c, (sql, ok) in columns.items())
    return f"""
        SELECT 'allowed_values' AS check_name, column_name, value, row_count, place FROM (
            SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY row_count DESC, value) AS place FROM ({counts})) WHERE place <= {top}"""


_META = ["_ingestion_timestamp", "_source_file", "_processing_date", "_batch_id", "_record_hash"]
_STATUSES = ["delivered", "shipped", "processing", "canceled", "unavailable", "invoiced", "created", "approved"]
# typed Bronze rows of the e-commerce tables fed from driver tables (the key is unique, so whole-row
# distinctness equals business-column distinctness and the constant metadata can stay out of ``src``)
_ECOM_CUSTOMERS = """SELECT CAST(c_custkey AS VARCHAR) AS customer_id, upper(trim(' ' || lower(c_mktsegment) || ' ')) AS customer_city,
    CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(c_nationkey AS VARCHAR) END AS customer_state,
    lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix FROM customer"""
_ECOM_ORDERS = """SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
    CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'pending' END AS order_status,
    o_orderdate AS order_purchase_timestamp,
    CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderdate + INTERVAL 1 DAY END AS order_approved_at,
    CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderdate + INTERVAL 3 DAY END AS order_delivered_carrier_date,
    o_orderdate + INTERVAL 7 DAY AS order_delivered_customer_date,
    CAST(o_orderdate + INTERVAL 30 DAY AS DATE) AS order_estimated_delivery_date FROM orders"""
_ECOM_PRODUCTS = """SELECT CAST(p_partkey AS VARCHAR) AS product_id, CAST(p_size AS DOUBLE) AS product_weight_g,
    CAST(CAST(p_retailprice AS DECIMAL(12,2)) - 950 AS DOUBLE) AS product_length_cm,
    CASE WHEN p_brand = 'Brand#1' THEN NULL ELSE CAST(p_size AS DOUBLE) END AS product_height_cm,
    CAST(p_size * 2 AS DOUBLE) AS product_width_cm FROM part"""


def _null_profile_sql() -> str:
    parts = [f"SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count, "
             f"{_pct(f'count(*) FILTER (WHERE {c} IS NULL)', 'count(*)')} AS null_percent, "
             f"CAST(count(*) AS BIGINT) AS row_count FROM o" for c in _ORDERS_COLS]
    return f"WITH o AS ({_ORDERS_NULLS}) " + " UNION ALL ".join(parts)


def _key_sql(label: str, table: str, key: str) -> str:
    return (f"SELECT '{label}' AS table_name, CAST(sum(kn) AS BIGINT) AS row_count, count(*) AS distinct_keys, "
            f"CAST(sum(kn - 1) AS BIGINT) AS duplicate_rows, count(*) FILTER (WHERE kn > 1) AS duplicated_keys, "
            f"CAST(coalesce(sum(kn) FILTER (WHERE isnull_), 0) AS BIGINT) AS null_key_rows, sum(kn - 1) = 0 AS is_unique "
            f"FROM (SELECT count(*) AS kn, bool_or({' OR '.join(k + ' IS NULL' for k in key.split(','))}) AS isnull_ "
            f"FROM {table} GROUP BY {key})")


_RUNS = ("SELECT event_id AS run_id, event_type AS job, user_id AS dag_id, "
         "CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status, ts AS started_at, "
         "ts + to_microseconds(CAST(round(value * 1000000.0) AS BIGINT)) AS ended_at, value AS duration_s, "
         "CAST(1 AS BIGINT) AS records FROM events")



def _window_rates(where: str, lateness: str) -> str:
    return f"""
        SELECT time_bucket(INTERVAL '1 day', started_at) AS window_start,
               time_bucket(INTERVAL '1 day', started_at) + INTERVAL '1 day' AS window_end,
               count(*) AS runs, count(*) FILTER (WHERE status = 'success') AS succeeded,
               CAST(count(*) FILTER (WHERE status = 'success') AS DOUBLE) * 100.0 / CAST(count(*) AS DOUBLE) AS success_rate,
               time_bucket(INTERVAL '1 day', started_at) + INTERVAL '1 day' <= (SELECT max(ts) FROM events) - INTERVAL '{lateness}' AS closed
        FROM ({_RUNS}) WHERE {where} GROUP BY 1, 2"""


def _trailing_sql(length: str, step: str, seconds: float, by: str = "") -> str:
    """Every pane of a group between its first and last; a range frame of the window's length over panes."""
    key, part = (f"{by}, ", f"PARTITION BY {by} ") if by else ("", "")
    using = f"({by}, pane)" if by else "(pane)"
    return f"""
        WITH p AS (SELECT {key}time_bucket(INTERVAL '{step}', started_at) AS pane, count(*) AS runs,
                          count(*) FILTER (WHERE status = 'success') AS succeeded, count(*) FILTER (WHERE status = 'failed') AS failed,
                          sum(records) AS records FROM ({_RUNS}) GROUP BY ALL),
        g AS (SELECT {key}unnest(generate_series(min(pane), max(pane), INTERVAL '{step}')) AS pane FROM p {'GROUP BY ' + by if by else ''}),
        d AS (SELECT {key}pane, coalesce(runs, 0) AS runs, coalesce(succeeded, 0) AS succeeded, coalesce(failed, 0) AS failed,
                     coalesce(records, 0) AS records FROM g LEFT JOIN p USING {using}),
        w AS (SELECT {key}pane + INTERVAL '{step}' AS at_time, CAST(sum(runs) OVER f AS BIGINT) AS runs, CAST(sum(succeeded) OVER f AS BIGINT) AS succeeded,
                     CAST(sum(failed) OVER f AS BIGINT) AS failed, CAST(sum(records) OVER f AS BIGINT) AS records FROM d
              WINDOW f AS ({part}ORDER BY pane RANGE BETWEEN INTERVAL '{length}' PRECEDING AND CURRENT ROW))
        SELECT *, CASE WHEN runs > 0 THEN CAST(succeeded AS DOUBLE) * 100.0 / CAST(runs AS DOUBLE) END AS success_rate,
               CAST(records AS DOUBLE) / {seconds} AS records_per_second, CAST(failed AS DOUBLE) / {seconds} AS failures_per_second FROM w"""


def _p95_states_sql() -> str:
    """From the runs themselves, at each grain: the largest value of the 1 % bucket that holds the rank."""
    grains = " UNION ALL ".join(f"SELECT '{g}' AS grain, time_bucket(INTERVAL '{g}', started_at) AS pane_start, job, duration_s AS v FROM ({_RUNS})"
                                for g in ("5 minutes", "1 hour", "1 day"))
    return f"""
        WITH r AS (SELECT grain, pane_start, job, v, CASE WHEN v = 0 THEN 0 WHEN v > 0 THEN ceil(ln(v) / ln(1.01::DOUBLE)) + 1048576
                          ELSE -ceil(ln(-v) / ln(1.01::DOUBLE)) - 1048576 END AS bucket FROM ({grains})),
        s AS (SELECT grain, pane_start, job, bucket, count(*) AS n, max(v) AS high FROM r GROUP BY ALL),
        c AS (SELECT *, sum(n) OVER (PARTITION BY grain, pane_start, job ORDER BY bucket) AS upto,
                     sum(n) OVER (PARTITION BY grain, pane_start, job) AS runs FROM s)
        SELECT grain, pane_start, job, CAST(runs AS BIGINT) AS runs, high AS p95 FROM c
        WHERE upto > floor(0.95::DOUBLE * (runs - 1)) AND upto - n <= floor(0.95::DOUBLE * (runs - 1))"""


_CUSTOMER_RAW_NULLS = (f"SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, "
                       f"CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS c_acctbal, "
                       f"nullif(c_mktsegment, 'BUILDING') AS c_mktsegment FROM customer")

_BRONZE_COUNT_TABLES = f"""
WITH cust AS (SELECT DATE '2024-01-15' AS _processing_date, TIMESTAMP '2024-01-15 02:00:00' AS _ingestion_timestamp FROM customer),
ord AS (SELECT DATE '2024-01-15' AS _processing_date, TIMESTAMP '2024-01-15 02:00:00' AS _ingestion_timestamp FROM orders),
ev AS (SELECT CAST(ts AS DATE) AS _processing_date, ts AS _ingestion_timestamp FROM events),
sup AS (SELECT DATE '2024-01-14' AS _processing_date, TIMESTAMP '2024-01-14 02:00:00' AS _ingestion_timestamp FROM supplier)
"""

_FACT = """
SELECT l.l_orderkey, l.l_linenumber, l.l_returnflag, l.l_linestatus,
       CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS revenue,
       CAST(l.l_quantity AS DECIMAL(12,2)) AS quantity,
       o.o_custkey, o.o_orderdate, c.c_mktsegment, c.c_nationkey, n.n_name
FROM lineitem l
LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
"""


def _stream_quality_sql() -> str:
    """The events report of one micro-batch (metadata columns included, NULL rows left out)."""
    cols = ["event_id", "ts", "user_id", "event_type", "value", "props", "_ingestion_timestamp", "_source_file",
            "_processing_date", "_batch_id", "_record_hash"]
    head = (
        "WITH s AS (SELECT count(*) AS rows_, count(*) FILTER (WHERE event_type NOT IN ('signup', 'purchase', 'view', 'click')) AS a0, "
        "count(*) FILTER (WHERE value < 0) AS g0, "
        + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS n_{c}" for c in cols[:6]) + " FROM events), "
        "k AS (SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT event_id FROM events)) AS extra FROM events) "
    )

    def row(check, col, sev, metric, thr, passed, fail_msg, frm="s"):
        col_sql = "CAST(NULL AS VARCHAR)" if col is None else f"'{col}'"
        msg = "'ok'" if fail_msg is None else f"CASE WHEN {passed} THEN 'ok' ELSE '{fail_msg}' END"
        return (f"SELECT 'EVENTS' AS table_name, '{check}' AS check_name, {col_sql} AS column_name, '{sev}' AS severity, "
                f"CAST({metric} AS DOUBLE) AS metric, CAST({thr} AS DOUBLE) AS threshold, CAST({passed} AS BOOLEAN) AS passed, "
                f"{msg} AS message FROM {frm}")

    parts = [row("column_count", None, "error", len(cols), 0, "true", None),
             row("duplicate_columns", None, "error", 0, 0, "true", None)]
    parts += [row("required_column", c, "error", 1, 1, "true", None) for c in ("event_id", "ts", "event_type")]
    for c in cols[:6]:
        parts.append(row("null_count", c, "metric", f"n_{c}", "NULL", "true", None))
        parts.append(row("null_percent", c, "warning", _pct(f"n_{c}", "rows_"), 10.0, f"({_pct(f'n_{c}', 'rows_')}) <= 10.0",
                         "NULL share above threshold"))
    parts += [row("record_count", None, "error", "rows_", 0, "rows_ > 0", "table is empty"),
              row("allowed_values", "event_type", "warning", "a0", 0, "a0 = 0", "values outside the allowed set"),
              row("non_negative", "value", "warning", "g0", 0, "g0 = 0", "negative values found"),
              row("key_unique", "event_id", "error", "extra", 0, "extra = 0", "key is not unique", frm="k")]
    return head + " UNION ALL ".join(parts)


_TOO_MANY = """printf('too many corrupt lines: %.2f%% > 5.0%%',
                   (SELECT CAST(count(*) FILTER (WHERE ((o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')
                           OR (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AND o_totalprice < 100000))) AS DOUBLE)
                           * 100.0 / CAST(count(*) AS DOUBLE) FROM orders))"""


def _ingest_run_sql() -> str:
    ok = [f"SELECT '{t.upper()}' AS table_name, 'write' AS stage, 'success' AS status, (SELECT count(*) FROM {t}) AS record_count, "
          "CAST(NULL AS VARCHAR) AS error_class, CAST(NULL AS VARCHAR) AS error, CAST(NULL AS VARCHAR) AS schema_changes"
          for t in ("customer", "nation", "part", "region", "supplier")]
    return " UNION ALL ".join([*ok, "SELECT 'ORDERS', 'read', 'failed', CAST(NULL AS BIGINT), 'CorruptRecordsError', "
                               f"{_TOO_MANY}, CAST(NULL AS VARCHAR)"])


# customer written as part files with four headers: what each row holds after loading by name
_MIXED = f"""
    WITH r AS (SELECT *, CAST(c_nationkey AS INTEGER) AS k FROM (SELECT {_RAW['customer']} FROM customer))
    SELECT CASE WHEN k < 20 THEN c_custkey END AS c_custkey, CASE WHEN k < 20 THEN c_name END AS c_name,
           CASE WHEN k < 20 THEN c_nationkey END AS c_nationkey, CASE WHEN k < 20 THEN c_acctbal END AS c_acctbal,
           CASE WHEN k < 14 THEN c_mktsegment END AS c_mktsegment,
           CASE WHEN k >= 20 THEN concat_ws(',', c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment) END AS quarantined_line
    FROM r"""


def _published(name: str, src: str, typed: str, raw: list[str], day: str) -> str:
    """Bronze rows of a source table: typed columns, metadata, and the fingerprint of the raw values."""
    return (f"SELECT {typed}, TIMESTAMP '{day} 02:00:00' AS _ingestion_timestamp, '{name}' AS _source_file, DATE '{day}' AS _processing_date, "
            f"'{day.replace('-', '')}_020000' AS _batch_id, sha256(concat_ws('|', {', '.join(raw)})) AS _record_hash FROM ({src})")


_RAW_CUSTOMERS = """SELECT CAST(c_custkey AS VARCHAR) AS customer_id, ' ' || lower(c_mktsegment) || ' ' AS customer_city,
    CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(c_nationkey AS VARCHAR) END AS customer_state,
    lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix FROM customer"""
_RAW_PRODUCTS = """SELECT CAST(p_partkey AS VARCHAR) AS product_id, CAST(p_size AS VARCHAR) AS product_weight_g,
    CAST(CAST(p_retailprice AS DECIMAL(12,2)) - 950 AS VARCHAR) AS product_length_cm,
    CASE WHEN p_brand = 'Brand#1' THEN 'n/a' ELSE CAST(p_size AS VARCHAR) END AS product_height_cm,
    CAST(p_size * 2 AS VARCHAR) AS product_width_cm FROM part"""
_RAW_PAYMENTS = """SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS payment_sequential,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS payment_value, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS payment_installments
    FROM lineitem"""
_PUBLISH_RUNS = """
    WITH n AS (SELECT (SELECT count(*) FROM customer) AS c1, (SELECT count(*) FROM customer WHERE NOT c_acctbal < 0) AS c2,
                      (SELECT count(*) FROM part) AS p1, (SELECT count(*) FROM lineitem) AS l1, (SELECT count(*) FROM orders) AS o2),
    day1 AS (SELECT CAST(1 AS BIGINT) AS attempt, '20240114' AS run_id, 'OLIST_CUSTOMERS_DATASET' AS table_name, 'publish' AS stage,
                    'success' AS status, c1 AS record_count, CAST(NULL AS VARCHAR) AS error FROM n
             UNION ALL SELECT 1, '20240114', 'OLIST_PRODUCTS_DATASET', 'publish', 'success', p1, NULL FROM n
             UNION ALL SELECT 1, '20240114', 'OLIST_ORDER_PAYMENTS_DATASET', 'publish', 'success', l1, NULL FROM n),
    day2 AS (SELECT a.attempt, '20240115' AS run_id, 'OLIST_CUSTOMERS_DATASET' AS table_name, 'publish' AS stage, 'success' AS status,
                    c2 AS record_count, CAST(NULL AS VARCHAR) AS error FROM n, (VALUES (CAST(2 AS BIGINT)), (3)) a(attempt)
             UNION ALL SELECT a.attempt, '20240115', 'OLIST_ORDERS_DATASET', 'publish', 'success', o2, NULL FROM n, (VALUES (2), (3)) a(attempt)
             UNION ALL SELECT a.attempt, '20240115', 'OLIST_PRODUCTS_DATASET', 'validate', 'failed', NULL,
                    'load blocked by failed checks: key_unique(product_id): key is not unique' FROM (VALUES (2), (3)) a(attempt))
    SELECT * FROM day1 UNION ALL SELECT * FROM day2"""

_ACTIVE_RUNS = f"""
        WITH r AS (SELECT
              CASE WHEN date_trunc('minute', started_at) = started_at THEN started_at
                   ELSE date_trunc('minute', started_at) + INTERVAL '1 minute' END AS first_,
              CASE WHEN date_trunc('minute', ended_at) = ended_at THEN ended_at
                   ELSE date_trunc('minute', ended_at) + INTERVAL '1 minute' END AS stop_
            FROM ({_RUNS}) WHERE ended_at IS NULL OR ended_at > started_at),
        v AS (SELECT * FROM r WHERE stop_ IS NULL OR first_ < stop_),
        g AS (SELECT unnest(generate_series(min(first_), max(greatest(first_, coalesce(stop_ - INTERVAL '1 minute', first_))),
                                            INTERVAL '1 minute')) AS at_time FROM v),
        e AS (SELECT p, sum(d) AS d FROM (SELECT first_ AS p, 1 AS d FROM v UNION ALL
                                          SELECT stop_, -1 FROM v WHERE stop_ IS NOT NULL) GROUP BY p)
        SELECT at_time, CAST(sum(coalesce(d, 0)) OVER (ORDER BY at_time) AS BIGINT) AS active_runs
        FROM g LEFT JOIN e ON p = at_time"""

ORACLE: dict[str, str] = {
    "dq_report_orders": _DQ_ORDERS,
    "dq_rules_customer": _DQ_CUSTOMER,
    "dq_rules_part": _DQ_PART,
    "ecommerce_customers_report": dq_sql(
        "OLIST_CUSTOMERS_DATASET", _ECOM_CUSTOMERS,
        ["customer_id", "customer_city", "customer_state", "customer_zip_code_prefix"] + _META,
        ["customer_id"], ["customer_id", "customer_city", "customer_state"]),
    "ecommerce_orders_report": dq_sql(
        "OLIST_ORDERS_DATASET", _ECOM_ORDERS,
        ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
         "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date"] + _META,
        ["order_id"], ["order_id", "customer_id", "order_status"], {"order_status": _STATUSES}),
    "ecommerce_products_report": dq_sql(
        "OLIST_PRODUCTS_DATASET", _ECOM_PRODUCTS,
        ["product_id", "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"] + _META,
        ["product_id"], ["product_id"],
        nonneg=["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]),
    "dq_isolated": _isolated_sql(),
    "offending_values": _offending_sql(7),
    "null_profile": _null_profile_sql(),
    "duplicate_profile": """
        SELECT CAST(sum(n) AS BIGINT) AS row_count, count(*) AS distinct_count, CAST(sum(n - 1) AS BIGINT) AS duplicate_count
        FROM (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY o_custkey, o_orderstatus)""",
    "key_uniqueness": " UNION ALL ".join([
        _key_sql("orders", "orders", "o_orderkey"),
        _key_sql("lineitem", "lineitem", "l_orderkey"),
        _key_sql("lineitem_line", "lineitem", "l_orderkey,l_linenumber"),
    ]),
    "invalid_values": """
        SELECT 'o_orderstatus' AS column_name, o_orderstatus AS value, count(*) AS row_count
        FROM orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY o_orderstatus
        UNION ALL
        SELECT 'l_returnflag' AS column_name, l_returnflag AS value, count(*) AS row_count
        FROM lineitem WHERE l_returnflag NOT IN ('A', 'N') GROUP BY l_returnflag""",
    "negative_values": """
        SELECT 'customer' AS table_name, 'c_acctbal' AS column_name, count(*) FILTER (WHERE c_acctbal < 0) AS negative_count FROM customer
        UNION ALL
        SELECT 'supplier', 's_acctbal', count(*) FILTER (WHERE s_acctbal < 0) FROM supplier""",
    "bronze_enrich": f"""
        SELECT *, TIMESTAMP '2024-01-15 02:00:00' AS _ingestion_timestamp, 'CUSTOMER' AS _source_file,
               DATE '2024-01-15' AS _processing_date, '20240115_020000' AS _batch_id,
               sha256(concat_ws('|', c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment)) AS _record_hash
        FROM ({_CUSTOMER_RAW_NULLS})""",
    "standardize_text": """
        SELECT c_custkey, upper(trim('  ' || lower(c_mktsegment) || ' ')) AS c_mktsegment, upper(trim(' ' || c_name)) AS c_name
        FROM customer""",
    "type_timestamps": """
        SELECT o_orderkey,
               CASE WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE o_orderdate END AS order_ts,
               CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS order_day
        FROM orders""",
    "type_decimal": """
        SELECT l_orderkey, l_linenumber, CAST(TRY_CAST(
            CASE WHEN l_returnflag = 'R' THEN CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) || '5'
                 WHEN l_linestatus = 'O' THEN CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) || '000'
                 ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) END AS DECIMAL(10,2)) AS DOUBLE) AS payment_value
        FROM lineitem""",
    "type_double": """
        SELECT p_partkey, CASE WHEN p_size > 45 THEN NULL ELSE CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) END AS p_retailprice
        FROM part""",
    "type_int": """
        SELECT l_orderkey, l_linenumber,
               CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(l_quantity AS INTEGER) END AS installments,
               CAST(l_quantity AS INTEGER) AS installments_legacy
        FROM lineitem""",
    "corrupt_split": f"SELECT {_RAW['orders']} FROM orders WHERE NOT {_CORRUPT}",
    "stream_csv_ingest": f"SELECT {_RAW['orders']} FROM orders WHERE NOT {_CORRUPT}",
    "corrupt_rate_gate": f"""
        WITH s AS (SELECT count(*) AS total, count(*) FILTER (WHERE {_CORRUPT}) AS corrupt FROM orders),
        p AS (SELECT * FROM (VALUES ('base', 5.0), ('dev', 10.0), ('staging', 3.0), ('prod', 1.0)) t(env, max_percent))
        SELECT env, total, corrupt, {_pct('corrupt', 'total')} AS corrupt_percent, CAST(max_percent AS DOUBLE) AS max_percent,
               corrupt = 0 OR ({_pct('corrupt', 'total')}) <= max_percent AS passed
        FROM s, p""",
    "quarantine": f"""
        SELECT CASE WHEN {_SHORT} THEN concat_ws(',', o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate)
                    ELSE concat_ws(',', o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, 'x') END AS line
        FROM (SELECT {_RAW['orders']} FROM orders WHERE {_CORRUPT}) AS r""",
    "record_counts": _BRONZE_COUNT_TABLES + """
        SELECT 'CUSTOMER' AS table_name, count(*) AS record_count, count(*) > 0 AS passed FROM cust WHERE _processing_date = DATE '2024-01-15'
        UNION ALL SELECT 'ORDERS', count(*), count(*) > 0 FROM ord WHERE _processing_date = DATE '2024-01-15'
        UNION ALL SELECT 'EVENTS', count(*), count(*) > 0 FROM ev WHERE _processing_date = DATE '2024-01-15'
        UNION ALL SELECT 'SUPPLIER', count(*), count(*) > 0 FROM sup WHERE _processing_date = DATE '2024-01-15'""",
    "freshness": _BRONZE_COUNT_TABLES + """
        SELECT table_name, max(_ingestion_timestamp) AS latest_ingestion, count(*) AS records_today FROM (
            SELECT 'CUSTOMER' AS table_name, _ingestion_timestamp FROM cust WHERE _processing_date = DATE '2024-01-15'
            UNION ALL SELECT 'ORDERS', _ingestion_timestamp FROM ord WHERE _processing_date = DATE '2024-01-15'
            UNION ALL SELECT 'EVENTS', _ingestion_timestamp FROM ev WHERE _processing_date = DATE '2024-01-15'
            UNION ALL SELECT 'SUPPLIER', _ingestion_timestamp FROM sup WHERE _processing_date = DATE '2024-01-15'
        ) GROUP BY table_name""",
    "table_roundtrip": """
        SELECT c.c_custkey, c.c_name, n.n_name,
               (SELECT count(*) FROM customer JOIN nation ON c_nationkey = n_nationkey) AS rows_written, true AS table_exists
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "query_scan": """
        SELECT n.n_name, count(*) AS customers, CAST(sum(CAST(c.c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name""",
    "ingest_run": _ingest_run_sql(),
    "ingest_summary": f"""
        SELECT 'success' AS status, CAST(5 AS BIGINT) AS tables,
               (SELECT count(*) FROM customer) + (SELECT count(*) FROM nation) + (SELECT count(*) FROM part)
               + (SELECT count(*) FROM region) + (SELECT count(*) FROM supplier) AS records,
               'CUSTOMER,NATION,PART,REGION,SUPPLIER' AS table_names, '' AS errors
        UNION ALL SELECT 'failed', 1, 0, 'ORDERS', 'ORDERS at read: ' || {_TOO_MANY}""",
    "csv_mixed_headers": _MIXED,
    "publish_runs": _PUBLISH_RUNS,
    "published_customers": _published(
        "OLIST_CUSTOMERS_DATASET", f"SELECT * FROM ({_RAW_CUSTOMERS}) WHERE customer_state IS NOT NULL",
        "customer_id, upper(trim(customer_city)) AS customer_city, upper(trim(customer_state)) AS customer_state, customer_zip_code_prefix",
        ["customer_id", "customer_city", "customer_state", "customer_zip_code_prefix"], "2024-01-15"),
    "published_products": _published(
        "OLIST_PRODUCTS_DATASET", _RAW_PRODUCTS,
        ", ".join(["product_id"] + [f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in
                                    ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")]),
        ["product_id", "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"], "2024-01-14"),
    "published_payments": _published(
        "OLIST_ORDER_PAYMENTS_DATASET", _RAW_PAYMENTS,
        "order_id, payment_sequential, CAST(TRY_CAST(payment_value AS DECIMAL(10,2)) AS DOUBLE) AS payment_value, "
        "CAST(payment_installments AS INTEGER) AS payment_installments",
        ["order_id", "payment_sequential", "payment_value", "payment_installments"], "2024-01-14"),
    "post_load_checks": " UNION ALL ".join(
        f"SELECT '{t.upper()}' AS table_name, count(*) AS record_count, count(*) > 0 AS passed, count(*) AS fresh_rows FROM {t}"
        for t in ("customer", "nation", "part", "region", "supplier")),
    "file_inventory": """
        SELECT * FROM (VALUES ('customer.csv', 'CUSTOMER'), ('nation.csv', 'NATION'), ('orders.csv', 'ORDERS'),
            ('part.csv', 'PART'), ('region.csv', 'REGION'), ('supplier.csv', 'SUPPLIER')) t(entry, table_name)""",
    "required_files": """
        SELECT * FROM (VALUES ('customer.csv', true), ('orders.csv', true), ('lineitem.csv', false), ('part.csv', true),
            ('supplier.csv', true), ('nation.csv', true), ('region.csv', true)) t(entry, present)""",
    "success_rate": f"""
        SELECT time_bucket(INTERVAL '1 hour', started_at) AS window_start,
               time_bucket(INTERVAL '1 hour', started_at) + INTERVAL '1 hour' AS window_end,
               count(*) AS runs, count(*) FILTER (WHERE status = 'success') AS succeeded,
               {_pct("count(*) FILTER (WHERE status = 'success')", 'count(*)')} AS success_rate
        FROM ({_RUNS}) GROUP BY 1, 2""",
    "status_band": f"""
        SELECT *, CASE WHEN success_rate >= 95 THEN 'green' WHEN success_rate >= 80 THEN 'yellow' ELSE 'red' END AS band FROM (
        SELECT time_bucket(INTERVAL '1 day', started_at) AS window_start,
               time_bucket(INTERVAL '1 day', started_at) + INTERVAL '1 day' AS window_end,
               count(*) AS runs, count(*) FILTER (WHERE status = 'success') AS succeeded,
               {_pct("count(*) FILTER (WHERE status = 'success')", 'count(*)')} AS success_rate
        FROM ({_RUNS}) GROUP BY 1, 2)""",
    "active_runs": _ACTIVE_RUNS,
    "active_run_bands": f"""
        SELECT *, CASE WHEN active_runs >= 10 THEN 'red' WHEN active_runs >= 5 THEN 'yellow' ELSE 'green' END AS band
        FROM ({_ACTIVE_RUNS})""",
    "active_runs_at": f"""
        SELECT count(*) FILTER (WHERE started_at <= TIMESTAMP '2024-01-15 02:00:00'
                                  AND (ended_at IS NULL OR ended_at > TIMESTAMP '2024-01-15 02:00:00')) AS active_runs
        FROM ({_RUNS})""",
    "success_rate_last_24h": f"""
        SELECT time_bucket(INTERVAL '1 hour', started_at) AS window_start,
               time_bucket(INTERVAL '1 hour', started_at) + INTERVAL '1 hour' AS window_end,
               count(*) AS runs, count(*) FILTER (WHERE status = 'success') AS succeeded,
               {_pct("count(*) FILTER (WHERE status = 'success')", 'count(*)')} AS success_rate
        FROM ({_RUNS}) WHERE started_at >= TIMESTAMP '2024-01-14 02:00:00' AND started_at < TIMESTAMP '2024-01-15 02:00:00'
          AND job = 'purchase'
        GROUP BY 1, 2""",
    "stream_success_rate": _window_rates("true", "12 days"),
    "stream_rate_without_late": _window_rates("CAST(started_at AS DATE) NOT BETWEEN DATE '2024-01-07' AND DATE '2024-01-12'", "1 day"),
    "stream_late_runs": f"""
        SELECT *, time_bucket(INTERVAL '1 day', started_at) AS window_start, 'late' AS reason FROM ({_RUNS})
        WHERE CAST(started_at AS DATE) BETWEEN DATE '2024-01-07' AND DATE '2024-01-12'""",
    "stream_repeated_key": """
        SELECT CAST(0 AS BIGINT) AS arrival, true AS passed, CAST(0 AS BIGINT) AS repeated, count(*) AS orders,
               count(DISTINCT o_orderkey) AS order_keys, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM orders
        UNION ALL SELECT 1, false, count(*), NULL, NULL, NULL, NULL FROM orders WHERE o_orderstatus = 'F'""",
    "records_per_second": f"""
        SELECT time_bucket(INTERVAL '5 minutes', started_at) AS window_start, job, CAST(sum(records) AS BIGINT) AS records,
               CAST(sum(records) AS DOUBLE) / 300.0 AS records_per_second
        FROM ({_RUNS}) GROUP BY 1, 2""",
    "p95_value": f"""
        SELECT time_bucket(INTERVAL '1 day', started_at) AS window_start, job, count(*) AS runs,
               round(quantile_cont(duration_s, 0.95), 6) AS p95
        FROM ({_RUNS}) GROUP BY 1, 2""",
    "p95_states": _p95_states_sql(),
    "trailing_rates": _trailing_sql("55 minutes", "5 minutes", 3600.0),
    "trailing_rates_by_job": _trailing_sql("23 hours", "1 hour", 86400.0, "job"),
    "failure_rate": f"""
        SELECT time_bucket(INTERVAL '1 hour', started_at) AS window_start, dag_id, count(*) AS runs,
               count(*) FILTER (WHERE status = 'failed') AS failures,
               CAST(count(*) FILTER (WHERE status = 'failed') AS DOUBLE) / 3600.0 AS failures_per_second
        FROM ({_RUNS}) GROUP BY 1, 2""",
    "run_durations": f"""
        SELECT run_id, job, started_at, ended_at,
               CAST(date_diff('microsecond', started_at, ended_at) AS DOUBLE) / 1000000.0 AS duration_seconds
        FROM ({_RUNS})""",
    "dq_series": f"""
        WITH r AS (SELECT * FROM ({_DQ_ORDERS}) UNION ALL SELECT * FROM ({_DQ_CUSTOMER}) UNION ALL SELECT * FROM ({_DQ_PART}))
        SELECT *, CASE WHEN CAST(checks AS DOUBLE) = 0 THEN 0.0
                       ELSE CAST(validation_failures AS DOUBLE) * 100.0 / CAST(checks AS DOUBLE) END AS failure_rate
        FROM (SELECT table_name,
               count(*) FILTER (WHERE severity IN ('error', 'warning')) AS checks,
               count(*) FILTER (WHERE NOT passed AND severity IN ('error', 'warning')) AS validation_failures,
               count(*) FILTER (WHERE NOT passed AND severity = 'error') AS blocking_failures,
               coalesce(max(metric) FILTER (WHERE check_name = 'null_percent'), 0.0) AS max_null_percent
        FROM r GROUP BY table_name)""",
    "dedup_latest": """
        SELECT event_id, ts, user_id, event_type, value, props FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
        WHERE rn = 1""",
    "apply_rules": """
        SELECT CASE WHEN NOT coalesce(l_quantity > 0, false) THEN 'quantity_positive'
                    WHEN NOT coalesce(l_discount <= 0.08, false) THEN 'discount_small'
                    WHEN NOT coalesce(l_returnflag <> 'R', false) THEN 'not_returned' END AS _rejected_by,
               count(*) AS rows
        FROM lineitem GROUP BY 1""",
    "lookup_skewed": """
        WITH f AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN CAST(1 AS BIGINT) ELSE l_partkey END AS l_partkey, l_quantity
                   FROM lineitem),
        r AS (SELECT p_partkey, p_name || CASE WHEN p_retailprice > 1000 THEN ' v2' ELSE '' END AS p_name, p_brand FROM part WHERE p_brand <> 'Brand#3')
        SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, coalesce(p_name, 'part ' || l_partkey) AS p_name,
               coalesce(p_brand, 'unknown') AS p_brand, p_partkey IS NOT NULL AS found FROM f LEFT JOIN r ON l_partkey = p_partkey""",
    "upsert_latest": """
        SELECT event_id, ts, user_id, event_type, value, props FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
        WHERE rn = 1""",
    "append_runs": "SELECT *, 'run-' || lower(l_returnflag) AS run_id FROM lineitem WHERE l_returnflag IN ('A', 'N')",
    "write_modes": """
        WITH n AS (SELECT count(*) FILTER (WHERE c_acctbal < 0) AS old, count(*) FILTER (WHERE c_acctbal >= 0) AS new, min(c_custkey) AS first_key,
                          min(c_custkey) FILTER (WHERE c_acctbal < 0) AS first_old, min(c_custkey) FILTER (WHERE c_acctbal >= 0) AS first_new FROM customer)
        SELECT mode, state, CASE WHEN mode = 'error' AND state = 'existing' THEN 'TABLE_OR_VIEW_ALREADY_EXISTS' ELSE 'written' END AS outcome,
               CASE WHEN mode = 'error' AND state = 'existing' THEN NULL WHEN mode = 'ignore' AND state = 'existing' THEN 0 ELSE new END AS written,
               CASE WHEN state = 'new' OR mode = 'overwrite' THEN new WHEN mode = 'append' THEN old + new ELSE old END AS table_rows,
               CASE WHEN state = 'new' OR mode = 'overwrite' THEN first_new WHEN mode = 'append' THEN first_key ELSE first_old END AS first_key
        FROM n, (VALUES ('append'), ('overwrite'), ('ignore'), ('error')) m(mode), (VALUES ('existing'), ('new')) s(state)""",
    "lookup_join": """
        SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity, p.p_name, p.p_brand
        FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey""",
    "fact_sales": f"""
        SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, o_custkey, o_orderdate, c_mktsegment, c_nationkey, n_name,
               CAST(revenue AS DOUBLE) AS revenue, CAST(quantity AS DOUBLE) AS quantity FROM ({_FACT})""",
    "dim_customer": """
        SELECT c.c_custkey, c.c_name, c.c_mktsegment, c.c_nationkey, n.n_name, n.n_regionkey, r.r_name
        FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "kpi_rollup": f"""
        SELECT l_returnflag, l_linestatus, count(*) AS rows, CAST(sum(quantity) AS DOUBLE) AS sum_qty,
               CAST(sum(revenue) AS DOUBLE) AS revenue
        FROM ({_FACT}) GROUP BY ROLLUP (l_returnflag, l_linestatus)""",
    "daily_kpis": f"""
        SELECT CAST(o_orderdate AS DATE) AS order_day, count(*) AS lines, count(DISTINCT l_orderkey) AS orders,
               CAST(sum(revenue) AS DOUBLE) AS revenue
        FROM ({_FACT}) GROUP BY 1""",
    "count_trend": """
        SELECT event_type, day, record_count, previous_count,
               CASE WHEN previous_count IS NULL OR previous_count = 0 THEN NULL
                    ELSE CAST(record_count - previous_count AS DOUBLE) * 100.0 / CAST(previous_count AS DOUBLE) END AS pct_change
        FROM (SELECT event_type, day, record_count,
                     lag(record_count) OVER (PARTITION BY event_type ORDER BY day) AS previous_count
              FROM (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS record_count FROM events GROUP BY 1, 2))""",
    "mask_columns": f"""
        SELECT c_custkey,
               regexp_replace(regexp_replace(regexp_replace(c_name, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g') AS c_name,
               sha256('' || c_nationkey) AS c_nationkey,
               CASE WHEN length(c_acctbal) <= 4 THEN repeat('*', length(c_acctbal)) ELSE repeat('*', length(c_acctbal) - 4) || right(c_acctbal, 4) END AS c_acctbal,
               CASE WHEN c_mktsegment IS NULL THEN NULL ELSE '****' END AS c_mktsegment
        FROM (SELECT {_RAW['customer']} FROM customer)""",
    "lineage_counts": """
        SELECT 'events.parquet' AS file_name, count(*) AS rows, count(DISTINCT user_id) AS users FROM events""",
    "partitioned_whole": "SELECT *, CAST(ts AS DATE) AS event_day FROM events",
    "history_widened": """
        SELECT p_partkey, p_name, CAST(p_size AS DOUBLE) AS p_size, CAST(NULL AS VARCHAR) AS p_brand, DATE '2024-01-01' AS day FROM part
        UNION ALL SELECT p_partkey, p_name, p_size + 0.5::DOUBLE, p_brand, DATE '2024-01-02' FROM part
        UNION ALL SELECT p_partkey, NULL, CAST(p_size AS DOUBLE), p_brand, DATE '2024-01-03' FROM part""",
    "rates_in_range": f"""
        SELECT time_bucket(INTERVAL '1 hour', started_at) AS window_start,
               time_bucket(INTERVAL '1 hour', started_at) + INTERVAL '1 hour' AS window_end,
               count(*) AS runs, count(*) FILTER (WHERE status = 'success') AS succeeded,
               {_pct("count(*) FILTER (WHERE status = 'success')", 'count(*)')} AS success_rate
        FROM ({_RUNS}) WHERE started_at >= TIMESTAMP '2024-01-12 02:00:00' AND started_at < TIMESTAMP '2024-01-15 02:00:00'
        GROUP BY 1, 2""",
    "standardize_renamed": f"""
        SELECT product_id AS id, TRY_CAST(product_weight_g AS DOUBLE) AS product_weight_g, TRY_CAST(product_length_cm AS DOUBLE) AS product_length_cm,
               coalesce(TRY_CAST(product_height_cm AS DOUBLE), -1) AS height, TRY_CAST(product_width_cm AS DOUBLE) AS product_width_cm
        FROM ({_RAW_PRODUCTS})""",
    "drop_inventory": f"""
        SELECT 'customer.csv' AS entry, true AS present, CAST((SELECT sum(strlen(concat_ws(',', c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment)) + 1)
            FROM (SELECT {_RAW['customer']} FROM customer)) AS BIGINT) AS data_bytes
        UNION ALL SELECT 'part.csv', true, CAST((SELECT sum(strlen(concat_ws(',', p_partkey, p_name, p_brand, p_type, p_size,
            CAST(p_retailprice AS DECIMAL(18,2)))) + 1) FROM part) AS BIGINT)
        UNION ALL SELECT 'lineitem.csv', false, 0
        UNION ALL SELECT 'orders.csv', true, CAST((SELECT sum(1 + CASE
            WHEN {_SHORT} THEN strlen(concat_ws(',', o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate))
            WHEN {_LONG} THEN strlen(concat_ws(',', o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, 'x'))
            ELSE strlen(concat_ws(',', o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority)) END)
            FROM (SELECT {_RAW['orders'].replace('CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o_totalprice', 'CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice')} FROM orders)) AS BIGINT)""",
    "partitioned_roundtrip": """
        SELECT event_id, ts, user_id, event_type, value, CAST(ts AS DATE) AS event_day
        FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'""",
    "stream_quality": _stream_quality_sql(),
    "stream_bronze": """
        SELECT event_id, user_id, event_type, value, 'EVENTS' AS _source_file, DATE '2024-01-15' AS _processing_date,
               '20240115_020000' AS _batch_id,
               sha256(concat_ws('|', CAST(event_id AS VARCHAR), CAST(ts AS VARCHAR), CAST(user_id AS VARCHAR), event_type,
                                CAST(value AS VARCHAR), props)) AS _record_hash
        FROM events""",
}
