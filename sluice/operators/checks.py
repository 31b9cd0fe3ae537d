"""Post-load checks (AGG-8, AGG-9, FLT-6, SET-1).

Each takes loaded tables by name and a day; the day filter hits ``_processing_date``, which is a partition
column of partitioned Bronze tables, so only that day's files are read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F


def _day_filter(df: DataFrame, day, date_col: str) -> DataFrame:
    """``date_col = day``; ``day`` may be a date, a datetime (its date is used) or 'yyyy-MM-dd' text."""
    if isinstance(day, dt.datetime):
        day = day.date()
    d = F.lit(day) if isinstance(day, dt.date) else F.lit(day).cast("date")
    return df.filter(F.col(date_col) == d)


def record_counts(
    tables: Mapping[str, DataFrame],
    day,
    date_col: str = "_processing_date",
    check_time=None,
) -> DataFrame:
    """AGG-8: per table ``record_count`` for ``day`` (an empty table gives 0), ``passed`` = count > 0.

    Every table is a global aggregate (one row each) and the rows are concatenated with ``unionByName``.
    """
    parts = []
    for name, df in tables.items():
        one = _day_filter(df, day, date_col).agg(F.count(F.lit(1)).cast("long").alias("record_count"))
        ct = F.current_timestamp() if check_time is None else F.lit(check_time)
        parts.append(one.select(F.lit(name).alias("table_name"), "record_count", ct.alias("check_time"),
                                (F.col("record_count") > 0).alias("passed")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def freshness(
    tables: Mapping[str, DataFrame],
    day,
    ts_col: str = "_ingestion_timestamp",
    date_col: str = "_processing_date",
) -> DataFrame:
    """AGG-9: latest ingestion time and rows for ``day`` per table. A table without rows that day has no row.

    Tagged projections are concatenated (UNION ALL) and grouped once; each branch is pre-aggregated by
    Spark's partial aggregation before the small shuffle.
    """
    parts = [
        _day_filter(df, day, date_col).select(F.lit(name).alias("table_name"), F.col(ts_col).alias("_ts"))
        for name, df in tables.items()
    ]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy("table_name").agg(
        F.max("_ts").alias("latest_ingestion"), F.count(F.lit(1)).cast("long").alias("records_today")
    )
