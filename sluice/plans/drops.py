"""Raw CSV drops derived from the driver tables, written by Spark into the shared checkpoint folder.

Each table becomes a folder ``<name>.csv/`` of part files with a header line each, values rendered the
way a text export renders them (2-decimal money, ``yyyy-MM-dd HH:mm:ss`` times). ``orders`` can carry
malformed lines, chosen by the data itself (no key arithmetic):

* too few fields (priority dropped):  status 'P' and priority '1-URGENT'
* too many fields (an extra 'x'):     status 'F' and priority '1-URGENT' and total price < 100000
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from sluice.session import session_key, staging_path
from sluice.sinks.tables import write_lines

SHORT_LINE = "o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'"
LONG_LINE = "o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AND o_totalprice < 100000"

_cache: dict[tuple, str] = {}


def render(df: DataFrame) -> list[Column]:
    """Each column as the text a CSV export holds."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = c.cast("decimal(18,2)").cast("string")
        else:
            c = c.cast("string")
        out.append(c.alias(f.name))
    return out


def as_raw_strings(df: DataFrame) -> DataFrame:
    """The all-string frame a header CSV scan of ``df``'s export would give."""
    return df.select(*render(df))


def lines_of(df: DataFrame, short_when: str | None = None, long_when: str | None = None) -> DataFrame:
    """One text line per row; optionally drop the last field or add an extra one where a predicate holds."""
    fields = [F.coalesce(c, F.lit("")) for c in render(df)]  # NULL -> empty field, positions kept
    full = F.concat_ws(",", *fields)
    short = F.concat_ws(",", *fields[:-1])
    line = full
    if long_when:
        line = F.when(F.expr(long_when), F.concat_ws(",", full, F.lit("x"))).otherwise(line)
    if short_when:
        line = F.when(F.expr(short_when), short).otherwise(line)
    return df.select(line.alias("line"))


def write_table_csv(df: DataFrame, folder: str, name: str, short_when=None, long_when=None) -> str:
    path = f"{folder}/{name}.csv"
    write_lines(lines_of(df, short_when, long_when), path, header=",".join(df.columns))
    return path


def raw_drop(spark: SparkSession, sf_dir: str, tables=("region", "nation", "customer", "supplier", "part", "orders"),
             corrupt_orders: bool = True) -> str:
    """Write (once per session and input) a raw drop folder and return its path."""
    key = (session_key(spark), sf_dir, tuple(tables), corrupt_orders)
    if key in _cache:
        return _cache[key]
    folder = staging_path(spark, "raw")
    for t in tables:
        df = spark.read.parquet(f"{sf_dir}/{t}.parquet")
        if t == "orders" and corrupt_orders:
            write_table_csv(df, folder, t, SHORT_LINE, LONG_LINE)
        else:
            write_table_csv(df, folder, t)
    _cache[key] = folder
    return folder


#: Parts of the drop with differing headers: which rows, the file's columns, and the name its header gives one of them.
MIXED_PARTS = (
    ("c_nationkey < 8", ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"), {}),
    ("c_nationkey >= 8 AND c_nationkey < 14", ("c_mktsegment", "c_custkey", "c_acctbal", "c_name", "c_nationkey"), {}),
    ("c_nationkey >= 14 AND c_nationkey < 20", ("c_custkey", "c_nationkey", "c_name", "c_acctbal"), {}),
    ("c_nationkey >= 20", ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"), {"c_acctbal": "balance"}),
)


def mixed_header_drop(spark: SparkSession, sf_dir: str) -> str:
    """``customer`` as one folder of part files with four headers: as the table has it, in another order, without the
    last column, and with a name the table doesn't have."""
    path = f"{staging_path(spark, 'raw')}/customer.csv"
    df = spark.read.parquet(f"{sf_dir}/customer.parquet")
    for where, columns, renamed in MIXED_PARTS:
        write_lines(lines_of(df.filter(where).select(*columns)), path, header=",".join(renamed.get(c, c) for c in columns), mode="append")
    return path


def source_drop(spark: SparkSession, tables: dict[str, DataFrame]) -> str:
    """A raw drop of all-string ``tables`` under their source's file names (``<name>.csv`` folders); returns its folder."""
    folder = staging_path(spark, "raw")
    for name, df in tables.items():
        write_table_csv(df, folder, name)
    return folder
