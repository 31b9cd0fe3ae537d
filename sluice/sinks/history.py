"""Day by day tables whose schema changes (OPS-2 with OPS-1).

Old days are never rewritten. The table's schema is reconciled with a new day's: added columns are NULL in old
days, a type may only widen, and Spark's parquet reader turns the stored type into the wider one while it reads. The new
schema is a new catalog entry over the same files; a removed column stays and is NULL from then on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from sluice.sinks.publish import quoted
from sluice.sinks.tables import table_location

#: Types in widening order: each can be read as any later one of its row.
_WIDER = (("tinyint", "smallint", "int", "bigint"), ("tinyint", "smallint", "int", "double"), ("float", "double"),
          ("date", "timestamp_ntz"))


class SchemaConflict(ValueError):
    """A column whose type can't be widened without rewriting earlier days."""


def wider_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds values of both without a rewrite of stored ones; raises ``SchemaConflict`` if there is none."""
    if a == b:
        return a
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        if digits <= 38:
            return T.DecimalType(digits, scale)
    names = (a.simpleString(), b.simpleString())
    for row in _WIDER:
        if names[0] in row and names[1] in row:
            return a if row.index(names[0]) > row.index(names[1]) else b
    raise SchemaConflict(f"{names[0]} and {names[1]}")


def reconcile(old: T.StructType, new: T.StructType) -> T.StructType:
    """The old columns in their order, each as wide as both need, then the added ones. Names match in any case."""
    added = {f.name.lower(): f for f in new.fields}
    fields = []
    for f in old.fields:
        other = added.pop(f.name.lower(), None)
        try:
            fields.append(T.StructField(f.name, f.dataType if other is None else wider_type(f.dataType, other.dataType)))
        except SchemaConflict as exc:
            raise SchemaConflict(f"column {f.name}: {exc} have no common type that reads earlier days as they are") from None
    return T.StructType([*fields, *[T.StructField(f.name, f.dataType) for f in added.values()]])


def fit(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema``: cast to its types, NULL where it has none."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[(F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def evolve(spark: SparkSession, table: str, schema: T.StructType, partition_by: Sequence[str]) -> None:
    """Give an external table a reconciled schema: its entry is made anew over the same files, its partitions found
    there. Files are not touched."""
    location = table_location(spark, quoted(table))
    spark.sql(f"DROP TABLE {quoted(table)}")  # an external table's files stay
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = ", ".join(f"`{c}`" for c in partition_by)
    spark.sql(f"CREATE TABLE {quoted(table)} ({columns}) USING parquet PARTITIONED BY ({by}) LOCATION '{location}'")
    spark.sql(f"MSCK REPAIR TABLE {quoted(table)}")


def append_day(df: DataFrame, table: str, path: str, day: str = "_processing_date") -> T.StructType:
    """Write ``df`` as its days of ``table`` (replacing those days, keeping all others), evolving the schema where it
    differs. Returns the table's schema. Raises ``SchemaConflict`` before anything is changed."""
    spark = df.sparkSession
    if spark.catalog.tableExists(quoted(table)):
        old = spark.read.table(quoted(table)).schema
        schema = reconcile(old, df.schema)
        if [(f.name, f.dataType) for f in schema.fields] != [(f.name, f.dataType) for f in old.fields]:
            evolve(spark, table, schema, [day])
    else:
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE {quoted(table)} ({columns}) USING parquet PARTITIONED BY (`{day}`) LOCATION '{path}'")
    stored = spark.read.table(quoted(table)).schema
    (fit(df, stored).hint("rebalance", day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(day).parquet(table_location(spark, quoted(table))))
    spark.sql(f"MSCK REPAIR TABLE {quoted(table)}")
    spark.sql(f"REFRESH TABLE {quoted(table)}")
    return stored
