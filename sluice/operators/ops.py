"""Operational helpers (OPS-2 ... OPS-5): schema drift, count trends, masking, lineage columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from sluice.functions.masking import keep_last, mask_value, pseudonym, redact


def schema_frame(spark: SparkSession, schema: StructType) -> DataFrame:
    """A schema as rows ``(position, column_name, data_type, nullable)`` (bounded by the column count)."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(schema.fields)]
    return spark.createDataFrame(rows, "position int, column_name string, data_type string, nullable boolean")


def schema_changes(old: StructType, new: StructType) -> list[tuple[str, str, str | None, str | None]]:
    """(column_name, change, old_type, new_type) for every column added, removed, retyped or moved,
    ordered by column name. Schemas are metadata bounded by the column count, so this runs on the driver."""
    a = {f.name: (i, f.dataType.simpleString()) for i, f in enumerate(old.fields)}
    b = {f.name: (i, f.dataType.simpleString()) for i, f in enumerate(new.fields)}
    out = []
    for name in sorted(set(a) | set(b)):
        if name not in a:
            out.append((name, "added", None, b[name][1]))
        elif name not in b:
            out.append((name, "removed", a[name][1], None))
        elif a[name][1] != b[name][1]:
            out.append((name, "retyped", a[name][1], b[name][1]))
        elif a[name][0] != b[name][0]:
            out.append((name, "moved", a[name][1], b[name][1]))
    return out


def schema_drift(spark: SparkSession, old: StructType, new: StructType) -> DataFrame:
    """OPS-2: ``column_name, change ('added'|'removed'|'retyped'|'moved'), old_type, new_type`` between two
    schemas. Unchanged columns are not listed."""
    return spark.createDataFrame(schema_changes(old, new),
                                 "column_name string, change string, old_type string, new_type string")


def count_trend(df: DataFrame, group_col: str, day_col: str) -> DataFrame:
    """OPS-3: rows per (group, day) with the previous day's count and the percent change.

    The window runs over the *aggregated* counts (one row per group and day), never over raw rows.
    """
    daily = df.groupBy(F.col(group_col), F.to_date(F.col(day_col)).alias("day")).agg(
        F.count(F.lit(1)).cast("long").alias("record_count")
    )
    w = Window.partitionBy(group_col).orderBy("day")
    prev = F.lag("record_count").over(w)
    return daily.select(
        group_col, "day", "record_count", prev.alias("previous_count"),
        F.when(prev.isNull() | (prev == 0), F.lit(None).cast("double"))
        .otherwise((F.col("record_count") - prev).cast("double") * F.lit(100.0) / prev.cast("double"))
        .alias("pct_change"),
    )


_MASKS = {"hash": pseudonym, "mask": mask_value, "last4": keep_last, "redact": redact}


def mask_columns(df: DataFrame, policy: Mapping[str, str]) -> DataFrame:
    """OPS-4: replace columns per ``policy`` (column -> 'hash' | 'mask' | 'last4' | 'redact'); others untouched."""
    unknown = {v for v in policy.values() if v not in _MASKS}
    if unknown:
        raise ValueError(f"unknown masking methods: {sorted(unknown)}")
    return df.select(*[(_MASKS[policy[c]](c) if c in policy else F.col(c)).alias(c) for c in df.columns])


def with_lineage(df: DataFrame) -> DataFrame:
    """OPS-5: file path and modification time of every row's source file (file-based sources only)."""
    return df.select("*", F.col("_metadata.file_path").alias("_file_path"),
                     F.col("_metadata.file_modification_time").alias("_file_modified"))
