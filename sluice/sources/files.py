"""File inventory over any Hadoop path (local, ``s3a://``, ``abfss://`` ...), listed by Spark, not by the driver.

A raw drop is a folder; each table is either one file ``<name>.csv`` or a folder ``<name>.csv/`` of part
files (what Spark itself writes). The entry right below the root names the table.
"""

from __future__ import annotations

import os
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

_SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.\-]*:(//[^/]*)?"


def _strip_scheme(col):
    return F.regexp_replace(col, _SCHEME, "")


def absolute_path(root: str) -> str:
    """A scheme-less relative root resolved against this process's working directory (the JVM would use
    its own start directory otherwise)."""
    if not re.match(_SCHEME, root) and not root.startswith("/"):
        return os.path.abspath(root)
    return root


def _norm_root(root: str) -> str:
    """The root's path part as Spark will report it (scheme and authority removed)."""
    return re.sub(_SCHEME, "", absolute_path(root)).rstrip("/")


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Every file under ``root`` (recursive) as ``path, length, modification_time``; contents are never read.

    A missing root raises Spark's PATH_NOT_FOUND error; an empty root gives an empty frame.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(absolute_path(root)).select(
        "path", "length", F.col("modificationTime").alias("modification_time")
    )


def file_inventory(spark: SparkSession, root: str, suffix: str = ".csv") -> DataFrame:
    """SRC-1: files whose name ends in ``suffix`` (case-sensitive), with the table each belongs to.

    Columns: path, entry (name right below the root), table_name (entry without ``suffix``, upper-cased),
    length, modification_time.
    """
    base = _norm_root(root)
    files = list_files(spark, root, glob=f"*{suffix}")
    rel = F.substring(_strip_scheme(F.col("path")), len(base) + 2, 1 << 20)
    entry = F.substring_index(rel, "/", 1)
    # a table is an entry right below the root that bears the suffix itself; files in other folders are none
    return files.filter(entry.endswith(suffix)).select(
        "path",
        entry.alias("entry"),
        F.upper(F.replace(entry, F.lit(suffix), F.lit(""))).alias("table_name"),
        "length",
        "modification_time",
    )


def table_inventory(inventory: DataFrame) -> DataFrame:
    """One row per table: entry, table_name, files, bytes, last_modified (ordered by entry)."""
    return (
        inventory.groupBy("entry", "table_name")
        .agg(
            F.count(F.lit(1)).cast("long").alias("files"),
            F.sum("length").cast("long").alias("bytes"),
            F.max("modification_time").alias("last_modified"),
        )
        .orderBy("entry")
    )


def required_files(spark: SparkSession, inventory: DataFrame, required: Sequence[str]) -> DataFrame:
    """SRC-2: each required entry with ``present`` and its byte size (a left join against the inventory)."""
    need = spark.createDataFrame([(r,) for r in required], "entry string")
    sizes = inventory.groupBy("entry").agg(F.sum("length").cast("long").alias("bytes"))
    return need.join(sizes, "entry", "left").select(
        "entry", F.col("bytes").isNotNull().alias("present"), F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes")
    )


class MissingFilesError(FileNotFoundError):
    pass


def assert_required_files(report: DataFrame) -> None:
    """Raise listing every missing entry (only missing names reach the driver)."""
    missing = [r.entry for r in report.filter(~F.col("present")).select("entry").collect()]
    if missing:
        raise MissingFilesError(f"Missing required files: {sorted(missing)}")


def list_objects(spark: SparkSession, uri: str, sample: int = 5) -> DataFrame:
    """SRC-3: object count under ``uri`` plus the first ``sample`` keys in key order, as one row.

    The sample is a top-k (bounded); the count is a plain aggregate. No key list ever reaches the driver.
    """
    files = list_files(spark, uri)
    first = files.select("path").orderBy("path").limit(sample)
    both = files.select(F.lit(1).alias("one"), F.lit(None).cast("string").alias("key")).unionByName(
        first.select(F.lit(0).alias("one"), F.col("path").alias("key"))
    )
    return both.agg(
        F.sum("one").cast("long").alias("object_count"), F.sort_array(F.collect_list("key")).alias("sample")
    )
