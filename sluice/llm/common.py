"""Small helpers the operators of this package share."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from sluice.session import cut_lineage, staging_path

#: Words are maximal runs of anything but ASCII space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def let(value: Column, body) -> Column:
    """``body(v)`` with ``value`` evaluated once per row. A lambda that names an outer expression evaluates
    it again for every element, so values used inside another lambda are bound to a lambda variable first."""
    return F.transform(F.array(value), body)[0]


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back, so that a lost executor costs no recomputation."""
    return cut_lineage(df, name=f"llm-{name}")


def release(*frames: DataFrame) -> None:
    """Remove the folders of staged frames that nothing reads any more (what was made from them is staged itself)."""
    for df in frames:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/sluice/llm-" in folder:
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond


def running_sum(df: DataFrame, keys: Sequence[str], chunk: str, order: Sequence, value: str, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows of the same ``keys`` that come earlier in the order
    (``chunk``, then ``order``).

    A window over ``keys`` alone would put a hot key into one task. Here rows are summed by (keys, chunk),
    with partial sums before the shuffle; the sums of the few chunks of a key give each chunk's base; the
    window over the rows themselves only spans one chunk. ``df`` should be a staged or cheap frame: it is
    read twice.
    """
    base, inside = f"_{out}_base", f"_{out}_in"
    parts = df.groupBy(*keys, chunk).agg(F.sum(value).alias("_v"))
    before = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*[F.col(k).alias(f"_p_{k}") for k in keys], F.col(chunk).alias("_p_chunk"),
                         F.coalesce(F.sum("_v").over(before), F.lit(0)).alias(base))
    within = Window.partitionBy(*keys, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn(inside, F.coalesce(F.sum(value).over(within), F.lit(0)))
    cond = F.col(chunk) == F.col("_p_chunk")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_p_{k}"))
    return (rows.join(parts, cond)
            .withColumn(out, F.col(base) + F.col(inside))
            .drop(base, inside, "_p_chunk", *[f"_p_{k}" for k in keys]))


def open_fs(uri: str):
    """(file system, path) for a URI of the shared folder: local, HDFS or an object store."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else "file://" + os.path.abspath(uri))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared folder, as a URI that ``open_fs`` takes."""
    path = staging_path(spark, f"llm-{name}")
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return path if "://" in path else "file://" + os.path.abspath(path)
