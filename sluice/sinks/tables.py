"""Table writes (SNK-1, SNK-2, SNK-3, SNK-5, OPS-1) and delimited-text export.

Row counts at write time come from ``observe`` on the write itself, so no second pass recounts the data.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from sluice.session import cut_lineage

MODES = ("overwrite", "append", "ignore", "error", "errorifexists")


def _run_sql(spark: SparkSession, statements) -> None:
    if not statements:
        return
    if isinstance(statements, str):
        statements = [s for s in statements.split(";") if s.strip()]
    for stmt in statements:
        spark.sql(stmt)


def write_table(
    df: DataFrame,
    table: str | None = None,
    mode: str = "overwrite",
    fmt: str | None = None,
    options: Mapping[str, str] | None = None,
    path: str | None = None,
    partition_by: Sequence[str] | None = None,
    pre_sql=None,
    post_sql=None,
    bucket_by: tuple[int, Sequence[str]] | None = None,
    verify_count: bool = False,
) -> int:
    """SNK-1/2/5: write ``df`` and return the number of rows written (observed during the write).

    * ``fmt=None`` writes a catalog table (``saveAsTable``); ``path`` makes it an external table there.
    * ``fmt`` given with ``table`` passes it as ``dbtable`` (jdbc and warehouse connectors); with ``path``
      it saves files there.
    * ``pre_sql`` / ``post_sql`` run through ``spark.sql`` before and after; connectors that run their own
      actions get them as ``preactions`` / ``postactions`` options instead.
    * ``bucket_by=(n, cols)`` (catalog tables) hash-buckets and sorts the rows on ``cols``: tables bucketed
      the same way on their join key join later without a shuffle on either side.
    * ``verify_count`` recounts a full overwrite after it lands and raises on a mismatch. For parquet the
      recount is answered from file footers, so it reads no data.
    * ``mode="ignore"`` returns 0 when the catalog table exists; for a ``fmt`` write it returns -1 (the
      count is unknown, because nothing is observed when Spark skips the write).
    """
    if mode not in MODES:
        raise ValueError(f"unknown write mode {mode!r}; expected one of {MODES}")
    spark = df.sparkSession
    if mode == "ignore" and fmt is None and spark.catalog.tableExists(table):
        return 0  # nothing is written, so no observed count would ever arrive
    if fmt is None and mode == "overwrite" and table and _reads_table(df, table):
        # Spark refuses to overwrite a table the same plan reads: stage to the shared folder, then swap
        df = cut_lineage(df, spark, name="overwrite_stage")
    # an "ignore" write to an existing path writes nothing and completes no observation: count unknown (-1)
    observe = not (mode == "ignore" and fmt is not None)
    obs = Observation(f"write_count_{uuid.uuid4().hex}")  # unique: a failed write never completes its own
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows")) if observe else df
    writer = observed.write.mode(mode).options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        if fmt is not None:
            raise ValueError("bucketing needs a catalog table (fmt=None)")
        n, cols = bucket_by
        writer = writer.bucketBy(n, *cols).sortBy(*cols)
    if fmt is None:
        _run_sql(spark, pre_sql)
        if path is None and mode == "overwrite" and spark.catalog.tableExists(table):
            path = table_location(spark, table)  # keep an external table where it is
        if path:
            writer = writer.option("path", path)
        writer.saveAsTable(table)
        _run_sql(spark, post_sql)
    else:
        writer = writer.format(fmt)
        if pre_sql:
            writer = writer.option("preactions", pre_sql if isinstance(pre_sql, str) else ";".join(pre_sql))
        if post_sql:
            writer = writer.option("postactions", post_sql if isinstance(post_sql, str) else ";".join(post_sql))
        if path:
            writer.save(path)
        else:
            writer.option("dbtable", table).save()
    if not observe:
        return -1
    written = int(obs.get.get("rows", 0) or 0)
    if verify_count and mode == "overwrite" and table and fmt is None:
        landed = spark.read.table(table).count()
        if landed != written:
            raise WriteCountMismatch(f"{table}: wrote {written} rows but the table holds {landed}")
    return written


class WriteCountMismatch(RuntimeError):
    pass


def _reads_table(df: DataFrame, table: str) -> bool:
    """Does ``df`` read files of catalog table ``table``? (compares the table's location with the plan's
    input files; False when the table does not exist)."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        return False
    loc = _norm_uri(table_location(spark, table) or "").rstrip("/")
    if not loc:
        return False
    try:
        files = df.inputFiles()
    except Exception:  # noqa: BLE001 - not a file-based plan
        return False
    return any(_norm_uri(f).startswith(loc + "/") for f in files)


def _norm_uri(p: str) -> str:
    """'file:///x' and 'file:/x' name the same local path."""
    return re.sub(r"^file:/+", "file:/", p)


def table_location(spark: SparkSession, table: str) -> str | None:
    """Storage location of a catalog table (from ``DESCRIBE TABLE EXTENDED``)."""
    row = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter(F.col("col_name") == "Location").first()
    return row.data_type if row else None


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str],
    fmt: str = "parquet",
    dynamic: bool = True,
) -> int:
    """OPS-1: files partitioned by ``partition_cols``; with ``dynamic`` an overwrite replaces only the
    partitions present in ``df``.

    Rows are clustered with a ``rebalance`` hint on the partition columns: like a repartition it gives each
    partition value few files, but AQE splits a hot value (say one day holding a third of the rows) over
    several tasks instead of sending it to one.
    """
    clustered = df.hint("rebalance", *partition_cols)
    return write_table(
        clustered,
        mode="overwrite",
        fmt=fmt,
        path=path,
        partition_by=partition_cols,
        options={"partitionOverwriteMode": "dynamic" if dynamic else "static"},
    )


def write_lines(lines: DataFrame, path: str, header: str | None = None, mode: str = "overwrite") -> None:
    """Write pre-formatted text lines (one string column) as ``.csv`` part files, each starting with
    ``header``. Lines are written verbatim: no quoting, no escaping."""
    col = lines.columns[0]
    out = lines.select(F.col(col).alias(header or col))
    (
        out.write.mode(mode)
        .option("header", "true" if header else "false")
        .option("sep", "\u0001")
        .option("quote", "\u0000")
        .option("escapeQuotes", "false")
        .csv(path)
    )


def export_csv(df: DataFrame, path: str, mode: str = "overwrite", sep: str = ",") -> None:
    """Plain CSV export with a header in every part file (Spark's own quoting rules)."""
    df.write.mode(mode).option("header", "true").option("sep", sep).csv(path)
