"""Write, audit, publish: a table whose readers never see rows that failed a check.

A published table is a catalog view over one *version*, an ordinary table of its own:

* ``write``: the rows of a run become the version ``<table>__v_<run id>``. Readers don't see it;
* ``audit``: checks read the version as written. A failed check leaves the view, and so the rows that readers
  see, as they were;
* ``publish``: one catalog change points the view at the new version. Queries that began on the old version finish on
  it, because its files stay until ``keep`` newer versions were published.

The view's properties are the ledger: run id, row count and the versions still kept. A run that is replayed finds its own
run id there and changes nothing; one that died between write and publish writes its version anew. A table has
one writer at a time: catalogs have no compare-and-swap.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluice.sinks.tables import table_location, write_table

RUN, ROWS, KEPT = "sluice.run_id", "sluice.rows", "sluice.versions"


@dataclass(frozen=True)
class Published:
    table: str
    run_id: str
    rows: int
    replayed: bool  # True: this run had been published before, nothing was written


def quoted(table: str) -> str:
    """'db.my-table' -> '`db`.`my-table`'."""
    return ".".join(f"`{part.replace('`', '``')}`" for part in table.split("."))


def version_name(table: str, run_id: str) -> str:
    return f"{table}__v_{re.sub(r'[^0-9A-Za-z]', '_', run_id)}".lower()


def ledger(spark: SparkSession, table: str) -> dict[str, str]:
    """What the pointer says: empty if the table was never published."""
    if not spark.catalog.tableExists(quoted(table)):
        return {}
    rows = spark.sql(f"SHOW TBLPROPERTIES {quoted(table)}").collect()  # a handful of properties
    return {r.key: r.value for r in rows if r.key.startswith("sluice.")}


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def point_at(spark: SparkSession, table: str, version: str, run_id: str, rows: int, kept: Sequence[str]) -> None:
    """The one change that readers see."""
    props = {RUN: run_id, ROWS: str(rows), KEPT: ",".join(kept)}
    listed = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in props.items())
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(table)} TBLPROPERTIES ({listed}) AS SELECT * FROM {quoted(version)}")


def drop_version(spark: SparkSession, version: str) -> None:
    """Remove a version and its files (an external table's files stay when it is dropped, so they go by emptying it)."""
    if not spark.catalog.tableExists(quoted(version)):
        return
    empty = spark.createDataFrame([], spark.read.table(quoted(version)).schema)
    write_table(empty, quoted(version), path=table_location(spark, quoted(version)), options={"partitionOverwriteMode": "static"})
    spark.sql(f"DROP TABLE {quoted(version)}")


def write_audit_publish(
    df: DataFrame,
    table: str,
    run_id: str,
    audit: Callable[[DataFrame], None],
    path: str,
    partition_by: Sequence[str] | None = None,
    keep: int = 2,
    on_stage: Callable[[str], None] = lambda stage: None,
) -> Published:
    """Write ``df`` as a version under ``path``, run ``audit`` on it (which raises to block) and publish it.

    ``table`` is ``database.name``. ``on_stage`` hears of each stage before it begins: write, validate, publish. A
    blocked version is dropped. ``keep`` versions are kept, the published one included.
    """
    spark = df.sparkSession
    before = ledger(spark, table)
    if before.get(RUN) == run_id:
        return Published(table, run_id, int(before[ROWS]), True)
    if spark.catalog.tableExists(quoted(table)) and not before:
        raise ValueError(f"{table} exists and is no published table")
    version = version_name(table, run_id)
    on_stage("write")
    rows = write_table(df, quoted(version), mode="overwrite", path=f"{path.rstrip('/')}/{version.split('.')[-1]}",
                       partition_by=partition_by, verify_count=True)
    on_stage("validate")
    try:
        audit(spark.read.table(quoted(version)))
    except Exception:
        drop_version(spark, version)
        raise
    on_stage("publish")
    kept = [version, *[v for v in before.get(KEPT, "").split(",") if v and v != version]]
    point_at(spark, table, version, run_id, rows, kept[:keep])
    for old in kept[keep:]:
        drop_version(spark, old)
    return Published(table, run_id, rows, False)


def roll_back(spark: SparkSession, table: str) -> str:
    """Point the table at the version before the published one; returns that version's name."""
    kept = [v for v in ledger(spark, table).get(KEPT, "").split(",") if v]
    if len(kept) < 2:
        raise ValueError(f"{table} keeps no earlier version")
    version = kept[1]
    rows = spark.read.table(quoted(version)).agg(F.count(F.lit(1)).alias("n")).first().n
    point_at(spark, table, version, f"rollback:{version.split('__v_')[-1]}", int(rows), kept[1:])
    return version
