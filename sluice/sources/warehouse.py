"""Table and query scans through Spark's catalog or any data source (SRC-5 ... SRC-8, OPS-6).

The format is a parameter: ``None`` means the session catalog; anything else (``jdbc``, a warehouse
connector, ``parquet`` ...) goes through ``spark.read.format(fmt)`` with the given options.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)


class MissingSettingsError(ValueError):
    pass


def connection_options(
    settings: Mapping[str, str],
    required: Sequence[str],
    rename: Mapping[str, str] | None = None,
    defaults: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """SRC-7: settings -> reader/writer options. Every missing required key is listed in one error.

    ``rename`` maps a setting name to the option name the data source expects; ``defaults`` fills optional
    keys (for example a role of ``PUBLIC``).
    """
    missing = [k for k in required if not settings.get(k)]
    if missing:
        raise MissingSettingsError(f"Missing required connection settings: {missing}")
    merged = {**(defaults or {}), **{k: v for k, v in settings.items() if v not in (None, "")}}
    rename = rename or {}
    return {rename.get(k, k): str(v) for k, v in merged.items()}


def read_table(
    spark: SparkSession, name: str, fmt: str | None = None, options: Mapping[str, str] | None = None
) -> DataFrame:
    """SRC-5: a table by name, from the catalog or through a data source's ``dbtable`` option."""
    if fmt is None:
        return spark.read.table(name)
    return spark.read.format(fmt).options(**(options or {})).option("dbtable", name).load()


def execute_query(
    spark: SparkSession, sql: str, fmt: str | None = None, options: Mapping[str, str] | None = None
) -> DataFrame:
    """SRC-6: a SQL string as a DataFrame; run by Spark, or pushed to the source through its ``query`` option."""
    if fmt is None:
        return spark.sql(sql)
    return spark.read.format(fmt).options(**(options or {})).option("query", sql).load()


def read_jdbc(spark: SparkSession, url: str, table: str, options: Mapping[str, str] | None = None,
              partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """OPS-6: a database table read in parallel slices when a numeric partition column is given."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**(options or {}))
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", str(lower))
             .option("upperBound", str(upper)).option("numPartitions", str(num_partitions or 8)))
    return r.load()


def table_exists(spark: SparkSession, name: str, default_db: str | None = None) -> bool:
    """SRC-8: ``db.table`` split on the first dot; case-insensitive; any error gives False."""
    try:
        if "." in name:
            db, table = name.split(".", 1)
        else:
            db, table = default_db, name
        return bool(spark.catalog.tableExists(f"{db}.{table}" if db else table))
    except Exception as exc:  # noqa: BLE001 - existence checks never raise
        log.warning("table existence check failed for %s: %s", name, exc)
        return False
