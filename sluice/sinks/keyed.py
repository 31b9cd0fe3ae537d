"""Tables kept up to date run by run: the latest row per key, and appends that count once.

``KeyedTable`` (SILV-4 against an existing table): rows lie in hash buckets of their key, one partition folder each. An
upsert reads and rewrites only the buckets that its rows touch. The latest row per key wins, whatever the order of
the upserts, so one that is run again changes nothing.

``append_run`` (SNK-1, SNK-2): the rows of a run are a partition of their own, and registering the partition in the
catalog is the commit: one change, before which readers see nothing of the run.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from sluice.operators.silver import dedup_latest
from sluice.session import cut_lineage
from sluice.sinks.publish import quoted

BUCKET = "_bucket"


class KeyedTable:
    """Files under ``path`` holding the latest row per ``key`` by the greatest ``order_by`` tuple (end it with a unique
    column, or ties are settled by chance). ``buckets`` is fixed for the table's life; a bucket should fit a few tasks."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: Sequence[str], order_by: Sequence[str], buckets: int = 64):
        self.spark, self.key, self.order_by, self.buckets = spark, list(key), list(order_by), buckets
        self.rows = schema
        self.path = f"{path.rstrip('/')}/buckets-{buckets}"
        self.schema = StructType([*schema.fields, StructField(BUCKET, IntegerType())])
        spark.createDataFrame([], self.schema).write.mode("append").partitionBy(BUCKET).parquet(self.path)  # the folder exists

    def _stored(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def read(self) -> DataFrame:
        return self._stored().drop(BUCKET)

    def upsert(self, df: DataFrame) -> list[int]:
        """Merge ``df`` (the table's columns) into the table; returns the buckets that were rewritten.

        The batch is reduced to one row a key before it meets the table. Merged buckets are staged before the old ones
        are replaced, because Spark can't overwrite files it reads; a failure in between leaves the table as it was or
        some buckets merged, and running the upsert again completes it.
        """
        bucket = F.pmod(F.xxhash64(*[F.col(k) for k in self.key]), F.lit(self.buckets)).cast("int")
        batch = dedup_latest(df.select(*self.rows.names), self.key, self.order_by).withColumn(BUCKET, bucket)
        batch = cut_lineage(batch, self.spark, name="upsert")
        touched = sorted(r[0] for r in batch.select(BUCKET).distinct().collect())  # at most ``buckets`` numbers
        if not touched:
            return []
        old = self._stored().filter(F.col(BUCKET).isin(touched))  # a partition filter: other folders aren't read
        merged = dedup_latest(old.unionByName(batch), [*self.key, BUCKET], self.order_by)
        merged = cut_lineage(merged, self.spark, name="upsert")
        (merged.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BUCKET).parquet(self.path))
        return touched


class PostActionError(RuntimeError):
    pass


@dataclass(frozen=True)
class Appended:
    table: str
    run_id: str
    rows: int | None  # None: appended before, not counted again
    replayed: bool


RUN = "run_id"


def _execute(spark: SparkSession, statements: str | Sequence[str] | None) -> None:
    """Run statements to their end (a SELECT is lazy otherwise); its rows go nowhere."""
    for stmt in [statements] if isinstance(statements, str) else statements or []:
        spark.sql(stmt).write.format("noop").mode("overwrite").save()


def committed(spark: SparkSession, table: str, run_id: str) -> bool:
    """Is the run's partition registered?"""
    return spark.sql(f"SHOW PARTITIONS {quoted(table)} PARTITION ({RUN} = '{run_id}')").limit(1).count() > 0


def append_run(df: DataFrame, table: str, run_id: str, path: str, pre_sql=None, post_sql=None) -> Appended:
    """Append the rows of run ``run_id`` to ``table`` (created under ``path`` when missing), once.

    1. a run whose partition is registered is done: nothing is run or written;
    2. ``pre_sql``; the rows are written to the run's own folder, in place of what an earlier attempt left there;
    3. the partition is registered: readers see all rows of the run;
    4. ``post_sql``; if it fails, the partition is taken out again and ``PostActionError`` raised.

    ``run_id`` may hold letters, digits, '-', '_' and '.'.
    """
    spark = df.sparkSession
    if not run_id or not all(ch.isalnum() or ch in "-_." for ch in run_id):
        raise ValueError(f"not a run id: {run_id!r}")
    if RUN in df.columns:
        raise ValueError(f"the rows have a column {RUN} already")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted(table)} ({columns}, {RUN} STRING) USING parquet PARTITIONED BY ({RUN}) LOCATION '{path}'")
    if committed(spark, table, run_id):
        return Appended(table, run_id, None, True)
    _execute(spark, pre_sql)
    obs = Observation()
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{RUN}={run_id}")
    spark.sql(f"ALTER TABLE {quoted(table)} ADD PARTITION ({RUN} = '{run_id}')")
    try:
        _execute(spark, post_sql)
    except Exception as exc:
        spark.sql(f"ALTER TABLE {quoted(table)} DROP PARTITION ({RUN} = '{run_id}')")
        raise PostActionError(f"{table}, run {run_id}: the action after the append failed, the append was taken back") from exc
    return Appended(table, run_id, int(obs.get["rows"]), False)
