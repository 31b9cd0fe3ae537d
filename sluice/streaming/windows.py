"""Success rates over event-time windows of a stream, every window included (MET-1).

Each micro-batch is reduced to one partial state a window (runs, successes, latest start) and stored under the
micro-batch's number; the series is the sum of the states. A micro-batch that runs again replaces its states, so
nothing is counted twice. The event-time mark is the latest start of *earlier* micro-batches less the allowed
lateness, so a replay draws the same line. A window is closed when it ends at or before the mark: rows that come for it
later don't change it but go to a side output, as do rows without a time. Windows still open are in the series too.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sluice.functions.timecols import percent
from sluice.session import staging_path
from sluice.streaming.epochs import EpochStore

LATE, NO_TIME = "late", "no time"


class WindowRates:
    """Windows of ``length`` over run rows (columns ``ts`` and ``status``) of a stream of ``schema``."""

    def __init__(self, spark: SparkSession, schema: StructType, length: str = "1 hour", lateness: str = "10 minutes",
                 ts: str = "started_at", folder: str | None = None):
        self.spark, self.length, self.lateness, self.ts = spark, length, lateness, ts
        self.folder = folder or staging_path(spark, "stream", "window_rates")
        time = schema[ts].dataType.simpleString()
        self.states = EpochStore(spark, f"{self.folder}/states",
                                 f"window_start {time}, window_end {time}, late boolean, runs long, succeeded long, latest {time}")
        side = StructType([*schema.fields, StructField("window_start", schema[ts].dataType), StructField("reason", StringType())])
        self.side = EpochStore(spark, f"{self.folder}/side", side)

    def mark(self, before: int | None = None):
        """The event-time mark after the micro-batches before ``before`` (all by default); None before the first."""
        return self.states.read(before).agg((F.max("latest") - F.expr(f"INTERVAL {self.lateness}")).alias("mark")).first().mark

    def _windowed(self, rows: DataFrame, mark) -> DataFrame:
        w = rows.withColumn("_w", F.window(self.ts, self.length))  # drops rows without a time
        late = F.lit(False) if mark is None else F.col("_w.end") <= F.lit(mark)
        return w.withColumns({"window_start": F.col("_w.start"), "window_end": F.col("_w.end"), "late": late}).drop("_w")

    def merge_batch(self, batch: DataFrame, epoch: int) -> None:
        """What ``foreachBatch`` calls. Running it again for an epoch changes nothing."""
        mark = self.mark(before=epoch)
        states = self._windowed(batch, mark).groupBy("window_start", "window_end", "late").agg(
            F.count(F.lit(1)).alias("runs"), F.count_if(F.col("status") == "success").alias("succeeded"), F.max(self.ts).alias("latest"))
        self.states.put(states, epoch)
        self.states.compact(epoch, lambda rows: rows.groupBy("window_start", "window_end", "late").agg(
            F.sum("runs").alias("runs"), F.sum("succeeded").alias("succeeded"), F.max("latest").alias("latest")))
        no_time = batch.filter(F.col(self.ts).isNull()).withColumns(
            {"window_start": F.lit(None).cast(batch.schema[self.ts].dataType), "reason": F.lit(NO_TIME)})
        late = self._windowed(batch, mark).filter("late").drop("window_end", "late").withColumn("reason", F.lit(LATE))
        self.side.put(late.unionByName(no_time) if mark is not None else no_time, epoch)

    def run(self, runs: DataFrame, checkpoint: str | None = None, on_batch: Callable[[DataFrame, int], None] | None = None) -> None:
        """Process what the streaming frame ``runs`` holds now (``availableNow``), then stop."""
        q = (runs.writeStream.foreachBatch(on_batch or self.merge_batch).outputMode("update")
             .option("checkpointLocation", checkpoint or f"{self.folder}/checkpoint").trigger(availableNow=True).start())
        q.awaitTermination()
        if q.exception():
            raise q.exception()

    def series(self) -> DataFrame:
        """window_start, window_end, runs, succeeded, success_rate, closed: one row a window that has runs."""
        mark = self.mark()
        sums = self.states.read().filter("NOT late").groupBy("window_start", "window_end").agg(
            F.sum("runs").cast("long").alias("runs"), F.sum("succeeded").cast("long").alias("succeeded"))
        closed = F.lit(False) if mark is None else F.col("window_end") <= F.lit(mark)
        return sums.select("window_start", "window_end", "runs", "succeeded",
                           percent(F.col("succeeded"), F.col("runs")).alias("success_rate"), closed.alias("closed"))

    def side_rows(self) -> DataFrame:
        """Rows that changed no window: the run row, its window and the reason."""
        return self.side.read().drop(self.side.column)
