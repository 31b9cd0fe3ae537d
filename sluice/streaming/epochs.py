"""State kept as rows per micro-batch, so that a replayed micro-batch replaces its own.

``foreachBatch`` may run a micro-batch again after a failure, with the same number and the same rows. Everything a
micro-batch adds is therefore a folder ``<column>=<number>`` that is written whole; state is the union of the folders
of earlier micro-batches. ``compact`` merges the folders of finished micro-batches into one, so that what is read does
not grow with their number.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

#: Micro-batches whose folders are merged at a time.
COMPACT_EVERY = 64


class EpochStore:
    """Rows of ``schema`` per micro-batch under ``path``."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType | str, column: str = "epoch"):
        self.spark, self.path, self.column = spark, path.rstrip("/"), column
        self.rows = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.schema = StructType([*self.rows.fields, StructField(column, LongType())])
        for folder in (self.path, self._merged):  # an empty epoch -1: the folders exist, and a read error is an error
            self._write(spark.createDataFrame([], self.rows), folder, -1)

    @property
    def _merged(self) -> str:
        return f"{self.path}_merged"

    def _write(self, df: DataFrame, folder: str, epoch: int) -> None:
        df.write.mode("overwrite").parquet(f"{folder}/{self.column}={epoch}")

    def _read(self, folder: str) -> DataFrame:
        return self.spark.read.schema(self.schema).option("basePath", folder).parquet(folder)

    def put(self, df: DataFrame, epoch: int) -> None:
        """The rows of micro-batch ``epoch``, in place of those it wrote before."""
        self._write(df.select(*[F.col(f"`{f.name}`") for f in self.rows.fields]), self.path, epoch)

    def _last_merged(self) -> int:
        found = self._read(self._merged).agg(F.max(self.column).alias("n")).first().n
        return -1 if found is None else found

    def read(self, before: int | None = None) -> DataFrame:
        """Rows of all micro-batches, or of those before ``before``."""
        last = self._last_merged()
        out = self._read(self.path).filter(F.col(self.column) > last)
        if before is not None:
            out = out.filter(F.col(self.column) < before)
        return out if last < 0 else self._read(self._merged).filter(F.col(self.column) == last).unionByName(out)

    def compact(self, epoch: int, merge: Callable[[DataFrame], DataFrame], every: int = COMPACT_EVERY) -> None:
        """Every ``every`` micro-batches, merge the rows of those before ``epoch`` (which are finished and never run
        again). ``merge`` may combine rows; the folders it read are skipped from then on."""
        if epoch and epoch % every == 0:
            rows = merge(self.read(before=epoch)).select(*[F.col(f"`{f.name}`") for f in self.rows.fields])
            self._write(rows, self._merged, epoch - 1)


def digest(columns: Sequence[str]):
    """128 bits that stand for a key: NULL is a value of its own, and ('a', 'b') differs from ('ab', NULL)."""
    key = F.to_json(F.struct(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(columns)]), {"ignoreNullFields": "false"})
    return F.unhex(F.substring(F.sha2(key, 256), 1, 32))


class KeyState:
    """The keys of all accepted micro-batches, as digests of 16 bytes (AGG-4 over a stream)."""

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str]):
        self.key = list(key)
        self.store = EpochStore(spark, path, "digest binary")

    def _digests(self, batch: DataFrame) -> DataFrame:
        return batch.select(digest(self.key).alias("digest")).distinct()

    def known(self, batch: DataFrame, epoch: int) -> int:
        """How many different keys of ``batch`` came in an earlier accepted micro-batch. The join is an inner one, so
        the micro-batch's digests are broadcast if Spark finds them small, and the history isn't shuffled then."""
        return self.store.read(before=epoch).select("digest").join(self._digests(batch), "digest").count()

    def accept(self, batch: DataFrame, epoch: int) -> None:
        self.store.put(self._digests(batch), epoch)
        self.store.compact(epoch, lambda rows: rows)
