"""Lookups that stand hot keys and repeated reference keys (SILV-3, GOLD-1).

A left join deals fact rows by their key, so a key of a third of the rows is one task's work. Here the heavy keys are
found first (a key-only aggregate with partial sums; by definition at most as many as there are shuffle partitions),
their fact rows are dealt over several salts, and only their reference rows are copied to each salt. Whether the
reference is broadcast is left to Spark, which knows its size in bytes.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql import types as T


def heavy_keys(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """(keys..., _splits): keys with more rows than an even share, rows / partitions, and over how many salts to deal them
    so that none holds more than that share. NULL is a key too. At most ``partitions`` rows, told by the driver."""
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    obs = Observation()
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).observe(obs, F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"))
    top = counts.orderBy(F.col("_n").desc()).limit(parts).collect()
    share = max(obs.get["rows"] / parts, 1.0)
    rows = [(*[r[k] for k in keys], math.ceil(r["_n"] / share)) for r in top if r["_n"] > share]
    return spark.createDataFrame(rows, T.StructType([*[df.schema[k] for k in keys], T.StructField("_splits", T.IntegerType())]))


def latest_by_key(reference: DataFrame, keys: Sequence[str], columns: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row a key: that of the greatest ``order_by`` tuple, ties by the greatest ``columns``."""
    order = F.struct(*[F.col(c) for c in [*order_by, *columns]])
    picked = reference.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in columns]), order).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in columns])


def lookup(facts: DataFrame, reference: DataFrame, keys: Mapping[str, str], columns: Sequence[str], order_by: Sequence[str],
           fallback: Mapping[str, Column | str] | None = None, found: str = "found", partitions: int | None = None) -> DataFrame:
    """Every row of ``facts`` once, with ``columns`` of its reference row and ``found``.

    ``keys`` maps fact columns to reference columns. Repeated reference keys are settled by ``order_by``. ``fallback``
    gives a column's value where the lookup misses: a fact column's name or an expression over facts. A NULL key never
    matches. ``columns`` and ``found`` must not be fact columns.
    """
    clash = {*columns, found} & set(facts.columns)
    if clash:
        raise ValueError(f"columns of the facts would be hidden: {sorted(clash)}")
    own, other = list(keys), [f"_r{i}" for i in range(len(keys))]
    heavy = heavy_keys(facts, own, partitions).select(*[F.col(k).alias(f"_h{i}") for i, k in enumerate(own)], "_splits")
    heavy = F.broadcast(heavy)  # as many rows as shuffle partitions at most

    def split(df: DataFrame, by: Sequence[str]) -> DataFrame:
        cond = F.lit(True)
        for i, k in enumerate(by):
            cond = cond & F.col(k).eqNullSafe(F.col(f"_h{i}"))
        return df.join(heavy, cond, "left").drop(*[f"_h{i}" for i in range(len(by))])

    # the salt depends on the row's values and its partition alone, so a task that runs again deals its rows alike
    deal = F.pmod(F.xxhash64(*[F.col(c) for c in facts.columns], F.spark_partition_id()), F.coalesce(F.col("_splits"), F.lit(1)))
    dealt = split(facts, own).withColumn("_salt", F.when(F.col("_splits").isNotNull(), deal).otherwise(F.lit(0)).cast("int")).drop("_splits")
    one = latest_by_key(reference, list(keys.values()), columns, order_by)
    one = one.select(*[F.col(c).alias(o) for c, o in zip(keys.values(), other, strict=True)], *columns, F.lit(True).alias("_found"))
    salts = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_splits"), F.lit(1)) - 1))
    copies = split(one, other).withColumn("_copy", salts).drop("_splits")
    cond = F.col("_salt") == F.col("_copy")
    for k, o in zip(own, other, strict=True):
        cond = cond & (F.col(k) == F.col(o))
    out = dealt.join(copies, cond, "left")
    hit = F.coalesce(F.col("_found"), F.lit(False))
    value = {c: F.col(c) for c in columns}
    for c, instead in (fallback or {}).items():
        value[c] = F.when(hit, F.col(c)).otherwise(F.col(instead) if isinstance(instead, str) else instead)
    return out.select(*facts.columns, *[value[c].alias(c) for c in columns], hit.alias(found))
