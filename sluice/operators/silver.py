"""Curation steps after Bronze (SILV-1 ... SILV-4).

These are named, not coded, upstream; the semantics here are ours and documented per function.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sluice.operators.bronze import standardize as _typed
from sluice.specs import TableSpec


def standardize(df: DataFrame, spec: TableSpec, rename: Mapping[str, str] | None = None,
                fill: Mapping[str, object] | None = None) -> DataFrame:
    """SILV-1: spec typing, then renames, then NULL fills — still a single projection after Catalyst."""
    out = _typed(df, spec)
    if rename:
        out = out.select(*[F.col(c).alias(rename.get(c, c)) for c in out.columns])
    if fill:
        out = out.na.fill(dict(fill))
    return out


def apply_rules(df: DataFrame, rules: Mapping[str, str | Column]) -> tuple[DataFrame, DataFrame]:
    """SILV-2: rows passing every rule, and the rest with ``_rejected_by`` naming the first rule they broke.

    A rule is a SQL predicate (or Column) that must be TRUE; NULL counts as broken. One projection computes
    the reason; both outputs filter it, so the rules are evaluated once per row when the input is cached.
    """
    reason = F.lit(None).cast("string")
    for name, rule in reversed(list(rules.items())):
        cond = F.expr(rule) if isinstance(rule, str) else rule
        reason = F.when(~F.coalesce(cond, F.lit(False)), F.lit(name)).otherwise(reason)
    tagged = df.withColumn("_rejected_by", reason)
    kept = tagged.filter(F.col("_rejected_by").isNull()).drop("_rejected_by")
    rejected = tagged.filter(F.col("_rejected_by").isNotNull())
    return kept, rejected


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows; reads at most ``max_rows + 1`` of them."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(ref: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """Broadcast ``ref`` only when a cheap bounded count proves it has at most ``max_rows`` rows.

    Otherwise the frame is returned as is and the join stays a shuffle join (which AQE may still turn into
    a broadcast from runtime sizes).
    """
    return F.broadcast(ref) if row_count_at_most(ref, max_rows) else ref


def keys_unique(df: DataFrame, keys: Sequence[str]) -> bool:
    """Proof that ``keys`` never repeat: a key-only, partial-aggregated count that stops at the first repeat."""
    return df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).count() == 0


def enrich(df: DataFrame, ref: DataFrame, keys: Sequence[str] | Mapping[str, str], cols: Sequence[str],
           fallback: Mapping[str, str] | None = None, max_broadcast_rows: int | None = 1_000_000,
           ref_unique: bool | None = None, ref_small: bool | None = None) -> DataFrame:
    """SILV-3: left lookup join adding ``cols`` from ``ref``; a lookup never multiplies fact rows.

    ``keys`` is a list of shared names or a mapping fact column -> ref column. ``fallback`` maps an added
    column to a fact column used when the lookup misses (``coalesce(english, original)``). ``ref_small``
    passes a size check the caller already ran (``row_count_at_most``).

    Plan choice:
    * a reference proven small (bounded row count) is de-duplicated on its key and broadcast;
    * a large one is joined by shuffle. If its key is unique (``ref_unique=True``, or proven by a key-only
      aggregate when ``None``) it joins as is, so both join inputs are plain shuffles and AQE can split a
      hot fact key over many tasks; only a reference whose keys do repeat is de-duplicated first.
    """
    pairs = dict(keys) if isinstance(keys, Mapping) else {k: k for k in keys}
    knames = [f"__k{i}" for i in range(len(pairs))]
    r = ref.select(*[F.col(rc).alias(k) for k, rc in zip(knames, pairs.values())], *cols)
    if ref_small is None:
        ref_small = max_broadcast_rows is not None and row_count_at_most(r, max_broadcast_rows)
    if ref_small:
        r = F.broadcast(r if ref_unique else r.dropDuplicates(knames))
    else:
        unique = ref_unique if ref_unique is not None else keys_unique(r, knames)
        if not unique:
            r = r.dropDuplicates(knames)
    cond = [df[fc] == r[k] for fc, k in zip(pairs, knames)]
    out = df.join(r, cond, "left").drop(*knames)
    for c, fb in (fallback or {}).items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.col(fb)))
    return out


def dedup_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """SILV-4: keep the latest row per key: the greatest ``order_by`` tuple wins (list a unique column last
    to break ties deterministically).

    Written as ``max_by`` over a struct instead of ``row_number()`` over a window: the aggregate is
    partial (each task keeps one row per key before the shuffle), so a key holding a third of the data
    does not land in one task.
    """
    others = [c for c in df.columns if c not in keys]
    order = F.struct(*[F.col(c) for c in order_by])
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in others]), order).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others]).select(*df.columns)


def drop_exact_duplicates(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Exact-copy removal on ``cols`` (all columns by default)."""
    return df.dropDuplicates(list(cols) if cols else None)
