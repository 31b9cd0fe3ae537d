"""Facts, dimensions, summaries and published views (GOLD-1 ... GOLD-3). Natural keys throughout."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame

from concurrent.futures import ThreadPoolExecutor

from sluice.operators.silver import enrich, row_count_at_most

MAX_BROADCAST_ROWS = 1_000_000


def _sizes(refs: Sequence[DataFrame], max_rows: int = MAX_BROADCAST_ROWS) -> list[bool]:
    """The bounded size check of every dimension, run as concurrent Spark jobs."""
    if not refs:
        return []
    with ThreadPoolExecutor(max_workers=min(8, len(refs)), thread_name_prefix="dim-size") as pool:
        return list(pool.map(lambda r: row_count_at_most(r, max_rows), refs))


def build_dim(df: DataFrame, key: Sequence[str], cols: Sequence[str],
              lookups: Sequence[tuple[DataFrame, Mapping[str, str], Sequence[str]]] = ()) -> DataFrame:
    """GOLD-1 dimension: one row per natural ``key`` (latest duplicates are the caller's job:
    ``dedup_latest``), widened by lookups ``(ref, {dim col: ref col}, ref cols)`` applied in order, so a
    chain of normalised tables folds into one wide dimension that a fact joins once."""
    out = df.select(*key, *cols)
    for (ref, keys, rcols), small in zip(lookups, _sizes([r for r, _, _ in lookups])):
        out = enrich(out, ref, keys, rcols, ref_small=small)
    return out


def build_fact(df: DataFrame, measures: Mapping[str, Column],
               dims: Sequence[tuple[DataFrame, Mapping[str, str], Sequence[str]]] = (),
               keep: Sequence[str] = ()) -> DataFrame:
    """GOLD-1 fact: ``keep`` columns plus computed ``measures``, joined to dimension attributes.

    Dimension joins go through ``enrich`` (left joins, dimension side unique on its key), so the fact row
    count never changes; small dimensions are broadcast after a bounded size check, large ones shuffle.
    """
    out = df.select(*keep, *[m.alias(n) for n, m in measures.items()])
    for (ref, keys, rcols), small in zip(dims, _sizes([r for r, _, _ in dims])):
        out = enrich(out, ref, keys, rcols, ref_small=small)
    return out


def summarize(df: DataFrame, dims: Sequence[str], measures: Mapping[str, Column], rollup: bool = False) -> DataFrame:
    """GOLD-2: ``measures`` per ``dims``; with ``rollup`` also the subtotals and grand total (NULL dims)."""
    g = df.rollup(*dims) if rollup else df.groupBy(*dims)
    return g.agg(*[m.alias(n) for n, m in measures.items()])


def publish_view(df: DataFrame, name: str, global_view: bool = False) -> str:
    """GOLD-3: expose ``df`` to SQL under ``name``."""
    if global_view:
        df.createOrReplaceGlobalTempView(name)
        return f"global_temp.{name}"
    df.createOrReplaceTempView(name)
    return name
