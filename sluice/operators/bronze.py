"""Bronze projections: metadata enrichment, fingerprint and spec-driven typing (PRJ-1 ... PRJ-10).

Everything is one ``select`` so Catalyst keeps it inside a single whole-stage-codegen span.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sluice.functions.casts import try_cast_to
from sluice.functions.fingerprint import record_hash
from sluice.functions.text import upper_trim
from sluice.specs import TableSpec

METADATA_COLUMNS = ("_ingestion_timestamp", "_source_file", "_processing_date", "_batch_id", "_record_hash")


def batch_id_for(as_of: dt.datetime) -> str:
    """Batch id text ``yyyyMMdd_HHmmss``."""
    return as_of.strftime("%Y%m%d_%H%M%S")


def metadata_columns(
    table_name: str,
    hash_cols: Sequence[str],
    as_of: dt.datetime | None = None,
    batch_id: str | None = None,
) -> list[Column]:
    """PRJ-1 + PRJ-2: the five Bronze metadata columns.

    ``as_of`` fixes the clock (tests, reruns); without it the session clock is used, read once per query.
    ``_source_file`` carries the *table name*; the file path is ``with_lineage``'s job.
    """
    if as_of is None:
        ts = F.current_timestamp()
        day = F.current_date()
        bid = F.lit(batch_id) if batch_id else F.date_format(ts, "yyyyMMdd_HHmmss")
    else:
        ts = F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")
        day = F.lit(as_of.date())
        bid = F.lit(batch_id or batch_id_for(as_of))
    return [
        ts.alias("_ingestion_timestamp"),
        F.lit(table_name).alias("_source_file"),
        day.alias("_processing_date"),
        bid.alias("_batch_id"),
        record_hash(hash_cols).alias("_record_hash"),
    ]


def typed_columns(df: DataFrame, spec: TableSpec) -> list[Column]:
    """PRJ-4 ... PRJ-9: each column standardised / typed per ``spec`` (others unchanged, order kept)."""
    out = []
    for c in df.columns:
        col = F.col(c)
        if c in spec.upper_trim:
            col = upper_trim(col)
        if c in spec.casts:
            col = try_cast_to(col, spec.casts[c])
        out.append(col.alias(c))
    return out


def bronze_transform(
    df: DataFrame,
    spec: TableSpec,
    as_of: dt.datetime | None = None,
    batch_id: str | None = None,
) -> DataFrame:
    """Raw (all-string) rows -> Bronze rows: typed business columns plus metadata, in one projection.

    The fingerprint is taken over the *raw* values, before typing (so ' sp' and 'SP' hash differently).
    Tables without a registered spec pass through untyped.
    """
    raw_cols = df.columns
    return df.select(*typed_columns(df, spec), *metadata_columns(spec.name, raw_cols, as_of, batch_id))


def standardize(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Typing and text standardisation only (no metadata)."""
    return df.select(*typed_columns(df, spec))
