"""Time arithmetic that works the same on zone-less (``timestamp_ntz``) and session-zone timestamps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def add_seconds(ts, seconds) -> Column:
    """``ts + seconds`` at microsecond precision (seconds may be fractional)."""
    micros = F.round(_c(seconds).cast("double") * F.lit(1_000_000.0)).cast("long")
    return F.timestamp_add("MICROSECOND", micros, _c(ts))


def grid_floor(ts, step: str) -> Column:
    """Start of the ``step``-wide tumbling bucket holding ``ts`` (same buckets as ``F.window``)."""
    return F.window(_c(ts), step).start


def grid_ceil(ts, step: str) -> Column:
    """Smallest grid point >= ts. Spark allows one time-window expression per projection, so use at most one
    ``grid_floor`` / ``grid_ceil`` per ``select``."""
    w = F.window(_c(ts), step)
    return F.when(w.start == _c(ts), w.start).otherwise(w.end)


def percent(part, whole) -> Column:
    """``part * 100 / whole`` in double arithmetic; 0 when ``whole`` is 0 (the empty-table convention)."""
    p = _c(part).cast("double")
    w = _c(whole).cast("double")
    return F.when(w == 0, F.lit(0.0)).otherwise(p * F.lit(100.0) / w)
