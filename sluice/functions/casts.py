"""Typing of raw strings. Every cast is a *try* cast: under ANSI mode a bad value becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def legacy_int(col) -> Column:
    """String to int with pre-ANSI truncation: '8.7' -> 8, '-8.7' -> -8, 'x' -> NULL."""
    return _c(col).try_cast("decimal(38,20)").try_cast("int")


def try_cast_to(col, target: str) -> Column:
    """Cast a string column to ``target`` returning NULL for unparsable input.

    timestamp      -> session-zone timestamp ('2017-10-18 10:00:00'; date-only strings give midnight)
    timestamp_ntz  -> zone-less timestamp
    date           -> date; a trailing time part is ignored ('2017-10-18 00:00:00' -> 2017-10-18)
    legacy_int     -> int with truncation of a fractional part
    anything else  -> ``try_cast`` to that Spark SQL type (double, int, bigint, decimal(p,s) HALF_UP ...)
    """
    c = _c(col)
    t = target.strip().lower()
    if t == "timestamp":
        return F.try_to_timestamp(c)
    if t == "legacy_int":
        return legacy_int(c)
    return c.try_cast(t)
