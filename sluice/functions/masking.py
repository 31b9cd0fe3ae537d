"""Masking of sensitive values, all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def mask_value(col) -> Column:
    """Upper-case letters (of any script) -> 'X', lower-case -> 'x', digits -> 'n'; everything else kept."""
    return F.mask(_c(col).cast("string"))


def pseudonym(col, salt: str = "") -> Column:
    """A stable sha-256 pseudonym (joinable across tables masked with the same salt)."""
    return F.sha2(F.concat(F.lit(salt), _c(col).cast("string")), 256)


def keep_last(col, n: int = 4, fill: str = "*") -> Column:
    """Keep the last ``n`` characters, replace the rest with ``fill``; a value of up to ``n`` characters is
    replaced as a whole."""
    c = _c(col).cast("string")
    masked = F.concat(F.repeat(F.lit(fill), F.greatest(F.length(c) - n, F.lit(0))), F.substring(c, -n, n))
    return F.when(F.length(c) <= n, F.repeat(F.lit(fill), F.length(c))).otherwise(masked)


def redact(col, text: str = "****") -> Column:
    """Replace every non-NULL value with a fixed text."""
    return F.when(_c(col).isNull(), F.lit(None).cast("string")).otherwise(F.lit(text))
