"""Text standardisation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def upper_trim(col) -> Column:
    """``upper(trim(c))``: only spaces are trimmed (tabs stay), accents are kept."""
    c = F.col(col) if isinstance(col, str) else col
    return F.upper(F.trim(c))
