"""Column-level helpers: every function returns a ``Column`` built from Spark built-ins (JVM-side, codegen)."""

from sluice.functions.casts import try_cast_to, legacy_int
from sluice.functions.fingerprint import record_hash
from sluice.functions.text import upper_trim
from sluice.functions.masking import mask_value, pseudonym, keep_last, redact
from sluice.functions.timecols import add_seconds, grid_floor, grid_ceil, percent

__all__ = [
    "try_cast_to",
    "legacy_int",
    "record_hash",
    "upper_trim",
    "mask_value",
    "pseudonym",
    "keep_last",
    "redact",
    "add_seconds",
    "grid_floor",
    "grid_ceil",
    "percent",
]
