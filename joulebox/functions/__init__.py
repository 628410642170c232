"""Column -> Column helpers; all are Catalyst expressions (no Python UDFs)."""

from joulebox.functions.categories import HVAC_ACRONYMS, fix_acronyms, normalize_category, normalize_hvac
from joulebox.functions.dates import date_key, date_parts, parse_date
from joulebox.functions.numeric import (
    clamp_health_score,
    floor_int,
    nonfinite_to_null,
    safe_divide,
)
from joulebox.functions.text import batch_id, deviation_message, record_id

__all__ = [
    "HVAC_ACRONYMS",
    "fix_acronyms",
    "normalize_category",
    "normalize_hvac",
    "date_key",
    "date_parts",
    "parse_date",
    "clamp_health_score",
    "floor_int",
    "nonfinite_to_null",
    "safe_divide",
    "batch_id",
    "deviation_message",
    "record_id",
]
