"""Category clean-up: trim, empty -> NULL, initcap, HVAC acronym fixes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Acronym corrections applied after initcap (HVAC column only).
HVAC_ACRONYMS = {
    "Central Ac": "Central AC",
    "Split Ac": "Split AC",
    "No Hvac": "No HVAC",
    "Vrf": "VRF",
}


def normalize_category(col: Column | str, null_tokens: tuple[str, ...] = ("",)) -> Column:
    """trim -> tokens (case-insensitive) to NULL -> initcap.

    The default only turns the empty string into NULL, so a literal ``NaN``
    category survives as ``Nan`` exactly like the original pipeline; pass
    ``null_tokens=("", "nan")`` to treat it as missing instead.
    """
    c = F.trim(F.col(col) if isinstance(col, str) else col)
    tokens = [t.lower() for t in null_tokens]
    cond = F.lower(c).isin(tokens) if len(tokens) > 1 else (c == tokens[0])
    return F.initcap(F.when(cond, F.lit(None).cast("string")).otherwise(c))


def fix_acronyms(col: Column | str) -> Column:
    """Acronym map on an already initcapped value (one CASE)."""
    base = F.col(col) if isinstance(col, str) else col
    expr = None
    for wrong, right in HVAC_ACRONYMS.items():
        expr = F.when(base == wrong, F.lit(right)) if expr is None else expr.when(base == wrong, F.lit(right))
    return expr.otherwise(base)


def normalize_hvac(col: Column | str, null_tokens: tuple[str, ...] = ("",)) -> Column:
    """normalize_category followed by the acronym map.

    As one expression the initcap result is repeated in every CASE branch;
    ``operators.cleaning.normalize_categories`` applies the two steps in
    stacked projections so it is computed once per row.
    """
    return fix_acronyms(normalize_category(col, null_tokens))
