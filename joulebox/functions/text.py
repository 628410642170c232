"""Formatted identifiers and report messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Identifier formats of the batch splitter.
RECORD_ID_FORMAT = "REC-%06d"
BATCH_ID_FORMAT = "POWER-BATCH-%04d"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def record_id(index: Column | str) -> Column:
    return F.format_string(RECORD_ID_FORMAT, _c(index))


def batch_id(batch_number: Column | str) -> Column:
    return F.format_string(BATCH_ID_FORMAT, _c(batch_number))


def deviation_message(deviation: Column | str) -> Column:
    """'Energy consumption is 12.3% higher|lower than predicted' (1 decimal).

    The magnitude is rounded half-up on its decimal text before formatting so
    the text does not depend on a formatter's binary tie rule.
    """
    d = _c(deviation)
    direction = F.when(d > 0, F.lit("higher")).otherwise(F.lit("lower"))
    shown = F.round(F.abs(d), 1)
    return F.format_string("Energy consumption is %.1f%% %s than predicted", shown, direction)
