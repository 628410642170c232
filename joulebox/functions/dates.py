"""Date helpers: parsing, yyyyMMdd keys, calendar parts, hashed day offsets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_date(col: Column | str, fmt: str = "yyyy-MM-dd") -> Column:
    """Parse a date string; malformed text gives NULL (no ANSI failure)."""
    return F.try_to_date(_c(col), fmt)


def date_key(col: Column | str) -> Column:
    """yyyyMMdd as int."""
    return F.date_format(_c(col), "yyyyMMdd").cast("int")


def date_parts(col: Column | str) -> list[Column]:
    """Calendar attributes of a date column (1 = Sunday for day_of_week)."""
    d = _c(col)
    return [
        date_key(d).alias("date_key"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofweek(d).alias("day_of_week"),
        F.weekofyear(d).alias("week_of_year"),
        F.quarter(d).alias("quarter"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
    ]


def md5_bucket(key: Column | str, buckets: int) -> Column:
    """Stable bucket in [0, buckets) from the first 7 hex digits of md5(key)."""
    h = F.conv(F.substring(F.md5(_c(key).cast("string")), 1, 7), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(buckets))
