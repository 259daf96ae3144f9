"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.util import as_col

# The feed formats (Spark datetime patterns).
EXTERNAL_DATE_FORMAT = "M/d/yyyy"            # external book feed publication date
CHECKOUT_DATETIME_FORMAT = "MM/dd/yyyy h:m:s a"  # checkout feed, 12-hour clock
INVENTORY_REPORT_FORMAT = "MM/dd/yyyy hh:mm:ss a"
ISO_DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def parse_timestamp(c, fmt: str) -> Column:
    """F10. Lenient parse: malformed text gives NULL instead of failing the job
    (ANSI mode would raise).  Result is a zone-less timestamp."""
    return F.try_to_timestamp(as_col(c), F.lit(fmt)).cast("timestamp_ntz")


def epoch_seconds_to_ts(c) -> Column:
    """F11. Epoch seconds (number or numeric text) -> timestamp_ntz, without a
    round trip through the session time zone."""
    secs = as_col(c).try_cast("long")
    return F.timestamp_add("SECOND", secs, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def time_parts(c) -> list[Column]:
    """F9. hour, day, week (ISO), weekday (1 = Sunday), month, year."""
    c = as_col(c)
    return [
        F.hour(c).alias("hour"),
        F.dayofmonth(c).alias("day"),
        F.weekofyear(c).alias("week"),
        F.dayofweek(c).alias("weekday"),
        F.month(c).alias("month"),
        F.year(c).alias("year"),
    ]
