"""Date and timestamp column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted input layouts, tried in this order (first match wins).
TIMESTAMP_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd HH:mm",
    "MM/dd/yyyy HH:mm",
    "yyyy-MM-dd'T'HH:mm:ss'Z'",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd",
)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c, formats=TIMESTAMP_FORMATS) -> Column:
    """multi-format parse; unparseable -> null (never raises under ANSI)."""
    col = F.trim(_c(c).cast("string"))
    tries = [F.try_to_timestamp(col, F.lit(f)) for f in formats]
    return F.coalesce(*tries).cast("timestamp_ntz")


def weekday(c) -> Column:
    """Monday = 0 ... Sunday = 6 (``dayofweek`` would give Sunday = 1)."""
    return F.weekday(_c(c))


def date_parts(c, prefix: str) -> dict:
    """the date, hour, weekday and month derived from one timestamp."""
    col = _c(c)
    return {
        f"{prefix}_date": F.to_date(col),
        f"{prefix}_hour": F.hour(col),
        f"{prefix}_day_of_week": weekday(col),
        f"{prefix}_month": F.month(col),
    }


def month_key(c) -> Column:
    """``YYYY-MM``."""
    return F.date_format(_c(c), "yyyy-MM")


def age_at(birth, event) -> Column:
    """year difference minus one when the event month is before the birth month.

    The day of month is ignored, as in the reference.
    """
    b, e = _c(birth), _c(event)
    return (F.year(e) - F.year(b) - (F.month(e) < F.month(b)).cast("int")).cast("int")


def is_peak_hour(c, start: int = 9, end: int = 13) -> Column:
    """Hour within [start, end] inclusive."""
    h = F.hour(_c(c))
    return h.between(start, end)
