"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_MILLIS_ZONE = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"

# ISO-8601 date / date-time as the creation date may be written:
# year, year-month, date, date-time with optional fraction and offset.
_ISO_DATE = (
    r"^\d{4}(-\d{2}(-\d{2}(T\d{2}(:[0-5]\d(:[0-5]\d(\.\d{1,9})?)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?)?)?$"
)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_timestamp(ts) -> Column:
    """ISO text with milliseconds and zone (session zone is UTC)."""
    return F.date_format(_c(ts), ISO_MILLIS_ZONE)


def created_year(text) -> Column:
    """year of an ISO date text, null when the text is not a valid date.

    The year is read from the text itself, so a date-time with an offset keeps
    the year of that offset.  Validity: the ISO shape, and a real calendar date
    for the date part (month 1-12, day within the month), hours to 23, minutes
    and seconds to 59.  Week and ordinal dates and one-digit parts are not accepted.
    """
    t = _c(text)
    date_part = F.regexp_extract(t, r"^(\d{4}(-\d{2}(-\d{2})?)?)", 1)
    padded = F.when(F.length(date_part) == 4, F.concat(date_part, F.lit("-01-01"))).when(
        F.length(date_part) == 7, F.concat(date_part, F.lit("-01"))
    ).otherwise(date_part)
    hour_ok = F.coalesce(F.regexp_extract(t, r"T(\d{2})", 1).try_cast("int") < 24, F.lit(True))
    valid = t.rlike(_ISO_DATE) & F.try_to_timestamp(padded, F.lit("yyyy-MM-dd")).isNotNull() & hour_ok
    return F.when(valid, F.substring(t, 1, 4).cast("int"))
