"""Times of actions: lenient parsing and the text forms used in results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats of input and output times. A single ``H`` reads one or two digits,
# because hours arrive unpadded.
PARSE_FORMAT = "yyyy-MM-dd H:mm:ss"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DAY_HOUR_FORMAT = "yyyy-MM-dd_HH"


# Six whole numbers, blanks before each, then any text. Six digits keep every carry within range.
_FIELD = "[ \\t]*(-?[0-9]{1,6})"
FIELDS = f"^{_FIELD}-{_FIELD}-{_FIELD} {_FIELD}:{_FIELD}:{_FIELD}"


def parse_fields(text: Column) -> Column:
    """Text to timestamp field by field: one digit is enough, what follows the seconds is ignored, and a
    field beyond its range carries into the next (``24:00:05`` is five seconds into the next day, month 13
    the next January, day 0 the last of the month before). Null for other text, fields of more than six
    digits, and results outside the years 1 to 9999.
    """
    def field(n: int) -> Column:
        return F.regexp_extract(text, FIELDS, n).try_cast("bigint")

    months = field(1) * 12 + field(2) - 1
    first = F.make_date(F.floor(months / 12).cast("int"), (F.pmod(months, F.lit(12)) + 1).cast("int"), F.lit(1))
    seconds = (F.unix_date(first) + field(3) - 1) * 86400 + field(4) * 3600 + field(5) * 60 + field(6)
    # Wall-clock seconds: as far from the epoch in the session's time zone as in any other.
    time = F.to_utc_timestamp(F.timestamp_seconds(seconds), F.current_timezone())
    return F.when(F.year(F.timestamp_seconds(seconds)).between(1, 9999), time)


def parse_time(text: Column) -> Column:
    """Text to timestamp; unreadable text gives null instead of stopping the job.

    The usual form is read as a whole, any other by :func:`parse_fields`.
    """
    return F.coalesce(F.try_to_timestamp(text, F.lit(PARSE_FORMAT)), parse_fields(text))


def format_time(time: Column) -> Column:
    return F.date_format(time, TIME_FORMAT)


def day_hour(time: Column) -> Column:
    return F.date_format(time, DAY_HOUR_FORMAT)


def seconds_between(start: Column, end: Column) -> Column:
    return F.unix_seconds(end) - F.unix_seconds(start)
