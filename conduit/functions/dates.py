"""Date rendering and age. All text is UTC when the session is (see ``tune``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_DATE = "0000-00-00 00:00:00"

# Fixed value: a stored date's century, year, month, day, hour, minute and second are one
# byte each; the first two are kept plus 100, the last three plus 1.
_OFFSETS = (100, 100, 0, 0, 1, 1, 1)


def iso8601(ts: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss.SSS``."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS")


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970."""
    return F.unix_timestamp(ts)


def age_seconds(epoch: Column, as_of: Column) -> Column:
    """Seconds between an epoch value and a given moment."""
    return F.unix_timestamp(as_of) - epoch


def full_date(epoch: Column) -> Column:
    """12-hour clock text of epoch seconds."""
    return F.date_format(F.timestamp_seconds(epoch), "yyyy-MM-dd hh:mm:ss a")


def full_date_ms(epoch_ms: Column) -> Column:
    """ISO text with a ``Z`` of epoch milliseconds, in real UTC."""
    return F.date_format(F.timestamp_millis(epoch_ms), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def database_date(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``; a missing date is missing."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def stored_date(raw: Column) -> Column:
    """Text of a date as it is stored, in seven bytes; a century byte of zero is no date."""
    raw = raw.cast("binary")
    parts = [
        F.conv(F.hex(F.substring(raw, at + 1, 1)), 16, 10).cast("int") - offset
        for at, offset in enumerate(_OFFSETS)
    ]
    text = F.format_string("%02d%02d-%02d-%02d %02d:%02d:%02d", *parts)
    return F.when(F.octet_length(raw) >= 7, F.when(F.hex(F.substring(raw, 1, 1)) == "00", NO_DATE).otherwise(text))


def blank_padded(text: Column) -> Column:
    """Fixed-width character value without its trailing blanks."""
    return F.rtrim(text)
