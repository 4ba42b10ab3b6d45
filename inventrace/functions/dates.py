"""Timestamp text: parse without zone, format in the layouts the state tables keep."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inventrace.functions.text import strip

OFFSET = r"\s*(Z|UTC|[+-]\d{2}:?\d{2})$"
MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
SECONDS = "yyyy-MM-dd HH:mm:ss"


def parse_naive(text: Column) -> Column:
    """Date text to TIMESTAMP_NTZ; an offset or zone suffix is dropped, not applied. ISO forms, and those of :func:`written_date`."""
    raw = strip(text)
    return F.coalesce(F.regexp_replace(raw, OFFSET, "").try_cast("timestamp_ntz"), written_date(raw))


# Names of days and months, and zones, in date texts.
DAY_NAME = r"^(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,?\s+"
MONTH = r"(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)"
ZONE = r"\s*(?:z|utc|gmt)?\s*(?:[+-]\d{2}:?\d{2})?\s*(?:\([a-z ]*\))?$"

#: Rewrites of lower-case text, in this order, into ``d mon yyyy`` or ``yyyy-m-d`` with an optional clock time.
REWRITES = [
    (DAY_NAME, ""),
    (rf"^{MONTH}[a-z]*\s+(\d{{1,2}})\s+([\d:.]+)(?:\s+[a-z]{{3,4}})?\s+(\d{{4}})$", "$2 $1 $4 $3"),
    (r"^(\d{4})(\d{2})(\d{2})t?(\d{2})(\d{2})(\d{2})?(\D.*)?$", "$1-$2-$3 $4:$5:$6$7"),
    (r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"),
    (r":(\D|$)", ":00$1"),
    (r"(?<=:\d{2}|:\d{2}\.\d{1,6}|\d{4})" + ZONE, ""),
    (r"\s*\b([ap])\.?m\.?$", " $1m"),
    (r"(?<=\d)([ap])m$", " $1m"),
    (r"(?<=\d)(?:st|nd|rd|th)\b|,|\bat\b", " "),
    (rf"\b{MONTH}[a-z]*\.?", "$1"),
    (rf"^{MONTH}\s+(\d{{1,2}})\s+(\d{{4}})\b", "$2 $1 $3"),
    (rf"^(\d{{1,2}})-{MONTH}-(\d{{4}})\b", "$1 $2 $3"),
    (r"^(0?[1-9]|1[0-2])/(\d{1,2})/(\d{4})\b", "$3-$1-$2"),
    (r"^(1[3-9]|2\d|3[01])/(\d{1,2})/(\d{4})\b", "$3-$2-$1"),
    (r"^(\d{4})[/.](\d{1,2})[/.](\d{1,2})\b", "$1-$2-$3"),
    (r"^(\d{4}-\d{1,2}-\d{1,2})t", "$1 "),
    (r"\s+", " "),
]
CLOCKS = ["[ H:m[:s[.SSSSSS]]]", " h:m[:s[.SSSSSS]] a"]


def written_date(text: Column) -> Column:
    """Dates as mail headers, logs and people write them, to TIMESTAMP_NTZ; null for other text.

    ``Mon, 15 Jan 2024 10:00:00 GMT``, ``January 15, 2024 10:00 AM``, ``01/15/2024`` (the month first, unless it is above 12), ``2024/1/15``,
    ``Mon Jan 15 10:00:00 2024``, ``20240115T100000``. Zones are dropped.
    """
    low = F.lower(strip(text))
    for pattern, put in REWRITES:
        low = F.regexp_replace(low, pattern, put)
    layouts = [day + clock for day in ("d MMM yyyy", "yyyy-M-d") for clock in CLOCKS]
    read = F.transform(F.array(F.trim(low)), lambda t: F.coalesce(*[F.try_to_timestamp(t, F.lit(x)) for x in layouts]).cast("timestamp_ntz"))
    return F.when(F.regexp_like(text, F.lit(r"\d")), F.element_at(read, 1))


def utc_naive(text: Column) -> Column:
    """ISO-like text to TIMESTAMP_NTZ in UTC: an offset or zone suffix is applied; text without one is taken as UTC.

    The instant is cast in the session time zone, which :func:`inventrace.session.build` pins to UTC.
    """
    raw = strip(text)
    colon = F.regexp_replace(raw, r"([+-]\d{2})(\d{2})$", "$1:$2")
    zoned = F.regexp_like(raw, F.lit(OFFSET)) & F.contains(raw, F.lit(":"))
    return F.when(zoned, F.to_utc_timestamp(colon.try_cast("timestamp"), F.current_timezone()).cast("timestamp_ntz")).otherwise(raw.try_cast("timestamp_ntz"))


def micros_text(text: Column) -> Column:
    """Date text as ``yyyy-MM-dd HH:mm:ss.SSSSSS``; unparsable text is kept, blank is null."""
    raw = F.nullif(text, F.lit(""))
    return F.coalesce(F.date_format(parse_naive(raw), MICROS), raw)


def utc_text(text: Column) -> Column:
    """Date text to seconds; text that carried an offset is moved to UTC and marked so.

    The instant is cast in the session time zone, which :func:`inventrace.session.build` pins to UTC.
    """
    raw = F.nullif(text, F.lit(""))
    naive = F.date_format(parse_naive(raw), SECONDS)
    instant = F.date_format(F.to_utc_timestamp(raw.try_cast("timestamp"), F.current_timezone()), SECONDS)
    zoned = F.concat(instant, F.lit(" UTC"))
    return F.coalesce(F.when(F.regexp_like(strip(raw), F.lit(OFFSET)), zoned), naive, raw)


def micros_between(a: Column, b: Column) -> Column:
    """``a - b`` in microseconds for TIMESTAMP_NTZ columns."""
    return F.timestamp_diff("MICROSECOND", b, a)


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970 of a TIMESTAMP_NTZ. The session time zone is UTC, so no shift takes place."""
    return F.unix_micros(ts.cast("timestamp"))
