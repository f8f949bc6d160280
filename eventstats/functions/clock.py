"""Wall-clock helpers.

Event time is kept as 19-character text on the target clock (UTC+8 unless told
otherwise). Arithmetic is done on ``timestamp_ntz`` or on that text, so the session
time zone never decides a result, and every bucket is a plain text prefix.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# De-duplication interval labels and how much of 'yyyy-MM-dd HH:mm:ss'
# names one bucket. "all" is the single all-time bucket.
BUCKET_WIDTHS = {
    "minutely": 16,
    "hourly": 13,
    "daily": 10,
    "monthly": 7,
    "yearly": 4,
    "all": 0,
}

# Fixed value: accepted time text. The offset may be Z, +hh, +hhmm or +hh:mm.
TIME_PATTERN = (
    r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?"
    r"(Z|[+-](0\d|1[0-8])(:?[0-5]\d)?)?\z"
)
_EPOCH = "1970-01-01 00:00:00"


def offset_minutes(offset: str) -> int:
    """'+08:00' -> 480."""
    match = re.fullmatch(r"([+-])(\d{2}):?(\d{2})", offset)
    if not match:
        raise ValueError(f"not a time offset: {offset!r}")
    minutes = int(match[2]) * 60 + int(match[3])
    return -minutes if match[1] == "-" else minutes


def normalize_time(
    col: Column, default_offset: str = "+08:00", target_offset: str = "+08:00"
) -> Column:
    """Time text -> 'yyyy-MM-dd HH:mm:ss' on the target clock; null when not a valid time.

    A stated offset is honoured; text without one is read with ``default_offset``.
    """
    offset_minutes(default_offset)
    text = F.when(col.startswith('"'), F.translate(col, '"', "")).otherwise(col)
    tail = F.substring(text, F.lit(20), F.length(text))
    stated = tail.contains("+") | tail.contains("-") | tail.endswith("Z")
    instant = F.when(stated, text).otherwise(F.concat(text, F.lit(default_offset)))
    shifted = F.lit(_EPOCH).cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0),
        F.lit(0),
        F.lit(offset_minutes(target_offset)),
        F.unix_seconds(instant.try_cast("timestamp")),
    )
    return F.when(text.rlike(TIME_PATTERN), shifted.cast("string"))


def time_bucket(time: Column, minutes: int) -> tuple[Column, Column]:
    """Inclusive start and end text of the ``minutes`` bucket that holds a normalised time."""
    if minutes < 1 or 60 % minutes:
        raise ValueError(f"bucket length must divide 60, got {minutes}")
    hour = F.substring(time, 1, 14)
    minute = F.substring(time, 15, 2).try_cast("int")
    start = minute - F.pmod(minute, F.lit(minutes))

    def text(value: Column, second: str) -> Column:
        return F.concat(hour, F.lpad(value.cast("string"), 2, "0"), F.lit(second))

    return text(start, ":00"), text(start + (minutes - 1), ":59")


def bucket_label(time: Column, interval: str) -> Column:
    """Prefix of a normalised time that names its interval bucket."""
    if interval not in BUCKET_WIDTHS:
        raise ValueError(f"unknown interval {interval!r}; use one of {sorted(BUCKET_WIDTHS)}")
    width = BUCKET_WIDTHS[interval]
    return F.substring(time, 1, width) if width else F.lit("")


def bucket_key(time: Column, interval: str) -> Column:
    """Compact bucket name: yyyyMMddHHmm, yyyyMMddHH, yyyyMMdd, yyyyMM or yyyy."""
    return F.translate(bucket_label(time, interval), "- :", "")


def shift_hours(ts: Column, hours: int) -> Column:
    """Move a ``timestamp_ntz`` by whole hours."""
    return ts + F.make_dt_interval(F.lit(0), F.lit(hours))


_PATTERN_FIELDS = {"yyyy": 4, "MM": 2, "dd": 2, "HH": 2, "mm": 2, "ss": 2}


def text_to_millis(
    col: Column, pattern: str = "yyyy-MM-dd HH:mm:ss", offset: str = "+08:00"
) -> Column:
    """Wall-clock text -> epoch milliseconds; null when the text does not fit the pattern."""
    zoned = F.try_to_timestamp(F.concat(col, F.lit(" " + offset)), F.lit(pattern + " XXX"))
    return F.unix_millis(zoned)


def millis_to_text(
    col: Column, pattern: str = "yyyy-MM-dd HH:mm:ss", offset: str = "+08:00"
) -> Column:
    """Epoch milliseconds -> wall-clock text on the clock of ``offset``.

    The pattern is made of yyyy, MM, dd, HH, mm, ss and literal characters. The text is
    cut out of the ISO form, which no session setting changes.
    """
    micros = (col + offset_minutes(offset) * 60_000) * 1_000
    epoch = F.lit(_EPOCH).cast("timestamp_ntz")
    days = F.floor(micros / F.lit(86_400_000_000)).cast("int")
    rest = F.pmod(micros, F.lit(86_400_000_000))
    wall = epoch + F.make_dt_interval(
        days, F.lit(0), F.lit(0), (rest / F.lit(1_000_000)).cast("decimal(18,6)")
    )
    iso = F.substring(wall.cast("string"), 1, 19)
    start = {"yyyy": 1, "MM": 6, "dd": 9, "HH": 12, "mm": 15, "ss": 18}
    pieces = [p for p in re.split("(" + "|".join(_PATTERN_FIELDS) + ")", pattern) if p]
    return F.concat(
        *[
            F.substring(iso, start[p], _PATTERN_FIELDS[p]) if p in start else F.lit(p)
            for p in pieces
        ]
    )
