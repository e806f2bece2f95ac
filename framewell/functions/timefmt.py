"""Time conversion, parsing and formatting.

All times are UTC: the session time zone is pinned to UTC by the callers.
"""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted request date formats; single letters accept one or two
# digits ("2025-3-9").
REQUEST_DATE_FORMATS = ["yyyy-M-d", "yyyy/M/d", "yyyy-M-d H:m:s"]

_REQUEST_DATE = re.compile(r"(\d{4})(?:/(\d{1,2})/(\d{1,2})|-(\d{1,2})-(\d{1,2})(?: (\d{1,2}):(\d{1,2}):(\d{1,2}))?)", re.ASCII)

# Fixed value: archive event time text, "%Y-%m-%dT%H:%M:%S.%fZ".
EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_to_timestamp(col) -> Column:
    """Epoch seconds (double) -> timestamp, microseconds kept."""
    return F.timestamp_seconds(_c(col))


def timestamp_to_epoch(col) -> Column:
    """Inverse of T1: timestamp -> epoch seconds as double."""
    return F.unix_micros(_c(col).cast("timestamp")) / F.lit(1_000_000.0)


def now_utc() -> Column:
    """Processing time; one value per query/batch, never per row."""
    return F.current_timestamp()


def parse_event_time(col) -> Column:
    """T4: '%Y-%m-%dT%H:%M:%S.%fZ' text -> timestamp; anything else -> null."""
    return F.try_to_timestamp(_c(col), F.lit(EVENT_TIME_FORMAT))


def parse_request_date(col) -> Column:
    """T5: first of the three request formats that parses; null = reject."""
    return F.coalesce(*[F.try_to_timestamp(_c(col), F.lit(p)) for p in REQUEST_DATE_FORMATS])


def parse_request_date_literal(text: str) -> datetime:
    """T5 for one query literal on the driver (request coercion, not data)."""
    m = _REQUEST_DATE.fullmatch(text)
    if m is None:
        raise ValueError(f"not a request date: {text!r}")
    return datetime(*(int(part) for part in m.groups() if part and part.isdigit()))


# Output name patterns.
OBJECT_TIME_PATTERN = "yyyyMMdd_HHmmss"       # %Y%m%d_%H%M%S
OBJECT_DATE_PATTERN = "yyyy_MM_dd"            # %Y_%m_%d
FRAME_TIME_PATTERN = "yyMMdd_HHmmss_SSSSSS"   # %y%m%d_%H%M%S_%f
JSON_TIME_PATTERN = "yyyy-MM-dd HH:mm:ss.SSSSSS"  # %Y-%m-%d %H:%M:%S.%f
DISPLAY_TIME_PATTERN = "yyyy-MM-dd HH:mm:ss"  # table display text (T19)


def format_time(col, pattern: str) -> Column:
    """Timestamp -> text with a Spark datetime pattern."""
    return F.date_format(_c(col), pattern)


def shifted_epoch(col, hours: int = 9) -> Column:
    """Whole epoch seconds plus a fixed hour shift (playback range)."""
    return F.unix_timestamp(_c(col)) + F.lit(hours * 3600)


def as_ntz(col) -> Column:
    """Timestamp -> TIMESTAMP_NTZ (wall clock in the UTC session)."""
    return _c(col).cast("timestamp_ntz")


def as_utc_timestamp(col) -> Column:
    """TIMESTAMP_NTZ (UTC wall clock) -> TIMESTAMP, as watermarks need."""
    return _c(col).cast("timestamp")
