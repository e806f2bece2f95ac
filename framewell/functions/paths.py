"""Object paths, generated names and MIME types."""

from __future__ import annotations

import mimetypes
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from framewell.functions.timefmt import (FRAME_TIME_PATTERN, OBJECT_DATE_PATTERN,
                                         OBJECT_TIME_PATTERN)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def img_path(device_id="device_id", name="name") -> Column:
    """T9: '{device_id}/{name}'; null when either part is null (a reject)."""
    return F.concat(_c(device_id), F.lit("/"), _c(name))


def frame_name(device_id, ts) -> Column:
    """T10: '{device_id}_{yyMMdd_HHmmss_ffffff}.jpg'."""
    return F.concat(_c(device_id), F.lit("_"), F.date_format(_c(ts), FRAME_TIME_PATTERN),
                    F.lit(".jpg"))


def short_uid() -> Column:
    """Eight hex characters of a random uuid (non-deterministic)."""
    return F.substring(F.regexp_replace(F.expr("uuid()"), "-", ""), 1, 8)


def object_key(category, ts) -> Column:
    """T10: '{category}/{YYYY_MM_DD}/{YYYYmmdd_HHMMSS}_{8 hex}.parquet'."""
    return F.concat(_c(category), F.lit("/"), F.date_format(_c(ts), OBJECT_DATE_PATTERN),
                    F.lit("/"), F.date_format(_c(ts), OBJECT_TIME_PATTERN), F.lit("_"),
                    short_uid(), F.lit(".parquet"))


# Python's own table: extension -> MIME type, and the suffixes that only name an encoding
# ("a.jpg.gz" is a JPEG image).
_TABLE = mimetypes.MimeTypes(filenames=())
MIME_TYPES = {k.lstrip("."): v for k, v in {**_TABLE.types_map[0], **_TABLE.types_map[1]}.items()}
ENCODING_SUFFIX = "(?:" + "|".join(sorted(map(re.escape, _TABLE.encodings_map))) + ")$"
DEFAULT_MIME = "application/octet-stream"


def extension(path) -> Column:
    return F.lower(F.regexp_extract(F.regexp_replace(_c(path), ENCODING_SUFFIX, ""), r"\.([^./]+)$", 1))


def mime_type(path) -> Column:
    """Guessed from the file name; unknown -> application/octet-stream."""
    table = F.create_map(*[x for kv in MIME_TYPES.items() for x in map(F.lit, kv)])
    return F.coalesce(F.try_element_at(table, extension(path)), F.lit(DEFAULT_MIME))


def is_image(path) -> Column:
    """F8: MIME type guessed from the name starts with image/."""
    return mime_type(path).startswith("image/")
