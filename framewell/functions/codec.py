"""JSON, base64 and type-name helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewell.functions.timefmt import JSON_TIME_PATTERN

# Strict RFC 4648 base64 body (padding required), checked after line breaks
# are removed: Spark inserts CRLF every 76 characters when it encodes.
_B64 = r"^(?:[A-Za-z0-9+/]{4})*(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_base64(col) -> Column:
    return F.regexp_replace(_c(col), r"[\r\n]", "").rlike(_B64)


def b64decode(col) -> Column:
    """base64 text -> bytes; malformed text -> null (never raises)."""
    clean = F.regexp_replace(_c(col), r"[\r\n]", "")
    return F.when(clean.rlike(_B64), F.try_to_binary(clean, F.lit("base64")))


def b64decode_lenient(col) -> Column:
    """T13 as a lenient decoder reads it: characters outside the alphabet are left out, what follows a complete padding is
    ignored; incomplete padding -> null."""
    clean = F.regexp_replace(_c(col), r"[^A-Za-z0-9+/=]", "")
    whole = F.regexp_extract(clean, r"^((?:[A-Za-z0-9+/]{4})*)", 1)
    padded = F.regexp_extract(clean, r"^(?:[A-Za-z0-9+/]{4})*([A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)", 1)
    rest = F.substring(clean, F.length(whole) + 1, F.length(clean))
    ends = (padded != "") | rest.rlike("^=*$")
    return F.when(ends, F.try_to_binary(F.concat(whole, padded), F.lit("base64")))


def py_float(col) -> Column:
    """A double as Python writes it: plain from 0.0001 up to 1e16, else with a two-digit exponent at least."""
    c = _c(col)
    text = c.cast("string")
    # the JVM may write a digit too many: 16 digits do where they read as the same number
    short = F.format_string("%.15e", c)
    long = F.length(F.regexp_replace(F.regexp_extract(text, r"^-?([0-9.]+)", 1), r"[.]|^0[.]?0*", "")) > 16
    text = F.when(long & (short.try_cast("double") == c), F.concat(
        F.regexp_replace(F.regexp_extract(short, r"^([^e]+)", 1), r"0+$", ""), F.lit("E"), F.regexp_extract(short, r"e(.+)$", 1).try_cast("int").cast("string"))).otherwise(text)
    size = F.abs(c)
    digits = F.regexp_replace(F.regexp_extract(text, r"^-?([0-9.]+)", 1), r"\.0?$", "")
    power = F.regexp_extract(text, r"E(-?[0-9]+)$", 1).try_cast("int")
    exponent = F.concat(F.when(power < 0, "-").otherwise("+"), F.lpad(F.abs(power).cast("string"), F.greatest(F.lit(2), F.length(F.abs(power).cast("string"))), F.lit("0")))
    scientific = F.concat(F.when(c < 0, "-").otherwise(""), digits, F.lit("e"), exponent)
    # the digits with the point moved: 17 of them before or 20 after it at most
    plain = F.regexp_replace(text.try_cast("decimal(38,20)").cast("string"), r"0+$", "")
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    return (F.when(c.isNull(), F.lit(None).cast("string")).when(F.isnan(c), "nan").when(size == float("inf"), F.when(c > 0, "inf").otherwise("-inf"))
            .when(~text.contains("E"), text).when((size >= 1e-4) & (size < 1e16), plain).otherwise(scientific))


def b64encode(col) -> Column:
    """Bytes -> one-line base64 text (no CRLF chunking)."""
    return F.regexp_replace(F.base64(_c(col)), r"[\r\n]", "")


def decode_json(col, schema: T.StructType, corrupt_col: str | None = None) -> Column:
    """JSON text -> struct. With ``corrupt_col`` the raw text of a record
    that did not fit the schema is kept in that field."""
    opts = {"mode": "PERMISSIVE"}
    if corrupt_col:
        schema = T.StructType(schema.fields + [T.StructField(corrupt_col, T.StringType())])
        opts["columnNameOfCorruptRecord"] = corrupt_col
    return F.from_json(_c(col).cast("string"), schema, opts)


def encode_json(col) -> Column:
    """Struct -> JSON text; microsecond time text, nulls kept."""
    return F.to_json(_c(col), {"timestampFormat": JSON_TIME_PATTERN,
                               "timestampNTZFormat": JSON_TIME_PATTERN,
                               "ignoreNullFields": "false"})


# Python type names reported next to distinct values.
PY_TYPE_NAMES = {
    "string": "str", "bigint": "int", "int": "int", "smallint": "int", "tinyint": "int",
    "double": "float", "float": "float", "boolean": "bool", "timestamp": "datetime",
    "timestamp_ntz": "datetime", "date": "date", "binary": "bytes",
}


def py_type_name(dtype: T.DataType) -> str:
    name = dtype.simpleString()
    if name.startswith("decimal"):
        return "Decimal128"
    if name.startswith("array"):
        return "list"
    if name.startswith(("struct", "map")):
        return "dict"
    return PY_TYPE_NAMES.get(name, name)


def py_str(col, dtype: T.DataType) -> Column:
    """Value rendered as Python's str() would for the common types."""
    c = _c(col)
    name = dtype.simpleString()
    if name == "boolean":
        return F.when(c, F.lit("True")).when(~c, F.lit("False"))
    if name in ("timestamp", "timestamp_ntz"):
        return F.when(F.date_format(c, "SSSSSS") == "000000",
                      F.date_format(c, "yyyy-MM-dd HH:mm:ss")).otherwise(
            F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    if name == "double":
        return py_float(c)
    return c.cast("string")
