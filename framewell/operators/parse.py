"""Parse, validate and enrich frame messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewell import schemas
from framewell.functions.codec import b64decode, decode_json, is_base64, py_str
from framewell.functions.paths import img_path
from framewell.functions.timefmt import epoch_to_timestamp, now_utc

CORRUPT = "_corrupt_record"


def parse_messages(df: DataFrame, schema: T.StructType = schemas.FRAME,
                   value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """CAST(value AS STRING) -> parse with a fixed schema -> flatten.

    Other columns named in ``keep`` (topic offset, key, ...) pass through.
    ``parse_ok`` is false for a null message or text that does not fit the
    schema (truncated JSON, a quoted number for a numeric field).
    """
    keep = keep if keep is not None else [c for c in df.columns if c != value_col]
    out = _parsed(df, keep, value_col, schema)
    return out.select(
        *keep, *[F.col(f.name) for f in schema.fields],
        (~F.col("_null_msg") & F.col(CORRUPT).isNull()).alias("parse_ok"))


def _parsed(df: DataFrame, keep: list[str], value_col: str, schema: T.StructType) -> DataFrame:
    """Parse once per row. The fields come out of a generator (``inline``),
    which Catalyst does not push filters through, so a later filter on
    them cannot re-inline the parse once per referenced field."""
    parsed = decode_json(F.col(value_col), schema, CORRUPT)
    return df.select(*keep, F.col(value_col).isNull().alias("_null_msg"), F.inline(F.array(parsed)))


def validate_frames(df: DataFrame, value_col: str = "value",
                    keep: list[str] | None = None) -> DataFrame:
    """Rebuild each record through the frame model; collect every error.

    Numbers arrive as text first and are converted with ``try_cast`` (so
    "1.5" is accepted, as ``float(x)`` would). Adds ``valid`` and ``errors``.
    """
    keep = keep if keep is not None else [c for c in df.columns if c != value_col]
    m = _parsed(df, keep, value_col, schemas.FRAME_TEXT)
    fields = {f.name: F.col(f.name) for f in schemas.FRAME_TEXT.fields}
    ts = fields["timestamp"].try_cast("double")
    malformed = F.col("_null_msg") | (F.col(CORRUPT).isNotNull()
                                      & F.coalesce(*fields.values()).isNull())
    checks: list[Column] = [F.when(malformed, F.lit("malformed message"))]
    for name in ("device_id", "name", "width", "height", "img"):
        checks.append(F.when(~malformed & fields[name].isNull(), F.lit(f"{name} is required")))
    checks.append(F.when(~malformed & ts.isNull(), F.lit("timestamp is not a number")))
    checks.append(F.when(~malformed & fields["img"].isNotNull() & ~is_base64(fields["img"]),
                         F.lit("img is not base64")))
    errors = F.filter(F.array(*checks), lambda x: x.isNotNull())
    return m.select(
        *keep, fields["device_id"].alias("device_id"), fields["name"].alias("name"),
        ts.alias("timestamp"), fields["width"].alias("width"), fields["height"].alias("height"),
        fields["img"].alias("img"), errors.alias("errors")
    ).withColumn("valid", F.size("errors") == 0)


def split_rejects(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows and rejects from one validated frame (no stream stop).

    Callers that act on both sides of a batch should persist ``validated``
    first so the parse runs once.
    """
    good = validated.filter(F.col("valid")).drop("valid", "errors")
    rejects = validated.filter(~F.col("valid"))
    return good, rejects


def derive_metadata(df: DataFrame, with_process_time: bool = True,
                    with_updated_time: bool = False) -> DataFrame:
    """Add event_datetime (T1), img_path (T9) and processing times."""
    cols = [F.col(c) for c in df.columns]
    cols.append(epoch_to_timestamp("timestamp").alias("event_datetime"))
    if with_process_time:
        cols.append(now_utc().alias("process_datetime"))
    cols.append(img_path("device_id", "name").alias("img_path"))
    if with_updated_time:
        cols.append(now_utc().alias("updated_datetime"))
    return df.select(*cols)


def decode_payload(df: DataFrame, img_col: str = "img", out_col: str = "content") -> DataFrame:
    """K2 preparation: base64 text -> bytes (malformed -> null)."""
    return df.withColumn(out_col, b64decode(img_col))


def project_model(df: DataFrame, model: str | None) -> DataFrame:
    """Named projection; unknown name raises KeyError; None = all."""
    if model is None:
        return df
    cols = schemas.PROJECTIONS[model]
    return df.select(*[c for c in cols if c in df.columns])


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop payload columns; missing names are ignored."""
    return df.drop(*names)


def rename_with_alias(df: DataFrame, key: str = "id", alias: str = "_id",
                      stringify: tuple[str, ...] = ()) -> DataFrame:
    """Expose the key under its alias; render non-JSON types as text."""
    out = df.withColumnRenamed(key, alias) if key in df.columns and key != alias else df
    for c in stringify:
        out = out.withColumn(c, py_str(F.col(c), out.schema[c].dataType))
    return out
