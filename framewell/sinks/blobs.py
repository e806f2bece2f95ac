"""Blob sinks (K2, K8).

Blobs are rows of a parquet table ``(path, content, device_id, ...)``
partitioned by device; each micro-batch writes its own folder, so a replayed
batch overwrites itself instead of appending twice.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewell.functions.codec import b64decode
from framewell.functions.paths import img_path
from framewell.operators.ordering import keep_last


def blob_rows(frames: DataFrame, img_col: str = "img", order: str | None = None) -> DataFrame:
    """K2 projection: path '{device_id}/{name}' and decoded bytes (bad -> dropped).

    With ``order`` (arrival), a path written several times keeps the last
    write, as an object store does.
    """
    cols = [img_path("device_id", "name").alias("path"), b64decode(img_col).alias("content"), F.col("device_id")]
    out = frames.select(*cols, *([F.col(order)] if order else []))
    out = out.filter(F.col("path").isNotNull() & F.col("content").isNotNull())
    return keep_last(out, "path", order).drop(order) if order else out


def write_blobs(frames: DataFrame, root: str, batch_id: int | None = None, img_col: str = "img",
                order: str | None = "offset") -> None:
    """K2: decode and store every frame's payload, partitioned by device;
    one row per path per batch (last arrival)."""
    target = f"{root.rstrip('/')}/_batch={batch_id}" if batch_id is not None else root
    mode = "overwrite" if batch_id is not None else "append"
    order = order if order in frames.columns else None
    blob_rows(frames, img_col, order).write.mode(mode).partitionBy("device_id").parquet(target)


def upload_blobs(df: DataFrame, root: str, name_col: str = "name", content_col: str = "content",
                 metadata_cols: tuple[str, ...] = ()) -> DataFrame:
    """K8: store bytes with free metadata; returns (id, filename) of what was
    written. Ids are generated once and materialized with the rows."""
    meta = (F.create_map(*[x for c in metadata_cols for x in (F.lit(c), F.col(c).cast("string"))])
            if metadata_cols else F.create_map().cast("map<string,string>"))
    rows = df.select(F.expr("uuid()").alias("id"), F.col(name_col).alias("filename"),
                     F.col(content_col).alias("content"), meta.alias("metadata"))
    # every upload is a part of its own, so its rows can be told from earlier ones
    part = f"{root.rstrip('/')}/upload={uuid.uuid4().hex}"
    rows.write.parquet(part)
    return df.sparkSession.read.parquet(part).select("id", "filename")
