"""Blob operators (J1, F8, K2 preparation, T13, T14)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewell.functions.codec import b64encode
from framewell.functions.paths import is_image, mime_type


def with_mime(blobs: DataFrame, path_col: str = "path") -> DataFrame:
    """Add the MIME type guessed from the name."""
    return blobs.withColumn("mime_type", mime_type(path_col))


def filter_images(blobs: DataFrame, path_col: str = "path") -> DataFrame:
    """F8: image/* objects only."""
    return with_mime(blobs, path_col).filter(is_image(path_col))


def metadata_with_blob(images: DataFrame, blobs: DataFrame, path_col: str = "img_path",
                       content: str = "summary") -> DataFrame:
    """Metadata row -> its blob (inner join; a missing blob gives no row).

    ``content='summary'`` carries only size and digest through the join, so
    the shuffle moves no payload; ``'data_uri'`` returns the inline form the
    viewer shows (base64 of the bytes), ``'bytes'`` the raw bytes.
    """
    b = with_mime(blobs)
    if content == "summary":
        b = b.select("path", "mime_type", F.octet_length("content").cast("bigint").alias("n_bytes"),
                     F.sha2(F.col("content"), 256).alias("sha256"))
    elif content == "data_uri":
        b = b.select("path", "mime_type", F.concat(F.lit("data:"), F.col("mime_type"), F.lit(";base64,"),
                                                   b64encode("content")).alias("data_uri"))
    else:
        b = b.select("path", "mime_type", "content")
    return images.join(b, images[path_col] == b["path"], "inner").drop("path")
