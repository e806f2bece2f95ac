"""Blob sources (S8, S9): object bytes through the ``binaryFile`` reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from framewell.operators.ordering import keep_last
from framewell.sinks.fs import path_exists


def list_blobs(spark: SparkSession, root: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """Every stored object's path, size and time; bytes are not read
    (``content`` is pruned from the scan)."""
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
          .option("recursiveFileLookup", str(recursive).lower()).load(root))
    return df.select("path", "length", "modificationTime")


def read_blobs(spark: SparkSession, root: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """(path, content) for all objects under ``root``."""
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
          .option("recursiveFileLookup", str(recursive).lower()).load(root))
    return df.select("path", "content")


def read_blob(spark: SparkSession, root: str, key: str) -> DataFrame:
    """S8 by key: the object at ``root/key`` (zero rows when absent)."""
    path = f"{root.rstrip('/')}/{key.lstrip('/')}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], "path string, content binary")
    return spark.read.format("binaryFile").load(path).select("path", "content")


def read_blob_table(spark: SparkSession, path: str, keys: DataFrame | None = None) -> DataFrame:
    """S8 over the parquet blob table written by ``sinks.blobs.write_blobs``:
    the newest batch's bytes for each path (later writes replace earlier)."""
    df = spark.read.parquet(path)
    if keys is not None:
        df = df.join(keys, "path", "left_semi")
    if "_batch" in df.columns:
        df = keep_last(df, "path", "_batch").drop("_batch")
    return df
