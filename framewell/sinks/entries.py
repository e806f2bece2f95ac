"""Stored stream entries with retention (T-W6, F11).

Entries lie in slots of their time, ``slot=N`` folders of ``width`` seconds each. Trimming drops the slots that
are wholly expired and rewrites the one that the limit falls into, so its cost follows what expires, not what
is stored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framewell.session import work_dir
from framewell.sinks.fs import drop_folders, numbered_folders, path_exists


def _seconds(time_col: str) -> Column:
    return F.unix_micros(F.col(time_col).cast("timestamp")) / 1e6


def append_entries(df: DataFrame, root: str, time_col: str, width: int = 3600, batch_id: int | None = None) -> None:
    """Add entries, one file per slot touched. With ``batch_id`` the file belongs to that batch and a batch that is
    repeated replaces it. Entries without a time are refused (they would never expire)."""
    rows = df.where(F.col(time_col).isNotNull()).withColumn("slot", F.floor(_seconds(time_col) / width).cast("long"))
    if batch_id is None:
        rows.repartition("slot").write.mode("append").partitionBy("slot").parquet(root)
        return
    # dynamic overwrite touches this batch's folders only
    (rows.withColumn("part", F.lit(batch_id)).repartition("slot").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("slot", "part").parquet(root))


def read_entries(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(root).drop("slot", "part")


def trim_entries(spark: SparkSession, root: str, time_col: str, ttl_seconds: float, width: int = 3600) -> int:
    """Remove the entries older than ``ttl_seconds`` before the newest and return how many they were.

    The newest entry is in the last slot. Expired slots are counted from file footers and dropped; the border
    slot's remaining rows are written to the work folder first and swapped in, so that a run that dies is
    repeated without loss.
    """
    root = root.rstrip("/")
    slots = numbered_folders(spark, root, "slot")
    if not slots:
        return 0
    rows = spark.read.option("basePath", root).parquet(*[f"{root}/slot={n}" for n in slots])
    newest = rows.where(F.col("slot") == slots[-1]).agg(F.max(_seconds(time_col))).first()[0]
    limit = newest - ttl_seconds
    border = int(limit // width)
    removed = 0
    if slots[0] < border:
        removed += rows.where(F.col("slot") < border).count()
        drop_folders(spark, root, "slot", border)
    if border in slots:
        old = rows.where((F.col("slot") == border) & (_seconds(time_col) < limit)).count()
        if old:
            keep = spark.read.option("basePath", root).parquet(f"{root}/slot={border}").where(_seconds(time_col) >= limit)
            stage = f"{work_dir(spark)}/trim/{hashlib.sha1(root.encode()).hexdigest()[:16]}/{border}-{limit!r}"
            if not path_exists(spark, f"{stage}/_SUCCESS"):
                keep.write.mode("overwrite").parquet(stage)
            by = [c for c in ("slot", "part") if c in rows.columns]
            staged = spark.read.schema(keep.schema).parquet(stage)
            if "part" in by:  # parts left without a row go with the slot
                drop_folders(spark, root, "slot", border + 1)
            staged.repartition("slot").write.mode("append" if "part" in by else "overwrite").option(
                "partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(root)
            removed += old
    return removed
