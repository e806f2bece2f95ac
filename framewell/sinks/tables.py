"""Table sinks (K1, K3, K5, K7).

K1 keeps a keyed table without a MERGE-capable format: rows live in hash
buckets of the key (``_bucket`` partitions); a batch rewrites only the buckets
it touches. The merged buckets are first written to a stage folder under
the shared work folder (lineage cut), then swapped in with a dynamic
partition overwrite, then a commit marker is written. A replayed batch (the
stream sink is at-least-once) finds its marker and does nothing; a batch
that died after staging reuses the staged result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewell.operators.mutations import merge_by_key
from framewell.operators.ordering import keep_last, keep_last_values
from framewell.session import work_dir
from framewell.sinks.fs import has_partitions, path_exists, write_marker


def bucket_of(key: str, n_buckets: int):
    return F.pmod(F.xxhash64(F.col(key)), F.lit(n_buckets)).cast("int")


def upsert_table(spark: SparkSession, batch: DataFrame, table_path: str, key: str = "name",
                 order: str | Sequence[str] = "offset", n_buckets: int = 64,
                 batch_id: int | None = None, partition_by: Sequence[str] | None = None,
                 partial: bool = False) -> None:
    """K1: merge a batch into the keyed table at ``table_path``.

    Last arrival wins within the batch; across batches a row is replaced
    only by one with an equal or later ``order`` value, so replays and
    out-of-order files give the same table.

    Layout: hash buckets of the key (``_bucket``), or ``partition_by``
    columns that the key determines (for frames: device and capture hour,
    both part of the frame name). A batch rewrites only the partitions it
    touches, so with time-determined partitions it rewrites recent data
    only, however large the table is. A batch with a column ``partition`` comes from a
    topic of several partitions: rows keep (arrival_batch, partition, offset), offsets are
    compared within a partition only, between partitions the later batch wins. ``partial``: records may carry a
    subset of the fields (null = not supplied), see ``merge_by_key``.
    """
    table_path = table_path.rstrip("/")
    arrival = None
    if "partition" in batch.columns and batch_id is not None:
        arrival = ("arrival_batch", "partition", order if isinstance(order, str) else order[-1])
        batch = batch.withColumn("arrival_batch", F.lit(batch_id).cast("long"))
        order = [*arrival[1:]]
    parts = list(partition_by) if partition_by else ["_bucket"]
    marker = f"{table_path}/_commits/{batch_id}" if batch_id is not None else None
    if marker and path_exists(spark, marker):
        return
    tag = hashlib.sha1(table_path.encode()).hexdigest()[:16]
    stage = f"{work_dir(spark)}/upsert_stage/{tag}/{batch_id if batch_id is not None else 'adhoc'}"
    if batch_id is None or not path_exists(spark, f"{stage}/_SUCCESS"):
        b = batch if partition_by else batch.withColumn("_bucket", bucket_of(key, n_buckets))
        # the partition values one micro-batch touches (bounded by its size)
        touched = [tuple(r) for r in b.select(*parts).distinct().collect()]
        if not touched:
            return
        if not has_partitions(spark, table_path, parts[0]):
            # first write: nothing is read, so write straight into the table
            first = keep_last_values(b, key, order) if partial else keep_last(b, key, order)
            (first.repartition(*parts).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(table_path))
            if marker:
                write_marker(spark, marker)
            return
        target = spark.read.parquet(table_path)
        for c in parts:  # partition values come back with inferred types
            target = target.withColumn(c, F.col(c).cast(b.schema[c].dataType))
        hit = F.struct(*[F.col(c).cast("string") for c in parts]).isin(
            [F.struct(*[F.lit(None if v is None else str(v)) for v in t]) for t in touched])
        merged = merge_by_key(target.filter(hit), b, key, order, guard=True, partial=partial, arrival=arrival)
        # one file per touched partition, not one per task and partition
        merged.repartition(*parts).write.mode("overwrite").partitionBy(*parts).parquet(stage)
    staged = spark.read.parquet(stage)
    (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(*parts).parquet(table_path))
    if marker:
        write_marker(spark, marker)


def read_keyed_table(spark: SparkSession, table_path: str) -> DataFrame:
    return spark.read.parquet(table_path).drop("_bucket")


def write_parquet_batches(df: DataFrame, path: str, category: str = "category",
                          time_col: str = "event_datetime", mode: str = "append") -> None:
    """K3 (batch form): rows under category=/dt=YYYY_MM_DD/ partitions."""
    out = df.withColumn("dt", F.date_format(F.col(time_col), "yyyy_MM_dd"))
    out.write.mode(mode).partitionBy(category, "dt").parquet(path)


def write_points(points: DataFrame, path: str, mode: str = "append") -> None:
    """K5: all series in one partitioned pass (one folder per io_id),
    replacing the per-series write loop."""
    points.write.mode(mode).partitionBy("io_id").parquet(path)


def console(df: DataFrame, n: int = 20) -> None:
    """K7 (batch form): print rows."""
    df.show(n, truncate=False)
