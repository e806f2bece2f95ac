"""Streaming metrics (T-W2 stream form, A7-A9) without state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewell.streaming.ingest import _start


def fps_stream(spark: SparkSession, frames: DataFrame, time_col: str, out_path: str,
               key: str = "device_id", checkpoint: str | None = None, trigger: dict | None = None):
    """T-W2: frames per device per second.

    Every micro-batch writes its own counts into its own folder (a replay overwrites it);
    ``read_window_counts`` adds them up. Counts are additive, so no frame is too late and no
    state or watermark is kept.
    """
    def process(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():  # F10
            return
        counts = batch.groupBy(key, F.date_trunc("second", time_col).alias("second")).agg(F.count("*").alias("fps"))
        counts.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/_batch={batch_id}")
    return _start(frames.writeStream.foreachBatch(process), spark, checkpoint, trigger, "fps", out_path)


def read_window_counts(spark: SparkSession, out_path: str, key: str = "device_id") -> DataFrame:
    """Count of each (key, second) over all batches written by ``fps_stream``."""
    return spark.read.parquet(out_path).groupBy(key, "second").agg(F.sum("fps").alias("fps"))


SKETCH_K = 800  # of the quantile sketches: a rank error of about 0.4 %


def latency_stream(spark: SparkSession, source: DataFrame, latency: str, out_path: str, keys: Sequence[str] = (),
                   bounds: Sequence[float] = (), checkpoint: str | None = None, trigger: dict | None = None):
    """A8/A9 over a stream: every micro-batch writes one row per key with its count, sum, extremes, bucket
    counts (values up to each of ``bounds``) and a quantile sketch of bounded size, into its own folder (a
    replay overwrites it). All of them merge, so readers see any span of batches; no state is kept."""
    x = F.col(latency).cast("double")

    def process(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():  # F10
            return
        rows = batch.groupBy(*keys).agg(
            F.count(x).alias("n"), F.sum(x).alias("total"), F.min(x).alias("least"), F.max(x).alias("most"),
            F.array(*[F.count_if(x <= b) for b in bounds]).cast("array<long>").alias("buckets"),
            F.kll_sketch_agg_double(x, SKETCH_K).alias("sketch"))
        rows.where("n > 0").write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/_batch={batch_id}")
    return _start(source.writeStream.foreachBatch(process), spark, checkpoint, trigger, "latency", out_path)


def _merged(spark: SparkSession, out_path: str, keys: Sequence[str], since: int | None) -> DataFrame:
    rows = spark.read.parquet(out_path)
    return rows.where(F.col("_batch") >= since) if since is not None else rows


def read_latency(spark: SparkSession, out_path: str, keys: Sequence[str] = (), quantiles: Sequence[float] = (0.5, 0.9, 0.99),
                 since: int | None = None) -> DataFrame:
    """Per key n, avg, min and max, exact, and the quantiles ``p50`` ... within the sketch's rank error, over the
    batches written by ``latency_stream`` (from batch ``since`` on)."""
    m = _merged(spark, out_path, keys, since).groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("total").alias("_total"), F.min("least").alias("min_latency"), F.max("most").alias("max_latency"),
        F.kll_merge_agg_double("sketch").alias("_sketch"))
    named = [F.kll_sketch_get_quantile_double("_sketch", F.lit(float(q))).alias(f"p{q * 100:g}_latency") for q in quantiles]
    return m.select(*keys, "n", (F.col("_total") / F.col("n")).alias("avg_latency"), "min_latency", "max_latency", *named)


def read_histogram(spark: SparkSession, out_path: str, bounds: Sequence[float], keys: Sequence[str] = (), since: int | None = None) -> DataFrame:
    """Cumulative buckets (le, count) with '+Inf' for all values, exact, over the batches of ``latency_stream``."""
    sums = [F.sum(F.get("buckets", F.lit(i))).alias(f"_b{i}") for i in range(len(bounds))]
    m = _merged(spark, out_path, keys, since).groupBy(*keys).agg(*sums, F.sum("n").alias(f"_b{len(bounds)}"))
    le = F.array(*[F.struct(F.lit(str(b)).alias("le"), F.col(f"_b{i}").alias("count")) for i, b in enumerate([*bounds, "+Inf"])])
    return m.select(*keys, F.explode(le).alias("_e")).select(*keys, "_e.le", "_e.count")
