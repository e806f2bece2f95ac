"""Frame ingestion and archive streams (T-W3, T-W4, K1-K3, K7, F10, C2).

One checkpointed streaming query per flow; each micro-batch is handled with
set-based DataFrame writes (no collect, no per-row client calls):
blobs first, then the keyed metadata merge, then the rejects.
"""

from __future__ import annotations

import hashlib
import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewell.functions.codec import decode_json
from framewell.functions.timefmt import parse_event_time
from framewell.operators.ordering import keep_last
from framewell.operators.parse import derive_metadata, split_rejects, validate_frames
from framewell.session import work_dir
from framewell.sinks.blobs import write_blobs
from framewell.sinks.tables import upsert_table


METRICS_SCHEMA = ("batch_id long, n_rows long, n_good long, n_rejects long, "
                  "elapsed_s double, latency_per_row double")


def _start(writer, spark: SparkSession, checkpoint: str | None, trigger: dict | None, kind: str, target: str):
    """Start a query. Without a checkpoint its own follows from its kind and target, so a
    restart goes on with the batch numbers that the target's markers and folders know."""
    own = f"{work_dir(spark)}/checkpoints/{kind}-{hashlib.sha1(target.rstrip('/').encode()).hexdigest()}"
    writer = writer.option("checkpointLocation", checkpoint or own)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def poll_trigger(seconds: float = 0.1) -> dict:
    """T-W4: the producer's poll interval as a processing-time trigger."""
    return {"processingTime": f"{int(seconds * 1000)} milliseconds"}


def ingest_frames(spark: SparkSession, source: DataFrame, table_path: str, blob_root: str,
                  rejects_path: str, checkpoint: str | None = None, trigger: dict | None = None,
                  n_buckets: int = 64, metrics_path: str | None = None):
    """T-W3: topic (offset, value, and partition if there are several) -> validate -> blobs + keyed
    metadata + rejects.

    With ``metrics_path`` each batch appends one row (A7/A8): rows, good,
    rejects, elapsed seconds and elapsed per row. Counts come from an
    ``Observation`` on the validated batch, so they cost no extra job.
    """
    def process(batch: DataFrame, batch_id: int) -> None:
        started = time.perf_counter()
        obs = Observation(f"ingest_{batch_id}")
        v = validate_frames(batch, keep=[c for c in ("partition", "offset") if c in batch.columns]).observe(
            obs, F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("valid")).alias("n_good")).persist()
        try:
            # counting fills the cache, so the source is read once; asked whether it is empty,
            # it would begin every slice and break off
            if not v.count():
                return
            good, rejects = split_rejects(v)
            write_blobs(good, blob_root, batch_id)                           # K2 first
            meta = derive_metadata(good.drop("img"), with_process_time=True, with_updated_time=True)
            upsert_table(spark, meta, table_path, "name", "offset", n_buckets, batch_id)  # K1
            rejects.write.mode("overwrite").parquet(f"{rejects_path.rstrip('/')}/_batch={batch_id}")
        finally:
            v.unpersist()
        if metrics_path:
            m = obs.get
            elapsed = time.perf_counter() - started
            n = int(m.get("n_rows", 0))
            row = [(batch_id, n, int(m.get("n_good", 0)), n - int(m.get("n_good", 0)), elapsed,
                    elapsed / n if n else None)]
            spark.createDataFrame(row, METRICS_SCHEMA).write.mode("overwrite").parquet(
                f"{metrics_path.rstrip('/')}/_batch={batch_id}")
    return _start(source.writeStream.foreachBatch(process), spark, checkpoint, trigger, "ingest", table_path)


def relay_buffer(spark: SparkSession, buffer: DataFrame, out_path: str, key: str | None = None,
                 checkpoint: str | None = None, trigger: dict | None = None):
    """T-W4: forward a buffer stream to a topic every poll interval.

    Each trigger takes what the buffer holds (count-limited by the source's
    ``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger``); an empty poll makes no
    batch. Rows go out as JSON values (K4); the topic here is a JSON file
    sink, ``sinks.topics.write_topic`` is the Kafka form. A failed query
    resumes from its checkpoint instead of skipping data.
    """
    from framewell.sinks.topics import to_topic_value
    w = to_topic_value(buffer, key).writeStream.format("json").option("path", out_path)
    return _start(w, spark, checkpoint, trigger or poll_trigger(0.1), "relay", out_path)


ARCHIVE_BASE = T.StructType([T.StructField("event_datetime_str", T.StringType())])


def parse_archive_messages(source: DataFrame, model: T.StructType, keep_raw: bool = False) -> DataFrame:
    """JSON -> model fields; the time text is popped and parsed.
    Adds ``valid`` (time parsed and the message was JSON); with ``keep_raw`` the text stays as ``_raw``."""
    schema = T.StructType(ARCHIVE_BASE.fields + [f for f in model.fields if f.name != "event_datetime_str"])
    raw = [F.col("value").cast("string").alias("_raw")] if keep_raw else []
    m = source.select("offset", *raw, decode_json("value", schema).alias("m")).select("offset", *(["_raw"] if raw else []), "m.*")
    t = parse_event_time("event_datetime_str")
    return (m.withColumn("event_datetime", t).drop("event_datetime_str")
             .withColumn("valid", F.col("event_datetime").isNotNull()))


def archive_stream(spark: SparkSession, source: DataFrame, model: T.StructType, path: str,
                   category: str = "category", checkpoint: str | None = None,
                   trigger: dict | None = None, dedup_key: str | None = None, rejects_path: str | None = None):
    """K3: valid messages to Parquet under category=/dt=YYYY_MM_DD/, the others (offset, value) to
    ``rejects_path`` (by default beside the archive).

    The date folder comes from the event time, so a rerun lands in the same
    folders (processing time would not). With ``dedup_key`` each
    micro-batch keeps the last arrival per key (W1).
    """
    base = path.rstrip("/")
    rejects = (rejects_path or f"{base}_rejects").rstrip("/")
    parsed = parse_archive_messages(source, model, keep_raw=True)

    def process(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():  # F10
            return
        batch = batch.persist()
        try:
            good = batch.filter("valid").drop("valid", "_raw").withColumn("dt", F.date_format("event_datetime", "yyyy_MM_dd"))
            if dedup_key:
                good = keep_last(good, dedup_key, "offset")
            # a folder's rows come together first (large ones are split again): few files a batch, not tasks x folders
            (good.hint("rebalance", F.col(category), F.col("dt")).write.mode("overwrite")
             .partitionBy(category, "dt").parquet(f"{base}/_batch={batch_id}"))
            (batch.filter("not valid").select("offset", F.col("_raw").alias("value"))
             .write.mode("overwrite").parquet(f"{rejects}/_batch={batch_id}"))
        finally:
            batch.unpersist()
    return _start(parsed.writeStream.foreachBatch(process), spark, checkpoint, trigger, "archive", path)
