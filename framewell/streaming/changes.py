"""Change propagation streams (T-W7, M13 streaming form) and the live view (T-W5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewell.operators.changes import change_envelope, path_events
from framewell.operators.ordering import keep_last, latest_per_key
from framewell.sinks.fs import drop_folders, latest_version, numbered_folders
from framewell.streaming.ingest import _start


def route_changes(spark: SparkSession, raw_changes: DataFrame, out_path: str, watch: Sequence[str] | None = None,
                  checkpoint: str | None = None, trigger: dict | None = None):
    """T-W7 producer side: change records -> (F3 filtered) -> envelope JSON
    text (T12) -> topic. Here the topic is a JSON file sink; ``sinks.topics.
    write_topic`` is the Kafka form of the same last step."""
    from framewell.operators.changes import filter_changes
    src = filter_changes(raw_changes, watch) if watch else raw_changes
    env = change_envelope(src, as_json=True)
    w = env.writeStream.format("json").option("path", out_path)
    return _start(w, spark, checkpoint, trigger, "changes", out_path)


MARKS = "path string, seq long, gone boolean"


def _last_marks(events: DataFrame) -> DataFrame:
    """The event that decides for each path: the last by sequence, a delete before others of the same number."""
    last = events.groupBy("path").agg(F.max(F.struct("seq", "gone")).alias("m"))
    return last.select("path", "m.seq", "m.gone")


def cascade_stream(spark: SparkSession, envelope: DataFrame, tombstones: str, collection: str = "images",
                   checkpoint: str | None = None, trigger: dict | None = None, seq: str | None = None):
    """M13 streaming: each micro-batch writes, per object path it names, the event that comes last by the
    feed's sequence column ``seq`` (without one: by the batch), as one folder, replay-safe. A delete hides the
    path, an insert, update or replace that holds it shows it, whichever order they arrive in. Readers see
    live blobs through ``live_blobs``; ``compact_tombstones`` keeps the marks few."""
    def process(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():  # F10
            return
        order = F.col(seq).cast("long") if seq else F.lit(batch_id).cast("long")
        _last_marks(path_events(batch, order, collection)).write.mode("overwrite").parquet(f"{tombstones.rstrip('/')}/_batch={batch_id}")
    return _start(envelope.writeStream.foreachBatch(process), spark, checkpoint, trigger, "cascade", tombstones)


def tombstone_marks(spark: SparkSession, tombstones: str) -> DataFrame:
    """(path, seq, gone): the event that decides for each path, of the newest compacted state and the batches after it."""
    root = tombstones.rstrip("/")
    folded = numbered_folders(spark, f"{root}/_base", "v")
    parts = [spark.read.schema(MARKS).parquet(f"{root}/_base/v={folded[-1]}")] if folded else []
    fresh = [n for n in numbered_folders(spark, root, "_batch") if not folded or n > folded[-1]]
    if fresh:
        parts.append(spark.read.schema(MARKS).parquet(*[f"{root}/_batch={n}" for n in fresh]))
    if not parts:
        return spark.createDataFrame([], MARKS)
    return _last_marks(parts[0].unionAll(parts[1]) if len(parts) > 1 else parts[0])


def live_blobs(spark: SparkSession, blobs: DataFrame, tombstones: str) -> DataFrame:
    """Blobs but those whose last event is a delete (left anti)."""
    return blobs.join(tombstone_marks(spark, tombstones).where("gone").select("path"), "path", "left_anti")


def compact_tombstones(spark: SparkSession, tombstones: str, settled: int, blobs: DataFrame | None = None) -> int:
    """Fold the batches into one state and return its number of marks. No event with a sequence up to
    ``settled`` may still arrive: a mark up to it that shows its path has nothing left to hold off and goes,
    and so does a delete's whose object is no longer in ``blobs`` (if given). The folders folded by the
    compaction before this one are removed, so a reader that has listed them can finish."""
    root = tombstones.rstrip("/")
    batches = numbered_folders(spark, root, "_batch")
    before = numbered_folders(spark, f"{root}/_base", "v")
    marks = tombstone_marks(spark, root)
    keep = marks.where((F.col("seq") > settled) | F.col("gone"))
    if blobs is not None:
        there = blobs.select("path").distinct().withColumn("_there", F.lit(True))
        keep = keep.join(there, "path", "left").where((F.col("seq") > settled) | F.col("_there")).drop("_there")
    version = max([*batches, *before, -1])
    if version >= 0 and version not in before:
        keep.write.mode("overwrite").parquet(f"{root}/_base/v={version}")
        if before:
            drop_folders(spark, root, "_batch", before[-1] + 1)
            drop_folders(spark, f"{root}/_base", "v", before[-1])
    return tombstone_marks(spark, root).count()


def live_latest_stream(spark: SparkSession, frames: DataFrame, out_path: str, key: str = "device_id",
                       order: Sequence[str] = ("event_datetime", "name"), value: str = "img_path",
                       checkpoint: str | None = None, trigger: dict | None = None):
    """T-W5: per trigger, the newest frame of each key; emitted only when its
    ``value`` differs from the last one emitted for that key.

    State is a table with one row per key, versioned per batch (a new folder
    each time, so no path is overwritten while read). The batch is reduced
    with a keyed ``max_by`` first, so a hot key costs one row.
    """
    base = out_path.rstrip("/")
    cols = [key, *order, value]

    def process(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        newest = latest_per_key(batch.select(*cols), key, order)
        prev_dir = latest_version(spark, f"{base}/_state", batch_id)
        if prev_dir is not None:
            prev = spark.read.parquet(prev_dir)
        else:
            prev = spark.createDataFrame([], newest.schema)
        p = prev.select(key, F.col(value).alias("_last"), F.struct(*order).alias("_last_order"))
        j = newest.join(p, key, "left")
        fresh = j.filter(F.col("_last_order").isNull() | (F.struct(*order) > F.col("_last_order")))
        emit = fresh.filter(~F.col(value).eqNullSafe(F.col("_last"))).select(*cols)
        emit.write.mode("overwrite").parquet(f"{base}/_batch={batch_id}")
        state = keep_last(prev.unionByName(newest), key, list(order))
        state.write.mode("overwrite").parquet(f"{base}/_state/v={batch_id}")
        drop_folders(spark, f"{base}/_state", "v", batch_id - 1)  # a replay of this batch reads the one before
    return _start(frames.writeStream.foreachBatch(process), spark, checkpoint, trigger, "live", out_path)


def drop_expired(stream: DataFrame, time_col: str, ttl: str) -> DataFrame:
    """T-W6: keep only entries younger than ``ttl`` at processing time, with a
    watermark of the same length so any later state stays bounded."""
    return (stream.withWatermark(time_col, ttl)
            .filter(F.col(time_col) >= F.current_timestamp() - F.expr(f"INTERVAL {ttl}")))
