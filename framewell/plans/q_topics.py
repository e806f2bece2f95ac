"""Registered queries over row topics: counted reads with restarts, ids of appends, typed buffers, upserts over
several partitions."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from framewell.functions.timefmt import as_ntz
from framewell.plans import fixtures as fx
from framewell.plans.registry import query
from framewell.plans.sqlparts import BLOBS, META, with_
from framewell.session import scratch_path
from framewell.sinks.tables import read_keyed_table
from framewell.sinks.topics import append_buffer, append_topic
from framewell.sources.topics import consume, read_buffer_typed, read_topic_rows, topic_rows
from framewell.streaming.changes import cascade_stream, compact_tombstones, live_blobs
from framewell.streaming.ingest import ingest_frames

N_PARTITIONS = 4


def _until(q, batches: int | None) -> None:
    """Run a continuous query until it has done so many batches, or all there is, and stop it."""
    if batches is None:
        q.processAllAvailable()
    else:
        while q.isActive and (q.lastProgress is None or q.lastProgress["batchId"] + 1 < batches):
            q.awaitTermination(0.05)
    q.stop()
    if q.exception() is not None:
        raise q.exception()


@query("stream_rows", """
SELECT event_id, user_id, CAST(event_id % 4 AS INTEGER) AS partition,
       row_number() OVER (PARTITION BY event_id % 4 ORDER BY event_id) - 1 AS offset,
       CAST(1 AS BIGINT) AS n_seen, TRUE AS within_limit
FROM events""")
def q_stream_rows(spark, d):
    """The events as a topic of four partitions, read by a row limit a trigger; the query is
    stopped after two batches and goes on from its checkpoint."""
    base = scratch_path(spark, "stream_rows")
    ev = fx.table(spark, d, "events").select("event_id", "user_id")
    limit = max(100, ev.count() // 7)
    ordered = ev.withColumn("_p", F.col("event_id") % N_PARTITIONS).repartitionByRange("_p", "event_id").sortWithinPartitions("_p", "event_id")
    append_topic(ordered.select("event_id", "user_id"), f"{base}/topic", "user_id", partition=F.col("event_id") % N_PARTITIONS)

    def keep(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{base}/out/_batch={batch_id}")

    for batches in (2, None):
        src = read_topic_rows(spark, f"{base}/topic", "earliest", limit)
        _until(consume(src, keep, f"{base}/checkpoint", {"processingTime": "0 seconds"}), batches)
    seen = spark.read.parquet(f"{base}/out")
    # batches are few and of bounded size, so their sizes join back as a small table
    sizes = seen.groupBy("_batch").agg((F.count(F.lit(1)) <= limit).alias("within_limit"))
    row = F.from_json("value", "event_id long, user_id long")
    rows = seen.join(sizes, "_batch").select(row.alias("r"), "partition", "offset", "within_limit").select("r.*", "partition", "offset", "within_limit")
    return rows.groupBy("event_id", "user_id", "partition", "offset").agg(F.count(F.lit(1)).alias("n_seen"), F.min("within_limit").alias("within_limit"))


@query("append_ids", """
WITH halves AS (SELECT event_id, event_id % 2 AS half FROM events)
SELECT row_number() OVER (ORDER BY half, event_id) - 1 AS buffer_id, event_id, CAST(half AS INTEGER) AS append, TRUE AS stored
FROM halves""")
def q_append_ids(spark, d):
    """K6: two appends to one buffer; the ids given back are dense, disjoint and those stored."""
    path = scratch_path(spark, "append_ids")
    ev = fx.table(spark, d, "events").select("event_id")
    out = None
    for half in (0, 1):
        rows = ev.filter(F.col("event_id") % 2 == half).repartitionByRange("event_id").sortWithinPartitions("event_id")
        got = append_buffer(rows, path).withColumn("append", F.lit(half))
        out = got if out is None else out.unionAll(got)
    stored = topic_rows(spark, path).select(F.col("offset").alias("buffer_id"), F.col("value").alias("_v"))
    return out.join(stored, "buffer_id", "left").select(
        "buffer_id", F.from_json("value", "event_id long")["event_id"].alias("event_id"), "append", F.col("value").eqNullSafe(F.col("_v")).alias("stored"))


@query("typed_buffer", """
SELECT row_number() OVER (ORDER BY event_id) - 1 AS offset, event_type AS io_id, value, ts AS time FROM events""")
def q_typed_buffer(spark, d):
    """A buffer of point messages, pulled by a count, in the schema of its data type."""
    base = scratch_path(spark, "typed_buffer")
    points = fx.points(spark, d).repartitionByRange("event_id").sortWithinPartitions("event_id")
    append_buffer(points.select("io_id", "value", "timestamp"), f"{base}/buffer")
    src = read_buffer_typed(spark, f"{base}/buffer", "RAW", max(100, points.count() // 3))
    q = (src.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint")
         .trigger(processingTime="0 seconds").start())
    _until(q, None)
    out = spark.read.parquet(f"{base}/out")
    return out.select("offset", "io_id", "value", as_ntz(F.timestamp_seconds("timestamp")).alias("time"))


@query("stream_upsert_partitions", with_(META) + """,
last AS (SELECT name, device_id, img_path, event_datetime FROM meta WHERE event_id % 50 NOT IN (0, 2, 3)
         QUALIFY row_number() OVER (PARTITION BY name ORDER BY event_id DESC) = 1)
SELECT n_partitions, last.* FROM last CROSS JOIN (VALUES (1), (4), (9)) AS t(n_partitions)""")
def q_stream_upsert_partitions(spark, d):
    """K1/J2/T-W3: one topic in 1, 4 and 9 partitions, keyed by frame name and read by rows, gives one table.

    The messages are put in order and made once, every topic is written from them without another shuffle; the
    three consumers run side by side."""
    key = F.coalesce(F.get_json_object("value", "$.name"), F.lit(""))
    topic = fx.topic(spark, d, ordered=True).select("offset", "value", key.alias("_key")).persist(StorageLevel.DISK_ONLY)
    bases = {n: scratch_path(spark, "stream_upsert_partitions") for n in (1, 4, 9)}
    try:
        limit = max(100, -(-topic.count() // 2))
        for n, base in bases.items():
            append_topic(topic, f"{base}/topic", "_key", partition=F.pmod(F.xxhash64("_key"), F.lit(n)), value="value")
    finally:
        topic.unpersist()
    running: list = []
    try:
        for base in bases.values():
            src = read_topic_rows(spark, f"{base}/topic", "earliest", limit)
            running.append(ingest_frames(spark, src, f"{base}/images", f"{base}/blobs", f"{base}/rejects", n_buckets=8,
                                         trigger={"processingTime": "0 seconds"}))
        for q in running:
            _until(q, None)
    finally:
        for q in running:  # none goes on after another has failed
            q.stop()
    out = None
    for n, base in bases.items():
        t = read_keyed_table(spark, f"{base}/images").select(
            F.lit(n).alias("n_partitions"), "name", "device_id", "img_path", as_ntz("event_datetime").alias("event_datetime"))
        out = t if out is None else out.unionAll(t)
    return out


@query("stream_cascade_ordered", with_(BLOBS) + """
SELECT path, octet_length(content) AS n_bytes FROM blobs
WHERE CAST(split_part(split_part(path, '/', 2), '.', 1) AS BIGINT) % 6 NOT IN (0, 3, 5)""")
def q_stream_cascade_ordered(spark, d):
    """T-W7/M13: the last event of a path by the feed's sequence decides. By doc_id % 6: 0 deleted; 1 deleted,
    then written again; 2 written, an older delete arrives late; 3 written, then deleted; 4 no event; 5 deleted,
    written, deleted. The events arrive in two runs, the marks are compacted after each."""
    base = scratch_path(spark, "stream_cascade_ordered")
    sizes = fx.blobs(spark, d).select("path", F.octet_length("content").cast("bigint").alias("n_bytes"))
    k = F.split(F.split("path", "/")[1], r"\.")[0].cast("long")
    # (run that it arrives in, sequence within the path, operation)
    events = {0: [(0, 0, "delete")], 1: [(0, 0, "delete"), (1, 1, "insert")], 2: [(0, 1, "replace"), (1, 0, "delete")],
              3: [(0, 0, "update"), (1, 1, "delete")], 5: [(0, 0, "delete"), (0, 1, "insert"), (1, 2, "delete")]}
    table = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(r).alias("run"), F.lit(s).alias("s"), F.lit(op).alias("operation_type"))
                      for m, es in events.items() for r, s, op in es])
    doc = F.to_json(F.struct(F.col("path").alias("img_path")))
    gone = F.col("operation_type") == "delete"
    feed = (sizes.select("path", k.alias("k"), F.explode(F.filter(table, lambda e: e["m"] == k % 6)).alias("e")).select("path", "k", "e.*")
            .select("run", F.lit("images").alias("collection"), F.col("k").cast("string").alias("doc_id"), "operation_type",
                    (F.col("k") * 3 + F.col("s")).alias("seq"), F.when(gone, doc).alias("before_doc"), F.when(~gone, doc).alias("full_doc")))
    for run in (0, 1):
        append_topic(feed.where(F.col("run") == run).drop("run"), f"{base}/feed", "doc_id", 3)
        src = read_topic_rows(spark, f"{base}/feed", "earliest")
        env = src.select(F.from_json("value", "collection string, doc_id string, operation_type string, seq long, before_doc string, full_doc string").alias("e")).select("e.*")
        cascade_stream(spark, env, f"{base}/tombstones", checkpoint=f"{base}/checkpoint", trigger={"availableNow": True}, seq="seq").awaitTermination()
        # nothing is settled while late events may come
        compact_tombstones(spark, f"{base}/tombstones", settled=-1)
    return live_blobs(spark, sizes, f"{base}/tombstones")
