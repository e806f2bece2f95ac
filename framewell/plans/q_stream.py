"""Registered streaming queries: file-backed topics derived from the tables
run through the checkpointed streaming flows to completion (availableNow),
then the sink tables are read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewell.functions.timefmt import as_ntz, epoch_to_timestamp
from framewell.operators.parse import derive_metadata, split_rejects, validate_frames
from framewell.plans import fixtures as fx
from framewell.plans.registry import query
from framewell.plans.sqlparts import BLOBS, CHANGES, META, with_
from framewell.session import scratch_path
from framewell.sinks.entries import append_entries, read_entries, trim_entries
from framewell.sinks.tables import read_keyed_table
from framewell.sinks.topics import append_topic
from framewell.sources.tables import read_changes
from framewell.sources.topics import consume, read_topic_files, read_topic_rows, write_topic_files
from framewell.streaming.changes import cascade_stream, live_blobs, live_latest_stream, route_changes
from framewell.streaming.collect import collect_ordered, read_batches
from framewell.streaming.ingest import archive_stream, ingest_frames
from framewell.streaming.metrics import fps_stream, latency_stream, read_histogram, read_latency, read_window_counts

_ONCE = {"availableNow": True}
_LAT_STREAM = """
lat AS (SELECT 'cam' || CAST(user_id % 8 AS VARCHAR) AS device_id, value AS x FROM events)"""

# Envelope as it sits on the topic: document parts are JSON text.
ENVELOPE_TEXT = T.StructType([
    T.StructField("collection", T.StringType()), T.StructField("doc_id", T.StringType()),
    T.StructField("operation_type", T.StringType()), T.StructField("update_content", T.StringType()),
    T.StructField("removed_fields", T.ArrayType(T.StringType())),
    T.StructField("truncated_arrays", T.ArrayType(T.StringType())),
    T.StructField("before_doc", T.StringType()), T.StructField("full_doc", T.StringType())])


@query("stream_upsert", with_(META) + """
SELECT name, device_id, img_path, event_id AS offset, event_datetime FROM meta
WHERE event_id % 50 NOT IN (0, 2, 3)
QUALIFY row_number() OVER (PARTITION BY name ORDER BY event_id DESC) = 1""")
def q_stream_upsert(spark, d):
    """T-W3/K1/K2/C2: topic -> validated micro-batches -> blobs + keyed upsert."""
    base = scratch_path(spark, "stream_upsert")
    write_topic_files(fx.topic(spark, d), f"{base}/topic", n_files=4)
    src = read_topic_files(spark, f"{base}/topic", max_files_per_trigger=2)
    q = ingest_frames(spark, src, f"{base}/images", f"{base}/blobs", f"{base}/rejects",
                      trigger=_ONCE, n_buckets=16, metrics_path=f"{base}/metrics")
    q.awaitTermination()
    t = read_keyed_table(spark, f"{base}/images")
    return t.select("name", "device_id", "img_path", "offset", as_ntz("event_datetime").alias("event_datetime"))


ARCHIVE_MODEL = T.StructType([T.StructField("name", T.StringType()), T.StructField("category", T.StringType()),
                              T.StructField("value", T.DoubleType())])


@query("stream_archive", """
SELECT event_id AS offset,
       'cam' || CAST(user_id % 8 AS VARCHAR) || '_' || json_extract_string(props, '$.k') || '.jpg' AS name,
       event_type AS category, value, ts AS event_datetime, strftime(ts, '%Y_%m_%d') AS dt
FROM events WHERE event_id % 40 <> 0""")
def q_stream_archive(spark, d):
    """Archive topic -> parsed -> Parquet under category/dt folders."""
    base = scratch_path(spark, "stream_archive")
    write_topic_files(fx.archive_events(spark, d), f"{base}/topic", n_files=4)
    src = read_topic_files(spark, f"{base}/topic", max_files_per_trigger=2)
    q = archive_stream(spark, src, ARCHIVE_MODEL, f"{base}/archive", trigger=_ONCE)
    q.awaitTermination()
    out = spark.read.parquet(f"{base}/archive")
    return out.select("offset", "name", "category", "value",
                      as_ntz("event_datetime").alias("event_datetime"), F.col("dt").cast("string").alias("dt"))


@query("stream_archive_rejects", """
SELECT event_id AS offset FROM events WHERE event_id % 40 = 0""")
def q_stream_archive_rejects(spark, d):
    """The archive topic's messages without a valid time."""
    base = scratch_path(spark, "stream_archive_rejects")
    write_topic_files(fx.archive_events(spark, d), f"{base}/topic", n_files=4)
    src = read_topic_files(spark, f"{base}/topic", max_files_per_trigger=2)
    archive_stream(spark, src, ARCHIVE_MODEL, f"{base}/archive", trigger=_ONCE,
                   rejects_path=f"{base}/rejects").awaitTermination()
    return spark.read.parquet(f"{base}/rejects").select("offset")


@query("stream_fps", with_(META) + """
SELECT device_id, date_trunc('second', event_datetime) AS second, count(*) AS fps
FROM meta WHERE event_id % 50 NOT IN (0, 2, 3)
GROUP BY device_id, date_trunc('second', event_datetime)""")
def q_stream_fps(spark, d):
    """T-W2 stream form: per-second frame counts, added up over micro-batches."""
    base = scratch_path(spark, "stream_fps")
    write_topic_files(fx.topic(spark, d), f"{base}/topic", n_files=4)
    src = read_topic_files(spark, f"{base}/topic", max_files_per_trigger=2)
    good, _ = split_rejects(validate_frames(src, keep=["offset"]))
    frames = good.withColumn("event_time", epoch_to_timestamp("timestamp"))
    q = fps_stream(spark, frames, "event_time", f"{base}/fps", trigger=_ONCE)
    q.awaitTermination()
    out = read_window_counts(spark, f"{base}/fps")
    return out.select("device_id", as_ntz("second").alias("second"), "fps")


_GOOD = "event_id % 50 NOT IN (0, 2, 3)"
_SPLIT = "TIMESTAMP '2024-01-16 00:00:00'"


@query("stream_live", with_(META) + f""",
good AS (SELECT * FROM meta WHERE {_GOOD}),
h1 AS (SELECT * FROM good WHERE event_datetime < {_SPLIT}
       QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY event_datetime DESC, name DESC) = 1),
h2 AS (SELECT * FROM good WHERE event_datetime >= {_SPLIT}
       QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY event_datetime DESC, name DESC) = 1)
SELECT device_id, event_datetime, name, img_path FROM h1
UNION ALL
SELECT h2.device_id, h2.event_datetime, h2.name, h2.img_path FROM h2 LEFT JOIN h1 USING (device_id)
WHERE h1.img_path IS DISTINCT FROM h2.img_path""")
def q_stream_live(spark, d):
    """T-W5: newest frame per device, emitted when it changed; two arrivals
    (first half of the month, then the rest) through one checkpoint."""
    base = scratch_path(spark, "stream_live")
    topic = fx.topic(spark, d)
    ev = fx.table(spark, d, "events").select(F.col("event_id").alias("offset"), "ts")
    topic = topic.join(ev, "offset")
    split = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    ckpt = f"{base}/checkpoint"
    for part in (topic.filter(F.col("ts") < split), topic.filter(F.col("ts") >= split)):
        write_topic_files(part.drop("ts"), f"{base}/topic", n_files=2)
        src = read_topic_files(spark, f"{base}/topic")
        good, _ = split_rejects(validate_frames(src, keep=["offset"]))
        frames = derive_metadata(good.drop("img"), with_process_time=False)
        live_latest_stream(spark, frames, f"{base}/live", checkpoint=ckpt, trigger=_ONCE).awaitTermination()
    out = spark.read.parquet(f"{base}/live")
    return out.select("device_id", as_ntz("event_datetime").alias("event_datetime"), "name", "img_path")


@query("stream_cascade", with_(CHANGES, BLOBS) + """
SELECT path, octet_length(content) AS n_bytes FROM blobs
WHERE path NOT IN (SELECT before_img_path FROM envelope
                   WHERE collection = 'images' AND operation_type = 'delete'
                     AND before_img_path IS NOT NULL AND before_img_path <> '')""")
def q_stream_cascade(spark, d):
    """T-W7/S4/F3/P5/T12/M13: change records -> envelope topic -> consumer
    routes deletes -> tombstones -> live blobs."""
    base = scratch_path(spark, "stream_cascade")
    fx.changes(spark, d).repartition(4).write.json(f"{base}/changes")
    raw = read_changes(spark, f"{base}/changes", ["images", "other"])
    route_changes(spark, raw, f"{base}/topic", trigger=_ONCE,
                  checkpoint=f"{base}/ck_route").awaitTermination()
    env = spark.readStream.schema(ENVELOPE_TEXT).json(f"{base}/topic")
    env = env.withColumn("before_doc", F.from_json("before_doc", "img_path string"))
    cascade_stream(spark, env, f"{base}/tombstones", trigger=_ONCE,
                   checkpoint=f"{base}/ck_cascade").awaitTermination()
    sizes = fx.blobs(spark, d).select("path", F.octet_length("content").cast("bigint").alias("n_bytes"))
    return live_blobs(spark, sizes, f"{base}/tombstones")


@query("stream_collect", with_(META) + f"""
SELECT device_id, event_id, (row_number() OVER w - 1) // 50 AS batch_no, (row_number() OVER w - 1) % 50 AS position,
       CASE WHEN (row_number() OVER w - 1) // 50 < count(*) OVER (PARTITION BY device_id) // 50 THEN 'size' ELSE 'timeout' END AS flushed_by
FROM meta WHERE {_GOOD} WINDOW w AS (PARTITION BY device_id ORDER BY event_id)""")
def q_stream_collect(spark, d):
    """T-W1: batches of 50 frames per device in arrival order over several triggers; a closing message's time is
    past the timeout of what is left, which is flushed as partial batches."""
    base = scratch_path(spark, "stream_collect")
    topic = fx.topic(spark, d).select("offset", "value")
    row = F.struct(F.col("offset").alias("event_id"), "value")
    device = F.coalesce(F.get_json_object("value", "$.device_id"), F.lit(""))
    part = F.pmod(F.xxhash64(device), F.lit(4))
    ordered = topic.select("offset", part.alias("_p"), F.to_json(row).alias("value")).repartitionByRange("_p", "offset").sortWithinPartitions("_p", "offset")
    append_topic(ordered, f"{base}/topic", partition=F.col("_p"), value="value")
    closing = fx.topic(spark, d).orderBy("offset").limit(1).select(F.to_json(F.struct(F.lit(-1).alias("event_id"), F.to_json(F.struct(
        F.lit("closing").alias("device_id"), F.lit("end").alias("name"), F.lit(4102444800.0).alias("timestamp"),
        F.lit("1").alias("width"), F.lit("1").alias("height"), F.lit("").alias("img"))).alias("value"))).alias("value"))
    limit = max(100, topic.count() // 3)
    for last in (False, True):
        if last:
            append_topic(closing, f"{base}/topic", value="value")
        src = read_topic_rows(spark, f"{base}/topic", "earliest", limit)
        messages = src.select(F.from_json("value", "event_id long, value string").alias("m")).select("m.event_id", "m.value")
        good, _ = split_rejects(validate_frames(messages, keep=["event_id"]))
        frames = good.withColumn("event_time", epoch_to_timestamp("timestamp"))
        q = collect_ordered(spark, frames, f"{base}/out", "device_id", ["event_id"], 50, "event_id", "event_time",
                            timeout_seconds=400 * 86400, trigger={"processingTime": "0 seconds"}, min_rows=500)
        q.processAllAvailable()
        q.stop()
    return read_batches(spark, f"{base}/out").where("device_id != 'closing'")


@query("stream_latency", with_(_LAT_STREAM) + """
SELECT device_id, count(*) AS n, round(avg(x), 6) AS avg_latency, min(x) AS min_latency, max(x) AS max_latency,
       CAST(count_if(x <= 10) AS BIGINT) AS le_10, CAST(count_if(x <= 50) AS BIGINT) AS le_50, TRUE AS p50_ok, TRUE AS p90_ok, TRUE AS p99_ok
FROM lat GROUP BY device_id""")
def q_stream_latency(spark, d):
    """A8/A9 over a stream: counts, means, extremes and buckets exact, percentiles from merged sketches: ``ok`` if the
    rank of the value among all values is within 1 % of the percentile's."""
    base = scratch_path(spark, "stream_latency")
    ev = fx.table(spark, d, "events").select(F.concat(F.lit("cam"), (F.col("user_id") % 8).cast("string")).alias("device_id"), F.col("value").alias("x"))
    append_topic(ev, f"{base}/topic", "device_id", 4)
    src = read_topic_rows(spark, f"{base}/topic", "earliest", max(100, ev.count() // 4))
    rows = src.select(F.from_json("value", "device_id string, x double").alias("m")).select("m.*")
    q = latency_stream(spark, rows, "x", f"{base}/latency", ["device_id"], [10, 50], trigger={"processingTime": "0 seconds"})
    q.processAllAvailable()
    q.stop()
    keys = ["device_id"]
    stats = read_latency(spark, f"{base}/latency", keys)
    buckets = read_histogram(spark, f"{base}/latency", [10, 50], keys).groupBy(*keys).pivot("le", ["10", "50"]).agg(F.first("count"))
    # few rows of statistics join all values to find the rank that each percentile really has
    ranks = ev.join(F.broadcast(stats), keys).groupBy(*keys).agg(*[
        ((F.avg((F.col("x") < F.col(f"p{p}_latency")).cast("double")) - 0.01 <= p / 100)
         & (F.avg((F.col("x") <= F.col(f"p{p}_latency")).cast("double")) + 0.01 >= p / 100)).alias(f"p{p}_ok") for p in (50, 90, 99)])
    return stats.join(buckets, keys).join(ranks, keys).select(
        "device_id", "n", F.round("avg_latency", 6).alias("avg_latency"), "min_latency", "max_latency",
        F.col("10").alias("le_10"), F.col("50").alias("le_50"), "p50_ok", "p90_ok", "p99_ok")


@query("stream_retention", """
WITH e AS (SELECT event_id, ts, (row_number() OVER (ORDER BY event_id) - 1) // ((SELECT count(*) + 2 FROM events) // 3) + 1 AS run FROM events),
m AS (SELECT run, max(max(ts)) OVER (ORDER BY run) AS newest FROM e GROUP BY run),
s AS (SELECT m.run, count(*) AS stored FROM m JOIN e ON e.run <= m.run AND e.ts >= m.newest - INTERVAL 36 HOUR GROUP BY m.run),
a AS (SELECT run, count(*) AS added FROM e GROUP BY run)
SELECT CAST(run AS INTEGER) AS run, stored, added + coalesce(lag(stored) OVER (ORDER BY run), 0) - stored AS removed FROM s JOIN a USING (run)""")
def q_stream_retention(spark, d):
    """T-W6/F11: entries stored by time slots and trimmed after each of three triggers to the last 36 hours; what is stored
    and how many entries each trim removed."""
    base = scratch_path(spark, "stream_retention")
    ev = fx.table(spark, d, "events").select("event_id", "ts")
    limit = -(-ev.count() // 3)
    append_topic(ev.repartitionByRange("event_id").sortWithinPartitions("event_id"), f"{base}/topic")
    width, out = 6 * 3600, []

    def keep(batch, batch_id):
        rows = batch.select(F.from_json("value", "event_id long, ts timestamp_ntz").alias("m")).select("m.*")
        append_entries(rows, f"{base}/entries", "ts", width, batch_id)
        removed = trim_entries(spark, f"{base}/entries", "ts", 36 * 3600, width)
        out.append((batch_id + 1, read_entries(spark, f"{base}/entries").count(), removed))

    q = consume(read_topic_rows(spark, f"{base}/topic", "earliest", limit), keep, f"{base}/ck", {"processingTime": "0 seconds"})
    q.processAllAvailable()
    q.stop()
    return spark.createDataFrame(out, "run int, stored long, removed long")
