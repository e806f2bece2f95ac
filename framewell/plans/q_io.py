"""Registered queries over sources and sinks: collections, users, stored points, stored blobs, the relay."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewell.functions.codec import b64decode_lenient
from framewell.functions.timefmt import as_ntz
from framewell.operators.parse import project_model, split_rejects, validate_frames
from framewell.operators.series import to_points
from framewell.plans import fixtures as fx
from framewell.plans.registry import query
from framewell.plans.sqlparts import FRAMES, META, POINTS, USERS, with_
from framewell.session import scratch_path
from framewell.sinks.blobs import write_blobs
from framewell.sinks.tables import write_points
from framewell.sinks.topics import append_topic
from framewell.sources.blobs import read_blob_table
from framewell.sources.tables import read_collection, read_users
from framewell.sources.topics import read_buffer
from framewell.streaming.ingest import relay_buffer


@query("open_collection", "SELECT o_orderkey, o_orderstatus FROM orders")
def q_open_collection(spark, d):
    """A collection by path; only the named columns are read."""
    return read_collection(spark, f"{d.rstrip('/')}/orders.parquet", ["o_orderkey", "o_orderstatus"])


@query("users_by_id", with_(USERS) + " SELECT id, email, is_active FROM users WHERE id IN (SELECT n_nationkey * 3 FROM nation)")
def q_users_by_id(spark, d):
    """Users of a list of ids, in their public form."""
    path = scratch_path(spark, "users")
    fx.users(spark, d).write.parquet(path)
    ids = [r.k * 3 for r in fx.table(spark, d, "nation").select(F.col("n_nationkey").alias("k")).collect()]  # the request
    return project_model(read_users(spark, path, ids), "UserRead")


@query("stored_points", with_(POINTS) + " SELECT 'test' AS measurement, io_id, time, value FROM points")
def q_stored_points(spark, d):
    """K5: the points of all series stored in one pass and read back."""
    path = scratch_path(spark, "points")
    write_points(to_points(fx.points(spark, d)), path)
    return spark.read.parquet(path).select("measurement", F.col("io_id").cast("string").alias("io_id"), as_ntz("time").alias("time"), "value")


@query("stored_blobs", with_(FRAMES) + """,
good AS (SELECT *, event_id % 2 AS run FROM frames WHERE event_id % 50 NOT IN (0, 2, 3))
SELECT device_id || '/' || name AS path, octet_length(from_base64(img)) AS n_bytes, sha256(from_base64(img)) AS sha256, device_id FROM good
QUALIFY row_number() OVER (PARTITION BY device_id, name ORDER BY run DESC, event_id DESC) = 1""")
def q_stored_blobs(spark, d):
    """Payloads of two batches stored by path; a later write replaces an earlier one."""
    root = scratch_path(spark, "blobs")
    good, _ = split_rejects(validate_frames(fx.topic(spark, d), keep=["offset"]))
    for run in (0, 1):
        write_blobs(good.where(F.col("offset") % 2 == run), root, run)
    b = read_blob_table(spark, root)
    return b.select("path", F.octet_length("content").cast("bigint").alias("n_bytes"), F.sha2("content", 256).alias("sha256"), F.col("device_id").cast("string").alias("device_id"))


@query("lenient_blobs", with_(FRAMES) + """
SELECT event_id, CASE WHEN event_id % 4 = 3 THEN NULL ELSE decode(from_base64(img)) END AS text FROM frames""")
def q_lenient_blobs(spark, d):
    """Payload text with foreign characters, line breaks or bytes after its end, and text that is cut short, as a
    lenient decoder reads it."""
    f = fx.frames(spark, d)
    m = F.col("event_id") % 4
    img = F.regexp_replace("img", r"[\r\n]", "")
    text = (F.when(m == 0, F.concat(F.lit("*"), F.regexp_replace(img, "(.)", "$1\n"))).when(m == 1, F.concat(img, F.when(img.endswith("="), F.lit("QUJD")).otherwise(F.lit("===="))))
            .when(m == 2, img).otherwise(F.concat(F.regexp_replace(img, "=", ""), F.substring(F.lit("QQQ"), F.lit(1), F.lit(5) - F.length(F.regexp_replace(img, "=", "")) % 4))))
    return f.select("event_id", F.decode(b64decode_lenient(text), "UTF-8").alias("text"))


@query("relay_stream", with_(META) + """
SELECT device_id AS key, '{"event_id":' || event_id || ',"device_id":"' || device_id || '"}' AS value FROM meta""")
def q_relay_stream(spark, d):
    """T-W4/S5/K4: a buffer forwarded to a topic, a count at a time, until it is empty."""
    base = scratch_path(spark, "relay")
    rows = fx.frame_metadata(spark, d).select("event_id", "device_id")
    append_topic(rows, f"{base}/buffer")
    buffer = read_buffer(spark, f"{base}/buffer", max(100, rows.count() // 3)).select(F.from_json("value", "event_id long, device_id string").alias("m")).select("m.*")
    q = relay_buffer(spark, buffer, f"{base}/topic", key="device_id")
    q.processAllAvailable()
    q.stop()
    return spark.read.schema("key string, value string").json(f"{base}/topic")
