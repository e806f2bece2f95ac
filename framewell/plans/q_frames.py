"""Registered queries: frame parsing, validation, enrichment and ordering."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewell.functions.timefmt import as_ntz
from framewell.operators import ordering, parse
from framewell.plans import fixtures as fx
from framewell.plans.registry import query
from framewell.plans.sqlparts import FRAMES, META, with_

_CODE = "event_id % 50"

_PARSE_SQL = with_(FRAMES) + f"""
SELECT 0 AS partition, event_id AS offset,
       CASE WHEN {_CODE} = 0 THEN NULL ELSE device_id END AS device_id,
       CASE WHEN {_CODE} IN (0, 2) THEN NULL ELSE name END AS name,
       CASE WHEN {_CODE} IN (0, 1) THEN NULL ELSE timestamp END AS timestamp,
       CASE WHEN {_CODE} = 0 THEN NULL ELSE width END AS width,
       CASE WHEN {_CODE} = 0 THEN NULL ELSE height END AS height,
       CASE WHEN {_CODE} = 0 THEN NULL WHEN {_CODE} = 3 THEN '*' || img ELSE img END AS img,
       {_CODE} NOT IN (0, 1) AS parse_ok
FROM frames"""


@query("parse_frames", _PARSE_SQL)
def q_parse_frames(spark, d):
    """Topic JSON -> typed columns; bad text flagged, not dropped."""
    return parse.parse_messages(fx.topic(spark, d))


_VALIDATE_SQL = with_(FRAMES) + f"""
SELECT event_id AS offset, CASE WHEN {_CODE} = 0 THEN NULL ELSE device_id END AS device_id,
       CASE WHEN {_CODE} IN (0, 2) THEN NULL ELSE name END AS name,
       CASE WHEN {_CODE} = 0 THEN NULL ELSE timestamp END AS timestamp,
       CASE WHEN {_CODE} = 0 THEN false ELSE {_CODE} <> 2 AND {_CODE} <> 3 END AS valid,
       CASE WHEN {_CODE} = 0 THEN 'malformed message' WHEN {_CODE} = 2 THEN 'name is required'
            WHEN {_CODE} = 3 THEN 'img is not base64' ELSE '' END AS errors
FROM frames"""


@query("validate_frames", _VALIDATE_SQL)
def q_validate_frames(spark, d):
    """Every message checked; rejects carry their errors."""
    v = parse.validate_frames(fx.topic(spark, d), keep=["offset"])
    return v.select("offset", "device_id", "name", "timestamp", "valid",
                    F.array_join("errors", ";").alias("errors"))


@query("derive_metadata", with_(META) + """
SELECT event_id, device_id, name, timestamp, event_datetime, width, height, img_path FROM meta""")
def q_derive_metadata(spark, d):
    """P2/T1/T9 (processing time left out: it is not reproducible)."""
    m = parse.derive_metadata(fx.frames(spark, d).drop("img"), with_process_time=False)
    return m.select("event_id", "device_id", "name", "timestamp",
                    as_ntz("event_datetime").alias("event_datetime"), "width", "height", "img_path")


@query("keep_last", with_(FRAMES) + """
SELECT event_id, device_id, name, timestamp, width, height, img FROM frames
QUALIFY row_number() OVER (PARTITION BY name ORDER BY event_id DESC) = 1""")
def q_keep_last(spark, d):
    """Last arrival per name."""
    return ordering.keep_last(fx.frames(spark, d), "name", "event_id")


@query("latest_per_device", with_(META) + """
SELECT device_id, event_id, name, event_datetime, img_path FROM meta
QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY event_datetime DESC, name DESC) = 1""")
def q_latest_per_device(spark, d):
    """Newest frame of every device."""
    m = fx.frame_metadata(spark, d).select("device_id", "event_id", "name", "event_datetime", "img_path")
    return ordering.latest_per_key(m, "device_id", ("event_datetime", "name"))


@query("emit_on_change", with_(META) + """
SELECT event_id, device_id, img_path FROM (
  SELECT event_id, device_id, img_path,
         lag(img_path) OVER (PARTITION BY device_id ORDER BY event_datetime, event_id) AS prev
  FROM meta)
WHERE prev IS DISTINCT FROM img_path""")
def q_emit_on_change(spark, d):
    """Frames whose object path differs from the previous one of the device."""
    m = fx.frame_metadata(spark, d).select("event_id", "device_id", "event_datetime", "img_path")
    out = ordering.emit_on_change(m, "img_path", "device_id", ("event_datetime", "event_id"))
    return out.select("event_id", "device_id", "img_path")


@query("frame_sequence", with_(META) + """
SELECT event_id, device_id,
       row_number() OVER (PARTITION BY device_id ORDER BY event_datetime, event_id) - 1 AS frame_index
FROM meta""")
def q_frame_sequence(spark, d):
    """Playback index of each frame within its device."""
    m = fx.frame_metadata(spark, d).select("event_id", "device_id", "event_datetime")
    out = ordering.sequence_index(m, "device_id", ("event_datetime", "event_id"))
    return out.select("event_id", "device_id", "frame_index")


@query("count_batches", with_(META) + """
SELECT device_id, batch_no, count(*) AS n_frames, min(event_id) AS first_event_id,
       max(event_id) AS last_event_id
FROM (SELECT device_id, event_id,
             (row_number() OVER (PARTITION BY device_id ORDER BY event_datetime, event_id) - 1) // 50 AS batch_no
      FROM meta)
GROUP BY device_id, batch_no""")
def q_count_batches(spark, d):
    """Batches of at most 50 frames per device, in time order."""
    m = fx.frame_metadata(spark, d).select("event_id", "device_id", "event_datetime")
    b = ordering.count_batches(m, 50, "device_id", ("event_datetime", "event_id"))
    return b.groupBy("device_id", "batch_no").agg(
        F.count(F.lit(1)).alias("n_frames"), F.min("event_id").alias("first_event_id"),
        F.max("event_id").alias("last_event_id"))


@query("sliced_frames", """
WITH f AS (SELECT event_id, CASE WHEN user_id % 8 < 3 THEN 'hot' ELSE 'cam' || CAST(user_id % 8 AS VARCHAR) END AS device_id, event_type,
                  CASE WHEN event_id = (SELECT max(event_id) FROM events) THEN TIMESTAMP '2099-01-01 00:00:00'
                       ELSE TIMESTAMP '2024-01-01 00:00:00' + to_microseconds(epoch_us(ts) % 1000000) END AS t FROM events),
n AS (SELECT *, row_number() OVER w - 1 AS frame_index, lag(event_type) OVER w IS DISTINCT FROM event_type AS changed
      FROM f WINDOW w AS (PARTITION BY device_id ORDER BY t, event_id))
SELECT event_id, device_id, frame_index, frame_index // 50 AS batch_no, changed, TRUE AS even FROM n""")
def q_sliced_frames(spark, d):
    """W3-W5 with hot keys that are cut: a burst (all frames within one second, a third of one device) and
    one frame far off. ``even``: no slice has more than its depth of rows."""
    ev = fx.table(spark, d, "events").select("event_id", "user_id", "event_type", "ts")
    hot = F.when(F.col("user_id") % 8 < 3, F.lit("hot")).otherwise(F.concat(F.lit("cam"), (F.col("user_id") % 8).cast("string")))
    micros = F.unix_micros(F.col("ts").cast("timestamp")) % 1_000_000
    last = F.col("event_id") == ev.select(F.max("event_id")).scalar()
    base = F.unix_micros(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    t = F.when(last, F.lit("2099-01-01 00:00:00").cast("timestamp")).otherwise(F.timestamp_micros(base + micros))
    f = ev.select("event_id", hot.alias("device_id"), "event_type", t.alias("t"))
    depth = 100
    order = ("t", "event_id")
    numbered = ordering.count_batches(ordering.sequence_index(f, "device_id", order, min_rows=depth), 50, "device_id", order, min_rows=depth)
    changed = ordering.emit_on_change(f, "event_type", "device_id", order, min_rows=depth).select("event_id", F.lit(True).alias("changed"))
    slices = ordering.adaptive_slices(f, ["device_id"], order, depth)
    bound = F.greatest(F.lit(depth), F.sqrt(slices.groupBy("device_id").count().select(F.max("count")).scalar()))
    even = slices.groupBy("device_id", "_b").agg(F.count(F.lit(1)).alias("n")).groupBy("device_id").agg((F.max("n") <= bound).alias("even"))
    return (numbered.join(changed, "event_id", "left").join(even, "device_id")
            .select("event_id", "device_id", "frame_index", "batch_no", F.coalesce("changed", F.lit(False)).alias("changed"), "even"))


@query("stored_view", with_(META) + """
SELECT CAST(event_id AS VARCHAR) AS _id, device_id, name, img_path,
       CASE WHEN date_part('microseconds', event_datetime) % 1000000 = 0
            THEN strftime(event_datetime, '%Y-%m-%d %H:%M:%S')
            ELSE strftime(event_datetime, '%Y-%m-%d %H:%M:%S.%f') END AS event_datetime
FROM meta""")
def q_stored_view(spark, d):
    """Payload columns dropped (missing ones ignored), key exposed as
    ``_id``, non-JSON types rendered as text."""
    m = parse.derive_metadata(fx.frames(spark, d), with_process_time=False)
    m = parse.drop_columns(m, "img", "start_time", "timestamp", "width", "height")
    out = parse.rename_with_alias(m, "event_id", "_id", stringify=("_id", "event_datetime"))
    return out.select("_id", "device_id", "name", "img_path", "event_datetime")
