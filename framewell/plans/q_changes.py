"""Registered queries: change envelope, routing, cascade and blob joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewell.functions.codec import b64decode
from framewell.operators import blobs as bl
from framewell.operators import changes as ch
from framewell.plans import fixtures as fx
from framewell.plans.registry import query
from framewell.plans.sqlparts import BLOBS, CHANGES, FRAMES, IMAGES, with_
from framewell.sinks.topics import to_topic_value


def _envelope(spark, d):
    return ch.change_envelope(ch.filter_changes(fx.changes(spark, d), ["images", "other"]))


@query("change_envelope", with_(CHANGES) + """
SELECT collection, doc_id, operation_type, before_img_path, full_img_path,
       CASE WHEN operation_type = 'update' THEN o_orderstatus END AS updated_status
FROM envelope WHERE collection IN ('images', 'other') AND operation_type IN ('insert', 'update', 'delete', 'replace')""")
def q_change_envelope(spark, d):
    """Watched, forwarded changes as the 8-field envelope."""
    e = _envelope(spark, d)
    return e.select("collection", "doc_id", "operation_type",
                    F.col("before_doc.img_path").alias("before_img_path"),
                    F.col("full_doc.img_path").alias("full_img_path"),
                    F.col("update_content").getItem("status").alias("updated_status"))


@query("change_json", with_(CHANGES) + """
SELECT doc_id,
       CASE WHEN operation_type IN ('delete', 'update') THEN
         '{"_id":"' || doc_id || '","img_path":' || CASE WHEN before_img_path IS NULL THEN 'null' ELSE '"' || before_img_path || '"' END
         || ',"updated_datetime":"' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') || '"}' END AS before_json
FROM envelope WHERE collection = 'images' AND operation_type IN ('insert', 'update', 'delete', 'replace')""")
def q_change_json(spark, d):
    """Before-image as JSON text (microsecond time text, nulls kept)."""
    e = ch.change_envelope(ch.filter_changes(fx.changes(spark, d), ["images"]), as_json=True)
    return e.select("doc_id", F.col("before_doc").alias("before_json"))


@query("route_by_operation", with_(CHANGES) + """
SELECT doc_id, operation_type,
       CASE WHEN operation_type = 'delete' AND before_img_path IS NOT NULL AND before_img_path <> '' THEN 'delete_blob'
            WHEN operation_type = 'delete' THEN 'none'
            WHEN operation_type IN ('insert', 'update', 'replace') THEN 'noop_' || operation_type
            ELSE 'ignore' END AS action
FROM envelope WHERE collection = 'images' AND operation_type IN ('insert', 'update', 'delete', 'replace')""")
def q_route_by_operation(spark, d):
    """the handler's action per event of the images collection."""
    return ch.route_by_operation(_envelope(spark, d)).select("doc_id", "operation_type", "action")


@query("cascade_delete", with_(CHANGES, BLOBS) + """
SELECT path, octet_length(content) AS n_bytes FROM blobs
WHERE path NOT IN (SELECT before_img_path FROM envelope
                   WHERE collection = 'images' AND operation_type = 'delete'
                     AND before_img_path IS NOT NULL AND before_img_path <> '')""")
def q_cascade_delete(spark, d):
    """Blobs left after deleted documents release theirs."""
    sizes = fx.blobs(spark, d).select("path", F.octet_length("content").cast("bigint").alias("n_bytes"))
    return ch.cascade_delete(sizes, _envelope(spark, d))


@query("orphan_blobs", with_(IMAGES, BLOBS) + """
SELECT path, device_id FROM blobs WHERE path NOT IN (SELECT img_path FROM images)""")
def q_orphan_blobs(spark, d):
    """Blobs no image document references."""
    return ch.orphan_blobs(fx.blobs(spark, d), fx.images(spark, d)).select("path", "device_id")


@query("metadata_with_blob", with_(IMAGES, BLOBS) + """
SELECT i._id, i.device_id, i.img_path, 'image/jpeg' AS mime_type, octet_length(b.content) AS n_bytes,
       sha256(b.content) AS sha256
FROM images i JOIN blobs b ON i.img_path = b.path""")
def q_metadata_with_blob(spark, d):
    """Each image document with its stored object (size and digest)."""
    out = bl.metadata_with_blob(fx.images(spark, d).select("_id", "device_id", "img_path"), fx.blobs(spark, d))
    return out.select("_id", "device_id", "img_path", "mime_type", "n_bytes", "sha256")


@query("filter_images", with_(BLOBS) + """
SELECT path, CASE WHEN path LIKE '%.jpg' THEN 'image/jpeg' ELSE 'image/png' END AS mime_type,
       octet_length(content) AS n_bytes
FROM blobs WHERE path LIKE '%.jpg' OR path LIKE '%.png'""")
def q_filter_images(spark, d):
    """Image objects only, by name-guessed MIME type."""
    out = bl.filter_images(fx.blobs(spark, d))
    return out.select("path", "mime_type", F.octet_length("content").cast("bigint").alias("n_bytes"))


@query("decode_blob", with_(FRAMES) + """
SELECT device_id || '/' || name AS img_path, octet_length(from_base64(img)) AS n_bytes,
       decode(from_base64(img)) AS text, event_id
FROM frames""")
def q_decode_blob(spark, d):
    """Frame payload decoded to the bytes stored at '{device}/{name}'."""
    f = fx.frames(spark, d)
    content = b64decode("img")
    return f.select(F.concat("device_id", F.lit("/"), "name").alias("img_path"),
                    F.octet_length(content).cast("bigint").alias("n_bytes"),
                    F.decode(content, "UTF-8").alias("text"), "event_id")


@query("change_topic", with_(CHANGES) + """
SELECT doc_id AS key,
       '{"collection":"' || collection || '","doc_id":"' || doc_id || '","operation_type":"' || operation_type
       || '","before_img_path":' || coalesce('"' || before_img_path || '"', 'null') || '}' AS value
FROM envelope WHERE collection IN ('images', 'other') AND operation_type IN ('insert', 'update', 'delete', 'replace')""")
def q_change_topic(spark, d):
    """K4: envelope rows as (key, JSON value) ready for the topic writer."""
    e = _envelope(spark, d).select("collection", "doc_id", "operation_type",
                                   F.col("before_doc.img_path").alias("before_img_path"))
    return to_topic_value(e, key="doc_id")


@query("referenced_blobs", with_(IMAGES, BLOBS) + """
SELECT path, device_id FROM blobs WHERE path IN (SELECT img_path FROM images)""")
def q_referenced_blobs(spark, d):
    """J3 complement: blobs some image document references (left semi)."""
    return ch.referenced_blobs(fx.blobs(spark, d), fx.images(spark, d)).select("path", "device_id")
