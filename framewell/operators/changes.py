"""Change events: filter, envelope, routing and the blob cascade (S4, F3-F5,
F7, P5, T12, M13, J3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewell.functions.codec import encode_json

# Operation types the change feed forwards.
FORWARDED_OPERATIONS = ["insert", "update", "delete", "replace"]


def filter_changes(raw: DataFrame, watch: Sequence[str]) -> DataFrame:
    """watched collections and forwarded operation types only."""
    return raw.filter(F.col("ns.coll").isin(list(watch))
                      & F.col("operationType").isin(FORWARDED_OPERATIONS))


def change_envelope(raw: DataFrame, as_json: bool = False) -> DataFrame:
    """P5: the 8-field envelope; absent sections give nulls.

    With ``as_json`` the document parts are JSON text with microsecond
    times and nulls kept (T12), as they go onto the topic.
    """
    def part(c: str) -> Column:
        return encode_json(F.col(c)) if as_json else F.col(c)
    return raw.select(
        F.col("ns.coll").alias("collection"),
        F.col("documentKey._id").alias("doc_id"),
        F.col("operationType").alias("operation_type"),
        (encode_json(F.col("updateDescription.updatedFields")) if as_json
         else F.col("updateDescription.updatedFields")).alias("update_content"),
        F.col("updateDescription.removedFields").alias("removed_fields"),
        F.col("updateDescription.truncatedArrays").alias("truncated_arrays"),
        part("fullDocumentBeforeChange").alias("before_doc"),
        part("fullDocument").alias("full_doc"),
    )


def is_present(col) -> Column:
    """not null and not empty."""
    c = F.col(col) if isinstance(col, str) else col
    return c.isNotNull() & (c != F.lit(""))


def document_field(env: DataFrame, path: str) -> Column:
    """The text of a field of an envelope's document, given as struct, VARIANT or JSON text; null if the
    document or the field is missing."""
    part, name = path.split(".", 1)
    kind = env.schema[part].dataType
    if isinstance(kind, T.VariantType):
        return F.try_variant_get(part, f"$.{name}", "string")
    if isinstance(kind, T.StringType):
        return F.get_json_object(part, f"$.{name}")
    return F.col(path)


def route_by_operation(env: DataFrame, collection: str = "images",
                       path_field: str = "before_doc.img_path") -> DataFrame:
    """events of one collection with the action their handler takes.

    delete with a non-empty before-image path -> 'delete_blob'; insert,
    update, replace -> no-op hooks; anything else -> 'ignore'.
    """
    op = F.col("operation_type")
    action = (F.when((op == "delete") & is_present(document_field(env, path_field)), F.lit("delete_blob"))
              .when(op == "delete", F.lit("none"))
              .when(op.isin("insert", "update", "replace"), F.concat(F.lit("noop_"), op))
              .otherwise(F.lit("ignore")))
    return env.filter(F.col("collection") == collection).withColumn("action", action)


def deleted_paths(env: DataFrame, collection: str = "images",
                  path_field: str = "before_doc.img_path") -> DataFrame:
    """Object paths that delete events of ``collection`` release."""
    routed = route_by_operation(env, collection, path_field)
    return routed.filter(F.col("action") == "delete_blob").select(document_field(env, path_field).alias("path"))


def path_events(env: DataFrame, seq: Column, collection: str = "images", before: str = "before_doc.img_path",
                full: str = "full_doc.img_path") -> DataFrame:
    """(path, seq, gone) of every event of ``collection`` that names an object path: a delete by its
    before-image, an insert, update or replace by its document."""
    op = F.col("operation_type")
    gone = op == "delete"
    shown = op.isin("insert", "update", "replace")
    full_path = document_field(env, full) if full.split(".")[0] in env.columns else F.lit(None).cast("string")
    path = F.when(gone, document_field(env, before)).when(shown, full_path)
    rows = env.filter(F.col("collection") == collection).select(path.alias("path"), seq.alias("seq"), gone.alias("gone"))
    return rows.filter(is_present("path"))


def cascade_delete(blobs: DataFrame, env: DataFrame, collection: str = "images",
                   path_field: str = "before_doc.img_path") -> DataFrame:
    """Remove the blobs whose metadata documents were deleted.

    A left-anti join on the path. The path side is tiny next to the blobs
    (and AQE broadcasts it when it is), so blob bytes are not shuffled then.
    """
    gone = deleted_paths(env, collection, path_field).distinct()
    return blobs.join(gone, "path", "left_anti")


def orphan_blobs(blobs: DataFrame, images: DataFrame, path_col: str = "img_path") -> DataFrame:
    """Blobs that no metadata document references (left anti).

    The referenced paths are de-duplicated first (partial aggregation), so a
    path shared by many documents costs one row in the join.
    """
    refs = images.select(F.col(path_col).alias("path")).filter(F.col("path").isNotNull()).distinct()
    return blobs.join(refs, "path", "left_anti")


def referenced_blobs(blobs: DataFrame, images: DataFrame, path_col: str = "img_path") -> DataFrame:
    """J3 complement: blobs some document references (left semi)."""
    refs = images.select(F.col(path_col).alias("path")).distinct()
    return blobs.join(refs, "path", "left_semi")
