"""Record schemas, the schema registry and named projections.

Schemas are data (``StructType`` or its JSON form), never code loaded from
storage.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Frame message as it arrives on the topic (img is base64 text).
FRAME = T.StructType([
    T.StructField("device_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("timestamp", T.DoubleType()),
    T.StructField("width", T.StringType()),
    T.StructField("height", T.StringType()),
    T.StructField("img", T.StringType()),
])

# Same fields, every one read as text; numbers are converted with try_cast so
# a quoted number such as "1.5" is accepted (the float(x) behaviour).
FRAME_TEXT = T.StructType([T.StructField(f.name, T.StringType()) for f in FRAME.fields])

# Stored image metadata document.
IMAGE_METADATA = T.StructType([
    T.StructField("device_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("timestamp", T.DoubleType()),
    T.StructField("event_datetime", T.TimestampType()),
    T.StructField("process_datetime", T.TimestampType()),
    T.StructField("width", T.StringType()),
    T.StructField("height", T.StringType()),
    T.StructField("img_path", T.StringType()),
    T.StructField("updated_datetime", T.TimestampType()),
])

# Raw database change record. Documents are VARIANT: whole, whatever their fields.
CHANGE_RECORD = T.StructType([
    T.StructField("ns", T.StructType([T.StructField("db", T.StringType()),
                                      T.StructField("coll", T.StringType())])),
    T.StructField("documentKey", T.StructType([T.StructField("_id", T.StringType())])),
    T.StructField("operationType", T.StringType()),
    T.StructField("updateDescription", T.StructType([
        T.StructField("updatedFields", T.VariantType()),
        T.StructField("removedFields", T.ArrayType(T.StringType())),
        T.StructField("truncatedArrays", T.ArrayType(T.StructType([
            T.StructField("field", T.StringType()), T.StructField("newSize", T.IntegerType())]))),
    ])),
    T.StructField("fullDocumentBeforeChange", T.VariantType()),
    T.StructField("fullDocument", T.VariantType()),
])

# Time-series message.
POINT = T.StructType([
    T.StructField("io_id", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("timestamp", T.DoubleType()),
])

# Relational user table: id is the primary key, email unique.
USER = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("hashed_password", T.StringType()),
    T.StructField("is_active", T.BooleanType()),
    T.StructField("is_superuser", T.BooleanType()),
])

BLOB = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("content", T.BinaryType()),
])

CONFIG_ENTRY = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("type", T.StringType()),
])

# Registry: record kind -> schema (S6 / U4). Unknown kinds raise ValueError.
_REGISTRY: dict[str, T.StructType] = {
    "frame": FRAME,
    "frame_text": FRAME_TEXT,
    "image_metadata": IMAGE_METADATA,
    "change": CHANGE_RECORD,
    "point": POINT,
    "user": USER,
    "blob": BLOB,
    # typed buffer kinds of the stream producer
    "RAW": POINT,
    "IMG": FRAME,
}


def schema_by_name(name: str) -> T.StructType:
    try:
        return _REGISTRY[name]
    except KeyError:
        raise ValueError(f"unknown record kind: {name!r}") from None


# Named projections (P3). A request names one; unknown names fail; no name
# means the whole document.
PROJECTIONS: dict[str, list[str]] = {
    "ProjectImage": ["_id", "device_id", "name", "event_datetime", "img_path"],
    "UserRead": ["id", "email", "is_active"],
}
