"""Inputs derived from the driver's tables (see FIXTURES.md, part B).

Each derivation has a Spark form (here) and the same rule in SQL
(``framewell.plans.sqlparts``). Derivation rules give every row of the source a
role; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewell.functions.codec import encode_json
from framewell.functions.timefmt import as_ntz, epoch_to_timestamp, timestamp_to_epoch

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def frames(spark: SparkSession, sf_dir: str, ordered: bool = False) -> DataFrame:
    """Frame messages from ``events``; event_id is the arrival order. With ``ordered`` the frame's partitions and
    rows lie in that order; the stored columns are sorted, what is derived from them is derived after it."""
    ev = table(spark, sf_dir, "events")
    if ordered:
        ev = ev.repartitionByRange("event_id").sortWithinPartitions("event_id")
    device = F.concat(F.lit("cam"), (F.col("user_id") % 8).cast("string"))
    return ev.select(
        "event_id",
        device.alias("device_id"),
        F.concat(device, F.lit("_"), F.get_json_object("props", "$.k"), F.lit(".jpg")).alias("name"),
        timestamp_to_epoch(F.col("ts")).alias("timestamp"),
        F.lit("640").alias("width"),
        F.lit("480").alias("height"),
        F.base64(F.col("event_type").cast("binary")).alias("img"),
    )


def frame_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames with event time (NTZ, UTC wall clock) and object path."""
    f = frames(spark, sf_dir)
    return f.select("event_id", "device_id", "name", "timestamp",
                    as_ntz(epoch_to_timestamp("timestamp")).alias("event_datetime"),
                    "width", "height",
                    F.concat("device_id", F.lit("/"), "name").alias("img_path"))


def topic(spark: SparkSession, sf_dir: str, ordered: bool = False) -> DataFrame:
    """Frames as JSON text on a topic-like table (partition, offset, value), ``ordered`` by offset or as they come.

    Faults by ``event_id % 50``: 0 truncated JSON, 1 quoted timestamp,
    2 missing name, 3 malformed base64.
    """
    f = frames(spark, sf_dir, ordered)
    code = F.col("event_id") % 50
    body = F.struct(
        "device_id",
        F.when(code != 2, F.col("name")).alias("name"),
        "timestamp",
        "width", "height",
        F.when(code == 3, F.concat(F.lit("*"), F.col("img"))).otherwise(F.col("img")).alias("img"),
    )
    quoted = F.struct(
        "device_id", "name", F.col("timestamp").cast("string").alias("timestamp"),
        "width", "height", "img")
    text = (F.when(code == 0, F.substring(F.to_json(body), 1, 40))
            .when(code == 1, F.to_json(quoted)).otherwise(F.to_json(body)))
    return f.select(F.lit(0).alias("partition"), F.col("event_id").alias("offset"),
                    text.alias("value"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time-series points: io_id = event_type."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("event_type").alias("io_id"), "value",
                     timestamp_to_epoch(F.col("ts")).alias("timestamp"), "event_id")


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image metadata collection, one document per order."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("_id"),
        F.concat(F.lit("cam"), (F.col("o_custkey") % 8).cast("string")).alias("device_id"),
        F.concat(F.col("o_orderkey").cast("string"), F.lit(".jpg")).alias("name"),
        F.col("o_orderdate").alias("event_datetime"),
        F.lit("640").alias("width"), F.lit("480").alias("height"),
        F.concat(F.lit("src/"), F.col("o_orderkey").cast("string"), F.lit(".jpg")).alias("img_path"),
        F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"),
    )


def blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blob store: one object per document; extension by doc_id % 3."""
    d = table(spark, sf_dir, "documents")
    ext = F.element_at(F.array(F.lit(".jpg"), F.lit(".png"), F.lit(".txt")),
                       (F.col("doc_id") % 3 + 1).cast("int"))
    return d.select(F.concat(F.lit("src/"), F.col("doc_id").cast("string"), ext).alias("path"),
                    F.col("text").cast("binary").alias("content"),
                    F.col("source").alias("device_id"))


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw change records, one per order."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    op = (F.when(k % 97 == 0, "drop").when(F.col("o_orderstatus") == "F", "delete")
          .when(F.col("o_orderstatus") == "O", "update").otherwise("insert"))
    before_path = (F.when(k % 7 == 0, F.lit(None).cast("string")).when(k % 11 == 0, F.lit(""))
                   .otherwise(F.concat(F.lit("src/"), k.cast("string"), F.lit(".jpg"))))
    doc = lambda p: F.struct(k.cast("string").alias("_id"), p.alias("img_path"),
                             F.col("o_orderdate").cast("timestamp").alias("updated_datetime"))
    return o.select(
        F.struct(F.lit("db").alias("db"),
                 F.when(k % 10 == 0, "other").otherwise("images").alias("coll")).alias("ns"),
        F.struct(k.cast("string").alias("_id")).alias("documentKey"),
        op.alias("operationType"),
        F.when(op == "update", F.struct(
            F.create_map(F.lit("status"), F.col("o_orderstatus")).alias("updatedFields"),
            F.array().cast("array<string>").alias("removedFields"),
            F.array().cast("array<string>").alias("truncatedArrays"))).alias("updateDescription"),
        F.when(op.isin("delete", "update"), doc(before_path)).alias("fullDocumentBeforeChange"),
        F.when(op.isin("insert", "update"), doc(before_path)).alias("fullDocument"),
    )


def order_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as request text in one of three formats; % 4 = 3 unparseable."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    d = F.col("o_orderdate")
    text = (F.when(k % 4 == 0, F.date_format(d, "yyyy-M-d"))
            .when(k % 4 == 1, F.date_format(d, "yyyy/MM/dd"))
            .when(k % 4 == 2, F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
            .otherwise(F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss")))
    return o.select(k.alias("o_orderkey"), d.alias("o_orderdate"), text.alias("date_text"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User rows from ``customer``; rule-made faults: negative balance -> no
    e-mail, nation 0 -> e-mail without '@', key % 17 = 0 -> shares the
    e-mail of the previous key."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    ref = F.when(k % 17 == 0, k - 1).otherwise(k).cast("string")
    email = (F.when(F.col("c_acctbal") < 0, F.lit(None).cast("string"))
             .when(F.col("c_nationkey") == 0, F.concat(F.lit("user"), ref, F.lit(".example.org")))
             .otherwise(F.concat(F.lit("user"), ref, F.lit("@example.org"))))
    return c.select(k.alias("id"), F.col("c_name").alias("name"), email.alias("email"),
                    F.sha2(F.col("c_name"), 256).alias("hashed_password"),
                    F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit(False)).alias("is_active"),
                    F.lit(None).cast("boolean").alias("is_superuser"))


def supplier_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An insert batch of users from ``supplier`` (ids overlap customers)."""
    s = table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                    F.concat(F.lit("supplier"), F.col("s_suppkey").cast("string"),
                             F.lit("@example.org")).alias("email"),
                    F.sha2(F.col("s_name"), 256).alias("hashed_password"),
                    F.lit(None).cast("boolean").alias("is_active"),
                    F.lit(None).cast("boolean").alias("is_superuser"))


def doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with an array field: every line of the whole text as
    struct(no, text, n_chars, flag)."""
    d = table(spark, sf_dir, "documents")
    lines = F.transform(F.split(F.col("text"), "\n"),
                        lambda x, i: F.struct(i.cast("int").alias("no"), x.alias("text"),
                                              F.length(x).cast("int").alias("n_chars"),
                                              F.lit(False).alias("flag")))
    return d.select(F.col("doc_id").cast("string").alias("_id"), "lang", "source", lines.alias("lines"))


def archive_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive messages: event time as '%Y-%m-%dT%H:%M:%S.%fZ' text plus model
    fields; the time text is cut to seconds (a reject) for event_id % 40 = 0."""
    ev = table(spark, sf_dir, "events")
    full = F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    short = F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    body = F.struct(F.when(F.col("event_id") % 40 == 0, short).otherwise(full).alias("event_datetime_str"),
                    F.concat(F.lit("cam"), (F.col("user_id") % 8).cast("string"), F.lit("_"),
                             F.get_json_object("props", "$.k"), F.lit(".jpg")).alias("name"),
                    F.col("event_type").alias("category"), "value")
    return ev.select(F.col("event_id").alias("offset"), encode_json(body).alias("value"))
