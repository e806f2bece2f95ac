"""Message sources.

Topics come from Kafka (``readStream.format('kafka')``, options built here) or from a row topic
(``framewell.sources.topic_log``), a data source with the same columns, offsets per partition
and a limit of rows a trigger. The same downstream code also runs on a file stream of (offset, value)
JSON lines. Offsets come from the query checkpoint, never from a consumer group.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewell import schemas
from framewell.functions.codec import decode_json
from framewell.sources.topic_log import FORMAT, TopicSource

TOPIC_RECORD = T.StructType([T.StructField("offset", T.LongType()),
                             T.StructField("value", T.StringType())])


def kafka_options(brokers: Sequence[str] | str, topics: Sequence[str] | str,
                  starting_offsets: str = "latest", max_offsets_per_trigger: int | None = None,
                  extra: dict | None = None) -> dict:
    """Source options; brokers may be a list (joined, newlines stripped)."""
    if not isinstance(brokers, str):
        brokers = ",".join(brokers)
    brokers = brokers.replace("\n", "").strip()
    if not isinstance(topics, str):
        topics = ",".join(topics)
    # offsets resume from the query checkpoint; lost offsets fail the query
    # (Spark's default) instead of being skipped silently
    opts = {"kafka.bootstrap.servers": brokers, "subscribe": topics,
            "startingOffsets": starting_offsets}
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    opts.update(extra or {})
    return opts


def read_topic(spark: SparkSession, brokers, topics, starting_offsets: str = "latest",
               max_offsets_per_trigger: int | None = None, extra: dict | None = None) -> DataFrame:
    """Streaming frame of (partition, offset, timestamp, key, value text)."""
    opts = kafka_options(brokers, topics, starting_offsets, max_offsets_per_trigger, extra)
    raw = spark.readStream.format("kafka").options(**opts).load()
    return raw.select("partition", "offset", "timestamp", F.col("key").cast("string").alias("key"),
                      F.col("value").cast("string").alias("value"))


def read_topic_rows(spark: SparkSession, path: str, starting_offsets: str = "latest",
                    max_rows_per_trigger: int | None = None) -> DataFrame:
    """S1/S2 on a row topic: streaming frame of (partition, offset, timestamp, key, value); at most
    ``max_rows_per_trigger`` rows a trigger, each offset once whatever the restarts."""
    spark.dataSource.register(TopicSource)
    r = spark.readStream.format(FORMAT).option("path", path).option("startingOffsets", starting_offsets)
    if max_rows_per_trigger:
        r = r.option("maxRowsPerTrigger", str(int(max_rows_per_trigger)))
    return r.load()


def topic_rows(spark: SparkSession, path: str, writer: str | None = None) -> DataFrame:
    """The rows of a row topic as a table, or those that one ``writer`` appended."""
    spark.dataSource.register(TopicSource)
    r = spark.read.format(FORMAT).option("path", path)
    return (r.option("writer", writer) if writer else r).load()


def read_buffer(spark: SparkSession, path: str, count: int) -> DataFrame:
    """Pull a buffer ``count`` entries at a time, from its start; an empty trigger makes no batch."""
    return read_topic_rows(spark, path, "earliest", count)


def consume(source: DataFrame, callback: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None = None):
    """S3: call ``callback(batch, batch number)`` for every batch that has rows; checkpointed."""
    def process(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            callback(batch, batch_id)
    w = source.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return (w.trigger(**trigger) if trigger else w).start()


def read_topic_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """File-backed buffer of (offset, value) JSON lines, count-limited per
    trigger; an empty trigger produces no batch."""
    r = spark.readStream.schema(TOPIC_RECORD)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(int(max_files_per_trigger)))
    return r.json(path)


def write_topic_files(df: DataFrame, path: str, n_files: int | None = None) -> None:
    """Lay a batch of (offset, value) rows down as a file-backed topic.

    Files are not offset ranges (no sampling pass): consumers order by the
    ``offset`` column, never by file order.
    """
    out = df.select("offset", "value")
    if n_files:
        out = out.repartition(n_files, "offset")
    out.write.mode("append").json(path)


def read_buffer_typed(spark: SparkSession, path: str, data_type: str, count: int | None = None) -> DataFrame:
    """A buffer's entries in the schema of their data type (RAW points or IMG frames), with their
    offsets; an unknown type raises. An entry that isn't JSON gives nulls."""
    if data_type not in ("RAW", "IMG"):
        raise ValueError(f"unknown data type: {data_type}")
    rows = read_topic_rows(spark, path, "earliest", count)
    return rows.select("offset", decode_json("value", schemas.schema_by_name(data_type)).alias("m")).select("offset", "m.*")
