"""Message sinks (K4, K6, K7)."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewell.functions.codec import encode_json
from framewell.sources.topic_log import FORMAT, TopicSource
from framewell.sources.topics import topic_rows


def to_topic_value(df: DataFrame, key: str | None = None) -> DataFrame:
    """K4 projection: each row as JSON text (times with microseconds)."""
    cols = [encode_json(F.struct(*[F.col(c) for c in df.columns])).alias("value")]
    if key:
        cols.insert(0, F.col(key).cast("string").alias("key"))
    return df.select(*cols)


def write_topic(df: DataFrame, brokers: Sequence[str] | str, topic: str, checkpoint: str,
                key: str | None = None, trigger: dict | None = None):
    """K4 (streaming): JSON rows to a Kafka topic; checkpointed."""
    if not isinstance(brokers, str):
        brokers = ",".join(brokers)
    w = (to_topic_value(df, key).writeStream.format("kafka")
         .option("kafka.bootstrap.servers", brokers).option("topic", topic)
         .option("checkpointLocation", checkpoint))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def _messages(df: DataFrame, key: str | None, partitions: int, partition: Column | None, value: str | None) -> DataFrame:
    """Rows as messages of a row topic: the row as JSON or the text column ``value``, the key as text, and
    the partition that the key hashes to."""
    df.sparkSession.dataSource.register(TopicSource)
    value = F.col(value).cast("string") if value else encode_json(F.struct(*[F.col(c) for c in df.columns]))
    text = F.lit(None).cast("string") if key is None else F.col(key).cast("string")
    if partition is None:
        partition = F.pmod(F.xxhash64(text), F.lit(partitions)) if key is not None and partitions > 1 else F.lit(0)
    return df.select(partition.cast("int").alias("partition"), F.current_timestamp().alias("timestamp"), text.alias("key"), value.alias("value"))


def append_topic(df: DataFrame, path: str, key: str | None = None, partitions: int = 1, partition: Column | None = None,
                 value: str | None = None) -> str:
    """K4 (batch): append rows to a row topic in the frame's order; a key's rows go to one partition, or give the
    ``partition`` as a column. Returns the name of this append (see ``topic_rows``)."""
    name = uuid.uuid4().hex
    _messages(df, key, partitions, partition, value).write.format(FORMAT).option("path", path).option("writer", name).mode("append").save()
    return name


def write_topic_rows(df: DataFrame, path: str, checkpoint: str, key: str | None = None, partitions: int = 1,
                     trigger: dict | None = None, writer: str = "stream", value: str | None = None):
    """K4 (streaming): rows to a row topic; a batch that is repeated after a failure is published once.
    ``writer`` names the query among all that ever write to the topic."""
    w = (_messages(df, key, partitions, None, value).writeStream.format(FORMAT).option("path", path).option("writer", writer)
         .option("checkpointLocation", checkpoint))
    return (w.trigger(**trigger) if trigger else w).start()


def append_buffer(df: DataFrame, path: str) -> DataFrame:
    """K6: append rows to a buffer (a row topic of one partition) and return (buffer_id, value) as they
    are stored: ids are dense from 0, go on from append to append and are never handed out twice."""
    name = append_topic(df, path)
    return topic_rows(df.sparkSession, path, name).select(F.col("offset").alias("buffer_id"), "value")


def console_stream(df: DataFrame, checkpoint: str, trigger: dict | None = None):
    """K7 (streaming): print each micro-batch."""
    w = df.writeStream.format("console").option("truncate", "false").option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
