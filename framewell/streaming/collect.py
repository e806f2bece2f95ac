"""Size-or-timeout batching per key (T-W1), exact form.

The default way to batch a stream in Spark is the trigger itself
(``trigger(processingTime=timeout)`` plus a row limit). When a batch must hold exactly
``max_size`` items of one key, or whatever arrived within ``timeout`` of its first item, this
stateful processor (``collect_batches``) does it: full batches are emitted while the rows are read, so
a task holds one batch and one chunk of rows whatever the trigger brings; a list state holds the rest,
fewer than ``max_size`` items, and a timer flushes it: by the watermark (event time) or by the clock.
Within a trigger it takes a key's rows as the shuffle brings them. ``collect_ordered`` takes them in the
order of a column, also for a key that brings a third of a trigger's rows: batches are numbered by rank in
equal slices, what is left is a table of fewer than ``max_size`` rows a key. Keys are real keys
(a device), never one constant key, so the work spreads over tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import (ExpiredTimerInfo, StatefulProcessor,
                                                      StatefulProcessorHandle, TimerValues)

from framewell.operators.ordering import _join_null_safe, sequence_index
from framewell.session import ensure_rocksdb_state_store
from framewell.sinks.fs import drop_folders, latest_version
from framewell.streaming.ingest import _start


MILLIS = "collect__millis"  # an item's event time


class _CollectProcessor(StatefulProcessor):
    def __init__(self, key: str, items: list[str], item_schema: T.StructType, max_size: int, timeout_ms: int | None, by_event: bool):
        self.key, self.fields, self.item_schema = key, items, item_schema
        self.max_size, self.timeout_ms, self.by_event = max_size, timeout_ms, by_event

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", self.item_schema)
        self.meta = handle.getValueState("meta", "batch_no long, deadline long")

    def _batch(self, key_value, items: pd.DataFrame, batch_no: int, reason: str) -> pd.DataFrame:
        pdf = items[self.fields].reset_index(drop=True)
        pdf.insert(0, self.key, key_value)
        pdf["batch_no"] = batch_no
        pdf["position"] = range(len(pdf))
        pdf["flushed_by"] = reason
        return pdf

    def _held(self) -> pd.DataFrame:
        rows = list(self.pending.get()) if self.pending.exists() else []
        return pd.DataFrame(rows, columns=[f.name for f in self.item_schema.fields])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        (key_value,) = key
        meta = self.meta.get() if self.meta.exists() else None
        batch_no, deadline = (int(meta[0]), int(meta[1])) if meta else (0, -1)
        rest, flushed = self._held(), False
        had_pending = len(rest) > 0
        for chunk in rows:
            chunk = chunk[list(rest.columns)]
            rest = pd.concat([rest, chunk], ignore_index=True) if len(rest) else chunk.reset_index(drop=True)
            full = len(rest) // self.max_size
            for i in range(full):
                yield self._batch(key_value, rest.iloc[i * self.max_size:(i + 1) * self.max_size], batch_no, "size")
                batch_no += 1
                flushed = True
            rest = rest.iloc[full * self.max_size:].reset_index(drop=True)
        if self.timeout_ms is not None and (flushed or not had_pending):
            # the batch that was timing out was flushed, or none was pending
            if deadline >= 0:
                self.handle.deleteTimer(deadline)
                deadline = -1
            if len(rest):
                start = int(rest[MILLIS].iloc[0]) if self.by_event else timerValues.getCurrentProcessingTimeInMs()
                deadline = start + self.timeout_ms
                self.handle.registerTimer(deadline)
        self.pending.clear()
        if len(rest):
            self.pending.put(list(rest.itertuples(index=False, name=None)))
        self.meta.update((batch_no, deadline))

    def handleExpiredTimer(self, key, timerValues: TimerValues,
                           expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        (key_value,) = key
        meta = self.meta.get() if self.meta.exists() else (0, -1)
        rest = self._held()
        if len(rest):
            yield self._batch(key_value, rest, int(meta[0]), "timeout")
            self.meta.update((int(meta[0]) + 1, -1))
        self.pending.clear()

    def close(self) -> None:
        pass


def collect_batches(stream: DataFrame, key: str, items: list[str], max_size: int,
                    timeout_seconds: float | None = None, time_col: str | None = None) -> DataFrame:
    """T-W1: items of each key in batches of ``max_size``, or the partial batch ``timeout_seconds`` after its
    first item: (key, items..., batch_no, position, flushed_by).

    With ``time_col`` (a column with a watermark) time is event time: a partial batch is flushed when the
    watermark passes its first item's time plus the timeout, under any trigger, so a closing item of a later
    time ends what is pending. Without it, processing-time timers fire between ``processingTime``
    triggers. Without a timeout a partial batch waits for more items.
    """
    ensure_rocksdb_state_store(stream.sparkSession)
    by_event = time_col is not None
    ms = [F.unix_millis(F.col(time_col)).alias(MILLIS)] if by_event else []
    kept = [*items, *([time_col] if by_event and time_col not in items else [])]
    rows = stream.select(key, *kept, *ms)
    item_schema = T.StructType([rows.schema[c] for c in [*items, *([MILLIS] if by_event else [])]])
    out_schema = T.StructType([stream.schema[key], *[stream.schema[c] for c in items], T.StructField("batch_no", T.LongType()),
                               T.StructField("position", T.LongType()), T.StructField("flushed_by", T.StringType())])
    timeout_ms = None if timeout_seconds is None else int(timeout_seconds * 1000)
    proc = _CollectProcessor(key, items, item_schema, max_size, timeout_ms, by_event)
    mode = "None" if timeout_ms is None else "EventTime" if by_event else "ProcessingTime"
    return rows.groupBy(key).transformWithStateInPandas(proc, out_schema, "append", mode)


def collect_ordered(spark: SparkSession, stream: DataFrame, out_path: str, key: str, items: list[str], max_size: int, order: str,
                    time_col: str, timeout_seconds: float, checkpoint: str | None = None, trigger: dict | None = None,
                    min_rows: int = 100_000):
    """T-W1, ordered and set-based: batches of ``max_size`` items of each key in the order of ``order`` within a
    trigger (what earlier triggers left comes first), as rows (key, items..., batch_no, position, flushed_by)
    in one folder per trigger, replay-safe; read with ``read_batches``.

    A partial batch is flushed when an event time of ``timeout_seconds`` after its first item's has been
    seen in any key. Between triggers two tables are kept: the items left, and per key the number of its
    next batch; each trigger writes them anew and the one before the last is removed. ``order`` is
    unique within a key.
    """
    base = out_path.rstrip("/")
    rows_of = [key, *dict.fromkeys([*items, order, time_col])]

    def process(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():  # F10
            return
        old = latest_version(spark, f"{base}/_left", batch_id)
        new = batch.select(*rows_of).withColumn("_turn", F.lit(1))
        if old is None:
            left, turns, seen = new.limit(0), None, None
        else:
            left = spark.read.schema(new.schema).parquet(old).withColumn("_turn", F.lit(0))
            turns = spark.read.parquet(old.replace("/_left/", "/_turns/"))
            seen = turns.agg(F.max("_seen")).first()[0]
        ranked = sequence_index(left.unionByName(new), key, ["_turn", order], out="_i", min_rows=min_rows).withColumn("_seen", F.col(time_col))
        ranked = ranked.checkpoint()
        latest = ranked.agg(F.max("_seen")).first()[0]
        latest = latest if seen is None else max(latest, seen)
        per_key = ranked.groupBy(key).agg(F.floor(F.count(F.lit(1)) / max_size).alias("_full"))
        if turns is not None:
            # a key without new rows may have timed out too: its left rows are in ``ranked``
            per_key = _full_join(per_key, turns.select(key, F.col("_next").alias("_at")), key)
        else:
            per_key = per_key.withColumn("_at", F.lit(0).cast("long"))
        placed = _join_null_safe(ranked, per_key, [key])
        part = F.floor(F.col("_i") / max_size)
        first = placed.where((part == F.col("_full")) & (F.col("_i") % max_size == 0)).select(
            key, (F.col(time_col).cast("timestamp") + F.make_dt_interval(secs=F.lit(timeout_seconds)) <= F.lit(latest).cast("timestamp")).alias("_late"))
        placed = _join_null_safe(placed, first, [key], "left")
        late = F.coalesce("_late", F.lit(False))
        out = placed.where((part < F.col("_full")) | late).select(
            key, *items, (F.col("_at") + part).cast("long").alias("batch_no"), (F.col("_i") % max_size).cast("long").alias("position"),
            F.when(part < F.col("_full"), "size").otherwise("timeout").alias("flushed_by"))
        out.write.mode("overwrite").parquet(f"{base}/_batch={batch_id}")
        placed.where((part == F.col("_full")) & ~late).select(*rows_of).write.mode("overwrite").parquet(f"{base}/_left/v={batch_id}")
        done = _join_null_safe(per_key, first, [key], "left").select(
            key, (F.col("_at") + F.coalesce("_full", F.lit(0)) + late.cast("long")).alias("_next"), F.lit(latest).alias("_seen"))
        done.write.mode("overwrite").parquet(f"{base}/_turns/v={batch_id}")
        for name in ("_left", "_turns"):
            drop_folders(spark, f"{base}/{name}", "v", batch_id - 1)  # a replay of this trigger reads the one before
    return _start(stream.writeStream.foreachBatch(process), spark, checkpoint, trigger, "collect", out_path)


def _full_join(per_key: DataFrame, turns: DataFrame, key: str) -> DataFrame:
    """Every key of both sides once, keys compared null-safe: (key, _full, _at)."""
    both = per_key.select(key, "_full", F.lit(0).cast("long").alias("_at")).unionByName(
        turns.select(key, F.lit(0).cast("long").alias("_full"), F.col("_at").cast("long").alias("_at")))
    return both.groupBy(key).agg(F.max("_full").alias("_full"), F.max("_at").alias("_at"))


def read_batches(spark: SparkSession, out_path: str) -> DataFrame:
    """The batches written by ``collect_ordered``."""
    return spark.read.parquet(out_path).drop("_batch")
