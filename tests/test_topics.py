"""Row topics (ids, limits, restarts, retries), change records, ordered tombstones, arrival order, equal-depth slices."""

import json
import os
import random
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from framewell.operators import ordering
from framewell.operators.mutations import merge_by_key
from framewell.operators.versions import apply_changes, diff_versions
from framewell.sinks.tables import read_keyed_table, upsert_table
from framewell.sinks.topics import append_buffer, append_topic, write_topic_rows
from framewell.sources.topic_log import TopicLog, TopicStreamReader, share_rows
from framewell.sources.topics import consume, read_buffer, read_buffer_typed, read_topic_rows, topic_rows
from framewell.streaming.changes import cascade_stream, compact_tombstones, live_blobs, tombstone_marks

NOW = {"processingTime": "0 seconds"}


def numbers(spark, a, b, parts=3):
    return spark.range(a, b, numPartitions=parts).select(F.col("id").cast("string").alias("v"))


def drain(q, batches=None):
    while batches is not None and q.isActive and (q.lastProgress is None or q.lastProgress["batchId"] + 1 < batches):
        q.awaitTermination(0.05)
    if batches is None:
        q.processAllAvailable()
    q.stop()


# ---- ids and limits

def test_rows_are_shared_by_backlog_and_none_is_lost():
    rnd = random.Random(1)
    for _ in range(300):
        left = {str(p): rnd.choice([0, 1, 2, 7, 1000]) for p in range(rnd.randint(1, 9))}
        most = rnd.randint(1, 60)
        got = share_rows(left, most)
        assert sum(got.values()) == min(most, sum(left.values()))
        assert all(0 <= got[p] <= left[p] for p in left)


def test_two_appends_give_dense_disjoint_ids_and_return_what_is_stored(spark, tmp_path):
    path = str(tmp_path / "buffer")
    one = append_buffer(numbers(spark, 0, 25), path)
    two = append_buffer(numbers(spark, 25, 40), path)
    ids = [[r.buffer_id for r in x.collect()] for x in (one, two)]
    assert sorted(ids[0]) == list(range(25)) and sorted(ids[1]) == list(range(25, 40))
    stored = {r.offset: r.value for r in topic_rows(spark, path).collect()}
    assert {r.buffer_id: r.value for r in one.unionAll(two).collect()} == stored
    assert [json.loads(stored[i])["v"] for i in range(40)] == [str(i) for i in range(40)]  # the frames' order
    assert append_buffer(numbers(spark, 0, 0), path).collect() == []


def test_files_of_failed_attempts_are_not_part_of_the_topic(spark, tmp_path):
    path = str(tmp_path / "topic")
    append_topic(numbers(spark, 0, 10), path)
    log = TopicLog(path)
    some = os.listdir(f"{path}/data")[0]
    for i in range(3):  # what a lost attempt leaves
        os.link(f"{path}/data/{some}", f"{path}/data/0-{i}{uuid.uuid4().hex}.parquet")
    open(f"{path}/commits/x.draft", "w").close()
    append_topic(numbers(spark, 10, 15), path)
    assert sorted(r.offset for r in topic_rows(spark, path).collect()) == list(range(15))
    assert log.ends() == {"0": 15}


def test_a_streaming_batch_is_published_once(tmp_path):
    log = TopicLog(str(tmp_path / "t"))
    log.append([(0, 3, "a"), (1, 2, "b")], "q", 0)
    log.append([(0, 3, "c")], "q", 0)  # the engine repeats a batch it is not sure of
    log.append([(0, 4, "d")], "other", 0)
    log.append([(0, 4, "d")], "other", 0)
    log.append([(0, 1, "e")], "q", 1)
    assert log.ends() == {"0": 8, "1": 2}
    assert [(s.file, a, b) for s, a, b in log.slices({"0": 2, "1": 2}, {"0": 8, "1": 2})] == [("e", 0, 1), ("d", 0, 4), ("a", 2, 3)]


def test_keys_stay_in_one_partition_and_latest_skips_the_past(spark, tmp_path):
    path = str(tmp_path / "topic")
    rows = spark.range(0, 60).select((F.col("id") % 7).alias("k"), "id")
    append_topic(rows, path, "k", 4)
    src = read_topic_rows(spark, path)  # latest
    sink, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    start = lambda: src.writeStream.format("parquet").option("path", sink).option("checkpointLocation", ck).trigger(**NOW).start()
    drain(start())
    append_topic(rows, path, "k", 4)
    drain(start())
    seen = spark.read.schema(src.schema).parquet(sink)
    assert seen.count() in (0, 60)  # 0 where the first run had no batch to fix its start
    everything = topic_rows(spark, path)
    assert everything.groupBy("key").agg(F.countDistinct("partition").alias("n")).where("n > 1").count() == 0
    per = everything.groupBy("partition").agg(F.min("offset").alias("a"), F.max("offset").alias("b"), F.count("*").alias("n")).collect()
    assert all(r.a == 0 and r.b == r.n - 1 for r in per)


def test_every_offset_once_over_restarts_and_a_repeated_batch(spark, tmp_path):
    path, ck, out = str(tmp_path / "topic"), str(tmp_path / "ck"), str(tmp_path / "out")
    append_topic(spark.range(0, 100).withColumn("k", F.col("id") % 5), path, "k", 3)
    sizes = []

    def keep(batch, n):
        batch.write.mode("overwrite").parquet(f"{out}/_batch={n}")
        sizes.append(batch.count())

    start = lambda: consume(read_topic_rows(spark, path, "earliest", 17), keep, ck, NOW)
    for batches in (1, 2, 3):
        drain(start(), batches)
    # the process dies after a batch's rows are written and before it is noted as done
    last = max((f for f in os.listdir(f"{ck}/commits") if f.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        if os.path.exists(f"{ck}/commits/{name}"):
            os.remove(f"{ck}/commits/{name}")
    append_topic(spark.range(100, 130).withColumn("k", F.col("id") % 5), path, "k", 3)
    drain(start())
    rows = spark.read.parquet(out)
    assert max(sizes) <= 17
    assert sorted(json.loads(r.value)["id"] for r in rows.collect()) == list(range(130))
    assert rows.select("partition", "offset").distinct().count() == 130


def test_reader_positions(tmp_path):
    log = TopicLog(str(tmp_path / "t"))
    reader = TopicStreamReader({"path": str(tmp_path / "t"), "maxRowsPerTrigger": "4"})
    assert reader.latestOffset() == {} == reader.initialOffset()
    log.append([(0, 10, "a")], "w")
    again = TopicStreamReader({"path": str(tmp_path / "t"), "maxRowsPerTrigger": "4"})
    assert again.latestOffset() == {"0": 4} and again.initialOffset() == {"0": 0}
    again.partitions({"0": 6}, {"0": 6})  # what a restart plans first
    assert again.latestOffset() == {"0": 10}
    log.append([(1, 2, "b")], "w")
    assert sum(again.latestOffset().values()) - 6 == 4
    assert TopicStreamReader({"path": str(tmp_path / "t"), "startingOffsets": "latest"}).initialOffset() == {"0": 10, "1": 2}


def test_stream_to_topic_and_buffers_by_count_and_type(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    points = spark.createDataFrame([(f"io{i % 3}", float(i), 1.5 * i) for i in range(40)], "io_id string, value double, timestamp double")
    append_buffer(points.coalesce(1), a)
    relay = write_topic_rows(read_buffer(spark, a, 9).select("key", "value"), b, str(tmp_path / "ck"), value="value", trigger=NOW)
    drain(relay)
    assert sorted(r.value for r in topic_rows(spark, b).collect()) == sorted(r.value for r in topic_rows(spark, a).collect())
    q = read_buffer_typed(spark, a, "RAW", 15).writeStream.format("parquet").option("path", str(tmp_path / "o")).option(
        "checkpointLocation", str(tmp_path / "ck2")).trigger(**NOW).start()
    drain(q)
    assert sorted((r.offset, r.io_id, r.value) for r in spark.read.parquet(str(tmp_path / "o")).collect()) == [(i, f"io{i % 3}", float(i)) for i in range(40)]
    with pytest.raises(ValueError):
        read_buffer_typed(spark, a, "VIDEO")


# ---- change records

DOC = "_id string, n long, t timestamp, tags array<string>, at struct<x:long,y:struct<z:string>>, gone string"


def test_diff_names_nested_removed_and_truncated_fields(spark):
    t = datetime(2024, 1, 2, 3, 4, 5, 678901)
    old = [("same", 1, t, ["a"], (1, ("p",)), "g"), ("nested", 1, t, ["a"], (1, ("p",)), "g"), ("cut", 1, t, ["a", "b", "c"], None, "g"),
           ("removed", 1, t, None, None, "g"), ("deleted", None, t, [], None, None), ("whole", 1, t, ["a"], (1, ("p",)), "g"),
           ("struct_gone", 1, t, None, (1, ("p",)), "g"), ("nulls", None, None, None, None, None), (None, 1, t, None, None, None)]
    new = [("same", 1, t, ["a"], (1, ("p",)), "g"), ("nested", 1, t, ["a", "b"], (2, ("q",)), "g"), ("cut", 1, t, ["a"], None, "g"),
           ("removed", 1, t, None, None, None), ("inserted", 5, t, ["x"], (None, ("z",)), None), ("whole", 2, t + timedelta(seconds=1), ["b"], (3, None), "h"),
           ("struct_gone", 1, t, None, None, "g"), ("nulls", None, None, None, None, None), (None, 2, t, None, None, None)]
    a, b = spark.createDataFrame(old, DOC), spark.createDataFrame(new, DOC)
    got = {r.id: r for r in diff_versions(a, b).select(
        F.col("documentKey._id").alias("id"), F.col("operationType").alias("op"), F.to_json("updateDescription.updatedFields").alias("up"),
        F.col("updateDescription.removedFields").alias("rm"), F.col("updateDescription.truncatedArrays").alias("tr"),
        F.to_json("fullDocumentBeforeChange").alias("before"), F.to_json("fullDocument").alias("full")).collect()}
    assert set(got) == {"nested", "cut", "removed", "deleted", "whole", "inserted", "struct_gone"}
    assert got["nested"].op == "update" and json.loads(got["nested"].up) == {"at.x": 2, "at.y.z": "q", "tags": ["a", "b"]}
    assert json.loads(got["cut"].up) == {} and [tuple(x) for x in got["cut"].tr] == [("tags", 1)]
    assert got["removed"].rm == ["gone"] and got["struct_gone"].rm == ["at"]
    assert got["deleted"].op == "delete" and got["deleted"].full is None and json.loads(got["deleted"].before) == {
        "_id": "deleted", "t": "2024-01-02 03:04:05.678901", "tags": []}
    assert got["whole"].op == "replace" and got["whole"].up is None
    assert got["inserted"].op == "insert" and got["inserted"].before is None and json.loads(got["inserted"].full)["at"] == {"y": {"z": "z"}}
    forced = diff_versions(a, b, replaced=F.col("n") == 1).where("operationType = 'replace'").select("documentKey._id").collect()
    assert {r[0] for r in forced} == {"nested", "cut", "removed", "struct_gone"}


def test_changes_applied_give_the_new_version(spark):
    schema = "_id long, a string, b double, c array<long>"
    rnd = random.Random(4)
    row = lambda i: (i, rnd.choice(["x", "y", None]), rnd.choice([0.1, 1e300, None]), rnd.choice([[1, 2], [], None]))
    a = spark.createDataFrame([row(i) for i in range(80)], schema)
    b = spark.createDataFrame([row(i) for i in range(40, 120)], schema)
    back = apply_changes(a, diff_versions(a, b))
    key = lambda r: r["_id"]
    assert sorted(back.collect(), key=key) == sorted(b.collect(), key=key)
    assert diff_versions(a, a).count() == 0 and diff_versions(a.limit(0), b).where("operationType != 'insert'").count() == 0


# ---- tombstones

def events(spark, rows):
    doc = lambda p: None if p is None else json.dumps({"img_path": p})
    return spark.createDataFrame([("images", "d", op, seq, doc(p) if op == "delete" else None, doc(p) if op != "delete" else None) for op, p, seq in rows],
                                 "collection string, doc_id string, operation_type string, seq long, before_doc string, full_doc string")


def run_events(spark, base, rows, n):
    folder = f"{base}/in"
    events(spark, rows).coalesce(1).write.mode("append").json(folder)
    src = spark.readStream.schema(events(spark, rows).schema).json(folder)
    cascade_stream(spark, src, f"{base}/marks", checkpoint=f"{base}/ck", trigger={"availableNow": True}, seq="seq").awaitTermination()


def test_last_event_decides_and_marks_shrink(spark, tmp_path):
    base = str(tmp_path)
    blobs = spark.createDataFrame([(p,) for p in "abcdef"], "path string")
    live = lambda: sorted(r.path for r in live_blobs(spark, blobs, f"{base}/marks").collect())
    assert live() == list("abcdef")
    run_events(spark, base, [("delete", "a", 1), ("insert", "b", 5), ("update", "c", 2), ("delete", "d", 3), ("delete", "", 9)], 0)
    assert live() == ["b", "c", "e", "f"]
    run_events(spark, base, [("insert", "a", 7), ("delete", "b", 4), ("delete", "c", 6), ("drop", "e", 9)], 1)
    assert live() == ["a", "b", "e", "f"]
    assert compact_tombstones(spark, f"{base}/marks", settled=-1) == 4 and live() == ["a", "b", "e", "f"]
    assert compact_tombstones(spark, f"{base}/marks", settled=-1) == 4  # nothing new to fold
    run_events(spark, base, [("delete", "f", 8)], 2)
    assert compact_tombstones(spark, f"{base}/marks", settled=6, blobs=blobs.where("path != 'd'")) == 3
    assert live() == ["a", "b", "d", "e"]  # d's mark went, as its object was gone
    assert {(r.path, r.gone) for r in tombstone_marks(spark, f"{base}/marks").collect()} == {("a", False), ("c", True), ("f", True)}
    assert sorted(x for x in os.listdir(f"{base}/marks") if x.startswith("_batch")) == ["_batch=2"]


# ---- arrival order

def test_offsets_are_compared_within_a_partition_only(spark, tmp_path):
    path = str(tmp_path / "t")
    put = lambda rows, n: upsert_table(spark, spark.createDataFrame(rows, "partition int, offset long, name string, v string"),
                                       path, "name", "offset", 4, n)
    put([(0, 900, "a", "old"), (1, 5, "b", "old"), (0, 901, "c", "old")], 0)
    put([(1, 3, "a", "new"), (1, 4, "b", "late"), (2, 1, "c", "x"), (2, 2, "c", "new")], 1)
    assert {r.name: r.v for r in read_keyed_table(spark, path).collect()} == {"a": "new", "b": "old", "c": "new"}
    put([(1, 3, "a", "repeated")], 1)  # a replay of a committed batch changes nothing
    assert {r.name: r.v for r in read_keyed_table(spark, path).collect()}["a"] == "new"


def test_merge_keeps_rows_without_an_order_replaceable(spark):
    t = spark.createDataFrame([("a", None, None, None, "x")], "name string, run long, partition int, offset long, v string")
    b = spark.createDataFrame([("a", 1, 0, 4, "y")], "name string, run long, partition int, offset long, v string")
    assert merge_by_key(t, b, "name", ["partition", "offset"], arrival=("run", "partition", "offset")).first().v == "y"


# ---- slices

def test_a_burst_with_an_outlier_is_cut_evenly(spark):
    t0 = datetime(2024, 1, 1)
    rows = [(i, "hot", t0 + timedelta(microseconds=i % 500)) for i in range(5000)] + [(5001, "hot", datetime(2090, 1, 1)), (5002, "cold", t0), (5003, None, None)]
    df = spark.createDataFrame(rows, "id long, device_id string, ts timestamp")
    sizes = [r["count"] for r in ordering.adaptive_slices(df, ["device_id"], ["ts", "id"], min_rows=50).where("device_id = 'hot'").groupBy("_b").count().collect()]
    mean = sum(sizes) / len(sizes)
    assert sum(sizes) == 5001 and max(sizes) <= 70 and max(sizes) < 2 * mean  # sqrt(5001) = 70
    got = {r.id: r.frame_index for r in ordering.sequence_index(df, "device_id", ["ts", "id"], min_rows=50).collect()}
    for device in ("hot", "cold", None):
        mine = sorted((r for r in rows if r[1] == device), key=lambda r: (r[2] is not None, r[2] or t0, r[0]))
        assert [got[r[0]] for r in mine] == list(range(len(mine)))


# ---- console

def test_console_sinks_print_rows(spark, tmp_path, capsys):
    from framewell.sinks.tables import console
    from framewell.sinks.topics import console_stream
    console(spark.range(3).withColumnRenamed("id", "printed_id"))
    assert "printed_id" in capsys.readouterr().out
    append_topic(numbers(spark, 0, 5), str(tmp_path / "t"))
    q = console_stream(read_topic_rows(spark, str(tmp_path / "t"), "earliest"), str(tmp_path / "ck"), {"availableNow": True})
    q.awaitTermination()
    assert q.lastProgress["numInputRows"] == 5


# ---- one topic in several partition counts

def _event_table(spark, folder, n=600):
    """Events in no order; every key comes several times, some rows come twice, some lack a key."""
    t0 = datetime(2024, 1, 1)
    rows = [(i, t0 + timedelta(seconds=i), i % 11, "view", 1.0, None if i % 7 == 0 else json.dumps({"k": i % 13})) for i in range(n)]
    rows += rows[::40]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string")
    df.repartition(5).write.parquet(f"{folder}/events.parquet")
    last = {}
    for i, ts, user, _, _, props in sorted(rows, key=lambda r: r[0]):
        if props and i % 50 not in (0, 2, 3):
            last[f"cam{user % 8}_{json.loads(props)['k']}.jpg"] = ts
    return last


def test_topics_of_all_partition_counts_come_from_one_ordered_copy(spark, tmp_path, monkeypatch):
    from framewell.plans import q_topics
    last = _event_table(spark, str(tmp_path))
    seen, active, stored = [], [], set(spark.sparkContext._jsc.getPersistentRDDs())

    def append(df, path, *args, **more):
        seen.append((path, df._jdf.queryExecution().withCachedData().toString()))
        return append_topic(df, path, *args, **more)

    def until(q, batches):
        active.append(len(spark.streams.active))
        return was(q, batches)

    was = q_topics._until
    monkeypatch.setattr(q_topics, "append_topic", append)
    monkeypatch.setattr(q_topics, "_until", until)
    got = {}
    for r in q_topics.q_stream_upsert_partitions(spark, str(tmp_path)).collect():
        assert got.setdefault((r.n_partitions, r.name), r.event_datetime) == r.event_datetime
    assert got == {(n, name): ts for n in (1, 4, 9) for name, ts in last.items()}
    assert len(seen) == 3 and active == [3, 2, 1] and not spark.streams.active
    for n, (path, plan) in zip((1, 4, 9), seen, strict=True):
        # derived and sorted once, then only read
        assert plan.startswith("InMemoryRelation")
        rows = topic_rows(spark, path).select("partition", "offset", "key", F.get_json_object("value", "$.timestamp").cast("double").alias("t")).collect()
        assert len(rows) == 615 and {r.partition for r in rows} <= set(range(n))
        keys = {}
        for r in rows:
            assert keys.setdefault(r.key, r.partition) == r.partition
        for p in range(n):
            mine = sorted((r.offset, r.t) for r in rows if r.partition == p)
            assert [o for o, _ in mine] == list(range(len(mine)))
            times = [t for _, t in mine if t is not None]
            assert times == sorted(times)
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= stored  # the copy is given back


def test_ingest_reads_the_source_once_and_skips_empty_batches(spark, tmp_path):
    from framewell.plans import fixtures as fx
    from framewell.streaming.ingest import ingest_frames
    _event_table(spark, str(tmp_path))
    append_topic(fx.topic(spark, str(tmp_path)), f"{tmp_path}/topic", partition=F.col("offset") % 4, value="value")
    for kept in (615, 0):
        base = f"{tmp_path}/{kept}"

        def tick(offset, log=f"{base}.read", kept=kept):
            with open(log, "a") as f:  # also of tasks that are broken off
                f.write(".")
            return kept > 0

        src = read_topic_rows(spark, f"{tmp_path}/topic", "earliest").where(F.udf(tick, "boolean")("offset"))
        drain(ingest_frames(spark, src, f"{base}/images", f"{base}/blobs", f"{base}/rejects", f"{base}/checkpoint", NOW, 4, f"{base}/metrics"))
        assert os.path.getsize(f"{base}.read") == 615
        if kept:
            m = spark.read.parquet(f"{base}/metrics").first()
            assert (m.n_rows, m.n_rejects) == (615, spark.read.parquet(f"{base}/rejects").count())
            assert read_keyed_table(spark, f"{base}/images").count() > 0
        else:
            assert not any(os.path.exists(f"{base}/{x}") for x in ("images", "blobs", "rejects", "metrics"))
