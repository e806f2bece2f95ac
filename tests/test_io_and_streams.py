"""Sources, sinks and streaming pieces on small hand-made inputs."""

import uuid

import numpy as np
from pyspark.sql import functions as F

from framewell.operators import config, infer
from framewell.session import scratch_path
from framewell.sinks.tables import read_keyed_table, upsert_table
from framewell.sources.topics import kafka_options
from framewell.streaming.collect import collect_batches


def test_kafka_options():
    o = kafka_options(["b1:9092\n", "b2:9092"], "frames", max_offsets_per_trigger=500)
    assert o["kafka.bootstrap.servers"] == "b1:9092,b2:9092"
    assert o["subscribe"] == "frames" and o["startingOffsets"] == "latest"
    assert o["maxOffsetsPerTrigger"] == "500"


def test_upsert_table_replay_and_reorder(spark):
    path = scratch_path(spark, "test_upsert") + "/t"
    b1 = spark.createDataFrame([("n1", 5, "v5"), ("n2", 1, "v1")], "name string, offset long, val string")
    b0 = spark.createDataFrame([("n1", 3, "v3"), ("n3", 2, "v2")], "name string, offset long, val string")
    upsert_table(spark, b1, path, "name", "offset", 4, batch_id=1)
    upsert_table(spark, b0, path, "name", "offset", 4, batch_id=0)     # arrives late
    upsert_table(spark, b0, path, "name", "offset", 4, batch_id=0)     # replay: no-op
    got = {r.name: (r.offset, r.val) for r in read_keyed_table(spark, path).collect()}
    assert got == {"n1": (5, "v5"), "n2": (1, "v1"), "n3": (2, "v2")}


def test_flatten_nested_config(spark):
    df = spark.createDataFrame([(1, '{"a": 1, "b": {"c": "x", "d": {"e": 2.5}}, "f": [1, 2], "g": true}')],
                               "id int, doc string")
    got = {(r.key, r.value, r.type) for r in config.flatten_config(df, "doc", ["id"]).collect()}
    assert got == {("a", "1", "int"), ("b.c", "x", "str"), ("b.d.e", "2.5", "float"),
                   ("f", "[1,2]", "list"), ("g", "true", "bool")}


def test_scoring_paths_agree(spark):
    rows = [(i, [float(np.sin(i + j)) for j in range(8)]) for i in range(20)]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    w = [0.3 * (-1) ** i + 0.1 * i for i in range(8)]
    a = {r.id: r.score for r in infer.infer(df, "v", ["id"], infer.LinearModel(tuple(w))).collect()}
    b = {r.id: r.s for r in df.select("id", infer.score_linear("v", w).alias("s")).collect()}
    assert all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_collect_batches_size_only(spark, tmp_path):
    d = str(tmp_path / uuid.uuid4().hex)
    spark.range(0, 230).select(F.col("id").alias("offset"), (F.col("id") % 3).cast("string").alias("device_id"),
                               F.concat(F.lit("n"), F.col("id").cast("string")).alias("name")).write.json(d + "/in")
    src = spark.readStream.schema("offset long, device_id string, name string").json(d + "/in")
    out = collect_batches(src, "device_id", ["offset", "name"], 50)
    q = (out.writeStream.format("parquet").option("path", d + "/out").option("checkpointLocation", d + "/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    res = spark.read.parquet(d + "/out").groupBy("device_id", "batch_no").count().collect()
    assert sorted((r.device_id, r["count"]) for r in res) == [("0", 50), ("1", 50), ("2", 50)]


def test_binary_file_sources(spark, tmp_path):
    from framewell.sources.blobs import list_blobs, read_blob, read_blobs
    root = tmp_path / "objects"
    (root / "cam1").mkdir(parents=True)
    (root / "cam1" / "a.jpg").write_bytes(b"\xff\xd8abc")
    (root / "cam1" / "b.txt").write_bytes(b"hello")
    listed = {r.path.rsplit("/", 1)[1]: r.length for r in list_blobs(spark, str(root)).collect()}
    assert listed == {"a.jpg": 5, "b.txt": 5}
    assert len(read_blobs(spark, str(root), glob="*.jpg").collect()) == 1
    got = read_blob(spark, str(root), "cam1/b.txt").collect()
    assert len(got) == 1 and bytes(got[0].content) == b"hello"
    assert read_blob(spark, str(root), "cam1/none.jpg").count() == 0


def test_sink_helpers(spark, tmp_path):
    from datetime import datetime

    from framewell.operators.series import to_points
    from framewell.sinks.blobs import blob_rows, upload_blobs
    from framewell.sinks.tables import write_parquet_batches, write_points
    from framewell.sinks.topics import append_buffer, to_topic_value
    pts = spark.createDataFrame([("io1", 1.5, 1.0), ("io2", 2.5, 2.0)], "io_id string, value double, timestamp double")
    write_points(to_points(pts), str(tmp_path / "points"))
    back = spark.read.parquet(str(tmp_path / "points"))
    assert {r.io_id for r in back.collect()} == {"io1", "io2"} and "measurement" in back.columns
    ev = spark.createDataFrame([("a", "cat1", datetime(2025, 3, 9, 1, 2, 3))], "name string, category string, event_datetime timestamp")
    write_parquet_batches(ev, str(tmp_path / "arch"))
    assert spark.read.parquet(str(tmp_path / "arch")).first().dt == "2025_03_09"
    v = to_topic_value(ev, key="name").first()
    assert v.key == "a" and '"event_datetime":"2025-03-09 01:02:03.000000"' in v.value
    ids = append_buffer(ev, str(tmp_path / "buf")).collect()
    assert len(ids) == 1
    frames = spark.createDataFrame([("cam1", "x.jpg", "YWJj"), ("cam1", "y.jpg", "*bad")],
                                   "device_id string, name string, img string")
    rows = blob_rows(frames).collect()
    assert [(r.path, bytes(r.content)) for r in rows] == [("cam1/x.jpg", b"abc")]
    up = upload_blobs(spark.createDataFrame([("f.bin", b"123", "cam1")], "name string, content binary, device_id string"),
                      str(tmp_path / "fs"), metadata_cols=("device_id",))
    assert up.first().filename == "f.bin"


def test_projection_helpers_and_batch_map(spark):
    from framewell.operators.infer import map_records
    from framewell.operators.parse import drop_columns, rename_with_alias
    df = spark.createDataFrame([(1, "a", 2.5)], "id long, img_bytes string, v double")
    assert drop_columns(df, "img_bytes", "start_time").columns == ["id", "v"]
    r = rename_with_alias(df, "id", "_id", stringify=("v",))
    assert r.columns[0] == "_id" and r.schema["v"].dataType.simpleString() == "string"
    doubled = map_records(df.select("id", "v"), lambda p: p.assign(v=p.v * 2), "id long, v double")
    assert doubled.first().v == 5.0


def test_drop_expired_stream(spark, tmp_path):
    from datetime import datetime, timedelta, timezone

    from framewell.streaming.changes import drop_expired
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    src_dir = str(tmp_path / "in")
    spark.createDataFrame([(1, now), (2, now - timedelta(days=3))], "id int, ts timestamp").write.json(src_dir)
    s = spark.readStream.schema("id int, ts timestamp").json(src_dir)
    q = (drop_expired(s, "ts", "1 day").writeStream.format("parquet").option("path", str(tmp_path / "out"))
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert [r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [1]


def test_ingest_metrics_and_inference_sink(spark, tmp_path):
    from framewell.operators.infer import LinearModel, infer_to_table
    from framewell.plans import fixtures as fx
    from framewell.sinks.tables import read_keyed_table
    from framewell.sources.topics import read_topic_files, write_topic_files
    from framewell.streaming.ingest import ingest_frames
    base = str(tmp_path / uuid.uuid4().hex)
    write_topic_files(fx.topic(spark, "/root/testdata/sf0.001"), base + "/topic", n_files=2)
    src = read_topic_files(spark, base + "/topic", max_files_per_trigger=1)
    ingest_frames(spark, src, base + "/images", base + "/blobs", base + "/rejects", checkpoint=base + "/ck",
                  trigger={"availableNow": True}, n_buckets=4, metrics_path=base + "/metrics").awaitTermination()
    m = spark.read.parquet(base + "/metrics").agg(F.sum("n_rows"), F.sum("n_good"), F.count(F.lit(1))).first()
    assert m[0] == 1000 and m[1] == 1000 - 60 and m[2] == 2
    emb = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").withColumn("seq", F.lit(1))
    path = scratch_path(spark, "infer") + "/t"
    infer_to_table(emb, "embedding", ["label"], "vec_id", path, "seq", LinearModel((0.1,) * 64), batch_id=0)
    assert read_keyed_table(spark, path).count() == emb.count()


def test_upsert_table_time_partitions_rewrite_only_touched(spark):
    import os
    path = scratch_path(spark, "test_upsert_parts") + "/t"
    day1 = spark.createDataFrame([("camA_0101.jpg", 1, "camA", "2024010100", "a"),
                                  ("camB_0101.jpg", 2, "camB", "2024010100", "b")],
                                 "name string, offset long, device_id string, hour string, v string")
    upsert_table(spark, day1, path, "name", "offset", batch_id=0, partition_by=["device_id", "hour"])
    untouched = os.path.join(path.replace("file:", ""), "device_id=camB", "hour=2024010100")
    before = sorted(os.listdir(untouched))
    day2 = spark.createDataFrame([("camA_0101.jpg", 5, "camA", "2024010100", "a2"),
                                  ("camA_0102.jpg", 6, "camA", "2024010200", "c")],
                                 "name string, offset long, device_id string, hour string, v string")
    upsert_table(spark, day2, path, "name", "offset", batch_id=1, partition_by=["device_id", "hour"])
    assert sorted(os.listdir(untouched)) == before            # camB partition not rewritten
    got = {r.name: r.v for r in read_keyed_table(spark, path).collect()}
    assert got == {"camA_0101.jpg": "a2", "camB_0101.jpg": "b", "camA_0102.jpg": "c"}


def test_relay_buffer_forwards_all_rows(spark, tmp_path):
    from framewell.sinks.topics import append_buffer
    from framewell.sources.topics import read_buffer_typed
    from framewell.streaming.ingest import relay_buffer
    src = str(tmp_path / "buf")
    append_buffer(spark.createDataFrame([("io1", 1.0, 1.5), ("io2", 2.0, 2.5)], "io_id string, value double, timestamp double"), src)
    q = relay_buffer(spark, read_buffer_typed(spark, src, "RAW", 5), str(tmp_path / "topic"),
                     key="io_id", checkpoint=str(tmp_path / "ck"), trigger={"availableNow": True})
    q.awaitTermination()
    out = spark.read.json(str(tmp_path / "topic")).collect()
    assert sorted(r.key for r in out) == ["io1", "io2"] and all('"value":' in r.value for r in out)


def test_collect_batches_timeout_flush(spark, tmp_path):
    import time
    d = str(tmp_path / uuid.uuid4().hex)
    spark.range(0, 70).select(F.col("id").alias("offset"), F.lit("cam0").alias("device_id"),
                              F.concat(F.lit("n"), F.col("id").cast("string")).alias("name")).write.json(d + "/in")
    src = spark.readStream.schema("offset long, device_id string, name string").json(d + "/in")
    out = collect_batches(src, "device_id", ["offset", "name"], 50, timeout_seconds=2)
    q = (out.writeStream.format("parquet").option("path", d + "/out").option("checkpointLocation", d + "/ck")
         .trigger(processingTime="1 second").start())
    rows, t0 = [], time.time()
    try:
        while time.time() - t0 < 60:
            time.sleep(2)
            try:
                rows = spark.read.parquet(d + "/out").groupBy("batch_no", "flushed_by").count().collect()
            except Exception:  # noqa: BLE001 - sink folder not written yet
                rows = []
            if sum(r["count"] for r in rows) >= 70:
                break
    finally:
        q.stop()
    assert sorted((r.batch_no, r.flushed_by, r["count"]) for r in rows) == [(0, "size", 50), (1, "timeout", 20)]


def test_ingest_restart_from_checkpoint_no_duplicates(spark, tmp_path):
    from framewell.plans import fixtures as fx
    from framewell.sources.topics import read_topic_files, write_topic_files
    from framewell.streaming.ingest import ingest_frames
    base = str(tmp_path / uuid.uuid4().hex)
    topic = fx.topic(spark, "/root/testdata/sf0.001")
    write_topic_files(topic.filter("offset < 600"), base + "/topic", n_files=2)

    def run():
        src = read_topic_files(spark, base + "/topic", max_files_per_trigger=1)
        ingest_frames(spark, src, base + "/images", base + "/blobs", base + "/rejects",
                      checkpoint=base + "/ck", trigger={"availableNow": True}, n_buckets=4,
                      metrics_path=base + "/metrics").awaitTermination()

    run()
    first = spark.read.parquet(base + "/metrics").count()
    run()                                              # nothing new: no batch, no rewrite
    assert spark.read.parquet(base + "/metrics").count() == first
    write_topic_files(topic.filter("offset >= 600"), base + "/topic", n_files=1)
    run()                                              # only the new file is processed
    m = spark.read.parquet(base + "/metrics").agg(F.sum("n_rows")).first()[0]
    assert m == topic.count()
    blobs = spark.read.parquet(base + "/blobs")
    assert blobs.count() == blobs.select("path", "_batch").distinct().count()
    from framewell.sources.blobs import read_blob_table
    live = read_blob_table(spark, base + "/blobs")
    t = read_keyed_table(spark, base + "/images")
    assert t.count() == t.select("name").distinct().count()
    assert live.count() == live.select("path").distinct().count() == t.count()


def test_fps_stream_counts_late_frames(spark, tmp_path):
    from datetime import datetime, timedelta

    from framewell.streaming.metrics import fps_stream, read_window_counts
    d = str(tmp_path / uuid.uuid4().hex)
    t0 = datetime(2024, 1, 1, 0, 0, 0)
    schema = "device_id string, event_time timestamp"
    first = [("cam0", t0 + timedelta(seconds=100, milliseconds=ms)) for ms in (0, 300, 600)] + \
            [("cam0", t0 + timedelta(seconds=130))]
    spark.createDataFrame(first, schema).write.json(d + "/in/a")
    src = spark.readStream.schema(schema).option("recursiveFileLookup", "true").json(d + "/in")

    def run():
        fps_stream(spark, src, "event_time", d + "/out", checkpoint=d + "/ck",
                   trigger={"availableNow": True}).awaitTermination()
    run()
    # out of order by half a minute: counted as well
    late = [("cam0", t0 + timedelta(seconds=125, milliseconds=500)), ("cam0", t0 + timedelta(seconds=100))]
    spark.createDataFrame(late, schema).write.json(d + "/in/b")
    run()
    got = {(r.second - t0).seconds: r.fps for r in read_window_counts(spark, d + "/out").collect()}
    assert got == {100: 4, 125: 1, 130: 1}
