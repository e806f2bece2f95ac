"""Sketches over micro-batches, retention of stored entries, ordered collecting, stored models, chunked objects, validated inserts."""

import hashlib
import json
import os
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewell.operators import infer, validate
from framewell.sinks import objects
from framewell.sinks.entries import append_entries, read_entries, trim_entries
from framewell.sinks.tables import read_keyed_table
from framewell.streaming.collect import collect_batches, collect_ordered, read_batches
from framewell.streaming.metrics import latency_stream, read_histogram, read_latency

T0 = datetime(2024, 1, 1)


# ---- sketches

def test_latency_merges_over_batches_and_spans(spark, tmp_path):
    rnd = random.Random(1)
    values = [(("a", "b")[i % 3 == 0], rnd.lognormvariate(1, 1)) for i in range(6000)]
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    os.makedirs(src)
    stream = spark.readStream.schema("k string, x double").option("maxFilesPerTrigger", "1").json(src)
    for part in range(3):
        spark.createDataFrame([*values[part * 2000:(part + 1) * 2000], ("c", None)], "k string, x double").coalesce(1).write.mode("append").json(src)
        latency_stream(spark, stream, "x", out, ["k"], [1, 5], checkpoint=str(tmp_path / "ck"), trigger={"availableNow": True}).awaitTermination()
    got = {r.k: r for r in read_latency(spark, out, ["k"]).collect()}
    hist = {(r.k, r.le): r["count"] for r in read_histogram(spark, out, [1, 5], ["k"]).collect()}
    assert set(got) == {"a", "b"}  # a key without a value has no row
    for k in "ab":
        x = np.array([v for key, v in values if key == k])
        r = got[k]
        assert (r.n, r.min_latency, r.max_latency) == (len(x), x.min(), x.max()) and abs(r.avg_latency - x.mean()) < 1e-9
        for q, v in ((0.5, r.p50_latency), (0.9, r.p90_latency), (0.99, r.p99_latency)):
            assert abs((x <= v).mean() - q) < 0.01
        assert [hist[k, le] for le in ("1", "5", "+Inf")] == [(x <= 1).sum(), (x <= 5).sum(), len(x)]
    last = read_latency(spark, out, ["k"], since=2).agg(F.sum("n")).first()[0]
    assert last == 2000


# ---- retention

def test_trim_drops_slots_rewrites_the_border_and_counts(spark, tmp_path):
    root = str(tmp_path / "e")
    times = [T0 + timedelta(minutes=7 * i) for i in range(300)]
    frame = lambda a, b: spark.createDataFrame([(i, times[i]) for i in range(a, b)] + [(-1, None)], "id long, ts timestamp")
    stored = set()
    for n, (a, b) in enumerate([(0, 100), (100, 220), (220, 300)]):
        for _ in range(2):  # a repeated batch replaces itself
            append_entries(frame(a, b), root, "ts", 3600, n)
        stored |= set(range(a, b))
        limit = times[b - 1] - timedelta(hours=5)
        gone = {i for i in stored if times[i] < limit}
        kept_files = {f for s in os.listdir(root) if s.startswith("slot=") and int(s[5:]) * 3600 > limit.timestamp() for f in os.listdir(f"{root}/{s}")}
        assert trim_entries(spark, root, "ts", 5 * 3600, 3600) == len(gone)
        stored -= gone
        assert sorted(r.id for r in read_entries(spark, root).collect()) == sorted(stored)
        assert trim_entries(spark, root, "ts", 5 * 3600, 3600) == 0
        assert kept_files <= {f for s in os.listdir(root) if s.startswith("slot=") for f in os.listdir(f"{root}/{s}")}
    assert trim_entries(spark, str(tmp_path / "none"), "ts", 1) == 0


def test_trim_without_batches(spark, tmp_path):
    root = str(tmp_path / "e")
    rows = [(i, T0 + timedelta(minutes=i)) for i in range(200)]
    append_entries(spark.createDataFrame(rows, "id long, ts timestamp_ntz"), root, "ts", 3600)
    assert trim_entries(spark, root, "ts", 3600, 3600) == 139
    assert sorted(r.id for r in read_entries(spark, root).collect()) == list(range(139, 200))


# ---- collecting

def arrive(spark, folder, rows):
    spark.createDataFrame(rows, "k string, id long, ts timestamp").coalesce(1).write.mode("append").json(folder)


def test_ordered_batches_over_triggers_and_timeouts(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    os.makedirs(src)
    at = lambda s: T0 + timedelta(seconds=s)
    stream = spark.readStream.schema("k string, id long, ts timestamp").option("maxFilesPerTrigger", "1").json(src)
    # ids come in any order; b's partial batch times out in the third trigger, the rest at the end
    runs = [[("a", i, at(1)) for i in (5, 3, 1, 2, 4)] + [("b", 1, at(2)), (None, 1, at(2))],
            [("a", i, at(3)) for i in (9, 8, 7, 6)] + [("b", 2, at(4))],
            [("a", 10, at(20))], [("z", 0, at(1000))]]
    for rows in runs:
        arrive(spark, src, rows)
        collect_ordered(spark, stream, out, "k", ["id"], 4, "id", "ts", timeout_seconds=15, checkpoint=str(tmp_path / "ck"),
                        trigger={"availableNow": True}, min_rows=2).awaitTermination()
    got = sorted(((r.k, r.batch_no, r.position, r.id, r.flushed_by) for r in read_batches(spark, out).collect()), key=str)
    want = [("a", 0, p, p + 1, "size") for p in range(4)] + [("a", 1, p, p + 5, "size") for p in range(4)]
    want += [("a", 2, 0, 9, "timeout"), ("a", 2, 1, 10, "timeout")]  # 9 came at 3 s, 20 s is past its 15
    want += [("b", 0, 0, 1, "timeout"), ("b", 0, 1, 2, "timeout"), (None, 0, 0, 1, "timeout")]
    assert got == sorted(want, key=str)
    left = [d for d in os.listdir(f"{out}/_left") if d.startswith("v=")]
    assert sorted(left) == ["v=2", "v=3"]


def test_event_time_timer_flushes_the_rest(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    os.makedirs(src)
    at = lambda s: T0 + timedelta(seconds=s)
    stream = spark.readStream.schema("k string, id long, ts timestamp").json(src).withWatermark("ts", "0 seconds")
    for rows in ([("a", i, at(i)) for i in range(7)] + [("b", 0, at(1))], [("end", 0, at(500))]):
        arrive(spark, src, rows)
        q = collect_batches(stream, "k", ["id"], 3, timeout_seconds=10, time_col="ts").writeStream.format("parquet").option(
            "path", out).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        q.awaitTermination()
    rows = [r for r in spark.read.parquet(out).collect() if r.k != "end"]
    assert sorted((r.k, r.id) for r in rows) == [("a", i) for i in range(7)] + [("b", 0)]
    assert sorted((r.k, r.batch_no, r.flushed_by) for r in rows if r.position == 0) == [("a", 0, "size"), ("a", 1, "size"), ("a", 2, "timeout"), ("b", 0, "timeout")]


# ---- models

def test_models_are_versions_that_scores_follow(spark, tmp_path):
    rows = [(i, [float(i % 2), float(i), 1.0], i % 2) for i in range(40)] + [(100, None, 1), (101, [1.0], 0), (102, [0.5, 1.0, 1.0], None)]
    df = spark.createDataFrame(rows, "id long, v array<double>, y int")
    root = str(tmp_path / "m")
    with pytest.raises(ValueError):
        infer.load_model(spark, root)
    full = df.where("id < 100")
    one = infer.fit_mean_difference(full, "v", F.col("y") == 1)
    x = np.array([r[1] for r in rows[:40]])
    a, b = x[1::2].mean(0), x[::2].mean(0)
    assert np.allclose(one.weights, a - b) and abs(one.bias - (b @ b - a @ a) / 2) < 1e-9
    assert infer.save_model(spark, root, one) == 1 and infer.save_model(spark, root, infer.LinearModel((0.0, 0.0, 0.0), 2.0)) == 2
    first, last = infer.load_model(spark, root, 1), infer.load_model(spark, root)
    assert (first.version, last.version) == (1, 2) and first.weights == one.weights
    got = {r.id: r for r in infer.infer(df, "v", ["id"], first).collect()}
    assert got[100].score is None and got[101].predicted is None and got[102].score is not None
    assert np.allclose([got[i].score for i in range(40)], 1 / (1 + np.exp(-(x @ np.array(one.weights) + one.bias))))
    table = str(tmp_path / "t")
    for batch, model in enumerate((first, last)):
        infer.infer_to_table(df, "v", ["y"], "id", table, "model_version", model, batch)
    stored = read_keyed_table(spark, table).collect()
    assert {r.model_version for r in stored} == {2} and {round(r.score, 6) for r in stored if r.score is not None} == {round(1 / (1 + np.exp(-2.0)), 6)}


# ---- objects

def test_objects_come_back_whole_and_damage_is_told(spark, tmp_path):
    rnd = random.Random(2)
    content = {"empty": b"", "one": b"x", "even": rnd.randbytes(300), "odd": rnd.randbytes(1234)}
    df = spark.createDataFrame([(k, bytearray(v), "m") for k, v in content.items()] + [("null", None, None)], "name string, content binary, kind string")
    root = str(tmp_path / "store")
    put = objects.put_rows(df, root, metadata_cols=["kind"], chunk_bytes=100)
    told = {r.filename: r for r in objects.list_objects(spark, root).collect()}
    assert {k: (r.length, r.n_chunks, r.metadata) for k, r in told.items()} == {
        k: (len(v), max(1, -(-len(v) // 100)), {"kind": "m"}) for k, v in content.items()}
    assert put.count() == 4
    files = {r.object_id: r for r in objects.get_files(spark, root, str(tmp_path / "files")).collect()}
    for name, data in content.items():
        r = files[told[name].object_id]
        assert open(r.path, "rb").read() == data and (r.length, r.sha256) == (len(data), hashlib.sha256(data).hexdigest())
    only = objects.list_objects(spark, root).where("filename = 'odd'")
    assert objects.get_files(spark, root, str(tmp_path / "f2"), only).count() == 1
    # ranges of files give the same chunks
    objects.put_files(spark, str(tmp_path / "files"), str(tmp_path / "again"), chunk_bytes=100)
    again = {r.filename: r.digest for r in objects.list_objects(spark, str(tmp_path / "again")).collect()}
    assert again == {r.object_id: r.digest for r in told.values() if r.filename != "empty"}
    # one chunk lost, one changed, one twice
    upload = next(d for d in os.listdir(f"{root}/chunks"))
    rows = spark.read.parquet(f"{root}/chunks/{upload}")
    bad = rows.where("not (filename = 'odd' and n = 3)").withColumn("bytes", F.when(F.expr("filename = 'even' and n = 1"), F.lit(b"y")).otherwise(F.col("bytes")))
    broken = str(tmp_path / "broken")
    bad.unionAll(rows.where("filename = 'one'")).write.parquet(f"{broken}/chunks/{upload}")
    objects.list_objects(spark, root).write.parquet(f"{broken}/manifest/{upload}")
    reasons = {r.filename: r.reasons for r in objects.verify_objects(spark, broken).collect()}
    assert reasons["empty"] == [] and "chunks are missing" in reasons["odd"] and "bytes changed" in reasons["even"] and "chunks too many" in reasons["one"]
    for name in ("odd", "even", "one"):
        ids = objects.list_objects(spark, broken).where(F.col("filename") == name)
        with pytest.raises(Exception, match="chunk"):
            objects.get_files(spark, broken, str(tmp_path / "f3"), ids).collect()
        assert not [f for f in os.listdir(tmp_path / "f3") if not f.startswith(".")]


# ---- validated inserts

MODEL = validate.model_from_json(json.dumps({
    "_id": {"type": "object_id"}, "name": {"type": "string", "required": True, "max_length": 5, "pattern": "^[a-z]+$"},
    "n": {"type": "int", "least": 0, "most": 10}, "at_datetime": "datetime", "kind": {"type": "string", "choices": ["x", "y"], "default": "x"}}))
RAW = "src long, _id string, name string, n string, at_datetime string, kind string, extra string"
ID = "0123456789abcdef01234567"


def test_every_reason_is_told_and_nothing_becomes_null(spark, tmp_path):
    rows = [(1, ID, "ab", "3", "2024-1-2", None, None), (2, ID.upper(), "ab", None, None, "y", None), (3, None, "ok", "10", None, None, None),
            (4, "short", "toolong", "11", "2 Jan", "z", "e"), (5, None, None, "x1", None, None, None), (6, None, "A1", "-1", None, None, None),
            (7, "f" * 24, "ok", "1", None, None, None)]
    docs = spark.createDataFrame(rows, RAW)
    target = spark.createDataFrame([("f" * 24, "old", 1, "kept")], "_id string, name string, n int, old string")
    got = validate.insert_validated(target, docs, MODEL, order="src")
    rejects = {r.src: r.reasons for r in got.rejects.collect()}
    assert rejects == {
        2: ["_id: repeated"], 4: ["_id: not object_id", "at_datetime: not datetime", "kind: not a choice", "n: more than 10", "name: longer than 5"],
        5: ["n: not int", "name: required"], 6: ["n: less than 0", "name: malformed"], 7: ["_id: stored already"]}
    ids = {r.src: r._id for r in got.ids.collect()}
    assert set(ids) == {1, 3} and ids[1] == ID and len(ids[3]) == 24 and int(ids[3], 16) >= 0
    assert tuple(got.counts.first()) == (2, 5)
    table = {(r.name, r.n, r.old) for r in got.table.collect()}
    assert table == {("old", 1, "kept"), ("ab", 3, None), ("ok", 10, None)}
    strict = {r.src: r.reasons for r in validate.checked(docs, {k: v for k, v in MODEL.items()}, strict=True).select("src", "reasons").collect()}
    assert "extra: unknown" in strict[4] and strict[1] == ["src: unknown"]
    empty = validate.insert_validated(target, docs.limit(0), MODEL, order="src")
    assert tuple(empty.counts.first()) == (0, 0) and empty.table.count() == 1


def test_models_from_files_and_schemas(spark, tmp_path):
    path = tmp_path / "model.json"
    path.write_text(json.dumps({"a": "int", "b": {"type": "string", "required": True}}, indent=1))
    model = validate.load_model(spark, str(path))
    assert model["a"].type == "int" and model["b"].required
    from framewell import schemas
    rules = validate.model_from_schema(schemas.USER, ["email"])
    rows = spark.createDataFrame([(None, "n", None, None)], "id string, name string, email string, is_active string")
    assert validate.checked(rows, rules).first().reasons == ["email: required", "id: required"]
