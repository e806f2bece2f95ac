"""Operators on hand-made frames: edge cases and property checks."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from framewell import schemas
from framewell.operators import changes, collection, mutations, ordering, parse, series


def test_validate_good_plus_rejects_is_input(spark):
    rows = [(1, '{"device_id":"c","name":"n1","timestamp":1.5,"width":"1","height":"1","img":"YQ=="}'),
            (2, '{"device_id":"c","name":"n2","timestamp":"1.5","width":"1","height":"1","img":"YQ=="}'),
            (3, '{"device_id":"c","timestamp":1.5,"width":"1","height":"1","img":"YQ=="}'),
            (4, '{"device_id":"c","name":"n4","timestamp":1.5,"width":"1","height":"1","img":"@@"}'),
            (5, '{"device_id":"c","name":"n5",'), (6, None)]
    df = spark.createDataFrame(rows, "offset long, value string")
    v = parse.validate_frames(df, keep=["offset"])
    good, bad = parse.split_rejects(v)
    assert good.count() + bad.count() == df.count()
    errs = {r.offset: r.errors for r in bad.collect()}
    assert sorted(r.offset for r in good.collect()) == [1, 2]  # quoted number accepted
    assert errs[3] == ["name is required"] and errs[4] == ["img is not base64"]
    assert errs[5] == ["malformed message"] and errs[6] == ["malformed message"]
    strict = parse.parse_messages(df, keep=["offset"])
    assert {r.offset for r in strict.filter("parse_ok").collect()} == {1, 3, 4}


def test_keep_last_late_and_out_of_order(spark):
    # arrival order (offset) decides, not event time
    df = spark.createDataFrame([(1, "a", 10.0), (3, "a", 5.0), (2, "a", 20.0), (4, "b", 1.0)],
                               "offset long, name string, timestamp double")
    out = {r.name: (r.offset, r.timestamp) for r in ordering.keep_last(df, "name", "offset").collect()}
    assert out == {"a": (3, 5.0), "b": (4, 1.0)}
    assert ordering.keep_last(df.drop("name"), "name", "offset").count() == 4  # no key column: skipped


def _random_frames(spark, n=3000, devices=4, seed=7):
    rnd = random.Random(seed)
    t0 = datetime(2024, 1, 1)
    rows = [(i, f"d{rnd.randrange(devices)}", t0 + timedelta(seconds=rnd.randrange(10 * 86400)),
             f"p{rnd.randrange(3)}") for i in range(n)]
    return spark.createDataFrame(rows, "id long, device_id string, ts timestamp, img_path string")


def test_sliced_sequence_matches_global_window(spark):
    df = _random_frames(spark)
    got = ordering.sequence_index(df, "device_id", ["ts", "id"], bucket=F.date_trunc("hour", "ts"))
    adaptive = ordering.sequence_index(df, "device_id", ["ts", "id"], min_rows=1)
    assert adaptive.select("id", "frame_index").exceptAll(got.select("id", "frame_index")).count() == 0
    w = Window.partitionBy("device_id").orderBy("ts", "id")
    exp = df.withColumn("frame_index", F.row_number().over(w) - 1)
    assert got.select("id", "frame_index").exceptAll(exp.select("id", "frame_index")).count() == 0
    assert got.count() == df.count()


def test_sliced_previous_value_matches_lag(spark):
    df = _random_frames(spark)
    got = ordering.previous_value(df, "img_path", "device_id", ["ts", "id"], bucket=F.date_trunc("hour", "ts"))
    w = Window.partitionBy("device_id").orderBy("ts", "id")
    exp = df.withColumn("prev_value", F.lag("img_path").over(w))
    assert got.select("id", "prev_value").exceptAll(exp.select("id", "prev_value")).count() == 0
    adaptive = ordering.previous_value(df, "img_path", "device_id", ["ts", "id"], min_rows=1)
    assert adaptive.select("id", "prev_value").exceptAll(exp.select("id", "prev_value")).count() == 0
    changed = ordering.emit_on_change(df, "img_path", "device_id", ["ts", "id"], min_rows=1)
    assert changed.count() == exp.filter(~F.col("img_path").eqNullSafe(F.col("prev_value"))).count()


def test_pages_concatenate_to_full_sort(spark):
    df = _random_frames(spark, n=95)
    full = [r.id for r in ordering.paginate(df, ["-ts"], tie_break="id").collect()]
    pages = []
    for p in range(1, 12):
        pages += [r.id for r in ordering.paginate(df, ["-ts"], 10, p, tie_break="id").collect()]
    assert pages == full
    assert ordering.paginate(df, ["-ts"], 10, 99, tie_break="id").count() == 0      # beyond the end
    assert [r.id for r in ordering.paginate(df, ["-ts"], 10, 0, tie_break="id").collect()] == full[:10]  # page 0 -> 1
    # keyset pages give the same sequence
    seen, after = [], None
    while True:
        page = ordering.keyset_page(df, ["-ts", "id"], after, 10).collect()
        if not page:
            break
        seen += [r.id for r in page]
        after = (page[-1].ts, page[-1].id)
    assert seen == full


def test_page_count_and_total(spark):
    df = spark.range(0, 25).withColumnRenamed("id", "_id")
    page = collection.find_with_paginate(df, {"_id": {"$gte": 3}}, sort=["-_id"], page_size=10, page_num=3)
    rows = page.collect()
    assert [r._id for r in rows] == [4, 3] and rows[0].total_count == 22
    assert spark.range(1).select(ordering.page_count(F.lit(0), 10).alias("p")).first().p == 1


def test_push_null_and_missing_arrays_and_array_filter(spark):
    schema = "_id string, tags array<string>, items array<struct<k:int,v:string>>"
    df = spark.createDataFrame([("a", None, None), ("b", ["x"], [(1, "p"), (2, "q")])], schema)
    out = mutations.update(df, {}, push={"tags": "new"})
    got = {r._id: r.tags for r in out.collect()}
    assert got == {"a": ["new"], "b": ["x", "new"]}
    missing = mutations.update(df, {"_id": "b"}, push={"labels": "first"})
    assert {r._id: r.labels for r in missing.collect()} == {"a": None, "b": ["first"]}
    none = mutations.update(df, {"_id": "b"}, set={"items.$[e].v": "z"}, array_filter={"e.k": 9})
    r = none.filter("_id = 'b'").first()
    assert [x.v for x in r["items"]] == ["p", "q"] and r["_modified"] is False
    some = mutations.update(df, {"_id": "b"}, set={"items.$[e].v": "z"}, array_filter={"e.k": {"$gte": 2}})
    assert [x.v for x in some.filter("_id = 'b'").first()["items"]] == ["p", "z"]


def test_delete_with_null_predicate_keeps_row(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), ("c", 3)], "_id string, v int")
    kept = mutations.delete_many(df, {"v": {"$gt": 1}})
    assert sorted(r._id for r in kept.collect()) == ["a", "b"]
    assert mutations.deleted_count(df, {"v": {"$gt": 1}}).first().deleted_count == 1
    assert sorted(r._id for r in mutations.delete_one(df, {"v": {"$exists": True}}).collect()) == ["b", "c"]


def test_merge_keeps_untouched_fields_and_is_idempotent(spark):
    target = spark.createDataFrame([("n1", 1, "old", "keep"), ("n2", 2, "old2", "keep2")],
                                   "name string, offset long, img_path string, label string")
    batch = spark.createDataFrame([("n1", 5, "new"), ("n1", 4, "older"), ("n3", 6, "ins")],
                                  "name string, offset long, img_path string")
    m = mutations.merge_by_key(target, batch, "name", "offset")
    got = {r.name: (r.offset, r.img_path, r.label) for r in m.collect()}
    assert got == {"n1": (5, "new", "keep"), "n2": (2, "old2", "keep2"), "n3": (6, "ins", None)}
    again = mutations.merge_by_key(m, batch, "name", "offset")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, m.collect()))
    stale = spark.createDataFrame([("n1", 3, "stale")], "name string, offset long, img_path string")
    g = mutations.merge_by_key(m, stale, "name", "offset", guard=True).filter("name = 'n1'").first()
    assert g.img_path == "new"


def test_update_one_and_upsert(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "x"), ("c", "y")], "_id string, s string")
    out = mutations.update(df, {"s": "x"}, set={"s": "z"}, one=True)
    assert {r._id: r.s for r in out.collect()} == {"a": "z", "b": "x", "c": "y"}
    up = mutations.update(df, {"_id": "q"}, set={"s": "new"}, upsert=True)
    assert up.filter("_id = 'q'").first().s == "new" and up.count() == 4
    no_up = mutations.update(df, {"_id": "a"}, set={"s": "new"}, upsert=True)
    assert no_up.count() == 3


def test_update_many_counts_twice(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "_id string, v int")
    out = mutations.update_many(df, [{"query": {"v": 1}, "set": {"v": 5}},
                                     {"query": {"v": {"$gte": 2}}, "set": {"v": 9}},
                                     {"query": {"v": 9}}])
    got = {r._id: (r.v, r._modified_count) for r in out.collect()}
    assert got == {"a": (9, 2), "b": (9, 1)}


def test_constraints(spark):
    df = spark.createDataFrame([(1, "a", "x@y.org"), (1, "b", "x@y.org"), (2, None, "bad"), (3, "c", None)],
                               "id long, name string, email string")
    v = {(r.constraint, r.value): r.n for r in mutations.check_constraints(
        df, not_null=["name", "email"]).collect()}
    assert v[("duplicate id", "1")] == 2 and v[("duplicate email", "x@y.org")] == 2
    assert v[("null name", None)] == 1 and v[("null email", None)] == 1 and v[("bad email", "bad")] == 1


def test_change_routing_edge_events(spark):
    env = spark.createDataFrame(
        [("images", "1", "delete", {"img_path": "a/1.jpg"}), ("images", "2", "delete", None),
         ("images", "3", "truncate", None), ("other", "4", "delete", {"img_path": "a/4.jpg"}),
         ("images", "5", "delete", {"img_path": ""})],
        "collection string, doc_id string, operation_type string, before_doc struct<img_path:string>")
    acts = {r.doc_id: r.action for r in changes.route_by_operation(env).collect()}
    assert acts == {"1": "delete_blob", "2": "none", "3": "ignore", "5": "none"}
    blobs = spark.createDataFrame([("a/1.jpg", b"x"), ("a/4.jpg", b"y")], "path string, content binary")
    assert [r.path for r in changes.cascade_delete(blobs, env).collect()] == ["a/4.jpg"]


def test_histogram_and_retention(spark):
    df = spark.createDataFrame([(v,) for v in [1, 2, 2, 5, 50]], "lat int")
    h = {r.le: r["count"] for r in series.latency_histogram(df, "lat", [1, 2, 10]).collect()}
    assert h == {"1": 1, "2": 3, "10": 4, "+Inf": 5}
    t0 = datetime(2024, 1, 2)
    ev = spark.createDataFrame([(1, t0), (2, t0 - timedelta(hours=30)), (3, t0 - timedelta(hours=3))],
                               "id int, ts timestamp")
    assert sorted(r.id for r in series.retain_recent(ev, "ts", "1 day").collect()) == [1, 3]
    assert series.removed_count(ev, "ts", "1 day").first().removed_count == 1


def test_distinct_and_aggregate(spark):
    df = spark.createDataFrame([("a", 1, True), ("a", 2, None), ("b", 1, False)], "s string, n long, f boolean")
    d = {(r.field, r.value, r.type) for r in collection.distinct_values(df, ["s", "n", "f"]).collect()}
    assert d == {("s", "a", "str"), ("s", "b", "str"), ("n", "1", "int"), ("n", "2", "int"),
                 ("f", "True", "bool"), ("f", "False", "bool")}
    out = collection.aggregate(df, [{"$match": {"n": {"$gte": 1}}},
                                    {"$sort": {"n": 1}},
                                    {"$group": {"_id": "$s", "total": {"$sum": "$n"}, "first_n": {"$first": "$n"}}},
                                    {"$sort": {"_id": 1}}, {"$limit": 1}])
    r = out.first()
    assert (r["_id"], r.total, r.first_n) == ("a", 3, 1)
    with pytest.raises(ValueError):
        collection.aggregate(df, [{"$group": {"_id": "$s", "all": {"$push": "$n"}}}])
    assert collection.aggregate(df, [{"$count": "n_docs"}]).first().n_docs == 3


def test_registry_and_projection(spark):
    assert schemas.schema_by_name("IMG") == schemas.FRAME
    with pytest.raises(ValueError):
        schemas.schema_by_name("VIDEO")
    df = spark.createDataFrame([(1, "e", True, "h")], "id long, email string, is_active boolean, hashed_password string")
    assert parse.project_model(df, "UserRead").columns == ["id", "email", "is_active"]
    with pytest.raises(KeyError):
        parse.project_model(df, "Nope")


def test_hot_key_is_split_into_small_slices(spark):
    # one device holds 90% of the rows, all inside one day
    rnd = random.Random(3)
    t0 = datetime(2024, 1, 1)
    rows = [(i, "hot" if rnd.random() < 0.9 else f"d{i % 5}", t0 + timedelta(seconds=rnd.randrange(86400)))
            for i in range(4000)]
    df = spark.createDataFrame(rows, "id long, device_id string, ts timestamp")
    sliced = ordering.adaptive_slices(df, ["device_id"], ["ts", "id"], min_rows=1)
    biggest = sliced.groupBy("device_id", "_b").count().agg(F.max("count")).first()[0]
    assert biggest < 400  # about sqrt(3600) = 60 per slice, far below the 3600 of the key
    whole = ordering.adaptive_slices(df, ["device_id"], ["ts", "id"])
    assert whole.groupBy("device_id").agg(F.countDistinct("_b").alias("k")).agg(F.max("k")).first()[0] == 1
    got = ordering.sequence_index(df, "device_id", ["ts", "id"], min_rows=1)
    w = Window.partitionBy("device_id").orderBy("ts", "id")
    exp = df.withColumn("frame_index", F.row_number().over(w) - 1)
    assert got.select("id", "frame_index").exceptAll(exp.select("id", "frame_index")).count() == 0


def test_fps_resets_match_sequential_loop(spark):
    from framewell.operators.resets import fps_resets
    rnd = random.Random(11)
    t0 = datetime(2024, 1, 1)
    rows = []
    for dev, n, rate in (("hot", 3000, 25), ("b", 300, 4), ("c", 2, 1)):
        t = 0.0
        for i in range(n):
            t += rnd.expovariate(rate) if rnd.random() > 0.01 else rnd.uniform(1, 3)
            rows.append((dev, f"{dev}{i}", t0 + timedelta(microseconds=int(t * 1e6))))
    df = spark.createDataFrame(rows, "device_id string, name string, event_datetime timestamp")
    got = sorted((r.device_id, r.reset_time, r.fps) for r in fps_resets(df, min_rows=1).collect())
    whole = sorted((r.device_id, r.reset_time, r.fps) for r in fps_resets(df).collect())
    exp = []
    for dev in ("hot", "b", "c"):
        ts = sorted(r[2] for r in rows if r[0] == dev)
        secs = [(x - datetime(1970, 1, 1)).total_seconds() for x in ts]
        exp += [(dev, ts[i], c) for i, c in _resets_one_by_one(secs)]
    assert got == sorted(exp) and whole == sorted(exp)


def test_find_by_id_reports_misses(spark):
    docs = spark.createDataFrame([("a", 1), ("b", 2)], "_id string, v int")
    ids = spark.createDataFrame([("a",), ("z",), ("a",)], "requested_id string")
    got = {r.requested_id: (r.code, r.message) for r in collection.find_by_id(docs, ids).collect()}
    assert got == {"a": (200, None), "z": (400, "doc is not found, doc_id : z")}
    users = collection.find_by_id(docs, ids, miss_code=404).filter("requested_id = 'z'").first()
    assert users.code == 404


def test_partial_records_keep_untouched_fields(spark):
    target = spark.createDataFrame([("n1", 1, "w0", "h0", "keep")],
                                   "name string, offset long, width string, height string, label string")
    batch = spark.createDataFrame([("n1", 5, "w5", None), ("n1", 6, None, "h6"), ("n2", 7, None, "h7")],
                                  "name string, offset long, width string, height string")
    m = {r.name: (r.offset, r.width, r.height, r.label)
         for r in mutations.merge_by_key(target, batch, "name", "offset", partial=True).collect()}
    assert m == {"n1": (6, "w5", "h6", "keep"), "n2": (7, None, "h7", None)}
    whole = {r.name: (r.width, r.height)
             for r in mutations.merge_by_key(target, batch, "name", "offset").collect()}
    assert whole["n1"] == (None, "h6")   # whole-row mode: the last message replaces the row


def _resets_one_by_one(times):
    """(position, frames since the reset before) of every frame more than a second after the
    last reset; the first frame counts as one."""
    found, start, since = [], 0, times[0] if times else None
    for at, t in enumerate(times):
        if t - since > 1.0:
            found.append((at, at + 1 - start))
            start, since = at + 1, t
    return found
