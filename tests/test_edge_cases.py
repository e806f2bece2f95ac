"""Null keys, null orders, misses, repeats and malformed input of the collection operators."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from framewell.functions import paths, predicates, timefmt
from framewell.operators import collection, config, mutations, ordering
from framewell.sinks.blobs import upload_blobs
from framewell.sources.blobs import read_blob


def test_null_keys_keep_their_rows(spark):
    rows = [("a", 1.0, "x"), ("a", 2.0, "x"), (None, 1.0, "x"), (None, 2.0, "y")]
    df = spark.createDataFrame(rows, "k string, t double, v string")
    got = ordering.sequence_index(df, "k", "t", out="i").orderBy("k", "t").collect()
    assert [(r.k, r.t, r.i) for r in got] == [(None, 1.0, 0), (None, 2.0, 1), ("a", 1.0, 0), ("a", 2.0, 1)]
    assert ordering.emit_on_change(df, "v", "k", "t").count() == 3
    assert ordering.count_batches(df, 1, "k", "t").count() == 4


def test_keep_last_ranks_null_orders_lowest(spark):
    df = spark.createDataFrame([("n", None, "only"), ("m", None, "old"), ("m", 1, "new")], "name string, o int, v string")
    assert {(r.name, r.o, r.v) for r in ordering.keep_last(df, "name", "o").collect()} == {("n", None, "only"), ("m", 1, "new")}


def test_delete_one_without_a_match_keeps_all(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2)], "_id string, v int")
    assert mutations.delete_one(df, {"v": 9}).count() == 2
    assert [r.v for r in mutations.delete_one(df, {"v": 2}).collect()] == [1]


def test_update_by_key_keeps_fields_of_earlier_requests(spark):
    df = spark.createDataFrame([("k", 0, 0)], "k string, a int, b int")
    req = spark.createDataFrame([("k", 1, 5, None), ("k", 2, None, 6)], "k string, o int, a int, b int")
    assert [(r.a, r.b) for r in mutations.update_by_key(df, req, "k", "o", ["a", "b"]).collect()] == [(5, 6)]


def test_null_primary_key_is_a_violation(spark):
    df = spark.createDataFrame([(None, "a@b.cd", "n", "h"), (1, "c@d.ef", "n", "h")], "id long, email string, name string, hashed_password string")
    got = {(r.constraint, r.value, r.n) for r in mutations.check_constraints(df).collect()}
    assert got == {("null id", None, 1)}


def test_repeated_conditions_all_hold(spark):
    df = spark.createDataFrame([(5.0,), (15.0,), (25.0,)], "price double")
    assert [r.price for r in collection.find_expr(df, ["price>=20", "price>=10"]).collect()] == [25.0]


def test_nested_config_of_any_depth_and_malformed_text(spark):
    df = spark.createDataFrame([(1, '{"a":{"b":{"c":{"d":{"e":{"f":"}{{"}}}}}}'), (2, "{bad"), (3, None)], "id int, doc string")
    got = {(r.id, r.key, r.value, r.type) for r in config.flatten_config(df, "doc", ["id"]).collect()}
    assert got == {(1, "a.b.c.d.e.f", "}{{", "str"), (2, None, "{bad", "malformed")}


@pytest.mark.parametrize(("name", "kind"), [("a.heic", "image/heic"), ("a.avif", "image/avif"), ("a.ppm", "image/x-portable-pixmap"),
                                            ("a.jpg.gz", "image/jpeg"), ("a.JPEG", "image/jpeg"), ("a.none", "application/octet-stream")])
def test_mime_types_follow_the_standard_table(spark, name, kind):
    assert spark.range(1).select(paths.mime_type(F.lit(name))).first()[0] == kind


def test_request_dates():
    assert timefmt.parse_request_date_literal("2025/3/9") == datetime(2025, 3, 9)
    assert timefmt.parse_request_date_literal("2025-3-9 1:02:03") == datetime(2025, 3, 9, 1, 2, 3)
    for bad in ("2025/3-9", "2025-13-01", "2025/3/9 1:02:03", "x"):
        with pytest.raises(ValueError, match=".+"):
            timefmt.parse_request_date_literal(bad)
    got = predicates.coerce_query({"$or": [{"event_datetime": {"$in": ["2025-03-09"]}}, {"name": "2025-03-09"}]})
    assert got == {"$or": [{"event_datetime": {"$in": [datetime(2025, 3, 9)]}}, {"name": "2025-03-09"}]}


def test_blob_by_key_and_uploads_return_their_own(spark, tmp_path):
    for place in ("cam1", "old/cam1"):
        (tmp_path / place).mkdir(parents=True)
        (tmp_path / place / "b.txt").write_bytes(place.encode())
    assert [bytes(r.content) for r in read_blob(spark, str(tmp_path), "cam1/b.txt").collect()] == [b"cam1"]
    root = str(tmp_path / "up")
    one = spark.createDataFrame([("f", b"1")], "name string, content binary")
    upload_blobs(one, root)
    assert upload_blobs(one.withColumn("name", F.lit("g")), root).select("filename").collect() == [("g",)]
    assert spark.read.parquet(root).count() == 2


def test_upserted_document_has_pushed_and_dotted_fields(spark):
    df = spark.createDataFrame([("a", None, None)], "_id string, tags array<string>, meta struct<a:int,b:string>")
    out = mutations.update(df, {"_id": "n"}, set={"meta.a": 1}, push={"tags": "t"}, upsert=True)
    assert {r._id: (r.tags, r.meta and tuple(r.meta), r._modified) for r in out.collect()} == {
        "a": (None, None, False), "n": (["t"], (1, None), False)}


def test_set_below_a_missing_parent_makes_documents(spark):
    df = spark.createDataFrame([("a", None), ("b", None)], "_id string, meta struct<a:int,b:string>")
    out = mutations.update(df, {"_id": "a"}, set={"meta.a": 1, "new.x.y": 2, "new.z": 3})
    got = {r._id: (r.meta and tuple(r.meta), r.new and (r.new.x.y, r.new.z)) for r in out.collect()}
    assert got == {"a": ((1, None), (2, 3)), "b": (None, None)}


def test_upsert_without_a_text_key_needs_one(spark):
    with pytest.raises(ValueError, match="_id"):
        mutations.update(spark.createDataFrame([(1, 2)], "_id int, v int"), {"v": 3}, upsert=True)
