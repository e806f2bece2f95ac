"""Scalar functions and predicate building (T*, F1, F2, T6, T7)."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from framewell.functions import codec, paths, predicates, timefmt


def one(spark, col, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"x {dtype}").select(col.alias("r")).first()["r"]


def test_request_dates(spark):
    p = timefmt.parse_request_date(F.col("x"))
    assert one(spark, p, "2025-3-9") == datetime(2025, 3, 9)
    assert one(spark, p, "2025/03/09") == datetime(2025, 3, 9)
    assert one(spark, p, "2025-03-09 12:30:45") == datetime(2025, 3, 9, 12, 30, 45)
    assert one(spark, p, "2025-03-09T12:30:45") is None
    assert timefmt.parse_request_date_literal("2025-3-9") == datetime(2025, 3, 9)
    with pytest.raises(ValueError):
        timefmt.parse_request_date_literal("2025-03-09T12:30:45")


def test_event_time_text(spark):
    p = timefmt.parse_event_time(F.col("x"))
    assert one(spark, p, "2025-03-09T12:30:45.123Z") == datetime(2025, 3, 9, 12, 30, 45, 123000)
    assert one(spark, p, "2025-03-09T12:30:45.123456Z") == datetime(2025, 3, 9, 12, 30, 45, 123456)
    assert one(spark, p, "2025-03-09T12:30:45Z") is None


def test_base64_round_trip_and_rejects(spark):
    long_bytes = bytes(range(200))
    enc = one(spark, codec.b64encode(F.col("x")), long_bytes, "binary")
    assert "\r" not in enc and "\n" not in enc and len(enc) > 76
    assert bytes(one(spark, codec.b64decode(F.col("x")), enc)) == long_bytes
    assert one(spark, codec.b64decode(F.col("x")), "*ZXJyb3I=") is None
    assert one(spark, codec.b64decode(F.col("x")), "ZXJyb3I") is None  # missing padding
    chunked = one(spark, F.base64(F.col("x")), long_bytes, "binary")
    assert bytes(one(spark, codec.b64decode(F.col("x")), chunked)) == long_bytes


def test_mime_and_paths(spark):
    assert one(spark, paths.mime_type(F.col("x")), "a/b/c.JPG") == "image/jpeg"
    assert one(spark, paths.mime_type(F.col("x")), "a/b/c.parquet") == "application/octet-stream"
    assert one(spark, paths.mime_type(F.col("x")), "noext") == "application/octet-stream"
    assert one(spark, paths.img_path(F.lit("cam1"), F.col("x")), None) is None
    k = one(spark, paths.object_key(F.lit("cat"), F.col("x")), datetime(2025, 3, 9, 1, 2, 3), "timestamp")
    assert k.startswith("cat/2025_03_09/20250309_010203_") and k.endswith(".parquet")
    assert one(spark, paths.frame_name(F.lit("cam1"), F.col("x")), datetime(2025, 3, 9, 1, 2, 3, 4), "timestamp") \
        == "cam1_250309_010203_000004.jpg"


def test_json_encode_keeps_nulls_and_micros(spark):
    df = spark.createDataFrame([(datetime(2025, 3, 9, 1, 2, 3, 4), None)], "t timestamp, s string")
    txt = df.select(codec.encode_json(F.struct("t", "s")).alias("j")).first()["j"]
    assert txt == '{"t":"2025-03-09 01:02:03.000004","s":null}'


def test_query_operators(spark):
    df = spark.createDataFrame([(1, "a", None, [1, 2]), (2, "b", 5.0, [3]), (3, None, 7.0, None)],
                               "id int, s string, v double, arr array<int>")
    q = lambda d: sorted(r.id for r in df.filter(predicates.query_to_column(d, df.schema)).collect())
    assert q({"s": "a"}) == [1]
    assert q({"s": None}) == [3]
    assert q({"s": {"$ne": "a"}}) == [2, 3]            # null matches $ne
    assert q({"s": {"$in": ["a", None]}}) == [1, 3]
    assert q({"s": {"$nin": ["a"]}}) == [2, 3]
    assert q({"v": {"$gte": 5, "$lt": 7}}) == [2]
    assert q({"v": {"$exists": False}}) == [1]
    assert q({"$or": [{"id": 1}, {"v": 7.0}]}) == [1, 3]
    assert q({"arr": 2}) == [1]                         # scalar matches array element
    assert q({"s": {"$regex": "^[ab]$"}}) == [1, 2]
    with pytest.raises(ValueError):
        predicates.query_to_column({"s": {"$bogus": 1}}, df.schema)


def test_conditions_text(spark):
    q = predicates.conditions_to_query(["event_datetime>=2025-03-09", "event_datetime<=2025-03-10", "device_id=cam1"])
    assert q == {"event_datetime": {"$gte": "2025-03-09", "$lte": "2025-03-10"}, "device_id": {"$eq": "cam1"}}
    df = spark.createDataFrame([("cam1", datetime(2025, 3, 9, 5)), ("cam2", datetime(2025, 3, 9, 5)),
                                ("cam1", datetime(2025, 3, 11))], "device_id string, event_datetime timestamp")
    assert df.filter(predicates.conditions_to_column(
        ["event_datetime>=2025-03-09", "event_datetime<=2025-03-10", "device_id=cam1"], df.schema)).count() == 1
    with pytest.raises(ValueError):
        predicates.conditions_to_column(["nope=1"], df.schema)


def test_coerce_query():
    q = predicates.coerce_query({"event_datetime": {"$gte": "2025-03-09"}, "_id": {"$in": ["a", "b"]},
                                 "update_datetime": "2025/03/09"})
    assert q["event_datetime"]["$gte"] == datetime(2025, 3, 9)
    assert q["update_datetime"] == datetime(2025, 3, 9)
    with pytest.raises(ValueError):
        predicates.coerce_query({"event_datetime": "09.03.2025"})
    assert predicates.is_object_id("0123456789abcdef01234567")
    assert not predicates.is_object_id("xyz")
