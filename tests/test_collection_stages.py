"""Aggregation stages, texts of doubles, lenient base64, object ids in queries, totals of empty pages."""

import base64
import binascii
import random

import pytest
from pyspark.sql import functions as F

from framewell.functions.codec import b64decode_lenient, py_float
from framewell.functions.predicates import coerce_query
from framewell.operators.collection import aggregate, find_with_paginate


def test_doubles_as_python_writes_them(spark):
    rnd = random.Random(1)
    values = [0.0, -0.0, 1.0, 1e7, 12345678.0, 1e15, 9999999999999998.0, 1e16, 1.5e16, 1e22, 1e300, 0.001, 0.0001, 0.00012, 0.00099, 1e-5, 1.25e-7, -1e7, -2.5e-9, 123456.789,
              float("inf"), float("-inf"), float("nan"), 1e100]
    values += [round(rnd.uniform(-1, 1) * 10 ** rnd.randint(-6, 17), rnd.randint(0, 4)) for _ in range(300)]
    got = [r.t for r in spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").select(py_float("v").alias("t")).collect()]
    assert got == [str(v) for v in values] + [None]


def test_lenient_base64_reads_what_a_lenient_decoder_reads(spark):
    rnd = random.Random(2)
    texts = ["YWJj", "YW Jj\r\n", "*YWJj", "YWI=", "YQ==", "YQ=", "YQ", "YWJjZ", "", "====", "YWI=YWJj", "YQ==YQ==", "Y!W@I#=", "YWJj="]
    texts += ["".join(rnd.choice("*\n") + c if rnd.random() < 0.2 else c for c in base64.b64encode(rnd.randbytes(rnd.randint(0, 200))).decode()) for _ in range(50)]

    def plain(t):
        try:
            return base64.b64decode(t)
        except binascii.Error:
            return None

    got = [None if r.b is None else bytes(r.b) for r in spark.createDataFrame([(t,) for t in texts], "t string").select(b64decode_lenient("t").alias("b")).collect()]
    assert got == [plain(t) for t in texts]
    assert spark.createDataFrame([(None,)], "t string").select(b64decode_lenient("t").alias("b")).first().b is None


def test_object_ids_in_queries_take_their_stored_form():
    up, low = "0123456789ABCDEF01234567", "0123456789abcdef01234567"
    assert coerce_query({"_id": up, "name": up}) == {"_id": low, "name": up}
    assert coerce_query({"_id": {"$in": [up, "short", 5]}}) == {"_id": {"$in": [low, "short", 5]}}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [("a", 1, 10.0, ["x", "y"]), ("a", 2, 30.0, []), ("b", 3, 20.0, None), (None, 4, 5.0, ["z"]), (None, 5, 7.0, None)]
    return spark.createDataFrame(rows, "k string, n long, v double, tags array<string>")


def test_groups_with_bounded_lists(spark, docs):
    out = aggregate(docs, [{"$group": {"_id": "$k", "top": {"$topN": {"n": 1, "sortBy": {"v": -1}, "output": "$n"}},
                                       "last": {"$bottomN": {"n": 2, "sortBy": {"v": -1}, "output": "$n"}}, "s": {"$sum": "$v"}}}])
    assert {r._id: (r.top, r["last"], r.s) for r in out.collect()} == {"a": ([2], [2, 1], 40.0), "b": ([3], [3], 20.0), None: ([5], [5, 4], 12.0)}
    whole = aggregate(docs, [{"$group": {"_id": None, "top": {"$topN": {"n": 2, "sortBy": {"n": 1}, "output": "$k"}}}}]).first()
    assert whole.top == ["a", "a"]
    with pytest.raises(ValueError, match="whole groups"):
        aggregate(docs, [{"$group": {"_id": "$k", "all": {"$push": "$n"}}}])


def test_lookup_forms(spark, docs):
    other = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("c", 4), (None, 5)], "key string, w long")
    spec = {"from": "o", "localField": "k", "foreignField": "key", "as": "m"}
    rows = aggregate(docs, [{"$lookup": {**spec, "unwind": True}}], {"o": other}).collect()
    assert sorted((r.n, r.m.w if r.m else None) for r in rows) == [(1, 1), (1, 2), (1, 3), (2, 1), (2, 2), (2, 3), (3, None), (4, None), (5, None)]
    lists = aggregate(docs, [{"$lookup": {**spec, "most": 2, "sortBy": {"w": -1}}}], {"o": other}).collect()
    assert {r.n: [x.w for x in r.m] for r in lists} == {1: [3, 2], 2: [3, 2], 3: [], 4: [], 5: []}
    with pytest.raises(ValueError, match="most"):
        aggregate(docs, [{"$lookup": spec}], {"o": other})


def test_buckets_unwinds_unions_and_roots(spark, docs):
    spec = {"groupBy": "$v", "boundaries": [0, 10, 25]}
    got = aggregate(docs, [{"$bucket": {**spec, "default": "other"}}]).collect()
    assert {r._id: r["count"] for r in got} == {"0": 2, "10": 2, "other": 1}
    with pytest.raises(Exception, match="no bucket holds 30"):
        aggregate(docs, [{"$bucket": spec}]).collect()
    with pytest.raises(ValueError, match="ascend"):
        aggregate(docs, [{"$bucket": {**spec, "boundaries": [5, 1]}}])
    one = aggregate(docs, [{"$unwind": {"path": "$tags", "includeArrayIndex": "i"}}]).collect()
    assert sorted((r.n, r.tags, r.i) for r in one) == [(1, "x", 0), (1, "y", 1), (4, "z", 0)]
    kept = aggregate(docs, [{"$unwind": {"path": "$tags", "preserveNullAndEmptyArrays": True}}])
    assert kept.count() == 6 and kept.columns == ["k", "n", "v", "tags"]
    both = aggregate(docs, [{"$project": {"n": 1}}, {"$unionWith": {"coll": "d", "pipeline": [{"$match": {"k": "b"}}, {"$project": {"v": 1}}]}}], {"d": docs})
    assert both.count() == 6 and both.columns == ["n", "v"]
    root = aggregate(docs, [{"$set": {"d": {"$add": ["$n", 1]}}}, {"$unset": ["tags", "v"]}, {"$replaceRoot": {"newRoot": {"x": "$d", "y": "$k"}}}, {"$sort": {"x": 1}}]).first()
    assert (root.x, root.y) == (2, "a")


def test_facets_are_rows_of_documents(spark, docs):
    out = aggregate(docs, [{"$facet": {"n": [{"$count": "c"}], "k": [{"$sortByCount": "$k"}]}}])
    got = sorted((r.facet, r.d) for r in out.select("facet", F.to_json("doc").alias("d")).collect())
    assert got == [("k", '{"_id":"a","count":2}'), ("k", '{"_id":"b","count":1}'), ("k", '{"count":2}'), ("n", '{"c":5}')]


def test_a_page_past_the_end_keeps_the_total(spark):
    df = spark.createDataFrame([(str(i), i) for i in range(7)], "_id string, n long")
    page = lambda p, **kw: [(r._id, r.total_count) for r in find_with_paginate(df, {"n": {"$gte": 2}}, sort=["n"], page_size=3, page_num=p, keep_total=True).collect()]
    assert page(1) == [("2", 5), ("3", 5), ("4", 5)] and page(2) == [("5", 5), ("6", 5)] and page(3) == [(None, 5)]
    assert [(r._id, r.total_count) for r in find_with_paginate(df, {"n": 99}, page_size=3, keep_total=True).collect()] == [(None, 0)]
