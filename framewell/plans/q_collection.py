"""Registered queries: find, paginate, distinct and aggregate over collections."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewell.operators import collection, ordering
from framewell.plans import fixtures as fx
from framewell.plans.registry import query
from framewell.plans.sqlparts import IMAGES, with_


def _customers(spark, d):
    return fx.table(spark, d, "customer").withColumn("_id", F.col("c_custkey").cast("string"))


@query("find_range", with_(IMAGES) + """
SELECT _id, device_id, event_datetime, status FROM images
WHERE event_datetime >= TIMESTAMP '1996-01-01 00:00:00' AND event_datetime <= TIMESTAMP '1996-12-31 23:59:59'
  AND status IN ('F', 'O')""")
def q_find_range(spark, d):
    """Time range given as request text, plus $in."""
    q = {"event_datetime": {"$gte": "1996-01-01", "$lte": "1996-12-31 23:59:59"},
         "status": {"$in": ["F", "O"]}}
    return collection.find(fx.images(spark, d), q).select("_id", "device_id", "event_datetime", "status")


@query("find_in", """
SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer
WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_acctbal > 0
  AND (c_nationkey IS NULL OR c_nationkey <> 3)""")
def q_find_in(spark, d):
    """$in, $gt and $ne (a null field matches $ne)."""
    q = {"c_mktsegment": {"$in": ["BUILDING", "MACHINERY"]}, "c_acctbal": {"$gt": 0},
         "c_nationkey": {"$ne": 3}}
    return collection.find(fx.table(spark, d, "customer"), q).select(
        "c_custkey", "c_name", "c_mktsegment", "c_acctbal")


@query("find_expr", with_(IMAGES) + """
SELECT _id, device_id, event_datetime FROM images
WHERE event_datetime >= TIMESTAMP '1997-01-01' AND event_datetime <= TIMESTAMP '1997-06-30 23:59:59'
  AND device_id = 'cam3'""")
def q_find_expr(spark, d):
    """condition texts as the list page sends them."""
    conds = ["event_datetime>=1997-01-01", "event_datetime<=1997-06-30 23:59:59", "device_id=cam3"]
    return collection.find_expr(fx.images(spark, d), conds).select("_id", "device_id", "event_datetime")


@query("find_by_id", """
SELECT r.requested_id, c.c_name, CASE WHEN c.c_custkey IS NULL THEN 400 ELSE 200 END AS code,
       CASE WHEN c.c_custkey IS NULL THEN 'doc is not found, doc_id : ' || r.requested_id END AS message
FROM (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS requested_id FROM orders) r
LEFT JOIN customer c ON CAST(c.c_custkey AS VARCHAR) = r.requested_id""")
def q_find_by_id(spark, d):
    """every customer id referenced by an order, looked up by key."""
    ids = fx.table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("requested_id"))
    out = collection.find_by_id(_customers(spark, d), ids, key="_id")
    return out.select("requested_id", "c_name", "code", "message")


@query("paginate", with_(IMAGES) + """,
m AS (SELECT * FROM images WHERE status = 'O')
SELECT _id, device_id, name, event_datetime, img_path, (SELECT count(*) FROM m) AS total_count
FROM m ORDER BY event_datetime DESC, _id ASC LIMIT 10 OFFSET 20""")
def q_paginate(spark, d):
    """Page 3 of 10, newest first, with the total count."""
    return collection.find_with_paginate(fx.images(spark, d), {"status": "O"}, project="ProjectImage",
                                         sort=["-event_datetime"], page_size=10, page_num=3)


@query("newest_image", with_(IMAGES) + """
SELECT _id, device_id, name, event_datetime, img_path, (SELECT count(*) FROM images WHERE device_id = 'cam3') AS total_count
FROM images WHERE device_id = 'cam3' ORDER BY event_datetime DESC, _id ASC LIMIT 1""")
def q_newest_image(spark, d):
    """Newest document of one device (page_size=1)."""
    return collection.find_with_paginate(fx.images(spark, d), {"device_id": "cam3"}, project="ProjectImage",
                                         sort=["-event_datetime"], page_size=1, page_num=1)


@query("page_totals", with_(IMAGES) + """
SELECT device_id, count(*) AS total_count, greatest(1, CAST(ceil(count(*) / 10.0) AS BIGINT)) AS page_count
FROM images GROUP BY device_id""")
def q_page_totals(spark, d):
    """Matches and page count per device for the list view."""
    g = fx.images(spark, d).groupBy("device_id").agg(F.count(F.lit(1)).alias("total_count"))
    return g.withColumn("page_count", ordering.page_count(F.col("total_count"), 10).cast("bigint"))


@query("distinct_values", """
SELECT DISTINCT field, value, type FROM (
  SELECT 'o_orderstatus' AS field, o_orderstatus AS value, 'str' AS type FROM orders WHERE o_totalprice > 100000
  UNION ALL
  SELECT 'o_orderpriority', o_orderpriority, 'str' FROM orders WHERE o_totalprice > 100000
  UNION ALL
  SELECT 'o_custkey_mod', CAST(o_custkey % 8 AS VARCHAR), 'int' FROM orders WHERE o_totalprice > 100000)
WHERE value IS NOT NULL""")
def q_distinct_values(spark, d):
    """Tag values per field under a filter."""
    o = fx.table(spark, d, "orders").withColumn("o_custkey_mod", F.col("o_custkey") % 8)
    return collection.distinct_values(o, ["o_orderstatus", "o_orderpriority", "o_custkey_mod"],
                                      {"o_totalprice": {"$gt": 100000}})


STAGES = [
    {"$match": {"l_shipdate": {"$lte": "1998-09-02"}}},
    {"$addFields": {"price": {"$toDecimal": "$l_extendedprice"}, "disc": {"$toDecimal": "$l_discount"}}},
    {"$group": {"_id": {"l_returnflag": "$l_returnflag", "l_linestatus": "$l_linestatus"},
                "sum_qty": {"$sum": "$l_quantity"},
                "sum_base_price": {"$sum": "$price"},
                "sum_disc_price": {"$sum": {"$multiply": ["$price", {"$subtract": [1, "$disc"]}]}},
                "avg_disc": {"$avg": "$l_discount"},
                "count_order": {"$sum": 1}}},
    {"$project": {"l_returnflag": 1, "l_linestatus": 1, "count_order": 1,
                  "sum_qty": {"$round": ["$sum_qty", 2]},
                  "sum_base_price": {"$toDouble": {"$round": ["$sum_base_price", 2]}},
                  "sum_disc_price": {"$toDouble": {"$round": ["$sum_disc_price", 2]}},
                  "avg_disc": {"$round": ["$avg_disc", 6]}}},
    {"$sort": {"l_returnflag": 1, "l_linestatus": 1}},
]


@query("aggregate_stages", """
SELECT l_returnflag, l_linestatus, count(*) AS count_order,
       round(sum(l_quantity), 2) AS sum_qty,
       CAST(round(sum(CAST(l_extendedprice AS DECIMAL(18,2))), 2) AS DOUBLE) AS sum_base_price,
       CAST(round(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))), 2) AS DOUBLE) AS sum_disc_price,
       round(avg(l_discount), 6) AS avg_disc
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02'
GROUP BY l_returnflag, l_linestatus ORDER BY l_returnflag, l_linestatus""")
def q_aggregate_stages(spark, d):
    """A5: $match -> $addFields -> $group -> $project -> $sort over lineitem
    (money summed as exact decimals, so the result does not depend on the
    summation order)."""
    out = collection.aggregate(fx.table(spark, d, "lineitem"), STAGES)
    return out.withColumn("count_order", F.col("count_order").cast("bigint"))


@query("paginate_keyset", with_(IMAGES) + """
SELECT _id, device_id, event_datetime FROM images
WHERE status = 'O' AND (event_datetime < TIMESTAMP '1996-06-30 00:00:00'
      OR (event_datetime = TIMESTAMP '1996-06-30 00:00:00' AND _id > '5000'))
ORDER BY event_datetime DESC, _id ASC LIMIT 10""")
def q_paginate_keyset(spark, d):
    """O2 deep-page form: the page after a seen sort key (no offset scan)."""
    m = collection.find(fx.images(spark, d), {"status": "O"})
    after = (F.lit("1996-06-30 00:00:00").cast("timestamp"), "5000")
    page = ordering.keyset_page(m, ["-event_datetime", "_id"], after, 10)
    return page.select("_id", "device_id", "event_datetime")


@query("aggregate_lookup", """
WITH j AS (SELECT c_mktsegment AS _id, o_orderkey, o_totalprice,
                  row_number() OVER (PARTITION BY c_mktsegment ORDER BY o_totalprice DESC, o_orderkey) AS r
           FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'O')
SELECT _id, count(*) AS n, max(o_totalprice) AS most, array_to_string(list(CAST(o_orderkey AS VARCHAR) ORDER BY r) FILTER (WHERE r <= 3), ',') AS top
FROM j GROUP BY _id""")
def q_aggregate_lookup(spark, d):
    """A5: $match -> $lookup -> $group with a bounded $topN."""
    out = collection.aggregate(fx.table(spark, d, "orders"), [
        {"$match": {"o_orderstatus": "O"}},
        {"$lookup": {"from": "customer", "localField": "o_custkey", "foreignField": "c_custkey", "as": "c", "unwind": True}},
        {"$group": {"_id": "$c.c_mktsegment", "n": {"$count": {}}, "most": {"$max": "$o_totalprice"},
                    "top": {"$topN": {"n": 3, "sortBy": {"o_totalprice": -1, "o_orderkey": 1}, "output": {"$toString": "$o_orderkey"}}}}},
    ], {"customer": fx.table(spark, d, "customer")})
    return out.withColumn("top", F.array_join("top", ","))


@query("aggregate_lookup_list", """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS r FROM orders),
l AS (SELECT o_custkey, list(CAST(o_orderkey AS VARCHAR) ORDER BY r) AS keys FROM r WHERE r <= 2 GROUP BY o_custkey)
SELECT c_custkey, coalesce(array_to_string(keys, ','), '') AS newest, CAST(coalesce(len(keys), 0) AS INTEGER) AS n FROM customer LEFT JOIN l ON o_custkey = c_custkey""")
def q_aggregate_lookup_list(spark, d):
    """A5: $lookup of each customer's two newest orders as an array."""
    out = collection.aggregate(fx.table(spark, d, "customer"), [
        {"$lookup": {"from": "orders", "localField": "c_custkey", "foreignField": "o_custkey", "as": "o", "most": 2, "sortBy": {"o_orderdate": -1, "o_orderkey": 1}}},
    ], {"orders": fx.table(spark, d, "orders")})
    return out.select("c_custkey", F.array_join(F.transform("o", lambda x: x["o_orderkey"].cast("string")), ",").alias("newest"), F.size("o").alias("n"))


@query("aggregate_facets", """
WITH b AS (SELECT CASE WHEN o_totalprice >= 0 AND o_totalprice < 50000 THEN '0' WHEN o_totalprice >= 50000 AND o_totalprice < 200000 THEN '50000' ELSE 'more' END AS _id FROM orders)
SELECT 'prices' AS facet, _id, count(*) AS n FROM b GROUP BY _id
UNION ALL SELECT 'statuses', o_orderstatus, count(*) FROM orders GROUP BY o_orderstatus
UNION ALL SELECT 'total', NULL, count(*) FROM orders""")
def q_aggregate_facets(spark, d):
    """A5: $facet over $bucket, $sortByCount and $count."""
    out = collection.aggregate(fx.table(spark, d, "orders"), [{"$facet": {
        "prices": [{"$bucket": {"groupBy": "$o_totalprice", "boundaries": [0, 50000, 200000], "default": "more", "output": {"n": {"$count": {}}}}}],
        "statuses": [{"$sortByCount": "$o_orderstatus"}, {"$project": {"_id": 1, "n": "$count"}}],
        "total": [{"$count": "n"}]}}])
    return out.select("facet", F.try_variant_get("doc", "$._id", "string").alias("_id"), F.try_variant_get("doc", "$.n", "bigint").alias("n"))


@query("paginate_past_end", with_(IMAGES) + """
SELECT CAST(NULL AS VARCHAR) AS _id, count(*) AS total_count FROM images WHERE status = 'O'""")
def q_paginate_past_end(spark, d):
    """A2/O2: a page past the end still tells the total."""
    out = collection.find_with_paginate(fx.images(spark, d), {"status": "O"}, sort=["-event_datetime"], page_size=10, page_num=1_000_000, keep_total=True)
    return out.select("_id", "total_count")


@query("distinct_floats", """
SELECT DISTINCT 'value' AS field, CASE WHEN value = trunc(value) THEN CAST(CAST(value AS BIGINT) AS VARCHAR) || '.0' ELSE CAST(value AS VARCHAR) END AS value, 'float' AS type FROM events
UNION SELECT 'large', CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) || '000000.0', 'float' FROM events""")
def q_distinct_floats(spark, d):
    """Distinct values of doubles, small and large, in the text that the store's client shows."""
    ev = fx.table(spark, d, "events").select("value", (F.round(F.col("value") * 100) * 1e6).alias("large"))
    return collection.distinct_values(ev, ["value", "large"])
