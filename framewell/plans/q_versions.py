"""Registered queries over change records that are derived from two versions of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewell.operators.changes import change_envelope
from framewell.operators.versions import apply_changes, diff_versions
from framewell.plans import fixtures as fx
from framewell.plans.registry import query
from framewell.session import scratch_path
from framewell.sources.tables import read_changes

_FIELDS = {"o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double", "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"}

VERSIONS = """
k AS (SELECT *, o_orderkey % 10 AS m FROM orders),
v1 AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM k WHERE m <> 4),
v2 AS (SELECT o_orderkey, CASE WHEN m = 3 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey,
              CASE WHEN m IN (1, 3) THEN 'X' || o_orderstatus ELSE o_orderstatus END AS o_orderstatus,
              CASE WHEN m = 3 THEN o_totalprice + 0.5 ELSE o_totalprice END AS o_totalprice,
              CASE WHEN m = 3 THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS o_orderdate,
              CASE WHEN m IN (2, 3) THEN NULL ELSE o_orderpriority END AS o_orderpriority
       FROM k WHERE m <> 0)"""


def versions(spark, d) -> tuple[DataFrame, DataFrame]:
    """Two versions of ``orders`` by key % 10: 0 deleted, 1 status changed, 2 priority gone, 3 all fields
    changed, 4 inserted, the others equal."""
    o = fx.table(spark, d, "orders")
    m = F.col("o_orderkey") % 10
    all_ = m == 3
    new = o.where(m != 0).select(
        "o_orderkey", F.when(all_, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")).alias("o_custkey"),
        F.when(m.isin(1, 3), F.concat(F.lit("X"), F.col("o_orderstatus"))).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(all_, F.col("o_totalprice") + 0.5).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        F.when(all_, F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("o_orderdate")).alias("o_orderdate"),
        F.when(~m.isin(2, 3), F.col("o_orderpriority")).alias("o_orderpriority"))
    return o.where(m != 4).select("o_orderkey", *_FIELDS), new


@query("change_documents", "WITH " + VERSIONS.strip() + """,
j AS (SELECT v1.o_orderkey AS k1, v2.o_orderkey AS k2, coalesce(v1.o_orderkey, v2.o_orderkey) % 10 AS m,
             v1.o_custkey AS b1, v1.o_orderstatus AS b2, v1.o_totalprice AS b3, v1.o_orderdate AS b4, v1.o_orderpriority AS b5,
             v2.o_custkey AS f1, v2.o_orderstatus AS f2, v2.o_totalprice AS f3, v2.o_orderdate AS f4, v2.o_orderpriority AS f5
      FROM v1 FULL OUTER JOIN v2 ON v1.o_orderkey = v2.o_orderkey)
SELECT CAST(coalesce(k1, k2) AS VARCHAR) AS doc_id,
       CASE m WHEN 0 THEN 'delete' WHEN 3 THEN 'replace' WHEN 4 THEN 'insert' ELSE 'update' END AS operation_type,
       CASE m WHEN 1 THEN 'o_orderstatus=' || f2 WHEN 2 THEN '' END AS updated,
       CASE m WHEN 1 THEN '' WHEN 2 THEN 'o_orderpriority' END AS removed,
       b1 AS before_o_custkey, b2 AS before_o_orderstatus, b3 AS before_o_totalprice, b4 AS before_o_orderdate, b5 AS before_o_orderpriority,
       f1 AS full_o_custkey, f2 AS full_o_orderstatus, f3 AS full_o_totalprice, f4 AS full_o_orderdate, f5 AS full_o_orderpriority
FROM j WHERE k1 IS NULL OR k2 IS NULL OR m IN (1, 2, 3)""")
def q_change_documents(spark, d):
    """Insert, update, replace and delete records with whole documents and before-images, as JSON
    on the topic and read back field by field."""
    path = scratch_path(spark, "change_documents")
    diff_versions(*versions(spark, d), key="o_orderkey", collection="orders").write.json(path)
    env = change_envelope(read_changes(spark, path, ["orders"], stream=False), as_json=True)

    def field(doc, name, kind):
        return F.try_variant_get(F.parse_json(doc), f"$.{name}", kind).cast(kind)

    updates = F.array_sort(F.map_entries(F.from_json("update_content", "map<string,string>")))
    return env.select(
        "doc_id", "operation_type",
        F.when(F.col("operation_type") == "update", F.array_join(F.transform(updates, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")).alias("updated"),
        F.array_join(F.array_sort("removed_fields"), ",").alias("removed"),
        *[field("before_doc", c, t).alias(f"before_{c}") for c, t in _FIELDS.items()],
        *[field("full_doc", c, t).alias(f"full_{c}") for c, t in _FIELDS.items()])


@query("change_replay", "WITH " + VERSIONS.strip() + " SELECT * FROM v2")
def q_change_replay(spark, d):
    """The old version with the change records applied is the new version."""
    old, new = versions(spark, d)
    path = scratch_path(spark, "change_replay")
    diff_versions(old, new, key="o_orderkey", collection="orders").write.json(path)
    return apply_changes(old, read_changes(spark, path, ["orders"], stream=False), "o_orderkey")
