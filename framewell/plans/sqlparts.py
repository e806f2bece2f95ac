"""SQL text of the fixture derivations, used by the DuckDB oracles.

Each CTE states the same rule as ``framewell.plans.fixtures``.
"""

FRAMES = """
frames AS (
  SELECT event_id,
         'cam' || CAST(user_id % 8 AS VARCHAR) AS device_id,
         'cam' || CAST(user_id % 8 AS VARCHAR) || '_' || json_extract_string(props, '$.k') || '.jpg' AS name,
         CAST(epoch_us(ts) AS DOUBLE) / CAST(1000000 AS DOUBLE) AS timestamp,
         '640' AS width, '480' AS height,
         to_base64(encode(event_type)) AS img,
         ts
  FROM events)"""

META = FRAMES + """,
meta AS (
  SELECT event_id, device_id, name, timestamp, ts AS event_datetime, width, height,
         device_id || '/' || name AS img_path
  FROM frames)"""

POINTS = """
points AS (
  SELECT event_type AS io_id, value, CAST(epoch_us(ts) AS DOUBLE) / CAST(1000000 AS DOUBLE) AS timestamp,
         ts AS time, event_id
  FROM events)"""

IMAGES = """
images AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS _id,
         'cam' || CAST(o_custkey % 8 AS VARCHAR) AS device_id,
         CAST(o_orderkey AS VARCHAR) || '.jpg' AS name,
         o_orderdate AS event_datetime, '640' AS width, '480' AS height,
         'src/' || CAST(o_orderkey AS VARCHAR) || '.jpg' AS img_path,
         o_orderstatus AS status, o_totalprice AS price
  FROM orders)"""

BLOBS = """
blobs AS (
  SELECT 'src/' || CAST(doc_id AS VARCHAR) || (['.jpg', '.png', '.txt'])[doc_id % 3 + 1] AS path,
         encode(text) AS content, source AS device_id
  FROM documents)"""

CHANGES = """
changes AS (
  SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'other' ELSE 'images' END AS collection,
         CAST(o_orderkey AS VARCHAR) AS doc_id,
         CASE WHEN o_orderkey % 97 = 0 THEN 'drop' WHEN o_orderstatus = 'F' THEN 'delete'
              WHEN o_orderstatus = 'O' THEN 'update' ELSE 'insert' END AS operation_type,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN ''
              ELSE 'src/' || CAST(o_orderkey AS VARCHAR) || '.jpg' END AS path0,
         o_orderdate, o_orderstatus
  FROM orders),
envelope AS (
  SELECT collection, doc_id, operation_type,
         CASE WHEN operation_type IN ('delete', 'update') THEN path0 END AS before_img_path,
         CASE WHEN operation_type IN ('insert', 'update') THEN path0 END AS full_img_path,
         o_orderdate, o_orderstatus
  FROM changes)"""

USERS = """
users AS (
  SELECT c_custkey AS id, c_name AS name,
         CASE WHEN c_acctbal < 0 THEN NULL
              WHEN c_nationkey = 0 THEN 'user' || CAST(CASE WHEN c_custkey % 17 = 0 THEN c_custkey - 1 ELSE c_custkey END AS VARCHAR) || '.example.org'
              ELSE 'user' || CAST(CASE WHEN c_custkey % 17 = 0 THEN c_custkey - 1 ELSE c_custkey END AS VARCHAR) || '@example.org' END AS email,
         CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN false END AS is_active
  FROM customer),
supplier_users AS (
  SELECT s_suppkey AS id, s_name AS name, 'supplier' || CAST(s_suppkey AS VARCHAR) || '@example.org' AS email,
         CAST(NULL AS BOOLEAN) AS is_active
  FROM supplier)"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(p.strip().rstrip(",") for p in parts)
