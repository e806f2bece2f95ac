"""Registered queries: inserts, updates, upserts, deletes and user constraints."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewell.functions.timefmt import as_ntz
from framewell.operators import mutations, parse, validate
from framewell.operators.ordering import keep_last
from framewell.operators.parse import project_model
from framewell.plans import fixtures as fx
from framewell.plans.registry import query
from framewell.plans.sqlparts import IMAGES, META, USERS, with_


@query("insert_many", with_(IMAGES, META) + """
SELECT _id, device_id, name, img_path FROM images
UNION ALL
SELECT 'e' || CAST(event_id AS VARCHAR), device_id, name, img_path FROM meta
WHERE event_id % 50 NOT IN (0, 2, 3)""")
def q_insert_many(spark, d):
    """Validated frame documents appended to the image collection."""
    good, _ = parse.split_rejects(parse.validate_frames(fx.topic(spark, d), keep=["offset"]))
    docs = parse.derive_metadata(good.drop("img"), with_process_time=False).withColumn(
        "_id", F.concat(F.lit("e"), F.col("offset").cast("string")))
    docs = docs.withColumn("event_datetime", as_ntz("event_datetime"))
    out = mutations.insert_many(fx.images(spark, d), docs)
    return out.select("_id", "device_id", "name", "img_path")


IMAGE_RULES = validate.model_from_json("""{
  "_id": {"type": "string", "required": true, "max_length": 24},
  "name": {"type": "string", "required": true, "pattern": "^[0-9]+[.]jpg$"},
  "event_datetime": {"type": "datetime", "required": true},
  "width": {"type": "string", "default": "640"},
  "status": {"type": "string", "choices": ["F", "O", "P"]},
  "price": {"type": "double", "least": 0}
}""")


def _raw_images(spark, d):
    """Image documents as a client sends them, text throughout; rule-made faults by key % 20."""
    k = F.col("o_orderkey")
    m = k % 20
    o = fx.table(spark, d, "orders")
    key = F.when(m == 1, None).when(m == 2, k - 2).otherwise(k).cast("string")
    return o.select(
        k.alias("src"), key.alias("_id"),
        F.when(~m.isin(8, 10), F.concat(F.when(m == 9, F.lit("x ")).otherwise(F.lit("")), k.cast("string"), F.lit(".jpg"))).alias("name"),
        F.when(m == 7, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")).otherwise(F.date_format("o_orderdate", "yyyy/MM/dd")).alias("event_datetime"),
        F.when(m == 6, F.lit("Z")).otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(m.isin(4, 10), F.lit("abc")).when(m == 5, F.lit("-1.5")).otherwise(F.col("o_totalprice").cast("string")).alias("price"))


@query("insert_rejects", """
WITH r AS (SELECT o_orderkey AS src, o_orderkey % 20 AS m, o_totalprice, o_orderstatus, o_orderdate FROM orders)
SELECT src, CASE m WHEN 1 THEN NULL WHEN 2 THEN CAST(src - 2 AS VARCHAR) ELSE CAST(src AS VARCHAR) END AS _id,
       CASE m WHEN 1 THEN '_id: required' WHEN 2 THEN '_id: repeated' WHEN 3 THEN '_id: stored already' WHEN 4 THEN 'price: not double'
              WHEN 5 THEN 'price: less than 0' WHEN 6 THEN 'status: not a choice' WHEN 7 THEN 'event_datetime: not datetime'
              WHEN 8 THEN 'name: required' WHEN 9 THEN 'name: malformed' WHEN 10 THEN 'name: required; price: not double' ELSE '' END AS reasons,
       CASE WHEN m = 0 OR m > 10 THEN o_totalprice END AS price, CASE WHEN m = 0 OR m > 10 THEN o_orderstatus END AS status,
       CASE WHEN m = 0 OR m > 10 THEN o_orderdate END AS event_datetime, CASE WHEN m = 0 OR m > 10 THEN '640' END AS width
FROM r""")
def q_insert_rejects(spark, d):
    """Documents validated on insert: accepted rows as they are stored, refused ones with every reason."""
    target = fx.images(spark, d).where(F.col("_id").cast("long") % 20 == 3)
    got = validate.insert_validated(target, _raw_images(spark, d), IMAGE_RULES, "_id", "src")
    stored = got.table.select("_id", "price", "status", as_ntz("event_datetime").alias("event_datetime"), "width")
    accepted = got.ids.join(stored, "_id").select("src", "_id", F.lit("").alias("reasons"), "price", "status", "event_datetime", "width")
    refused = got.rejects.select("src", "_id", F.array_join("reasons", "; ").alias("reasons"))
    return accepted.unionByName(refused, allowMissingColumns=True)


@query("insert_counts", """
SELECT CAST(count_if(o_orderkey % 20 = 0 OR o_orderkey % 20 > 10) AS BIGINT) AS inserted_count,
       CAST(count_if(o_orderkey % 20 BETWEEN 1 AND 10) AS BIGINT) AS rejected_count FROM orders""")
def q_insert_counts(spark, d):
    """Inserted and refused counts of the same insert."""
    target = fx.images(spark, d).where(F.col("_id").cast("long") % 20 == 3)
    return validate.insert_validated(target, _raw_images(spark, d), IMAGE_RULES, "_id", "src").counts


@query("update_set_unset", with_(IMAGES) + """,
m AS (SELECT *, device_id = 'cam3' AND event_datetime >= TIMESTAMP '1996-01-01' AS hit FROM images)
SELECT _id, CASE WHEN hit THEN '1280' ELSE width END AS width,
       CASE WHEN hit THEN NULL ELSE height END AS height,
       CASE WHEN hit THEN 'X' ELSE status END AS status, hit AS _modified
FROM m""")
def q_update_set_unset(spark, d):
    """$set and $unset under a query with a datetime literal."""
    out = mutations.update(fx.images(spark, d),
                           {"device_id": "cam3", "event_datetime": {"$gte": "1996-01-01"}},
                           set={"width": "1280", "status": "X"}, unset={"height": ""})
    return out.select("_id", "width", "height", "status", "_modified")


@query("update_one", with_(IMAGES) + """
SELECT _id, device_id, 'F' AS status FROM images
WHERE _id = (SELECT min(_id) FROM images WHERE device_id = 'cam5' AND status = 'P')""")
def q_update_one(spark, d):
    """M3: first match only; returns the new document."""
    out = mutations.update(fx.images(spark, d), {"device_id": "cam5", "status": "P"},
                           set={"status": "F"}, one=True)
    return out.filter("_modified").select("_id", "device_id", "status")


_REQUESTS = [
    {"query": {"status": "P"}, "set": {"width": "800"}},
    {"query": {"device_id": "cam1"}, "set": {"width": "1024"}},
    {"query": {"price": {"$lt": 5000}}},
    {"query": {"status": "P", "device_id": "cam1"}, "unset": {"height": ""}},
]


@query("update_many", with_(IMAGES) + """
SELECT _id,
       CASE WHEN device_id = 'cam1' THEN '1024' WHEN status = 'P' THEN '800' ELSE width END AS width,
       CASE WHEN status = 'P' AND device_id = 'cam1' THEN NULL ELSE height END AS height,
       (CASE WHEN status = 'P' THEN 1 ELSE 0 END) + (CASE WHEN device_id = 'cam1' THEN 1 ELSE 0 END)
       + (CASE WHEN status = 'P' AND device_id = 'cam1' THEN 1 ELSE 0 END) AS _modified_count
FROM images""")
def q_update_many(spark, d):
    """Ordered requests; the third has no update and is skipped."""
    out = mutations.update_many(fx.images(spark, d), _REQUESTS)
    return out.select("_id", "width", "height", "_modified_count")


@query("update_by_key", with_(IMAGES) + """,
req AS (SELECT CAST(l_orderkey AS VARCHAR) AS _id, max({'n': l_linenumber, 'f': l_returnflag}).f AS flag
        FROM lineitem GROUP BY l_orderkey)
SELECT i._id, coalesce(r.flag, i.status) AS status,
       coalesce(r.flag IS NOT NULL AND r.flag <> i.status, false) AS _modified
FROM images i LEFT JOIN req r ON i._id = r._id""")
def q_update_by_key(spark, d):
    """M4 keyed form: one $set request per line item; the last line per order
    (line number, then flag) wins."""
    req = fx.table(spark, d, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("_id"), "l_linenumber",
        F.col("l_returnflag").alias("status"))
    out = mutations.update_by_key(fx.images(spark, d), req, "_id", ["l_linenumber", "status"], ["status"])
    return out.select("_id", "status", "_modified")


_DOC_LINES = """
doc_lines AS (SELECT CAST(doc_id AS VARCHAR) AS _id, lang, source, string_split(text, chr(10)) AS lines FROM documents)"""


@query("update_push", with_(_DOC_LINES) + """
SELECT _id, len(lines) + CASE WHEN lang = 'de' THEN 1 ELSE 0 END AS n_lines,
       CASE WHEN lang = 'de' THEN 'EOF' ELSE lines[len(lines)] END AS last_text,
       lang = 'de' AS _modified
FROM doc_lines""")
def q_update_push(spark, d):
    """M7: $push a line onto every German document's line array."""
    out = mutations.update(fx.doc_lines(spark, d), {"lang": "de"},
                           push={"lines": {"no": -1, "text": "EOF", "n_chars": 3, "flag": False}})
    return out.select("_id", F.size("lines").cast("bigint").alias("n_lines"),
                      F.element_at("lines", -1).getField("text").alias("last_text"), "_modified")


@query("update_array_filter", with_(_DOC_LINES) + """,
c AS (SELECT _id, source IN ('src1', 'src2') AS hit,
             len(list_filter(lines, lambda x: length(x) = 0)) AS n_empty FROM doc_lines)
SELECT _id, CASE WHEN hit THEN n_empty ELSE 0 END AS n_flagged, hit AND n_empty > 0 AS _modified FROM c""")
def q_update_array_filter(spark, d):
    """M8: flag the empty lines of two sources' documents (array filter)."""
    out = mutations.update(fx.doc_lines(spark, d), {"source": {"$in": ["src1", "src2"]}},
                           set={"lines.$[l].flag": True}, array_filter={"l.n_chars": 0})
    return out.select("_id", F.size(F.filter("lines", lambda x: x.getField("flag"))).cast("bigint").alias("n_flagged"),
                      "_modified")


@query("upsert_one", with_(IMAGES) + """
SELECT _id, device_id, status FROM images
UNION ALL
SELECT 'new', 'cam9', 'N'""")
def q_upsert_one(spark, d):
    """M9: update with upsert; nothing matches, so the document is inserted."""
    out = mutations.update(fx.images(spark, d), {"_id": "new", "device_id": "cam9"},
                           set={"status": "N"}, upsert=True, one=True)
    return out.select("_id", "device_id", "status")


@query("upsert_by_key", with_(META) + """,
target AS (SELECT * FROM meta WHERE event_datetime < TIMESTAMP '2024-01-20'
           QUALIFY row_number() OVER (PARTITION BY name ORDER BY event_id DESC) = 1),
batch AS (SELECT * FROM meta WHERE event_datetime >= TIMESTAMP '2024-01-10'
          QUALIFY row_number() OVER (PARTITION BY name ORDER BY event_id DESC) = 1)
SELECT coalesce(b.name, t.name) AS name,
       CASE WHEN b.name IS NOT NULL THEN b.device_id ELSE t.device_id END AS device_id,
       CASE WHEN b.name IS NOT NULL THEN b.timestamp ELSE t.timestamp END AS timestamp,
       CASE WHEN b.name IS NOT NULL THEN b.img_path ELSE t.img_path END AS img_path,
       CASE WHEN b.name IS NOT NULL THEN b.event_id ELSE t.event_id END AS event_id,
       CASE WHEN t.name IS NOT NULL THEN 'stored' END AS label
FROM target t FULL OUTER JOIN batch b ON t.name = b.name""")
def q_upsert_by_key(spark, d):
    """Merge a batch of later frames into stored metadata by name;
    the stored-only field ``label`` survives."""
    m = fx.frame_metadata(spark, d).select("name", "device_id", "timestamp", "img_path", "event_id",
                                           "event_datetime")
    stored = m.filter(m.event_datetime < F.lit("2024-01-20").cast("timestamp_ntz"))
    target = keep_last(stored, "name", "event_id").drop("event_datetime").withColumn(
        "label", F.lit("stored"))
    batch = m.filter(m.event_datetime >= F.lit("2024-01-10").cast("timestamp_ntz")).drop("event_datetime")
    return mutations.merge_by_key(target, batch, "name", "event_id").select(
        "name", "device_id", "timestamp", "img_path", "event_id", "label")


@query("delete_many", """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
WHERE NOT coalesce(o_orderstatus = 'F' AND o_totalprice < 50000, false)""")
def q_delete_many(spark, d):
    """Remove all matches; a null predicate keeps the row."""
    out = mutations.delete_many(fx.table(spark, d, "orders"),
                                {"o_orderstatus": "F", "o_totalprice": {"$lt": 50000}})
    return out.select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("delete_one", with_(IMAGES) + """
SELECT _id, device_id, status FROM images
WHERE _id <> (SELECT min(_id) FROM images WHERE device_id = 'cam2' AND status = 'F')""")
def q_delete_one(spark, d):
    """Remove the first match only."""
    out = mutations.delete_one(fx.images(spark, d), {"device_id": "cam2", "status": "F"})
    return out.select("_id", "device_id", "status")


@query("public_users", with_(USERS) + """
SELECT id, email, coalesce(is_active, true) AS is_active FROM users""")
def q_public_users(spark, d):
    """Defaults applied on create; only public columns leave."""
    u = mutations.apply_defaults(fx.users(spark, d), {"is_active": True, "is_superuser": False})
    return project_model(u, "UserRead")


@query("check_constraints", with_(USERS) + """,
allu AS (SELECT id, name, email FROM users UNION ALL SELECT id, name, email FROM supplier_users)
SELECT 'duplicate id' AS constraint, CAST(id AS VARCHAR) AS value, count(*) AS n FROM allu GROUP BY id HAVING count(*) > 1
UNION ALL
SELECT 'duplicate email', email, count(*) FROM allu WHERE email IS NOT NULL GROUP BY email HAVING count(*) > 1
UNION ALL
SELECT 'null email', NULL, count(*) FROM allu WHERE email IS NULL HAVING count(*) > 0
UNION ALL
SELECT 'bad email', email, count(*) FROM allu WHERE email IS NOT NULL AND NOT contains(email, '@') GROUP BY email""")
def q_check_constraints(spark, d):
    """C4: key, unique e-mail, not-null and e-mail format over users plus an insert batch."""
    u = fx.users(spark, d).unionByName(fx.supplier_users(spark, d))
    return mutations.check_constraints(u.withColumn("id", F.col("id")), key="id", unique=["email"],
                                       not_null=["name", "email"], email="email")


@query("deleted_count", """
SELECT count(*) AS deleted_count FROM orders WHERE o_orderstatus = 'F' AND o_totalprice < 50000""")
def q_deleted_count(spark, d):
    """The count a delete_many returns."""
    return mutations.deleted_count(fx.table(spark, d, "orders"),
                                   {"o_orderstatus": "F", "o_totalprice": {"$lt": 50000}})
