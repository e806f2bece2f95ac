"""Registered queries over stored objects and stored models."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewell.operators import infer
from framewell.plans import fixtures as fx
from framewell.plans.registry import query
from framewell.session import scratch_path
from framewell.sinks.objects import get_files, list_objects, put_files, put_rows, verify_objects
from framewell.sinks.tables import read_keyed_table


@query("chunked_objects", """
SELECT 'doc' || CAST(doc_id AS VARCHAR) AS filename, lang, octet_length(encode(text)) AS length,
       CAST(greatest(1, ceil(octet_length(encode(text)) / 1000.0)) AS INTEGER) AS n_chunks, sha256(text) AS sha256, TRUE AS intact
FROM documents WHERE text IS NOT NULL""")
def q_chunked_objects(spark, d):
    """Every document stored as chunks of 1,000 bytes, listed, fetched as files and compared by digest."""
    base = scratch_path(spark, "chunked_objects")
    docs = fx.table(spark, d, "documents").select(F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("name"), "lang", F.col("text").cast("binary").alias("content"))
    put_rows(docs, f"{base}/store", metadata_cols=["lang"], chunk_bytes=1000)
    get_files(spark, f"{base}/store", f"{base}/files").write.parquet(f"{base}/fetched")
    fetched = spark.read.parquet(f"{base}/fetched").select("object_id", "sha256", F.col("length").alias("_length"))
    intact = verify_objects(spark, f"{base}/store").select("object_id", (F.size("reasons") == 0).alias("intact"))
    out = list_objects(spark, f"{base}/store").join(fetched, "object_id").join(intact, "object_id")
    return out.select("filename", F.col("metadata")["lang"].alias("lang"), F.col("_length").alias("length"), "n_chunks", "sha256", "intact")


@query("stored_files", """
SELECT CAST(count(*) AS BIGINT) AS n_files, CAST(sum(octet_length(encode(text))) AS BIGINT) AS length, TRUE AS same FROM documents WHERE text IS NOT NULL""")
def q_stored_files(spark, d):
    """Files fetched from one store are put into another by ranges; the same objects result."""
    base = scratch_path(spark, "stored_files")
    docs = fx.table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("name"), F.col("text").cast("binary").alias("content"))
    put_rows(docs, f"{base}/a", chunk_bytes=4000)
    get_files(spark, f"{base}/a", f"{base}/files").write.parquet(f"{base}/fetched")
    put_files(spark, f"{base}/files", f"{base}/b", chunk_bytes=4000)
    a = list_objects(spark, f"{base}/a").select("object_id", F.struct("length", "n_chunks", "digest").alias("a"))
    b = list_objects(spark, f"{base}/b").select(F.col("filename").alias("object_id"), F.struct("length", "n_chunks", "digest").alias("b"))
    return a.join(b, "object_id", "full_outer").agg(F.count("b").alias("n_files"), F.sum("b.length").alias("length"), F.min(F.col("a").eqNullSafe(F.col("b"))).alias("same"))


@query("infer_scores", """
WITH t(version, m) AS (VALUES (1, 2), (2, 3)),
u AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
w AS (SELECT version, i, avg(x) FILTER (WHERE label % m = 0) AS a, avg(x) FILTER (WHERE label % m <> 0) AS b FROM u, t GROUP BY version, i),
bias AS (SELECT version, sum(b * b - a * a) / 2 AS c FROM w GROUP BY version)
SELECT vec_id, label, version, round(1.0 / (1.0 + exp(-(sum(x * (a - b)) + any_value(c)))), 6) AS score
FROM u JOIN w USING (i) JOIN bias USING (version) GROUP BY vec_id, label, version""")
def q_infer_scores(spark, d):
    """Two models are fitted and stored as versions; each scores all vectors into a keyed table."""
    base = scratch_path(spark, "infer_scores")
    e = fx.table(spark, d, "embeddings")
    out = None
    for version, m in ((1, 2), (2, 3)):
        fitted = infer.fit_mean_difference(e, "embedding", F.col("label") % m == 0)
        assert infer.save_model(spark, f"{base}/models", fitted) == version
        infer.infer_to_table(e, "embedding", ["label"], "vec_id", f"{base}/scores{version}", "model_version", infer.load_model(spark, f"{base}/models"))
        t = read_keyed_table(spark, f"{base}/scores{version}").select("vec_id", "label", F.col("model_version").alias("version"), F.round("score", 6).alias("score"))
        out = t if out is None else out.unionAll(t)
    return out
