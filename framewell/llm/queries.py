"""Registered queries of the operators of this subpackage and their SQL oracles."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewell.llm.archives import pages_through_archives
from framewell.llm.centroids import clustered, clustered_sql
from framewell.llm.common import table
from framewell.llm.decontaminate import decontaminate
from framewell.llm.lang_id import identify
from framewell.llm.licenses import scan, scan_sql
from framewell.llm.line_dedup import dedup_sql, drop_lines
from framewell.llm.mixing import mix
from framewell.llm.near_vectors import near_vectors
from framewell.llm.ngram_join import ngram_classes
from framewell.llm.page_text import extract
from framewell.llm.periodic_runs import find_runs
from framewell.llm.pseudonyms import pseudonymise
from framewell.llm.token_counts import count_tokens

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return wrap


@query("op4_decontaminate")
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), "contaminated")


@query("op8_ngram_join")
def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_classes(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


@query("op2_pseudonyms")
def op2_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(table(spark, sf_dir, "documents"))


@query("op10_mixing")
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_near_vectors")
def op3_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query("op7_archives", """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN first END AS refers_to, TRUE AS intact
FROM m""")
def op7_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages_through_archives(table(spark, sf_dir, "pages"))


@query("op9_page_text")
def op9_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


@query("op5_licenses", scan_sql())
def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


@query("op6_token_counts")
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))


def repeated_tail(doc_id, n: int) -> np.ndarray | None:
    """Word numbers of the text of one document in ten whose tail is made periodic, by its id."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or n == 0:
        return None
    g = h // 10
    a = g % n
    places = np.arange(n)
    return np.where(places < a, places, a + (places - a) % (1 + (n - a) // (3 + g % 8)))


@query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(table(spark, sf_dir, "documents"), rewrite=repeated_tail)
    listed = F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query("op12_centroids", clustered_sql())
def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(table(spark, sf_dir, "embeddings"))


@query("op13_line_dedup", dedup_sql())
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
