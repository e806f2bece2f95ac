"""Table sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewell import schemas
from framewell.operators.changes import filter_changes


def read_collection(spark: SparkSession, source: str, columns: Sequence[str] | None = None,
                    fmt: str = "parquet") -> DataFrame:
    """A collection by path or catalog name; only ``columns`` are read."""
    df = spark.table(source) if fmt == "table" else spark.read.format(fmt).load(source)
    return df.select(*columns) if columns else df


def read_users(spark: SparkSession, source: str, ids: Sequence[int] | None = None,
               fmt: str = "parquet", options: dict | None = None) -> DataFrame:
    """User rows (parquet here, JDBC in deployment via ``fmt='jdbc'``)."""
    r = spark.read.format(fmt).options(**(options or {}))
    df = r.load() if fmt == "jdbc" else r.load(source)
    return df.filter(F.col("id").isin(list(ids))) if ids is not None else df


def read_changes(spark: SparkSession, path: str, watch: Sequence[str], stream: bool = True) -> DataFrame:
    """Change records (JSON lines) with the fixed nested schema; the
    collection / operation filter (F3) is applied at the source."""
    r = spark.readStream if stream else spark.read
    return filter_changes(r.schema(schemas.CHANGE_RECORD).json(path), watch)
