"""Model scoring over Arrow batches.

A model is stored data: weights, bias and a version, written by ``save_model`` and read back by
``load_model``. It reaches the workers as a broadcast, loaded once per process and version, and is
applied to whole Arrow batches; nothing is scored row by row in Python.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framewell.sinks.fs import numbered_folders


@dataclass(frozen=True)
class LinearModel:
    """Logistic score of a vector."""

    weights: tuple[float, ...]
    bias: float = 0.0
    version: int = 0

    def __call__(self, vectors: pd.Series) -> np.ndarray:
        """Scores; NaN for a null vector or one of another length."""
        out = np.full(len(vectors), np.nan)
        w = np.asarray(self.weights)
        fits = [i for i, v in enumerate(vectors) if v is not None and len(v) == len(w)]
        if fits:
            z = np.vstack([np.asarray(vectors.iloc[i], dtype=np.float64) for i in fits]) @ w + self.bias
            out[fits] = 1.0 / (1.0 + np.exp(-z))
        return out


def fit_mean_difference(df: DataFrame, vector_col: str, positive: Column) -> LinearModel:
    """A linear model between the means of positive and other vectors (rows where ``positive`` is null don't
    count). Component means are partial aggregates; one row per component comes back."""
    parts = df.select(positive.alias("p"), F.posexplode(vector_col).alias("i", "x")).where("p is not null")
    x = F.col("x").cast("double")
    rows = parts.groupBy("i").agg(F.avg(F.when(F.col("p"), x)).alias("a"), F.avg(F.when(~F.col("p"), x)).alias("b")).orderBy("i").collect()
    a, b = (np.array([r[c] if r[c] is not None else 0.0 for r in rows]) for c in ("a", "b"))
    return LinearModel(tuple((a - b).tolist()), float((b @ b - a @ a) / 2))


def save_model(spark: SparkSession, root: str, model: LinearModel) -> int:
    """Store a model as the next version under ``root``; that version. Stored versions are never rewritten."""
    version = max(numbered_folders(spark, root, "v"), default=0) + 1
    row = [(list(map(float, model.weights)), float(model.bias))]
    spark.createDataFrame(row, "weights array<double>, bias double").coalesce(1).write.mode("error").parquet(f"{root.rstrip('/')}/v={version}")
    return version


def load_model(spark: SparkSession, root: str, version: int | None = None) -> LinearModel:
    """A stored version, the newest by default; ValueError if there is none."""
    stored = numbered_folders(spark, root, "v")
    if not stored or (version is not None and version not in stored):
        raise ValueError(f"no model version {version if version is not None else ''} under {root}")
    version = stored[-1] if version is None else version
    row = spark.read.parquet(f"{root.rstrip('/')}/v={version}").first()
    return LinearModel(tuple(row.weights), row.bias, version)


def infer(df: DataFrame, vector_col: str, keep: list[str], model: LinearModel | Callable[[pd.Series], np.ndarray],
          threshold: float = 0.5) -> DataFrame:
    """Score each row: the kept columns, score (null where the model has none) and predicted."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema.fields)
    schema += ", score double, predicted boolean"
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            s = shared.value(pdf[vector_col])
            out = pdf[keep].copy()
            out["score"] = s
            out["predicted"] = s > threshold
            yield out
    scored = df.select(*dict.fromkeys([*keep, vector_col])).mapInPandas(run, schema)
    known = F.col("score").isNotNull() & ~F.isnan("score")
    return scored.withColumn("predicted", F.when(known, F.col("predicted"))).withColumn("score", F.when(known, F.col("score")))


def map_records(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """An arbitrary pandas function per Arrow batch."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield fn(pdf)
    return df.mapInPandas(run, schema)


def score_linear(vector: Column | str, weights: list[float], bias: float = 0.0) -> Column:
    """U1 without Python: dot product and logistic in JVM expressions."""
    v = F.col(vector) if isinstance(vector, str) else vector
    w = F.array(*[F.lit(float(x)) for x in weights])
    dot = F.aggregate(F.zip_with(v, w, lambda a, b: a.cast("double") * b), F.lit(0.0), lambda acc, x: acc + x)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(dot + F.lit(bias))))


def infer_to_table(df: DataFrame, vector_col: str, keep: list[str], key: str, table_path: str, order: str,
                   model: LinearModel, batch_id: int | None = None) -> None:
    """K9: scores and the model's version written to a keyed results table (K1), one row per key. ``order`` decides
    between results of one key: a column of ``df`` or ``model_version``."""
    from framewell.sinks.tables import upsert_table
    columns = [c for c in dict.fromkeys([*keep, key, order]) if c != "model_version"]
    scored = infer(df, vector_col, columns, model).withColumn("model_version", F.lit(model.version))
    upsert_table(df.sparkSession, scored, table_path, key, order, batch_id=batch_id)
