"""Centroid clustering of integer vectors with an incremental distance matrix.

A vector of exactly ``size`` components, none null or non-finite, is kept with each component
x as the integer floor(scale * x). Every kept vector stores its exact integer dot product
with every centroid. After a round each centroid is replaced by the componentwise floor of
its members' mean; the stored products are then updated by the centroid's nonzero component
changes alone, and the nearest centroid is the argmin of |c|^2 - 2 v.c. Each state is a
written table, so a lost executor repeats one round at most; what reaches the driver is the
centroids (``k`` rows) and their members' sums.

Defined cases: vectors with a scaled component of 2^27 or more in size are left out, as their distances don't fit
into a long. Fewer kept vectors than ``k`` give that many centroids; none give no rows. Ties
of distance go to the smaller centroid, ties of the starting order (equal ids) to the smaller
vector; a null id comes last in that order. Repeated rows count each. Only the two named
columns are read, so other columns can't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewell.llm.common import map_batches, materialise

SIZE, SCALE, CENTROIDS, ROUNDS, SALT = 64, 64, 16, 3, "1:"
LIMIT = 1 << 27  # of a component: a distance of 64 components stays below 2^62


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """The rows of a list column of equal lengths."""
    offsets = column.offsets
    flat = column.values.slice(offsets[0].as_py(), offsets[-1].as_py() - offsets[0].as_py())
    return flat.to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32()), pa.array(values.ravel(), kind))


def kept_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """(vec_id, q): the scaled integer vectors."""
    x = F.col(embedding)
    whole = vectors.select(F.col(vec_id).alias("vec_id"), x.alias("x")).where(
        F.col("x").isNotNull() & (F.size("x") == size)
        & F.forall("x", lambda e: F.coalesce(F.abs(e.cast("double")) * scale < LIMIT, F.lit(False))))
    return whole.select("vec_id", F.transform("x", lambda e: F.floor(e.cast("double") * scale).cast("int")).alias("q"))


def starting_centroids(kept: DataFrame, k: int = CENTROIDS, salt: str = SALT) -> np.ndarray:
    """The ``k`` vectors with the smallest sha256 of the salted id, in that order."""
    digest = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    first = kept.select(digest.alias("h"), "q").orderBy(F.asc_nulls_last("h"), "q").limit(k).collect()
    return np.array([r.q for r in first], np.int64)


def _nearest(dots: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.argmin((centroids * centroids).sum(1) - 2 * dots, axis=1)


def _state_type(kept: DataFrame) -> T.StructType:
    return T.StructType([kept.schema["vec_id"], T.StructField("q", T.ArrayType(T.IntegerType())), T.StructField("norm", T.LongType()),
                         T.StructField("dots", T.ArrayType(T.LongType())), T.StructField("cluster", T.IntegerType())])


def first_state(kept: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Every vector with its norm, all dot products and its nearest centroid."""
    width = centroids.shape[1]

    def make():
        def fn(batch):
            q = _matrix(batch.column(1), width)
            dots = q @ centroids.T
            yield {"vec_id": batch.column(0), "q": batch.column(1), "norm": pa.array((q * q).sum(1)),
                   "dots": _lists(dots, pa.int64()), "cluster": pa.array(_nearest(dots, centroids).astype(np.int32))}
        return fn

    return materialise(map_batches(kept, _state_type(kept), make), "centroids")


def next_state(state: DataFrame, before: np.ndarray, centroids: np.ndarray) -> DataFrame:
    """The state under changed centroids: products move by nonzero component changes only."""
    k, width = centroids.shape
    change = centroids - before
    moves = [(c, np.flatnonzero(change[c])) for c in range(k) if change[c].any()]

    def make():
        def fn(batch):
            q, dots = _matrix(batch.column("q"), width), _matrix(batch.column("dots"), k)
            for c, parts in moves:
                dots[:, c] += q[:, parts] @ change[c, parts]
            yield {"vec_id": batch.column("vec_id"), "q": batch.column("q"), "norm": batch.column("norm"),
                   "dots": _lists(dots, pa.int64()), "cluster": pa.array(_nearest(dots, centroids).astype(np.int32))}
        return fn

    return materialise(map_batches(state, state.schema, make), "centroids")


def moved_centroids(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids replaced by the exact floor of their members' mean; empty ones stay. Members are
    summed within each task, the tasks' sums by Spark: ``k`` rows come back."""
    k, width = centroids.shape

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        for batch in batches:
            cluster = batch.column(0).to_numpy()
            np.add.at(total, cluster, _matrix(batch.column(1), width))
            count += np.bincount(cluster, minlength=k)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(count[some]), _lists(total[some], pa.int64())],
                                         names=["cluster", "n", "total"])

    parts = state.select("cluster", "q").mapInArrow(partial, "cluster int, n long, total array<long>")
    sums = [F.sum(F.col("total")[i].cast("decimal(38,0)")) for i in range(width)]
    out = centroids.copy()
    for row in parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*sums).alias("total")).collect():
        out[row.cluster] = [int(t) // row.n for t in row.total]
    return out


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE,
            salt: str = SALT) -> tuple[DataFrame, np.ndarray]:
    """(state, centroids): after ``rounds`` rounds and a last assignment, one row per kept vector
    (vec_id, q, norm, dots, cluster), and the ``k`` centroids it was assigned to."""
    kept = kept_vectors(vectors, size=size, scale=scale)
    centroids = starting_centroids(kept, k, salt)
    if len(centroids) == 0:
        return kept.sparkSession.createDataFrame([], _state_type(kept)), centroids
    state = first_state(kept, centroids)
    for _ in range(rounds):
        before, centroids = centroids, moved_centroids(state, centroids)
        state = next_state(state, before, centroids)
    return state, centroids


def clustered(vectors: DataFrame, **options) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance (squared), cluster_inertia, inertia and
    centroid_sha256 (of the centroid's components joined by commas)."""
    state, centroids = cluster(vectors, **options)
    norms = [int(c @ c) for c in centroids]
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    mine = F.col("cluster") + 1
    if not norms:
        nothing = F.lit(None)
        return state.select("vec_id", "cluster", *(nothing.cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")),
                            nothing.cast("string").alias("centroid_sha256"))
    near = state.select("vec_id", "cluster", (
        F.col("norm") - 2 * F.element_at("dots", mine) + F.element_at(F.array(*map(F.lit, norms)).cast("array<long>"), mine)).alias("distance"))
    sums = {r.cluster: int(r.s) for r in near.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    each = F.array(*(F.lit(sums.get(c, 0)).cast("long") for c in range(len(norms))))
    return near.select("vec_id", "cluster", "distance", F.element_at(each, mine).alias("cluster_inertia"),
                       F.lit(sum(sums.values())).cast("long").alias("inertia"),
                       F.element_at(F.array(*map(F.lit, digests)), mine).alias("centroid_sha256"))


def clustered_sql(size: int = SIZE, scale: int = SCALE, k: int = CENTROIDS, rounds: int = ROUNDS, salt: str = SALT) -> str:
    """The same in SQL: all distances anew in every round."""
    parts = [f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {scale}) AS BIGINT)) AS q
  FROM embeddings WHERE len(embedding) = {size}
    AND len(list_filter(embedding, lambda x: abs(CAST(x AS DOUBLE)) * {scale} < {LIMIT})) = {size}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h NULLS LAST, q) - 1 AS c, q
  FROM (SELECT sha256('{salt}' || CAST(vec_id AS VARCHAR)) AS h, q FROM kept ORDER BY h NULLS LAST, q LIMIT {k}))"""]
    for i in range(rounds + 1):
        parts.append(f"""
a{i} AS MATERIALIZED (
  SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT r, c, CAST(list_sum(list_transform(list_zip(v.q, o.q), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
    FROM kept v, c{i} o) GROUP BY r)""")
        if i < rounds:
            parts.append(f"""
m{i} AS MATERIALIZED (
  SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS q
  FROM (SELECT c, j, sum(x) AS s, count(*) AS n
        FROM (SELECT c, unnest(q) AS x, generate_subscripts(q, 1) AS j FROM kept JOIN a{i} USING (r)) GROUP BY c, j) GROUP BY c),
c{i + 1} AS MATERIALIZED (SELECT c, coalesce(m{i}.q, c{i}.q) AS q FROM c{i} LEFT JOIN m{i} USING (c))""")
    return "WITH" + ",".join(parts) + f"""
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(o.q, ',')) AS centroid_sha256
FROM kept JOIN a{rounds} a USING (r) JOIN c{rounds} o ON o.c = a.c"""
