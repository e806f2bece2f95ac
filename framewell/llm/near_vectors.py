"""Near-duplicate vectors by a pivot-permutation index.

Vectors are described by their ``nearest`` nearest pivots. Inverted lists (label, pivot) retrieve
the vectors that name a pivot; two vectors are candidates if they share ``shared`` pivots or
more, counted in the list of their smallest common pivot alone, so every candidate pair is
verified once. Verification is the cosine in double precision.

Pivots are fitted on a bounded sample: about the square root of the number of vectors, at
most ``MAX_PIVOTS``, drawn by hash from four times as many and kept apart, so that a large
group of near copies does not supply them all. Where fewer than ``nearest`` are apart (all
vectors of a length in a narrow cone, or one group of near copies), sampled vectors fill up to that many:
then every vector names every pivot and all pairs of a label are verified, which is exact, and
quadratic in blocks. With fewer vectors than ``shared`` pivots, all pivots count. Every vector is indexed. Equal vectors of
one label are one class before the search; lists of any length are dealt into blocks of
about ``BLOCK`` classes, every two blocks meet once, and a block pair returns counts and one
edge a class, never pairs.

Vectors that are null, zero or hold null or non-finite components, or whose label is null,
link with nothing. Vectors of different lengths have no cosine. Rows with a null vec_id
have no component and link with nothing; repeated rows count as vectors. An empty table gives no
rows. Other columns are not read, so their names can't clash.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewell.llm.common import connected_components, map_batches, materialise

COSINE = 0.98
NEAREST, SHARED = 8, 2
MIN_PIVOTS, MAX_PIVOTS = 64, 4096
APART = 0.9
BLOCK = 1000


def usable(vec: str = "embedding", label: str = "label"):
    """Whether a row can link at all."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (F.col(label).isNotNull() & F.col("vec_id").isNotNull() & F.col(vec).isNotNull()
            & F.coalesce(finite & F.exists(vec, lambda x: x != 0), F.lit(False)))


def choose_pivots(classes: DataFrame, nearest: int = NEAREST) -> dict[int, np.ndarray]:
    """Unit pivots for every vector length: at most MAX_PIVOTS from at most four times as many rows, and
    at least ``nearest`` if there are as many rows."""
    out = {}
    for dim, n in [(r.dim, r.n) for r in classes.groupBy("dim").agg(F.count("*").alias("n")).collect()]:
        want = min(MAX_PIVOTS, max(MIN_PIVOTS, 2 ** round(math.log2(max(1.0, math.sqrt(n))))))
        rows = (classes.where(F.col("dim") == dim).select("id", "vec").orderBy(F.xxhash64("id", F.lit("pivot")), "id")
                .limit(4 * want).collect())
        if not rows:
            continue
        sample = np.array([r.vec for r in rows], dtype=np.float64)
        sample /= np.abs(sample).max(axis=1)[:, None]
        sample /= np.linalg.norm(sample, axis=1)[:, None]
        kept = [0]
        for i in range(1, len(sample)):
            if len(kept) < want and (sample[kept] @ sample[i]).max() < APART:
                kept.append(i)
        if len(kept) < nearest:
            kept += [i for i in range(len(sample)) if i not in set(kept)][:nearest - len(kept)]
        out[dim] = sample[kept]
    return out


def unit(vecs: np.ndarray) -> np.ndarray:
    v = vecs.astype(np.float64)
    v = v / np.abs(v).max(axis=1)[:, None]
    return v / np.sqrt((v * v).sum(axis=1))[:, None]


def index_lists(classes: DataFrame, nearest: int) -> DataFrame:
    """One row per class and pivot that it names: label, dim, pivot, id, size, vec, pivots."""
    shared = classes.sparkSession.sparkContext.broadcast(choose_pivots(classes, nearest))
    schema = T.StructType([*classes.select("label", "dim", "id", "size", "vec").schema.fields,
                           T.StructField("pivots", T.ArrayType(T.IntegerType()))])

    def make():
        pivots = shared.value

        def fn(batch):
            dims = batch.column(1).to_pylist()
            vecs = batch.column(4).to_pylist()
            names: list = [None] * len(dims)
            for dim in set(dims):
                at = [i for i, d in enumerate(dims) if d == dim]
                near = unit(np.array([vecs[i] for i in at])) @ pivots[dim].T
                for i, row in zip(at, np.sort(np.argsort(-near, axis=1, kind="stable")[:, :nearest], axis=1).tolist(), strict=True):
                    names[i] = row
            yield {**{c: batch.column(k) for k, c in enumerate(("label", "dim", "id", "size", "vec"))}, "pivots": names}
        return fn

    return map_batches(classes.select("label", "dim", "id", "size", "vec"), schema, make).withColumn("pivot", F.explode("pivots"))


def block_pair(pivot: int, block_a: np.ndarray, ids: np.ndarray, sizes: np.ndarray, vecs: np.ndarray,
               pivots: np.ndarray, cosine: float, shared: int, i: int, j: int):
    """(ids, links, edge) of the members of two blocks of one list (of one, if i = j)."""
    left = np.flatnonzero(block_a == i)
    right = left if i == j else np.flatnonzero(block_a == j)
    if not len(left) or not len(right):
        return ids[:0], sizes[:0], ids[:0]
    names = np.unique(pivots)
    has = np.zeros((len(ids), len(names)), dtype=np.float32)
    np.put_along_axis(has, np.searchsorted(names, pivots), 1.0, axis=1)
    before = has[:, names < pivot]
    near = has[left] @ has[right].T >= min(shared, pivots.shape[1])  # shared-pivot counts
    near &= before[left] @ before[right].T == 0  # the pair's smallest common pivot is this list's
    if i == j:
        np.fill_diagonal(near, False)
    u = unit(vecs)
    linked = near & (u[left] @ u[right].T >= cosine) if near.any() else near
    # the smallest id that each member reaches inside the two blocks
    a, b, top = ids[left].copy(), ids[right].copy(), np.iinfo(np.int64).max
    while linked.any():
        a2 = np.minimum(a, np.where(linked, b[None, :], top).min(axis=1))
        b2 = np.minimum(b, np.where(linked, a2[:, None], top).min(axis=0))
        if i == j:
            a2 = b2 = np.minimum(a2, b2)
        if (a2 == a).all() and (b2 == b).all():
            break
        a, b = a2, b2
    n_left, n_right = linked @ sizes[right], linked.T @ sizes[left]
    if i == j:
        return ids[left], n_left, a
    return np.concatenate([ids[left], ids[right]]), np.concatenate([n_left, n_right]), np.concatenate([a, b])


def near_vectors(rows: DataFrame, cosine: float = COSINE, nearest: int = NEAREST, shared: int = SHARED) -> DataFrame:
    """One row per row of ``rows`` (vec_id, embedding, label): vec_id, n_links, component_id, kept."""
    named = rows.select("vec_id", "embedding", "label").withColumn("ok", usable()).withColumn(
        "digest", F.when(F.col("ok"), F.md5(F.concat_ws(":", F.col("label").cast("string"), F.col("embedding").cast("string")))))
    classes = materialise(named.where("ok").groupBy("digest").agg(
        F.first("label").alias("label"), F.min("vec_id").alias("id"), F.count("*").alias("size"),
        F.first("embedding").alias("vec")).withColumn("dim", F.size("vec")), "near_vectors")
    lists = materialise(index_lists(classes, nearest), "near_vectors")
    key = ["label", "dim", "pivot"]
    blocks = lists.groupBy(*key).agg((F.floor(F.count("*") / BLOCK) + 1).cast("int").alias("blocks"))
    dealt = (lists.join(blocks, key).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
             .select(*key, "i", "j", "block", "id", "size", "vec", "pivots"))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("links", T.LongType()), T.StructField("edge", T.LongType())])

    def join(group: pa.Table) -> pa.Table:
        def matrix(name, kind):
            flat = group.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)
            return flat.astype(kind).reshape(group.num_rows, -1)

        one = {c: group.column(c)[0].as_py() for c in ("pivot", "i", "j")}
        ids, links, edge = block_pair(
            one["pivot"], group.column("block").to_numpy(), group.column("id").to_numpy(), group.column("size").to_numpy(),
            matrix("vec", np.float64), matrix("pivots", np.int32), cosine, shared, one["i"], one["j"])
        has = links > 0
        return pa.table({"id": pa.array(ids[has], pa.int64()), "links": pa.array(links[has].astype(np.int64)),
                         "edge": pa.array(edge[has], pa.int64())})

    found = materialise(dealt.groupBy(*key, "i", "j").applyInArrow(join, schema), "near_vectors")
    comps = connected_components(found.select(F.col("id").alias("a"), F.col("edge").alias("b")).distinct())
    per_class = (classes.select("digest", "id", "size")
                 .join(found.groupBy("id").agg(F.sum("links").alias("links")), "id", "left")
                 .join(comps.withColumnRenamed("node", "id"), "id", "left")
                 .select("digest", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
                         F.coalesce("component", "id").alias("component")))
    return (named.select("vec_id", "digest").join(per_class, "digest", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))
