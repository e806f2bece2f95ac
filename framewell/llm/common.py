"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import sys
import types
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from framewell.session import scratch_path

# Rows and bytes that one Arrow batch may hold: very long texts are spread over
# more batches, so a Python worker's memory does not depend on their number.
BATCH_ROWS = 2000
BATCH_BYTES = 8 << 20
SMALL_BATCH_BYTES = 2 << 20  # where several operators follow each other in the same worker processes


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, with the Arrow batch bounds of this package set."""
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Bound the Arrow batches of the session (to ``most`` bytes) and fix its time zone to UTC."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most))
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def materialise(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared work folder and read it back: cuts
    the lineage, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, kind)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(name: str) -> str:
    """A column name that no input column has."""
    return f"__{name}_{uuid.uuid4().hex[:12]}"


def map_batches(df: DataFrame, schema: T.StructType,
                make: Callable[[], Callable[[pa.RecordBatch], Iterable[dict]]]) -> DataFrame:
    """Arrow-batched map. ``make()`` runs once per task (build automata and caches
    there) and returns a function from a batch to column dictionaries."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for cols in fn(batch):
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
                     for f, c in zip(arrow, (cols[f.name] for f in arrow), strict=True)],
                    schema=arrow)
        give_back_memory()

    return df.mapInArrow(run, schema)


def append_columns(df: DataFrame, column: str, schema: T.StructType, name: str,
                   make: Callable[[], Callable[[pa.Array], dict]]) -> DataFrame:
    """``df`` with one more struct column ``name`` computed from ``column``; all
    other columns pass through unread."""
    out = T.StructType([*df.schema.fields, T.StructField(name, schema)])
    arrow = to_arrow_schema(out)
    at = df.columns.index(column)
    inner = arrow.field(len(arrow) - 1).type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            cols = fn(batch.column(at))
            arrays = [c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
                      for f, c in ((f, cols[f.name]) for f in inner)]
            yield pa.RecordBatch.from_arrays(
                [*(c.cast(f.type) for c, f in zip(batch.columns, arrow, strict=False)),
                 pa.StructArray.from_arrays(arrays, fields=list(inner))], schema=arrow)
        give_back_memory()

    return df.mapInArrow(run, out)


def give_back_memory() -> None:
    """At a task's end: return what allocators keep for reuse, as the worker process stays."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def arrow_column(kind: T.DataType, make: Callable[[], Callable[[pa.Array], pa.Array]], column: Column) -> Column:
    """A column computed from another in Arrow batches; all other columns stay in the JVM. ``make()`` runs
    once per task."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fn = make()
        for batch in batches:
            yield fn(batch)
        give_back_memory()

    return F.arrow_udf(run, kind)(column)


def byte_slices(column: pa.Array, most: int) -> Iterator[pa.Array]:
    """Consecutive slices of a string column of about ``most`` bytes, of one row at least."""
    size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64))
    at = 0
    while at < len(column):
        before = int(size[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(size, before + most, side="right")))
        yield column.slice(at, end - at)
        at = end


def utf8(column: pa.Array) -> list[bytes | None]:
    """The values of a string column as UTF-8 bytes."""
    return column.cast(pa.binary()).to_pylist()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) with component = smallest node reachable, for every node of
    ``edges``. Large-star and small-star rounds until the edges stop changing: the
    edge count never grows, minima are partial aggregates, and a hub's edges are
    an ordinary skewed join side. Every round is a written table."""
    cur = materialise(edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "cc")
    state = None
    while True:
        both = cur.unionAll(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        nxt = materialise(small.select("e.u", "e.v").where("u != v").distinct(), "cc")
        now = nxt.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        cur = nxt
        if tuple(now) == state:
            break
        state = tuple(now)
    member = cur.groupBy("u").agg(F.min("v").alias("component"))
    return (member.select(F.col("u").alias("node"), "component")
            .unionAll(member.select(F.col("component").alias("node"), "component").distinct()))


def worker_cache(key: tuple, make: Callable[[], object]) -> object:
    """``make()``'s value, kept for later tasks of the same worker process; one value per operator (the
    first part of ``key``), so other keys replace it. Holds what a task may build anew at any time."""
    home = sys.modules.setdefault("framewell_worker_cache", types.ModuleType("framewell_worker_cache")).__dict__
    if home.get(key[0], (None,))[0] != key:
        home[key[0]] = key, make()
    return home[key[0]][1]


def vocabulary_matches(trie, texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(joined, offsets, lengths, end, piece) of all matches of an Aho-Corasick automaton of piece numbers in several
    texts, searched as one text joined by a character of no piece: ``end`` is the place after the match, ascending."""
    joined = "\0".join(texts)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    offsets = np.concatenate([[0], np.cumsum(lengths[:-1] + 1)]) if texts else np.zeros(0, np.int64)
    found = np.fromiter(trie.iter(joined), np.dtype([("last", np.int64), ("piece", np.int64)]))
    return joined, offsets, lengths, found["last"] + 1, found["piece"]
