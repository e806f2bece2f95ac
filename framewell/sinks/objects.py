"""Objects stored as numbered chunks.

An object is a run of chunk rows (object_id, n, bytes, digest) and one manifest row that tells their number, length
and the digest of their digests. Neither storing files nor fetching objects holds an object in a row or in memory:
files are read by ranges, each by a task of its own, and written chunk after chunk. Order, number and digests
are checked on the way back.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


CHUNK_BYTES = 4 << 20
_CHUNK = "object_id string, n int, filename string, metadata map<string,string>, bytes binary"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))


def _bound_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 * CHUNK_BYTES))


def _store(chunks: DataFrame, root: str) -> DataFrame:
    """Write chunk rows as one upload, then their manifest; the manifest rows."""
    spark, root, upload = chunks.sparkSession, root.rstrip("/"), uuid.uuid4().hex
    chunks.withColumn("digest", F.sha2("bytes", 256)).write.parquet(f"{root}/chunks/upload={upload}")
    written = spark.read.parquet(f"{root}/chunks/upload={upload}")
    # the chunks' digests of an object are 64 bytes for each CHUNK_BYTES of it
    manifest = written.groupBy("object_id").agg(
        F.max("filename").alias("filename"), F.sum(F.octet_length("bytes").cast("long")).alias("length"), F.count(F.lit(1)).cast("int").alias("n_chunks"),
        _digest_of_digests().alias("digest"), F.max_by("metadata", F.col("n") == 0).alias("metadata"))
    manifest.write.parquet(f"{root}/manifest/upload={upload}")
    return spark.read.parquet(f"{root}/manifest/upload={upload}")


def _digest_of_digests() -> Column:
    listed = F.sort_array(F.collect_list(F.struct("n", "digest")))
    return F.sha2(F.concat_ws(",", F.transform(listed, lambda c: c["digest"])), 256)


def put_rows(df: DataFrame, root: str, name_col: str = "name", content_col: str = "content", metadata_cols: Sequence[str] = (),
             chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """K8: store the objects that rows hold; (object_id, filename, length, n_chunks, digest, metadata) of each. An empty
    object has one empty chunk, a null one is not stored."""
    meta = F.create_map(*[x for c in metadata_cols for x in (F.lit(c), F.col(c).cast("string"))]) if metadata_cols else F.create_map()
    rows = df.where(F.col(content_col).isNotNull()).select(
        F.expr("uuid()").alias("object_id"), F.col(name_col).alias("filename"), meta.cast("map<string,string>").alias("metadata"), F.col(content_col).cast("binary").alias("c"))
    last = F.greatest(F.ceil(F.octet_length("c") / chunk_bytes), F.lit(1)) - 1
    cut = rows.select("*", F.explode(F.sequence(F.lit(0), last.cast("int"))).alias("n"))
    return _store(cut.select("object_id", "n", "filename", "metadata", F.substring("c", F.col("n") * chunk_bytes + 1, F.lit(chunk_bytes)).alias("bytes")), root)


def put_files(spark: SparkSession, folder: str, root: str, glob: str = "*", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """K8: store the files of a folder, whatever their size: they are listed without their bytes and read by ranges.
    Spark's listing leaves out files without a byte; there is nothing of them to store."""
    _bound_batches(spark)
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder).select("path", "length"))
    last = F.greatest(F.ceil(F.col("length") / chunk_bytes), F.lit(1)) - 1
    ranges = (files.withColumn("object_id", F.sha2("path", 256)).withColumn("n", F.explode(F.sequence(F.lit(0), last.cast("int"))))
              .repartition("object_id", "n"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, object_id, n in zip(*(batch.column(c).to_pylist() for c in ("path", "object_id", "n")), strict=True):
                store, name = _open(path)
                with store.open_input_file(name) as f:
                    f.seek(n * chunk_bytes)
                    data = f.read(chunk_bytes)
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in (
                    (object_id, pa.string()), (n, pa.int32()), (name.rsplit("/", 1)[-1], pa.string()),
                    ([("path", path)], pa.map_(pa.string(), pa.string())), (data, pa.binary()))], names=["object_id", "n", "filename", "metadata", "bytes"])

    return _store(ranges.select("path", "object_id", "n").mapInArrow(read, _CHUNK), root)


def list_objects(spark: SparkSession, root: str) -> DataFrame:
    """The manifest rows of all objects; no chunk is read."""
    return spark.read.parquet(f"{root.rstrip('/')}/manifest").drop("upload")


def _chunks(spark: SparkSession, root: str, ids: DataFrame | None) -> DataFrame:
    chunks = spark.read.parquet(f"{root.rstrip('/')}/chunks")
    return chunks if ids is None else chunks.join(ids.select("object_id").distinct(), "object_id", "left_semi")


def verify_objects(spark: SparkSession, root: str, ids: DataFrame | None = None) -> DataFrame:
    """(object_id, filename, reasons): what is wrong with each stored object; an empty array if nothing."""
    seen = _chunks(spark, root, ids).groupBy("object_id").agg(
        F.count(F.lit(1)).alias("c"), F.count_distinct("n").alias("d"), F.max("n").alias("last"), F.sum(F.octet_length("bytes").cast("long")).alias("l"),
        F.count_if(F.sha2("bytes", 256) != F.col("digest")).alias("bad"), _digest_of_digests().alias("all"))
    told = list_objects(spark, root)
    told = told if ids is None else told.join(ids.select("object_id").distinct(), "object_id", "left_semi")
    j = told.join(seen, "object_id", "left")
    reasons = F.array_compact(F.array(
        F.when(F.coalesce("c", F.lit(0)) < F.col("n_chunks"), F.lit("chunks are missing")),
        F.when((F.col("c") > F.col("d")) | (F.col("last") >= F.col("n_chunks")), F.lit("chunks too many")),
        F.when(F.col("bad") > 0, F.lit("bytes changed")),
        F.when((F.col("all") != F.col("digest")) | (F.col("l") != F.col("length")), F.lit("not the stored object"))))
    return j.select("object_id", "filename", reasons.alias("reasons"))


def get_files(spark: SparkSession, root: str, folder: str, ids: DataFrame | None = None) -> DataFrame:
    """Write objects as files ``folder/object_id``, chunk after chunk, and return (object_id, path, length, sha256) of
    each. A chunk that is missing, repeated or changed fails the job; a file appears only when it is whole."""
    _bound_batches(spark)
    folder = folder.rstrip("/")
    told = list_objects(spark, root).select("object_id", "n_chunks")
    rows = _chunks(spark, root, ids).select("object_id", "n", "bytes", "digest").join(told, "object_id")
    rows = rows.repartition("object_id").sortWithinPartitions("object_id", "n")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        store.create_dir(base, recursive=True)
        current, out, whole, size, expected, total = None, None, None, 0, 0, 0

        def finish() -> pa.RecordBatch:
            if expected != total:
                raise ValueError(f"object {current}: {expected} of {total} chunks")
            out.close()
            store.move(draft, f"{base}/{current}")
            return pa.RecordBatch.from_arrays([pa.array([current]), pa.array([f"{folder}/{current}"]), pa.array([size]), pa.array([whole.hexdigest()])],
                                              names=["object_id", "path", "length", "sha256"])

        for batch in batches:
            for object_id, n, data, digest, count in zip(*(batch.column(c).to_pylist() for c in ("object_id", "n", "bytes", "digest", "n_chunks")), strict=True):
                if object_id != current:
                    if current is not None:
                        yield finish()
                    current, whole, size, expected, total = object_id, hashlib.sha256(), 0, 0, count
                    draft = f"{base}/.{object_id}.{uuid.uuid4().hex}"  # attempts don't meet
                    out = store.open_output_stream(draft)
                if n != expected or hashlib.sha256(data).hexdigest() != digest:
                    raise ValueError(f"object {object_id}: chunk {n} where {expected} was due, or its bytes changed")
                out.write(data)
                whole.update(data)
                size, expected = size + len(data), expected + 1
        if current is not None:
            yield finish()

    return rows.mapInArrow(write, "object_id string, path string, length long, sha256 string")