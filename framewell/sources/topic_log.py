"""Row topics: a Spark data source of messages counted in rows.

A topic folder holds data files that tasks write and numbered commit files. Each commit names the
segments it adds, ``(partition, base, rows, file)``: the offset of a message is its segment's base
plus its place in the file. Tasks never number rows, so a retried or speculative task leaves
nothing but a file that no commit names; the driver hands out each partition's offsets once, from the
ends that the last commit states. Offsets are dense from 0 in every partition, in the order of the
written frame's partitions and rows.

Reading plans slices of segments: a trigger takes at most ``maxRowsPerTrigger`` rows, shared among the
partitions by what each has left, and every slice is read by a task of its own. Positions
come from the query's checkpoint. ``startingOffsets`` is ``earliest`` or ``latest`` (new queries only).

One query or job appends to a topic at a time. The folder may be on any file system that
``pyarrow.fs`` opens by URI.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter,
                                    DataSourceStreamReader, InputPartition, WriterCommitMessage)

FORMAT = "framewell_topic"
SCHEMA = "partition int, offset long, timestamp timestamp, key string, value string"
ARROW = pa.schema([("partition", pa.int32()), ("offset", pa.int64()), ("timestamp", pa.timestamp("us", "UTC")),
                   ("key", pa.string()), ("value", pa.string())])
STORED = pa.schema([ARROW.field(c) for c in ("timestamp", "key", "value")])
ROW_GROUP, SLICE_ROWS = 10_000, 500_000


@dataclass
class Segment:
    partition: int
    base: int
    rows: int
    file: str


class TopicLog:
    """The commits of one topic folder."""

    def __init__(self, path: str):
        self.fs, root = pafs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
        self.root = root.rstrip("/")

    def versions(self) -> list[int]:
        found = self.fs.get_file_info(pafs.FileSelector(f"{self.root}/commits", allow_not_found=True))
        return sorted(int(f.base_name.split(".")[0]) for f in found if f.base_name.endswith(".json"))

    def commit_at(self, version: int) -> dict:
        with self.fs.open_input_file(f"{self.root}/commits/{version:012d}.json") as f:
            return json.loads(f.read())

    def ends(self) -> dict[str, int]:
        """The next offset of every partition."""
        versions = self.versions()
        return self.commit_at(versions[-1])["ends"] if versions else {}

    def newest_first(self) -> Iterator[dict]:
        for v in reversed(self.versions()):
            yield self.commit_at(v)

    def append(self, pieces: list[tuple[int, int, str]], writer: str, batch: int | None = None) -> None:
        """Number the rows of written files and publish them. A streaming writer's batch that is
        already published is not published again."""
        if batch is not None:
            for c in self.newest_first():
                if c["writer"] == writer:
                    if c["batch"] >= batch:
                        return
                    break
        versions = self.versions()
        begins = self.commit_at(versions[-1])["ends"] if versions else {}
        ends, segments = dict(begins), []
        for partition, rows, file in pieces:
            base = ends.get(str(partition), 0)
            segments.append([partition, base, rows, file])
            ends[str(partition)] = base + rows
        body = {"writer": writer, "batch": batch, "begins": begins, "ends": ends, "segments": segments}
        self.fs.create_dir(f"{self.root}/commits", recursive=True)
        draft, final = f"{self.root}/commits/{uuid.uuid4().hex}.draft", f"{self.root}/commits/{(versions[-1] if versions else -1) + 1:012d}.json"
        with self.fs.open_output_stream(draft) as f:
            f.write(json.dumps(body).encode())
        self.fs.move(draft, final)  # readers see a commit whole or not at all

    def slices(self, start: dict[str, int], end: dict[str, int]) -> list[tuple[Segment, int, int]]:
        """(segment, first row, end row) of the offsets from ``start`` up to ``end``; commits older than
        ``start`` are not read."""
        out = []
        for c in self.newest_first():
            for s in (Segment(*x) for x in c["segments"]):
                a = max(s.base, start.get(str(s.partition), 0))
                b = min(s.base + s.rows, end.get(str(s.partition), 0))
                out += [(s, i - s.base, min(i + SLICE_ROWS, b) - s.base) for i in range(a, b, SLICE_ROWS)]
            if all(n <= start.get(p, 0) for p, n in c["begins"].items()):
                break
        return out

    def read(self, segment: Segment, first: int, last: int) -> Iterator[pa.RecordBatch]:
        """The rows ``first`` to ``last`` of a segment, by row groups."""
        with self.fs.open_input_file(f"{self.root}/data/{segment.file}") as f:
            file, at = pq.ParquetFile(f), 0
            for g in range(file.num_row_groups):
                n = file.metadata.row_group(g).num_rows
                a, b = max(first, at), min(last, at + n)
                if a < b:
                    rows = file.read_row_group(g).slice(a - at, b - a)
                    yield from pa.table({"partition": pa.array([segment.partition] * (b - a), pa.int32()),
                                         "offset": pa.array(range(segment.base + a, segment.base + b), pa.int64()),
                                         **{c: rows.column(c) for c in STORED.names}}, schema=ARROW).combine_chunks().to_batches()
                at += n


def share_rows(left: dict[str, int], most: int) -> dict[str, int]:
    """``most`` rows shared among partitions in proportion to what each has left, none of them lost to
    rounding."""
    total = sum(left.values())
    if total <= most:
        return dict(left)
    out = {p: n * most // total for p, n in left.items()}
    spare = most - sum(out.values())
    for p in sorted(left, key=lambda p: (out[p] - left[p] * most / total, p)):
        if spare and out[p] < left[p]:
            out[p] += 1
            spare -= 1
    return out


class _Slice(InputPartition):
    """One slice of a segment: what a task reads."""


def _read_slice(path: str, partition: InputPartition) -> Iterator[pa.RecordBatch]:
    segment, first, last = partition.value
    yield from TopicLog(path).read(Segment(*segment), first, last)


def _planned(slices) -> list[InputPartition]:
    return [_Slice(((s.partition, s.base, s.rows, s.file), a, b)) for s, a, b in slices]


class TopicStreamReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.log = TopicLog(self.path)
        self.latest = options.get("startingOffsets", "earliest") == "latest"
        self.most = int(options["maxRowsPerTrigger"]) if options.get("maxRowsPerTrigger") else None
        self.first: dict[str, int] | None = None
        self.at: dict[str, int] | None = None  # the end of the last planned batch; the engine plans it anew on a restart

    def initialOffset(self) -> dict:
        if self.first is None:
            ends = self.log.ends()
            self.first = ends if self.latest else dict.fromkeys(ends, 0)
        return self.first

    def latestOffset(self) -> dict:
        start = self.initialOffset() if self.at is None else self.at
        ends = self.log.ends()
        left = {p: n - start.get(p, 0) for p, n in ends.items()}
        if self.most is not None:
            left = share_rows(left, self.most)
        return {p: start.get(p, 0) + n for p, n in left.items()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.at = end
        return _planned(self.log.slices(start, end))

    def read(self, partition: InputPartition):
        return _read_slice(self.path, partition)


class TopicReader(DataSourceReader):
    """All committed rows, or those of one writer's commits."""

    def __init__(self, options: dict):
        self.path, self.writer = options["path"], options.get("writer")

    def partitions(self) -> list[InputPartition]:
        log = TopicLog(self.path)
        if self.writer is None:
            planned = _planned(log.slices({}, log.ends()))
        else:
            mine = (Segment(*x) for c in log.newest_first() if c["writer"] == self.writer for x in c["segments"])
            planned = _planned((s, i, min(i + SLICE_ROWS, s.rows)) for s in mine for i in range(0, s.rows, SLICE_ROWS))
        return planned or [InputPartition(None)]

    def read(self, partition: InputPartition):
        return iter(()) if partition.value is None else _read_slice(self.path, partition)


@dataclass
class Written(WriterCommitMessage):
    pieces: list[tuple[int, int, str]]


def _write_task(path: str, batches: Iterator[pa.RecordBatch]) -> Written:
    """Write a task's rows, one file for each topic partition, in their order."""
    log = TopicLog(path)
    log.fs.create_dir(f"{log.root}/data", recursive=True)
    files: dict[int, tuple[str, pq.ParquetWriter]] = {}
    rows: dict[int, int] = {}
    for batch in batches:
        where = batch.column("partition")
        stored = pa.table([batch.column(f.name).cast(f.type) for f in STORED], schema=STORED)
        for p in pc.unique(where).to_pylist():
            if p not in files:
                name = f"{p}-{uuid.uuid4().hex}.parquet"
                files[p] = name, pq.ParquetWriter(f"{log.root}/data/{name}", STORED, filesystem=log.fs)
                rows[p] = 0
            some = stored.filter(pc.equal(where, p))
            files[p][1].write_table(some, row_group_size=ROW_GROUP)
            rows[p] += some.num_rows
    for _, writer in files.values():
        writer.close()
    return Written([(p, rows[p], files[p][0]) for p in sorted(files)])


def _pieces(messages) -> list[tuple[int, int, str]]:
    return [x for m in messages if m is not None for x in m.pieces]


class TopicWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.writer = options["path"], options.get("writer") or uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        return _write_task(self.path, iterator)

    def commit(self, messages) -> None:
        TopicLog(self.path).append(_pieces(messages), self.writer)

    def abort(self, messages) -> None:
        """Files that no commit names are not part of the topic."""


class TopicStreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, options: dict):
        self.path, self.writer = options["path"], options["writer"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        return _write_task(self.path, iterator)

    def commit(self, messages, batchId: int) -> None:
        TopicLog(self.path).append(_pieces(messages), self.writer, batchId)

    def abort(self, messages, batchId: int) -> None:
        """Files that no commit names are not part of the topic."""


class TopicSource(DataSource):
    """``spark.read / readStream / write / writeStream .format(FORMAT)``; options: path, maxRowsPerTrigger,
    startingOffsets, writer. Frames to write have the columns partition, timestamp, key, value."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TopicReader:
        return TopicReader(self.options)

    def streamReader(self, schema) -> TopicStreamReader:
        return TopicStreamReader(self.options)

    def writer(self, schema, overwrite: bool) -> TopicWriter:
        return TopicWriter(self.options)

    def streamWriter(self, schema, overwrite: bool) -> TopicStreamWriter:
        return TopicStreamWriter(self.options)
