"""Legacy web archives: ARC files (versions 1 and 2) converted to WARC.

``read_arc`` parses the version block, the version's header line and the declared length of
every record. ``convert`` synthesises what WARC asks for and ARC lacks: record ids (name-
based UUIDs), ISO timestamps, record types and SHA-1 digests of block and payload. Of
records with equal payloads of at least ``REVISIT_BYTES`` bytes the one with the largest
page id stays a response; the others become revisits that keep only the HTTP header.
``write_arc`` and ``write_warc`` write gzip files through Spark's text sink (the separator that
ends a record is its line end), so any file system that Spark writes works; readers
take whole files, whose size is that of a write task.

A null html is an empty payload; a null url is written as ``urn:none``; white space in a URL is
percent-encoded. Null page ids stay null and sort lowest; of repeated rows with equal
page id and payload one is the response. Empty tables give empty archives. Only page_id, url and html
are read, so other columns can't clash; pages of any length are written whole.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from framewell.llm.common import materialise
from framewell.session import scratch_path

REVISIT_BYTES = 1000
STAMP = "20240101000000"  # archive date of generated records
# Fixed formats of the two archive kinds.
ARC_FIELDS = {1: "URL IP-address Archive-date Content-type Archive-length",
              2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
ARC_END, WARC_END = "\n", "\r\n\r\n"
OUT_BYTES = 4 << 20  # of record blocks in one Arrow batch

LINE = T.StructType([T.StructField("value", T.BinaryType())])
RECORD = T.StructType([
    T.StructField("rid", T.StringType()), T.StructField("version", T.IntegerType()), T.StructField("url", T.StringType()),
    T.StructField("ip", T.StringType()), T.StructField("stamp", T.StringType()), T.StructField("page_id", T.LongType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("block", T.BinaryType())])
WARC = T.StructType([
    T.StructField("record_id", T.StringType()), T.StructField("record_type", T.StringType()), T.StructField("refers_to_id", T.StringType()),
    T.StructField("url", T.StringType()), T.StructField("date", T.StringType()), T.StructField("page_id", T.LongType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()), T.StructField("intact", T.BooleanType())])


def _batches(rows, arrow: pa.Schema, weigh: str):
    """Arrow batches of at most about OUT_BYTES of the column ``weigh``."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[weigh] or b"")
        if size >= OUT_BYTES or len(held) >= 2000:
            yield pa.RecordBatch.from_pylist(held, schema=arrow)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=arrow)


def _write(lines: DataFrame, path: str, end: str) -> None:
    # the cast keeps the bytes as they are
    lines.select(F.col("value").cast("string")).write.option("lineSep", end).option("compression", "gzip").text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def write_arc(pages: DataFrame, path: str) -> None:
    """(page_id, url, html) as ARC files, one per task, version 1 and 2 by turns."""
    arrow = to_arrow_schema(LINE)

    def record(version: int, page_id, url, html: bytes, offset: int) -> bytes:
        head = [b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=UTF-8", b"Content-Length: %d" % len(html)]
        head += [b"X-Page-Id: %d" % page_id] if page_id is not None else []
        block = b"\r\n".join([*head, b"", html])
        if version == 2:
            check = hashlib.sha1(html).hexdigest()
            middle = f"text/html 200 {check} - {offset} part.arc"
        else:
            middle = "text/html"
        url = re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "") or "urn:none"
        return f"{url} 0.0.0.0 {STAMP} {middle} {len(block)}\n".encode() + block

    def run(batches):
        part = TaskContext.get().partitionId()
        version = 1 + part % 2

        def rows():
            note = f"{version} 0 framewell\n{ARC_FIELDS[version]}\n".encode()
            first = f"filedesc://part-{part}.arc 0.0.0.0 {STAMP} text/plain "
            first += f"200 - - 0 part.arc {len(note)}\n" if version == 2 else f"{len(note)}\n"
            value = first.encode() + note
            offset = len(value) + 1
            yield {"value": value}
            for batch in batches:
                cols = (batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist())
                for page_id, url, html in zip(*cols, strict=True):
                    value = record(version, page_id, url, html or b"", offset)
                    offset += len(value) + 1
                    yield {"value": value}

        yield from _batches(rows(), arrow, "value")

    _write(pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(run, LINE), path, ARC_END)


def arc_records(raw: io.BufferedIOBase):
    """(version, header fields, block, index) of the records of one ARC file. The version block
    names the header's fields; the declared length ends the record."""
    names: list[str] = []
    version, index = 0, 0
    while True:
        line = raw.readline()
        if not line:
            return
        line = line.rstrip(b"\r\n")
        if not line:
            continue
        fields = line.decode("utf-8", "replace").split(" ")
        block = raw.read(int(fields[-1]))
        if fields[0].startswith("filedesc:"):
            note = block.decode("utf-8", "replace").splitlines()
            version, names = int(note[0].split(" ")[0]), note[1].split(" ")
            continue
        yield version, dict(zip(names, [" ".join(fields[:len(fields) - len(names) + 1]), *fields[len(fields) - len(names) + 1:]], strict=True)), block, index
        index += 1


def split_http(block: bytes) -> tuple[bytes, bytes, dict[str, str]]:
    """(header with its blank line, payload, header fields) of an HTTP response block."""
    at = block.find(b"\r\n\r\n")
    at = len(block) if at < 0 else at + 4
    fields = {}
    for line in block[:at].decode("latin-1").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            fields[name.strip().lower()] = value.strip()
    return block[:at], block[at:], fields


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """The records of all ARC files under ``path`` (see RECORD)."""
    arrow = to_arrow_schema(RECORD)

    def run(batches):
        def rows():
            for batch in batches:
                for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    raw = gzip.GzipFile(fileobj=io.BytesIO(memoryview(content.as_buffer())))
                    for version, f, block, index in arc_records(raw):
                        _, payload, http = split_http(block)
                        rid = uuid.uuid5(uuid.NAMESPACE_URL, f"{name}#{index} {f['URL']} {f['Archive-date']}")
                        page = http.get("x-page-id")
                        yield {"rid": str(rid), "version": version, "url": f["URL"], "ip": f["IP-address"], "stamp": f["Archive-date"],
                               "page_id": int(page) if page else None, "payload_bytes": len(payload),
                               "payload_digest": hashlib.sha1(payload).hexdigest(), "block": block}

        yield from _batches(rows(), arrow, "block")

    return _files(spark, path).mapInArrow(run, RECORD)


def convert(records: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """``records`` with refers_id, refers_url, refers_stamp: what a revisit refers to, else null. Only
    records whose payload occurs again meet in the joins; blocks move once."""
    keys = materialise(records.drop("block"), "archives")
    best = (keys.where(F.col("payload_bytes") >= revisit_bytes).groupBy("payload_digest", "payload_bytes")
            .agg(F.count("*").alias("n"), F.max(F.struct("page_id", "rid", "url", "stamp")).alias("first")).where("n > 1"))
    again = (keys.select("rid", "payload_digest", "payload_bytes").join(best, ["payload_digest", "payload_bytes"])
             .where(F.col("rid") != F.col("first.rid"))
             .select("rid", F.col("first.rid").alias("refers_id"), F.col("first.url").alias("refers_url"), F.col("first.stamp").alias("refers_stamp")))
    return records.join(materialise(again, "archives"), "rid", "left")


def _sha1_name(hexadecimal: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def _iso(stamp: str) -> str:
    s = stamp.ljust(14, "0")
    return f"{s[:4]}-{s[4:6]}-{s[6:8]}T{s[8:10]}:{s[10:12]}:{s[12:14]}Z"


def warc_record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    """A record without the separator that ends it."""
    lines = ["WARC/1.0", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in fields), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block


def write_warc(converted: DataFrame, path: str) -> None:
    """Converted records as WARC files, one per task, each led by a warcinfo record."""
    arrow = to_arrow_schema(LINE)
    cols = ["rid", "url", "ip", "stamp", "payload_digest", "block", "refers_id", "refers_url", "refers_stamp"]

    def run(batches):
        def rows():
            part = TaskContext.get().partitionId()
            note = b"software: framewell\r\nformat: WARC File Format 1.0\r\n"
            yield {"value": warc_record("warcinfo", [
                ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{path}#{part}')}>"), ("WARC-Date", _iso(STAMP)),
                ("Content-Type", "application/warc-fields")], note)}
            for batch in batches:
                for r in batch.to_pylist():
                    block, kind, more = r["block"], "response", []
                    if r["refers_id"] is not None:
                        block, kind = split_http(block)[0], "revisit"
                        more = [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:uuid:{r['refers_id']}>"),
                                ("WARC-Refers-To-Target-URI", r["refers_url"]), ("WARC-Refers-To-Date", _iso(r["refers_stamp"]))]
                    yield {"value": warc_record(kind, [
                        ("WARC-Record-ID", f"<urn:uuid:{r['rid']}>"), ("WARC-Date", _iso(r["stamp"])), ("WARC-Target-URI", r["url"]),
                        ("WARC-IP-Address", r["ip"]), ("WARC-Payload-Digest", _sha1_name(r["payload_digest"])),
                        ("WARC-Block-Digest", _sha1_name(hashlib.sha1(block).hexdigest())), *more,
                        ("Content-Type", "application/http; msgtype=response")], block)}

        yield from _batches(rows(), arrow, "value")

    _write(converted.select(cols).mapInArrow(run, LINE), path, WARC_END)


def warc_records(raw: io.BufferedIOBase):
    """(header fields, block) of the records of one WARC file, by their declared lengths."""
    while True:
        line = raw.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            continue
        fields = {}
        while line := raw.readline().rstrip(b"\r\n"):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        yield fields, raw.read(int(fields["content-length"]))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The response and revisit records under ``path`` (see WARC); ``intact`` says whether the digests
    recomputed from the stored bytes equal the stored ones."""
    arrow = to_arrow_schema(WARC)

    def urn(value: str | None) -> str | None:
        return value and value.removeprefix("<urn:uuid:").removesuffix(">")

    def run(batches):
        def rows():
            for batch in batches:
                for content in batch.column(1):
                    raw = gzip.GzipFile(fileobj=io.BytesIO(memoryview(content.as_buffer())))
                    for f, block in warc_records(raw):
                        if f["warc-type"] not in ("response", "revisit"):
                            continue
                        _, payload, http = split_http(block)
                        digest = base64.b32decode(f["warc-payload-digest"].removeprefix("sha1:")).hex()
                        whole = f["warc-type"] == "response"
                        same = f["warc-block-digest"] == _sha1_name(hashlib.sha1(block).hexdigest())
                        page = http.get("x-page-id")
                        yield {"record_id": urn(f["warc-record-id"]), "record_type": f["warc-type"], "refers_to_id": urn(f.get("warc-refers-to")),
                               "url": f["warc-target-uri"], "date": f["warc-date"], "page_id": int(page) if page else None,
                               "payload_bytes": len(payload) if whole else int(http["content-length"]), "payload_digest": digest,
                               "intact": same and (not whole or hashlib.sha1(payload).hexdigest() == digest)}

        yield from _batches(rows(), arrow, "record_id")

    return _files(spark, path).mapInArrow(run, WARC)


def pages_through_archives(pages: DataFrame) -> DataFrame:
    """Pages written as ARC, converted, written as WARC and read back: page_id, payload_bytes,
    payload_digest, record_type, refers_to (page id), intact."""
    spark = pages.sparkSession
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(pages, arc)
    write_warc(convert(read_arc(spark, arc)), warc)
    back = materialise(read_warc(spark, warc), "archives")
    target = back.where("record_type = 'response'").select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"))
    return (back.join(target, "refers_to_id", "left")
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact"))
