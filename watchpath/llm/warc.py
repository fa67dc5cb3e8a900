"""WARC archives: a writer and a sequential reader.

Every page becomes one record in one gzip member. Of pages with equal payloads
the one with the largest id is stored as ``response``; the others are
``revisit`` records that carry the HTTP header and refer to it.

Spark's text writer writes a string column's bytes as they are, followed by the
line separator. A gzip member of less than 16 MB of data ends in a zero byte
(the top byte of its length), so members are handed over without that byte and
the separator puts it back: the files are plain concatenated gzip members. A
larger record is followed by an empty member, which readers pass over.

A file is one value for the reader (Spark's ``binaryFile``), so files are bounded by
bytes: each task numbers its members by their running size and starts a file when the
next member would pass the bound. Only a record larger than that makes a larger file.
Archives of other writers are read as they are, up to the 2 GB that ``binaryFile``
takes, and one of their files must fit a task twice (JVM and Python).

The reader inflates one member after another in bounded steps, frames the block by its
Content-Length, and verifies block and payload digests.

Cases: a null payload is an empty one; empty payloads are equal to each other.
A null url gives no target header; a null page id is written as ``null`` and
read back as null. Rows that repeat the id of their group's response are
responses too (they hold the same payload). No pages give an archive without
records. Other columns do not matter.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import col, materialize, run_path

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEVEL = 4
#: Bytes of an archive file at most, but for a single larger record.
FILE_BYTES = 64 << 20
_STEP = 1 << 16
_EMPTY = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\x03\x03\x00" + bytes(8)
_URN = "urn:page:"


def digest(data: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _header(fields: list[tuple[str, str]], first: str) -> bytes:
    clean = ((k, v.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if k == "WARC-Target-URI" else v)
             for k, v in fields)
    return "\r\n".join([first, *(f"{k}: {v}" for k, v in clean), "", ""]).encode()


def record(page_id, url: str | None, payload: bytes, refers_to=None) -> bytes:
    """One record as a gzip member; with ``refers_to`` a revisit without payload."""
    http = _header([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))], "HTTP/1.1 200 OK")
    block = http if refers_to is not None else http + payload
    name = "null" if page_id is None else page_id
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"),
              ("WARC-Record-ID", f"<{_URN}{name}>"), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", url))
    fields += [("WARC-Payload-Digest", f"sha1:{digest(payload)}"), ("WARC-Block-Digest", f"sha1:{digest(block)}")]
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<{_URN}{refers_to}>"), ("WARC-Profile", PROFILE)]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    member = b"".join((packer.compress(_header(fields, "WARC/1.1")), packer.compress(block),
                       packer.compress(b"\r\n\r\n"), packer.flush()))
    return member if member[-1] == 0 else member + _EMPTY


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes


class Members:
    """Records of a file of gzip members, read in order with bounded inflation steps."""

    def __init__(self, data: bytes) -> None:
        self._data = memoryview(data)
        self._at = 0

    def __iter__(self) -> Iterator[Record]:
        while self._at < len(self._data):
            if (read := self._member()) is not None:
                yield read

    def _member(self) -> Record | None:
        inflate, start = zlib.decompressobj(31), self._at
        text, headers, need = bytearray(), None, None
        feed = self._at
        while not inflate.eof:
            pending = inflate.unconsumed_tail
            if not pending:
                pending = self._data[feed: feed + _STEP]
                if not pending:
                    raise ValueError(f"the gzip member at byte {start} is cut off")
                feed += len(pending)
            text += inflate.decompress(pending, _STEP)
            if headers is None and (end := text.find(b"\r\n\r\n")) >= 0:
                headers = parse_header(bytes(text[:end]), "WARC/")
                need = int(headers["content-length"])
                del text[: end + 4]
        self._at = feed - len(inflate.unused_data)
        if headers is None:
            if text:
                raise ValueError(f"the gzip member at byte {start} holds no record")
            return None
        if len(text) != need + 4 or text[need:] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {start} does not have the {need} bytes it names")
        return Record(headers, bytes(text[:need]))


def parse_header(head: bytes, start: str) -> dict[str, str]:
    """Fields of a header block by lower-cased name."""
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    if not first.startswith(start):
        raise ValueError(f"not a {start} header: {first[:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def _number(field: str | None) -> int | None:
    value = (field or "").strip("<>").removeprefix(_URN)
    return int(value) if value not in ("", "null") else None


def _verified(r: Record) -> tuple:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload."""
    h = r.headers
    if h["warc-block-digest"] != f"sha1:{digest(r.block)}":
        raise ValueError(f"block digest of {h['warc-record-id']} does not match")
    head, _, payload = r.block.partition(b"\r\n\r\n")
    size = int(parse_header(head, "HTTP/")["content-length"])
    named = h["warc-payload-digest"].removeprefix("sha1:")
    if h["warc-type"] == "response" and (len(payload) != size or digest(payload) != named):
        raise ValueError(f"payload of {h['warc-record-id']} does not match its digest")
    url = h.get("warc-target-uri")
    if url is not None:
        url = url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
    return (_number(h["warc-record-id"]), url, size, named, h["warc-type"], _number(h.get("warc-refers-to")),
            payload if h["warc-type"] == "response" else None)


def _members(file_bytes: int) -> Callable:
    """Each record's member without its last byte, and the number of its file among the task's files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, held = 0, 0
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "refers_to")]
            for page, url, payload, refers_to in zip(*columns, strict=True):
                made = record(page.as_py(), url.as_py(), payload.as_py() or b"", refers_to.as_py())
                if held and held + len(made) > file_bytes:
                    file, held = file + 1, 0
                held += len(made)
                yield pa.RecordBatch.from_pydict({"file": pa.array([file], pa.int32()),
                                                  "member": pa.array([made[:-1]], pa.binary())})

    return run


def write_archives(pages: DataFrame, path: str, id: str = "page_id", url: str = "url", payload: str = "html",
                   least: int = 0, file_bytes: int = FILE_BYTES) -> None:
    """Writes a record per page; equal payloads of at least ``least`` bytes are stored once. A folder per file
    number holds one file of each task."""
    data = F.coalesce(col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(col(id).cast("long").alias("page_id"), col(url).alias("url"), data.alias("payload"))
    key = (F.sha2("payload", 256).alias("sha"), F.octet_length("payload").alias("size"))
    same = rows.select("page_id", *key).filter(F.col("size") >= least).groupBy("sha", "size").agg(
        F.max("page_id").alias("stored"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    same = materialize(same, "warc-same")          # written first, so the join below is planned by its true size
    joined = rows.select("*", *key).join(same, ["sha", "size"], "left")
    refers_to = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("stored")), F.col("stored"))
    records = joined.select("page_id", "url", "payload", refers_to.alias("refers_to"))
    members = records.mapInArrow(_batched(_members(file_bytes)), "file int, member binary")
    members.select("file", F.col("member").cast("string").alias("value")).write.option("lineSep", "\x00").option(
        "compression", "none").option("maxRecordsPerFile", 0).partitionBy("file").text(path)


def _batched(make: Callable, size: int = 4 << 20):
    """Joins single-row batches up to about ``size`` bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        total = 0
        for one in make(batches):
            held.append(one)
            total += one.nbytes
            if total > size:
                yield pa.concat_batches(held)
                held, total = [], 0
        if held:
            yield pa.concat_batches(held)

    return run


_FIELDS = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]


def _records(with_payload: bool):
    fields = _FIELDS if with_payload else _FIELDS[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, held = [], 0
                for r in Members(content.as_buffer()):
                    rows.append(_verified(r))
                    held += len(r.block)
                    if held > 8 << 20 and with_payload or len(rows) >= 5000:
                        yield _table(rows, fields)
                        rows, held = [], 0
                yield _table(rows, fields)

    return run


def _table(rows: list[tuple], fields: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(_FIELDS)
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[i], _TYPES[i]) for i in range(len(fields))], names=fields)


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives under ``path``; fails on a bad frame or digest."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    schema = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
              "refers_to long") + (", payload binary" if with_payload else "")
    return files.mapInArrow(_records(with_payload), schema)


def archived(pages: DataFrame, id: str = "page_id", url: str = "url", payload: str = "html", least: int = 0,
             with_payload: bool = True, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the pages to archives in the shared folder and reads them back."""
    path = run_path(pages, "warc")
    write_archives(pages, path, id, url, payload, least, file_bytes)
    return read_archives(pages.sparkSession, path, with_payload)
