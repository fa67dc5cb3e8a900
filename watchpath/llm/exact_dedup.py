"""Exact deduplication by Grace hashing.

Texts are equal when identical after deleting white space ``[\\x20\\x09-\\x0D]``.

1. ``written`` stores every row once with a row number, its content hash and
   sizes (shared folder; later steps read only the columns they need).
2. ``bucket_bits`` repartitions the hash space, level by level, until the
   distinct contents of every bucket fit ``bucket_bytes`` (or the bucket is one
   content). Only hashes and sizes move here.
3. Records are combined within each task (so a hot content sends one record per
   task), spilled to their buckets by Spark's shuffle and, inside a task, by its
   spillable sort, and each bucket is loaded into an open-addressing table that
   compares complete contents.
4. Each row joins its group's verdict on the digest. Adaptive execution splits
   a hot digest's rows, as the join has shuffles of its own on both sides.

Cases: a null text is an empty text, and empty texts are equal to each other.
Of a group, most code points in the original text, then the smallest id (null
ids last), then the earliest row stays; so of repeated rows exactly one stays.
An empty table gives an empty result. Other columns are carried untouched.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import col, materialize, numbered
from .textarrays import WHITE

#: Largest total of distinct contents in a bucket's table, and what an entry counts besides its content.
BUCKET_BYTES = 16 << 20
ENTRY_BYTES = 400
#: Bytes of whole rows that a worker sends on in one batch (more if a batch that came was larger).
OUT_BYTES = 4 << 20
_HASH_BITS = 63


class ContentTable:
    """Open addressing with linear probing; only equal complete contents share an entry.

    An entry keeps its best member, ranked by (-points, id is null, id, row),
    and the number of its members.
    """

    def __init__(self) -> None:
        self._mask = 1023
        self._slots = [-1] * 1024
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.best: list[tuple] = []
        self.counts: list[int] = []
        self.size = 0

    def add(self, h: int, content: bytes, rank: tuple, count: int) -> None:
        at = h & self._mask
        while (entry := self._slots[at]) >= 0:
            if self.hashes[entry] == h and self.contents[entry] == content:
                self.counts[entry] += count
                if rank < self.best[entry]:
                    self.best[entry] = rank
                return
            at = (at + 1) & self._mask
        self._slots[at] = len(self.hashes)
        self.hashes.append(h)
        self.contents.append(content)
        self.best.append(rank)
        self.counts.append(count)
        self.size += len(content) + ENTRY_BYTES
        if 2 * len(self.hashes) > self._mask:
            self._grow()

    def _grow(self) -> None:
        self._mask = 2 * self._mask + 1
        self._slots = [-1] * (self._mask + 1)
        for entry, h in enumerate(self.hashes):
            at = h & self._mask
            while self._slots[at] >= 0:
                at = (at + 1) & self._mask
            self._slots[at] = entry

    def batch(self, least: int = 1) -> pa.RecordBatch:
        keep = [i for i, n in enumerate(self.counts) if n >= least]
        best = [self.best[i] for i in keep]
        return pa.RecordBatch.from_pydict({
            "h": pa.array([self.hashes[i] for i in keep], pa.int64()),
            "content": pa.array([self.contents[i] for i in keep], pa.binary()),
            "points": pa.array([-b[0] for b in best], pa.int64()),
            "id": pa.array([None if b[1] else b[2] for b in best], pa.int64()),
            "row": pa.array([b[3] for b in best], pa.int64()),
            "members": pa.array([self.counts[i] for i in keep], pa.int64()),
        })


_RECORD = "h long, content binary, points long, id long, row long, members long"


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds hash, digest and size of each text without its white space."""
    for batch in batches:
        digests, sizes = [], []
        for text in batch.column("text"):
            content = (text.as_py() or b"").translate(None, WHITE)
            digests.append(hashlib.sha256(content).digest())
            sizes.append(len(content))
        hashes = [int.from_bytes(d[:8], "big") >> 1 for d in digests]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(hashes, pa.int64()), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64())],
            names=[*batch.schema.names, "h", "sha", "size"])


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of one task, equal contents made one; the table is passed on whenever it is full."""
    table = ContentTable()
    for batch in batches:
        columns = [batch.column(c) for c in ("h", "text", "points", "id", "row")]
        for h, text, points, key, row in zip(*columns, strict=True):
            content = (text.as_py() or b"").translate(None, WHITE)
            key = key.as_py()
            table.add(h.as_py(), content, (-points.as_py(), key is None, key or 0, row.as_py()), 1)
            if table.size > BUCKET_BYTES:
                yield table.batch()
                table = ContentTable()
    yield table.batch()


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One table per bucket (records come sorted by bucket); contents met more than once come out."""
    table, current = ContentTable(), None
    names = ["h", "points", "id", "row", "members"]

    def out() -> pa.RecordBatch:
        done = table.batch(least=2)
        digests = [hashlib.sha256(c.as_py()).digest() for c in done.column("content")]
        return pa.RecordBatch.from_arrays(
            [pa.array(digests, pa.binary()), *(done.column(c) for c in names[2:])],
            names=["sha", "keep_id", "keep_row", "members"])

    for batch in batches:
        columns = [batch.column(c) for c in ("bucket", "h", "content", "points", "id", "row", "members")]
        for bucket, h, content, points, key, row, members in zip(*columns, strict=True):
            if (bucket := bucket.as_py()) != current:
                if current is not None:
                    yield out()
                table, current = ContentTable(), bucket
            key = key.as_py()
            table.add(h.as_py(), content.as_py(), (-points.as_py(), key is None, key or 0, row.as_py()), members.as_py())
    yield out()


def written(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Every row, written once: row (number), id, doc (its columns), points, h, sha, size, text."""
    whole = F.coalesce(col(text), F.lit(""))
    rows = numbered(docs.select(
        col(id).cast("long").alias("id"), F.struct(*[col(c) for c in docs.columns if c != text]).alias("doc"),
        F.length(whole).cast("long").alias("points"), col(text).isNull().alias("no_text"),
        whole.cast("binary").alias("text")), "row")
    added = [T.StructField("h", T.LongType()), T.StructField("sha", T.BinaryType()), T.StructField("size", T.LongType())]
    out = T.StructType([*rows.schema.fields, *added])
    return materialize(rows.mapInArrow(_signed, out), "dedup-rows")


def bucket_bits(rows: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Leading hash bits that name a bucket, so that the contents of each fit.

    Starts from the total size (and four buckets per shuffle partition), then
    splits every bucket again until none with two contents is too large.
    """
    contents = rows.groupBy("h").agg((F.max("size") + ENTRY_BYTES).alias("size"))
    total = contents.agg(F.sum("size")).first()[0] or 0
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = max(math.ceil(math.log2(max(1, total / bucket_bytes))), math.ceil(math.log2(4 * partitions)))
    while bits < _HASH_BITS:
        large = contents.groupBy(_bucket(bits).alias("bucket")).agg(
            F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).filter(
            (F.col("size") > bucket_bytes) & (F.col("n") > 1))
        if large.isEmpty():
            break
        bits += 2
    return min(bits, _HASH_BITS)


def _bucket(bits: int):
    return F.shiftright("h", _HASH_BITS - bits)


def groups(rows: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per content met more than once: sha, keep_id, keep_row, members."""
    bits = bucket_bits(rows, bucket_bytes)
    records = rows.select("h", "text", "points", "id", "row").mapInArrow(_combined, _RECORD)
    buckets = records.withColumn("bucket", _bucket(bits)).repartition("bucket").sortWithinPartitions("bucket")
    return buckets.mapInArrow(_tables, "sha binary, keep_id long, keep_row long, members long")


def exact_groups(docs: DataFrame, text: str = "text", id: str = "doc_id",
                 bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = written(docs.select(col(id), col(text)), text, id)
    found = rows.select("row", "id", "sha").join(groups(rows, bucket_bytes), "sha", "left")
    alone = F.col("keep_row").isNull()
    return found.select(
        F.col("id").alias("doc_id"),
        F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("members", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def _sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of each content and the size of its row: the content, the text it came from and the other columns."""
    for batch in batches:
        hashes, sizes = [], []
        for text, rest in zip(batch.column("text"), batch.column("rest"), strict=True):
            text = text.as_py()
            content = text.translate(None, WHITE)
            hashes.append(_hash(content))
            sizes.append(len(content) + len(text) + rest.as_py())
        yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(sizes, pa.int64())], names=["h", "size"])


def _hash(content: bytes) -> int:
    return int.from_bytes(hashlib.sha256(content).digest()[:8], "big") >> 1


class Best:
    """The best row of each content met, whole: the table ranks, the batches are kept until it is emptied."""

    def __init__(self) -> None:
        self._clear()

    def _clear(self) -> None:
        self.table, self._held, self._rows, self._bytes, self._least = ContentTable(), [], 0, 0, 0

    def add(self, batch: pa.RecordBatch) -> None:
        contents = [text.as_py().translate(None, WHITE) for text in batch.column("text")]
        if "h" not in batch.schema.names:
            batch = batch.append_column("h", pa.array([_hash(c) for c in contents], pa.int64()))
        columns = [batch.column(c) for c in ("h", "points", "id", "row")]
        for i, (content, h, points, key, row) in enumerate(zip(contents, *columns, strict=True)):
            key = key.as_py()
            self.table.add(h.as_py(), content, (-points.as_py(), key is None, key or 0, row.as_py(), self._rows + i), 1)
        self._held.append(batch)
        self._rows += batch.num_rows
        self._bytes += batch.nbytes

    @property
    def full(self) -> bool:
        """Whether contents, or rows that have not lost, are many."""
        return self.table.size > BUCKET_BYTES or 2 * self._least > BUCKET_BYTES

    def settle(self) -> None:
        """Lets go of rows that have lost, when those held are many, and twice what the last time left."""
        if self._bytes > max(BUCKET_BYTES, 2 * self._least):
            at = np.array([b[4] for b in self.table.best])
            self._held = self._kept()
            for i, entry in enumerate(np.argsort(at).tolist()):
                self.table.best[entry] = (*self.table.best[entry][:4], i)
            self._rows, self._bytes = len(at), sum(b.nbytes for b in self._held)
            self._least = self._bytes

    def _kept(self) -> list[pa.RecordBatch]:
        """The best rows in the order they came, taken from one batch after another."""
        rows, low = np.sort([b[4] for b in self.table.best]), 0
        kept, parts, size = [], [], 0
        for batch in self._held:
            first, last = np.searchsorted(rows, (low, low + batch.num_rows))
            if first < last:
                part = batch if last - first == batch.num_rows else batch.take(pa.array(rows[first:last] - low))
                if parts and size + part.nbytes > OUT_BYTES:
                    kept.append(_joined(parts))
                    parts, size = [], 0
                parts.append(part)
                size += part.nbytes
            low += batch.num_rows
        return kept + [_joined(parts)] if parts else kept

    def out(self) -> list[pa.RecordBatch]:
        kept = self._kept() if self._held else []
        self._clear()
        return kept


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _best_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one task, of equal contents the best; passed on whenever the table is full."""
    best = Best()
    for batch in batches:
        best.add(batch)
        best.settle()
        if best.full:
            yield from best.out()
    yield from best.out()


def _best_of_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One table per bucket (rows come sorted by bucket)."""
    best, current = Best(), None
    for batch in batches:
        buckets = batch.column("bucket").to_numpy()
        cuts = [0, *(np.flatnonzero(buckets[1:] != buckets[:-1]) + 1).tolist(), len(buckets)]
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            if high > low:
                if buckets[low] != current:
                    yield from best.out()
                    current = buckets[low]
                best.add(batch.slice(low, high - low))
                best.settle()
    yield from best.out()


def drop_exact_copies(docs: DataFrame, text: str = "text", id: str = "doc_id",
                      bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``docs`` without the rows whose content stays in another row; same columns.

    A first reading sizes the buckets by whole rows, as these are what a bucket's task holds (each content's hash
    and largest size are written). In the second the rows themselves go to their buckets, once, and the row that
    stays comes out whole.
    """
    whole = F.coalesce(col(text), F.lit(""))
    rows = numbered(docs.select(
        col(id).cast("long").alias("id"), F.struct(*[col(c) for c in docs.columns if c != text]).alias("doc"),
        F.length(whole).cast("long").alias("points"), col(text).isNull().alias("no_text"),
        whole.cast("binary").alias("text")), "row")
    rest = [F.coalesce(F.octet_length(F.col("doc")[c].cast("string")).cast("long"), F.lit(0)) for c in docs.columns if c != text]
    sized = rows.select("text", sum(rest, F.lit(0).cast("long")).alias("rest")).mapInArrow(_sized, "h long, size long")
    bits = bucket_bits(materialize(sized.groupBy("h").agg(F.max("size").alias("size")), "dedup-sizes"), bucket_bytes)
    hashed = T.StructType([*rows.schema.fields, T.StructField("h", T.LongType())])
    some = rows.mapInArrow(_best_of_task, hashed).withColumn("bucket", _bucket(bits))
    buckets = some.repartition("bucket").sortWithinPartitions("bucket")
    left = buckets.mapInArrow(_best_of_buckets, buckets.schema)
    shown = F.when(~F.col("no_text"), F.col("text").cast("string"))
    return left.select(*[shown.alias(c) if c == text else F.col("doc")[c].alias(c) for c in docs.columns])
