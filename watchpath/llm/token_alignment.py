"""Alignment of two tokenizers' tokens by their byte ranges, with corpus-wide link counts.

A text's tokens under A (a byte-level vocabulary) and B (a piece vocabulary) cover
the same bytes: a space and the text. Byte offsets where tokens of both end cut
them into groups; an A and a B token are linked when their ranges overlap.

1. Galloping intersection: of each text, the shorter list of token ends drives an
   exponential and then binary search into the longer (``gallop``; every 16th end
   first, the others from there). Common ends slice the groups, and differences of
   the ranks found are the ranges of overlapping tokens.
2. Texts are taken in chunks of ``CHUNK_BYTES`` (a longer text by itself). A chunk is
   one row of a written table: its texts' figures, its distinct links, and of each
   text the links it holds as places among these. A text's figures count as
   ``TEXT_BYTES`` more, so many short or empty texts make chunks too. Spark holds the
   rows of a Parquet row group at once, and those it sorts as they are; so places are
   packed, and a row group has ``ROW_GROUP_BYTES`` or one row, however many chunks a
   task makes.
3. Links are counted over the chunks' distinct links (one row per chunk and link),
   and each A token's highest count follows from these counts. Counts go back to
   the chunks that hold the link, and a chunk's texts sum them up.

So no text moves, and what moves has a row per chunk and distinct link, not per
token. The only broadcast is one row per A token.

Cases: a null or empty text, and one whose joined bytes under A or B differ from
a space and the text, has no tokens: zeros and an empty ``groups``. Repeated rows
and null ids are rows like any other. An empty table gives no rows. Other columns
are not carried.

A's tokens are made with the ``tiktoken`` library from A's vocabulary (its ids rise in
the order of its merges), which gives what the ``tokenizers`` library gives.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packing import _byte_letters
from .tables import col, materialize, run_path

#: Text bytes of a chunk, and of one tokenizer call (a longer text is one by itself).
CHUNK_BYTES = 8 << 20
CALL_BYTES = 1 << 18
#: What a text's figures take in its chunk's row.
TEXT_BYTES = 128
#: Encoded bytes of a row group of the chunk table (a longer row is one by itself).
ROW_GROUP_BYTES = 1 << 20
#: Distance of the ends that are searched first.
ANCHORS = 16
#: Fixed value: how byte-level vocabularies split a text before merging.
SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


class Bytes:
    """Byte strings by number, as one array and its bounds."""

    def __init__(self, items: list[bytes]) -> None:
        self.sizes = np.array([len(x) for x in items], np.int64)
        self._starts = np.append(0, np.cumsum(self.sizes))[:-1]
        self._data = np.frombuffer(b"".join(items) or b"\0", np.uint8)

    def joined(self, numbers: np.ndarray) -> np.ndarray:
        sizes = self.sizes[numbers]
        shift = self._starts[numbers] - (np.cumsum(sizes) - sizes)
        return self._data[np.arange(int(sizes.sum())) + np.repeat(shift, sizes)]


class ByteLevel:
    """Tokens of a byte-level vocabulary (a ``tokenizers`` file) of a space and a text."""

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        special = {x["content"] for x in told["added_tokens"]}
        letter = {c: b for b, c in _byte_letters().items()}
        ranks = {bytes(letter[c] for c in token): i for token, i in told["model"]["vocab"].items() if token not in special}
        self._encoding = tiktoken.Encoding("A", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        entries = [b""] * (max(told["model"]["vocab"].values()) + 1)
        for token, i in ranks.items():
            entries[i] = token
        self.entries = Bytes(entries)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self._encoding.encode_ordinary(" " + t) for t in texts]


class Pieces:
    """Tokens of a piece vocabulary (a ``sentencepiece`` file that adds a space) of a text."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self._model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        told = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.entries = Bytes([bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()
                              for i, piece in enumerate(told)])

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1)


@cache
def _tokens(a: str, b: str) -> tuple[ByteLevel, Pieces]:
    return ByteLevel(a), Pieces(b)


def _search(longer: np.ndarray, keys: np.ndarray, low: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """For each key the first place from ``low`` on (at most ``stop``) whose value is no smaller; values below ``low`` are."""
    low, high, step = low.copy(), low.copy(), 1
    going = np.arange(len(keys))
    while len(going):                                   # exponential: low <= answer, until high is at or behind it
        at = np.minimum(high[going], stop[going] - 1)
        before = (high[going] < stop[going]) & (longer[at] < keys[going])
        going = going[before]
        low[going] = high[going] + 1
        high[going] = np.minimum(low[going] + step, stop[going])
        step *= 2
    while len(going := np.flatnonzero(low < high)):     # binary
        middle = (low[going] + high[going]) // 2
        less = longer[middle] < keys[going]
        low[going[less]] = middle[less] + 1
        high[going[~less]] = middle[~less]
    return low


def gallop(longer: np.ndarray, keys: np.ndarray, low: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Ranks of rising ``keys`` in ``longer`` (places of the first value that is no smaller), each searched
    for between ``low`` and ``stop`` (one value per key, rising with the keys)."""
    first = np.arange(0, len(keys), ANCHORS)
    anchors = _search(longer, keys[first], low[first], stop[first])
    near = np.repeat(anchors, np.diff(np.append(first, len(keys))))
    return _search(longer, keys, np.minimum(np.maximum(near, low), stop), stop)


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (counts[0] numbers), then the same of starts[1], ..."""
    return np.arange(int(counts.sum())) + np.repeat(starts - (np.cumsum(counts) - counts), counts)


class Aligned:
    """Tokens of some texts: a and b (ids), rows (of a's and b's tokens), and what galloping finds of them."""

    def __init__(self, texts: int, a: np.ndarray, row_a: np.ndarray, end_a: np.ndarray,
                 b: np.ndarray, row_b: np.ndarray, end_b: np.ndarray) -> None:
        self.n_a, self.n_b = np.bincount(row_a, minlength=texts), np.bincount(row_b, minlength=texts)
        at_a, at_b = np.append(0, np.cumsum(self.n_a)), np.append(0, np.cumsum(self.n_b))
        cut_a, cut_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        linked: list[tuple[np.ndarray, np.ndarray]] = []
        a_drives = self.n_a <= self.n_b
        for drives, row, end, at, other_end, other_at, cut, other_cut in (
                (a_drives, row_a, end_a, at_a, end_b, at_b, cut_a, cut_b),
                (~a_drives, row_b, end_b, at_b, end_a, at_a, cut_b, cut_a)):
            own = np.flatnonzero(drives[row])
            r = row[own]
            rank = gallop(other_end, end[own], other_at[r], other_at[r + 1])      # of the text's last end: its last place
            common = other_end[np.minimum(rank, len(other_end) - 1)] == end[own] if len(own) else np.empty(0, bool)
            cut[own], other_cut[rank[common]] = common, True
            head = np.append(True, r[1:] != r[:-1]) if len(own) else np.empty(0, bool)
            before = np.where(head, other_at[r], np.roll(rank + common, 1))       # first one that ends behind the start
            counts = rank + 1 - before
            mine, others = np.repeat(own, counts), _spread(before, counts)
            linked.append((mine, others) if drives is a_drives else (others, mine))
        self.link_a, self.link_b = (np.concatenate(x) for x in zip(*linked, strict=True))
        self.link_row = row_a[self.link_a]
        self.n_links = np.bincount(self.link_row, minlength=texts)
        self.n_groups = np.bincount(row_a[cut_a], minlength=texts)
        self.group_a = np.cumsum(cut_a) - cut_a
        self.group_b = np.cumsum(cut_b) - cut_b
        self.cut_a, self.cut_b = cut_a, cut_b


_DIGITS = cache(lambda n: Bytes([b"%d" % i + mark for mark in (b",", b"|", b";") for i in range(n)]))


def _groups(found: Aligned, a: np.ndarray, b: np.ndarray, entries: int) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of each text."""
    order = np.empty(len(a) + len(b), np.int64)
    place_a = np.arange(len(a)) + np.searchsorted(found.group_b, found.group_a, "left")
    place_b = np.arange(len(b)) + np.searchsorted(found.group_a, found.group_b, "right")
    order[place_a] = a + entries * found.cut_a
    order[place_b] = b + 2 * entries * found.cut_b
    digits = _DIGITS(entries)
    data = digits.joined(order).tobytes()
    ends = np.append(0, np.cumsum(digits.sizes[order]))[np.append(0, np.cumsum(found.n_a + found.n_b))].tolist()
    return [data[x: y - 1] if y > x else b"" for x, y in zip(ends[:-1], ends[1:], strict=True)]


def _encoded(tokens: ByteLevel | Pieces, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, text numbers, and the bytes of all."""
    got = tokens.encode(texts)
    sizes = np.fromiter(map(len, got), np.int64, len(got))
    ids = np.fromiter(chain.from_iterable(got), np.int64, int(sizes.sum()))
    return ids, np.repeat(np.arange(len(texts)), sizes), tokens.entries.joined(ids)


class Chunk:
    """Figures of the texts of one chunk, gathered call by call."""

    def __init__(self, a: ByteLevel, b: Pieces) -> None:
        self._a, self._b = a, b
        self._entries = max(len(a.entries.sizes), len(b.entries.sizes))
        self._width = len(b.entries.sizes)
        self.size = 0
        self._keys: list[int | None] = []
        self._numbers: list[tuple[np.ndarray, ...]] = []
        self._digests: list[str] = []
        self._links: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, keys: list[int | None], texts: list[str]) -> None:
        a, row_a, bytes_a = _encoded(self._a, texts)
        b, row_b, bytes_b = _encoded(self._b, texts)
        want = [b" " + t.encode() if t else b"" for t in texts]
        size = np.array([len(w) for w in want], np.int64)
        wrong = np.zeros(len(texts), bool)
        for ids, row, joined, entries in ((a, row_a, bytes_a, self._a.entries), (b, row_b, bytes_b, self._b.entries)):
            got = np.bincount(row, entries.sizes[ids], len(texts)).astype(np.int64)
            wrong |= got != size
            if not (got == size).all() or joined.tobytes() != b"".join(want):
                at = np.append(0, np.cumsum(got))
                wrong |= [joined[at[i]: at[i + 1]].tobytes() != w for i, w in enumerate(want)]
        wrong |= size == 0
        keep_a, keep_b = ~wrong[row_a], ~wrong[row_b]
        a, row_a, b, row_b = a[keep_a], row_a[keep_a], b[keep_b], row_b[keep_b]
        # Both lists hold the same bytes of every text, so running ends are comparable over all texts.
        found = Aligned(len(texts), a, row_a, np.cumsum(self._a.entries.sizes[a]), b, row_b, np.cumsum(self._b.entries.sizes[b]))
        groups = _groups(found, a, b, self._entries)
        codes = a[found.link_a] * self._width + b[found.link_b]
        span = len(self._a.entries.sizes) * self._width
        codes, times = np.unique(found.link_row * span + codes, return_counts=True)
        self._links.append((np.bincount(codes // span, minlength=len(texts)), codes % span, times))
        self._numbers.append((found.n_a, found.n_b, found.n_groups, found.n_links))
        self._digests += [hashlib.sha256(g).hexdigest() if g else "" for g in groups]
        self._keys += keys
        self.size += int(size.sum()) + TEXT_BYTES * len(texts)

    def batch(self, number: int) -> pa.RecordBatch:
        held, codes, times = (np.concatenate(x) for x in zip(*self._links, strict=True))
        distinct, place, docs = np.unique(codes, return_inverse=True, return_counts=True)
        numbers = [np.concatenate(x) for x in zip(*self._numbers, strict=True)]
        # Places rise within a text, so their differences are small.
        first = np.append(0, np.cumsum(held))[:-1]
        gaps = np.diff(place, prepend=0)
        gaps[first[held > 0]] = place[first[held > 0]]
        one = lambda values, kind: pa.array([values], pa.list_(kind))
        packed = lambda values: pa.array([zlib.compress(values.astype(np.int32).tobytes(), 1)], pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), one(self._keys, pa.int64()), *[one(x, pa.int64()) for x in (*numbers, held)],
             one(self._digests, pa.string()), packed(gaps), packed(times), one(distinct, pa.int64()),
             one(docs, pa.int64())], names=_CHUNK_NAMES)


_CHUNK_NAMES = ["chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links", "held", "digest", "gaps", "times", "link", "docs"]
_CHUNK = ("chunk long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
          "held array<long>, digest array<string>, gaps binary, times binary, link array<long>, docs array<long>")


def _calls(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str], int]]:
    """Ids and texts of one tokenizer call, and their size."""
    keys, texts, held = [], [], 0
    for batch in batches:
        for key, text in zip(batch.column("id"), batch.column("text"), strict=True):
            text = text.as_py() or ""
            size = len(text) + TEXT_BYTES
            if texts and held + size > CALL_BYTES:
                yield keys, texts, held
                keys, texts, held = [], [], 0
            keys.append(key.as_py())
            texts.append(text)
            held += size
    if texts:
        yield keys, texts, held


def _chunks(path_a: str, path_b: str, chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _tokens(path_a, path_b)
        number = TaskContext.get().partitionId() << 33
        chunk = Chunk(a, b)
        for keys, texts, held in _calls(batches):
            if chunk.size and chunk.size + held > chunk_bytes:
                yield chunk.batch(number)
                number, chunk = number + 1, Chunk(a, b)
            chunk.add(keys, texts)
        if chunk._keys:
            yield chunk.batch(number)

    return run


def _summed(key: tuple, chunk: pa.Table, counts: pa.Table) -> pa.Table:
    """Figures of a chunk's texts, with the counts of its links."""
    packed = ("gaps", "times")
    values = {name: chunk.column(name).combine_chunks().values for name in chunk.column_names if name not in ("chunk", *packed)}
    gaps, times = (np.frombuffer(zlib.decompress(chunk.column(name)[0].as_py()), np.int32).astype(np.int64) for name in packed)
    held = values["held"].to_numpy()
    first = np.append(0, np.cumsum(held))
    place = np.cumsum(gaps)
    base = np.repeat(np.where(first[:-1] > 0, place[np.maximum(first[:-1] - 1, 0)], 0) if len(place) else first[:-1], held)
    place = place - base
    n, best = (np.zeros(len(values["link"]), np.int64) for _ in range(2))
    at = np.searchsorted(values["link"].to_numpy(), counts.column("link").to_numpy())
    n[at], best[at] = counts.column("n").to_numpy(), counts.column("best").to_numpy()

    def per_text(weights: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(weights))
        return total[first[1:]] - total[first[:-1]]

    return pa.table({**{k: values[k] for k in ("doc_id", "n_a", "n_b", "n_groups", "n_links")},
                     "n_best": per_text(times * best[place]), "count_sum": per_text(times * n[place]),
                     "groups_sha256": values["digest"]})


_OUT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def chunks(docs: DataFrame, a: str, b: str, text: str = "text", id: str = "doc_id", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The written table of chunks (see the module's text): one row per chunk."""
    rows = docs.select(col(id).cast("long").alias("id"), col(text).alias("text"))
    path = run_path(docs, "align-chunks")
    # Row groups are cut by size from the first row on, not from the hundredth.
    bounds = {"parquet.block.size": ROW_GROUP_BYTES, "parquet.page.size.row.check.min": 1}
    rows.mapInArrow(_chunks(a, b, chunk_bytes), _CHUNK).write.options(**bounds).parquet(path)
    return docs.sparkSession.read.parquet(path)


def link_counts(chunked: DataFrame, pieces: int) -> DataFrame:
    """link (A's id times ``pieces`` plus B's id), n (documents that hold it), best (1: none of A's id has more)."""
    links = chunked.select(F.explode(F.arrays_zip("link", "docs")).alias("x")).select("x.link", "x.docs")
    counts = links.groupBy("link").agg(F.sum("docs").alias("n")).withColumn("a", F.expr(f"link div {pieces}"))
    counts = materialize(counts, "align-counts")
    highest = counts.groupBy("a").agg(F.max("n").alias("most"))          # at most a row per entry of A's vocabulary
    return counts.join(F.broadcast(highest), "a").select("link", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))


def aligned(docs: DataFrame, a: str, b: str, text: str = "text", id: str = "doc_id",
            chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per row: doc_id, n_a, n_b (tokens), n_groups, n_links, n_best (links whose count is their A id's
    highest), count_sum (counts over links), groups_sha256. ``a`` and ``b`` are vocabulary files on every machine."""
    chunked = chunks(docs, a, b, text, id, chunk_bytes)
    counts = link_counts(chunked, len(_tokens(a, b)[1].entries.sizes))
    wanted = chunked.select(F.col("chunk").alias("at"), F.explode("link").alias("link")).join(counts, "link")
    return chunked.drop("docs").groupBy("chunk").cogroup(wanted.groupBy("at")).applyInArrow(_summed, _OUT)
