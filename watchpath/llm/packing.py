"""Packing by power-of-two decomposition.

A document's token ids (and an end id) are cut into pieces whose lengths are
powers of two, at most the sequence length: whole sequences first, then the
binary digits of the rest, largest first. Each piece is one sequence of its
own, so no sequence crosses documents and none needs padding. Pieces of equal
length form a bucket; ``sequence_id`` ranges do not overlap between buckets, so
sorting or partitioning by it keeps equal lengths together for batching.

The step is narrow: no shuffle, one document at a time in memory.

Cases: a null or empty text still has its end id, so it is one piece of length
1. Repeated rows are packed as often as they occur, with sequences of their
own. An empty table gives no pieces. Other columns are not carried.

Tokens are those of the ``tokenizers`` library. The vocabulary's pre-tokenizer
never joins text across white space, so ids are memoised per lower-cased word;
texts with characters beyond Latin, control characters or a special token's
mark are handed to the library whole.
"""

from __future__ import annotations

import array
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import col

SEQUENCE = 2048
#: Bytes of a generation of a Python worker's memo (words, ids and the table's own), and of its longest word.
MEMO_BYTES = 40 << 20
MEMO_WORD = 100
#: Token bytes put into one Arrow batch.
_BATCH_BYTES = 2 << 20

#: Bits of a sequence id below its bucket: partition (20) and position in it (33).
_BUCKET_SHIFT = 53
_MAX_PARTITIONS = 1 << 20

_UNUSUAL = regex.compile(r"[^\t\n\x0b\x0c\r\x20-\x7e -įı-ɏ]")
_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


_USUAL_BYTES = bytes(b for b in range(256) if not _UNUSUAL.match(chr(b)))


def _unusual(text: str) -> bool:
    """Whether a text has a character that the memo's word splitting doesn't cover."""
    try:
        return bool(text.encode("latin-1").translate(None, _USUAL_BYTES))
    except UnicodeEncodeError:
        return bool(_UNUSUAL.search(text))


@cache
def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable
    Latin-1 characters stand for themselves, the others take letters from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordTokens:
    """Token ids of texts as packed little-endian unsigned 32-bit integers."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        self._model = self._whole.model
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._size = 0

    def ids(self, text: str) -> bytes:
        if "<|" in text or _unusual(text):
            return array.array("I", self._whole.encode(text, add_special_tokens=False).ids).tobytes()
        out = []
        for word in text.lower().split():
            found = self._young.get(word)
            if found is None:
                found = self._old.get(word)
                if found is None:
                    found = self._word(word)
                self._keep(word, found)
            out.append(found)
        return b"".join(out)

    def _keep(self, word: str, ids: bytes) -> None:
        """Remembers a word; when the young generation is full, the old one goes."""
        if len(word) > MEMO_WORD:
            return
        self._young[word] = ids
        self._size += len(word) + len(ids) + 180
        if self._size > MEMO_BYTES:
            self._young, self._old, self._size = {}, self._young, 0

    def _word(self, word: str) -> bytes:
        letters = _byte_letters()
        ids = array.array("I")
        for part in _PARTS.findall(word):
            if not part.isascii():
                part = "".join(letters[b] for b in part.encode())
            ids.extend(token.id for token in self._model.tokenize(part))
        return ids.tobytes()


@cache
def _tokens(path: str) -> WordTokens:
    return WordTokens(path)


def lengths(n: int, longest: int = SEQUENCE) -> list[int]:
    """Powers of two that add up to ``n``, none above ``longest`` (itself one), falling."""
    out = [longest] * (n // longest)
    rest = n % longest
    for bit in reversed(range(rest.bit_length())):
        if rest >> bit & 1:
            out.append(1 << bit)
    return out


_PIECE = "doc_id long, start long, length long, doc_tokens long, tokens binary"


def _cut(path: str, end_id: int, longest: int):
    end = array.array("I", [end_id]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(path)
        rows: list[tuple] = []
        held = 0

        def out() -> pa.RecordBatch:
            keys, starts, sizes, totals, pieces = zip(*rows, strict=True) if rows else ((),) * 5
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            arrays = [pa.array(v, t) for v, t in zip((keys, starts, sizes, totals, pieces), types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "length", "doc_tokens", "tokens"])

        for batch in batches:
            for key, text in zip(batch.column("id"), batch.column("text"), strict=True):
                ids = tokens.ids(text.as_py() or "") + end
                key, total, start = key.as_py(), len(ids) // 4, 0
                for n in lengths(total, longest):
                    rows.append((key, start, n, total, ids[4 * start: 4 * (start + n)]))
                    start += n
                held += len(ids)
                if held > _BATCH_BYTES:
                    yield out()
                    rows, held = [], 0
        yield out()

    return run


def pieces(docs: DataFrame, tokenizer: str, text: str = "text", id: str = "doc_id",
           end_id: int = 1, longest: int = SEQUENCE) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, tokens (packed ids),
    sequence_id, offset. ``tokenizer`` is the vocabulary file, on every machine."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the sequence length must be a power of two")
    cut = docs.select(col(id).cast("long").alias("id"), col(text).alias("text")).mapInArrow(
        _cut(tokenizer, end_id, longest), _PIECE)
    within = F.monotonically_increasing_id()        # partition << 33 | position
    bucket = F.round(F.log2("length")).cast("long")
    few = F.assert_true(F.spark_partition_id() < _MAX_PARTITIONS, "too many partitions for sequence ids")
    return cut.select("*", F.coalesce(few.cast("long"), F.shiftleft(bucket, _BUCKET_SHIFT) + within).alias("sequence_id"),
                      F.lit(0).cast("long").alias("offset"))


def write_buckets(packed: DataFrame, path: str) -> None:
    """Sequences as Parquet, one folder per length."""
    packed.select("sequence_id", "doc_id", "start", "tokens", "length").write.partitionBy("length").parquet(path)
