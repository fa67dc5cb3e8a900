"""Language identification by compression.

For each language one raw-content Zstandard dictionary is filled with its
training text. A text is cut into chunks, every chunk is compressed with every
dictionary, and the language with the smallest total wins: its dictionary held
the most of what the text repeats. The score is the winner's share of a softmax
over compressed bits per byte; where it is below ``MARGIN`` the answer is marked
as rejected.

Dictionaries are bounded: per language ``DICT_BYTES`` from pieces spread over
the whole of at most ``TRAIN_ROWS`` training texts, taken in hash order. Each
gives as much as the others, or all it has, until the dictionary is full or all
are used up. Every whole text is classified.

Cases: a null text, or one without a letter, is ``und`` with score 0. Equal
totals go to the first language by code point. Rows without an id or language
are not learned from; with no training rows every text is ``und``. Repeated
rows get equal answers. An empty table gives an empty result; other columns do
not matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import col, materialize

DICT_BYTES = 160 << 10
TRAIN_ROWS = 700
#: Bytes of normalised text compressed at once; short enough that the dictionary counts in every chunk.
CHUNK = 1 << 10
#: Characters of a training text's piece.
PIECE = 256
MARGIN = 0.55
LEVEL = 6

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def normal(text: str) -> bytes:
    """Lower-case letters, everything else as single spaces."""
    return _NOT_LETTERS.sub(" ", text.lower()).strip().encode("utf-8", "replace")


def _room(lengths: list[int], wanted: int) -> int:
    """The characters that each text may give so that all together give ``wanted``, or the longest text's."""
    for i, n in enumerate(sorted(lengths)):
        each = -(-wanted // (len(lengths) - i))
        if n >= each:
            return each
        wanted -= n
    return max(lengths)


def _spread(text: Column, room: Column) -> Column:
    """About ``room`` characters in pieces evenly spread over a text; all of a text that is no longer."""
    n, pieces = F.length(text), F.ceil(room / PIECE)
    size = F.ceil(room / pieces).cast("int")
    parts = F.transform(F.sequence(F.lit(0).cast("long"), pieces - 1), lambda j: F.substring(
        text, (F.floor((2 * j + 1) * n / (2 * pieces)) - F.floor(size / 2) + 1).cast("int"), size))
    return F.when(n <= room, text).otherwise(F.array_join(parts, " "))


def dictionaries(train: DataFrame, text: str = "text", id: str = "doc_id", lang: str = "lang",
                 dict_bytes: int = DICT_BYTES, rows: int = TRAIN_ROWS) -> dict[str, bytes]:
    """Dictionary content per language, from at most ``rows`` texts each in hash order."""
    known = train.filter(col(id).isNotNull() & col(lang).isNotNull() & col(text).isNotNull()).select(
        col(id).cast("string").alias("id"), col(lang).alias("lang"), col(text).alias("text"))
    counts = {r.lang: r.n for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = 1 << 40
    u = F.pmod(F.xxhash64(F.lit("dictionary"), "id"), F.lit(parts))
    share = F.lit(-1)
    for name, n in counts.items():            # some more than asked for, cut below
        share = F.when(F.col("lang") == name, int(parts * min(1.0, 1.5 * rows / n))).otherwise(share)
    near = materialize(known.withColumns({"u": u, "h": F.xxhash64("text")}).filter(F.col("u") < share), "language-sample")
    sampled: dict[str, list] = {}
    for r in near.select("lang", "u", "h", F.length("text").alias("n")).collect():
        sampled.setdefault(r.lang, []).append((r.u, r.h, r.n))
    sampled = {name: sorted(found)[:rows] for name, found in sampled.items()}
    longest = {name: max(n for *_, n in found) for name, found in sampled.items()}
    room = {name: _room([n for *_, n in found], dict_bytes) for name, found in sampled.items()}
    out: dict[str, bytes] = {}
    while any(room.values()):
        ask = near.sparkSession.createDataFrame([(name, sampled[name][-1][:2], n) for name, n in room.items() if n],
                                                "lang string, last struct<u: long, h: long>, room long")
        picked = near.join(F.broadcast(ask), "lang").filter(F.struct("u", "h") <= F.col("last")).select(
            "lang", "u", "h", _spread(F.col("text"), F.col("room")).alias("text")).collect()
        texts: dict[str, list] = {}
        for r in sorted(picked, key=lambda r: (r.lang, r.u, r.h)):
            texts.setdefault(r.lang, []).append(normal(r.text))
        for name, parts in texts.items():
            parts = parts[:rows]
            size = sum(map(len, parts)) + len(parts) - 1
            if size < dict_bytes and room[name] < longest[name]:        # characters that are no letters left room
                room[name] = min(longest[name], 1 + int(room[name] * min(4.0, 1.05 * dict_bytes / max(1, size))))
                continue
            if size > dict_bytes:
                parts = [part[: -(-len(part) * dict_bytes // size)] for part in parts]
            room[name], content = 0, b" ".join(parts)
            if content.strip():
                out[name] = content[:dict_bytes]
    return dict(sorted(out.items()))


@cache
def _compressors(contents: tuple[bytes, ...]):
    import zstandard as zstd

    made = []
    for content in contents:
        raw = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
        raw.precompute_compress(level=LEVEL)
        made.append(zstd.ZstdCompressor(level=LEVEL, dict_data=raw, write_content_size=False, write_dict_id=False))
    return made


def sizes(text: str, contents: tuple[bytes, ...]) -> tuple[np.ndarray, int]:
    """Compressed bytes of the whole text per dictionary, and its normalised length."""
    data = normal(text)
    total = np.zeros(len(contents))
    for at in range(0, len(data), CHUNK):
        chunk = data[at: at + CHUNK]
        total += [len(c.compress(chunk)) for c in _compressors(contents)]
    return total, len(data)


def _answers(names: list[str], contents: tuple[bytes, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], []
            for text in batch.column("text"):
                text = text.as_py() or ""
                if not names or not any(map(str.isalpha, text)):
                    langs.append("und")
                    scores.append(0.0)
                    continue
                total, n = sizes(text, contents)
                best = int(np.argmin(total))
                bits = 8 * (total - total[best]) / np.sqrt(n)
                langs.append(names[best])
                scores.append(float(1 / np.exp(-bits).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"])

    return run


def identified(docs: DataFrame, contents: dict[str, bytes], text: str = "text", id: str = "doc_id",
               margin: float = MARGIN) -> DataFrame:
    """doc_id, lang_pred, score, rejected (the margin is narrow) for every row."""
    names = sorted(contents)
    run = _answers(names, tuple(contents[n] for n in names))
    found = docs.select(col(id).cast("long").alias("doc_id"), col(text).alias("text")).mapInArrow(
        run, "doc_id long, lang_pred string, score double")
    return found.withColumn("rejected", F.col("score") < margin)
