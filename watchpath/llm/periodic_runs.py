"""Periodic runs of words, exactly, and texts without the repetitions.

A run is a stretch of consecutive words with smallest period q and a length of
at least max(24, 3 q) that no neighbouring word extends keeping period q.

1. Candidates lie on a harmonic grid: for period q the positions x that are
   multiples of max(q, 8). A run is long enough to hold two grid points next to
   each other with their partners q words on, so only such positions are kept
   whose words equal their partners' (on word hashes: nothing is missed).
2. The words of the texts that have candidates are numbered exactly and
   compressed to a run-length grammar by recompression, forwards and backwards
   (``recompression``). Two grammar queries give a candidate's exact run;
   candidates that a found run covers are skipped.
3. Runs of one extent are one run; its least period stays.

The step is narrow: no shuffle. One batch of texts (one text, if it is longer) is in
memory at a time; a text of n words costs about n log n.

Cases: a null or empty text has no words, no run and an empty collapsed text.
Repeated rows and null ids are rows like any other. An empty table gives no rows.
Other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .recompression import Grammar
from .tables import col
from .textarrays import steps, word_hashes, word_spans

#: Least length of a run in words, and in periods.
LENGTH, PERIODS = 24, 3
#: Least distance of grid points: two of them and a period below it fit into LENGTH.
GRID = LENGTH // PERIODS
#: Words of texts compressed together (a longer text by itself), and candidates looked at together.
GROUP_WORDS = 1 << 18
BLOCK = 1 << 19
#: Texts of up to so many words take their grid from a table.
_TABLE_WORDS = 1 << 15


@cache
def _grid(words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Position, grid step, period and the last word needed, of all grid points of a text of ``words`` words, by the last."""
    periods = np.arange(1, words // PERIODS + 1)
    step = np.maximum(periods, GRID)
    counts = np.maximum(0, (words - periods - step + step - 1) // step)
    period, step = np.repeat(periods, counts), np.repeat(step, counts)
    x = (np.arange(len(period)) - np.repeat(np.cumsum(counts) - counts, counts)) * step
    last = x + step + period
    order = np.argsort(last, kind="stable")
    return tuple(v[order].astype(np.int32) for v in (x, step, period, last))


def _candidates(words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, periods) of grid points of one text that may lie in a run."""
    n = len(words)
    if n < LENGTH:
        return
    if n <= _TABLE_WORDS:
        x, step, period, last = _grid(1 << max(10, (n - 1).bit_length()))
        size = np.searchsorted(last, n)
        x, step, period = x[:size], step[:size], period[:size]
        at = np.flatnonzero(words[x] == words[x + period])
        at = at[period[at] <= n // PERIODS]
        x, step, period = x[at], step[at], period[at]
        at = words[x + step] == words[x + step + period]
        yield x[at].astype(np.int64), period[at].astype(np.int64)
        return
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for q in range(1, n // PERIODS + 1):
        step = max(q, GRID)
        same = words[: n - q: step] == words[q:: step]
        at = np.flatnonzero(same[:-1] & same[1:]) * step
        if len(at):
            held.append((at, np.full(len(at), q)))
            size += len(at)
        if size > BLOCK:
            yield tuple(map(np.concatenate, zip(*held, strict=True)))
            held, size = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


def _extents(words: np.ndarray, lows: np.ndarray, highs: np.ndarray, x: np.ndarray, period: np.ndarray,
             grammars: tuple[Grammar, Grammar]) -> np.ndarray:
    """(start, end, period) of the runs of the candidates; those of one text end at its ``lows`` and ``highs``."""
    order = np.lexsort((x, period))
    x, period, lows, highs = x[order], period[order], lows[order], highs[order]
    step = np.maximum(period, GRID)
    new = np.append(True, (period[1:] != period[:-1]) | (x[1:] - x[:-1] != step[1:]) | (lows[1:] != lows[:-1]))
    streak = np.cumsum(new) - 1
    forwards, backwards = grammars
    pending, found, reach = np.arange(len(x)), [], np.full(streak[-1] + 1 if len(x) else 0, -1)
    while len(pending):
        head = pending[np.append(True, streak[pending][1:] != streak[pending][:-1])]
        at, q = x[head], period[head]
        end = np.minimum(at + q + forwards.common(at, at + q), highs[head])
        last = len(words) - at
        start = np.maximum(at - backwards.common(last, last - q), lows[head])
        reach[streak[head]] = end
        long = end - start >= np.maximum(LENGTH, PERIODS * q)
        found.append(np.stack((start, end, q), axis=1)[long])
        pending = pending[np.append(True, streak[pending][1:] != streak[pending][:-1]) ^ True]
        pending = pending[x[pending] + period[pending] >= reach[streak[pending]]]
    return np.concatenate(found) if found else np.empty((0, 3), np.int64)


def runs_of(texts: list[np.ndarray], exact: list[np.ndarray] | None = None) -> list[np.ndarray]:
    """Of each text (an array of word numbers): its runs as rows (start, length, period) by start, then period.

    ``exact``: numbers to decide on, where ``texts`` are hashes that only rule out.
    """
    exact = texts if exact is None else exact
    whole = np.concatenate([*exact, np.empty(0, np.int64)])
    grammars = Grammar(whole), Grammar(whole[::-1])
    base, size, out = 0, 0, []
    blocks: list[tuple[np.ndarray, ...]] = []
    found: list[np.ndarray] = []

    def solve() -> None:
        if blocks:
            x, period, low, high = map(np.concatenate, zip(*blocks, strict=True))
            found.append(_extents(whole, low, high, x, period, grammars))
            blocks.clear()

    bases = []
    for words in texts:
        bases.append(base)
        for x, period in _candidates(words):
            blocks.append((x + base, period, np.full(len(x), base), np.full(len(x), base + len(words))))
            size += len(x)
            if size > BLOCK:
                solve()
                size = 0
        base += len(words)
    solve()
    runs = np.concatenate(found) if found else np.empty((0, 3), np.int64)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    if len(runs):
        runs = runs[np.append(True, (runs[1:, :2] != runs[:-1, :2]).any(axis=1))]       # the least period of an extent
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    for low, words in zip(bases, texts, strict=True):
        own = runs[np.searchsorted(runs[:, 0], low): np.searchsorted(runs[:, 0], low + len(words))]
        out.append(np.stack((own[:, 0] - low, own[:, 1] - own[:, 0], own[:, 2]), axis=1))
    return out


def _kept(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words stay: those in no run behind its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:-1]) == 0


def _joined(data: bytes, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """The words joined by a space."""
    return b" ".join([data[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)])


_OUT = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _batch(ids: pa.Array, texts: pa.Array) -> Iterator[pa.RecordBatch]:
    """Rows of one batch, a step of texts at a time."""
    for low, high, data, offsets in steps(texts, BLOCK * 2):
        starts, ends, row = word_spans(data, offsets)
        hashes = word_hashes(data, starts, ends).view(np.int64)
        at = np.searchsorted(row, np.arange(high - low + 1))
        raw = data.tobytes()
        runs: dict[int, np.ndarray] = {}
        group: list[tuple[int, np.ndarray, np.ndarray]] = []
        held = 0

        def solve() -> None:
            for (i, _, _), own in zip(group, runs_of([h for _, h, _ in group], [e for _, _, e in group]), strict=True):
                runs[i] = own
            group.clear()

        for i in range(high - low):
            own = hashes[at[i]: at[i + 1]]
            if any(len(x) for x, _ in _candidates(own)):
                known: dict[bytes, int] = {}
                spans = zip(starts[at[i]: at[i + 1]].tolist(), ends[at[i]: at[i + 1]].tolist(), strict=True)
                exact = np.fromiter((known.setdefault(raw[s:e], len(known)) for s, e in spans), np.int64, len(own))
                group.append((i, own, exact))
                held += len(own)
                if held > GROUP_WORDS:
                    solve()
                    held = 0
        if group:
            solve()
        none = np.empty((0, 3), np.int64)
        collapsed = []
        for i in range(high - low):
            s, e = starts[at[i]: at[i + 1]], ends[at[i]: at[i + 1]]
            if len(runs.get(i, none)):
                keep = _kept(len(s), runs[i])
                collapsed.append(_joined(raw, s[keep], e[keep]))
            elif offsets[i + 1] - offsets[i] > BLOCK:         # in parts, so that the words are no objects all at once
                parts = range(0, len(s), GROUP_WORDS)
                collapsed.append(b" ".join([b" ".join(raw[s[k]: e[min(k + GROUP_WORDS, len(s)) - 1]].split()) for k in parts]))
            else:
                collapsed.append(b" ".join(raw[offsets[i]: offsets[i + 1]].split()))
        every = [runs.get(i, none) for i in range(high - low)]
        flat = np.concatenate([*every, none])
        rows = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"])
        ranges = pa.array(np.cumsum([0, *map(len, every)]), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [ids.slice(low, high - low), pa.array(np.diff(at), pa.int64()), pa.ListArray.from_arrays(ranges, rows),
             pa.array(collapsed, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from _batch(batch.column("id"), batch.column("text"))


def periodic_runs(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """One row per row: doc_id, n_words, runs (start and length in words, period; by start, then period) and
    collapsed, the words that no run holds behind its first period, joined by one space."""
    whole = F.coalesce(col(text), F.lit("")).cast("binary")
    return docs.select(col(id).cast("long").alias("id"), whole.alias("text")).mapInArrow(_run, _OUT)
