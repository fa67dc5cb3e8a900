"""Token counts by a finite-state transducer compiled from a piece vocabulary.

The vocabulary merges the best-scored adjacent pair first. A sequence of pieces
is the encoding of a text exactly when every adjacent pair in it is the
encoding of its own joined text, so a text can be read left to right: at each
character the last piece of the prefix's encoding is the longest piece ending
there that is compatible with the last piece before it. That depends on a
bounded tail only, which makes it a deterministic transducer: a state holds the
tail that can still grow into a piece and, for each position in it, the last
piece and the count there; a transition is annotated with the tokens it adds.
States and transitions are compiled when first met and kept per worker.

A text is cut into chunks. A chunk's state map (state before -> state after,
tokens) is fixed behind its first space, since no piece continues over a space:
only the head depends on the state before it. A map is a row: the head, the
state that the characters in front of the chunk suggest, the head's tokens from
there, the tokens behind the head and the state at the end. Two maps compose
into one: where the first ends in the state that the second supposed, their
tokens add up, else the second's head is read again from the true state. So the
composition is exact and associative. The chunks of long texts are dealt over
all tasks, and their maps are composed in levels of ``FAN`` neighbours, the
block sums of a prefix scan, until one map a text is left; its first
supposition is the initial state, so its tokens are the text's. States go
between tasks by what they hold (tail, pieces and counts), not by a worker's
number. Only a text without spaces carries its characters through the levels.
Words behind a space start from one state, so their counts are memoised, in two
generations bound by bytes.

Characters outside the vocabulary count one token per UTF-8 byte. Spaces are
pieces' word marks, one more is put in front of a text, and control pieces are
never matched, as the sentencepiece library does by default.

Cases: a null or empty text has 0 tokens and 0 bytes. Repeated rows are counted
alike. An empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import col, materialize

LIMIT = 4096
#: Characters of a chunk; texts of more than ``LONG`` are dealt over tasks.
CHUNK, LONG = 1 << 16, 1 << 18
#: Maps composed into one by a task, and characters in front of a chunk that suggest its first state.
FAN, WARM = 64, 64
#: Bytes of a generation of memoised words (about), and characters of a word that is not memoised.
MEMO_BYTES, LONG_WORD = 32 << 20, 64
_ENTRY_BYTES = 120
#: Compiled states and tested pairs that a worker keeps.
MAX_STATES, MAX_TESTED = 300_000, 1_000_000
_MARK = "▁"
#: In a state: a position where no piece that may still grow begins.
_NONE = object()
#: The state in which nothing before matters.
INITIAL = ("", ((None, 0),))
_SEGMENTS = re.compile(" +[^ ]*")


class Transducer:
    """Counting transducer of a piece vocabulary ({piece: rank}, low ranks merge first)."""

    def __init__(self, ranks: dict[str, int]) -> None:
        self._ranks = ranks
        self._longest = max(map(len, ranks), default=1)
        self._growing = {p[:n] for p in ranks for n in range(1, len(p))}
        self._fits: dict[tuple[str, str], bool] = {}
        self._joins: dict[tuple[str, str], bool] = {}
        self._clear()

    def _clear(self) -> None:
        #: State number by (tail, last pieces and counts along it).
        self._numbers: dict[tuple, int] = {INITIAL: 0}
        self._states: list[tuple] = [INITIAL]
        self._next: list[dict[str, tuple[int, int]]] = [{}]

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text by merging pair after pair (defines the encoding)."""
        parts, ranks = list(text), self._ranks
        while True:
            best, at = len(ranks), -1
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1], best)
                if rank < best:
                    best, at = rank, i
            if at < 0:
                return parts
            parts[at: at + 2] = [parts[at] + parts[at + 1]]

    def _fit(self, before: str | None, piece: str) -> bool:
        key = (before or "", piece)
        found = self._fits.get(key)
        if found is None:
            pieces = [before, piece] if before else [piece]
            found = self._fits[key] = self.merged("".join(pieces)) == pieces
        return found

    def _may_join(self, before: str, char: str) -> bool:
        """Whether any piece could hold an end of ``before`` and go on with ``char``."""
        key = (before, char)
        found = self._joins.get(key)
        if found is None:
            ends = (before[i:] + char for i in range(len(before)))
            found = self._joins[key] = any(e in self._growing or e in self._ranks for e in ends)
        return found

    def _step(self, state: int, char: str) -> tuple[int, int]:
        """Compiles one transition."""
        tail, ends = self._states[state]
        if char not in self._ranks:
            return 0, len(char.encode("utf-8", "replace"))
        grown = tail + char
        if ends[-1][0] and not self._may_join(ends[-1][0], char):
            ends = (*ends[:-1], (None, ends[-1][1]))      # nothing continues over this boundary
        for at in range(len(tail) + 1):        # longest piece first
            before, count = ends[at]
            if before is not _NONE and grown[at:] in self._ranks and self._fit(before, grown[at:]):
                break
        here = count + 1
        added = here - ends[-1][1]
        kept = [(at, p, n) for at, (p, n) in enumerate(ends) if p is not _NONE and grown[at:] in self._growing]
        first = kept[0][0] if kept else len(grown)
        new = [(_NONE, 0)] * (len(grown) - first) + [(grown[at:], 0)]
        for position, p, n in kept:            # only where a longer piece may still begin
            new[position - first] = (p, n - here)
        tail, ends = grown[first:], tuple(new)
        return self.number((tail, ends)), added

    def run(self, state: int, text: str) -> tuple[int, int]:
        """(state after, tokens added) from a state over marks and characters."""
        table, total = self._next, 0
        for char in text:
            arc = table[state].get(char)
            if arc is None:
                arc = table[state][char] = self._step(state, char)
                if len(self._states) > MAX_STATES:       # inside a text, too: keep the state that is read on
                    here = self._states[arc[0]]
                    self._clear()
                    table, arc = self._next, (self.number(here), arc[1])
            state, added = arc
            total += added
        self._trim()
        return state, total

    def _trim(self) -> None:
        for tested in (self._fits, self._joins):
            if len(tested) > MAX_TESTED:
                tested.clear()

    def number(self, state: tuple) -> int:
        """The number of a state here (numbers change when the table is cleared)."""
        found = self._numbers.get(state)
        if found is None:
            found = self._numbers[state] = len(self._states)
            self._states.append(state)
            self._next.append({})
        return found

    def state(self, number: int) -> tuple:
        return self._states[number]

    def name(self, state: int) -> str:
        """A state's name, the same in every worker."""
        tail, ends = self._states[state]
        return json.dumps([tail, [None if p is _NONE else [p, n] for p, n in ends]], ensure_ascii=False)

    def named(self, name: str) -> int:
        """The number that a named state has here."""
        tail, ends = json.loads(name)
        return self.number((tail, tuple((_NONE, 0) if e is None else tuple(e) for e in ends)))


class Words:
    """Tokens of a word behind one space. The words last used stay in two generations of bounded bytes."""

    def __init__(self, machine: Transducer) -> None:
        self._machine, self._young, self._old, self._bytes = machine, {}, {}, 0

    def __getitem__(self, word: str) -> int:
        found = self._young.get(word)
        if found is not None:
            return found
        found = self._old.get(word)
        if found is None:
            found = self._machine.run(0, _MARK + word)[1]
            if len(word) > LONG_WORD:
                return found
        self._young[word] = found
        self._bytes += _ENTRY_BYTES + 4 * len(word)
        if self._bytes > MEMO_BYTES:
            self._young, self._old, self._bytes = {}, self._young, 0
        return found


class Map(NamedTuple):
    """A chunk's state map. From state s: tokens of ``head`` from s (``head_tokens`` if s is ``guess``) and
    ``fixed``; after it ``end``, whatever s is if ``ends`` (a space lies inside), else if s is ``guess``."""

    head: str
    guess: str
    head_tokens: int
    fixed: int
    end: str
    ends: bool


class Counter:
    """Counts tokens of whole texts."""

    def __init__(self, ranks: dict[str, int]) -> None:
        self.machine = Transducer(ranks)
        self._words = Words(self.machine)

    def _parts(self, chunk: str) -> tuple[str, int, int | None]:
        """(head, tokens behind it, state at the end or None where the head is all)."""
        run, words = self.machine.run, self._words
        cut = chunk.find(" ")
        if cut == 0:       # spaces may go on from the chunk before
            cut = chunk.find(" ", len(chunk) - len(chunk.lstrip(" ")))
        if cut < 0:
            return chunk.replace(" ", _MARK), 0, None
        head, rest = chunk[:cut].replace(" ", _MARK), chunk[cut:]
        if "  " in rest:
            *inner, tail = _SEGMENTS.findall(rest)
            fixed = sum(words[s[1:]] if s[1:2] != " " else run(0, s.replace(" ", _MARK))[1] for s in inner)
        else:
            _, *inner, tail = rest.split(" ")
            fixed, tail = sum(map(words.__getitem__, inner)), " " + tail
        end, last = run(0, tail.replace(" ", _MARK))
        return head, fixed + last, end

    def chunk_map(self, chunk: str, before: str = "") -> Map:
        """The map of a chunk (no mark in it); ``before``: characters in front of it, "" for the first."""
        guess = self.machine.name(self.machine.run(0, before.replace(" ", _MARK))[0])
        head, fixed, end = self._parts(chunk)
        end = None if end is None else self.machine.name(end)
        after, tokens = self.machine.run(self.machine.named(guess), head)
        return Map(head, guess, tokens, fixed, self.machine.name(after) if end is None else end, end is not None)

    def compose(self, first: Map, then: Map) -> Map:
        """The map of two neighbouring stretches."""
        tokens, end = then.head_tokens, then.end
        if first.end != then.guess:            # supposed wrongly: read the head again
            after, tokens = self.machine.run(self.machine.named(first.end), then.head)
            end = then.end if then.ends else self.machine.name(after)
        if first.ends:
            return first._replace(fixed=first.fixed + tokens + then.fixed, end=end)
        return Map(first.head + then.head, first.guess, first.head_tokens + tokens, then.fixed, end, then.ends)

    def count(self, text: str, chunk: int = CHUNK) -> int:
        """Tokens of a text, read by one task."""
        machine, state, total = self.machine, INITIAL, 0
        for _, _, part in chunks(text, chunk):
            head, fixed, end = self._parts(part)
            end = None if end is None else machine.state(end)
            after, added = machine.run(machine.number(state), head)
            state, total = machine.state(after) if end is None else end, total + added + fixed
        return total


def chunks(text: str, chunk: int = CHUNK) -> Iterator[tuple[int, str, str]]:
    """(number, characters in front, chunk) of a text with its space in front."""
    if not text:
        return
    text = " " + text.replace(_MARK, " ")
    for i, at in enumerate(range(0, len(text), chunk)):
        yield i, text[max(0, at - WARM): at], text[at: at + chunk]


@cache
def counter(model: str) -> Counter:
    """The counter of a sentencepiece model file (normal pieces, best score first)."""
    import sentencepiece

    vocab = sentencepiece.SentencePieceProcessor(model_file=model)
    normal = [i for i in range(vocab.get_piece_size())
              if not (vocab.is_control(i) or vocab.is_unknown(i) or vocab.is_byte(i) or vocab.is_unused(i))]
    normal.sort(key=lambda i: -vocab.get_score(i))
    return Counter({vocab.id_to_piece(i): rank for rank, i in enumerate(normal)})


_DOC = "row long, doc_id long, n_bytes long"
_MAPS = f"{_DOC}, level long, head string, guess string, head_tokens long, fixed long, end string, ends boolean"


def _counted(model: str, long: int, chunk: int):
    """Counts of texts of at most ``long`` characters (``part`` null), chunks of the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(model)
        for batch in batches:
            known = [batch.column(c).to_pylist() for c in ("row", "doc_id", "n_bytes")]
            counted = []
            for i, doc in enumerate(zip(*known, strict=True)):
                text = batch.column("text")[i].as_py() or ""
                if len(text) <= long:
                    counted.append((*doc, tokens.count(text), None, None, None))
                    continue
                for part, before, some in chunks(text, chunk):
                    yield _table([(*doc, None, part, before, some)], _FIRST)
            if counted:
                yield _table(counted, _FIRST)

    return run


_FIRST = pa.schema([(c, pa.int64()) for c in ("row", "doc_id", "n_bytes", "n_tokens", "part")]
                   + [(c, pa.string()) for c in ("before", "chunk")])
_LEVEL = pa.schema([(c, pa.int64()) for c in ("row", "doc_id", "n_bytes", "level")]
                   + [("head", pa.string()), ("guess", pa.string()), ("head_tokens", pa.int64()), ("fixed", pa.int64()),
                      ("end", pa.string()), ("ends", pa.bool_())])


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)],
                                      schema=schema)


def _mapped(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(model)
        for batch in batches:
            for i in range(batch.num_rows):
                row = [batch.column(c)[i].as_py() for c in ("row", "doc_id", "n_bytes", "part")]
                found = tokens.chunk_map(batch.column("chunk")[i].as_py(), batch.column("before")[i].as_py())
                yield _table([(*row, *found)], _LEVEL)

    return run


def _composed(model: str, fan: int):
    """Up to ``fan`` neighbouring maps of a text as one."""

    def run(table: pa.Table) -> pa.Table:
        tokens = counter(model)
        rows = sorted(table.to_pylist(), key=lambda r: r["level"])
        found = None
        for row in rows:
            here = Map(*(row[c] for c in Map._fields))
            found = here if found is None else tokens.compose(found, here)
        first = rows[0]
        return pa.Table.from_batches([_table(
            [(first["row"], first["doc_id"], first["n_bytes"], first["level"] // fan, *found)], _LEVEL)])

    return run


def token_counts(docs: DataFrame, model: str, text: str = "text", id: str = "doc_id", limit: int = LIMIT,
                 long: int = LONG, chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit; ``model``: a vocabulary file on every machine.
    Texts of more than ``long`` characters are counted in chunks, by many tasks."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), col(id).cast("long").alias("doc_id"),
                       F.octet_length(F.coalesce(col(text), F.lit(""))).cast("long").alias("n_bytes"),
                       col(text).alias("text"))
    first = materialize(rows.mapInArrow(_counted(model, long, chunk),
                                        f"{_DOC}, n_tokens long, part long, before string, chunk string"), "token-chunks")
    whole = first.filter("part is null").select("doc_id", "n_bytes", "n_tokens")
    parts = first.filter("part is not null")
    last = parts.agg(F.max("part")).first()[0]
    if last is not None:
        n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        maps = parts.repartition(n, "row", "part").mapInArrow(_mapped(model), _MAPS)
        while last > 0:                        # a level: ``fan`` neighbours become one
            maps = maps.groupBy("row", F.floor(F.col("level") / fan)).applyInArrow(_composed(model, fan), _MAPS)
            last //= fan
        whole = whole.unionByName(maps.select("doc_id", "n_bytes", (F.col("head_tokens") + F.col("fixed")).alias("n_tokens")))
    return whole.withColumn("over_limit", F.col("n_tokens") > limit)
