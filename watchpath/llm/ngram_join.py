"""N-gram Jaccard join as a blocked sparse matrix product.

Documents are rows and word n-grams columns of a 0/1 matrix A; A times its
transpose holds every pair's overlap. The product is taken by column blocks on
the part of A that can still decide a pair:

1. ``signatures``: each document's set size and a 64-bit name of its set. Equal
   sets are one class (one row of the matrix), so copies cost nothing further.
2. ``hot_grams``: n-grams of many classes, counted over all documents. They come
   last in the global order of n-grams (by heat, then hash).
3. A class keeps the first ``n - ceil(t n) + 1`` n-grams in that order: two sets
   of similarity t share one of them. These entries are spread over column
   blocks; every block multiplies its columns, adds up overlap counts per pair
   and drops pairs by size. Counts of all blocks are added, and pairs are
   discarded whose count plus what their remaining n-grams could add stays
   below the overlap that their sizes ask for.
4. Columns shared by many classes are not multiplied out: their members are
   compared with one pivot per size band (the one with the most hot n-grams, so
   the least edited copy), and after that only members outside the column's
   main component are paired with the others. Where two classes meet in a hot
   column, all their cold n-grams are in their prefixes; if they shared one,
   step 3 has the pair. Else all cold n-grams of both count as differences, and
   few are left for the hot ones. If these differ in at most k, and all hot
   n-grams are dealt over m > k parts, m - k parts are the same in both: so one of
   the k + 1 parts that fewest classes have. Only classes that agree in such a rare part are
   paired (``agreeing``), where sizes and 256 parities leave a link possible.
5. Surviving pairs pass a sieve: a parity bitmap of each set (about n/4 bytes)
   gives a lower bound of how many n-grams two sets differ in, so an upper
   bound of their overlap. What is left is checked on the full sets, best pair
   of each class first, the others only where both sides are still in different
   components: a pair inside one component cannot change it.

Hashes of n-grams are 64 bits wide. All threshold tests use integers.

Cases: a null text, or one without words, has an empty set and links with
nothing. With fewer than ``n`` words the whole sequence is the one n-gram.
Repeated rows are copies. Null ids come last in choosing a component's id. An
empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import connected_components
from .tables import col, free_name, materialize, numbered
from .textarrays import LOWER, mix, steps, word_hashes, word_spans

WORDS = 5
#: Similarity as a fraction: intersection * DEN >= NUM * union.
NUM, DEN = 80, 100
#: Classes that hold a column before it is compared by pivots instead of pair by pair.
WIDE = 24
#: Classes from which on an n-gram counts as hot; raised until the hot n-grams fit a broadcast.
HOT, MAX_HOT = 48, 1_000_000
#: Entries per column block, and n-grams, entries and pairs that a task holds before a flush.
BLOCK = 300_000
_FLUSH, _FLUSH_ENTRIES, _FLUSH_PAIRS = 1_000_000, 400_000, 200_000


@cache
def _weights(words: int) -> np.ndarray:
    return mix(np.arange(11, 11 + words, dtype=np.uint64)) | np.uint64(1)


def gram_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each row, A-Z lower-cased."""
    data = LOWER[data]
    starts, ends, row = word_spans(data, offsets)
    hashes = word_hashes(data, starts, ends)
    weights = _weights(words)
    bounds = np.searchsorted(row, np.arange(len(offsets)))
    if len(hashes) >= words:
        n = len(hashes) - words + 1
        grams = np.zeros(n, np.uint64)
        for k in range(words):
            grams += hashes[k: k + n] * weights[k]
        grams = mix(grams)
    else:
        grams = np.empty(0, np.uint64)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= words:
            out.append(np.unique(grams[a: b - words + 1]))
        elif b > a:
            short = (hashes[a:b] * weights[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(mix(np.array([short], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def set_name(grams: np.ndarray) -> int:
    """A 64-bit name of a set (signed), from its elements and size."""
    total = mix(grams ^ np.uint64(0x5DEECE66D)).sum(dtype=np.uint64) + np.uint64(len(grams))
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


def parities(grams: np.ndarray) -> bytes:
    """A bitmap of twice the set's size or more (a power of two): whether each bit was hit an odd number of times."""
    bits = 1 << max(6, (2 * len(grams) - 1).bit_length())
    hits = np.bincount((grams & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits(hits & 1, bitorder="little").tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """At least so many n-grams are in one of two sets only: each flips one bit of one bitmap."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2:]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def prefix(n: int) -> int:
    """First n-grams of a set of size n of which linked sets share one."""
    return n - math.ceil(NUM * n / DEN) + 1


def _sets(batch: pa.RecordBatch, words: int) -> Iterator[tuple[int, np.ndarray]]:
    for first, _, data, offsets in steps(batch.column("text")):
        for i, grams in enumerate(gram_sets(data, offsets, words)):
            yield first + i, grams


def _signed(words: int):
    """Rows with set size, name and bitmap (kind 0), and n-grams met in several classes of a task (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[np.ndarray] = []
        count = 0

        def common() -> pa.RecordBatch:
            grams, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.empty(0, np.uint64),) * 2
            twice = n > 1
            k = int(twice.sum())
            return pa.RecordBatch.from_pydict({
                "kind": pa.array(np.ones(k, np.int32)), "row": pa.nulls(k, pa.int64()), "doc_id": pa.nulls(k, pa.int64()),
                "name": pa.array(grams[twice].view(np.int64)), "n": pa.array(n[twice].astype(np.int64)),
                "bits": pa.nulls(k, pa.binary())})

        for batch in batches:
            sizes, labels, maps = np.zeros(batch.num_rows, np.int64), [None] * batch.num_rows, [None] * batch.num_rows
            for i, grams in _sets(batch, words):
                if not len(grams):
                    continue
                sizes[i], labels[i], maps[i] = len(grams), set_name(grams), parities(grams)
                if labels[i] not in seen:
                    seen.add(labels[i])
                    held.append(grams)
                    count += len(grams)
                    if count > _FLUSH:
                        yield common()
                        seen, held, count = set(), [], 0
            yield pa.RecordBatch.from_pydict({
                "kind": pa.array(np.zeros(batch.num_rows, np.int32)), "row": batch.column("row"),
                "doc_id": batch.column("doc_id"), "name": pa.array(labels, pa.int64()), "n": pa.array(sizes),
                "bits": pa.array(maps, pa.binary())})
        yield common()

    return run


def is_hot(grams: np.ndarray, heat: np.ndarray) -> np.ndarray:
    """Which n-grams are among ``heat`` (sorted)."""
    if not len(heat):
        return np.zeros(len(grams), bool)
    return heat[np.minimum(np.searchsorted(heat, grams), len(heat) - 1)] == grams


_ENTRY = np.dtype([("gram", "<u8"), ("owner", "<u4"), ("rank", "<u4")])


def _entries(words: int, blocks: int, hot):
    """Prefix entries of a task's classes by column block; those in hot columns in blocks from ``blocks`` on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heat = hot.value
        classes: list[tuple[int, int, int]] = []      # name, size, hot n-grams
        seen: set[int] = set()
        parts: list[np.ndarray] = []
        count = 0

        def out() -> Iterator[pa.RecordBatch]:
            entries = np.concatenate(parts) if parts else np.empty(0, _ENTRY)
            known = np.array(classes, np.int64).reshape(-1, 3)
            block = (entries["gram"] % np.uint64(blocks)).astype(np.int64)
            wide = is_hot(entries["gram"], heat)       # dealt by class, so that a hot column is spread
            block[wide] = blocks + known[entries["owner"][wide], 0] % blocks
            order = np.argsort(block, kind="stable")
            entries, block = entries[order], block[order]
            bounds = np.searchsorted(block, np.arange(2 * blocks + 1))
            rows = []
            for b in np.flatnonzero(np.diff(bounds)):
                some = entries[bounds[b]: bounds[b + 1]].copy()
                owners, some["owner"] = np.unique(some["owner"], return_inverse=True)
                rows.append((int(b), some.tobytes(), known[owners].tobytes()))
            for at in range(0, len(rows), 200):
                some = rows[at: at + 200]
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([r[0] for r in some], pa.int32()),
                    "entries": pa.array([r[1] for r in some], pa.binary()),
                    "classes": pa.array([r[2] for r in some], pa.binary())})

        for batch in batches:
            for _, grams in _sets(batch, words):
                if not len(grams) or (label := set_name(grams)) in seen:
                    continue
                seen.add(label)
                warm = is_hot(grams, heat)
                keep = prefix(len(grams))
                ordered = grams[~warm][:keep]
                if len(ordered) < keep:
                    ordered = np.concatenate([ordered, grams[warm][: keep - len(ordered)]])
                part = np.empty(keep, _ENTRY)
                part["gram"], part["owner"], part["rank"] = ordered, len(classes), np.arange(keep)
                classes.append((label, len(grams), int(warm.sum())))
                parts.append(part)
                count += keep
                if count > _FLUSH_ENTRIES:
                    yield from out()
                    classes, seen, parts, count = [], set(), [], 0
        yield from out()

    return run


_ENTRY_ROWS = "block int, entries binary, classes binary"
_PAIR = "a long, b long, na long, nb long, shared long, rank_a long, rank_b long, gram long"


def _added(parts: list[np.ndarray]) -> np.ndarray:
    """Pair rows (a, b, na, nb, shared, rank_a, rank_b) with equal pairs added up."""
    rows = np.concatenate(parts) if parts else np.empty((0, 7), np.int64)
    if not len(rows):
        return rows
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    first = np.flatnonzero(np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(1)])
    out = rows[first].copy()
    out[:, 4] = np.add.reduceat(rows[:, 4], first)
    out[:, 5] = np.maximum.reduceat(rows[:, 5], first)
    out[:, 6] = np.maximum.reduceat(rows[:, 6], first)
    return out


def _multiplied(blocks: int):
    """One column block: overlap counts of the pairs of its columns; members of wide columns (all of a
    hot block's) as rows without ``b`` (a: class, gram: column, shared: hot n-grams, rank_b: 1 if hot)."""

    def run(table: pa.Table) -> pa.Table:
        return _product(table, table.column("block")[0].as_py() >= blocks)

    return run


def _product(table: pa.Table, hot: bool) -> pa.Table:
    grams, names, sizes, heats, ranks = [], [], [], [], []
    for entries, classes in zip(table.column("entries"), table.column("classes"), strict=True):
        some = np.frombuffer(entries.as_py(), _ENTRY)
        known = np.frombuffer(classes.as_py(), np.int64).reshape(-1, 3)[some["owner"]]
        grams.append(some["gram"])
        names.append(known[:, 0])
        sizes.append(known[:, 1])
        heats.append(known[:, 2])
        ranks.append(some["rank"].astype(np.int64))
    gram, name, size, heat, rank = (np.concatenate(x) for x in (grams, names, sizes, heats, ranks))
    order = np.lexsort((name, gram))
    gram, name, size, heat, rank = gram[order], name[order], size[order], heat[order], rank[order]
    new = np.r_[True, (gram[1:] != gram[:-1]) | (name[1:] != name[:-1])]      # a class sent by several tasks
    gram, name, size, heat, rank = gram[new], name[new], size[new], heat[new], rank[new]
    starts = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])
    widths = np.full(len(starts), WIDE + 1) if hot else np.diff(np.r_[starts, len(gram)])
    pairs: list[np.ndarray] = []
    held, limit = 0, _FLUSH_PAIRS
    for width in range(2, WIDE + 1):
        at = starts[widths == width]
        i, j = np.triu_indices(width, 1)
        step = max(1, _FLUSH_PAIRS // 4 // len(i))
        for k in range(0, len(at), step):
            some = at[k: k + step]
            x, y = (some[:, None] + i).ravel(), (some[:, None] + j).ravel()
            near = (NUM * size[x] <= DEN * size[y]) & (NUM * size[y] <= DEN * size[x])
            x, y = x[near], y[near]
            pairs.append(np.stack([name[x], name[y], size[x], size[y], np.ones(len(x), np.int64), rank[x], rank[y]], 1))
            held += len(x)
            if held > limit:
                pairs = [_added(pairs)]
                held = len(pairs[0])
                limit = max(_FLUSH_PAIRS, 2 * held)      # distinct pairs stay: merge again when they double
    rows = _added(pairs)
    inside = np.repeat(widths > WIDE, np.diff(np.r_[starts, len(gram)]))
    k = int(inside.sum())
    columns = [np.r_[rows[:, c], extra] for c, extra in
               ((0, name[inside]), (1, np.zeros(k, np.int64)), (2, size[inside]), (3, np.zeros(k, np.int64)),
                (4, heat[inside]), (5, rank[inside]), (6, np.full(k, int(hot))))]
    blank = np.r_[np.zeros(len(rows), bool), np.ones(k, bool)]
    gram = np.r_[np.zeros(len(rows), np.int64), gram[inside].view(np.int64)]
    return pa.table({
        "a": pa.array(columns[0]), "b": pa.array(columns[1], mask=blank), "na": pa.array(columns[2]),
        "nb": pa.array(columns[3], mask=blank), "shared": pa.array(columns[4]), "rank_a": pa.array(columns[5]),
        "rank_b": pa.array(columns[6]), "gram": pa.array(gram, mask=~blank)})


def _reachable(shared, na, ra, nb, rb):
    """Whether the overlap can still reach the least one: what is shared in the prefixes up to the last
    common n-gram, and all n-grams behind it."""
    most = shared + F.least(na - ra - 1, nb - rb - 1)
    return (NUM + DEN) * most >= NUM * (na + nb)


def hot_grams(counts: DataFrame) -> np.ndarray:
    """Sorted n-grams of ``HOT`` or more classes; of more where they would not fit ``MAX_HOT``.

    The order they define decides cost only: any order gives the same links.
    """
    grams = materialize(counts.groupBy("name").agg(F.sum("n").alias("n")).filter(F.col("n") >= HOT), "ngram-hot")
    least = HOT
    while grams.filter(F.col("n") >= least).count() > MAX_HOT:
        least *= 2
    found = grams.filter(F.col("n") >= least).select("name").toPandas()["name"].to_numpy(np.int64)
    return np.sort(found.view(np.uint64))


def _overlaps(a: pa.Array, b: pa.Array) -> pa.Array:
    out = []
    for x, y in zip(a, b, strict=True):
        x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
        if len(x) > len(y):
            x, y = y, x
        at = np.searchsorted(y, x)
        out.append(int((y[np.minimum(at, len(y) - 1)] == x).sum()))
    return pa.array(out, pa.int64())


def _full_sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column("name")
            kept, sets, total = [], [], 0
            for i, grams in _sets(batch, words):
                if len(grams) and set_name(grams) == wanted[i].as_py():
                    kept.append(wanted[i].as_py())
                    sets.append(grams.tobytes())
                    total += len(sets[-1])
                if total > 8 << 20:
                    yield pa.RecordBatch.from_pydict({"name": pa.array(kept, pa.int64()), "grams": pa.array(sets, pa.binary())})
                    kept, sets, total = [], [], 0
            yield pa.RecordBatch.from_pydict({"name": pa.array(kept, pa.int64()), "grams": pa.array(sets, pa.binary())})

    return run


def _differences(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([least_difference(x.as_buffer(), y.as_buffer()) for x, y in zip(a, b, strict=True)], pa.int64())


class Join:
    """Links of one table of documents."""

    def __init__(self, docs: DataFrame, text: str, id: str, words: int, row: str | None) -> None:
        self._words = words
        number = F.monotonically_increasing_id() if row is None else col(row)
        self._rows = docs.select(number.alias("row"), col(id).cast("long").alias("doc_id"), col(text).cast("binary").alias("text"))
        self._docs = self._rows.drop("row")

    def signatures(self) -> tuple[DataFrame, DataFrame]:
        """(row, doc_id, name, n, bits) of every document, and n-gram counts of tasks."""
        rows = self._rows.mapInArrow(
            _signed(self._words), "kind int, row long, doc_id long, name long, n long, bits binary")
        both = materialize(rows, "ngram-signed")
        return both.filter("kind = 0").drop("kind"), both.filter("kind = 1").select("name", "n")

    def candidates(self, grams: int, heat) -> tuple[DataFrame, DataFrame]:
        """Pairs (a, b, na, nb, shared) that can still be linked, and members of wide columns."""
        spark = self._docs.sparkSession
        blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(0.21 * grams / BLOCK))
        entries = self._docs.mapInArrow(_entries(self._words, blocks, heat), _ENTRY_ROWS)
        product = materialize(entries.groupBy("block").applyInArrow(_multiplied(blocks), _PAIR), "ngram-product")
        pairs = product.filter("b is not null").groupBy("a", "b").agg(
            F.first("na").alias("na"), F.first("nb").alias("nb"), F.sum("shared").alias("shared"),
            F.max("rank_a").alias("ra"), F.max("rank_b").alias("rb"))
        pairs = pairs.filter(_reachable(*map(F.col, ("shared", "na", "ra", "nb", "rb")))).drop("ra", "rb")
        wide = product.filter("b is null").select(
            "gram", F.col("a").alias("name"), F.col("na").alias("n"), F.col("rank_a").alias("rank"),
            F.col("shared").alias("heat"), (F.col("rank_b") == 1).alias("hot")).distinct()
        return materialize(pairs, "ngram-pairs"), materialize(wide, "ngram-wide")

    def sets(self, classes: DataFrame, needed: DataFrame) -> DataFrame:
        """(name, grams) of the needed classes, from the text of one document each."""
        chosen = materialize(classes.join(needed, "name", "left_semi").select("name", "shown", "times"), "ngram-needed")
        texts = chosen.join(self._docs, F.col("shown").eqNullSafe(F.col("doc_id"))).select("name", "text")
        found = texts.mapInArrow(_full_sets(self._words), "name long, grams binary")
        if not chosen.filter("times > 1").isEmpty():     # rows repeated with their id
            found = found.dropDuplicates(["name"])
        return materialize(found, "ngram-sets")


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) whose full sets are similar enough."""
    overlap = F.arrow_udf(_overlaps, "long")
    both = pairs.select("a", "b").join(sets.select(F.col("name").alias("a"), F.col("grams").alias("ga")), "a").join(
        sets.select(F.col("name").alias("b"), F.col("grams").alias("gb")), "b")
    shared = both.select("a", "b", (F.octet_length("ga") / 8 + F.octet_length("gb") / 8).cast("long").alias("both"),
                         overlap("ga", "gb").alias("shared"))
    return materialize(shared.filter(DEN * F.col("shared") >= NUM * (F.col("both") - F.col("shared"))).select("a", "b"),
                       "ngram-links")


def _ends(pairs: DataFrame) -> DataFrame:
    """Classes of pairs."""
    return pairs.select(F.explode(F.array("a", "b")).alias("name")).distinct()


def _sieved(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) that their bitmaps don't rule out."""
    side = lambda x: classes.select(F.col("name").alias(x), F.col("n").alias(f"n{x}"), F.col("bits").alias(f"bits_{x}"))
    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    both = both.withColumn("apart", F.arrow_udf(_differences, "long")("bits_a", "bits_b"))
    total = F.col("na") + F.col("nb")                # overlap <= (total - apart) / 2
    return both.filter((NUM + DEN) * (total - F.col("apart")) >= 2 * NUM * total).select("a", "b")


def _pivots(wide: DataFrame) -> DataFrame:
    """Pairs of each member of a wide column with the pivot of its size band, and of pivots of neighbouring bands."""
    band = F.floor(F.log("n") / math.log(DEN / NUM))
    wide = wide.withColumn("band", band)
    pivots = wide.groupBy("gram", "band").agg(F.max(F.struct("heat", "name")).alias("p")).select(
        "gram", "band", F.col("p.name").alias("pivot"))
    star = wide.join(pivots, ["gram", "band"]).select(F.col("name").alias("x"), F.col("pivot").alias("y"))
    up = pivots.select("gram", (F.col("band") + 1).alias("band"), F.col("pivot").alias("x"))
    step = pivots.join(up, ["gram", "band"]).select("x", F.col("pivot").alias("y"))
    return star.union(step).filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _best(pairs: DataFrame) -> DataFrame:
    """Of each class, its pair with the most shared n-grams for its size."""
    weight = F.col("shared") / (F.col("na") + F.col("nb"))
    each = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("of"), weight.alias("w"))
    return each.groupBy("of").agg(F.max(F.struct("w", "a", "b")).alias("p")).select("p.a", "p.b").distinct()


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose sides are in different components so far."""
    a = labels.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    b = labels.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    return pairs.join(a, "a", "left").join(b, "b", "left").filter(
        F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")


def _with_main(wide: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of wide columns with their component, and the column's main one."""
    known = wide.join(labels.withColumnRenamed("node", "name"), "name", "left").withColumn(
        "component", F.coalesce("component", "name"))
    main = known.groupBy("gram", "component").agg(F.count(F.lit(1)).alias("k")).groupBy("gram").agg(
        F.max(F.struct("k", "component")).alias("m"), F.count(F.lit(1)).alias("components")).select(
        "gram", F.col("m.component").alias("main"), "components")
    return materialize(known.join(main.filter("components > 1").drop("components"), "gram"), "ngram-members")


def _outside(known: DataFrame) -> DataFrame:
    """Members of wide, not hot columns outside the main component, with every other member that sizes allow."""
    of_x = {"name": "x", "n": "nx", "rank": "rx", "component": "cx"}
    known = known.filter("not hot")
    out = known.filter("component <> main").select("gram", *[F.col(a).alias(b) for a, b in of_x.items()])
    nx, n = F.col("nx"), F.col("n")
    by_rank = _reachable(1 + F.least("rx", "rank"), nx, F.col("rx"), n, F.col("rank"))
    met = out.join(known, "gram").filter((F.col("cx") != F.col("component")) & (NUM * nx <= DEN * n) & (NUM * n <= DEN * nx)
                                         & by_rank)
    return met.select(F.least("x", "name").alias("a"), F.greatest("x", "name").alias("b")).distinct()


def _able(known: DataFrame) -> DataFrame:
    """Members of hot columns with hot n-grams enough for a link by these alone."""
    n, heat = F.col("n"), F.col("heat")
    differ = F.floor((n + F.floor(n * DEN / NUM)) * (DEN - NUM) / (DEN + NUM))
    return known.filter(F.col("hot") & (n - heat <= differ))


def ladder(most: int) -> list[int]:
    """Numbers of differences, each half as much again as the last, up to the first that is ``most`` or more."""
    out = [0]
    while out[-1] < most:
        out.append(max(out[-1] + 1, out[-1] * 3 // 2))
    return out


def part_steps(heat: int, n: int) -> tuple[list[int], bool]:
    """Steps of the ladder that a set of size n with ``heat`` hot n-grams is dealt at, from its home up; whether
    it can be the side at home.

    Linked sets that share no cold n-gram differ in at most f(a) + f(b) hot ones, where f is the size's share
    of differences less the set's cold n-grams; so in at most twice the larger f. That number's step of the
    ladder is the home of the set with the larger f, and the other visits all steps from its own home up to
    the highest that a partner can have.
    """
    both = DEN + NUM
    home = 2 * (n * (DEN - NUM) - (n - heat) * both) // both
    steps_up = ladder(2 * (n * DEN // NUM) * (DEN - NUM) // both)
    first = next((i for i, k in enumerate(steps_up) if k >= home), len(steps_up) - 1)
    return steps_up[first:], home >= 0


def parts_at(k: int) -> int:
    """Parts that n-grams are dealt over at step k: linked sets are the same in all but k of them."""
    return (3 * k + 1) // 2 + 1


def part_names(hot: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of the parts of the hot n-grams of a set of size n, step by step (``part_steps``), and whether it is
    at home there. Empty parts have names too: equal sets agree in them."""
    steps_up, able = part_steps(len(hot), n)
    keys, names, at_home = mix(hot ^ np.uint64(0x2545F4914F6CDD1D)), [], []
    for k in steps_up:
        count = parts_at(k)
        part = (keys % np.uint64(count)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        at = np.flatnonzero(np.diff(part[order], prepend=-1))
        sums = np.zeros(count, np.uint64)
        if len(at):
            sums[part[order][at]] = np.add.reduceat(mix(keys[order]), at)
        names.append(mix(mix(sums + np.uint64(k)) + np.arange(count, dtype=np.uint64)))
        at_home.append(np.full(count, k == steps_up[0] and able))
    return np.concatenate(names).view(np.int64), np.concatenate(at_home)


#: Numbers of 64 parities each that go with a part, of all hot n-grams of the set.
_SKETCH = 4


def sketch(hot: np.ndarray) -> np.ndarray:
    """Parities of the hot n-grams: sets differ in at least as many as their parities do."""
    bit = (mix(hot ^ np.uint64(0x9FB21C651E98DF25)) % np.uint64(64 * _SKETCH)).astype(np.int64)
    odd = np.bincount(bit, minlength=64 * _SKETCH) & 1
    return np.packbits(odd, bitorder="little").view(np.int64)


_OF_SET = ["name", "n", "component", "cold", *(f"s{i}" for i in range(_SKETCH))]
_PART_ROWS = "part long, step int, home boolean, " + ", ".join(f"{c} long" for c in _OF_SET)


def _parts(heat):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held: list[tuple]) -> pa.RecordBatch:
            times = [len(h[0]) for h in held]
            columns = {"part": pa.array(np.concatenate([h[0] for h in held])),
                       "step": pa.array(np.concatenate([h[1] for h in held])),
                       "home": pa.array(np.concatenate([h[2] for h in held]))}
            sets = np.array([h[3] for h in held], np.int64)
            return pa.RecordBatch.from_pydict(columns | {
                c: pa.array(np.repeat(sets[:, i], times)) for i, c in enumerate(_OF_SET)})

        held, count = [], 0
        for batch in batches:
            known = zip(*(batch.column(c).to_pylist() for c in ("name", "n", "component")), strict=True)
            for (label, n, component), grams in zip(known, batch.column("grams"), strict=True):
                grams = np.frombuffer(grams.as_buffer(), np.uint64)
                hot = grams[is_hot(grams, heat.value)]
                names, home = part_names(hot, n)
                steps_up = part_steps(len(hot), n)[0]
                step = np.repeat(np.array(steps_up, np.int32), [parts_at(k) for k in steps_up])
                held.append((names, step, home, (label, n, component, n - len(hot), *sketch(hot).tolist())))
                count += len(names)
                if count > _FLUSH_ENTRIES:
                    yield out(held)
                    held, count = [], 0
        if held:
            yield out(held)

    return run


def agreeing(members: DataFrame, sets: DataFrame, heat) -> DataFrame:
    """Pairs (a, b) of ``members`` (name, n, component) of different components that agree in a rare part of their
    hot n-grams, one of them at home, and can be linked by sizes and parities.

    Of a step's parts a set keeps the k + 1 that fewest sets have: equal parts of two sets that differ in k or
    fewer cannot all be among the others. Parts where no pair can be drop out before the join.
    """
    rows = members.join(sets, "name").select("name", "n", "component", "grams")
    parts = materialize(rows.mapInArrow(_parts(heat), _PART_ROWS), "ngram-parts")
    held = parts.groupBy("part").agg(F.count(F.lit(1)).alias("sets"))
    place = F.row_number().over(Window.partitionBy("name", "step").orderBy("sets", "part"))
    rare = materialize(parts.join(held, "part").withColumn("place", place).filter(F.col("place") <= F.col("step") + 1).drop(
        "place", "sets", "step"), "ngram-rare")
    mixed = rare.groupBy("part").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                     F.max("home").alias("home")).filter("lo <> hi and home")
    rare = materialize(rare.join(mixed.select("part"), "part", "left_semi"), "ngram-mixed")
    x = rare.filter("home").select("part", *[F.col(c).alias(f"{c}_x") for c in _OF_SET])
    n, nx = F.col("n"), F.col("n_x")
    flips = sum((F.bit_count(F.col(f"s{i}").bitwiseXOR(F.col(f"s{i}_x"))) for i in range(1, _SKETCH)),
                F.bit_count(F.col("s0").bitwiseXOR(F.col("s0_x"))))
    uneven = F.abs((n - F.col("cold")) - (nx - F.col("cold_x")))
    differ = F.col("cold") + F.col("cold_x") + F.greatest(flips.cast("long"), uneven)
    met = x.join(rare, "part").filter((F.col("component_x") != F.col("component"))
                                      & (NUM * nx <= DEN * n) & (NUM * n <= DEN * nx)
                                      & ((DEN + NUM) * differ <= (DEN - NUM) * (n + nx)))
    return met.select(F.least("name_x", "name").alias("a"), F.greatest("name_x", "name").alias("b")).distinct()


def ngram_components(docs: DataFrame, text: str = "text", id: str = "doc_id", words: int = WORDS,
                     row: str | None = None) -> DataFrame:
    """row, doc_id, n_shingles, component (a number, null for an empty set), component_id (the least id
    reachable by links). ``row``: a column that numbers the rows, else they are numbered here."""
    join = Join(docs, text, id, words, row)
    signed, counts = join.signatures()
    total = signed.agg(F.sum("n")).first()[0] or 0
    heat = docs.sparkSession.sparkContext.broadcast(hot_grams(counts))      # at most MAX_HOT numbers
    pairs, wide = join.candidates(total, heat)
    by_id = signed.filter("n > 0").groupBy("name", "doc_id").agg(
        F.count(F.lit(1)).alias("times"), F.first("n").alias("n"), F.first("bits").alias("bits"))
    classes = materialize(by_id.groupBy("name").agg(
        F.min("doc_id").alias("shown"), F.max("times").alias("times"), F.first("n").alias("n"), F.first("bits").alias("bits")),
        "ngram-classes")
    first = materialize(_sieved(_best(pairs).union(_pivots(wide)).distinct(), classes), "ngram-first")
    left = materialize(_sieved(pairs.join(first, ["a", "b"], "left_anti"), classes), "ngram-left")
    links = _linked(first, join.sets(classes, _ends(first)))
    labels = connected_components(links)
    known = _with_main(wide, labels)
    members, n = materialize(_able(known).select("name", "n", "component").distinct(), "ngram-able", count=True)
    met = _outside(known)
    if n:
        met = met.union(agreeing(members, join.sets(classes, members), heat)).distinct()
    rest, n = materialize(_apart(left, labels).union(_sieved(met, classes)).distinct(), "ngram-rest", count=True)
    if n:
        labels = connected_components(links.union(_linked(rest, join.sets(classes, _ends(rest)))))
    # A row's component: by its class's label, then the least id of all classes there.
    named = classes.join(labels.withColumnRenamed("node", "name"), "name", "left").withColumn(
        "component", F.coalesce("component", "name"))
    least = named.groupBy("component").agg(F.min("shown").alias("component_id"))
    shown = materialize(named.join(least, "component").select("name", "component", "component_id"), "ngram-labels")
    return signed.join(shown, "name", "left").select(
        "row", "doc_id", F.col("n").alias("n_shingles"), "component",
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def drop_near_copies(docs: DataFrame, text: str = "text", id: str = "doc_id", words: int = WORDS) -> DataFrame:
    """``docs`` with one row of each component: that of its least id (the earliest of repeated rows)."""
    row = free_name(docs, "row")
    rows = materialize(numbered(docs, row), "ngram-docs")
    found = materialize(ngram_components(rows, text, id, words, row).filter("component is not null"), "ngram-found")
    stays = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("best"))
    goes = materialize(found.join(stays.select(F.col("best.row").alias("row")), "row", "left_anti").select(
        F.col("row").alias(row)), "ngram-goes")
    return rows.join(goes, row, "left_anti").select(*[col(c) for c in docs.columns])
