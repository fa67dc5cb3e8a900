"""Mixing sources to target weights by min-cost flow.

Documents may belong to several overlapping sources. They are aggregated by
membership pattern (the set of their sources); the flow network has a node per
pattern and per source, so its size follows the source scheme and not the
corpus. A pattern offers its words once at no cost, and again at a rising
(convex) cost up to ``max_uses`` times; each source takes up to its quota. The
cheapest full flow gives the words to take from each pattern.

Documents of a pattern are then taken in a seeded order: every document
``words // size`` times, and a seeded part of them once more: in that order
each document that still fits is taken and the others are skipped, until none
fits. A run up to the first misfit is found from a histogram of the order hash
(combined before the shuffle) and a window over its one boundary bin, so no
pattern's rows meet in one task; the next run goes on behind the misfit with
the documents that fit what is left. That is less than the misfit's size, so
runs are few (about the logarithm of the longest text). At the end the smallest
document not taken is taken too where that comes nearer to the quota, so a
pattern is off by at most half of that document. The selection depends on ids,
sizes and the seed only.

Cases: a null or empty text has size 0 and is never taken. A null source is a
source of its own, ordered last. Repeated rows are separate documents (ties of
hash go by id, then size, then row). Sources without words get target 0. An
empty table gives an empty result. Column names other than id, text and source
do not matter.
"""

from __future__ import annotations

import heapq
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import col, materialize, numbered
from .textarrays import count_words, steps

MAX_USES = 3
SEED = 17
#: Bins of the order hash per pattern.
_BINS = 4096
#: A document's place in the seeded order.
_PLACE = "struct<bin: long, u: long, doc_id: long, row: long>"


def word_counts(texts: pa.Array) -> pa.Array:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text; null counts as empty."""
    out = [count_words(data, offsets) for _, _, data, offsets in steps(texts)]
    return pa.array([int(n) for part in out for n in part], pa.int64())


def targets(sizes: dict, weights: dict, max_uses: int = MAX_USES) -> dict:
    """Words per source: all words shared by weight, no source above ``max_uses``
    times its size; what is cut off goes to the others by weight."""
    left, open_, out = Fraction(sum(sizes.values())), dict(weights), {}
    while open_:
        total = sum(open_.values())
        capped = [s for s, w in open_.items() if left * w > max_uses * sizes[s] * total]
        if not capped:
            return out | {s: left * w / total for s, w in open_.items()}
        for s in capped:
            out[s] = Fraction(max_uses * sizes[s])
            del open_[s]
        left -= sum(out[s] for s in capped)
    return out


def quotas(wanted: dict) -> dict:
    """Whole words near ``wanted`` (fractions) with the same sum: largest rests round up."""
    whole = {s: int(t) for s, t in wanted.items()}
    spare = round(sum(wanted.values())) - sum(whole.values())
    for s in sorted(wanted, key=lambda s: whole[s] - wanted[s])[:spare]:
        whole[s] += 1
    return whole


def cheapest_flow(patterns: dict, quota: dict, max_uses: int = MAX_USES) -> dict:
    """Words to take per pattern. ``patterns``: {frozenset of sources: words}.

    Successive shortest paths with potentials; use k of a pattern costs k*k a word.
    """
    names = list(patterns)
    nodes = {"start": 0, "end": 1}
    for key in [*((p, "pattern") for p in names), *((s, "source") for s in quota)]:
        nodes[key] = len(nodes)
    edges: list[list] = []                     # to, capacity left, cost
    out: list[list[int]] = [[] for _ in nodes]

    def arc(a, b, capacity, cost):
        for x, y, c, price in ((a, b, capacity, cost), (b, a, 0, -cost)):
            out[x].append(len(edges))
            edges.append([y, c, price])

    uses = {}
    for p in names:
        uses[p] = len(edges)
        for k in range(max_uses):
            arc(nodes["start"], nodes[(p, "pattern")], patterns[p], k * k)
        for s in p:
            if s in quota:
                arc(nodes[(p, "pattern")], nodes[(s, "source")], max_uses * patterns[p], 0)
    for s, words in quota.items():
        arc(nodes[(s, "source")], nodes["end"], words, 0)
    lift = [0] * len(nodes)
    while True:
        far: list = [None] * len(nodes)
        via: list = [None] * len(nodes)
        far[0], queue = 0, [(0, 0)]
        while queue:
            d, x = heapq.heappop(queue)
            if d > far[x]:
                continue
            for e in out[x]:
                y, c, price = edges[e]
                if c and (far[y] is None or d + price + lift[x] - lift[y] < far[y]):
                    far[y], via[y] = d + price + lift[x] - lift[y], e
                    heapq.heappush(queue, (far[y], y))
        if far[1] is None:
            break
        lift = [v + (d if d is not None else far[1]) for v, d in zip(lift, far, strict=True)]
        path, x = [], 1
        while x:
            path.append(via[x])
            x = edges[via[x] ^ 1][0]
        step = min(edges[e][1] for e in path)
        for e in path:
            edges[e][1] -= step
            edges[e ^ 1][1] += step
    return {p: sum(edges[uses[p] + 2 * k + 1][1] for k in range(max_uses)) for p in names}


def default_weights(sources: list) -> dict:
    """1, 2, 3, 1, ... over the sources by code point, null last."""
    ordered = sorted(sources, key=lambda s: (s is None, s or ""))
    return {s: 1 + i % 3 for i, s in enumerate(ordered)}


def mixed(docs: DataFrame, sources: Column, weights=default_weights, text: str = "text", id: str = "doc_id",
          max_uses: int = MAX_USES, seed: int = SEED, keep: Column | None = None) -> DataFrame:
    """One row per document: doc_id, sources, size, uses, taken (= uses * size), source_size and target
    (sums over its sources), keep (``keep``, such as a struct of the document's columns).

    ``sources``: an array of the document's sources (elements may be null);
    ``weights``: from the list of sources to {source: weight}.
    """
    size = F.arrow_udf(word_counts, T.LongType())(F.coalesce(col(text).cast("binary"), F.lit(b"")))
    rows = docs.select(
        col(id).cast("long").alias("doc_id"), F.array_sort(F.array_distinct(sources)).alias("sources"),
        size.alias("size"), (F.lit(None) if keep is None else keep).alias("keep"))
    rows = materialize(numbered(rows.withColumn(
        "u", F.xxhash64(F.lit(seed), "doc_id", "size")), "row"), "mix-sizes")
    rows = rows.select("*", F.pmod("u", F.lit(_BINS)).alias("bin"), F.to_json(F.struct("sources")).alias("pattern"))
    plan = _plan(rows, weights, max_uses)
    return _select(rows, plan)


def mixed_by_source(docs: DataFrame, source: str = "source", text: str = "text", id: str = "doc_id",
                    max_uses: int = MAX_USES, seed: int = SEED) -> DataFrame:
    """The mix of documents with one source each: doc_id, source, size, uses, taken, source_size, target, keep."""
    rows = mixed(docs, F.array(col(source)), text=text, id=id, max_uses=max_uses, seed=seed)
    return rows.withColumn("source", F.col("sources")[0])


def repeated(docs: DataFrame, source: str = "source", text: str = "text", id: str = "doc_id",
             max_uses: int = MAX_USES, seed: int = SEED) -> DataFrame:
    """``docs`` with each row as often as the mix uses it; same columns."""
    whole = F.struct(*[col(c) for c in docs.columns])
    rows = mixed(docs, F.array(col(source)), text=text, id=id, max_uses=max_uses, seed=seed, keep=whole)
    uses = F.explode(F.array_repeat(F.lit(1), F.col("uses").cast("int")))
    return rows.select("keep", uses.alias("use")).select(*[F.col("keep")[c].alias(c) for c in docs.columns])


def _plan(rows: DataFrame, weights, max_uses: int) -> DataFrame:
    """Per pattern: its words and target, full uses of every document, and the words beyond them."""
    found = rows.groupBy("pattern").agg(F.first("sources").alias("sources"), F.sum("size").alias("words")).collect()
    words = {r.pattern: r.words for r in found}
    members = {r.pattern: frozenset(r.sources or []) for r in found}
    names = frozenset().union(*members.values())
    sizes = {s: sum(words[p] for p in words if s in members[p]) for s in names}
    wanted = targets(sizes, weights(list(names)), max_uses)
    flow = cheapest_flow({members[p]: words[p] for p in words}, quotas(wanted), max_uses)
    plan = []
    for p, w in words.items():
        full, beyond = divmod(flow[members[p]], w) if w else (0, 0)
        plan.append((p, sum(sizes[s] for s in members[p]), float(sum(wanted[s] for s in members[p])), full, beyond))
    plan = rows.sparkSession.createDataFrame(plan, "pattern string, source_size long, target double, full long, beyond long")
    return materialize(plan, "mix-plan")       # its size is known then


def _select(rows: DataFrame, plan: DataFrame) -> DataFrame:
    spark = rows.sparkSession
    rows = rows.withColumn("place", F.struct("bin", "u", "doc_id", "row"))
    free = rows.filter("size > 0").select("pattern", "bin", "size", "u", "doc_id", "row", "place")
    gaps = {r.pattern: r.beyond for r in plan.filter("beyond > 0").select("pattern", "beyond").collect()}
    # Per pattern its runs (gap, stop): documents of at most ``gap`` words placed before ``stop`` are taken. A run stops
    # at the first document that does not fit any more; the next one goes on behind it with those that do, so that no
    # more than one document is shut out at a time, whatever its size.
    runs: dict[str, list] = {p: [] for p in gaps}
    going = dict(gaps)
    while going:
        ask = materialize(spark.createDataFrame([(p, g, runs[p][-1][1] if runs[p] else None) for p, g in going.items()],
                                                f"pattern string, gap long, since {_PLACE}"), "mix-gaps")
        fit = free.filter(F.col("size") <= max(going.values())).join(ask, "pattern").filter(
            (F.col("size") <= F.col("gap")) & (F.col("since").isNull() | (F.col("place") > F.col("since"))))
        found = {r.pattern: r for r in _run(fit).collect()}
        going = {}
        for p, r in found.items():
            runs[p].append((gaps[p], r.stop))
            gaps[p] -= r.words
            if r.stop is not None and gaps[p] > 0:
                going[p] = gaps[p]
    marks = "pattern string, gap long, runs array<struct<gap: long, stop: " + _PLACE + ">>"
    taken = materialize(spark.createDataFrame([(p, gaps[p], runs[p]) for p in runs], marks), "mix-runs")
    in_run = F.exists("runs", lambda r: (F.col("size") <= r["gap"]) & F.coalesce(F.col("place") < r["stop"], F.lit(True)))
    # No document left fits: the smallest is taken where going over by it is nearer than falling short.
    over = free.join(taken.filter("gap > 0"), "pattern").filter(~in_run & (F.col("size") - F.col("gap") < F.col("gap"))).groupBy(
        "pattern").agg(F.min(F.struct("size", "u", "doc_id", "row"))["row"].alias("over"))
    marked = materialize(plan.join(taken.drop("gap"), "pattern", "left").join(over, "pattern", "left"), "mix-marked")
    more = F.coalesce(in_run, F.lit(False)) | F.coalesce(F.col("row") == F.col("over"), F.lit(False))
    uses = F.when(F.col("size") > 0, F.col("full") + more.cast("long")).otherwise(F.lit(0).cast("long"))
    return rows.join(marked, "pattern").select("doc_id", "sources", "size", uses.alias("uses"),
                                               (uses * F.col("size")).alias("taken"), "source_size", "target", "keep")


def _run(fit: DataFrame) -> DataFrame:
    """Per pattern, the place of the first document in seeded order that passes the gap (null if none does) and the
    words before it."""
    bins = fit.groupBy("pattern", "gap", "bin").agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(Window.partitionBy("pattern").orderBy("bin"))
    # The boundary bin: the first whose running sum passes the words wanted.
    passed = F.when(F.col("upto") > F.col("gap"), F.struct("bin", (F.col("upto") - F.col("words")).alias("before")))
    cut = bins.withColumn("upto", upto).groupBy("pattern").agg(F.min(passed).alias("at"), F.sum("words").alias("all")).select(
        "pattern", "all", F.col("at.bin").alias("bin"), F.col("at.before").alias("before"))
    cut = materialize(cut, "mix-cut")
    running = F.sum("size").over(Window.partitionBy("pattern").orderBy("u", "doc_id", "row"))
    edge = fit.join(cut.select("pattern", "bin", "before"), ["pattern", "bin"]).withColumn("sum", F.col("before") + running)
    first = edge.filter("sum > gap").groupBy("pattern").agg(
        F.min(F.struct("place", (F.col("sum") - F.col("size")).alias("words"))).alias("first"))
    return cut.join(first, "pattern", "left").select(
        "pattern", F.col("first.place").alias("stop"), F.coalesce("first.words", "all").alias("words"))
