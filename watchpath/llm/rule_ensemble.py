"""Quality classifier: a sparse ensemble of rules over text statistics.

``statistics`` measures every whole text (byte and word shares, repetition).
``fit`` grows a small random forest on labelled rows, takes every path from a
root to an inner node or leaf as a conjunctive rule, and fits lasso logistic
weights for the rules; most become zero. ``Rules.score`` compiles what is left
into one Spark column expression.

Fitting uses a bounded sample of the labelled rows (``MAX_ROWS``, picked by a
hash of the id); scoring covers all rows.

Cases: a null or empty text has all statistics 0 and is scored like any other
row. Rows without a label, or with a null id or label, are not learned from.
Without labelled rows, or with one class only, the score is the smoothed share
of label 1. Repeated rows are scored alike. An empty table gives an empty
result; other columns do not matter.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import col, materialize
from .textarrays import steps, word_hashes, word_spans

MAX_ROWS = 40_000
TREES, DEPTH, PENALTY, SEED = 24, 3, 0.002, 7

#: Byte classes whose share of all bytes is measured.
_CLASSES = {
    "symbols": b"#*$%&<>^~@\\=+{}[]_", "bars": b"|", "shouts": b"!?", "stops": b".,;:",
    "digits": b"0123456789", "upper": bytes(range(65, 91)), "lines": b"\n",
    "controls": bytes(b for b in range(32) if b not in (9, 10, 13)),
}
STATISTICS = ["log_words", "word_length", "new_words", "repeats", "longest_word", "top_word", *_CLASSES]


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    member = {name: np.isin(np.arange(256), list(chars)) for name, chars in _CLASSES.items()}
    for batch in batches:
        parts: list[np.ndarray] = []
        for _, _, data, offsets in steps(batch.column("text")):
            n = len(offsets) - 1
            out = np.zeros((n, len(STATISTICS)))
            size = np.maximum(np.diff(offsets), 1)
            row = np.repeat(np.arange(n), np.diff(offsets))
            for j, flags in enumerate(member.values()):
                out[:, len(STATISTICS) - len(member) + j] = np.bincount(row[flags[data]], minlength=n) / size
            starts, ends, owner = word_spans(data, offsets)
            words = np.bincount(owner, minlength=n)
            some = np.maximum(words, 1)
            hashes = word_hashes(data, starts, ends)
            out[:, 0] = np.log1p(words)
            out[:, 1] = np.bincount(owner, ends - starts, minlength=n) / some
            again = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
            out[:, 3] = np.bincount(owner[1:][again], minlength=n) / some
            np.maximum.at(out[:, 4], owner, np.minimum(ends - starts, 1000))
            order = np.lexsort((hashes, owner))
            h, o = hashes[order], owner[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
            first = np.flatnonzero(new)
            out[:, 2] = np.bincount(o[first], minlength=n) / some
            np.maximum.at(out[:, 5], o[first], np.diff(np.append(first, len(h))))
            out[:, 5] /= some
            parts.append(out)
        stats = np.concatenate(parts) if parts else np.zeros((0, len(STATISTICS)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(stats[:, j]) for j in range(len(STATISTICS)))],
            names=["doc_id", *STATISTICS])


def statistics(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """doc_id and the statistics of each whole text (doubles)."""
    return docs.select(col(id).cast("long").alias("doc_id"), col(text).cast("binary").alias("text")).mapInArrow(
        _measured, "doc_id long, " + ", ".join(f"{name} double" for name in STATISTICS))


@dataclass(frozen=True)
class Rules:
    """Weighted conjunctions: ((statistic, is_above, threshold), ...) and a weight each."""

    intercept: float
    rules: tuple[tuple[tuple[tuple[str, bool, float], ...], float], ...] = ()

    def score(self) -> Column:
        """Probability of label 1, from the statistics' columns."""
        margin = F.lit(self.intercept)
        for conditions, weight in self.rules:
            margin = margin + F.when(holds(conditions), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-margin))


def holds(conditions) -> Column:
    """A rule as a boolean column."""
    return reduce(lambda a, b: a & b, (F.col(name) > at if above else F.col(name) <= at for name, above, at in conditions))


def tree_paths(description: str, names: list[str]) -> set[tuple[tuple[str, bool, float], ...]]:
    """Every path of a tree, from its printed form (``If (feature 3 <= 0.5)`` lines, indented by depth)."""
    paths, above = set(), []
    for line in description.splitlines():
        if m := re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line):
            del above[len(m[1]) - 2:]
            above.append((names[int(m[2])], m[3] == ">", float(m[4])))
            paths.add(_tightened(above))
    return paths


def _tightened(conditions) -> tuple[tuple[str, bool, float], ...]:
    """One bound per statistic and side: the strictest."""
    best: dict[tuple[str, bool], float] = {}
    for name, above, at in conditions:
        key = (name, above)
        best[key] = (max if above else min)(at, best.get(key, at))
    return tuple(sorted((name, above, at) for (name, above), at in best.items()))


def fit(stats: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Rules:
    """Rules learned from ``labels`` (doc_id, label 0/1) joined with ``stats``."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    known = labels.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).select(
        "doc_id", F.col("label").cast("double").alias("label"))
    total = known.count()
    share = min(1.0, max_rows / max(total, 1))
    picked = known.filter(F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    rows = materialize(stats.join(picked, "doc_id"), "rules-train")
    counts = {r.label: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    ones, zeros = counts.get(1.0, 0), counts.get(0.0, 0)
    if not ones or not zeros:
        return Rules(math.log((ones + 1) / (zeros + 1)))
    data = VectorAssembler(inputCols=STATISTICS, outputCol="features").transform(rows).select("features", "label", *STATISTICS)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, maxBins=64,
                                    featureSubsetStrategy="onethird").fit(data)
    paths = sorted(set().union(*(tree_paths(t.toDebugString, STATISTICS) for t in forest.trees)))
    if not paths:
        return Rules(math.log((ones + 1) / (zeros + 1)))
    marks = data.select("label", *[holds(p).cast("double").alias(f"r{i}") for i, p in enumerate(paths)])
    marks = VectorAssembler(inputCols=[f"r{i}" for i in range(len(paths))], outputCol="features").transform(
        marks).select("features", "label")
    model = LogisticRegression(elasticNetParam=1.0, regParam=PENALTY, maxIter=60).fit(marks)
    weights = model.coefficients.toArray()
    return Rules(float(model.intercept), tuple((p, float(w)) for p, w in zip(paths, weights, strict=True) if w))


def classified(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, text: str = "text",
               id: str = "doc_id", max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, score, predicted for every row; ``held_out`` (over doc_id) rows are not learned from."""
    stats = materialize(statistics(docs, text, id), "rules-stats")
    known = labels if held_out is None else labels.filter(~held_out)
    model = fit(stats, known, max_rows)
    score = model.score()
    return stats.select("doc_id", score.alias("score")).select(
        "doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
