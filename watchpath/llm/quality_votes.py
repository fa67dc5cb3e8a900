"""Quality rules as weak supervision, in DataFrame functions only.

Each rule votes good (1) or bad (-1) on a document, or abstains (0). Rules are
right with an unknown accuracy each; expectation-maximisation over the votes
estimates accuracies and the share of good documents without labels, and a
document is kept when its posterior probability of being good is one half or
more. Documents that fail the base rules (too short, mostly repeated) are not
kept whatever the vote.

Texts are measured once and the measures written; the model is fitted on the
distinct vote patterns with their counts (bounded by the rules, not by the
corpus), with votes of all documents. A repeated word window is found on 64-bit
window hashes within one text: they are sorted with their positions, neighbours
compared, and covered words counted from gaps between starts, so time is
n log n in a text's words. Distinct words are counted in spans of fixed length
over the whole text, and no rule asks for exactly none of something, so votes
do not turn with a text's length alone.

Cases: a null or empty text has all measures 0 and fails the base rules. Ties at
one half are kept. Repeated rows are counted as often as they occur and judged
alike. An empty table gives an empty result. Measures live in one struct column,
so other columns and their names do not matter.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import col, free_name, materialize

MIN_WORDS = 50
#: Repeated words, in percent of the words, above which a text fails.
MAX_REPEATED = 50
WINDOW = 3
#: Words per span in which distinct words are counted: their share falls with length in any text.
SPAN = 256
#: Symbols a word that a plain text may have.
FEW_SYMBOLS = 0.01
_WHITE = " \t\n\x0b\x0c\r"
_SPACE = r"[ \t\n\x0B\f\r]+"
_SYMBOLS = "[#*$%&|<>]"

#: Expectation-maximisation: rounds, first guess of accuracies and of the good share, its weight (share of
#: all documents), bounds of accuracies.
ROUNDS, FIRST, GOOD, WEIGHT, LEAST, MOST = 40, 0.8, 0.8, 0.02, 0.55, 0.995

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _less(text: Column, char: str) -> Column:
    """How often a character occurs."""
    return F.length(text) - F.length(F.replace(text, F.lit(char)))


def _repeated(words: Column) -> Column:
    """Words inside windows that occur twice or more in the text."""
    hashes = F.transform(F.slice(words, 1, F.size(words) - (WINDOW - 1)), lambda w, i: F.xxhash64(
        w, *(F.get(words, i + k) for k in range(1, WINDOW))))

    def starts(pairs: Column) -> Column:
        def again(p: Column, k: Column) -> Column:
            before, after = F.get(pairs, k - 1)["h"], F.get(pairs, k + 1)["h"]
            return (p["h"] == before) | (p["h"] == after)

        # the comparison is null at the ends where there is no neighbour
        return F.array_sort(F.transform(F.filter(pairs, lambda p, k: F.coalesce(again(p, k), F.lit(False))), lambda p: p["i"]))

    def covered(at: Column) -> Column:
        gaps = F.transform(at, lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - i, F.lit(WINDOW))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

    def of(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
            _let(pairs, lambda p: _let(starts(p), covered)))

    return F.when(F.size(words) > WINDOW, _let(hashes, of)).otherwise(F.lit(0).cast("long"))


def _distinct(words: Column) -> Column:
    """Distinct words of each span of the text, summed."""
    spans = F.transform(F.sequence(F.lit(0), F.floor((F.size(words) - 1) / SPAN).cast("int")), lambda k: F.size(
        F.array_distinct(F.slice(words, k * SPAN + 1, F.lit(SPAN)))))
    return F.when(F.size(words) > SPAN, F.aggregate(spans, F.lit(0).cast("long"), lambda a, n: a + n)).otherwise(
        F.size(F.array_distinct(words)).cast("long"))


def measured(docs: DataFrame, into: str, text: str = "text") -> DataFrame:
    """``docs`` with a struct ``into`` of whole-text measures (longs)."""
    whole = F.coalesce(col(text), F.lit(""))
    trimmed = F.btrim(whole, F.lit(_WHITE))

    def of(t: Column, w: Column, lines: Column) -> Column:
        measures = {
            "n_words": F.size(w),
            "word_chars": F.length(F.array_join(w, "")),
            "n_symbols": F.length(t) - F.length(F.regexp_replace(t, _SYMBOLS, "")),
            "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
            "n_repeat_words": _repeated(w),
            "n_lines": F.size(lines),
            "n_bars": _less(t, "|"),
            "n_shouts": _less(t, "!"),
            "n_upper": F.length(t) - F.length(F.regexp_replace(t, "[A-Z]+", "")),
            "n_distinct": _distinct(w),
        }
        return F.struct(*[m.cast("long").alias(name) for name, m in measures.items()])

    # Values used many times are bound once, whatever the optimizer makes of the projections around them.
    none = F.array().cast("array<string>")
    # Lines are those of the whole text: trimming would shorten the first and last.
    lines = F.filter(F.split(whole, "\n"), lambda line: F.btrim(line, F.lit(_WHITE)) != "")
    packed = _let(trimmed, lambda t: _let(F.when(t == "", none).otherwise(F.split(t, _SPACE)),
                                          lambda w: _let(lines, lambda found: of(t, w, found))))
    return docs.select("*", packed.alias(into))


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEATED * m["n_words"])


def votes(m: Column) -> dict[str, Column]:
    """Each rule's vote: 1 good, -1 bad, 0 abstains."""
    n = F.greatest(m["n_words"], F.lit(1))
    chars = F.greatest(m["word_chars"], F.lit(1))
    symbols, shouts, upper = m["n_symbols"] / n, m["n_shouts"] / n, m["n_upper"] / chars
    repeats, distinct, length = m["n_repeat_words"] / n, m["n_distinct"] / n, m["word_chars"] / n
    dups = m["n_dup_lines"] / F.greatest(m["n_lines"], F.lit(1))
    bad = {
        "symbols": symbols > 0.1,
        "symbol_glut": symbols > 0.3,
        "bars": m["n_bars"] / n > 0.1,
        "shouting": shouts > 0.3,
        "capitals": upper > 0.3,
        "repeats": repeats > 0.4,
        "few_distinct": distinct < 0.4,
        "line_copies": dups > 0.4,
        "word_length": (length > 6.5) | (length < 3),
    }
    good = {
        "plain": (symbols <= FEW_SYMBOLS) & (shouts <= 0.05) & (upper < 0.15) & (repeats < 0.2),
        "prose": (distinct > 0.5) & (repeats < 0.2) & length.between(4, 6.5) & (symbols <= 0.05),
    }
    return {k: F.when(v, -1).otherwise(0) for k, v in bad.items()} | {k: F.when(v, 1).otherwise(0) for k, v in good.items()}


@dataclass(frozen=True)
class VoteModel:
    """Share of good documents and each rule's accuracy."""

    good: float
    accuracy: tuple[float, ...]

    def posterior(self, ballots: list) -> Column:
        """Probability of good given the votes' columns."""
        margin = F.lit(_logit(self.good))
        for vote, a in zip(ballots, self.accuracy, strict=True):
            margin = margin + vote * F.lit(_logit(a))
        return 1 / (1 + F.exp(-margin))


def _logit(p: float) -> float:
    return math.log(p / (1 - p))


def fitted(patterns: list[tuple[tuple[int, ...], int]], rules: int, rounds: int = ROUNDS) -> VoteModel:
    """Accuracies and good share from vote patterns and their counts, by expectation-maximisation."""
    accuracy, good = [FIRST] * rules, GOOD
    total = sum(n for _, n in patterns)
    if not total:
        return VoteModel(good, tuple(accuracy))
    anchor = WEIGHT * total
    for _ in range(rounds):
        right, cast, expected = [anchor * FIRST] * rules, [anchor] * rules, 0.0
        for ballot, n in patterns:
            margin = _logit(good) + sum(v * _logit(a) for v, a in zip(ballot, accuracy, strict=True))
            q = 1 / (1 + math.exp(-max(-700.0, min(700.0, margin))))
            expected += n * q
            for j, v in enumerate(ballot):
                if v:
                    right[j] += n * (q if v > 0 else 1 - q)
                    cast[j] += n
        accuracy = [min(MOST, max(LEAST, r / c)) for r, c in zip(right, cast, strict=True)]
        good = min(0.95, max(0.05, expected / total))
    return VoteModel(good, tuple(accuracy))


def fit(rows: DataFrame, into: str) -> VoteModel:
    """The vote model of measured rows: all documents, by distinct vote pattern."""
    ballots = votes(col(into))
    counted = rows.select([v.alias(k) for k, v in ballots.items()]).groupBy(*ballots).agg(F.count(F.lit(1)).alias("n"))
    patterns = sorted((tuple(r[k] for k in ballots), r["n"]) for r in counted.collect())
    return fitted(patterns, len(ballots))


def verdict(model: VoteModel, into: str) -> Column:
    """Whether a measured row is kept."""
    m = col(into)
    return ~base_failed(m) & (model.posterior(list(votes(m).values())) >= 0.5)


def judged(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """doc_id, the base measures, base_failed, kept, posterior for every row."""
    rows = materialize(measured(docs.select(col(id).cast("long").alias("doc_id"), col(text).alias("text")), "m").drop("text"),
                       "votes-measured")
    model = fit(rows, "m")
    m = F.col("m")
    return rows.select("doc_id", *[m[c].alias(c) for c in BASE], base_failed(m).alias("base_failed"),
                       verdict(model, "m").alias("kept"), model.posterior(list(votes(m).values())).alias("posterior"))


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the rows that the vote or the base rules reject; same columns."""
    into = free_name(docs, "measures")
    rows = measured(docs, into, text)
    # The texts are measured again for the filter: cheaper than a second copy of them on disk.
    model = fit(materialize(rows.select(into), "votes-measured"), into)
    return rows.filter(verdict(model, into)).select(*[col(c) for c in docs.columns])
