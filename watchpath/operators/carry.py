"""Ordered windows over keys of any size, in bounded tasks.

A window partitioned by a key sends all rows of that key to one task, and a
bot-like account can hold a large share of a day. Here rows are first dealt
over range partitions of (key, order): Spark cuts the ranges at row quantiles of
a sample, so a hot key is spread over as many partitions as its rows need,
also when they all fall into one second. Every window then runs per (partition,
key), and what crosses a partition's edge is carried:

* LAG: a partition's last row of each kind is the previous row of the next
  partition's first one, if their keys are equal;
* running sums: a partition adds the sums of its first key's rows in earlier
  partitions; rows at its last instant also add the later partitions' rows at that
  same instant (peers share a RANGE sum);
* sums over runs: only a partition's first and last run can go on elsewhere.

Carrying is associative, so one pass over the partitions in order (a prefix scan)
composes it. A partition is one row of edge values: the driver holds as many rows as
there are partitions, never more, and sends them back as a broadcast of that bound.

There is one path for all keys: no profile of key sizes, no threshold. The dealt
rows are written once to the shared folder, as partition numbers must be the
same in every later reading; so a source is read twice (the sample, the write).
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from watchpath.session import materialize

PART = "_part"
TIE = "_tie"
#: Columns that dealt rows carry besides their own.
DEALT = [PART, TIE]


def deal(df: DataFrame, keys, order, tiebreak=(), parts: int | None = None, name: str = "dealt") -> DataFrame:
    """``df`` written in range partitions of (keys, order), with ``_part`` and ``_tie``.

    ``tiebreak`` columns, then a hash of the row, order rows of one instant, so that LAGs are
    reproducible and an instant can be cut. ``parts``: the number of ranges
    (default: ``spark.sql.shuffle.partitions``). Rows already dealt are returned as they are.
    """
    if PART in df.columns:
        return df
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tied = df.withColumn(TIE, F.xxhash64(*[F.col(c) for c in df.columns]))
    ranged = tied.repartitionByRange(n, *[F.col(c) for c in (*keys, *order, *tiebreak, TIE)])
    return materialize(ranged.withColumn(PART, F.spark_partition_id()), name)


def together(df: DataFrame, keys) -> DataFrame:
    """Dealt rows with each (partition, key) in one task; serves all windows of the key."""
    return df.repartition(PART, *keys)


def _key(names) -> Column:
    return F.struct(*[F.col(c) for c in names])


def _broadcast_rows(df: DataFrame, rows: list[dict], schema: T.StructType) -> DataFrame:
    """Edge rows (one per partition, and kind) for a join: their number has that bound."""
    return F.broadcast(df.sparkSession.createDataFrame([tuple(r[f.name] for f in schema.fields) for r in rows], schema))


def _tails(df: DataFrame, keys, at, lags, by=()) -> DataFrame:
    """Per partition (and kind): ``_carry``, the key and the values of the last row before it."""
    tails = (df.groupBy(PART, *by)
             .agg(F.max_by(F.struct(_key(keys).alias("key"), *[F.col(src).alias(name) for name, src in lags]),
                           _key([*keys, *at])).alias("last"))
             .orderBy(PART).collect())
    before, rows = {}, []
    for r in tails:
        kind = tuple(r[c] for c in by)
        if kind in before:
            rows.append({PART: r[PART], **{c: r[c] for c in by}, "_carry": before[kind]})
        before[kind] = r["last"]
    kinds = dict(df.select(*keys, *by, *dict.fromkeys(src for _, src in lags)).dtypes)
    carry = ("struct<key:struct<" + ",".join(f"`{c}`:{kinds[c]}" for c in keys) + ">,"
             + ",".join(f"`{name}`:{kinds[src]}" for name, src in lags) + ">")
    schema = f"{PART} int," + "".join(f"`{c}` {kinds[c]}," for c in by) + f"_carry {carry}"
    return _broadcast_rows(df, rows, T._parse_datatype_string(schema))


def _own_lags(lags, window) -> list[Column]:
    return [*[F.lag(src).over(window).alias(f"_l_{name}") for name, src in lags],
            F.lag(F.lit(1)).over(window).isNull().alias("_first")]


def _fixed_lags(lags, keys) -> list[Column]:
    goes_on = F.col("_first") & F.col("_carry").isNotNull() & F.col("_carry.key").eqNullSafe(_key(keys))
    return [F.when(goes_on, F.col(f"_carry.{name}")).otherwise(F.col(f"_l_{name}")).alias(name) for name, _ in lags]


def carried_lags(df: DataFrame, keys, order, lags, by=(), tiebreak=()) -> DataFrame:
    """``lags`` (name, source column) over (keys, by) by order, as new columns of dealt rows.

    ``by``: columns of few values (kinds of rows) that split the key.
    """
    keys, by, at = list(keys), list(by), [*order, *tiebreak, TIE]
    own = df.select("*", *_own_lags(lags, Window.partitionBy(PART, *keys, *by).orderBy(*at)))
    joined = own.join(_tails(df, keys, at, lags, by), [PART, *by], "left")
    return joined.select(*df.columns, *_fixed_lags(lags, keys))


class Bounds:
    """First and last (key, instant) of each partition of dealt rows: one row per partition, on the driver."""

    def __init__(self, dealt: DataFrame, keys, order):
        self.keys, self.order = list(keys), list(order)
        found = dealt.groupBy(PART).agg(F.min(self.place()).alias("_lo"), F.max(self.place()).alias("_hi"))
        rows = found.orderBy(PART).collect()
        self.of = {r[PART]: r for r in rows}
        self._table = F.broadcast(dealt.sparkSession.createDataFrame(rows, found.schema))

    def place(self) -> Column:
        return F.struct(_key(self.keys).alias("key"), _key(self.order).alias("at"))

    def marked(self, df: DataFrame) -> DataFrame:
        """Adds where a row stands in its partition: of its first or last key, at its first or last instant."""
        place, key = self.place(), _key(self.keys)
        return df.join(self._table, PART).select(
            *df.columns, (key == F.col("_lo.key")).alias("_in_lo"), (key == F.col("_hi.key")).alias("_in_hi"),
            (place == F.col("_lo")).alias("_at_lo"), (place == F.col("_hi")).alias("_at_hi"))

    def with_sums(self, rows) -> list[dict]:
        """Rows of sums per partition, in order, with its bounds as lo and hi."""
        return [{**r.asDict(), "lo": self.of[r[PART]]["_lo"], "hi": self.of[r[PART]]["_hi"]}
                for r in sorted(rows, key=lambda r: r[PART])]


def _scan(rows, names) -> tuple[dict, dict]:
    """Per partition: sums of its first key's rows in earlier partitions, and of later rows at its last instant."""
    before, extra = {}, {}
    done = defaultdict(lambda: dict.fromkeys(names, 0))       # of the key so far
    for r in rows:
        before[r[PART]] = dict(done[r["lo"]["key"]])
        for name in names:
            done[r["hi"]["key"]][name] += r[f"tail_{name}"] or 0
    later = defaultdict(lambda: dict.fromkeys(names, 0))      # at the instant, behind this partition
    for r in reversed(rows):
        extra[r[PART]] = dict(later[r["hi"]])
        for name in names:
            later[r["lo"]][name] += r[f"first_{name}"] or 0
    return before, extra


def carried_sums(df: DataFrame, keys, order, running, totals=(), dealt: DataFrame | None = None) -> DataFrame:
    """Running sums (default RANGE frame: peers share theirs) and totals of keys, as new columns of dealt rows.

    ``running``, ``totals``: (name, non-null integer or double Column); names are unique over both. ``dealt``: the table
    that ``df`` is a part of, if bounds are cheaper to take there.
    """
    keys, sums = list(keys), [*running, *totals]
    bounds = Bounds(df if dealt is None else dealt, keys, order)
    edged = bounds.marked(df)
    rows = bounds.with_sums(edged.groupBy(PART).agg(*[
        F.sum(F.when(F.col(where), expr)).alias(f"{side}_{name}") for name, expr in sums
        for side, where in (("head", "_in_lo"), ("tail", "_in_hi"), ("first", "_at_lo"))]).collect())
    before, extra = _scan(rows, [n for n, _ in sums])
    whole = defaultdict(lambda: dict.fromkeys([n for n, _ in totals], 0))
    for r in rows:
        for name, _ in totals:
            whole[r["lo"]["key"]][name] += r[f"head_{name}"] or 0
            if r["hi"]["key"] != r["lo"]["key"]:
                whole[r["hi"]["key"]][name] += r[f"tail_{name}"] or 0
    window, key = Window.partitionBy(PART, *keys).orderBy(*order), Window.partitionBy(PART, *keys)
    own = edged.select("*", *[F.sum(expr).over(window).alias(n) for n, expr in running], *[F.sum(expr).over(key).alias(n) for n, expr in totals])
    kinds = dict(own.dtypes)
    number = {n: float if kinds[n] in ("double", "float") else int for n, _ in sums}
    out = [{PART: r[PART],
            **{f"_b_{n}": number[n](before[r[PART]][n]) for n, _ in running},
            **{f"_e_{n}": number[n](extra[r[PART]][n]) for n, _ in running},
            **{f"_lo_{n}": number[n](whole[r["lo"]["key"]][n]) for n, _ in totals},
            **{f"_hi_{n}": number[n](whole[r["hi"]["key"]][n]) for n, _ in totals}} for r in rows]
    fields = [f"_b_{n} {kinds[n]},_e_{n} {kinds[n]}" for n, _ in running] + [f"_lo_{n} {kinds[n]},_hi_{n} {kinds[n]}" for n, _ in totals]
    carry = _broadcast_rows(df, out, T._parse_datatype_string(",".join([f"{PART} int", *fields])))
    return own.join(carry, PART, "left").select(
        *df.columns,
        *[(F.col(n) + F.when(F.col("_in_lo"), F.col(f"_b_{n}")).otherwise(F.lit(0)) + F.when(F.col("_at_hi"), F.col(f"_e_{n}"))
           .otherwise(F.lit(0))).cast(kinds[n]).alias(n) for n, _ in running],
        *[F.when(F.col("_in_lo"), F.col(f"_lo_{n}")).when(F.col("_in_hi"), F.col(f"_hi_{n}")).otherwise(F.col(n)).cast(kinds[n]).alias(n)
          for n, _ in totals])


def carried_runs(df: DataFrame, keys, order, heads: Column, amount: Column, run: str, total: str,
                 dealt: DataFrame | None = None, lags=(), tiebreak=()) -> DataFrame:
    """Run ids and run sums (and LAGs of the key) of dealt rows: ``run`` counts ``heads`` (0 or 1) up to a row's instant (RANGE frame),
    ``total`` is the sum of ``amount`` (nulls skipped; null if all are) over the key's rows with that id.

    The windows run once, on ids that count from the partition's start; these rows are written, and
    their edges (a row per partition) give the offsets and the sums of runs that go on.
    """
    keys = list(keys)
    bounds = Bounds(df if dealt is None else dealt, keys, order)
    edged = bounds.marked(together(df, keys))
    at = [*order, *tiebreak, TIE]
    ids = edged.select("*", F.sum(heads).over(Window.partitionBy(PART, *keys).orderBy(*order)).cast("long").alias(run),
                       *(_own_lags(lags, Window.partitionBy(PART, *keys).orderBy(*at)) if lags else ()))
    # rows at the last instant can belong to a later run than the rows before them with this id
    local = Window.partitionBy(PART, *keys, run, "_at_hi")
    written = materialize(ids.select("*", amount.alias("_amount"), F.sum(amount).over(local).alias(total)), "runs")
    own_runs = written.groupBy(PART).agg(F.min(F.when(F.col("_in_lo"), F.col(run))).alias("_lo_run"),
                                         F.max(F.when(F.col("_in_hi") & ~F.col("_at_hi"), F.col(run))).alias("_hi_run"))
    amounts = lambda where: F.sum(F.when(where, F.col("_amount")))
    begins = F.col("_in_lo") & (F.col(run) == F.col("_lo_run")) & ~F.col("_at_hi")
    ends = F.col("_in_hi") & (F.col(run) == F.col("_hi_run")) & ~F.col("_at_hi")
    rows = bounds.with_sums(written.join(F.broadcast(own_runs), PART).groupBy(PART).agg(       # one row per partition
        F.first("_lo_run").alias("lo_run"), F.first("_hi_run").alias("hi_run"),
        F.max(F.when(F.col("_at_hi"), F.col(run))).alias("last_run"),
        F.sum(F.when(F.col("_in_hi"), heads)).alias("tail_n"), F.sum(F.when(F.col("_at_lo"), heads)).alias("first_n"),
        amounts(begins).alias("begins"), amounts(ends).alias("ends"), amounts(F.col("_at_hi")).alias("at_hi")).collect())
    before, extra = _scan(rows, ["n"])
    sums: dict = {}
    edges = []
    for r in rows:
        one_key, lo_key, hi_key = r["lo"]["key"] == r["hi"]["key"], r["lo"]["key"], r["hi"]["key"]
        first = before[r[PART]]["n"]
        hi_first = first if one_key else 0
        places = {name: None if of is None else (key, of + offset) for name, key, of, offset in (
            ("begins", lo_key, r["lo_run"], first), ("ends", hi_key, r["hi_run"], hi_first),
            ("at_hi", hi_key, r["last_run"], hi_first + extra[r[PART]]["n"]))}
        for name, place in places.items():
            same_rows = name == "ends" and one_key and r["lo_run"] == r["hi_run"]
            if place is not None and r[name] is not None and not same_rows:
                sums[place] = sums.get(place, 0) + r[name]
        edges.append((r, first, places))
    kind = dict(written.dtypes)[total]
    carry = _broadcast_rows(df, [
        {PART: r[PART], "_lo_run": r["lo_run"], "_hi_run": r["hi_run"], "_b": first, "_e": extra[r[PART]]["n"],
         **{f"_t_{name}": sums.get(key) for name, key in places.items()}} for r, first, places in edges],
        T._parse_datatype_string(f"{PART} int,_lo_run long,_hi_run long,_b long,_e long,"
                                 + ",".join(f"_t_{n} {kind}" for n in ("begins", "ends", "at_hi"))))
    joined = written.join(carry, PART, "left")
    offset = F.when(F.col("_in_lo"), F.col("_b")).otherwise(F.lit(0)) + F.when(F.col("_at_hi"), F.col("_e")).otherwise(F.lit(0))
    if lags:
        joined = joined.join(_tails(written, keys, at, lags), PART, "left")
    return joined.select(*df.columns, *(_fixed_lags(lags, keys) if lags else ()), (F.col(run) + offset).alias(run),
                         F.when(F.col("_at_hi"), F.col("_t_at_hi")).when(begins, F.col("_t_begins")).when(ends, F.col("_t_ends"))
                         .otherwise(F.col(total)).alias(total))
