r"""Chat texts from reply trees.

Messages answer other messages of their tree. A path leads from a root to a leaf.

1. Iterative self-joins double each message's pointer to an ancestor until all
   have passed their root: round k knows the ancestor 2^k answers above, and the
   number and summed score of the messages below it. A tree of depth d takes
   log2(d) rounds, each written once, of ids and scores only.
2. A branch's score is the mean score of its messages. The ``paths`` best leaves of
   a tree are chosen (all if None; ties: the longer branch, then the least id).
3. The rounds' pointers, largest first, list each chosen leaf's ancestors, every
   one once. Texts join their places and are put together, a conversation per path.

The template is, for each turn, ``<s>[INST]`` role ``[/INST]`` text ``</s>``. In roles and
texts a backslash is doubled and ``\.`` is put behind the first character of a control
string (``<s>``, ``</s>``, ``[INST]``, ``[/INST]``), so none is left and the change can be undone
(``read_back``). ``loss`` has the span of each learned text (number of the turn, start
and length in code points within its turn): those of ``learned`` roles.

Only DataFrame functions. Trees of up to ``WHOLE_TREE`` messages move once, by tree. Larger
ones are dealt by message and then by path, so that no task gets a tree of
any size; a single conversation is one value.

Cases: a null role or text is an empty one. A parent that is null or not in the
tree makes a root. Repeated rows of one id stand side by side on its place; their
parent is the least and their score the highest. A null id is an id like any other,
as is a null tree. Messages whose parents form a circle lead to no root
and are in no conversation. An empty table gives no rows. Other columns are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from .tables import col, materialize, run_path

#: Messages of a tree that is put together in one task.
WHOLE_TREE = 100_000
#: Large trees are broadcast as a list of up to so many (else joined by a shuffle).
LISTED_TREES = 100_000

#: The template's marks.
TURN, ROLE_END, TURN_END = "<s>[INST]", "[/INST]", "</s>"
_CONTROL = r"(<(?=/?s>)|\[(?=/?INST\]))"


def escaped(c: Column) -> Column:
    return F.regexp_replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), _CONTROL, r"$1\\.")


def unescaped(c: Column) -> Column:
    return F.regexp_replace(c, r"\\(?:(\\)|\.)", "$1")


def chained(rows: DataFrame, tree: str, turn: str, role: str = "role", text: str = "text") -> DataFrame:
    """Messages of conversations without branches: ``rows`` with message and parent, the row before it by
    turn (ties: by role, then text's digest). Nulls come first. Equal rows are one message."""
    message = F.struct(col(turn).alias("turn"), F.coalesce(col(role), F.lit("")).alias("role"),
                       F.md5(F.coalesce(col(text), F.lit("")).cast("binary")).alias("text"))
    order = rows.select(col(tree).alias("tree"), message.alias("message")).distinct()
    before = F.lag("message").over(Window.partitionBy("tree").orderBy("message"))
    return rows.select("*", message.alias("message")).drop("parent"), order.select("tree", "message", before.alias("parent"))


def _written(df: DataFrame, name: str, count: Column) -> tuple[DataFrame, int]:
    """``df`` written and read again, and a count made while writing."""
    path, seen = run_path(df, name), Observation(name)
    df.observe(seen, F.count(F.when(count, 1)).alias("n")).write.parquet(path)
    return df.sparkSession.read.parquet(path), int(seen.get["n"])


def _met(left: DataFrame, right: DataFrame, node: str, how: str = "inner") -> DataFrame:
    """``left`` with the columns of ``right`` (t, p, ...) of the message that ``node`` names."""
    return left.join(right, (F.col("tree") == F.col("t")) & (F.col(node) == F.col("p")), how).drop("t", "p")


def _named(df: DataFrame, node: str, *more: Column | str) -> DataFrame:
    return df.select(F.col("tree").alias("t"), F.col(node).alias("p"), *more)


def _paths(nodes: DataFrame, paths: int | None) -> DataFrame:
    """tree, leaf, node, place (0: the root) of the messages on the chosen paths."""
    first = _met(nodes, _named(nodes, "node", F.lit(True).alias("known")), "parent", "left").select(
        "tree", "node", F.when(F.col("known"), F.col("parent")).alias("up"), F.lit(1).cast("long").alias("n"), F.col("score").alias("s"))
    step, going = _written(first, "reply-step", F.col("up").isNotNull())
    leaves = _met(step, _named(step, "up").filter("p is not null").distinct(), "node", "left_anti").select("tree", "node")
    rounds, done, before = [], step.filter("up is null"), None
    while going and going != before:                     # what stays are circles
        active = step.filter("up is not null")
        rounds.append(active.select("tree", "node", "up"))
        far = _named(active.unionByName(done), "node", F.col("up").alias("far"), F.col("n").alias("fn"), F.col("s").alias("fs"))
        step, left = _written(_met(active, far, "up").select(
            "tree", "node", F.col("far").alias("up"), (F.col("n") + F.col("fn")).alias("n"), (F.col("s") + F.col("fs")).alias("s")),
            "reply-step", F.col("up").isNotNull())
        done = done.unionByName(step.filter("up is null"))
        before, going = going, left
    chosen = _met(leaves, _named(done, "node", "n", (F.col("s") / F.col("n")).alias("mean")), "node")
    if paths is not None:
        best = Window.partitionBy("tree").orderBy(F.desc("mean"), F.desc("n"), "node")
        chosen = chosen.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= paths)
    found = chosen.select("tree", F.col("node").alias("leaf"), "node", (F.col("n") - 1).alias("place"))
    for k in reversed(range(len(rounds))):
        moved = _met(found, _named(rounds[k], "node", "up"), "node").select(
            "tree", "leaf", F.col("up").alias("node"), (F.col("place") - (1 << k)).alias("place"))
        found = materialize(found.unionByName(moved), "reply-paths")
    return found


def conversations(messages: DataFrame | tuple[DataFrame, DataFrame], tree: str, message: str, parent: str, role: str = "role",
                  text: str = "text", score: str | None = None, paths: int | None = 1, learned: tuple[str, ...] = ("assistant",),
                  whole_tree: int = WHOLE_TREE) -> DataFrame:
    """One row per chosen path: tree, leaf, formatted (string), loss (spans; see the module's text).

    ``messages``: rows with their parent; or rows and, apart, a table (tree, message, parent) of their links.
    ``score``: a numeric column (null or none: 0).
    """
    rows, links = messages if isinstance(messages, tuple) else (messages, None)
    key = lambda c: F.struct(c.alias("v"))  # noqa: E731  equal for equal values, nulls too, and itself never null
    value = F.lit(0.0) if score is None else F.coalesce(col(score).cast("double"), F.lit(0.0))
    names = (tree, message, parent) if links is None else ("tree", "message", "parent")
    of, node, up = (col(n) for n in names)
    links = (rows if links is None else links).select(
        key(of).alias("tree"), key(node).alias("node"), F.when(up.isNotNull(), key(up)).alias("parent"), value.alias("score"))
    nodes = materialize(links.groupBy("tree", "node").agg(F.min("parent").alias("parent"), F.max("score").alias("score")), "reply-nodes")
    places = materialize(_paths(nodes, paths), "reply-places")
    large = nodes.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > whole_tree).select("tree")
    large, n = materialize(large, "reply-large", count=True)
    rows = rows.select(key(col(tree)).alias("tree"), key(col(message)).alias("node"), F.coalesce(col(role), F.lit("")).alias("role"),
                       F.coalesce(col(text), F.lit("")).alias("text"))
    if not n:
        return _formatted(_placed(rows, places), learned)
    listed = F.broadcast(large) if n <= LISTED_TREES else large
    side = lambda df, how: df.join(listed.select(F.col("tree").alias("t")), (F.col("tree") == F.col("t")), how)
    usual = _formatted(_placed(side(rows, "left_anti"), side(places, "left_anti")), learned)
    return usual.unionByName(_formatted(side(places, "left_semi").join(side(rows, "left_semi"), ["tree", "node"]), learned))


def _placed(rows: DataFrame, places: DataFrame) -> DataFrame:
    """``rows`` on their places, a row for each; all of a tree in one task, so that nothing moves again by path."""
    kind = lambda df, names: df.select(*[
        F.col(n) if n in df.columns else F.lit(None).cast(dict([*rows.dtypes, *places.dtypes])[n]).alias(n) for n in names])
    names = ["tree", "node", "role", "text", "leaf", "place"]
    both = kind(rows, names).unionByName(kind(places, names)).repartition("tree")
    at = F.collect_list(F.when(F.col("place").isNotNull(), F.struct("leaf", "place"))).over(Window.partitionBy("tree", "node"))
    texts = both.withColumn("at", at).filter("place is null").select("tree", "node", "role", "text", F.explode("at").alias("x"))
    return texts.select("tree", "node", "role", "text", "x.leaf", "x.place")


def _formatted(placed: DataFrame, learned: tuple[str, ...]) -> DataFrame:
    """Conversations of messages on their places."""
    head = F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(ROLE_END))
    teaches = F.col("role").isin(*learned)
    body = escaped(F.col("text"))
    turns = placed.select("tree", "leaf", F.struct(
        "place", F.concat(head, body, F.lit(TURN_END)).alias("turn"),
        F.when(teaches, F.length(head)).alias("start"), F.when(teaches, F.length(body)).alias("length")).alias("x"))
    path = turns.groupBy("tree", "leaf").agg(F.sort_array(F.collect_list("x")).alias("x"))
    spans = F.filter(F.transform("x", lambda x, i: F.struct(i.alias("turn"), x["start"].alias("start"), x["length"].alias("length"))),
                     lambda x: x["start"].isNotNull())
    return path.select(F.col("tree.v").alias("tree"), F.col("leaf.v").alias("leaf"), F.array_join("x.turn", "").alias("formatted"), spans.alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` with turns: array of role, text and learned (the text under the loss mask, null where none), unescaped."""
    pieces = F.split("formatted", TURN_END)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)              # behind the last turn is nothing
    parts = rf"(?s)^<s>\[INST\](.*?)\[/INST\](.*)$"
    masks = F.map_from_entries(F.transform("loss", lambda x: F.struct(x["turn"], x)))
    turns = F.transform("pieces", lambda piece, i: F.struct(
        unescaped(F.regexp_extract(piece, parts, 1)).alias("role"), unescaped(F.regexp_extract(piece, parts, 2)).alias("text"),
        unescaped(F.substring(piece, F.col("masks")[i]["start"] + 1, F.col("masks")[i]["length"])).alias("learned")))
    return formatted.select("*", pieces.alias("pieces"), masks.alias("masks")).select(
        *[col(c) for c in formatted.columns], turns.alias("turns"))
