"""Periodic runs, chat formatting and token alignment against plain versions."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from urllib.parse import urlparse

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from watchpath.llm import periodic_runs, queries, reply_trees, token_alignment
from watchpath.llm.queries import tokenizer_path
from watchpath.llm.recompression import Grammar

SMALL = "/root/testdata/sf0.001"
A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


# --- periodic runs -------------------------------------------------------------

def plain_runs(words):
    """Every maximal stretch that keeps a period, tried one by one; the least period of an extent counts."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            k = i
            while k + q < n and words[k] == words[k + q]:
                k += 1
            if k + q - i >= max(24, 3 * q):
                found.setdefault((i, k + q), q)
            i = max(k, i) + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def words_of(text):
    return (text or "").encode().split()


def test_grammar_extensions():
    rng = random.Random(5)
    for _ in range(300):
        n, kinds = rng.randint(1, 150), rng.choice([1, 2, 3, 9])
        a = [rng.randrange(kinds) for _ in range(n)]
        if rng.random() < 0.5:
            p = rng.randint(1, 9)
            a = [a[i % p] if rng.random() < 0.97 else 5 for i in range(n)]
        i, j = (np.array([rng.randrange(n) for _ in range(40)]) for _ in range(2))
        i, j = i[i != j], j[i != j]
        for x, y, got in zip(i, j, Grammar(np.array(a)).common(i, j), strict=True):
            want = 0
            while max(x, y) + want < n and a[x + want] == a[y + want]:
                want += 1
            assert got == want


@pytest.mark.parametrize("table_words", [64, 1 << 15])
def test_runs_equal_plain_runs(monkeypatch, table_words):
    monkeypatch.setattr(periodic_runs, "_TABLE_WORDS", table_words)
    rng, total = random.Random(6), 0
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(1, 4)):
            n, kinds = rng.randint(0, 300), rng.choice([1, 2, 3, 30])
            a = [rng.randrange(kinds) for _ in range(n)]
            for _ in range(rng.randint(0, 4) if n > 5 else 0):
                s, p = rng.randrange(n), rng.randint(1, n // 4 + 1)
                for i in range(s, rng.randint(s, n)):
                    a[i] = a[s + (i - s) % p] if rng.random() < 0.999 else 77
            texts.append(np.array(a, np.int64))
        for a, got in zip(texts, periodic_runs.runs_of(texts), strict=True):
            want = plain_runs(list(a))
            total += len(want)
            assert [tuple(r) for r in got.tolist()] == sorted(want, key=lambda r: (r[0], r[2]))
    assert total > 50


def test_periodic_runs_of_tables(spark, edge, docs, nothing):
    repeats = spark.createDataFrame([(50, "a b c " * 9, 1), (51, "x " * 24 + "y", 1), (52, "x " * 23, 1), (None, "x\ty " * 40, 1),
                                     (53, "start " + "a b " * 30 + "b a " * 30, 1)], "doc_id long, text string, runs int")
    for table in (edge, docs, repeats):
        got = sorted(((r.doc_id or -1), r.n_words, [tuple(x) for x in r.runs], r.collapsed)
                     for r in periodic_runs.periodic_runs(table).collect())
        want = []
        for r in table.collect():
            words = words_of(r.text)
            runs = sorted(plain_runs(words), key=lambda x: (x[0], x[2])) if len(words) < 5000 else []
            want.append(((r.doc_id or -1), len(words), runs, collapsed([w.decode() for w in words], runs)))
        long = {x[0] for x in want if x[1] >= 5000}                   # too long for the plain version: periods are above n / 3
        assert [g for g in got if g[0] not in long] == sorted(w for w in want if w[0] not in long)
    assert periodic_runs.periodic_runs(nothing).count() == 0


def test_query_of_runs(spark):
    got = {r.doc_id: r for r in queries.op11_recompression_runs(spark, SMALL).collect()}
    some = 0
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        words, h = [w.decode() for w in words_of(r.text)], zlib.crc32(str(r.doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
        runs = sorted(plain_runs(words), key=lambda x: (x[0], x[2]))
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None,) * 3)
        x = got[r.doc_id]
        some += len(runs)
        assert (x.n_runs, x.start, x.length, x.period) == (len(runs), *best)
        assert x.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert x.runs_sha256 == sha("".join(f"{s},{m},{q}\n" for s, m, q in runs))
        assert x.collapsed_sha256 == sha(collapsed(words, runs))
    assert some > 5


# --- chat formatting -----------------------------------------------------------

def chat_row(key, turns, formatted_chars):
    loss = "".join(text for role, text in turns if role == "assistant")
    return (key, len(turns), sha("".join(f"{role}\n{text}\n" for role, text in turns)), len(loss), sha(loss), formatted_chars)


def test_query_of_chat(spark):
    by = defaultdict(list)
    for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect():
        by[r.conv_id].append((r.turn, r.role, r.text or ""))
    want = {k: [t[1:] for t in sorted(v)] for k, v in by.items()}
    want[-1] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    got = {r.conv_id: r for r in queries.op12_reply_tree_chat(spark, SMALL).collect()}
    assert set(got) == set(want)
    for key, turns in want.items():
        assert tuple(got[key]) == chat_row(key, turns, got[key].formatted_chars)
        assert got[key].formatted_chars >= sum(len(r) + len(t) + 20 for r, t in turns)


def test_marks_are_escaped_and_come_back(spark):
    rng = random.Random(8)
    parts = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "\\.", ".", "<", "[", "/s>", "INST]", "a", "$1", "\n", "é🎉", " "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(800)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for r in rows.select("t", reply_trees.escaped(F.col("t")).alias("e")).withColumn(
            "back", reply_trees.unescaped(F.col("e"))).collect():
        assert r.back == r.t and not any(mark in r.e for mark in ("<s>", "</s>", "[INST]", "[/INST]"))


def plain_paths(rows, paths):
    """{(tree, leaf): [ids from the root]} of the best leaves of each tree."""
    nodes = {}
    for tree, node, parent, score in rows:
        old = nodes.get((tree, node))
        nodes[tree, node] = (parent, score or 0.0) if old is None else (
            min((p for p in (old[0], parent) if p is not None), default=None), max(old[1], score or 0.0))
    found = {}
    for tree, node in nodes:
        if any(t == tree and p == node for (t, _), (p, _) in nodes.items()):
            continue
        path, at = [], node
        while at is not None and (tree, at) in nodes and at not in path:
            path.append(at)
            at = nodes[tree, at][0]
        if at is None or (tree, at) not in nodes:
            found.setdefault(tree, []).append((node, path[::-1], sum(nodes[tree, x][1] for x in path) / len(path)))
    out = {}
    for tree, some in found.items():
        best = sorted(some, key=lambda x: (-x[2], -len(x[1]), x[0]))
        out |= {(tree, leaf): path for leaf, path, _ in best[:paths]}
    return out


@pytest.mark.parametrize(("paths", "whole_tree"), [(1, 1000), (2, 10), (None, 1000), (None, 10)])
def test_reply_trees(spark, paths, whole_tree):
    rng, rows = random.Random(9), []
    for tree in range(5):
        for node in range(rng.randint(1, 40)):
            rows.append((tree, node, rng.randrange(node) if node and rng.random() < 0.97 else None, rng.choice([0.0, 0.5, 1.0, None]),
                         rng.choice(["user", "assistant", None]), rng.choice([f"t{node}", None, "", "</s>"]), 7))
    rows += [(8, 1, 2, 1.0, "user", "circle", 7), (8, 2, 1, 1.0, "user", "circle", 7), (8, 3, 99, 1.0, "user", "orphan", 7)]
    rows += [(9, n, n - 1 if n else None, 1.0, "assistant", f"deep{n}", 7) for n in range(70)]
    rows += [(10, 0, None, 1.0, "user", "twice", 7), (10, 0, None, 1.0, "user", "twice", 7)]
    table = spark.createDataFrame(rows, "tree_id long, id long, up long, score double, role string, text string, leaf int")
    found = reply_trees.read_back(reply_trees.conversations(
        table, "tree_id", "id", "up", score="score", paths=paths, whole_tree=whole_tree)).collect()
    want = plain_paths([r[:4] for r in rows], paths)
    assert {(r.tree, r.leaf) for r in found} == set(want) and len(found) == len(want)
    told = defaultdict(list)
    for r in rows:
        told[r[0], r[1]].append((r[4] or "", r[5] or ""))
    for r in found:
        turns = [t for node in want[r.tree, r.leaf] for t in told[r.tree, node]]
        assert [(t.role, t.text) for t in r.turns] == turns
        assert [t.learned for t in r.turns] == [text if role == "assistant" else None for role, text in turns]


def test_chat_edges(spark):
    rows = [(1, 0, "user", None, "x"), (1, 1, "assistant", "", "x"), (1, 1, "assistant", "", "x"), (1, None, None, "first", "x"),
            (None, 0, "user", "no id", "x"), (2, 5, "assistant", "word " * 30_000, "x")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, parent string")

    def chat(df):
        return reply_trees.read_back(reply_trees.conversations(reply_trees.chained(df, "conv_id", "turn"), "conv_id", "message", "parent"))

    got = {r.tree: [(t.role, t.text) for t in r.turns] for r in chat(table).collect()}
    assert got[1] == [("", "first"), ("user", ""), ("assistant", ""), ("assistant", "")]
    assert got[2] == [("assistant", "word " * 30_000)] and got[None] == [("user", "no id")]
    assert chat(table.limit(0)).count() == 0


# --- token alignment -----------------------------------------------------------

@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def plain_alignment(libraries, table):
    """Rows of the query, token by token."""
    lib_a, lib_b = libraries
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    letter = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
    out, links, count = [], [], Counter()
    for r in table:
        text = r.text or ""
        a = lib_a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = lib_b.encode(text) if text else []
        bytes_a = [bytes(letter[c] for c in lib_a.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(lib_b.id_to_piece(i)[3:5], 16)]) if lib_b.is_byte(i) else lib_b.id_to_piece(i).replace("▁", " ").encode()
                   for i in b]
        if not text or {b"".join(bytes_a), b"".join(bytes_b)} != {(" " + text).encode()}:
            out.append([r.doc_id, 0, 0, 0, 0, ""])
            links.append([])
            continue
        ends_a, ends_b = (list(np.cumsum([len(x) for x in some])) for some in (bytes_a, bytes_b))
        pairs, j = [], 0
        for i, end in enumerate(ends_a):
            start = ends_a[i - 1] if i else 0
            while ends_b[j] <= start:
                j += 1
            k = j
            while k < len(b) and (ends_b[k - 1] if k else 0) < end:
                pairs.append((a[i], b[k]))
                k += 1
        groups, x, y = [], 0, 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            u, v = ends_a.index(cut) + 1, ends_b.index(cut) + 1
            groups.append(",".join(map(str, a[x:u])) + "|" + ",".join(map(str, b[y:v])))
            x, y = u, v
        count.update(set(pairs))
        links.append(pairs)
        out.append([r.doc_id, len(a), len(b), len(groups), len(pairs), sha(";".join(groups))])
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    return sorted(((d or -1), *n, sum(count[p] == most[p[0]] for p in pairs), sum(count[p] for p in pairs), s)
                  for (d, *n, s), pairs in zip(out, links, strict=True))


@pytest.mark.parametrize("chunk_bytes", [3000, 8 << 20])
def test_alignment_of_tables(spark, edge, docs, nothing, libraries, monkeypatch, chunk_bytes):
    from .test_tokens import texts

    if chunk_bytes < 10_000:
        monkeypatch.setattr(token_alignment, "CALL_BYTES", 500)
    odd = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*texts(300), " a", "a ", "　 b", "a▁ b", "</s> <s>", "<|endoftext|>"])],
                                "doc_id long, text string, chunk string")
    for table in (odd, edge.filter("text is null or length(text) < 1000"), docs.limit(40)):
        rows = table.collect()
        got = sorted(((r.doc_id if r.doc_id is not None else -1) or -1, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)
                     for r in token_alignment.aligned(table, A, B, chunk_bytes=chunk_bytes).collect())
        assert got == plain_alignment(libraries, rows)
    assert token_alignment.aligned(nothing, A, B).count() == 0


def test_long_texts_align(edge, libraries):
    table = edge.filter("length(text) > 1000")
    for r in token_alignment.aligned(table, A, B).collect():
        text = table.filter(F.col("doc_id") == r.doc_id).first().text
        assert (r.n_a, r.n_b) == (len(libraries[0].encode(" " + text, add_special_tokens=False).ids), len(libraries[1].encode(text)))


def test_chunks_of_a_task_are_in_small_row_groups(spark, docs):
    """Spark holds a row group at once, so it must not have all chunks of a task."""
    texts = [r.text for r in docs.limit(50).collect()]
    texts *= 8_000_000 // sum(map(len, texts)) + 1
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    chunked = token_alignment.chunks(rows, A, B, chunk_bytes=1 << 20)
    metas = [pq.ParquetFile(urlparse(f).path).metadata for f in chunked.inputFiles()]
    groups = [m.row_group(i) for m in metas for i in range(m.num_row_groups)]
    assert sum(g.num_rows for g in groups) > 6
    assert all(g.num_rows == 1 or g.total_byte_size <= 1 << 20 for g in groups) and len(groups) > 1


def test_empty_texts_fill_chunks(spark):
    rows = spark.range(5000, numPartitions=1).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    sizes = [len(r.doc_id) for r in token_alignment.chunks(rows, A, B, chunk_bytes=1 << 18).select("doc_id").collect()]
    assert sum(sizes) == 5000 and max(sizes) <= (1 << 18) // 100
    found = token_alignment.aligned(rows, A, B, chunk_bytes=1 << 18).collect()
    assert sorted(tuple(r) for r in found) == [(i, 0, 0, 0, 0, 0, 0, "") for i in range(5000)]


def test_gallop_is_a_search():
    rng = np.random.default_rng(3)
    for size in (1, 5, 300):
        longer = np.unique(rng.integers(0, 4 * size, size))
        keys = np.unique(rng.integers(0, 4 * size, max(1, size // 3)))
        got = token_alignment.gallop(longer, keys, np.zeros(len(keys), np.int64), np.full(len(keys), len(longer)))
        assert (got == np.searchsorted(longer, keys)).all()
