"""The pipeline's stages against plain versions of what each decides."""

import array
import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from watchpath.llm import exact_dedup, mixing, ngram_join, quality_votes

import corpus_pipeline as cp

from .test_dedup_join import brute

SMALL = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for i, (name, stage) in enumerate(cp.STAGES):
        before = docs
        stage(spark, docs, SMALL).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        counts.append(docs.count())
        if i < 4:
            assert docs.columns == columns, name
        if name == "quality_rules":
            want = {r.doc_id for r in quality_votes.judged(before).collect() if r.kept}
            assert {r.doc_id for r in docs.collect()} == want
        if name == "exact_dedup":
            want = {r.doc_id for r in exact_dedup.exact_groups(before).collect() if r.kept}
            assert {r.doc_id for r in docs.collect()} == want
        if name == "ngram_join":
            want = {r.component_id for r in ngram_join.ngram_components(before).collect()}
            assert {r.doc_id for r in docs.collect()} == want
        if name == "mixing":
            assert {r.doc_id for r in docs.collect()} <= {r.doc_id for r in before.collect()}
    assert counts[1] < counts[0] and counts[2] <= counts[1] and counts[3] <= counts[2] and counts[5] >= counts[4]
    assert cp.ORACLE_SQL is None


def words(text):
    return re.findall(r"[^ \t-\r]+", text or "")


def made_documents():
    """Clean prose of a hot source and others, junk, copies, near copies, a very long text, null and empty texts."""
    draw = random.Random(11)
    vocabulary = ["".join(draw.choices("abcdefghijklmnoprstu", k=draw.randrange(4, 8))) for _ in range(3000)]
    prose = lambda n: " ".join(draw.choices(vocabulary, k=n))
    texts = [prose(draw.randrange(60, 300)) for _ in range(70)]
    texts += [t.replace(" ", "  ", 3) for t in texts[:8]] + [texts[0]] * 12                # copies, some with more blanks
    for t in texts[10:20]:                                                                 # near copies
        w = t.split()
        w[len(w) // 2] = "edited"
        texts.append(" ".join(w))
    texts += ["## $$ || %% " * 40, "BUY NOW!! " * 50, "short text", "a b c d e " * 30, "\n".join(["same line here"] * 40)]
    texts += [prose(30_000), prose(120) + " R&D", None, "", " \t\n"]
    sources = ["hot", "hot", "hot", "b", None, "c", "d"]
    return [(i, t, "en", sources[i % 7], len(t or ""), i, "x", 0.5, None) for i, t in enumerate(texts)]


def ballot(text):
    w, text = words(text), text or ""
    at = defaultdict(list)
    for i in range(len(w) - 2):
        at[tuple(w[i: i + 3])].append(i)
    repeated = len({k for found in at.values() if len(found) > 1 for i in found for k in (i, i + 1, i + 2)})
    n, chars = max(1, len(w)), max(1, sum(map(len, w)))
    lines = [line for line in text.split("\n") if words(line)]
    symbols, bars, shouts = (sum(text.count(c) for c in some) / n for some in ("#*$%&|<>", "|", "!"))
    upper, repeats, length = len(re.findall("[A-Z]", text)) / chars, repeated / n, sum(map(len, w)) / n
    distinct = sum(len(set(w[i: i + 256])) for i in range(0, len(w), 256)) / n
    dups = (len(lines) - len(set(lines))) / max(1, len(lines))
    bad = (symbols > 0.1, symbols > 0.3, bars > 0.1, shouts > 0.3, upper > 0.3, repeats > 0.4, distinct < 0.4, dups > 0.4,
           length > 6.5 or length < 3)
    good = (symbols <= 0.01 and shouts <= 0.05 and upper < 0.15 and repeats < 0.2,
            distinct > 0.5 and repeats < 0.2 and 4 <= length <= 6.5 and symbols <= 0.05)
    return len(w) < 50 or 100 * repeated > 50 * len(w), tuple([-b for b in map(int, bad)] + list(map(int, good)))


def plain_quality(docs):
    """Votes weighed by accuracies that maximise their likelihood, 40 rounds from 0.8."""
    judged = {d[0]: ballot(d[1]) for d in docs}
    logit = lambda p: math.log(p / (1 - p))
    accuracy, share = [0.8] * 11, 0.8
    posterior = lambda v: 1 / (1 + math.exp(-logit(share) - sum(x * logit(a) for x, a in zip(v, accuracy))))
    for _ in range(40):
        q = {i: posterior(v) for i, (_, v) in judged.items()}
        anchor, fresh = 0.02 * len(docs), []
        for j in range(11):
            cast = [(q[i] if v[j] > 0 else 1 - q[i]) for i, (_, v) in judged.items() if v[j]]
            fresh.append(min(0.995, max(0.55, (anchor * 0.8 + sum(cast)) / (anchor + len(cast)))))
        accuracy, share = fresh, min(0.95, max(0.05, sum(q.values()) / len(docs)))
    return [d for d in docs if not judged[d[0]][0] and posterior(judged[d[0]][1]) >= 0.5]


def plain_exact(docs):
    best = {}
    for d in docs:
        key = "".join(words(d[1]))
        best[key] = min(best.get(key, d), d, key=lambda d: (-len(d[1] or ""), d[0]))
    return sorted(best.values())


def plain_near(docs):
    of = brute([(d[0], d[1]) for d in docs])
    return [d for d in docs if of[d[0]][1] == d[0]]


def plain_mix(spark, docs):
    """How often each document is used."""
    sizes, total = Counter(), 0
    size = {d[0]: len(words(d[1])) for d in docs}
    for d in docs:
        sizes[d[3]] += size[d[0]]
    total = Fraction(sum(sizes.values()))
    weight = {s: 1 + i % 3 for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    target = {}
    while weight:
        whole = sum(weight.values())
        capped = [s for s in weight if total * weight[s] > 3 * sizes[s] * whole]
        for s in capped or list(weight):
            target[s] = Fraction(3 * sizes[s]) if capped else total * weight[s] / whole
        for s in capped:
            total -= target[s]
        weight = {s: w for s, w in weight.items() if s not in target}
    taken = {s: math.floor(t) for s, t in target.items()}
    for s in sorted(target, key=lambda s: taken[s] - target[s])[: round(sum(target.values())) - sum(taken.values())]:
        taken[s] += 1
    rows = spark.createDataFrame(list(size.items()), "doc_id long, size long")
    u = {r.doc_id: r.u for r in rows.select("doc_id", F.xxhash64(F.lit(mixing.SEED), "doc_id", "size").alias("u")).collect()}
    uses = {}
    for s in sizes:
        own = sorted((d[0] for d in docs if d[3] == s), key=lambda i: (u[i] % 4096, u[i], i))
        full, gap = divmod(taken[s], sizes[s])
        left = []
        for i in own:
            fits = size[i] <= gap
            uses[i], gap = full + fits, gap - fits * size[i]
            left += [] if fits else [(size[i], u[i], i)]
        if left and min(left)[0] - gap < gap:
            uses[min(left)[2]] += 1
    return {i: n for i, n in uses.items() if n}


def test_run_equals_plain_stages(spark, tmp_path):
    docs = made_documents()
    schema = "doc_id long, text string, lang string, source string, n_chars int, row int, h string, size double, measures string"
    spark.createDataFrame(docs, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = cp.run(spark, str(tmp_path)).collect()

    kept = plain_quality(docs)
    single = plain_exact(kept)
    apart = plain_near(single)
    assert len(docs) > len(kept) > len(single) > len(apart) > 50
    uses = plain_mix(spark, apart)
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    text = {d[0]: d[1] for d in apart}
    pieces, sequences = defaultdict(lambda: defaultdict(list)), defaultdict(list)
    for r in got:
        pieces[r.doc_id][r.start].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert {i: {len(same) for same in starts.values()} for i, starts in pieces.items()} == {i: {n} for i, n in uses.items()}
    for i, starts in pieces.items():
        ids = [*tokenizer.encode(text[i], add_special_tokens=False).ids, 1]
        assert [x for at in sorted(starts) for x in array.array("I", bytes(starts[at][0].tokens))] == ids
        at = 0
        for start in sorted(starts):
            assert start == at and all(r.doc_tokens == len(ids) and r.length == starts[start][0].length for r in starts[start])
            at += starts[start][0].length
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048


def test_run_on_an_empty_table(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars int, row int"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0
