"""Exact dedup and n-gram join: brute force, edge rows, the parts of their methods."""

import itertools
import random
import re

import numpy as np
import pytest

from watchpath.llm import exact_dedup, ngram_join
from watchpath.llm.components import connected_components

WHITE = "[ \t\n\v\f\r]"


def test_content_table_compares_contents():
    table = exact_dedup.ContentTable()
    for i in range(3000):
        table.add(7, b"%d" % (i % 1500), (0, False, i, i), 1)        # all hashes collide
    assert len(table.counts) == 1500 and set(table.counts) == {2}


def test_exact_groups_on_edge_rows(edge):
    rows = exact_dedup.exact_groups(edge).collect()
    assert len(rows) == edge.count()
    empty = [r for r in rows if r.doc_id in (1, 2, 3)]
    assert {r.keep_id for r in empty} == {3} and [r.doc_id for r in empty if r.kept] == [3]       # most code points
    same = [r for r in rows if r.doc_id in (4, 5, 6)]
    assert {(r.keep_id, r.group_size) for r in same} == {(5, 4)}
    assert sum(r.kept for r in same) == 1                                # one of the repeated rows stays
    assert [r.kept for r in rows if r.doc_id is None] == [True]


def test_small_buckets_give_the_same_groups(edge):
    rows = lambda n: sorted(map(str, exact_dedup.exact_groups(edge, bucket_bytes=n).collect()))
    assert rows(64) == rows(1 << 24)


def test_dropping_copies_keeps_columns(edge, nothing):
    left = exact_dedup.drop_exact_copies(edge)
    assert left.columns == edge.columns and left.dtypes == edge.dtypes
    assert left.count() == 6
    assert exact_dedup.drop_exact_copies(nothing).count() == 0 and exact_dedup.exact_groups(nothing).count() == 0


def gram_set(text):
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.split(f"{WHITE}+", text or "") if w]
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i: i + 5]) for i in range(len(words) - 4))


def brute(rows):
    sets = {i: gram_set(t) for i, t in rows}
    part = {i: i for i in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * len(sets[a] | sets[b]):
            x, y = part[a], part[b]
            part = {i: min(x, y) if p in (x, y) else p for i, p in part.items()}
    return {i: (len(sets[i]), part[i]) for i in sets}


@pytest.mark.parametrize("wide", [2, 24])
def test_join_matches_brute_force(spark, monkeypatch, wide):
    """Copies, near copies at the bound, shared passages; with narrow limits the wide-column path does the work."""
    monkeypatch.setattr(ngram_join, "WIDE", wide)
    monkeypatch.setattr(ngram_join, "HOT", 2 * wide)
    rng = random.Random(wide)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    passage = [word() for _ in range(30)]
    bases = [[word() for _ in range(rng.choice([3, 6, 40, 90]))] for _ in range(6)]
    rows = []
    for i in range(140):
        words = list(rng.choice(bases)) if i % 3 else [word() for _ in range(40)]
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            words[rng.randrange(len(words))] = word()
        if i % 5 == 0:
            words[10:10] = passage
        rows.append((i, " ".join(words).title() if i % 7 == 0 else "\n".join(words)))
    got = ngram_join.ngram_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows)


def test_linked_sets_without_shared_cold_grams_agree_in_a_part():
    rng = np.random.default_rng(5)
    fresh = lambda k: rng.integers(0, 1 << 63, k, dtype=np.uint64)
    met = 0
    for _ in range(3000):
        size = int(rng.integers(1, 120))
        both = fresh(size)
        own = [fresh(int(rng.integers(0, 2 + size // 6))) for _ in range(2)]          # hot, in one set only
        cold = rng.integers(0, 2 + size // 8, 2)
        a, b = (np.unique(np.r_[both, o]) for o in own)
        na, nb = len(a) + int(cold[0]), len(b) + int(cold[1])
        if 100 * size >= 80 * (na + nb - size):
            met += 1
            (x, x_home), (y, y_home) = ngram_join.part_names(a, na), ngram_join.part_names(b, nb)
            assert np.isin(x[x_home], y).any() or np.isin(y[y_home], x).any()
    assert met > 500


def test_shared_passages_do_not_pair_everyone(spark, monkeypatch):
    """Documents of 10 out of 30 shared passages of 40 words, hardly any linked: pairs stay below the documents."""
    rng = random.Random(3)
    passages = [" ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(40)) for _ in range(30)]
    rows = [(i, " ".join(rng.sample(passages, 10))) for i in range(240)]
    for i in (240, 241, 242):                    # linked by hot n-grams: an edited copy of 0, one of 1, one of 240
        words = rows[{240: 0, 241: 1, 242: 240}[i]][1].split()
        words[i % 7 * 40: i % 7 * 40 + 2] = [f"x{i}"]
        rows.append((i, " ".join(words)))
    made = []
    for name in ("agreeing", "_outside"):
        plain = getattr(ngram_join, name)
        monkeypatch.setattr(ngram_join, name, lambda *a, plain=plain: (found := plain(*a), made.append(found.count()))[0])
    got = ngram_join.ngram_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows)
    assert len(made) == 2 and sum(made) < len(rows)


def test_sketches_never_overstate_the_difference():
    rng = np.random.default_rng(8)
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 63, rng.integers(0, 300), dtype=np.uint64))
        b = np.unique(np.r_[a[: rng.integers(0, len(a) + 1)], rng.integers(0, 1 << 63, rng.integers(0, 200), dtype=np.uint64)])
        flips = int(np.bitwise_count((ngram_join.sketch(a) ^ ngram_join.sketch(b)).view(np.uint64)).sum())
        assert flips <= len(np.setxor1d(a, b))


def test_edited_copies_agree_in_a_rare_part_whatever_is_common():
    """Of k + 1 parts with the lowest rank in any common order, sets that differ in k or fewer n-grams share one."""
    rng = np.random.default_rng(9)
    for _ in range(300):
        a = np.unique(rng.integers(0, 1 << 63, rng.integers(20, 200), dtype=np.uint64))
        differ = rng.integers(0, len(a) // 9 + 1)
        b = np.unique(np.r_[a[differ:], rng.integers(0, 1 << 63, rng.integers(0, len(a) // 9 + 1), dtype=np.uint64)])
        if 100 * len(np.intersect1d(a, b)) < 80 * len(np.union1d(a, b)):
            continue
        found = []
        for x in (a, b):
            names, home = ngram_join.part_names(x, len(x))
            at, rare, at_home = 0, set(), set()
            for k in ngram_join.part_steps(len(x), len(x))[0]:
                count = ngram_join.parts_at(k)
                kept = sorted(zip(names[at: at + count].tolist(), home[at: at + count]), key=lambda p: p[0] % 7919)[: k + 1]
                rare |= {p for p, _ in kept}
                at_home |= {p for p, h in kept if h}
                at += count
            assert at == len(names)
            found.append((rare, at_home))
        (x, x_home), (y, y_home) = found
        assert x_home & y or y_home & x


def test_join_on_edge_rows(edge, nothing):
    rows = {r.doc_id: r for r in ngram_join.ngram_components(edge).collect()}
    assert all(rows[i].n_shingles == 0 and rows[i].component_id == i for i in (1, 2, 3))
    assert rows[7].component_id == rows[8].component_id == 7 and rows[6].component_id == 4
    left = ngram_join.drop_near_copies(edge)
    assert left.columns == edge.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 1, 2, 3, 4, 7, 9]
    assert ngram_join.ngram_components(nothing).count() == 0 and ngram_join.drop_near_copies(nothing).count() == 0


def test_bitmaps_never_overstate_the_difference():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 300), dtype=np.uint64))
        b = np.unique(np.r_[a[: rng.integers(0, len(a) + 1)], rng.integers(0, 1 << 63, rng.integers(0, 200), dtype=np.uint64)])
        if len(b):
            assert ngram_join.least_difference(ngram_join.parities(a), ngram_join.parities(b)) <= len(np.setxor1d(a, b))


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(31)} | {100 + i: 100 for i in range(40)}
    none = spark.createDataFrame([], "a long, b long")
    assert connected_components(none).count() == 0
