"""Mixing, classifier, language, votes, URL filter, WARC."""

import base64
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from watchpath.llm import language_id, mixing, quality_votes, rule_ensemble, url_filters, warc
from watchpath.llm.queries import URL_RULES, queries

SMALL, MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def words(text):
    return [w for w in re.split("[ \t\n\v\f\r]+", text or "") if w]


def test_targets_reshare_the_excess():
    got = mixing.targets({"a": 10, "b": 10, "c": 100}, {"a": 10, "b": 1, "c": 1})
    assert got == {"a": 30, "b": 30, "c": 60}
    assert mixing.targets({"a": 0}, {"a": 1}) == {"a": Fraction(0)} and mixing.targets({}, {}) == {}


def test_cheapest_flow_prefers_first_uses():
    a, b, both = frozenset("a"), frozenset("b"), frozenset("ab")
    flow = mixing.cheapest_flow({a: 10, b: 10, both: 10}, {"a": 15, "b": 15})
    assert sum(flow.values()) == 30 and flow == {a: 10, b: 10, both: 10}
    assert mixing.cheapest_flow({a: 10}, {"a": 100}) == {a: 30}                   # at most three uses
    sizes, cost = {a: 4, both: 3}, lambda s, x: sum(k * k * min(max(x - s * k, 0), s) for k in range(3))
    best = min(cost(4, x) + cost(3, y) for x, y in itertools.product(range(13), range(10)) if x + y == 12 and y >= 2)
    got = mixing.cheapest_flow(sizes, {"a": 10, "b": 2})
    assert sum(got.values()) == 12 and cost(4, got[a]) + cost(3, got[both]) == best


def test_mix_meets_its_targets(spark, edge, nothing):
    rows = queries()["op3_flow_mixing"](spark, MID).collect()
    again = queries()["op3_flow_mixing"](spark, MID).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    texts = {r.doc_id: r for r in spark.read.parquet(f"{MID}/documents.parquet").collect()}
    by, size = defaultdict(list), Counter()
    for r in rows:
        assert r["size"] == len(words(texts[r.doc_id].text)) and r.taken <= 3 * r["size"]
        by[texts[r.doc_id].source].append(r)
    for s, own in by.items():
        size[s] = sum(r["size"] for r in own)
        assert {r.source_size for r in own} == {size[s]}
    wanted = mixing.targets(size, mixing.default_weights(list(size)))
    for s, own in by.items():
        assert own[0].target == pytest.approx(float(wanted[s]))
        assert sum(r.taken for r in own) == pytest.approx(float(wanted[s]), rel=0.03)
    assert mixing.mixed_by_source(edge).count() == edge.count()
    assert mixing.mixed_by_source(nothing).count() == 0
    out = mixing.repeated(edge)
    assert out.columns == edge.columns and out.count() > 0


def skewed_sources(spark):
    """500 ordinary documents and one of 200,000 words in "a", one document alone in "solo", many in "z"."""
    draw = random.Random(3)
    rows = [(i, "w " * max(1, int(draw.lognormvariate(5.5, 0.8))), "a") for i in range(500)]
    rows += [(500, "w " * 200_000, "a"), (501, "w " * 1000, "solo")]
    rows += [(1000 + i, "w " * draw.randrange(1, 900), "z") for i in range(500)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_mix_with_a_very_long_document_meets_its_quota(spark):
    docs = skewed_sources(spark)
    # targets: 0.9 of the only document, 0.6 of the long document's source and the rest from the third
    sizes = Counter()
    for r in docs.collect():
        sizes[r.source] += len(words(r.text))
    share = {"solo": 900, "a": int(0.6 * sizes["a"])}
    share["z"] = sum(sizes.values()) - sum(share.values())
    for seed in range(4):
        rows = mixing.mixed(docs, F.array("source"), lambda names: share, seed=seed, keep=F.col("source")).collect()
        assert len(rows) == 1002
        for s in sizes:
            own = [r for r in rows if r.keep == s]
            used = Counter(r.uses for r in own)
            assert max(used) <= 3 and max(used) - min(used) <= 1
            off = sum(r.taken for r in own) - min(share[s], 3 * sizes[s])
            rest = [r["size"] for r in own if r.uses == min(used)]
            assert 2 * abs(off) <= min(rest), (seed, s, off)
        assert next(r.uses for r in rows if r.keep == "solo") == 1


def test_mix_takes_what_fits_in_seeded_order(spark):
    docs = skewed_sources(spark).filter("source = 'a'").union(skewed_sources(spark).filter("source = 'z'"))
    got = mixing.mixed(docs, F.array("source"), seed=5, keep=F.struct(
        "source", F.xxhash64(F.lit(5), "doc_id", F.size(F.split(F.btrim("text"), " ")).cast("long")).alias("u"))).collect()
    for s in ("a", "z"):
        own = sorted((r for r in got if r.keep.source == s), key=lambda r: (r.keep.u % mixing._BINS, r.keep.u, r.doc_id))
        size = sum(r["size"] for r in own)
        full, gap = divmod(round(own[0].target), size)
        want, left = {}, []
        for r in own:
            fits = r["size"] <= gap
            want[r.doc_id] = full + fits
            gap -= fits * r["size"]
            left += [] if fits else [(r["size"], r.keep.u, r.doc_id)]
        if left and min(left)[0] - gap < gap:
            want[min(left)[2]] += 1
        assert {r.doc_id: r.uses for r in own} == want


def test_rule_ensemble(spark, edge, nothing):
    rows = queries()["op4_rule_quality"](spark, MID).collect()
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{MID}/labels.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1}
    known = [r for r in held if r.doc_id in label]
    assert sum(r.predicted == label[r.doc_id] for r in known) / len(known) > 0.95
    none = spark.createDataFrame([(None, 1), (4, None)], "doc_id long, label int")
    got = rule_ensemble.classified(edge, none).collect()
    assert len(got) == edge.count() and {r.score for r in got} == {0.5}
    assert rule_ensemble.classified(nothing, none).count() == 0
    path = rule_ensemble.tree_paths("x\n  If (feature 0 <= 1.5)\n   Predict: 0.0\n  Else (feature 0 > 1.5)\n   Predict: 1.0", ["n"])
    assert path == {(("n", False, 1.5),), (("n", True, 1.5),)}


def test_language(spark, edge, nothing):
    rows = queries()["op7_compression_language"](spark, MID).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{MID}/documents.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.95
    contents = language_id.dictionaries(edge)
    got = {r.doc_id: r for r in language_id.identified(edge, contents).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1, 2, 3)) and got[4].lang_pred == "en"
    assert language_id.dictionaries(nothing) == {} and language_id.identified(nothing, contents).count() == 0


def test_dictionaries_go_on_in_long_training_texts(spark):
    texts = [" ".join(f"{'abc'[i]}{n:x}".translate(str.maketrans("0123456789", "ghijklmnop")) for n in range(35_000))
             for i in range(3)]
    short = [(10 + i, "short words only, 12 of 34", "xx") for i in range(5)]
    rows = [(i, t, "la") for i, t in enumerate(texts)] + short + [(20, "1 2 3 " * 9000 + "last", "yy"), (21, "", "yy")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language_id.dictionaries(docs)
    assert 0.98 * language_id.DICT_BYTES <= len(got["la"]) <= language_id.DICT_BYTES
    held = set(got["la"].decode().split())
    for t in texts:
        w = t.split()
        assert all(len(held & set(w[k:k + 7000])) > 500 for k in range(0, 35_000, 7000))     # of every part of each text
    assert got["xx"] == b" ".join([b"short words only of"] * 5) and got["yy"].strip() == b"last"


def brute_measures(text):
    text = text or ""
    w = words(text)
    seen = defaultdict(list)
    for i in range(len(w) - 2):
        seen[tuple(w[i: i + 3])].append(i)
    covered = {k for at in seen.values() if len(at) > 1 for i in at for k in (i, i + 1, i + 2)}
    lines = [line for line in text.split("\n") if words(line)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_votes_match_brute_force(spark, edge, docs, nothing):
    odd = [(20, "a b c a b c"), (21, "x x x x x"), (22, "p\n p\np\nq\n\n"), (23, "a b c d a b c a b")]
    table = edge.select("doc_id", "text").union(docs.select("doc_id", "text")).union(spark.createDataFrame(odd, "a long, b string"))
    got = sorted((r.doc_id or -1, *(r[c] for c in quality_votes.BASE)) for r in quality_votes.judged(table).collect())
    assert got == sorted((r.doc_id or -1, *brute_measures(r.text)) for r in table.collect())
    for r in quality_votes.judged(table).collect():
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and r.posterior >= 0.5)
    assert quality_votes.judged(nothing).count() == 0
    left = quality_votes.keep_good(edge)
    assert left.columns == edge.columns and all(len(words(r.text)) >= 50 for r in left.collect())


def test_votes_separate_labelled_rows(spark):
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{MID}/labels.parquet").collect()}
    rows = [r for r in queries()["op10_quality_votes"](spark, MID).collect() if r.doc_id in label and not r.base_failed]
    assert sum(r.kept == bool(label[r.doc_id]) for r in rows) / len(rows) > 0.97


def test_votes_keep_long_clean_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "lang", "text")
    clean = docs.join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet").filter("quality = 1").select("doc_id"), "doc_id")
    texts = [r.text for r in clean.filter("lang = 'en'").dropDuplicates(["text"]).orderBy("doc_id").collect()]
    long = []
    for i, least in enumerate((30_000, 100_000)):
        w = list(itertools.islice(itertools.chain.from_iterable(map(words, texts)), least))
        assert len(w) == least
        long += [(-1 - 2 * i, " ".join(w)), (-2 - 2 * i, " ".join([*w[:40], "R&D", *w[40:900], "5%", *w[900:]]))]
    spam = (-9, " ".join(words(texts[0])[:40] * 750))
    table = docs.select("doc_id", "text").union(spark.createDataFrame([*long, spam], "doc_id long, text string"))
    got = {r.doc_id: r for r in quality_votes.judged(table).filter("doc_id < 0").collect()}
    assert len(got) == 5 and all(got[i].kept and not got[i].base_failed for i in (-1, -2, -3, -4)), got
    assert not got[-9].kept


def test_votes_count_distinct_words_by_span(spark):
    n = quality_votes.SPAN
    rows = ["", "a", " ".join(["x"] * n), " ".join(["x"] * (n + 1)), " ".join(f"w{i % 300}" for i in range(3 * n + 7))]
    want = [sum(len(set(words(t)[i:i + n])) for i in range(0, len(words(t)), n)) for t in rows]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert [r.n for r in quality_votes.measured(docs, "m").orderBy("doc_id").select(F.col("m.n_distinct").alias("n")).collect()] == want


def test_expectation_maximisation_prefers_agreeing_rules():
    model = quality_votes.fitted([((1, 1, 1), 60), ((-1, -1, 1), 30), ((1, 1, -1), 5), ((-1, -1, -1), 5)], 3)
    assert model.accuracy[0] > model.accuracy[2]
    assert quality_votes.fitted([], 2).accuracy == (quality_votes.FIRST,) * 2


PAGES = [
    (1, "https://a.example.org/es/x", ""), (2, "https://EXAMPLE.org/en/12?q", None), (3, "http://b.com/fr/", ""), (4, None, "x"),
    (5, "no scheme", ""), (6, "https://alias.net/p", '<link rel="canonical" href="https://x.example.org/es/y">'),
    (7, "https://alias.net/q", '<META http-equiv="refresh" content="0; url=/p">'),
    (8, "https://both.net/", '<link href=https://alias.net/q rel=canonical><link rel="canonical" href="https://ok.org/">'),
    (9, "https://far.net/", "<a href='https://x.example.org/es/y'>"), (9, "https://far.net/", ""),
]


def test_url_filter(spark):
    pages = spark.createDataFrame([(*p, "extra") for p in PAGES], "page_id long, url string, html string, host string")
    rows = {r.page_id: r for r in url_filters.judged(pages, URL_RULES).collect()}
    assert (rows[1].rule, rows[1].verdict) == ("example.org/es/", "block")
    assert (rows[2].host, rows[2].path, rows[2].rule) == ("example.org", "/en/12", "example.org/en/1")
    assert rows[3].verdict == "allow" and rows[9].verdict == "allow" and rows[9].rule is None
    assert (rows[4].host, rows[4].path, rows[4].rule, rows[5].host) == ("", "", None, "")
    assert {rows[i].verdict for i in (6, 7, 8)} == {"allow"}            # one alias is explicitly allowed
    blocked = {r.page_id: r.verdict for r in url_filters.judged(pages.filter("page_id <> 8"), URL_RULES).collect()}
    assert (blocked[6], blocked[7], blocked[9]) == ("block", "block", "allow")
    assert url_filters.judged(pages.limit(0), URL_RULES).count() == 0


def test_warc_round_trip(spark):
    big = "x" * (17 << 20)
    rows = [(1, "u", "same"), (2, "u\nv%", "same"), (2, "w", "same"), (3, None, None), (4, "z", ""), (5, "y", "é\r\n\r\nö"),
            (None, "n", "same"), (6, "b", big)]
    pages = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, size int")
    got = warc.archived(pages).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r.page_id].append(r)
    assert [r.record_type for r in by[2]] == ["response"] * 2 and {r.url for r in by[2]} == {"u\nv%", "w"}
    assert (by[1][0].record_type, by[1][0].refers_to, by[1][0].payload_bytes, by[1][0].payload) == ("revisit", 2, 4, None)
    assert (by[None][0].record_type, by[None][0].refers_to) == ("revisit", 2)
    assert (by[3][0].refers_to, by[4][0].record_type, by[4][0].payload_bytes) == (4, "response", 0)
    assert bytes(by[5][0].payload).decode() == rows[5][2] and by[6][0].payload_bytes == len(big)
    assert by[5][0].payload_digest == base64.b32encode(hashlib.sha1(rows[5][2].encode()).digest()).decode()
    assert warc.archived(pages.limit(0)).count() == 0


def test_warc_reader_sees_damage():
    good = warc.record(1, "u", b"payload")
    assert [r.block[-7:] for r in warc.Members(good + warc._EMPTY + good)] == [b"payload"] * 2
    for bad in (good[:-9], good + b"junk"):
        with pytest.raises((ValueError, zlib.error)):
            list(warc.Members(bad))
    wrong = warc.Record({**next(iter(warc.Members(good))).headers, "warc-block-digest": "sha1:x"}, b"")
    with pytest.raises(ValueError):
        warc._verified(wrong)


def test_archives_are_bounded_by_bytes(spark, tmp_path):
    rows = [(i, f"https://a.org/{i}", f"page {i} " + "".join(chr(97 + (i * j * j) % 26) for j in range(600))) for i in range(200)]
    rows += [(200, "https://a.org/long", "".join(chr(33 + (j * j * j) % 93) for j in range(60_000))), (201, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2)
    path, bound = f"{tmp_path}/archive", 8_000
    warc.write_archives(pages, path, file_bytes=bound)
    files = list((tmp_path / "archive").rglob("*.txt"))
    counts = [sum(1 for _ in warc.Members(f.read_bytes())) for f in files]
    assert sum(counts) == len(rows) and len(files) >= sum(f.stat().st_size for f in files) / bound > 5
    assert all(f.stat().st_size <= bound or n == 1 for f, n in zip(files, counts, strict=True))
    got = {r.page_id: bytes(r.payload).decode() for r in warc.read_archives(spark, path).collect()}
    assert got == {i: html or "" for i, _, html in rows}


def test_urls_without_a_name_get_no_alias(spark):
    link = '<link rel="canonical" href="http://blocked.example.org/es/x">'
    pages = [(1, "http://alias.net/a", link), (2, "http://alias.net/a", None), (3, None, link), (4, "no name", link), (5, "", None)]
    pages += [(10 + i, None, None) for i in range(50)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    rows = {r.page_id: (r.host, r.verdict) for r in url_filters.judged(df, URL_RULES).collect()}
    assert rows[1] == rows[2] == ("alias.net", "block")
    assert len(rows) == 55 and all(rows[i] == ("", "allow") for i in rows if i > 2)


def test_very_long_html(spark):
    html = "x" * 3_000_000 + '<link rel="canonical" href="http://blocked.example.org/es/x">'
    df = spark.createDataFrame([(1, "http://alias.net/a", html)], "page_id long, url string, html string")
    assert url_filters.judged(df, URL_RULES).collect()[0].verdict == "block"
