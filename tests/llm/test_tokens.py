"""Packing and token counts against the libraries."""

import array
import random
from functools import reduce

import pytest

from watchpath.llm import packing, token_counts
from watchpath.llm.queries import tokenizer_path

WORDS, PIECES = tokenizer_path("word_bpe_49k.json"), tokenizer_path("piece_bpe_32k.model")


def texts(n):
    rng = random.Random(n)
    parts = ["ab", "aA \n", "the an", "  ▁a", "<s><unk><0x41>", "ñéß日本🎉 \u0000x", "0123. ,", "=-_* ", "\t\r a", "İΣ é'll don't",
             "<|endoftext|>", "\x1c\x85 ²½", "etaoin shrdlu"]
    return ["".join(rng.choice(rng.choice(parts)) if rng.random() < 0.6 else rng.choice(parts) for _ in range(rng.randint(0, 25)))
            for _ in range(n)]


def test_word_tokens_equal_the_library():
    from tokenizers import Tokenizer

    whole, ours = Tokenizer.from_file(WORDS), packing.WordTokens(WORDS)
    for text in texts(3000):
        assert list(array.array("I", ours.ids(text))) == whole.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("chunk", [3, 1 << 16])
def test_transducer_equals_the_library(chunk):
    import sentencepiece

    whole, ours = sentencepiece.SentencePieceProcessor(model_file=PIECES), token_counts.counter(PIECES)
    for text in [*texts(3000), "a" * 200, " " * 90, "= " * 40]:
        assert ours.count(text, chunk) == len(whole.encode(text)), repr(text)


@pytest.mark.parametrize("chunk", [3, 17])
def test_chunk_maps_compose_in_any_grouping(chunk):
    import sentencepiece

    whole, ours = sentencepiece.SentencePieceProcessor(model_file=PIECES), token_counts.counter(PIECES)
    wrong = 0
    for text in [*texts(800), "a" * 200, " " * 90, "= " * 40, "ñ" * 50, "日本" * 200]:
        maps = [ours.chunk_map(part, before) for _, before, part in token_counts.chunks(text, chunk)]
        wrong += sum(a.end != b.guess for a, b in zip(maps, maps[1:], strict=False))
        for fan in (2, 5, 1000):                 # levels of a scan, and one fold
            level = maps
            while len(level) > 1:
                level = [reduce(ours.compose, level[i: i + fan]) for i in range(0, len(level), fan)]
            assert sum(m.head_tokens + m.fixed for m in level) == len(whole.encode(text)), repr(text)
    assert wrong                                 # wrongly supposed states occurred and were read again


def test_states_cleared_inside_a_text(monkeypatch):
    import sentencepiece

    whole = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    ours = token_counts.Counter(token_counts.counter(PIECES).machine._ranks)
    monkeypatch.setattr(token_counts, "MAX_STATES", 50)
    monkeypatch.setattr(token_counts, "MAX_TESTED", 50)
    monkeypatch.setattr(token_counts, "MEMO_BYTES", 5_000)
    text = " ".join(f"w{i * 7919 % 100003}xé日" for i in range(3000)) + "x" * 300
    assert ours.count(text) == ours.count(text, 100) == len(whole.encode(text))
    assert len(ours._words._young) + len(ours._words._old) < 100 and len(ours.machine._states) <= 51


def test_long_texts_are_counted_in_chunks_by_many_tasks(spark, edge, nothing):
    import sentencepiece

    whole = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    more = spark.createDataFrame([(20, "日本語" * 900, "ja", "z", 0, "x", 1.0), (21, " " * 500 + "a" * 700, "en", "z", 0, "x", 1.0),
                                  (21, " " * 500 + "a" * 700, "en", "z", 0, "x", 1.0)], edge.schema)
    table = edge.union(more)
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit)
                 for r in token_counts.token_counts(table, PIECES, long=20, chunk=50, fan=4).collect())
    want = [(r.doc_id or -1, len((r.text or "").encode()), len(whole.encode(r.text or ""))) for r in table.collect()]
    assert got == sorted((*w, w[2] > 4096) for w in want)
    assert token_counts.token_counts(nothing, PIECES, long=20).count() == 0


def test_lengths():
    for n in (1, 2047, 2048, 2049, 7000):
        cut = packing.lengths(n)
        assert sum(cut) == n and all(x & (x - 1) == 0 and x <= 2048 for x in cut) and cut == sorted(cut, reverse=True)


def test_pieces_round_trip(edge, docs, nothing):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(WORDS)
    for table in (edge, docs):
        rows = packing.pieces(table, WORDS).collect()
        assert len({r.sequence_id for r in rows}) == len(rows) and {r.offset for r in rows} == {0}
        buckets = sorted((r.sequence_id, r.length) for r in rows)
        assert [n for _, n in buckets] == sorted(n for _, n in buckets)          # equal lengths lie together
        by = {}
        for r in rows:
            assert len(r.tokens) == 4 * r.length and r.length & (r.length - 1) == 0
            by.setdefault(r.doc_id, {}).setdefault(r.start, r)
        for r in table.collect():
            want = [*whole.encode(r.text or "", add_special_tokens=False).ids, 1]
            got = array.array("I", b"".join(bytes(by[r.doc_id][s].tokens) for s in sorted(by[r.doc_id])))
            assert list(got) == want and by[r.doc_id][0].doc_tokens == len(want)
    assert packing.pieces(nothing, WORDS).count() == 0


def test_token_counts_of_tables(edge, docs, nothing):
    import sentencepiece

    whole = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for table in (edge, docs):
        got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(table, PIECES).collect())
        want = [(r.doc_id or -1, len((r.text or "").encode()), len(whole.encode(r.text or ""))) for r in table.collect()]
        assert got == sorted((*w, w[2] > 4096) for w in want)
    assert token_counts.token_counts(nothing, PIECES).count() == 0
