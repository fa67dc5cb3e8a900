"""Memory bounds of memos and tables."""

from pyspark.sql import functions as F

from watchpath.llm import exact_dedup, packing
from watchpath.llm.queries import tokenizer_path


def test_memo_of_one_long_text_is_bounded(monkeypatch):
    monkeypatch.setattr(packing, "MEMO_BYTES", 50_000)
    tokens = packing.WordTokens(tokenizer_path("word_bpe_49k.json"))
    text = " ".join(f"w{i}x" for i in range(5000)) + " " + "y" * 500
    ids = tokens.ids(text)
    assert sum(len(w) + len(v) + 180 for half in (tokens._young, tokens._old) for w, v in half.items()) <= 2 * 50_000 + 400
    assert "y" * 500 not in tokens._young and ids == packing.WordTokens(tokenizer_path("word_bpe_49k.json")).ids(text)


def test_short_contents_count_their_entries(spark, monkeypatch):
    table = exact_dedup.ContentTable()
    for i in range(1000):
        table.add(i, b"x%d" % i, (0,), 1)
    assert table.size >= 1000 * exact_dedup.ENTRY_BYTES
    rows = spark.range(4000).selectExpr("id * 2305843009213693 as h", "10L as size")
    assert exact_dedup.bucket_bits(rows, 100_000) >= 4                  # 4000 entries do not fit one table


def test_dropping_copies_holds_few_rows(spark, edge, docs, monkeypatch):
    """Tables that are emptied often, and buckets that settle often, give the same rows."""
    for table in (edge, docs):
        want = sorted(map(str, exact_dedup.drop_exact_copies(table).collect()))
        kept = [r for r in exact_dedup.exact_groups(table).collect() if r.kept]
        assert len(want) == len(kept)
        small = sorted(map(str, exact_dedup.drop_exact_copies(table, bucket_bytes=3000).collect()))
        assert small == want


def test_best_settles_without_losing_rows():
    import pyarrow as pa

    best, one = exact_dedup.Best(), exact_dedup.BUCKET_BYTES
    exact_dedup.BUCKET_BYTES = 100
    try:
        for i in range(50):
            text = b"t%d " % (i % 7) * 3
            best.add(pa.RecordBatch.from_pydict({"text": pa.array([text], pa.binary()), "points": pa.array([10 + (i == 30)], pa.int64()),
                                                 "id": pa.array([i], pa.int64()), "row": pa.array([i], pa.int64())}))
            best.settle()
        rows = [r for b in best.out() for r in b.to_pylist()]
    finally:
        exact_dedup.BUCKET_BYTES = one
    assert sorted(r["id"] for r in rows) == [0, 1, 3, 4, 5, 6, 30]


def test_rows_leave_in_small_batches():
    """Little content in much white space: what is sent on is bounded by bytes, not by rows."""
    import pyarrow as pa

    best, rows = exact_dedup.Best(), 400
    for low in range(0, rows, 40):
        texts = [b"t%d" % (i % 300) + b" " * 50_000 for i in range(low, low + 40)]
        best.add(pa.RecordBatch.from_pydict({
            "text": pa.array(texts, pa.binary()), "points": pa.array([len(t) for t in texts], pa.int64()),
            "id": pa.array(range(low, low + 40), pa.int64()), "row": pa.array(range(low, low + 40), pa.int64())}))
        best.settle()
    assert best._bytes <= 2 * exact_dedup.BUCKET_BYTES
    out = best.out()
    assert max(b.nbytes for b in out) <= 5 << 20
    assert sorted(r["id"] for b in out for r in b.select(["id"]).to_pylist()) == list(range(300))


def test_buckets_are_sized_by_whole_rows(spark, monkeypatch):
    """A bucket's task holds rows with their white space and other columns, so these count, not the contents alone."""
    real, bits = exact_dedup.bucket_bits, []
    monkeypatch.setattr(exact_dedup, "bucket_bits", lambda *a: bits.append(real(*a)) or bits[-1])
    for text, note in ((F.concat(F.col("doc_id").cast("string"), F.lit(" " * 10_000)), F.lit("")),
                       (F.col("doc_id").cast("string"), F.lit("n" * 10_000))):
        table = spark.range(500).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("lang")).select(
            "*", text.alias("text"), note.alias("note"))
        left = exact_dedup.drop_exact_copies(table.union(table), bucket_bytes=20_000)
        assert left.columns == table.columns and left.exceptAll(table).isEmpty() and left.count() == 500
        assert bits[-1] >= 8                                           # 5 MB of rows in buckets of 20 kB
