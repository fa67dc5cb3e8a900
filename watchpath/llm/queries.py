"""The registered queries of the corpus operators and their DuckDB twins.

Each takes (spark, sf_dir) and applies its operator, with production
parameters, to the whole of its table.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (exact_dedup, language_id, mixing, ngram_join, packing, periodic_runs, quality_votes, reply_trees,
               rule_ensemble, token_alignment, token_counts, url_filters, warc)
from .oracles import ORACLES

URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]

#: Bytes of one Arrow batch between the JVM and a Python worker.
BATCH_BYTES = 4 << 20

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives Python workers this package where they would not find it by themselves, and sends texts to
    them in batches that suit long documents (unless the session says otherwise)."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":       # the default
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    known = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    sc = spark.sparkContext
    # Paths of the driver say something about its own machine only.
    here = re.fullmatch(r"local(\[.*\])?", sc.master) and (_ROOT in known or os.getcwd() == _ROOT)
    if here or sc.applicationId in _shipped:
        return
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="watchpath-py-")), "watchpath.zip")   # the driver serves it
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(os.path.join(_ROOT, "watchpath")):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, _ROOT))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


def tokenizer_path(name: str) -> str:
    """A public vocabulary file (folder: WATCHPATH_TOKENIZERS, else the installed one)."""
    if folder := os.environ.get("WATCHPATH_TOKENIZERS"):
        return os.path.join(folder, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(modulus: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def op1_grace_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies by Grace hashing: every document with the one that stays."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op2_power_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Power-of-two pieces of every document."""
    packed = packing.pieces(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("tokens").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op3_flow_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document for the target mix of sources."""
    docs = table(spark, sf_dir, "documents")
    return mixing.mixed_by_source(docs).select("doc_id", "size", "source_size", "target", "taken")


def op4_rule_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by a sparse rule ensemble."""
    held_out = _remainder(3) == 1
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    found = rule_ensemble.classified(table(spark, sf_dir, "documents"), labels, F.coalesce(held_out, F.lit(False)))
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under 5-word shingle similarity of 0.8."""
    return ngram_join.ngram_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    return url_filters.judged(table(spark, sf_dir, "pages"), URL_RULES)


def op7_compression_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by compression with per-language dictionaries."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(_remainder(4) == 2, F.lit(False))
    contents = language_id.dictionaries(docs.filter(~held_out))
    return language_id.identified(docs, contents).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to WARC archives and read back."""
    read = warc.archived(table(spark, sf_dir, "pages"), with_payload=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by the compiled transducer."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op10_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality measures and the weakly supervised verdict on every document."""
    return quality_votes.judged(table(spark, sf_dir, "documents")).drop("posterior")


def _with_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text, where every tenth text repeats a stretch of its words up to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.expr(r"filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w <> '')")
    changed = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"), F.floor(h / 10).cast("long").alias("g"))
    changed = changed.withColumn("n", F.size("words").cast("long")).withColumn("a", F.expr("if(n > 0, g % n, 0L)"))
    changed = changed.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    repeated = F.expr("array_join(transform(sequence(0L, n - 1), i -> words[int(if(i >= a, a + (i - a) % p, i))]), ' ')")
    return changed.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


def op11_recompression_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, and its text without them."""
    found = periodic_runs.periodic_runs(_with_repeats(table(spark, sf_dir, "documents")))
    longest = F.expr("""aggregate(runs, cast(null as struct<start:long,length:long,period:long>), (best, run) ->
        if(best is null or run.length * best.period > best.length * run.period, run, best))""")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("best", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op12_reply_tree_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as chat text, read back from it."""
    told = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    messages = reply_trees.chained(told.unionByName(marked), "conv_id", "turn")
    formatted = reply_trees.conversations(messages, "conv_id", "message", "parent", role="role", text="text")
    back = reply_trees.read_back(formatted)
    turns = F.expr("array_join(transform(turns, t -> concat(t.role, '\n', t.text, '\n')), '')")
    learned = F.expr("array_join(transform(filter(turns, t -> t.learned is not null), t -> t.learned), '')")
    return back.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns.cast("binary"), 256).alias("turns_sha256"), F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned.cast("binary"), 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers' tokens of every document."""
    return token_alignment.aligned(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
                                   tokenizer_path("piece_bpe_32k.model"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline over all documents."""
    if _ROOT not in sys.path:
        sys.path.insert(0, _ROOT)
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_grace_dedup, op2_power_packing, op3_flow_mixing, op4_rule_quality, op5_ngram_join,
                                    op6_url_filter, op7_compression_language, op8_warc, op9_token_counts,
                                    op10_quality_votes, op11_recompression_runs, op12_reply_tree_chat,
                                    op13_token_alignment, pipeline)}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
