"""Registered queries of this package: name -> fn(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.session import scratch_path

from . import (
    conversation_repair, exact_topk, html_text, jaccard_join, katz, line_quality, mixing, packing, substring_dedup,
    token_files, toxicity, warc, whitening,
)
from .frames import read


def op1_substring_dedup(spark, sf_dir):
    out = substring_dedup.dedup(read(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op2_exact_topk(spark, sf_dir):
    return exact_topk.search(read(spark, sf_dir, "embeddings", "vec_id", "embedding")).drop("digits")


def op3_html_text(spark, sf_dir):
    return html_text.extract(read(spark, sf_dir, "pages", "page_id", "url", "html"))


def op4_jaccard_join(spark, sf_dir):
    return jaccard_join.join(read(spark, sf_dir, "documents", "doc_id", "text"))


def op5_line_quality(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return line_quality.measure(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept", "lost_chars")


def op6_warc(spark, sf_dir):
    path = scratch_path(spark, "llm-warc")
    warc.write(read(spark, sf_dir, "pages", "page_id", "url", "html"), path)
    whole = warc.assemble(warc.read(spark, path)).filter("capture is not null")
    whole = whole.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))  # repeated rows
    rows = whole.select(
        F.col("metadata.page_id").cast("long").alias("page_id"), F.col("capture.payload_bytes").alias("payload_bytes"),
        F.col("capture.payload_digest").alias("payload_digest"), F.col("capture.record_type").alias("record_type"),
        F.col("capture.refers_to").alias("to"), "capture_id")
    first = (rows.filter("record_type = 'response'").groupBy(F.col("capture_id").alias("to"))
             .agg(F.max("page_id").alias("refers_to")))
    # captures that refer to none have a key of their own each, that no capture has
    rows = rows.withColumn("to", F.coalesce("to", F.concat(F.lit("none "), F.col("capture_id"))))
    return (rows.drop("capture_id").join(first, "to", "left")
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def op7_katz(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))
    out = katz.score(docs, katz.train(docs.filter(~held_out)))
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_mixing(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "source", "text")
    return mixing.schedule(docs).select("doc_id", "source", "source_block", "slot")


def op9_toxicity(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    lexicon, weights = toxicity.learn(docs, read(spark, sf_dir, "labels", "doc_id", "toxic"))
    out = toxicity.score(docs, lexicon, weights)
    return out.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score",
                      (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op10_packing(spark, sf_dir):
    return packing.pack(read(spark, sf_dir, "documents", "doc_id", "text"))


def op11_conversation_repair(spark, sf_dir):
    talks = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    report, repaired = conversation_repair.repair(conversation_repair.damaged(talks))
    hashes = conversation_repair.digests(repaired).withColumnRenamed("conv", "_conv")
    full = report.join(hashes, F.col("conv").eqNullSafe(F.col("_conv")), "left")
    out = talks.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().join(
        full, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select("conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"))


def op12_token_files(spark, sf_dir):
    path = scratch_path(spark, "llm-tokens")
    token_files.write(read(spark, sf_dir, "documents", "doc_id", "text"), path)
    return token_files.read(spark, path)


def op13_whitening(spark, sf_dir):
    out = whitening.whiten(read(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    # a sum beyond a long (some 10^9 fitted vectors) is null here; the operator's column holds it
    return out.withColumn("deviation", F.col("deviation").try_cast("long"))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_exact_topk": op2_exact_topk,
    "op3_html_text": op3_html_text,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_line_quality": op5_line_quality,
    "op6_warc": op6_warc,
    "op7_katz": op7_katz,
    "op8_mixing": op8_mixing,
    "op9_toxicity": op9_toxicity,
    "op10_packing": op10_packing,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_token_files": op12_token_files,
    "op13_whitening": op13_whitening,
}
