"""The registered queries of the operators, with the SQL they are checked against where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from trendmill.llm import (
    bpe, chat_format, exact_dedup, lexical, license_scan, line_dedup, merkle, mixing, packing, quality_rules, simhash,
    token_files, toxicity,
)
from trendmill.llm.common import table, vocabulary

_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "<|im_end|><|im_start|>assistant ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    return chat_format.read_back(chat_format.format_conversations(rows.union(probe)))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), F.col("toxic"), grades=4, refine=True)
    return toxicity.predict(docs, model)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("byte_bpe_50k.json")
    coded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return coded.select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = token_files.write_and_read(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end=2)
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end=1)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.remove_repeated_passages(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", F.size("removed").cast("long").alias("n_removed"),
        F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("removed_chars"),
        F.array_join(F.transform("removed", lambda s: F.concat_ws("-", s["start"], s["end"])), " ").alias("spans"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_copies(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.measure(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *[F.col("quality")[name].alias(name) for name in _MEASURES])


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.unhex(merkle.digest([*fields, lowered])))
    leaves = docs.select("doc_id", "source", merkle.digest([*fields, F.col("text")]).alias("leaf"), tampered.alias("found"))
    proven = merkle.prove(leaves, "source", "doc_id")
    found = F.coalesce(F.lower(F.hex("found")), F.col("leaf"))
    return proven.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.sibling_text(F.col("proof")), 256).alias("proof_sha256"),
        merkle.fold(found, F.col("proof")).alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_toxicity": op2_toxicity,
    "op3_license_scan": op3_license_scan,
    "op4_bpe": op4_bpe,
    "op5_token_files": op5_token_files,
    "op6_packing": op6_packing,
    "op7_simhash": op7_simhash,
    "op8_line_dedup": op8_line_dedup,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_lexical_search": op12_lexical_search,
    "op13_mixing": op13_mixing,
    "pipeline": corpus_pipeline.run,
}

SQL = {
    "op3_license_scan": license_scan.scan_sql("documents"),
    "op8_line_dedup": line_dedup.removal_sql("documents"),
    "op9_exact_dedup": exact_dedup.copies_sql("documents"),
    "op10_quality_rules": quality_rules.measure_sql("documents"),
    "op11_merkle_manifest": merkle.manifest_sql("documents"),
    "op12_lexical_search": lexical.search_sql("documents", "benchmark"),
    "op13_mixing": mixing.mix_sql("documents"),
}
