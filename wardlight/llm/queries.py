"""The registered queries of this subpackage and the SQL that equals them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight.llm import (
    decontaminate,
    jaccard,
    lexical,
    licences,
    line_dedup,
    merkle,
    packing,
    piece_bpe,
    quality,
    secrets,
    sql,
    substring,
    topk,
    toxicity,
)
from wardlight.llm.tables import remainder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sha256(text) -> F.Column:
    return F.sha2(text, 256)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.dedup(spark, _table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", _sha256(F.col("kept")).alias("kept_sha256"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(_table(spark, sf_dir, "documents"), licences.known_licences(spark))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(
        spark,
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        _sha256(F.array_join("items", ",")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    findings, _ = secrets.scan(spark, _table(spark, sf_dir, "documents"))
    return findings.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        _sha256(F.col("base")).alias("base_sha256"),
        "spans",
        "n_bare",
        "n_live",
        "n_example",
    )


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_components(spark, _table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = remainder(F.col("doc_id"), 3) == 1
    return _classified(quality.score(documents, quality.fit(documents, labels, held_out)), held_out)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = remainder(F.col("doc_id"), 5) == 0
    return _classified(toxicity.score(documents, toxicity.fit(documents, labels, held_out)), held_out)


def _classified(scores: DataFrame, held_out: F.Column) -> DataFrame:
    return scores.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        *(c for c in scores.columns if c not in ("doc_id", "score")),
    )


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.dedup(spark, documents)
    return out.select("doc_id", "n_lines", "n_removed", "text")


def op11_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = piece_bpe.encode(_table(spark, sf_dir, "documents"), model)
    digests = encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        _sha256(F.array_join("ids", ",")).alias("ids_sha256"),
        "ids",
    )
    decoded = piece_bpe.decode(digests, model, ("doc_id", "n_tokens", "ids_sha256"))
    return decoded.select("doc_id", "n_tokens", "ids_sha256", _sha256(F.col("decoded")).alias("decoded_sha256"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = remainder(F.col("doc_id"), 7) == 0
    rows = merkle.manifest(spark, _table(spark, sf_dir, "documents"), tampered)
    proof = _sha256(F.lower(F.hex("siblings"))).alias("proof_sha256")
    return rows.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", "verified", "lang", "position")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_license_scan,
        op3_best_fit_packing,
        op4_decontamination,
        op5_secret_scan,
        op6_ngram_jaccard,
        op7_top_k,
        op8_quality,
        op9_toxicity,
        op10_line_dedup,
        op11_piece_bpe,
        op12_lexical_search,
        op13_merkle_manifest,
    )
}

ORACLES: dict[str, str] = {
    "op1_substring_dedup": sql.SUBSTRING_DEDUP,
    "op4_decontamination": sql.DECONTAMINATION,
    "op7_top_k": sql.TOP_K,
    "op10_line_dedup": sql.LINE_DEDUP,
    "op12_lexical_search": sql.LEXICAL_SEARCH,
    "op13_merkle_manifest": sql.MERKLE_MANIFEST,
}
