"""Training-data pipeline: five stages over the documents of one folder, each written as Parquet and read by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight.llm import decontaminate, jaccard, line_dedup, packing, toxicity
from wardlight.llm.tables import remainder, spare, written

#: documents from this score on are rejected as toxic
REJECT_SCORE = 0.5


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below ``REJECT_SCORE``; rows with a null doc_id are scored like others."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    index = toxicity.fit(docs, labels, remainder(F.col("doc_id"), 5) == 0)
    return toxicity.keep_below(docs, index, REJECT_SCORE)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of lines repeated from earlier ones; n_chars follows the new text."""
    out = line_dedup.dedup(spark, docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones, the first by doc_id and text hash; documents like no other stay.

    Rows of one id but different texts are different documents; rows alike in both are one document and share its fate.
    A null id counts as the last. Texts without words are like no other. Other columns, whatever their names, stay.
    """
    groups = jaccard.link_components(spark, docs)
    return _without(docs, groups.where(~F.col("is_first")).select("doc_id", "row_key"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item. Other columns, whatever their names, stay."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contamination(spark, docs, benchmark).where("n_hit > 0")
    return _without(docs, found.select("doc_id", "row_key"))


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows named by (doc_id, row_key)."""
    names = spare(docs, "gone_doc", "gone_key")
    doc, key = (F.col(name) for name in names)
    same = (F.xxhash64("doc_id", "text") == key) & F.col("doc_id").eqNullSafe(doc)
    return docs.join(gone.distinct().toDF(*names).hint("merge"), same, "left_anti")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents in sequences of at most 2048 tokens, one row per piece."""
    return packing.pack(
        spark, docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    )


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard", keep_one_of_similar),
    ("decontamination", drop_contaminated),
    ("best_fit_packing", pack_sequences),
]

#: Learned scores and tokens are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
