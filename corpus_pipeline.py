"""From raw documents to packed training windows.

Quality rules, toxicity, near-duplicates, personal data, packing: each stage reads
what its predecessor wrote.  Nulls, empty and repeated rows, empty tables and extra
columns are handled as the operators' docstrings say: texts without words fail the
quality rules; of rows that share an id one survives near-dedup; rows with
a null id go through; extra columns are carried to the packing stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenure.llm import near_dedup, packing, pii, quality_rules, toxicity
from tenure.llm.common import held_out, save, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the fences of their language and source."""
    return quality_rules.keep(docs)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; the model learns from the labels outside the held-out fifth."""
    labels = table(spark, sf_dir, "labels").where(~held_out()).select(F.col("doc_id").alias("id"), "toxic")
    source = table(spark, sf_dir, "documents").where(~held_out()).select(F.col("doc_id").alias("id"), "text", "lang")
    return toxicity.keep(docs, toxicity.learn(source, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose sets of five-word shingles are 0.8 alike."""
    return near_dedup.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Accepted spans replaced by their kind; ``n_chars`` follows the text."""
    out = pii.redact(docs)
    if "n_chars" in out.columns:
        kind = out.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 4096 tokens."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)


STAGES = [
    ("quality_rules", quality),
    ("toxicity", toxic),
    ("near_dedup", near_duplicates),
    ("pii", personal_data),
    ("packing", pack),
]

#: Trained models, hashed signatures and tokenizers can't be expressed in SQL;
#: the stages are tested against brute-force versions in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
