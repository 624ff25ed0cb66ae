"""Corpus pipeline: toxicity, near duplicates, decontamination, secrets, pieces.

Every stage takes the documents its predecessor kept and returns documents with the same columns (the last one
returns pieces). ``run`` writes each stage's result as Parquet below ``spark.checkpoint.dir`` and reads it back for the next.

Rows with a null id or text pass the filters: no stage has evidence against them. An empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm import decontaminate, kit, ngram_join, pieces, secrets, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts, by the threshold of their language; trained on three folds of the labels."""
    model = toxicity.fit(docs, kit.tables(spark, sf_dir, "labels"), kit.fold(F.col("doc_id"), 4) != 2)
    return toxicity.accepted(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near copies; of equal rows one stays."""
    found = ngram_join.near_components(docs.select("doc_id", "text"))
    later = found.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    kept = docs.join(later, "doc_id", "left_anti").select(*docs.columns)
    return kept.where(F.col("doc_id").isNull()).unionAll(kept.where(F.col("doc_id").isNotNull()).dropDuplicates())


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an occurrence of any benchmark item within its edit budget."""
    return decontaminate.without_items(docs, kit.tables(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, reported secrets replaced by a mark."""
    return secrets.redact(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentation of every document."""
    import public_tokenizers

    return pieces.encode(docs, public_tokenizers.path(pieces.VOCABULARY))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scans", redact_secrets),
    ("sentencepiece", encode_pieces),
]
ORACLE_SQL = None  # a trained classifier and sampled segmentations have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    folder = kit.scratch(spark)
    docs = kit.tables(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = kit.written(stage(spark, docs, sf_dir), folder, f"{number}-{name}")
    return docs
