"""Documents to packed training sequences: the stages, in order, and the job that runs them.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet
below the shared folder, and the next stage reads it back. All but the last return the
columns they were given. Rows without text or id pass every filter that finds nothing in them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.decontaminate import without_contained
from tillroll.llm.jaccard_join import jaccard_components
from tillroll.llm.packing import pack_documents
from tillroll.llm.queries import tokenizer_path, toxicity_chain
from tillroll.llm.secret_scan import fit_tagger, redact_secrets
from tillroll.llm.toxicity import without_toxic
from tillroll.session import materialise, scratch_scope


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain calls toxic are dropped."""
    return without_toxic(docs, toxicity_chain(spark, docs, sf_dir))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents (five-word shingles, Jaccard 0.8) one stays: the text
    with the smallest id, and of several texts under that id the one that hashes lowest. Rows
    go by id and text, so another text under an id that goes is judged by itself. Of rows with
    the same id and text one stays; a row without words, or without an id, stays."""
    groups = jaccard_components(docs, n=5, percent=80, least=True)
    leave = groups.filter("not is_least").select("doc_id", F.col("text_hash").alias("__text")).distinct()
    kept = docs.withColumn("__text", F.xxhash64("text")).join(leave, ["doc_id", "__text"], "left_anti")
    return kept.dropDuplicates(["doc_id", "__text"]).select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain 80 % or more of a benchmark item's shingles are dropped."""
    return without_contained(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; the documents stay, with their new length."""
    clean = redact_secrets(docs, fit_tagger(docs))
    if "n_chars" in clean.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.length("text").cast(kind))
    return clean


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of what is left, with their places in sequences of 1024 tokens."""
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxicity),
    ("ngram_join", near_duplicates),
    ("decontamination", decontaminate),
    ("secrets", secrets),
    ("packing", packing),
]

#: Trained models and a tokenizer decide, which SQL cannot express; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with scratch_scope(spark, keep=lambda purpose: purpose.startswith("pipeline-")):
            docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
