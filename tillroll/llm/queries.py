"""Named queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chaining import repeated_passages
from .context_tree import context_tree_scores
from .decontaminate import contained_items
from .importance import importance_sample
from .jaccard_join import jaccard_components
from .line_cleaning import clean_lines
from .packing import pack_documents
from .preferences import format_preferences, swapped_answers
from .prefix_trie import prefix_trie
from .secret_scan import KINDS, find_secrets, fit_tagger
from .token_output import write_matrix
from .toxicity import Chain, score_toxicity, train_chain
from .url_filter import PATTERNS, Rule, filter_urls

#: The tokenizer file of the packing queries, among those of the public tokenizers.
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path(TOKENIZER))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of at most 1024 tokens in as few sequences as best fit finds."""
    return pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path())


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that documents share, edits included."""
    return repeated_passages(_table(spark, sf_dir, "documents"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents linked by a Jaccard similarity of 0.9 of three-word shingles."""
    return jaccard_components(_table(spark, sf_dir, "documents"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and tagged secrets of every document."""
    docs = _table(spark, sf_dir, "documents")
    found = find_secrets(docs, fit_tagger(docs))
    shown = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    base = F.filter("spans", lambda s: s["kind"] != "crf")

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *(number(kind).alias(f"n_{kind}") for kind in KINDS),
        F.sha2(F.array_join(F.transform(base, shown), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", shown), ",").alias("spans"),
    )


def op5_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the written matrix of all documents, with checksums of ids and positions."""
    rows = write_matrix(_table(spark, sf_dir, "documents"), tokenizer_path())
    return rows.select(
        "row_id",
        "n_tokens",
        F.crc32("ids").alias("ids_crc32"),
        "cu_seqlens",
        F.crc32("positions").alias("positions_crc32"),
        "doc_ids",
        "pieces",
    )


def op6_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered turns of preference pairs made from all conversations."""
    return format_preferences(swapped_answers(_table(spark, sf_dir, "conversations")))


def op7_line_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line rules and text counts of every document, and whether it stays."""
    return clean_lines(_table(spark, sf_dir, "documents")).drop("cleaned")


#: The chain of the label table: first whether a text is junk, then whether it is toxic.
CATEGORIES = ("junk", "toxic")


def toxicity_chain(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Chain:
    labels = _table(spark, sf_dir, "labels")
    return train_chain(docs, labels.withColumn("junk", 1 - F.col("quality")), CATEGORIES)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category probabilities of every document and whether it is toxic."""
    docs = _table(spark, sf_dir, "documents")
    return score_toxicity(docs, toxicity_chain(spark, docs, sf_dir))


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of every document by token counts and by a context tree."""
    return context_tree_scores(_table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds 80 % or more of an item's five-word shingles."""
    return contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the trie over all rebuilt conversations."""
    return prefix_trie(_table(spark, sf_dir, "conversations"))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance weights of all documents towards the benchmark, and a tenth drawn by them."""
    return importance_sample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


#: The site rules of the URL query.
SITE_RULES = (
    Rule("block", "net/", site=True),
    Rule("allow", "example.net/en/", site=True),
    Rule("block", "example.com/de/", site=True),
    Rule("allow", "org/fr/", site=True),
)


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, deciding rule and verdict of every page's URL."""
    return filter_urls(_table(spark, sf_dir, "pages"), SITE_RULES + PATTERNS)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_packing, op2_substring_dedup, op3_ngram_join, op4_secrets, op5_token_output, op6_preferences, op7_line_cleaning, op8_toxicity, op9_lm_score, op10_decontamination, op11_prefix_trie, op12_importance, op13_url_filters)}
