"""A corpus pipeline: toxicity, line dedup, n-gram Jaccard join, secret scan, packing.

Every stage takes what the one before it kept and works on all of it. All but
the last return the columns of ``documents``; the last returns the pieces of
the packed sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.line_dedup import dedup_lines
from sluice.llm.packing import pack
from sluice.llm.secrets import mask_secrets
from sluice.llm.shingle_join import jaccard_groups
from sluice.llm.toxicity import drop_toxic
from sluice.session import free, stored, table

#: Near duplicates share this percentage of their shingles of so many words.
WORDS, PERCENT = 5, 80


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; the others, null and empty texts among them, stay as they are."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a site go; all documents stay, whole copies of a page with all their lines."""
    return dedup_lines(docs, dropped=None, spare_copies=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates the document with the smallest id stays. Documents without an id stay."""
    groups = jaccard_groups(docs, width=WORDS, percent=PERCENT)
    others = groups.where(F.col("doc_id") != F.col("component_id")).select("doc_id")
    return docs.join(others, "doc_id", "left_anti").select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked by their kind; all documents stay, null texts as they are, repeated rows each by itself."""
    return mask_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their sequences and offsets. Null texts count as empty: a piece of the end id alone; repeated rows are packed as often as they occur."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: A trained classifier and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``. What a stage has read is deleted when its result is written; an empty table
    gives an empty result, columns beyond those of ``documents`` pass through all stages but the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        kept = stored(stage(spark, docs, sf_dir))
        free(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
