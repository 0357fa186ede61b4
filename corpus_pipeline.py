"""From raw documents to packed training bins: five stages, each over all that the one before kept.

Every stage reads the stored result of its predecessor and, but for the last,
returns the columns of ``documents``. Stages on word shingles use five words
and a similarity of 0.8.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.llm.common import stored, table
from fleetspark.llm.decontamination import contamination
from fleetspark.llm.near_dedup import near_duplicates
from fleetspark.llm.packing import pack
from fleetspark.llm.quality_rules import quality_rules
from fleetspark.llm.substring_dedup import remove_repeats

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
REST = ("lang", "source", "n_chars")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the repetition rules."""
    return quality_rules(docs, keep_columns=REST).where("kept").select(*COLUMNS)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near copies. Documents without an id stay, as they
    are linked with nothing; rows that repeat a kept id are that document and stay."""
    kept = near_duplicates(docs, shingle=5, percent=80).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi").select(*COLUMNS)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has; documents of which nothing is left go."""
    kept = remove_repeats(docs, keep_columns=("lang", "source"))
    return kept.where("n_removed = 0 or n_removed < n_words").select(
        "doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars")
    )


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't hold benchmark passages."""
    found = contamination(docs, table(spark, sf_dir, "benchmark"), keep_columns=("text", *REST))
    return found.where("not contaminated").select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document: its bin and its place in it."""
    return pack(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("substring_dedup", substring_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Best-fit packing is sequential, so SQL can't express the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
