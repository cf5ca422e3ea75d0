"""A training corpus from raw documents, in stages that are each written and read again.

Every stage but the last returns the columns of ``documents``. A stage that changes texts
sets ``n_chars`` where the table has it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.llm import decontaminate, jaccard_join, langid, packing, suffix_dedup
from daygrain.llm.common import staged, table

#: Bytes from which on a repeated string goes: 99 of 100 stretches of 51 words have as many. ``op4`` has its own 400.
PASSAGE = 250


def _set_aside(docs: DataFrame) -> DataFrame:
    """``docs`` with names for all columns but doc_id and text that no operator's result has."""
    return docs.select(*[F.col(f"`{c}`").alias(_safe(i, c)) for i, c in enumerate(docs.columns)])


def _safe(i: int, column: str) -> str:
    return column if column in ("doc_id", "text") else f"in_{i}"


def _as_documents(kept: DataFrame, docs: DataFrame, rewritten: bool = False) -> DataFrame:
    columns = {c: F.col(_safe(i, c)) for i, c in enumerate(docs.columns)}
    if rewritten and "n_chars" in columns:
        columns["n_chars"] = F.length(F.coalesce("text", F.lit(""))).cast(docs.schema["n_chars"].dataType)
    return kept.select(*[column.alias(c) for c, column in columns.items()])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; those without a letter (``und``) go."""
    found = langid.identify(_set_aside(docs), langid.train(docs))
    return _as_documents(found.where(F.col("lang_pred") != langid.UNKNOWN), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document, by doc_id, of each near-duplicate component."""
    found = jaccard_join.near_duplicates(_set_aside(docs), with_text=True)
    return _as_documents(found.where("kept"), docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand elsewhere, too; those left without a word go."""
    found = suffix_dedup.remove_repeats(_set_aside(docs), size=PASSAGE)
    return _as_documents(found.where(F.col("text").rlike(r"\S")), docs, rewritten=True)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark items don't contaminate, without the few benchmark words that are left."""
    found = decontaminate.contamination(_set_aside(docs), table(spark, sf_dir, "benchmark"))
    clean = found.where(~decontaminate.contaminated())
    return _as_documents(decontaminate.without_spans(clean), docs, rewritten=True)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of token ids."""
    return packing.pack(docs, packing.tokenizer_path())


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_strings", drop_repeats),
    ("decontamination", decontaminated),
    ("packing", packed),
]

#: EM, components, a suffix order and a vocabulary file are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; the rows of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
