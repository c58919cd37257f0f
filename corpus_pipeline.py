"""The corpus pipeline: five stages over ``documents``, each written and read again by ``run``.

Quality rules drop repetitive texts, the Jaccard join keeps one document of each group of near
copies, decontamination drops holders of benchmark items, the tagger masks personal data, and
packing puts what is left into batches. All stages but the last return the columns of documents.

No stage but packing's is SQL (chosen paths, latent search and a network are not), so ORACLE_SQL
is None; tests hold the stages against brute force.

Every stage takes any columns beside doc_id and text and hands them on (all but the last), keeps a
row's place in no order, and gives an empty table for an empty one. What else its rows give is said
in its function; an exact account is in the operator's module.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from atelier.llm import chosen_path, decontaminate, packing, pii_tagger, suffix_rules
from atelier.llm.common import materialise, release, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text passes the rules, unchanged. Null, empty and short texts (under 50 words) go;
    very long ones are judged whole; repeated rows stay or go together; a null doc_id is as good as any."""
    return suffix_rules.keep_unrepetitive(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies, unchanged: that of the smallest doc_id (none comes last), of
    ties one. Null and empty texts are in no class and all stay, but of repeated rows one does."""
    return chosen_path.keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item, unchanged. Null and empty texts stay; very long ones are searched
    whole; repeated rows stay or go together; an empty benchmark drops nothing."""
    return decontaminate.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, personal data in text replaced by its kind in brackets, and n_chars, if there, counted
    anew where that is so. Null texts stay null; repeated rows are treated alike."""
    return pii_tagger.redact(docs)


def length_buckets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, tokens, bucket, batch and place of every row. Null and empty texts are one token (the end's);
    rows longer than a batch's budget have one of their own; repeated rows have a place each."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("length_buckets", length_buckets),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        made = stage(spark, docs, sf_dir)
        last, docs = docs, materialise(made, f"stage-{name}")
        release(last)
        release(made)  # what only the stage has read
    out = STAGES[-1][1](spark, docs, sf_dir)
    release(docs)  # packing has written the lengths, which are all that its result reads
    return out
