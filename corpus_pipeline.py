"""A corpus, stage by stage, from raw documents to packed training sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from umbu.llm.decontamination import drop_contaminated
from umbu.llm.language_id import drop_rejected
from umbu.llm.line_dedup import dedup_lines
from umbu.llm.near_duplicates import drop_near_duplicates
from umbu.llm.packing import pack
from umbu.llm.tables import importable, keep, table
from umbu.queries.registry import Query


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of no known language, or without text, go.

    Languages are those that enough text declares. Nulls and repeats: ``identify``.
    """
    importable(spark)
    return drop_rejected(docs)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that are like an earlier one go, and with them documents of no others.

    So do null texts and texts of white space alone. Repeated rows have the same lines
    left; of equal lines in rows of different ids the one of smallest id stays.
    """
    return dedup_lines(docs).where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with close fingerprints the one of smallest doc_id stays.

    Rows without an id come last; of rows equal in id and text one stays.
    """
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth is benchmark text go; null texts stay."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every word that is left in the training sequences.

    Texts without words have a row without a sequence; see ``pack`` for repeats.
    """
    return pack(docs).drop("text_hash")


STAGES = [
    ("language ID", identify_language),
    ("line dedup", remove_repeated_lines),
    ("SimHash near-dedup", keep_one_of_each),
    ("benchmark decontamination", decontaminate),
    ("best-fit packing", pack_sequences),
]

# Language models, fingerprints and best-fit packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


PIPELINE = Query(run, ORACLE_SQL)
