"""Corpus pipeline: from raw documents to packed training sequences.

Quality classifier, line dedup, SimHash near-dedup, mixing to source weights, packing. Each
stage is written as Parquet to the shared folder and read again as the next one's documents.
All but the last keep the columns of ``docs``, whatever their names; an empty table passes
through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salvor.llm import op1_mixing, op6_lines, op8_quality, op9_simhash, op10_packing
from salvor.llm.common import staged, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, taught by the labels that aren't held out, doesn't reject.

    Null and empty texts score as a text of no words, repeated rows alike; a null doc_id is kept
    or rejected by its text."""
    return op8_quality.accepted(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of many sources, n_chars being that of the new text.

    A null text stays null, an empty one empty; of a line's occurrences the first by doc_id (null
    first) stays; repeated rows lose the same lines; null is a source of its own."""
    return op6_lines.documents_without_boilerplate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the first by doc_id (null after all), then text.

    Null and empty texts are one group; of repeated rows one stays."""
    return op9_simhash.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them.

    Null and empty texts have no words and are not taken; null is a source of its own; equal keys
    are taken in the order of doc_id; repeated rows share alike."""
    return op1_mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mix, each in its sequence.

    A null or empty text is the one id 0; a null doc_id is kept; repeated rows are packed as often
    as they stand."""
    return op10_packing.packed_documents(docs)


STAGES = [("quality classifier", quality), ("line dedup", lines), ("SimHash near-dedup", near), ("mixing sources", mix), ("best-fit packing", pack)]

#: Trained models, fingerprints and tokens have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
