"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's docs.  All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from procura.llm import cotraining, jaccard, kneser_ney, mixing, packing
from procura.llm.common import free_name, stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained quality classifier does not reject."""
    model = cotraining.fit(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs.columns, "score")
    return cotraining.score(docs, model, docs.columns, score).filter(f"{score} >= 0.5").drop(score)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the Kneser-Ney models do not find toxic."""
    model = kneser_ney.fit(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs.columns, "score")
    return kneser_ney.score(docs, model, docs.columns, score).filter(f"{score} < 0.5").drop(score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingle sets
    with a Jaccard similarity of 0.8 or more, and what such links connect."""
    return jaccard.one_of_each(docs, width=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The curriculum's rows, in training order; a document taken twice is two
    rows, and the last one taken of a source is cut to its target."""
    return mixing.training_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and offset."""
    return packing.pack(docs)


STAGES = [("quality", quality), ("toxicity", toxicity), ("near_duplicates", near_duplicates), ("mix", mix), ("pack", pack)]

#: learned scores and token ids: not in SQL (tests hold each stage to a plain loop)
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
