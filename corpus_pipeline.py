"""From documents to encoded training text: five stages, each one operator of assayframe.llm.

Every stage takes (spark, docs, sf_dir) and returns a table, which is written as Parquet and read
back as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from assayframe.llm import budget_mix, chosen_path, fertility, pii_votes, piece_codec
from assayframe.llm.common import settled


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that fail the base rule or leave their fertility bands go."""
    return fertility.kept_rows(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: the first document of each class stays."""
    return chosen_path.first_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: personal data is masked in the texts, and n_chars follows."""
    return pii_votes.mask_rows(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents as often as the mix of sources takes them."""
    return budget_mix.mixed_rows(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: the ids of every text that is left."""
    return piece_codec.digests(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("personal data", personal_data),
    ("source mix", source_mix),
    ("piece codec", encode_pieces),
]

#: The bands, the chosen paths, the span classifier and the fit are not SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
