"""From raw documents to token ids: five stages, each over all that the one before has kept.

Texts that the quality classifier rejects go; of each group of near duplicates the document with the smallest id
stays; contaminated documents go; personal data is replaced by its kind in brackets; texts are encoded.  All stages
but the last return the columns of ``documents``; the last adds ``pieces`` (the best segmentation's ids) and
``scores`` (of the best segmentations).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sftframe.llm import decontam, jaccard, pieces, pii, quality
from sftframe.llm.textcore import stored, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redacted(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode_best(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", keep_distinct),
    ("decontamination", keep_uncontaminated),
    ("personal_data", redact_personal_data),
    ("encoding", encode),
]

#: Classifier, components and lattices are beyond SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
