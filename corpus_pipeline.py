"""The training-corpus pipeline over ``documents``: quality, near duplicates, decontamination, personal data, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that ``run`` writes as Parquet to the shared folder
and reads again as the next stage's documents.  All stages but the last return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from threadsmith.llm import decontaminate, jaccard_join, pii, poisson_mix, quality_net
from threadsmith.llm.common import cut, read


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality network accepts.  Without labels of both classes all stay."""
    return quality_net.keep_good(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the least id, of each group of near duplicates."""
    return jaccard_join.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_leaks(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by marks and ``n_chars`` counted anew."""
    return pii.redact_documents(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' target weights and shuffled, with mix_copy and mix_key."""
    return poisson_mix.mix_sources(docs)


STAGES = [("quality classifier", quality), ("n-gram Jaccard join", near_duplicates),
          ("benchmark decontamination", decontamination), ("personal data", personal_data),
          ("mixing sources to target weights", mixing)]

#: the quality network and the edit matching have no SQL twin
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
