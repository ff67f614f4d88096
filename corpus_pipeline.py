"""A training-data pipeline: five stages, each one operator of ``gable.llm``.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept and returns a DataFrame; :func:`run` writes each result as Parquet in
the shared folder and rereads it as the next stage's input. All stages but
the last return the columns of ``documents``.

1. ``language_id``: texts that the nearest-centroid classifier rejects go.
2. ``near_duplicates``: of documents linked by 5-word shingles at a Jaccard
   similarity of 0.8 or more (and their components) one stays.
3. ``decontamination``: documents of which benchmark windows hit 5 % or more go.
4. ``mixing``: sources are mixed to target weights; a document appears as
   often as it is taken.
5. ``token_files``: texts are encoded and written as token files; the result
   is what a reader finds in them.

Nulls, empty and repeated rows behave as the operators' docstrings say; an
empty table passes through all stages as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gable.llm import decontamination, language_id, mixing, ngram_join, token_files
from gable.llm.common import materialise, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs, language_id.fit(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs, n=5, num=80, den=100)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"), remove="documents")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.apply_mix(docs, mixing.fit_mix(docs))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_files.token_files(docs, token_files.default_tokenizer(), end_id=1)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", remove_contaminated),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]

#: near duplicates, models and the tokenizer are beyond SQL; see tests/llm
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs
