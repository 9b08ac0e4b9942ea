"""The corpus pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; stage results are
written as Parquet in the shared folder and read again by the next stage.

Defined results. A null, empty or blank text has neutral importance and no toxic
sentence, is one near-duplicate group with the other such texts, and encodes to no
token. Every row is judged by its own text, whatever its ``doc_id``; repeated rows
are near duplicates of each other. Extra columns of any name are kept up to the last
stage. An empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from orrery.llm import bpe, decontaminate, quality_resample, simhash, toxicity
from orrery.llm.common import materialise, read_table
from orrery.llm.queries import TOKENIZER


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling selects."""
    return quality_resample.keep_selected(docs, read_table(spark, sf_dir, "labels"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic."""
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a contaminating share of benchmark windows."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of each document's tokens and of what they decode to."""
    return bpe.digest(docs, public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN)


STAGES = [
    ("quality_classifier", select_quality),
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("byte_level_bpe", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Learned verdicts have no SQL form. tests/llm compares run() with its stages and with
#: the five decisions in plain Python.
ORACLE_SQL = None
