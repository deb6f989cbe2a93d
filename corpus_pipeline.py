"""A corpus pipeline of five stages: identify languages, drop near-duplicates, replace personal data, mix sources, encode.

Each stage works on what the one before kept, written as Parquet and read again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventpulse.llm import langid, mixing, nearcopies, pieces, pii
from eventpulse.llm.common import drop_all_but_last, materialize, table, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a score at or over the calibrated threshold; null text and text without letters go."""
    return langid.keep_identified(docs, langid.fit(docs, langid.learnable()))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by Jaccard similarity of 0.8 on shingles of five words: that of the smallest id. Fingerprints within 3 bits come first, shingle lists find the rest."""
    return nearcopies.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data and secrets."""
    return pii.replace_pii(docs, chars_col="n_chars").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled by calibrated probabilities."""
    return mixing.sample(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document, and whether they decode to its text."""
    return pieces.encode(docs, pieces.read_model())


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("personal_data", personal_data), ("mix", mix), ("encode", encode)]

#: Training, components and raking can't be put in SQL; tests/llm/test_pipeline.py checks each stage against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``. Once a stage's result is written, what was written before it goes."""
    docs, before = table(spark, sf_dir, "documents"), len(written())
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}")
            drop_all_but_last(spark, before)
    return docs
