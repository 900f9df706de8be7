"""Corpus pipeline: five stages over ``documents``, each on all rows the one before kept.

Rows rejected as toxic go; repeated and nearly repeated lines are cut (and
documents with nothing left); one document of each near-duplicate group stays;
documents that cover a benchmark item go; the rest is segmented for a
SentencePiece vocabulary. The checks of each stage are those of its operator.
A row is known by its id and text together, so rows that share an id, or have
none, are deduplicated and judged each by its own text. Empty texts and empty
tables are handled as the operators' docstrings state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tollgate.llm import line_dedup, minhash, sentencepiece_sample, tiling, toxicity
from tollgate.llm.common import Scratch, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier, trained on the labelled rows of ``docs``, does not reject."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that an earlier line repeats; documents left without words go."""
    return line_dedup.dedup(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component (five-word shingles, similarity 0.8)."""
    return minhash.keep_one(docs, width=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover no benchmark item."""
    return tiling.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def segment(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every text left."""
    return sentencepiece_sample.digests(sentencepiece_sample.sample(docs))


STAGES = [("toxicity", drop_toxic), ("line_dedup", dedup_lines), ("minhash", dedup_documents), ("decontamination", decontaminate), ("sentencepiece", segment)]

#: Trained and sampling stages have no SQL form; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written and read again."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        before, docs = docs, scratch.keep(stage(spark, docs, sf_dir))
        if i:
            scratch.drop(before)
    return docs


REGISTRY = {"pipeline": (run, ORACLE_SQL)}
