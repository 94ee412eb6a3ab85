"""Corpus pipeline: toxicity, near duplicates, repeated passages, benchmark passages, packing.

Every stage takes (spark, docs, sf_dir) and works on all that the one before
it kept; its result is written as Parquet and read again as the next one's
``docs``.  All but the last return the columns of ``documents``, whatever
further columns they have and however those are named.

Defined results of the stages, in their order:

* a null, empty or wordless text gets the classifiers' score of no words, is a
  near copy of nothing and so stays, loses nothing, is never contaminated, and
  packs as the closing id alone;
* of rows that repeat id and text one stays after the near copies, of tied
  documents of a group the one with the smallest id (null last);
* passages are cut out of every text that holds them, copies included;
* empty tables give empty results; null ids are ids like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarmac.llm import decontaminate, jaccard_tree, packing, suffix_dedup, toxicity
from tarmac.llm.common import Scratch, small_batches, table

#: shingle width of the near-duplicate stage (words) and its similarity
NEAR = jaccard_tree.Rule(width=5, num=80, den=100)
#: words of a repeated passage that goes: over fifty
PASSAGE = 51


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain flags as toxic go."""
    small_batches(spark)
    return toxicity.kept(docs, toxicity.learn(docs, table(spark, sf_dir, "labels"), toxicity.categories()))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies one document stays."""
    small_batches(spark)
    return jaccard_tree.one_of_each(docs, rule=NEAR)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that also stand elsewhere are cut out of the texts."""
    small_batches(spark)
    return suffix_dedup.cut_texts(docs, PASSAGE, unit=suffix_dedup.WORDS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated with benchmark passages go."""
    return decontaminate.clean(docs, decontaminate.benchmark_windows(table(spark, sf_dir, "benchmark")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the texts with their places in sequences of at most 4096 tokens."""
    small_batches(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents``; a stage's table goes once the next one is written."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        docs = scratch.stored(stage(spark, docs, sf_dir), name)
        if i:
            scratch.drop(STAGES[i - 1][0])
    return STAGES[-1][1](spark, docs, sf_dir)


# classifiers, components and least squares have no SQL form
ORACLE_SQL = None
