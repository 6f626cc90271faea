"""A training corpus from raw documents: each stage reads what its predecessor wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import line_dedup, mixing, near_dedup, packing, quality_rules
from tallyloom.llm.common import Scratch
from tallyloom.llm.queries import MIX, table, tokenizer_path

#: One epoch only, so that no document is repeated in the corpus.
CORPUS_MIX = mixing.Mix(MIX.domains, MIX.langs, MIX.sources, MIX.domain_of, budget_share=0.8, max_epochs=1)


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without their failing lines."""
    return quality_rules.clean(docs)


def lines_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that many documents share."""
    return line_dedup.clean(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, linked from a similarity of 0.80 on (op5's own contract says 0.85)."""
    return near_dedup.one_of_each(docs, percent=80)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents chosen towards the target weights."""
    return mixing.mixed_documents(docs, CORPUS_MIX)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality_rules", rules_stage),
    ("line_dedup", lines_stage),
    ("near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed corpus of a data folder."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    name, stage = STAGES[-1]
    return scratch.finish(stage(spark, docs, sf_dir))


#: The tokenizer and the registers of near de-duplication are beyond SQL.
ORACLE_SQL = None
