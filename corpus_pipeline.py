"""Corpus pipeline over ``documents``: five stages, each written as Parquet and reread by the next.

1. quality_rules: rows that the rules reject go, and from the others the lines above the limit.
2. exact_dedup: of equal texts, the row with the smallest doc_id stays.
3. simhash_dedup: one row of each component of similar texts (0.8 of their five-word shingles) stays.
4. mixing: rows as often as the mix to target weights takes them.
5. packing: the mix as pieces in sequences of at most 2048 tokens.

All stages but the last return the columns of ``documents``, whichever they
are.  What a stage does with nulls, empty or long texts, ties, repeated rows,
empty tables and extra columns is stated in its operator's module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cairnspark.llm.common import clear_scratch, scratch_mark, staged, table
from cairnspark.llm.exact_dedup import exact_dedup
from cairnspark.llm.mixing import mixed_rows
from cairnspark.llm.packing import pack
from cairnspark.llm.quality_rules import filter_quality
from cairnspark.llm.simhash import drop_near_duplicates


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return filter_quality(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_rows(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_rules", quality_stage),
    ("exact_dedup", exact_stage),
    ("simhash_dedup", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: SimHash components and bin completion have no SQL form; the tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage written and reread; what a stage and the one before it have written goes when its output is there."""
    docs, since = table(spark, sf_dir, "documents"), scratch_mark()
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
        clear_scratch(spark, since, last=1)
    return STAGES[-1][1](spark, docs, sf_dir)
