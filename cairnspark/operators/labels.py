"""Labels for identifiers: which to ask for, merging a cache, resolving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def wanted(rows: DataFrame, *columns: str) -> DataFrame:
    """qid: the distinct non-empty identifiers of the columns."""
    parts = [rows.select(F.col(c).alias("qid")) for c in columns]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where("qid <> ''").distinct()


def known(keys: DataFrame, cache: DataFrame) -> DataFrame:
    return keys.join(cache, "qid", "left_semi")


def to_fetch(keys: DataFrame, cache: DataFrame) -> DataFrame:
    return keys.join(cache, "qid", "left_anti")


def merged(old: DataFrame, new: DataFrame) -> DataFrame:
    """qid, label of both; the new one counts where both have it."""
    both = old.select("qid", F.col("label").alias("old")).join(new.select("qid", F.col("label").alias("new")), "qid", "full_outer")
    return both.select("qid", F.coalesce("new", "old").alias("label"))


def resolved(rows: DataFrame, labels: DataFrame, *columns: str) -> DataFrame:
    """The rows with identifiers in ``columns`` replaced by labels; empty where there is none.

    Plain left joins: whether the label table is small enough to broadcast is
    left to the size that Spark measures.
    """
    for c in columns:
        one = labels.select(F.col("qid").alias("__label_key"), F.col("label").alias("__label"))
        rows = rows.join(one, F.nullif(F.col(c), F.lit("")) == F.col("__label_key"), "left").withColumn(c, F.coalesce("__label", F.lit(""))).drop("__label_key", "__label")
    return rows
