"""Folds and bounded training samples, drawn by hashes of identifiers: the same on every run, with no sort and no hot task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def fold(id_col: Column) -> Column:
    """CRC-32 of the identifier as text, modulo FOLDS; a null identifier counts as empty text.  Fold 0 is held out."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % FOLDS


def draw(key: Column, salt: int) -> Column:
    """A number in [0, 1) from a key (an identifier, a text) and salt."""
    return F.pmod(F.xxhash64(F.coalesce(key.cast("string"), F.lit("")), F.lit(salt)), F.lit(1 << 30)).cast("double") / float(1 << 30)


def bounded(df: DataFrame, id_col: Column, bound: int, total: int, salt: int = 1) -> DataFrame:
    """About ``bound`` rows of ``total`` (all, if there are no more)."""
    return df if total <= bound else df.where(draw(id_col, salt) < bound / total)
