"""Runs of months as ``yyyy-MM``."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def months_before(spark: SparkSession, n: int, day: datetime.date, current: bool = False) -> DataFrame:
    """month, back: the n months before that of ``day``, oldest first; with ``current``, that month and the n - 1 before it, newest first."""
    back = F.col("id") if current else F.lit(n) - F.col("id")
    month = F.date_format(F.add_months(F.trunc(F.lit(day), "month"), -back.cast("int")), "yyyy-MM")
    return spark.range(n).select(month.alias("month"), back.cast("int").alias("back"))


def month_names(n: int, day: datetime.date, current: bool = False) -> list[str]:
    """The same on the driver, for paths."""
    last = day.year * 12 + day.month - 1
    numbers = [last - k for k in range(n)] if current else [last - k for k in range(n, 0, -1)]
    return [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in numbers]
