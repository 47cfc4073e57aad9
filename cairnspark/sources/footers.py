"""Parquet footers as tables, and the gates that read them."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession

KEY_VALUE = "file string, key string, value string"
COLUMNS = "file string, name string, type string, logical_type string"


def _open(path: str) -> pq.ParquetFile:
    fs, inner = pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)
    return pq.ParquetFile(fs.open_input_file(inner))


def key_values(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """file, key, value of the footers' metadata."""
    rows = [(p, k.decode(), v.decode("utf-8", "replace")) for p in paths for k, v in (_open(p).metadata.metadata or {}).items()]
    return spark.createDataFrame(rows, KEY_VALUE)


def columns(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """file, name (dotted), type (physical), logical_type of the footers' leaf columns."""
    rows = []
    for p in paths:
        schema = _open(p).schema
        rows += [(p, schema.column(i).path, schema.column(i).physical_type, str(schema.column(i).logical_type)) for i in range(len(schema))]
    return spark.createDataFrame(rows, COLUMNS)


def is_complete(path: str) -> bool:
    """Whether a cached extract may be used: it can be read, and is not marked as incomplete."""
    try:
        flag = (_open(path).metadata.metadata or {}).get(b"complete")
    except (OSError, ValueError):
        return False
    return flag is None or flag.decode().lower() != "false"


def recorded_months(path: str) -> list[str]:
    """The months whose views a file's build has joined."""
    said = (_open(path).metadata.metadata or {}).get(b"pageviews_months", b"").decode()
    return [m for m in said.split(",") if m]
