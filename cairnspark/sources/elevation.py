"""Elevations, sampled tile by tile through a function that the caller brings (a raster client, a table, a test's stand-in)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import dem_tile, off_the_edge
from ..shipping import ship

Sampler = Callable[[str, list[tuple[float, float]]], list[float]]


def sample_elevations(points: DataFrame, sampler: Sampler, key: str = "page_id") -> DataFrame:
    """key, elevation (short).  points: key, lat, lon.

    Points are dealt and sorted by ranges of (tile, place), so that a task opens
    a tile once for each run of its points (up to a batch), and a crowded tile is
    split over tasks and batches.  What a sampler cannot give is 0; values are
    cut off to whole metres.
    """
    ship(points.sparkSession)
    rows = points.select(key, dem_tile(F.col("lat"), F.col("lon")).alias("tile"), off_the_edge(F.col("lat")).alias("lat"), off_the_edge(F.col("lon")).alias("lon"))
    kind = rows.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            high = pd.Series(0, index=frame.index, dtype="int16")
            for tile, part in frame.groupby("tile"):
                try:
                    got = [int(v) for v in sampler(tile, list(zip(part["lon"], part["lat"], strict=True)))]
                except Exception:  # noqa: BLE001  a tile that is missing or broken is level with the sea
                    got = [0] * len(part)
                high.loc[part.index] = got
            yield pd.DataFrame({key: frame[key], "elevation": high})

    return rows.repartitionByRange("tile", "lat", "lon").sortWithinPartitions("tile").mapInPandas(run, f"{key} {kind}, elevation short")
