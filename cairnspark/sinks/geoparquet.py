"""GeoParquet: files in the order of the Hilbert curve, with a bbox column, small row groups, and ``geo`` and build metadata in their footers."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ..operators.assemble import spatially_sorted
from ..shipping import ship

ROW_GROUP = 25_000


def geo_metadata(box: tuple[float, float, float, float] | None = None) -> dict:
    column = {
        "encoding": "WKB",
        "geometry_types": ["Point"],
        "covering": {"bbox": {k: ["bbox", k] for k in ("xmin", "ymin", "xmax", "ymax")}},
    }
    if box:
        column["bbox"] = list(box)
    return {"version": "1.1.0", "primary_column": "geometry", "columns": {"geometry": column}}


def write_files(df: DataFrame, path: str, metadata: dict[str, str], row_group: int = ROW_GROUP, box: str | None = None) -> DataFrame:
    """Write a file per partition below ``path``, with ``metadata`` in its footer and row groups of ``row_group`` rows; returns file, n (rows), xmin, ymin, xmax, ymax.

    With ``box``, a struct column of corners, the footer also has the ``geo``
    metadata of the file's own extent.  Each task writes under a name of its
    own attempt and moves the file to its final name when it is whole: a lost
    or repeated task leaves no half a file and no second copy.  Memory is one
    row group a task.
    """
    ship(df.sparkSession)
    uri = path if "://" in path else f"file://{path}"
    run = uuid.uuid4().hex[:8]
    corners = (("xmin", min), ("ymin", min), ("xmax", max), ("ymax", max))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(uri)
        fs.create_dir(root, recursive=True)
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{run}.parquet"
        draft = f"{root}/_{name}.{task.taskAttemptId()}"
        writer, n, extent, held = None, 0, [None] * 4, []

        def flush() -> None:
            nonlocal held
            if held:
                writer.write_table(pa.Table.from_batches(held), row_group_size=row_group)
                held = []

        for b in batches:
            if not b.num_rows:
                continue
            if writer is None:
                writer = pq.ParquetWriter(fs.open_output_stream(draft, compression=None), b.schema.with_metadata({}), compression="zstd")
            if box:
                for k, (f, pick) in enumerate(corners):
                    seen = [v for v in (extent[k], *b.column(b.schema.names.index(box)).field(f).to_pylist()) if v is not None]
                    extent[k] = pick(seen) if seen else None
            n += b.num_rows
            at = 0
            while at < b.num_rows:  # row groups are filled to the row
                room = row_group - sum(x.num_rows for x in held)
                held.append(b.slice(at, room))
                at += held[-1].num_rows
                if sum(x.num_rows for x in held) == row_group:
                    flush()
        if writer is None:
            return
        flush()
        geo = {"geo": json.dumps(geo_metadata(None if None in extent else tuple(extent)))} if box else {}
        writer.add_key_value_metadata(metadata | geo)
        writer.close()
        fs.move(draft, f"{root}/{name}")
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n]), *[pa.array([v], pa.float64()) for v in extent]], ["file", "n", *(f for f, _ in corners)])

    kind = "file string, n long, xmin double, ymin double, xmax double, ymax double"
    return df.sparkSession.createDataFrame(df.mapInArrow(write, kind).collect(), kind)  # one row per file


def write_geoparquet(articles: DataFrame, path: str, metadata: dict[str, str] | None = None, row_group: int = ROW_GROUP, parts: int | None = None) -> DataFrame:
    """The article table, sorted along the Hilbert curve; see ``write_files``."""
    return write_files(spatially_sorted(articles, parts), path, dict(metadata or {}), row_group, "bbox")


def build_metadata(months: list[str], wanted: int, extract: str | None) -> dict[str, str]:
    """What a build records of its caches: the months joined, how many were wanted, the feature extract."""
    return {"pageviews_months": ",".join(months), "pageviews_months_wanted": str(wanted), "osm_extent_extract": extract or ""}


def write_extract(df: DataFrame, path: str, metadata: dict[str, str], order: list[str] | None = None) -> DataFrame:
    """A cache with its origin in the footers (``source``, ``month``, ``complete``, ...): a month of traffic or the feature extract, sorted if told so."""
    return write_files(df.orderBy(*order) if order else df, path, metadata)


def add_metadata(path: str, metadata: dict[str, str]) -> None:
    """Add key-value metadata to one finished file; row groups stay as they are.  The new file replaces the old one when it is whole."""
    fs, inner = pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)
    with fs.open_input_file(inner) as source:
        old = pq.ParquetFile(source)
        draft = f"{inner}.{uuid.uuid4().hex[:8]}"
        own = {k: v for k, v in (old.metadata.metadata or {}).items() if k != b"ARROW:schema"}
        with fs.open_output_stream(draft, compression=None) as out, pq.ParquetWriter(out, old.schema_arrow.with_metadata(None), compression="zstd") as writer:
            for k in range(old.num_row_groups):
                writer.write_table(old.read_row_group(k), row_group_size=max(1, old.metadata.row_group(k).num_rows))
            writer.add_key_value_metadata(own | {k.encode(): v.encode() for k, v in metadata.items()})
    fs.move(draft, inner)
