"""Shared helpers: table reads, intermediate tables in the shared folder, bounded slices of Arrow batches."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetspark.session import fresh_dir

#: Text bytes handled at once inside a task; bounds the numpy scratch arrays of a Python worker.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers through Spark's file server, once a context."""
    context = spark.sparkContext
    if getattr(context, "_fleetspark_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="fleetspark-code-"), "fleetspark_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)
    context._fleetspark_shipped = True


def in_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType | str) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage with a table that every executor can reach, so a lost
    executor costs the running tasks only and random or ordered steps before
    it are not evaluated twice.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def string_slices(column: pa.ChunkedArray | pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(from, to) row ranges of a string column with about ``limit`` bytes each; a longer text stands alone."""
    offsets = utf8_buffers(column)[1]
    n, start = len(offsets) - 1, 0
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        end = min(n, max(end, start + 1))
        yield start, end
        start = end


def utf8_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (from 0) of a string column; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def map_slices(
    df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: StructType | str, text: str
) -> DataFrame:
    """``mapInArrow`` whose function sees slices of about SLICE_BYTES of column ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for a, b in string_slices(batch.column(batch.schema.get_field_index(text))):
                    yield fn(batch.slice(a, b - a))

    return in_arrow(df, run, schema)


def list_column(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from the flat values and the number of values of each row."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def runs(keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal neighbours, and the length at the end."""
    if not len(keys):
        return np.zeros(1, np.int64)
    return np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))


def clean_columns(df: DataFrame, *needed: str) -> DataFrame:
    """Only the named columns, so that further columns of the input cannot clash with derived ones."""
    return df.select(*[F.col(f"`{c}`") for c in needed])
