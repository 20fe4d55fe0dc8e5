"""Reading, and what several operators need."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from slipmatch.sources.shared import remove, write_aside

# Rows of a batch are worked on in runs of about this many bytes, at least one row each.
RUN_BYTES = 1 << 20


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def to_utf8(column: str):
    """The text's UTF-8 bytes; null counts as no bytes."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


class Asides:
    """Tables written aside by name, and removed as soon as nothing needs them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        table = write_aside(df, name)
        self.paths[name] = table.path
        return table.read(self.spark)

    def drop(self, *names: str) -> None:
        for name in names:
            remove(self.spark, self.paths.pop(name))


@contextmanager
def batch_rows(spark: SparkSession, rows: int):
    """Arrow batches of so many rows at most for the jobs run inside, so that whole texts take less memory."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def runs(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with the bytes of a string column and the offset of each row in them."""
    whole = batch.column(column)
    lengths = np.asarray(pc.fill_null(pc.binary_length(whole), 0)).astype(np.int64)
    ends = np.cumsum(lengths)
    first = 0
    while first < len(lengths):
        base = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, base + RUN_BYTES, "right")))
        part = batch.slice(first, last - first)
        texts = pc.fill_null(part.column(column).cast(pa.large_binary()), b"")
        data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        yield part, data[offsets[0] : offsets[-1]], offsets - offsets[0]
        first = last
