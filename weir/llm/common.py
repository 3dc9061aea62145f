"""What the operators of this package share: reading, sealing results, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from weir.streaming.storage import written

# Word separators of the contracts: space and the six ASCII controls from TAB to CR without others.
SEPARATORS = b" \t\n\x0b\x0c\r"

# Rows of one Arrow batch: 512 texts of 100 KB are 50 MB in a Python worker.
BATCH_ROWS = 512

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    """Columns of a whole table; a remote path works, only Spark opens it."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
    return df.select(*columns) if columns else df


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the rows of the Arrow batches that Python stages of this session get."""
    if int(spark.conf.get(_BATCH)) > rows:
        spark.conf.set(_BATCH, str(rows))


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def sealed(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder; its shuffle files go once it is written.

    Later steps read the table, so a lost executor costs the tasks of one step.
    """
    with _shuffles_removed(df.sparkSession):
        return written(df, name)


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """Apply a function to Arrow batches, one at a time."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := function(batch)) is not None:
                yield out

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return memory that Arrow keeps for later to the machine: a worker waits beside the JVM until the next Python stage."""
    pa.default_memory_pool().release_unused()


def byte_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of texts; NULL counts as empty."""
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    elif pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    return [x or b"" for x in column.to_pylist()]


def lists(flat: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))
