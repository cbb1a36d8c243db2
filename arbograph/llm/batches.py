"""Shared plumbing: bounded text chunks for Arrow workers, and tables in the shared scratch folder."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: UTF-8 bytes of text that a worker holds as Python objects at a time (one longer text is held alone).
CHUNK_BYTES = 1 << 19


def _trim() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def release(spark: SparkSession) -> None:
    """Let go, on the driver, of what finished plans, models and broadcasts hold; for the end of a long job, not of each table."""
    _trim()
    spark.sparkContext._jvm.System.gc()


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes of text, or one row. A worker that is used again gives back what
    it has freed."""
    try:
        yield from _slices(batches, column, limit)
    finally:
        _trim()


def _slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(column)
        if not len(batch):
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 16)
        at = 0
        while at < len(ends):
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def text_chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """``slices`` with their texts; null becomes ''."""
    for part in slices(batches, column, limit):
        yield part, [t or "" for t in part.column(column).to_pylist()]


def record_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def scratch_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one where it is unset (local runs)."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        root = "file://" + tempfile.mkdtemp(prefix="scratch-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


#: Spark deletes a query's shuffle files at its end, not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, label: str = "table") -> DataFrame:
    """df written once to the shared folder and read back: cuts the lineage and survives lost executors."""
    spark, schema = df.sparkSession, df.schema
    path, before = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}", spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(schema).parquet(path)
    out._scratch = path
    return out


#: Rows of a few numbers that are broadcast at most (16 MB for one number).
BROADCAST_ROWS = 1_000_000


def small(rows: DataFrame) -> DataFrame:
    """A saved table, to be broadcast if its checked size allows it; else it is joined by a shuffle."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def columns(df: DataFrame) -> list[Column]:
    """All columns of df, whatever their names."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """df.mapInArrow, which takes no column with a dot in its name."""
    names = df.columns
    return df.toDF(*(f"c{i}" for i in range(len(names)))).mapInArrow(lambda batches: run(b.rename_columns(names) for b in batches), schema)


def free_name(df: DataFrame, name: str) -> str:
    """The name, longer if df has such a column."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def discard(df: DataFrame) -> None:
    """Delete the files of a table from ``saved`` that nothing will read again."""
    jvm = df.sparkSession.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(df._scratch)
    path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
