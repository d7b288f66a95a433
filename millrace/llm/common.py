"""Helpers shared by the text operators: tables, written cuts, arrow batches of text."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import scratch_dir, ship  # noqa: F401

SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends here, and lost executors take nothing along."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def forget(*frames: DataFrame) -> None:
    """Delete the tables behind frames of ``written`` that nothing reads any more."""
    for df in frames:
        drop_folder(df.sparkSession, df.written_at)


def drop_folder(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


BROADCAST_ROWS = 1 << 22


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """A written copy whose rows have a number each, and the number's column; what is decided on rows is told by it."""
    name = free_name(docs, "row_number")
    return written(docs.withColumn(name, F.monotonically_increasing_id()), "numbered"), name


def without(rows: DataFrame, gone: DataFrame, key: str, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``rows`` but for those whose ``key`` is in ``gone``; texts stay where they are while ``gone`` is small enough to broadcast."""
    few = gone.limit(broadcast_rows + 1).count() <= broadcast_rows
    return rows.join(F.broadcast(gone) if few else gone, key, "left_anti").drop(key)


@contextmanager
def uncollected() -> Iterator[None]:
    """Without garbage collection: what is remembered stays, and walking it again and again costs more than the work.

    The worker that runs the next task has it back.
    """
    gc.freeze()
    gc.disable()
    try:
        yield
    finally:
        gc.enable()
        gc.unfreeze()


def id_crc(doc_id: Column | str = "doc_id") -> Column:
    """crc32 of the id as text; NULL for a NULL id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary"))


def free_name(df: DataFrame, base: str) -> str:
    """A column name that the frame does not have."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name = f"_{name}"
    return name


def spread(n: int | None, df: DataFrame) -> int:
    return n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and len + 1 offsets; NULL is an empty text. Eight spare bytes follow."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    first, last = (int(offsets[0]), int(offsets[-1])) if len(texts) else (0, 0)
    data = np.zeros(last - first + 8, dtype=np.uint8)
    if last > first:
        data[:-8] = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[first:last]
    return data, offsets - first if len(texts) else np.zeros(1, dtype=np.int64)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``limit`` bytes of text; a longer text is a run of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def run_lengths(counts: np.ndarray) -> np.ndarray:
    """0 .. n-1 for each n of ``counts``, one after the other."""
    total = int(counts.sum())
    firsts = np.repeat(np.cumsum(counts) - counts, counts)
    return np.arange(total, dtype=np.int64) - firsts
