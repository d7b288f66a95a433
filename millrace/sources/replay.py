"""Rows at rest as a replayable stream in event-time order.

A file stream takes files in the order of their modification times, which says nothing about the
times inside. Here a table is laid out by event time first: one range of time per file, the files dated in that
order, and at the end, if asked for, a closing row that moves the watermark past all that is open. So a
stream's results do not depend on how the table lay in files, and it can be stopped and
started again from its checkpoint: the folder stays as it is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import scratch_dir
from millrace.sources.readers import table_stream

# How many files one micro-batch takes, so that its size does not grow with the table.
FILES_PER_BATCH = 64


def lay_out(
    rows: DataFrame, ts: str, folder: str, files: int | None = None, close_after: str | None = None, times: Sequence[str] = (), blank: Sequence[str] = (),
) -> None:
    """Write ``rows`` below ``folder`` in ranges of ``ts``, and a last row ``close_after`` the newest time.

    The closing row is a copy of a newest row but for its times, ``ts`` and the further ``times``, which all are the closing time,
    and for ``blank`` columns, which are NULL. Without a time in any row there is none. Rows with equal
    times share a file.
    """
    spark = rows.sparkSession
    ranges = rows.repartitionByRange(files, ts) if files else rows.repartitionByRange(ts)
    ranges.sortWithinPartitions(ts).write.parquet(f"{folder}/rows")
    if close_after:
        laid = spark.read.schema(rows.schema).parquet(f"{folder}/rows")
        newest = laid.where(F.col(ts).isNotNull()).orderBy(F.desc(ts)).limit(1)
        later = F.col(ts) + F.expr(f"INTERVAL {close_after}")
        changed = {c: later for c in (ts, *times)} | {c: F.lit(None) for c in blank}
        newest.select(*[changed.get(c, F.col(c)).cast(rows.schema[c].dataType).alias(c) for c in rows.columns]).coalesce(1).write.parquet(f"{folder}/rows-end")
    else:
        rows.limit(0).write.parquet(f"{folder}/rows-end")
    _date_in_order(spark, [f"{folder}/rows", f"{folder}/rows-end"])


def _date_in_order(spark: SparkSession, folders: list[str]) -> None:
    """Date the part files by folder and name, a second apart."""
    path_of, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    nth = 0
    for folder in folders:
        where = path_of(folder)
        fs = where.getFileSystem(conf)
        names = sorted(s.getPath().getName() for s in fs.listStatus(where))
        for name in names:
            if name.startswith("part-"):
                fs.setTimes(path_of(folder, name), 1_700_000_000_000 + 1000 * nth, -1)
                nth += 1


def laid_out(spark: SparkSession, rows: DataFrame, folder: str, max_files: int = FILES_PER_BATCH) -> DataFrame:
    """The stream over a folder of ``lay_out``; ``rows`` gives the columns."""
    return table_stream(spark, f"{folder}/rows*", rows.schema, max_files)


def replayed(
    rows: DataFrame, ts: str, label: str, close_after: str | None = None, files: int | None = None,
    max_files: int = FILES_PER_BATCH, times: Sequence[str] = (), blank: Sequence[str] = (),
) -> DataFrame:
    """``rows`` as a stream that comes in the order of ``ts``; see ``lay_out``."""
    spark = rows.sparkSession
    folder = scratch_dir(spark, f"{label}-replay")
    lay_out(rows, ts, folder, files, close_after, times, blank)
    return laid_out(spark, rows, folder, max_files)
