"""Sinks."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.session import scratch_dir, ship

# Fixed value: progress is saved once per second.
CHECKPOINT_INTERVAL = "1 second"


def as_text(df: DataFrame) -> DataFrame:
    """Each row as one delimited line."""
    return df.select(F.to_csv(F.struct("*")).alias("value"))


def write_text(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Overwrite ``path`` with one line per row. A single file means a single task: small results only."""
    lines = as_text(df)
    (lines.coalesce(1) if single_file else lines).write.mode("overwrite").text(path)


def _print_lines(rows: Iterator[Row]) -> None:
    for row in rows:
        print(row.value)
    sys.stdout.flush()


def print_rows(df: DataFrame, name: str = "printer sink", rows: int | None = None) -> StreamingQuery | None:
    """Print every row of a batch, or of each micro-batch of a stream, as one delimited line.

    The tasks print to the output of their own executors, so nothing passes through the
    driver. With ``rows`` the driver shows that many of a batch or micro-batch instead.
    """

    def put(part: DataFrame, _: int = 0) -> None:
        if rows is None:
            ship(part.sparkSession)
            as_text(part).foreachPartition(_print_lines)
        else:
            part.show(rows, truncate=False)

    if df.isStreaming:
        return df.writeStream.queryName(name).outputMode("update").foreachBatch(put).start()
    put(df)
    return None


def _writer(stream: DataFrame, checkpoint: str, name: str | None, mode: str, once: bool, interval: str):
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)


def stream_to_table(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    name: str | None = None,
    once: bool = False,
    interval: str = CHECKPOINT_INTERVAL,
) -> StreamingQuery:
    """Append finished rows to parquet, exactly once across restarts."""
    return _writer(stream, checkpoint, name, "append", once, interval).format("parquet").start(path)


def stream_by_batch(
    stream: DataFrame,
    each: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    name: str | None = None,
    once: bool = False,
    interval: str = CHECKPOINT_INTERVAL,
) -> StreamingQuery:
    """Hand each micro-batch and its number to a function, which must bear repetition."""
    return _writer(stream, checkpoint, name, mode, once, interval).foreachBatch(each).start()


def batch_folder(path: str, batch: int) -> str:
    """The folder one micro-batch owns; writing it again replaces it."""
    return f"{path}/batch={batch}"


def stream_to_text(stream: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    return stream_by_batch(
        stream, lambda df, batch: write_text(df, batch_folder(path, batch)), checkpoint, once=once
    )


def stream_to_topic(
    rows: DataFrame, options: dict[str, str], checkpoint: str, format: str = "kafka",
    path: str | None = None, once: bool = False,
) -> StreamingQuery:
    """Send topic rows (key, value, topic) to a topic sink, or to files of the same shape."""
    writer = _writer(rows, checkpoint, None, "append", once, CHECKPOINT_INTERVAL).format(format)
    return writer.options(**options).start(path) if path else writer.options(**options).start()


def write_topic(rows: DataFrame, options: dict[str, str], format: str = "kafka", path: str | None = None) -> None:
    writer = rows.write.format(format).options(**options).mode("append")
    writer.save(path) if path else writer.save()


@contextmanager
def _state_partitions(spark: SparkSession) -> Iterator[None]:
    """No more state partitions than cores: each costs a commit in every micro-batch."""
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(min(int(before), spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def with_rocksdb(spark: SparkSession) -> Iterator[None]:
    """The state store that ``transformWithState`` needs, for queries started inside."""
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    spark.conf.set(setting, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def drain(stream: DataFrame, label: str, mode: str = "append", rocksdb: bool = False) -> DataFrame:
    """Run a stream over all data present and return what it wrote.

    What is still open at the end of the input stays open; ``sources.replay`` can close it.

    With ``append`` these are the final rows. With ``update`` each row also carries its
    ``batch``; the row of the highest batch is the current one of its key.
    """
    spark = stream.sparkSession
    ship(spark)
    path, checkpoint = scratch_dir(spark, label), scratch_dir(spark, f"{label}-progress")
    with _state_partitions(spark), with_rocksdb(spark) if rocksdb else nullcontext():
        if mode == "append":
            query = stream_to_table(stream, path, checkpoint, label, once=True)
        else:
            query = stream_by_batch(
                stream,
                lambda df, batch: df.write.mode("overwrite").parquet(batch_folder(path, batch)),
                checkpoint, mode, label, once=True,
            )
        query.awaitTermination()
    reader = spark.read.schema(stream.schema) if mode == "append" else spark.read
    return reader.parquet(path)


def show_plan(df: DataFrame, mode: str = "formatted") -> None:
    df.explain(mode)


def named(df: DataFrame, description: str) -> DataFrame:
    """Name the jobs this thread starts from here on."""
    df.sparkSession.sparkContext.setJobDescription(description)
    return df
