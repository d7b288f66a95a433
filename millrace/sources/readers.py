"""Sources. Each works with a batch reader and, where it makes sense, a streaming one."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas

# The consumer group and poll cap of the click jobs, for those who ask for them; the
# ride disorder.
CONSUMER_GROUP = "test-group1"
POLL_CAP = 50
RIDE_DISORDER = "60 seconds"

CORRUPT = "_corrupt"


def _reader(spark: SparkSession, streaming: bool):
    return spark.readStream if streaming else spark.read


def text_lines(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Lines of text files; with ``streaming`` also the lines of files still to come."""
    return _reader(spark, streaming).text(path).withColumnRenamed("value", "text")


def records(lines: DataFrame, schema: T.StructType, text: str = "text") -> DataFrame:
    """Typed records from delimited lines, with the raw line kept where it does not parse."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full.fields)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return lines.select(F.from_csv(F.col(text), ddl, options).alias("r")).select("r.*")


def literal_rows(spark: SparkSession, rows: Iterable[Any], schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def collection(spark: SparkSession, values: Iterable[Any], kind: str = "int", name: str = "v") -> DataFrame:
    """One column from a driver-side collection."""
    return spark.createDataFrame([(v,) for v in values], f"{name} {kind}")


def integer_range(spark: SparkSession, first: int, last: int, name: str = "v") -> DataFrame:
    """Whole numbers, both ends included; made on the executors."""
    return spark.range(first, last + 1).withColumnRenamed("id", name)


def rides_file(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Compressed or plain delimited rides, out of order by up to a minute.

    ``ts`` is the time of the record itself. A stream gets a watermark of the disorder and
    is replayable from its checkpoint.
    """
    rides = _reader(spark, streaming).schema(schemas.RIDE).csv(path)
    timed = rides.withColumn("ts", F.when(F.col("is_start"), F.col("start_time")).otherwise(F.col("end_time")))
    return timed.withWatermark("ts", RIDE_DISORDER) if streaming else timed


def table_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    """Parquet files as a stream; ``max_files`` limits how many each trigger takes."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def topic_options(
    topics: Iterable[str],
    servers: str,
    group: str | None = None,
    poll_cap: int | None = None,
    earliest: bool = False,
) -> dict[str, str]:
    """Reader options for one topic or several.

    Queries that share a ``group`` may each get a part of a topic, so the default is a group of
    its own for every query.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": ",".join(topics)}
    if group:
        options["kafka.group.id"] = group
    if poll_cap:
        options["kafka.max.poll.records"] = str(poll_cap)
    if earliest:
        options["startingOffsets"] = "earliest"
    return options


def topic_rows(
    spark: SparkSession,
    options: Mapping[str, str],
    format: str = "kafka",
    rows_per_trigger: int | None = None,
    path: str | None = None,
    streaming: bool = True,
) -> DataFrame:
    """Rows of a topic source: key, value, topic, partition, offset, timestamp.

    The connector must be on the classpath. Any file format with the same columns does for
    replays: pass its name and a ``path``; topics are then selected by the ``topic`` column.
    """
    reader = _reader(spark, streaming).format(format)
    if path is None:
        if rows_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", rows_per_trigger)
        return reader.options(**options).load()
    rows = reader.schema(schemas.TOPIC_ROW).load(path)
    return rows.where(F.col("topic").isin(*options["subscribe"].split(",")))


def arrival_time(df: DataFrame) -> DataFrame:
    """Ingestion time of file rows: when their file was last written."""
    return df.withColumn("arrival_ts", F.col("_metadata.file_modification_time"))
