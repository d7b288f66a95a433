"""Operators over one global order, or over the order of a busy key, as streams without a single-task state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.joins import join_null_safe, running_max_enrich
from millrace.operators.running import ROWS_PER_BLOCK, running, running_sum
from millrace.session import delete_folder, ship
from millrace.sources.writers import batch_folder, stream_by_batch
from millrace.streaming.stateful import in_flight_stream


def running_max_everywhere(
    left: DataFrame,
    right: DataFrame,
    ts: str,
    tie: str,
    value: str,
    path: str,
    checkpoint: str,
    rows_per_block: int = ROWS_PER_BLOCK,
    once: bool = False,
) -> StreamingQuery:
    """Left rows with the largest right value seen so far on the whole stream.

    Each micro-batch is one batch job over blocks. What it hands to the next one is a
    single number, kept under the number of the batch: a batch that is run again reads
    what its predecessor left and replaces its own output. Results are below ``rows`` and
    the numbers below ``top``.
    """
    ship(left.sparkSession)
    tagged = left.select(ts, tie, F.lit(None).cast("double").alias(value), F.lit(True).alias("_left")).unionByName(
        right.select(ts, tie, F.col(value).cast("double").alias(value), F.lit(False).alias("_left"))
    )

    def write(batch: DataFrame, number: int) -> None:
        before = 0.0
        if number:
            tops = batch.sparkSession.read.schema("top double")
            before = tops.parquet(batch_folder(f"{path}/top", number - 1)).first().top
        batch.persist()  # read once per pass otherwise
        lefts, rights = batch.where("_left"), batch.where("NOT _left")
        found = running_max_enrich(lefts.select(ts, tie), rights, ts, tie, value, rows_per_block=rows_per_block)
        top = F.greatest(F.col("max_so_far"), F.lit(before)).alias("max_so_far")
        found.select(ts, tie, top).write.mode("overwrite").parquet(batch_folder(f"{path}/rows", number))
        newest = rights.agg(F.greatest(F.coalesce(F.max(value), F.lit(0.0)), F.lit(before)).alias("top"))
        newest.write.mode("overwrite").parquet(batch_folder(f"{path}/top", number))
        batch.unpersist()

    return stream_by_batch(tagged, write, checkpoint, once=once)


def in_flight_size_everywhere(
    requests: DataFrame,
    responses: DataFrame,
    ts: str,
    path: str,
    checkpoint: str,
    key: str = "id",
    rows_per_block: int = ROWS_PER_BLOCK,
    expire_after: str | None = None,
    once: bool = False,
) -> StreamingQuery:
    """How many requests are open after each one that opens or closes, over the whole stream.

    The keyed state tells what each row changes. The sizes are a running sum of the changes over the
    blocks of a micro-batch, on top of one number that is committed under the batch's number, as above. Micro-batches
    must come in event-time order, both sides together, as ``sources.replay`` lays them out. Results
    ``(ts, side, key, change, in_flight)`` are below ``rows``.
    """
    changes = in_flight_stream(requests, responses, ts, key, expire_after=expire_after).where("change <> 0")

    def write(batch: DataFrame, number: int) -> None:
        before = 0
        if number:
            before = batch.sparkSession.read.schema("size bigint").parquet(batch_folder(f"{path}/size", number - 1)).first().size
        batch.persist()  # read once per pass otherwise
        sized = running(batch, [], [ts, "side", key], {"in_flight": running_sum(F.col("change"))}, rows_per_block=rows_per_block)
        size = (F.col("in_flight") + F.lit(before)).cast("bigint").alias("in_flight")
        sized.select(ts, "side", key, "change", size).write.mode("overwrite").parquet(batch_folder(f"{path}/rows", number))
        after = batch.agg((F.coalesce(F.sum("change"), F.lit(0)) + F.lit(before)).cast("bigint").alias("size"))
        after.write.mode("overwrite").parquet(batch_folder(f"{path}/size", number))
        batch.unpersist()

    return stream_by_batch(changes, write, checkpoint, once=once)


# A key's largest values of so many micro-batches are put together into one table.
BATCHES_PER_BASE = 16


def running_max_by_key(
    left: DataFrame,
    right: DataFrame,
    key: str,
    ts: str,
    tie: str,
    value: str,
    path: str,
    checkpoint: str,
    rows_per_block: int = ROWS_PER_BLOCK,
    batches_per_base: int = BATCHES_PER_BASE,
    once: bool = False,
) -> StreamingQuery:
    """Left rows with the largest right value of their key so far, never below zero, for keys of any size.

    A micro-batch is a batch job over blocks, so a busy key is many tasks. It leaves one row per key it has
    seen a value of; every ``batches_per_base`` of these tables are merged into one, so what a
    micro-batch writes follows its own keys and not all of them. The largest value of a key goes ahead of the key's rows in the
    next micro-batch. Rows are ordered by (``ts``, ``tie``), a right one first, and must come in that order
    from one micro-batch to the next; NULL is a key like any other. Results are below ``rows``.
    """
    spark = left.sparkSession
    ship(spark)
    tagged = left.select(key, ts, tie, F.lit(None).cast("double").alias(value), F.lit(True).alias("_left")).unionByName(
        right.select(key, ts, tie, F.col(value).cast("double").alias(value), F.lit(False).alias("_left"))
    )
    schema = tagged.select(key, value).schema

    def tops_before(number: int) -> DataFrame:
        base = number // batches_per_base * batches_per_base
        folders = [batch_folder(f"{path}/top", n) for n in range(base, number)]
        if base:
            folders.append(batch_folder(f"{path}/base", base))
        if not folders:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*folders).groupBy(key).agg(F.max(value).alias(value))

    def write(batch: DataFrame, number: int) -> None:
        if number and number % batches_per_base == 0:
            last = number - batches_per_base
            folders = [batch_folder(f"{path}/top", n) for n in range(last, number)] + ([batch_folder(f"{path}/base", last)] if last else [])
            merged = spark.read.schema(schema).parquet(*folders).groupBy(key).agg(F.max(value).alias(value))
            merged.write.mode("overwrite").parquet(batch_folder(f"{path}/base", number))
        if number > batches_per_base and number % batches_per_base == 1:
            # The base was committed with the batch before; what it was made of goes.
            for n in range(number - 1 - batches_per_base, number - 1):
                delete_folder(spark, batch_folder(f"{path}/top", n))
            delete_folder(spark, batch_folder(f"{path}/base", number - 1 - batches_per_base))
        batch.persist()  # read once per pass otherwise
        lefts, rights = batch.where("_left"), batch.where("NOT _left").select(key, ts, tie, value)
        seen = batch.select(key).distinct()
        # Without time and tie these sort before all rows of the key.
        known = join_null_safe(tops_before(number), seen, [key], "left_semi")
        ahead = known.select(key, *[F.lit(None).cast(batch.schema[c].dataType).alias(c) for c in (ts, tie)], value)
        found = running_max_enrich(lefts.select(key, ts, tie), rights.unionByName(ahead), ts, tie, value, [key], rows_per_block)
        found.write.mode("overwrite").parquet(batch_folder(f"{path}/rows", number))
        rights.groupBy(key).agg(F.max(value).alias(value)).write.mode("overwrite").parquet(batch_folder(f"{path}/top", number))
        batch.unpersist()

    return stream_by_batch(tagged, write, checkpoint, once=once)
