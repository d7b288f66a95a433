"""Late rows and event-time order in batch data.

Here every row moves the watermark, as it would if rows were handled one at a time. A
stream advances its watermark once per micro-batch instead and so may keep a few more.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.times import epoch_us
from millrace.operators.running import ROWS_PER_BLOCK, running, running_count, running_max
from millrace.session import durable

# Fixed value: the watermark delay of the connected-car jobs.
CAR_DELAY_SECONDS = 40


def mark_late(
    events: DataFrame,
    ts: str,
    arrival: Sequence[str],
    delay_seconds: int = CAR_DELAY_SECONDS,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Add ``is_late``: the row is at or behind the watermark left by the rows that arrived before it."""
    seen = running(
        events, [], arrival, {"_newest": running_max(F.col(ts))}, inclusive=False,
        rows_per_block=rows_per_block,
    )
    lag = epoch_us(F.col("_newest")) - epoch_us(F.col(ts))
    late = F.coalesce(lag >= delay_seconds * 1_000_000, F.lit(False))
    return seen.withColumn("is_late", late).drop("_newest")


def sorted_on_time(
    events: DataFrame,
    key: str,
    ts: str,
    tie: str,
    arrival: Sequence[str],
    delay_seconds: int = CAR_DELAY_SECONDS,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """On-time rows with their ``position`` in event-time order within the key."""
    marked = mark_late(events, ts, arrival, delay_seconds, rows_per_block)
    kept = durable(marked.where(~F.col("is_late")).drop("is_late"))
    return running(
        kept, [key], [ts, tie], {"position": running_count()}, rows_per_block=rows_per_block
    )


def event_time_layout(events: DataFrame, key: str, ts: str, tie: str, partitions: int | None = None) -> DataFrame:
    """Rows laid out by key and event time, ready to be written.

    Ranges are cut on (key, ts, tie), so a frequent key spans several partitions, which
    follow one another in order.
    """
    target = (key, ts, tie) if partitions is None else (partitions, key, ts, tie)
    return events.repartitionByRange(*target).sortWithinPartitions(key, ts, tie)
