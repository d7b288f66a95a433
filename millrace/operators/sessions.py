"""Gap sessions per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.times import epoch_us
from millrace.operators.running import ROWS_PER_BLOCK, Blocks, running_max, running_sum

# Fixed value: the gap of the connected-car job.
CAR_GAP_SECONDS = 15


def _summary(ts: Column, measure: Column) -> list[Column]:
    return [
        F.min(ts).alias("session_start"),
        F.max(ts).alias("session_end"),
        F.count(F.lit(1)).alias("n"),
        F.min(measure).alias("min_value"),
        F.max(measure).alias("max_value"),
        F.avg(measure).alias("avg_value"),
    ]


def sessions(
    events: DataFrame, key: str, ts: str, measure: str, gap_seconds: int = CAR_GAP_SECONDS
) -> DataFrame:
    """Sessions of a stream or a batch; events exactly one gap apart share a session."""
    gap = F.session_window(ts, f"{gap_seconds} seconds").alias("session")
    return events.groupBy(key, gap).agg(*_summary(F.col(ts), F.col(measure))).drop("session")


def sessions_any_skew(
    events: DataFrame,
    key: str,
    ts: str,
    tie: str,
    measure: str,
    gap_seconds: int = CAR_GAP_SECONDS,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Sessions of a batch in which one key may hold a large part of the rows.

    The built-in session window merges all rows of a key in one task. When a key is too
    large for that, its rows are numbered by session across blocks and then aggregated
    with a map-side partial step. Rows without a time belong to no session, as in the
    built-in window.
    """
    rows = events.where(F.col(ts).isNotNull()).select(key, ts, tie, measure)
    blocks = Blocks.plan(rows, [key], [ts, tie], rows_per_block)
    if not blocks.cuts:
        return sessions(rows, key, ts, measure, gap_seconds)
    previous = blocks.running(
        blocks.assign(rows), {"_previous": running_max(F.col(ts))}, inclusive=False
    )
    gap_us = gap_seconds * 1_000_000
    opens = F.when(epoch_us(F.col(ts)) - epoch_us(F.col("_previous")) <= gap_us, 0).otherwise(1)
    numbered = blocks.running(
        previous.withColumn("_opens", opens), {"_session": running_sum(F.col("_opens"))}, spread=False
    )
    summary = _summary(F.col(ts), F.col(measure))
    return numbered.groupBy(key, "_session").agg(*summary).drop("_session")


def session_parts(events: DataFrame, key: str, ts: str, measure: str) -> DataFrame:
    """Events with a time as sessions of one instant each, in a form that can be merged on."""
    m = F.col(measure)
    found = events.where(F.col(ts).isNotNull()).groupBy(key, F.col(ts).alias("session_start")).agg(
        F.count(F.lit(1)).alias("n"), F.min(m).alias("min_value"), F.max(m).alias("max_value"),
        F.sum(m).alias("total"), F.count(m).alias("known"),
    )
    return found.withColumn("session_end", F.col("session_start"))


def merged_sessions(parts: DataFrame, key: str, gap_seconds: int, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Parts of a key that overlap, or are at most one gap apart, as one. No two parts of a key start together.

    A key with many parts is cut over blocks, and its sessions are added up from partial sums.
    """
    blocks = Blocks.plan(parts, [key], ["session_start"], rows_per_block)
    reached = blocks.running(blocks.assign(parts), {"_reached": running_max(F.col("session_end"))}, inclusive=False)
    apart = epoch_us(F.col("session_start")) - epoch_us(F.col("_reached"))
    opens = F.when(apart <= gap_seconds * 1_000_000, 0).otherwise(1)
    numbered = blocks.running(reached.withColumn("_opens", opens), {"_session": running_sum(F.col("_opens"))}, spread=False)
    sums = [F.sum(c).cast(parts.schema[c].dataType).alias(c) for c in ("n", "total", "known")]
    ends = [F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end")]
    extremes = [F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value")]
    return numbered.groupBy(key, "_session").agg(*ends, *sums, *extremes).select(*parts.columns)


def session_summary(merged: DataFrame, key: str) -> DataFrame:
    """Merged parts with the columns of ``sessions``."""
    average = F.when(F.col("known") > 0, F.col("total").cast("double") / F.col("known"))
    return merged.select(key, "session_start", "session_end", "n", "min_value", "max_value", average.alias("avg_value"))
