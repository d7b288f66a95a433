"""Streams as batch jobs over finished time slots.

A micro-batch appends its rows to a log dealt by time slot. Once the newest time less the delay has
passed slots, one batch job handles all their rows, with the operators for batches: these cut a busy key over
many tasks, which a state per key cannot. Everything a micro-batch leaves behind stands in folders under its
number, so one that runs again replaces its own work, and a query goes on after a stop. Slots
that no later batch needs are deleted, so the log does not grow with the stream.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.times import epoch_us
from millrace.operators.joins import JOIN_WINDOW, next_at_or_after, window_join_any_skew
from millrace.operators.running import ROWS_PER_BLOCK
from millrace.operators.sessions import CAR_GAP_SECONDS, merged_sessions, session_parts, session_summary
from millrace.session import delete_folder, make_folder
from millrace.sources.writers import batch_folder, stream_by_batch

SLOT, BATCH = "_slot", "_batch"
CLOCK = "newest bigint, closed bigint, handled int, needed bigint"


def _us(duration: str) -> int:
    return int(pd.Timedelta(duration).total_seconds() * 1_000_000)


@dataclass(frozen=True)
class Finished:
    """What one batch job sees: rows from ``since`` (None: the beginning) to before ``until`` are complete and new.

    ``number`` is the micro-batch, ``last`` the one that handled slots before it.
    """

    log: SlotLog
    number: int
    last: int | None
    since: int | None
    until: int

    def new(self) -> DataFrame:
        return self.log.rows(self.since, self.until)


@dataclass(frozen=True)
class SlotLog:
    """Rows of a stream below ``path/log``, in one folder per slot of ``ts``."""

    spark: SparkSession
    path: str
    schema: T.StructType
    ts: str
    slot_us: int

    @property
    def folder(self) -> str:
        return f"{self.path}/log"

    def append(self, batch: DataFrame, number: int, closed: int | None) -> None:
        """Add a micro-batch. Rows without a time or of a slot that is closed are dropped."""
        us = epoch_us(F.col(self.ts))
        slot = ((us - F.pmod(us, F.lit(self.slot_us))) / F.lit(self.slot_us)).cast("bigint")
        rows = batch.withColumns({SLOT: slot, BATCH: F.lit(number)})
        rows = rows.where(F.col(SLOT) >= closed) if closed is not None else rows.where(F.col(SLOT).isNotNull())
        writer = rows.hint("rebalance", SLOT).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(SLOT, BATCH).parquet(self.folder)

    def _all(self) -> DataFrame:
        schema = T.StructType([*self.schema, T.StructField(SLOT, T.LongType()), T.StructField(BATCH, T.IntegerType())])
        return self.spark.read.schema(schema).parquet(self.folder)

    def newest(self, number: int) -> int | None:
        """The largest time of a micro-batch's rows."""
        return self._all().where(F.col(BATCH) == number).agg(F.max(epoch_us(F.col(self.ts)))).first()[0]

    def rows(self, since: int | None, until: int | None) -> DataFrame:
        """Rows with since <= time < until, in microseconds; only their slots are read."""
        found, time = self._all(), epoch_us(F.col(self.ts))
        if since is not None:
            found = found.where((F.col(SLOT) >= since // self.slot_us) & (time >= since))
        if until is not None:
            found = found.where((F.col(SLOT) <= (until - 1) // self.slot_us) & (time < until))
        return found.drop(SLOT, BATCH)

    def forget(self, before: int) -> None:
        """Delete the slots that end at or before a time."""
        for slot in self._slots():
            if (slot + 1) * self.slot_us <= before:
                delete_folder(self.spark, f"{self.folder}/{SLOT}={slot}")

    def _slots(self) -> list[int]:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        found = where.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(where)
        names = [s.getPath().getName() for s in found]
        return [int(n.split("=")[1]) for n in names if n.startswith(f"{SLOT}=")]


def by_finished_slots(
    stream: DataFrame, ts: str, slot: str, delay: str, path: str, checkpoint: str,
    handle: Callable[[Finished], tuple[DataFrame, int | None]], once: bool = False,
) -> StreamingQuery:
    """Hand finished slots to ``handle`` as they come; its rows go below ``path/rows``.

    A slot is finished when the newest time of the stream, less ``delay``, has reached its end. ``handle`` also
    returns the time from which on it will need rows again, or None for all. Rows of a finished slot that come later are
    dropped, and rows without a time.
    """
    spark, slot_us, delay_us = stream.sparkSession, _us(slot), _us(delay)
    log = SlotLog(spark, path, stream.schema, ts, slot_us)
    for part in ("log", "rows"):
        make_folder(spark, f"{path}/{part}")

    def write(batch: DataFrame, number: int) -> None:
        clock = spark.read.schema(CLOCK).parquet(batch_folder(f"{path}/clock", number - 1)).first() if number else None
        newest, closed, last, needed = clock or (None, None, None, None)
        if needed is not None:
            log.forget(needed)
        log.append(batch, number, closed)
        newest = max((t for t in (newest, log.newest(number)) if t is not None), default=None)
        upto = None if newest is None else (newest - delay_us) // slot_us
        if upto is not None and (closed is None or upto > closed):
            since = None if closed is None else closed * slot_us
            found, needed = handle(Finished(log, number, last, since, upto * slot_us))
            found.write.mode("overwrite").parquet(batch_folder(f"{path}/rows", number))
            closed, last = upto, number
        after = spark.createDataFrame([(newest, closed, last, needed)], CLOCK)
        after.coalesce(1).write.mode("overwrite").parquet(batch_folder(f"{path}/clock", number))

    return stream_by_batch(stream, write, checkpoint, once=once)


def window_join_finished(
    left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, path: str, checkpoint: str,
    window: str = JOIN_WINDOW, delay: str = "10 seconds", slot: str | None = None, rows_per_task: int = ROWS_PER_BLOCK, once: bool = False,
) -> StreamingQuery:
    """Pairs with equal keys in the same window, made when the window is over.

    A (key, window) too large for one task becomes a grid, as in ``window_join_any_skew``: the sizes
    are counted over the whole window, so no key has to be known as a busy one before. A NULL key meets nothing.
    ``slot`` is a whole number of windows that are handled together, one if it is not given.
    """
    slot = slot or window
    if _us(slot) % _us(window):
        raise ValueError(f"a slot of {slot} is no whole number of windows of {window}")
    l, r = F.struct(*left.columns), F.struct(*right.columns)
    l_type, r_type = left.select(l.alias("s")).schema["s"].dataType, right.select(r.alias("s")).schema["s"].dataType
    both = left.select(F.col(left_ts).alias("_ts"), l.alias("_l"), F.lit(None).cast(r_type).alias("_r")).unionByName(
        right.select(F.col(right_ts).alias("_ts"), F.lit(None).cast(l_type).alias("_l"), r.alias("_r"))
    )

    def pairs(done: Finished) -> tuple[DataFrame, int]:
        rows = done.new()
        lefts, rights = (rows.where(F.col(s).isNotNull()).select(f"{s}.*") for s in ("_l", "_r"))
        return window_join_any_skew(lefts, rights, key, left_ts, right_ts, window, rows_per_task), done.until

    return by_finished_slots(both, "_ts", slot, delay, path, checkpoint, pairs, once)


def sessions_finished(
    events: DataFrame, key: str, ts: str, measure: str, path: str, checkpoint: str,
    gap_seconds: int = CAR_GAP_SECONDS, slot: str = "1 minute", delay: str = "60 seconds",
    rows_per_block: int = ROWS_PER_BLOCK, once: bool = False,
) -> StreamingQuery:
    """Gap sessions of a stream in which one key may hold a large part of the rows.

    Each round makes sessions of the finished slots, in blocks that cut a key where they must, and merges them with those that
    the rounds before left open. A session is given out when no event can join it any more; the
    open ones are carried on as one row each, whatever their size. Results have the columns of ``sessions``.
    """
    gap_us = gap_seconds * 1_000_000

    def grown(done: Finished) -> tuple[DataFrame, int]:
        parts = session_parts(done.new(), key, ts, measure)
        if done.last is not None:
            before = done.log.spark.read.schema(parts.schema).parquet(batch_folder(f"{path}/open", done.last))
            parts = parts.unionByName(before)
        whole = merged_sessions(parts, key, gap_seconds, rows_per_block)
        # Merged once: what is open is written first, and what is over is read from there.
        everything = batch_folder(f"{path}/merged", done.number)
        whole.write.mode("overwrite").parquet(everything)
        whole = done.log.spark.read.schema(whole.schema).parquet(everything)
        ended = epoch_us(F.col("session_end")) + gap_us < done.until
        whole.where(~ended).write.mode("overwrite").parquet(batch_folder(f"{path}/open", done.number))
        if done.last is not None:
            delete_folder(done.log.spark, batch_folder(f"{path}/merged", done.last))
        return session_summary(whole.where(ended), key), done.until

    return by_finished_slots(events.select(key, ts, measure), ts, slot, delay, path, checkpoint, grown, once)


HEARD = "heard bigint"


def timer_triggers_finished(
    events: DataFrame, ts: str, tie: str, timeout: str, path: str, checkpoint: str,
    slot: str = "1 minute", delay: str = "60 seconds", rows_per_block: int = ROWS_PER_BLOCK, once: bool = False,
) -> StreamingQuery:
    """For each event the first event of the whole stream at or after its timer, as ``timer_triggers`` finds it.

    The log is the queue of timers: an event's timer is due one timeout after its slot. A round in which the newest finished event
    moves from one time to another sets off just the timers between the two, so it reads the slots one timeout earlier and no timer
    twice. Timers that nothing has set off yet are in ``open_timers``. Events without a time have no timer.
    """
    timeout_us = _us(timeout)

    def set_off(done: Finished) -> tuple[DataFrame, int | None]:
        spark, fresh = done.log.spark, done.new()
        before = None
        if done.last is not None:
            before = spark.read.schema(HEARD).parquet(batch_folder(f"{path}/heard", done.last)).first().heard
        top = fresh.agg(F.max(epoch_us(F.col(ts)))).first()[0]
        heard = before if top is None else top
        spark.createDataFrame([(heard,)], HEARD).coalesce(1).write.mode("overwrite").parquet(batch_folder(f"{path}/heard", done.number))
        since = None if before is None else before - timeout_us + 1
        # With nothing new the range is empty.
        since, until = (0, 0) if top is None else (since, top - timeout_us + 1)
        timed = done.log.rows(since, until).withColumn("due", F.col(ts) + F.expr(f"INTERVAL {timeout}"))
        found = next_at_or_after(
            timed, fresh.select(ts, tie, F.col(tie).alias("triggered_by")), [], "due", ts, tie, "triggered_by", rows_per_block
        )
        return found, None if heard is None else heard - timeout_us + 1

    return by_finished_slots(events, ts, slot, delay, path, checkpoint, set_off, once)


def open_timers(events: DataFrame, ts: str, timeout: str, path: str, slot: str = "1 minute") -> DataFrame:
    """Finished events below ``path`` whose timer no event has set off yet; ``events`` gives the columns."""
    spark = events.sparkSession
    log = SlotLog(spark, path, events.schema, ts, _us(slot))
    clock = spark.read.schema(f"{CLOCK}, batch int").parquet(f"{path}/clock").orderBy(F.desc("batch")).first()
    if clock is None or clock.handled is None:
        return log.rows(0, 0).withColumn("due", F.col(ts))
    heard = spark.read.schema(HEARD).parquet(batch_folder(f"{path}/heard", clock.handled)).first().heard
    since = None if heard is None else heard - _us(timeout) + 1
    return log.rows(since, clock.closed * log.slot_us).withColumn("due", F.col(ts) + F.expr(f"INTERVAL {timeout}"))
