"""Streams with keyed state and event-time timers.

All run through ``applyInPandasWithState``: Spark shuffles by key and stores the
state; a function sees one key's new rows of one micro-batch. Its memory is bounded by
the micro-batch (limit it at the source) plus the state, and the watermark trims the
state. Times inside the state are microseconds.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.functions.codec import FEATURE_SCORING, PROCESSING_DONE
from millrace.functions.times import epoch_us
from millrace.operators.joins import NO_INFO
from millrace.session import ship
from millrace.streaming.builtin import watermarked

EVENT_TIMEOUT = GroupStateTimeout.EventTimeTimeout
NO_TIMEOUT = GroupStateTimeout.NoTimeout


def _arrays(fields: Iterable[T.StructField], prefix: str = "") -> list[T.StructField]:
    """State fields that hold a list of each column."""
    return [T.StructField(prefix + f.name, T.ArrayType(f.dataType)) for f in fields]


def _watermark_us(state: GroupState) -> int | None:
    """The watermark, or None before the first one."""
    ms = state.getCurrentWatermarkMs()
    return ms * 1000 if ms > 0 else None


def _set_timer(state: GroupState, us: int) -> None:
    state.setTimeoutTimestamp(-(-int(us) // 1000))


def _rows(chunks: Iterator[pd.DataFrame], columns: Sequence[str]) -> pd.DataFrame:
    frames = list(chunks)
    return pd.concat(frames, ignore_index=True)[list(columns)] if frames else pd.DataFrame(columns=list(columns))


def _stateful(grouped: GroupedData, function, output, state, timeout: str) -> DataFrame:
    """``function`` per group; the workers get the package before it is wrapped, because it is wrapped with its files."""
    ship(SparkSession.getActiveSession())
    return grouped.applyInPandasWithState(function, output, state, "append", timeout)


def _keep_late(timed: DataFrame, ts: str) -> DataFrame:
    """Let late rows through to a state function that has an answer for them.

    Spark drops rows behind the watermark by the event-time column it finds on them; for a
    window that is its end. A window of a hundred years in place of the time lets every
    row pass and leaves the watermark as it is.
    """
    return timed.withColumn("_century", F.window(ts, "36500 days")).drop(ts)


def sort_by_event_time(
    stream: DataFrame, key: str, ts: str, tie: str, delay: str, slot: str = "1 minute", shards: int = 256
) -> DataFrame:
    """Buffer rows and release them in event-time order behind the watermark; drop late ones.

    There is one buffer per time slot and shard of keys. Slots do not overlap, so the order
    of a key is the order of (``slot_start``, ``position``), while a busy key spreads over
    the buffers of many slots. Many quiet keys share a buffer and are handled together. The
    buffer goes away once the watermark has left its slot.
    """
    timed = watermarked(stream, ts, delay).withColumn("_us", epoch_us(F.col(ts)))
    kept = [f for f in timed.schema.fields if f.name != ts]
    names = [f.name for f in kept]
    slots = F.window(ts, slot)
    slotted = timed.withColumns({
        "_slot": epoch_us(slots["start"]),
        "_slot_end": epoch_us(slots["end"]),
        "_shard": F.pmod(F.hash(key), F.lit(shards)),
    })
    output = T.StructType([*kept, T.StructField("_slot", T.LongType()), T.StructField("position", T.LongType())])
    state_type = T.StructType([
        T.StructField("released_keys", T.ArrayType(timed.schema[key].dataType)),
        T.StructField("released", T.ArrayType(T.LongType())),
        *_arrays(kept),
    ])

    def release(group: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark = _watermark_us(state)
        _, slot_start, slot_end = group
        released: dict = {}
        held = None
        if state.exists:
            keys, counts, *lists = state.get
            released = dict(zip(keys, counts))
            held = pd.DataFrame(dict(zip(names, lists))) if lists[0] else None
        if not state.hasTimedOut:
            fresh = _rows(chunks, names)
            if watermark is not None:
                fresh = fresh[fresh["_us"] > watermark]
            held = fresh if held is None else pd.concat([held, fresh], ignore_index=True)
        if held is None:
            held = pd.DataFrame(columns=names)
        held = held.sort_values([key, "_us", tie], kind="stable", ignore_index=True)
        due = np.zeros(len(held), dtype=bool) if watermark is None else (held["_us"] <= watermark).to_numpy(bool)
        out, held = held[due], held[~due]
        if len(out):
            nth = out.groupby(key, dropna=False, sort=False).cumcount() + 1
            before = out[key].map(lambda k: released.get(k, 0))
            out = out.assign(_slot=slot_start, position=(nth + before).astype("int64"))
            released.update(zip(out[key], out["position"].tolist()))
            yield out
        if len(held) or watermark is None or watermark < slot_end:
            state.update((list(released), list(released.values()), *[held[n].tolist() for n in names]))
            _set_timer(state, held["_us"].min() if len(held) else slot_end)
        elif state.exists:
            state.remove()

    grouped = slotted.groupBy("_shard", "_slot", "_slot_end")
    result = _stateful(grouped, release, output, state_type, EVENT_TIMEOUT)
    return result.select(
        key,
        F.timestamp_micros("_us").alias(ts),
        *[n for n in names if n not in (key, "_us")],
        F.timestamp_micros("_slot").alias("slot_start"),
        "position",
    )


def asof_stream(
    trades: DataFrame, infos: DataFrame, key: str, ts: str, tie: str, payload: str,
    delay: str, default: str = NO_INFO, salts: int = 1,
) -> DataFrame:
    """Early as-of answers, corrected at most once when the watermark passes.

    A trade is answered on arrival with what is known (``is_final`` false). When the
    watermark reaches it and the answer has changed, the new one follows (``is_final``
    true). A late trade is answered once, as final. Behind the watermark only the newest
    info is kept.

    With ``salts`` > 1 the trades of a key are dealt over that many states, each of which
    gets all infos of the key: for keys with more waiting trades than one state should hold.
    """
    columns = [key, ts, tie]
    dealt = F.pmod(F.xxhash64(tie), F.lit(salts)).cast("int")
    to_all = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    sides = trades.select(
        *columns, F.lit(None).cast("string").alias(payload), F.lit(True).alias("_trade"), dealt.alias("_salt")
    ).unionByName(infos.select(*columns, payload, F.lit(False).alias("_trade"), to_all.alias("_salt")))
    timed = _keep_late(watermarked(sides, ts, delay).withColumn("_us", epoch_us(F.col(ts))), ts)
    tie_type = timed.schema[tie].dataType
    output = T.StructType([
        timed.schema[key],
        T.StructField("_us", T.LongType()),
        T.StructField(tie, tie_type),
        T.StructField(payload, T.StringType()),
        T.StructField("is_final", T.BooleanType()),
    ])
    state_type = T.StructType(_arrays([
        T.StructField("info_us", T.LongType()),
        T.StructField("info", T.StringType()),
        T.StructField("trade_us", T.LongType()),
        T.StructField("trade", tie_type),
        T.StructField("answered", T.StringType()),
    ]))

    def answer(us: np.ndarray, info_us: np.ndarray, info: np.ndarray) -> np.ndarray:
        if not len(info):
            return np.full(len(us), default, dtype=object)
        at = np.searchsorted(info_us, us, side="right") - 1
        return np.where(at >= 0, info[np.maximum(at, 0)], default)

    def match(key_: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark = _watermark_us(state)
        info_us, info, wait_us, wait, answered = (
            [list(v) for v in state.get] if state.exists else ([], [], [], [], [])
        )
        emitted = []

        def emit(us, ids, answers, final) -> None:
            emitted.append(pd.DataFrame({key: key_[0], "_us": us, tie: ids, payload: answers, "is_final": final}))

        fresh = None
        if not state.hasTimedOut:
            rows = _rows(chunks, ["_us", tie, payload, "_trade"]).sort_values(["_us", tie], ignore_index=True)
            is_trade = rows["_trade"].to_numpy(dtype=bool)
            news, fresh = rows[~is_trade], rows[is_trade]
            info_us += news["_us"].tolist()
            info += news[payload].tolist()
        by_time = np.argsort(np.array(info_us, dtype=np.int64), kind="stable")
        known_us = np.array(info_us, dtype=np.int64)[by_time]
        known = np.array(info, dtype=object)[by_time]

        if fresh is not None and len(fresh):
            us = fresh["_us"].to_numpy(np.int64)
            answers = answer(us, known_us, known)
            late = us <= watermark if watermark is not None else np.zeros(len(us), dtype=bool)
            emit(us, fresh[tie].to_numpy(), answers, late)
            wait_us += us[~late].tolist()
            wait += fresh[tie].to_numpy()[~late].tolist()
            answered += answers[~late].tolist()

        if watermark is not None:
            us = np.array(wait_us, dtype=np.int64)
            due = us <= watermark
            if due.any():
                final = answer(us[due], known_us, known)
                ids, old = np.array(wait)[due], np.array(answered, dtype=object)[due]
                changed = final != old
                if changed.any():
                    emit(us[due][changed], ids[changed], final[changed], True)
                keep = np.flatnonzero(~due)
                wait_us, wait, answered = ([v[i] for i in keep] for v in (wait_us, wait, answered))
            first_needed = max(int(np.searchsorted(known_us, watermark, side="right")) - 1, 0)
            known_us, known = known_us[first_needed:], known[first_needed:]

        state.update((known_us.tolist(), known.tolist(), wait_us, wait, answered))
        if wait_us:
            _set_timer(state, min(wait_us))
        yield from emitted

    result = _stateful(timed.groupBy(key, "_salt"), match, output, state_type, EVENT_TIMEOUT)
    return result.select(key, F.timestamp_micros("_us").alias(ts), tie, payload, "is_final")


def in_flight_stream(
    requests: DataFrame, responses: DataFrame, ts: str, key: str = "id", shards: int = 256, expire_after: str | None = None
) -> DataFrame:
    """Changes of the number of open requests: +1 when a key opens, -1 when it closes.

    Keys are spread over ``shards`` states, each a set of open keys with their times; a closed key leaves no
    trace. With ``expire_after`` a key that waits for longer than that leaves as soon as its shard
    sees a later time, with a change of -1 on side 2 at the time it expired; else it waits for ever. The size at any time
    is the sum of the changes.
    """
    closing = F.col("status").isin(FEATURE_SCORING, PROCESSING_DONE)
    events = requests.select(key, ts, F.lit(0).alias("side")).unionByName(
        responses.where(closing).select(key, ts, F.lit(1).alias("side"))
    )
    events = events.withColumns({"_us": epoch_us(F.col(ts)), "_shard": F.pmod(F.hash(key), F.lit(shards))})
    output = T.StructType([
        events.schema[key],
        T.StructField("_us", T.LongType()),
        T.StructField("side", T.IntegerType()),
        T.StructField("change", T.IntegerType()),
    ])
    state_type = T.StructType(_arrays([events.schema[key], T.StructField("opened", T.LongType())]))
    lives_us = None if expire_after is None else int(pd.Timedelta(expire_after).total_seconds() * 1_000_000)

    def track(_: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = _rows(chunks, [key, "_us", "side"])
        opened = dict(zip(*state.get)) if state.exists else {}
        if lives_us is not None and len(rows):
            # A key that has expired by the newest row is closed at that time, before what comes later.
            newest = int(rows["_us"].max())
            asked = rows[rows["side"] == 0]
            due = [(k, us + lives_us) for k, us in [*opened.items(), *zip(asked[key].tolist(), asked["_us"].tolist())] if us + lives_us <= newest]
            if due:
                keys, times = zip(*due)
                ends = pd.DataFrame({key: pd.Series(keys, dtype=rows[key].dtype), "_us": times, "side": 2})
                rows = pd.concat([rows, ends], ignore_index=True)
        rows = rows.sort_values([key, "_us", "side"], ignore_index=True)
        change = np.zeros(len(rows), dtype="int32")
        keys, times, sides = rows[key].tolist(), rows["_us"].tolist(), rows["side"].tolist()
        for i, (k, us, side) in enumerate(zip(keys, times, sides)):
            was = k in opened
            if side == 0:
                change[i] = not was
                opened.setdefault(k, us)
            elif was and (side == 1 or opened[k] + lives_us == us):
                change[i] = -1
                del opened[k]
        state.update((list(opened), list(opened.values())))
        yield rows.assign(change=change)[(change != 0) | (rows["side"] < 2).to_numpy()]

    result = _stateful(events.groupBy("_shard"), track, output, state_type, NO_TIMEOUT)
    return result.select(key, F.timestamp_micros("_us").alias(ts), "side", "change")


def running_max_stream(
    left: DataFrame, right: DataFrame, key: str, ts: str, tie: str, value: str
) -> DataFrame:
    """Left rows with the largest right value of their key so far, never below zero."""
    both = left.select(key, ts, tie, F.lit(None).cast("double").alias("_v"), F.lit(1).alias("side")).unionByName(
        right.select(key, ts, tie, F.col(value).cast("double").alias("_v"), F.lit(0).alias("side"))
    )
    both = both.withColumn("_us", epoch_us(F.col(ts))).drop(ts)
    output = T.StructType([
        both.schema[key],
        T.StructField("_us", T.LongType()),
        both.schema[tie],
        T.StructField("max_so_far", T.DoubleType()),
    ])

    def enrich(key_: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = _rows(chunks, ["_us", tie, "_v", "side"]).sort_values(["_us", tie, "side"], ignore_index=True)
        start = state.get[0] if state.exists else 0.0
        top = np.maximum.accumulate(np.concatenate([[start], rows["_v"].fillna(0.0).to_numpy(float)]))[1:]
        state.update((float(top[-1]),))
        left_rows = rows["side"].to_numpy() == 1
        if left_rows.any():
            yield pd.DataFrame({
                key: key_[0], "_us": rows["_us"][left_rows], tie: rows[tie][left_rows], "max_so_far": top[left_rows],
            })

    result = _stateful(both.groupBy(key), enrich, output, "top double", NO_TIMEOUT)
    return result.select(key, F.timestamp_micros("_us").alias(ts), tie, "max_so_far")
