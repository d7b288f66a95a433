"""Rows held back until the watermark has passed them, then handled in event-time order.

State is kept through ``transformWithState``: a key has one buffer per time slot, and each
micro-batch appends chunks to the slots it touches, so what a micro-batch writes does not grow with what waits.
One timer per slot, at its end, releases it: by then no row of the slot can come any more, and
all earlier slots of the key have been released. So the order is that of the batch operators, whatever the
order of arrival inside the delay and however the input lies in files.

Needs the RocksDB state store; ``sources.writers.drain`` and ``with_rocksdb`` turn it on.
"""

from __future__ import annotations

import sys
from abc import abstractmethod
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.functions.geo import GridSpec
from millrace.functions.times import epoch_us
from millrace.operators.joins import NO_INFO
from millrace.operators.travel_time import ride_features
from millrace.streaming.builtin import watermarked


# How many rows of a state are taken from a micro-batch at once, and how many states a shard of keys is dealt over.
ROWS_AT_ONCE = 1 << 16
PARTS = 4


def packed(frame: pd.DataFrame) -> tuple[bytes]:
    """Rows as one binary value of the state."""
    batch = pa.RecordBatch.from_pandas(frame, preserve_index=False).replace_schema_metadata(None)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as out:
        out.write_batch(batch)
    return (sink.getvalue().to_pybytes(),)


def unpacked(value: tuple[bytes]) -> pd.DataFrame:
    return pa.ipc.open_stream(value[0]).read_all().to_pandas()


def gathered(frames: Iterator[pd.DataFrame], names: list[str], limit: int = ROWS_AT_ONCE) -> Iterator[pd.DataFrame]:
    """The frames in runs of about ``limit`` rows."""
    held, size = [], 0
    for frame in frames:
        held.append(frame[names])
        size += len(frame)
        if size >= limit:
            yield pd.concat(held, ignore_index=True)
            held, size = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


class InOrder(StatefulProcessor):
    """Hands the rows of each slot to ``released``, sorted by ``order``, slot after slot.

    ``fields`` are the columns to keep; the first is the time in microseconds, ``us``.
    """

    def __init__(self, fields: list[T.StructField], order: list[str], slot_us: int):
        self.fields, self.order, self.slot_us = fields, order, slot_us
        self.names = [f.name for f in fields]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle_ = handle
        self.chunks = handle.getMapState("chunks", "slot bigint, nth int", "rows binary")
        self.sizes = handle.getMapState("sizes", "slot bigint", "n int")
        self.start(handle)

    def start(self, handle: StatefulProcessorHandle) -> None:
        """Set up what the subclass remembers."""

    @abstractmethod
    def released(self, key: tuple, slot: int, rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """The answer to the rows of one slot."""

    def wakes(self, rows: pd.DataFrame) -> np.ndarray:
        """Further times at which these rows' key is to be asked, in microseconds."""
        return np.zeros(0, dtype=np.int64)

    def _end_ms(self, slot: int) -> int:
        return -(-(slot + 1) * self.slot_us // 1000)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        before, sizes = {}, {}

        def chunks_of(slot: int) -> int:
            if slot not in sizes:
                found = self.sizes.getValue((slot,)) if self.sizes.containsKey((slot,)) else None
                before[slot] = sizes[slot] = found[0] if found else 0
                if not found:
                    before[slot] = None
                    self.handle_.registerTimer(self._end_ms(slot))
            return sizes[slot]

        for frame in gathered(rows, self.names):
            frame = frame[frame["us"].notna()]
            for slot, own in frame.groupby(frame["us"].astype("int64") // self.slot_us, sort=True):
                slot = int(slot)
                if self._end_ms(slot) <= watermark:
                    continue  # released before: the rows are late
                n = chunks_of(slot)
                self.chunks.updateValue((slot, n), packed(own))
                sizes[slot] = n + 1
                for later in np.unique(self.wakes(own) // self.slot_us).tolist():
                    chunks_of(later)
        for slot, n in sizes.items():
            if n != before[slot]:
                self.sizes.updateValue((slot,), (n,))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        slot = expiredTimerInfo.getExpiryTimeInMs() * 1000 // self.slot_us - 1
        n = self.sizes.getValue((slot,))[0]
        parts = [pd.DataFrame(columns=self.names)] if not n else []
        for nth in range(n):
            parts.append(unpacked(self.chunks.getValue((slot, nth))))
            self.chunks.removeKey((slot, nth))
        self.sizes.removeKey((slot,))
        rows = pd.concat(parts, ignore_index=True).sort_values(self.order, kind="stable", ignore_index=True)
        yield from self.released(key, slot, rows)

    def close(self) -> None:
        pass


def in_order(timed: DataFrame, keys: list[str], processor: InOrder, output: T.StructType | str) -> DataFrame:
    """Run a processor over a stream that has its watermark and the processor's columns."""
    # The driver's helper process, which asks a processor for its state's columns, has no shipped files.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    return timed.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=output, outputMode="Append", timeMode="EventTime"
    )


class _TravelTimes(InOrder):
    """One least-squares model per key: five sums, exact at any size."""

    def start(self, handle: StatefulProcessorHandle) -> None:
        self.sums = handle.getValueState("sums", "n string, sx string, sy string, sxx string, sxy string")

    def released(self, key: tuple, slot: int, rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        start = rows["is_start"].to_numpy(dtype=bool)
        x, y = rows["distance"].to_numpy(float), rows["duration"].to_numpy(float)
        trains = ~start & ~np.isnan(x) & ~np.isnan(y)
        # Python's whole numbers, kept as text: they outgrow every number type of the state.
        whole_x, whole_y = (np.where(trains, v, 0).astype("int64").astype(object) for v in (x, y))
        terms = np.vstack([trains.astype("int64").astype(object), whole_x, whole_y, whole_x * whole_x, whole_x * whole_y])
        before = [int(v) for v in self.sums.get()] if self.sums.exists() else [0] * 5
        known = np.array(before, dtype=object)[:, None] + terms.cumsum(axis=1)
        self.sums.update(tuple(str(v) for v in known[:, -1]))
        n, sx, sy, sxx, sxy = known[:, start].astype(float)
        spread = n * sxx - sx * sx
        with np.errstate(divide="ignore", invalid="ignore"):
            slope = np.where(spread != 0, (n * sxy - sx * sy) / spread, 0.0)
            fitted = ((sy - slope * sx) / n + slope * x[start]) / 60000.0
        whole = pd.Series(np.where(n > 0, np.trunc(fitted), np.nan)).astype("Int32")
        if len(whole):
            yield pd.DataFrame({"ride_id": rows["ride_id"].to_numpy()[start], "cell": key[0], "bucket": key[1], "minutes": whole})


def travel_time_stream(rides: DataFrame, grid: GridSpec, delay: str = "60 seconds", slot_seconds: int = 60, ts: str = "ts") -> DataFrame:
    """A prediction for each ride start from the ride ends before it in event time, one model per key.

    Rides wait for the watermark, so predictions equal the batch operator's on all rides that are no later than
    ``delay``; later ones are dropped. A ride is answered at most ``slot_seconds`` after the watermark has reached it.
    """
    features = ride_features(watermarked(rides, ts, delay), grid, ts).withColumn("us", epoch_us(F.col(ts)))
    kept = ["us", "ride_id", "is_start", "distance", "duration"]
    timed = features.select("cell", "bucket", ts, *kept)
    fields = [T.StructField(c, timed.schema[c].dataType) for c in kept]
    processor = _TravelTimes(fields, ["us", "ride_id"], slot_seconds * 1_000_000)
    return in_order(timed, ["cell", "bucket"], processor, "ride_id bigint, cell int, bucket int, minutes int")


MICROSECONDS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


class _AsOf(InOrder):
    """The newest info at or before each trade, twice: as known on arrival, and as it is.

    A state has many keys, ``k`` names a row's; they are answered together.
    """

    def __init__(self, fields, order, slot_us, tie: str, payload: str, default: str):
        super().__init__(fields, order, slot_us)
        self.tie, self.payload, self.default = tie, payload, default

    def start(self, handle: StatefulProcessorHandle) -> None:
        # Per key the newest released info, and the newest seen at all.
        self.settled = handle.getValueState("settled", "infos binary")
        self.newest = handle.getValueState("newest", "infos binary")

    def _known(self, rows: pd.DataFrame, *states) -> pd.DataFrame:
        """Infos in the order of their times; of one time, those of a later state are later, and the rows' own come last."""
        own = rows.loc[rows["side"] == 0, ["us", "k", self.payload]].set_axis(["us", "k", "info"], axis=1)
        frames = [f for f in (*(unpacked(s.get()) for s in states if s.exists()), own) if len(f)] or [own]
        known = pd.concat(frames, ignore_index=True).astype({"us": "int64", "k": object, "info": object})
        return known.sort_values("us", kind="stable", ignore_index=True)

    def _answers(self, rows: pd.DataFrame, known: pd.DataFrame, is_final: bool) -> Iterator[pd.DataFrame]:
        trades = rows.loc[rows["side"] == 1, ["us", "k", self.tie]].set_axis(["us", "k", "tie"], axis=1).astype({"us": "int64", "k": object})
        if len(trades):
            found = pd.merge_asof(trades, known.assign(hit=True), on="us", by="k")
            info = found["info"].astype(object).where(found["hit"].notna(), self.default)
            yield pd.DataFrame({"k": found["k"], "us": found["us"], "tie": found["tie"], "info": info.where(info.notna(), None), "is_final": is_final})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows), ignore_index=True)[self.names].sort_values(self.order, kind="stable", ignore_index=True)
        timed = frame[frame["us"].notna()]
        known = self._known(timed, self.settled, self.newest)
        if (timed["side"] == 0).any():
            self.newest.update(packed(known.drop_duplicates("k", keep="last")))
        yield from self._answers(timed, known, False)
        never = frame.loc[frame["us"].isna() & (frame["side"] == 1), ["k", self.tie]].set_axis(["k", "tie"], axis=1)
        if len(never):
            yield never.assign(us=None, info=self.default, is_final=False)[["k", "us", "tie", "info", "is_final"]]
        yield from super().handleInputRows(key, iter((timed,)), timerValues)

    def released(self, key: tuple, slot: int, rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        known = self._known(rows, self.settled)
        if (rows["side"] == 0).any():
            self.settled.update(packed(known.drop_duplicates("k", keep="last")))
        yield from self._answers(rows, known, True)


def _key_text(key: str) -> Column:
    return F.to_json(F.struct(F.col(key).alias("k")), MICROSECONDS)


def asof_refined_stream(
    trades: DataFrame, infos: DataFrame, key: str, ts: str, tie: str, payload: str, delay: str, slot_seconds: int = 3600, default: str = NO_INFO,
    shards: int = 16,
) -> DataFrame:
    """``(key, ts, tie, payload, is_final)``: an early answer to each trade on arrival, and the final one later.

    The early one is a guess from what the key has seen. The final one comes once the watermark has passed the slot,
    for every trade that was not later than ``delay``, and equals the batch join's: infos of one time are ordered
    by ``tie``. Later trades get an early answer only, so no final one is wrong. Behind the watermark one info of a key is kept.
    A NULL key matches nothing, and so does a trade without a time, which has no final answer. Keys are dealt over ``shards`` times ``PARTS`` states.
    """
    sides = trades.select(key, ts, tie, F.lit(None).cast("string").alias(payload), F.lit(1).alias("side")).unionByName(
        infos.where(F.col(key).isNotNull()).select(key, ts, tie, payload, F.lit(0).alias("side"))
    )
    kept = ["us", "k", tie, payload, "side"]
    # Trades without a key match nothing, so any state has an answer to them.
    dealt = F.hash(F.coalesce(F.col(key).cast("string"), F.col(tie).cast("string")))
    timed = watermarked(sides, ts, delay).withColumns({"us": epoch_us(F.col(ts)), "k": _key_text(key), "_shard": F.pmod(dealt, F.lit(shards * PARTS))})
    timed = timed.select("_shard", ts, *kept)
    fields = [T.StructField(c, timed.schema[c].dataType) for c in kept]
    output = T.StructType([
        T.StructField("k", T.StringType()), T.StructField("us", T.LongType()), T.StructField("tie", timed.schema[tie].dataType),
        T.StructField("info", T.StringType()), T.StructField("is_final", T.BooleanType()),
    ])
    processor = _AsOf(fields, ["us", "side", tie], slot_seconds * 1_000_000, tie, payload, default)
    found = in_order(timed, ["_shard"], processor, output)
    whole = F.from_json("k", T.StructType([T.StructField("k", trades.schema[key].dataType)]), MICROSECONDS)["k"]
    return found.select(whole.alias(key), F.timestamp_micros("us").alias(ts), F.col("tie").alias(tie), F.col("info").alias(payload), "is_final")


REQUEST, RESPONSE = 0, 1


class _FirstResponse(InOrder):
    """The first response of each request, or none once it can no longer come in time."""

    def __init__(self, fields, order, slot_us, timeout_us: int):
        super().__init__(fields, order, slot_us)
        self.timeout_us = timeout_us

    def start(self, handle: StatefulProcessorHandle) -> None:
        self.waiting = handle.getValueState("waiting", "requests binary")

    def wakes(self, rows: pd.DataFrame) -> np.ndarray:
        # A request's time runs out in a slot whose timer has to come even if nothing else does.
        return rows.loc[rows["side"] == REQUEST, "us"].to_numpy(np.int64) + self.timeout_us

    def released(self, key: tuple, slot: int, rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        end = (slot + 1) * self.slot_us
        asked = rows.loc[rows["side"] == REQUEST, ["us", "k", "request"]]
        if self.waiting.exists():
            before = unpacked(self.waiting.get())
            asked = pd.concat([before, asked], ignore_index=True) if len(asked) else before
            self.waiting.clear()
        if not len(asked):
            return
        asked = asked.astype({"us": "int64", "k": object}).sort_values("us", kind="stable", ignore_index=True)
        answers = rows.loc[rows["side"] == RESPONSE, ["us", "k"]].astype({"us": "int64", "k": object})
        answers = answers.assign(answer=answers["us"].astype("Int64")).sort_values("us", kind="stable")
        found = pd.merge_asof(asked, answers, on="us", by="k", direction="forward", tolerance=self.timeout_us)
        # Slots come in order: what has no answer in time by the end of this one has none at all.
        over = (found["answer"].notna() | (found["us"] + self.timeout_us < end)).to_numpy(bool)
        held = found[~over]
        if len(held):
            self.waiting.update(packed(held[["us", "k", "request"]]))
        if over.any():
            yield found.loc[over, ["us", "request", "answer"]]


def first_response_stream(
    requests: DataFrame, responses: DataFrame, key: str, request_ts: str, response_ts: str,
    timeout: str, delay: str, slot_seconds: int = 60, shards: int = 256,
) -> DataFrame:
    """Each request once, with its first response inside the timeout or NULL, as ``request_timeouts`` gives it.

    Keys are dealt over ``shards`` times ``PARTS`` states, in which a request waits for no longer than the timeout and a slot; a state's
    requests are answered together. Each request also sets the timer of the slot in which its time runs out. Rows later than ``delay``
    are dropped, and rows without a time. A NULL key is never answered.
    """
    timeout_us = int(pd.Timedelta(timeout).total_seconds() * 1_000_000)
    others = [c for c in requests.columns if c != request_ts]
    whole = F.to_json(F.struct(*others), MICROSECONDS)
    k = _key_text(key)
    asked = requests.select(F.col(request_ts).alias("_ts"), k.alias("k"), whole.alias("request"), F.lit(REQUEST).alias("side"))
    # No request has the empty text. Responses without a key stay, because their times move the watermark.
    answered = responses.select(
        F.col(response_ts).alias("_ts"), F.when(F.col(key).isNull(), F.lit("")).otherwise(k).alias("k"), F.lit(None).cast("string").alias("request"), F.lit(RESPONSE).alias("side")
    )
    # A watermark on each side: the slower side sets the pace.
    timed = watermarked(asked, "_ts", delay).unionByName(watermarked(answered, "_ts", delay))
    us = epoch_us(F.col("_ts"))
    dealt = F.hash(F.when(F.col("k") == "", us.cast("string")).otherwise(F.col("k")))
    timed = timed.select("_ts", F.pmod(dealt, F.lit(shards * PARTS)).alias("_shard"), us.alias("us"), "k", "request", "side")
    kept = ["us", "k", "request", "side"]
    fields = [T.StructField(c, timed.schema[c].dataType) for c in kept]
    processor = _FirstResponse(fields, ["us", "side"], slot_seconds * 1_000_000, timeout_us)
    found = in_order(timed, ["_shard"], processor, "us bigint, request string, answer bigint")
    kinds = T.StructType([requests.schema[c] for c in others])
    whole = F.from_json("request", kinds, MICROSECONDS)
    return found.select(
        F.timestamp_micros("us").alias(request_ts), whole.alias("_r"), F.timestamp_micros("answer").alias(response_ts)
    ).select(*[F.col(c) if c == request_ts else F.col(f"_r.{c}") for c in requests.columns], response_ts)
