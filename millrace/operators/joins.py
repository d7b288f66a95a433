"""Two-input operators: window join, as-of join, running enrichment, lookup, timeouts."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.times import epoch_us
from millrace.operators.running import (
    MAX_BLOCKS,
    ROWS_PER_BLOCK,
    running,
    running_last,
    running_max,
)

# The join window, the answer when nothing is known, the separator of the
# running-maximum text, and the response timeout.
JOIN_WINDOW = "3 seconds"
NO_INFO = "No customer info available"
LABEL_GAP = "  "
TIMEOUT_MS = 25


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match each other; keeps the left side's key columns."""
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    match = [left[k].eqNullSafe(other[f"_r_{k}"]) for k in keys]
    joined = left.join(other, reduce(lambda a, b: a & b, match), how)
    return joined.drop(*[f"_r_{k}" for k in keys])


def window_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_ts: str,
    right_ts: str,
    window: str = JOIN_WINDOW,
) -> DataFrame:
    """All pairs with equal keys in the same tumbling window.

    Both sides name the key alike and share no other column. The window start is part of
    the join key, so one shuffle on (key, window) serves, and a busy key spreads over its
    windows.
    """
    left_w = left.withColumn("window_start", F.window(left_ts, window)["start"])
    right_w = right.withColumn("window_start", F.window(right_ts, window)["start"])
    return left_w.join(right_w, [key, "window_start"])


def window_join_any_skew(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_ts: str,
    right_ts: str,
    window: str = JOIN_WINDOW,
    rows_per_task: int = ROWS_PER_BLOCK,
    max_hot: int = MAX_BLOCKS,
) -> DataFrame:
    """The same pairs when a single (key, window) may be too large for one task.

    A large group becomes a grid: its left rows are dealt over the grid's rows and repeated
    along its columns, its right rows the other way round, so every pair meets in exactly one
    place. A side that is small there is not cut. The place of a row follows from its values,
    so a task that runs again deals it alike. A side counts as large beyond 1/``max_hot`` of
    its rows at least, hence the broadcast list has fewer than 2 * ``max_hot`` rows.
    """
    left_w = left.withColumn("window_start", F.window(left_ts, window)["start"])
    right_w = right.withColumn("window_start", F.window(right_ts, window)["start"])
    on = [key, "window_start"]
    sizes = (
        left_w.select(*on, F.lit(1).alias("_l"), F.lit(0).alias("_r"))
        .unionByName(right_w.select(*on, F.lit(0).alias("_l"), F.lit(1).alias("_r")))
        .where(F.col(key).isNotNull())
        .groupBy(*on)
        .agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    )
    lefts, rights, largest = sizes.agg(F.sum("_l"), F.sum("_r"), F.max(F.greatest("_l", "_r"))).first()
    limit = max(rows_per_task, math.ceil(max(lefts or 0, rights or 0) / max_hot))
    if (largest or 0) <= limit:
        return left_w.join(right_w, on)
    cut = [F.greatest(F.lit(1), F.ceil(F.col(c) / limit)).cast("int").alias(c) for c in ("_l", "_r")]
    hot = F.broadcast(sizes.where((F.col("_l") > limit) | (F.col("_r") > limit)).select(*on, *cut))

    def placed(side: DataFrame, dealt: str, repeated: str) -> DataFrame:
        own = F.pmod(F.xxhash64(*side.columns), F.coalesce(dealt, F.lit(1))).cast("int")
        along = F.sequence(F.lit(0), F.coalesce(repeated, F.lit(1)) - 1)
        joined = side.join(hot, on, "left")
        return joined.withColumns({f"{dealt}_at": own, f"{repeated}_at": F.explode(along)}).drop("_l", "_r")

    pairs = placed(left_w, "_l", "_r").join(placed(right_w, "_r", "_l"), [*on, "_l_at", "_r_at"])
    return pairs.drop("_l_at", "_r_at")


def _tagged(left: DataFrame, right: DataFrame, right_first: bool) -> DataFrame:
    """Both inputs as one frame; ``_side`` settles who comes first at equal times."""
    left_side, right_side = (1, 0) if right_first else (0, 1)
    return left.withColumn("_side", F.lit(left_side)).unionByName(
        right.withColumn("_side", F.lit(right_side)), allowMissingColumns=True
    )


def asof_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    ts: str,
    tie: str,
    payload: str,
    default: Column | None = None,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """For each left row the payload of the latest right row at or before it, per key.

    Both sides carry ``key``, ``ts`` and ``tie``; only the right one carries ``payload``.
    One shuffle and one sort: rows are never multiplied, however many the candidates. A NULL
    key matches nothing.
    """
    both = _tagged(left, right.where(F.col(key).isNotNull()).select(key, ts, tie, payload), right_first=True)
    known = running(
        both, [key], [ts, "_side", tie], {"_found": running_last(F.col(payload))},
        rows_per_block=rows_per_block,
    )
    fallback = F.lit(NO_INFO) if default is None else default
    return known.where("_side = 1").select(
        *left.columns, F.coalesce("_found", fallback).alias(payload)
    )


def next_at_or_after(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    tie: str,
    payload: str,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """For each left row the payload of the earliest right row at or after it.

    The mirror image of the as-of join: the order runs backwards in time. Without keys
    the whole input is one group, cut into blocks like any large one. Among right rows of
    equal time the one with the smallest ``tie`` is found. A NULL key matches nothing.
    """
    for key in keys:
        right = right.where(F.col(key).isNotNull())
    back = "_back"
    l = left.withColumns({back: -epoch_us(F.col(left_ts)), "_tie": -F.col(tie)})
    r = right.select(
        *keys, (-epoch_us(F.col(right_ts))).alias(back), (-F.col(tie)).alias("_tie"), F.col(payload).alias("_payload")
    )
    both = _tagged(l, r, right_first=True)
    found = running(
        both, list(keys), [back, "_side", "_tie"], {"_found": running_last(F.col("_payload"))},
        rows_per_block=rows_per_block,
    )
    return found.where("_side = 1").select(*left.columns, F.col("_found").alias(payload))


def request_timeouts(
    requests: DataFrame,
    responses: DataFrame,
    key: str,
    request_ts: str,
    response_ts: str,
    timeout: str,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Requests with their first response within ``timeout``, or NULL when it ran out.

    Only the earliest response at or after the request can decide, so no request is paired
    with all responses of its key.
    """
    found = next_at_or_after(
        requests.withColumn("_one", F.lit(1)),
        responses.select(key, response_ts, F.lit(1).alias("_one")),
        [key], request_ts, response_ts, "_one", response_ts, rows_per_block,
    )
    in_time = F.col(response_ts) <= F.col(request_ts) + F.expr(f"INTERVAL {timeout}")
    return found.drop("_one").withColumn(response_ts, F.when(in_time, F.col(response_ts)))


def timer_triggers(
    events: DataFrame, ts: str, tie: str, timeout: str, rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """For each event the first event of the whole input at or after its timer.

    The result adds ``due`` and ``triggered_by`` (NULL while no later event has come).
    """
    timed = events.withColumn("due", F.col(ts) + F.expr(f"INTERVAL {timeout}"))
    found = next_at_or_after(
        timed, events.select(ts, tie, F.col(tie).alias("triggered_by")), [], "due", ts, tie,
        "triggered_by", rows_per_block,
    )
    return found


def running_max_enrich(
    left: DataFrame,
    right: DataFrame,
    ts: str,
    tie: str,
    value: str,
    keys: Sequence[str] = (),
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Left rows with the largest right value so far, never below zero.

    Order is (ts, tie), a right row going first when both are equal.
    """
    both = _tagged(left, right.select(*keys, ts, tie, value), right_first=True)
    seen = running(
        both, list(keys), [ts, tie, "_side"], {"_max": running_max(F.col(value))},
        rows_per_block=rows_per_block,
    )
    top = F.greatest(F.coalesce("_max", F.lit(0)), F.lit(0))
    return seen.where("_side = 1").select(*left.columns, top.alias("max_so_far"))


def running_max_label(identifier: str = "id", value: str = "max_so_far") -> Column:
    return F.concat(F.col(identifier).cast("string"), F.lit(LABEL_GAP), F.col(value).cast("string"))


def lookup(
    df: DataFrame,
    table: DataFrame,
    key: str,
    max_broadcast_rows: int = 100_000,
    max_broadcast_bytes: int = 32 << 20,
) -> DataFrame:
    """Left join of a batch or a stream with a lookup table of unique keys.

    The table is broadcast only after a look at a bounded part of it shows that it is small
    in rows and in bytes. A larger one is joined by a shuffle, with the adaptive skew join
    splitting a hot key.
    """
    part = table.limit(max_broadcast_rows + 1)
    width = F.octet_length(F.to_json(F.struct("*")))
    rows, size = part.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    small = rows <= max_broadcast_rows and size <= max_broadcast_bytes
    return df.join(F.broadcast(table) if small else table, key, "left")
