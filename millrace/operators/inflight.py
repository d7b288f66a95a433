"""Requests that still wait for their response."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.codec import FEATURE_SCORING, PROCESSING_DONE
from millrace.operators.running import ROWS_PER_BLOCK, running, running_last, running_sum
from millrace.session import durable

# The response statuses that close a request.
CLOSING = (FEATURE_SCORING, PROCESSING_DONE)


def open_requests(requests: DataFrame, responses: DataFrame, key: str = "id") -> DataFrame:
    """Requests without a closing response. Keys are made distinct before the join."""
    closed = responses.where(F.col("status").isin(*CLOSING)).select(key).distinct()
    return requests.join(closed, key, "left_anti")


def in_flight_size(
    requests: DataFrame,
    responses: DataFrame,
    ts: str,
    key: str = "id",
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """How many requests are open after each request or response, in order of time.

    A request opens its key and a closing response closes it; repeating either changes
    nothing. At equal times requests come first, then keys in order. A key must not occur
    twice with the same time and side.
    """
    events = requests.select(ts, key, F.lit(0).alias("side"), F.lit(True).alias("_opens")).unionByName(
        responses.select(
            ts, key, F.lit(1).alias("side"),
            F.when(F.col("status").isin(*CLOSING), F.lit(False)).alias("_opens"),
        )
    )
    order = [ts, "side"]
    before = running(
        events, [key], order, {"_was": running_last(F.col("_opens"))}, inclusive=False,
        rows_per_block=rows_per_block,
    )
    was = F.coalesce("_was", F.lit(False)).cast("int")
    now = F.coalesce("_opens", "_was", F.lit(False)).cast("int")
    # The global pass below reads its input several times; it must not redo the keyed one.
    changes = durable(before.select(*order, key, (now - was).alias("change")))
    return running(
        changes, [], [*order, key], {"in_flight": running_sum(F.col("change"))},
        rows_per_block=rows_per_block,
    )
