"""Status hops of the click pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.codec import (
    BUSINESS_TOPIC,
    FEATURE_SCORING,
    PRE_PROCESSING,
    PROCESSING_DONE,
    REQUEST_TOPIC,
    SCORED_TOPIC,
    decode_clicks,
    encode_clicks,
)
from millrace.operators.rows import with_status


def set_status(clicks: DataFrame, status: str) -> DataFrame:
    return clicks.withColumn("status", F.lit(status))


def status_hop(rows: DataFrame, source: str, before: str, after: str, target: str) -> DataFrame:
    """Topic rows in, topic rows out: clicks in one status move on to the next one."""
    clicks = decode_clicks(rows, [source])
    return encode_clicks(set_status(with_status(clicks, before), after), target)


def score_requests(rows: DataFrame) -> DataFrame:
    return status_hop(rows, REQUEST_TOPIC, PRE_PROCESSING, FEATURE_SCORING, BUSINESS_TOPIC)


def finish_scored(rows: DataFrame) -> DataFrame:
    return status_hop(rows, BUSINESS_TOPIC, FEATURE_SCORING, PROCESSING_DONE, SCORED_TOPIC)


def click_hops(clicks: DataFrame) -> DataFrame:
    """New requests through both hops, as decoded clicks of the scored topic."""
    requests = encode_clicks(with_status(clicks, PRE_PROCESSING), REQUEST_TOPIC)
    return decode_clicks(finish_scored(score_requests(requests)), [SCORED_TOPIC])
