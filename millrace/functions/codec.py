"""Delimited click-event codec between typed rows and topic rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Statuses, topic names, field order and delimiter of the click format.
PRE_PROCESSING = "PreProcessing"
FEATURE_SCORING = "FeatureScoring"
PROCESSING_DONE = "ProcessingDone"
REQUEST_TOPIC = "TEST"
BUSINESS_TOPIC = "BusinessEvents"
SCORED_TOPIC = "ScoredEvents"
FIELDS = ("customer", "clicked_item", "event_time", "status", "id")
DELIMITER = "|"
CHARSET = "UTF-8"


def with_defaults(clicks: DataFrame) -> DataFrame:
    """Fill a missing status and a missing id.

    ``uuid()`` is not repeatable: write the result before using it twice.
    """
    return clicks.withColumns(
        {
            "status": F.coalesce("status", F.lit(PRE_PROCESSING)),
            "id": F.coalesce("id", F.uuid()),
        }
    )


def click_text() -> Column:
    """One delimited line; an absent field prints as ``null`` so positions never shift."""
    return F.concat_ws(DELIMITER, *[F.coalesce(F.col(f).cast("string"), F.lit("null")) for f in FIELDS])


def encode_clicks(clicks: DataFrame, topic: str, keep: Iterable[str] = ()) -> DataFrame:
    """Typed clicks to topic rows, keyed by customer."""
    return clicks.select(
        F.encode("customer", CHARSET).alias("key"),
        F.encode(click_text(), CHARSET).alias("value"),
        F.lit(topic).alias("topic"),
        *keep,
    )


def _fields(parts: Column) -> Column:
    """The fields of one split line; ``ok`` tells whether it is well formed.

    Trailing empty fields do not count, so something must stand in the last field or after.
    """
    raw = F.get(parts, F.lit(2))
    time = F.when(raw.rlike(r"\A[+-]?[0-9]+\z"), raw.try_cast("bigint"))
    named = [(time if f == "event_time" else F.get(parts, F.lit(i))).alias(f) for i, f in enumerate(FIELDS)]
    complete = F.array_join(F.slice(parts, len(FIELDS), F.size(parts)), "") != ""
    return F.struct((complete & time.isNotNull()).alias("ok"), *named)


def _parsed(rows: DataFrame, topics: Iterable[str]) -> DataFrame:
    """Rows of the given topics with their parsed fields.

    A one-element generator holds the parse. Predicates on the fields stay above it, so a
    chain of hops evaluates each parse once instead of once per predicate that uses it.
    """
    parts = F.split(F.decode("value", CHARSET), r"\|")
    gated = rows.where(F.col("topic").isin(*topics))
    return gated.select("*", F.inline(F.transform(F.array(parts), _fields)))


def decode_clicks(rows: DataFrame, topics: Iterable[str], keep: Iterable[str] = ()) -> DataFrame:
    """Topic rows of the given topics to typed clicks; malformed rows are left to ``corrupt_rows``."""
    return _parsed(rows, topics).where("ok").select(*FIELDS, *keep)


def corrupt_rows(rows: DataFrame, topics: Iterable[str]) -> DataFrame:
    """Topic rows of the given topics that do not decode, unchanged."""
    return _parsed(rows, topics).where(~F.coalesce("ok", F.lit(False))).select(*rows.columns)
