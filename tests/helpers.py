"""Small conveniences for tests."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

EPOCH = datetime(2024, 1, 1)


def at(seconds: float) -> datetime:
    return EPOCH + timedelta(seconds=seconds)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def with_time(df, column="s", name="ts"):
    """A zone-less time from a column of seconds."""
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    step = F.expr("INTERVAL '0.001' SECOND") * F.round(F.col(column) * 1000).cast("bigint")
    return df.withColumn(name, start + step)


def same(left, right):
    """Both frames hold the same rows, counting repeats."""
    right = right.select(*left.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()
