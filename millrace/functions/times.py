"""Event-time arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def from_epoch_ms(ms: Column) -> Column:
    """Epoch milliseconds to a timestamp."""
    return F.timestamp_millis(ms)


def epoch_ms(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def epoch_us(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def elapsed_minutes(start: Column, end: Column) -> Column:
    return (epoch_ms(end) - epoch_ms(start)) / F.lit(60000.0)


def window_end_ms(window: Column) -> Column:
    """Exclusive end of a window, in epoch milliseconds."""
    return epoch_ms(window["end"])


def now_ms() -> Column:
    return F.unix_millis(F.current_timestamp())


def plus_us(ts: Column, micros: Column | int) -> Column:
    """``ts`` shifted by microseconds; keeps the type of ``ts``."""
    return ts + F.expr("INTERVAL '0.000001' SECOND") * micros
