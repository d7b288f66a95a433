"""Value histograms that can be added up: minutes roll up to hours, batches and streams to one another.

A bucket holds the whole numbers that agree in their sign and their first ``bits`` + 1 binary digits, so its width
is at most ``2 ** -bits`` of its lower end and every value below ``2 ** (bits + 1)`` has a bucket of its own. There are at most
``128 * 2 ** bits`` buckets for a name and period, whatever the number of samples. All of it is column functions and sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.metrics import PERIOD

BITS = 5


def _shift(value: Column, bits: int) -> Column:
    """How many low digits a bucket leaves open."""
    return F.greatest(F.length(F.bin(F.abs(value))) - (bits + 1), F.lit(0))


def bucket_of(value: Column, bits: int = BITS) -> Column:
    """The end of the value's bucket that is nearer to zero."""
    shift = _shift(value, bits)
    digits = F.call_function("shiftright", F.abs(value), shift)
    return F.call_function("shiftleft", digits, shift) * F.signum(value).cast("bigint")


def value_histogram(samples: DataFrame, ts: str = "ts", value: str = "value", period: str = PERIOD, bits: int = BITS) -> DataFrame:
    """``(period_start, metric, bucket, n)``; NULL values count nowhere. With a watermark it is a stream."""
    present = samples.where(F.col(value).isNotNull()).withColumn("bucket", bucket_of(F.col(value).cast("bigint"), bits))
    counted = present.groupBy(F.window(ts, period).alias("w"), "metric", "bucket").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("w.start").alias("period_start"), "metric", "bucket", "n")


def rolled_up(histogram: DataFrame, period: str) -> DataFrame:
    """The histogram of longer periods, which the shorter ones must divide."""
    start = F.window("period_start", period)["start"].alias("period_start")
    return histogram.groupBy(start, "metric", "bucket").agg(F.sum("n").alias("n"))


def merged(*histograms: DataFrame) -> DataFrame:
    """One histogram of all samples of several."""
    both = histograms[0]
    for other in histograms[1:]:
        both = both.unionByName(other)
    return both.groupBy("period_start", "metric", "bucket").agg(F.sum("n").alias("n"))


def histogram_quantiles(histogram: DataFrame, probs: dict[str, float]) -> DataFrame:
    """``(period_start, metric, n, <name> ..)``: the bucket that holds the sample of rank ``floor(p * (n - 1))``.

    The sample itself is no nearer to zero than that, and farther by ``2 ** -bits`` of it at most.
    """
    group = Window.partitionBy("period_start", "metric")
    upto = F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    ranked = histogram.withColumn("_upto", upto).withColumn("_size", F.sum("n").over(group))
    picks = [F.min(F.when(F.col("_upto") > F.floor(F.lit(float(p)) * (F.col("_size") - 1)), F.col("bucket"))).alias(name) for name, p in probs.items()]
    return ranked.groupBy("period_start", "metric").agg(F.max("_size").alias("n"), *picks)
