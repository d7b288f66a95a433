"""Metric roll-ups: counters and distributions per name and period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from millrace.operators.joins import join_null_safe
from millrace.operators.running import ROWS_PER_BLOCK, running, running_sum
from millrace.session import durable

# The metric prefix and names, and the reporting period.
PREFIX = "sdp.heartbeat"
REQUESTS = "requests"
PREPROCESSING_RESPONSE = "preprocessing.response"
PREPROCESSING_RESPONSE_TIME = "preprocessing.response.time"
SCORING_RESPONSE = "fexnscoring.response"
SCORING_RESPONSE_CASED = "fexNScoring.response"
SCORING_RESPONSE_TIME = "fexnscoring.response.time"
PERIOD = "1 minute"


def metric_name(*parts: Column | str) -> Column:
    """Dotted name below the common prefix."""
    return F.concat_ws(".", F.lit(PREFIX), *parts)


def metric_counts(samples: DataFrame, ts: str = "ts", period: str = PERIOD) -> DataFrame:
    """Events per metric and period."""
    counted = samples.groupBy(F.window(ts, period).alias("w"), "metric").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("w.start").alias("period_start"), "metric", "n")


def metric_summary(
    samples: DataFrame, ts: str = "ts", value: str = "value", period: str = PERIOD
) -> DataFrame:
    """Count, range, mean and spread per metric and period; all partial aggregates."""
    v = F.col(value)
    grouped = samples.groupBy(F.window(ts, period).alias("w"), "metric").agg(
        F.count(v).alias("n"),
        F.min(v).alias("min_value"),
        F.max(v).alias("max_value"),
        F.avg(v).alias("mean_value"),
        F.stddev_samp(v).alias("stddev_value"),
    )
    return grouped.select(F.col("w.start").alias("period_start"), *grouped.columns[1:])


def metric_quantiles_approx(
    samples: DataFrame,
    probs: Sequence[float],
    ts: str = "ts",
    value: str = "value",
    period: str = PERIOD,
    accuracy: int = 10_000,
) -> DataFrame:
    """Quantiles from mergeable sketches, for streams and dashboards."""
    sketched = samples.groupBy(F.window(ts, period).alias("w"), "metric").agg(
        F.percentile_approx(value, list(probs), accuracy).alias("q")
    )
    return sketched.select(F.col("w.start").alias("period_start"), "metric", "q")


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: dict[str, float],
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Interpolated quantiles per key without holding a group in one task.

    Values are first counted per key. A running total over the distinct values then says
    which row indexes each value covers, and the two neighbours of a quantile are picked
    by ordinary aggregates.
    """
    keys = list(keys)
    present = df.where(F.col(value).isNotNull())
    # Read several times below, and far smaller than the rows it counts.
    counted = durable(present.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n")))
    ranked = running(counted, keys, [value], {"_upto": running_sum(F.col("_n"))}, rows_per_block=rows_per_block)
    # Group sizes grow with the data, so Spark's own size check picks the join.
    sizes = counted.groupBy(*keys).agg(F.sum("_n").alias("_size"))
    sized = join_null_safe(ranked, sizes, keys)
    picks = []
    for name, p in probs.items():
        at = F.lit(float(p)) * (F.col("_size") - 1)
        picks.append(F.min(F.when(F.col("_upto") > F.floor(at), F.col(value))).alias(f"_lo_{name}"))
        picks.append(F.min(F.when(F.col("_upto") > F.ceil(at), F.col(value))).alias(f"_hi_{name}"))
        picks.append(F.max(at - F.floor(at)).alias(f"_part_{name}"))
    found = sized.groupBy(*keys).agg(*picks)
    return found.select(
        *keys,
        *[
            (F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_part_{n}")).alias(n)
            for n in probs
        ],
    )


def metric_histogram(
    samples: DataFrame,
    probs: dict[str, float],
    ts: str = "ts",
    value: str = "value",
    period: str = PERIOD,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Summary and exact quantiles per metric and period."""
    keyed = samples.select(F.window(ts, period)["start"].alias("period_start"), "metric", value)
    quantiles = exact_quantiles(keyed, ["period_start", "metric"], value, probs, rows_per_block)
    summary = metric_summary(samples, ts, value, period)
    return join_null_safe(summary, quantiles, ["period_start", "metric"])


def observed(df: DataFrame, name: str, **counters: Column) -> tuple[DataFrame, Observation]:
    """Counters gathered while a job runs, at no extra pass."""
    observation = Observation(name)
    return df.observe(observation, *[c.alias(n) for n, c in counters.items()]), observation
