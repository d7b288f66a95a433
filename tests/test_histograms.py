"""Mergeable histograms: bounds of error, and sums over periods and parts."""

import random

from pyspark.sql import functions as F

from helpers import rows, with_time
from millrace.operators.histograms import bucket_of, histogram_quantiles, merged, rolled_up, value_histogram


def samples(spark):
    rnd = random.Random(1)
    data = [(float(i), rnd.choice("ab"), rnd.choice([0, 1, -1, rnd.randint(-40, 40), int(10 ** rnd.uniform(0, 17)), -int(10 ** rnd.uniform(0, 9))])) for i in range(4000)]
    return data, with_time(spark.createDataFrame([*data, (1.0, "a", None)], "s double, metric string, value long")).drop("s")


def test_buckets_are_narrow(spark):
    values = [0, 1, -1, 63, 64, 65, 127, 128, -129, 10**18, -(10**18), 2**62 + 12345]
    got = spark.createDataFrame([(v,) for v in values], "v long").select("v", bucket_of(F.col("v")).alias("b")).collect()
    for r in got:
        assert abs(r.b) <= abs(r.v) <= abs(r.b) * (1 + 2**-5) and (r.b < 0) == (r.v < 0) and (abs(r.v) >= 64 or r.b == r.v)


def test_sums_of_parts_are_the_whole(spark):
    _, table = samples(spark)
    whole = value_histogram(table, period="1 hour")
    assert rows(rolled_up(value_histogram(table, period="1 minute"), "1 hour")) == rows(whole)
    odd = F.abs("value") % 2 == 1
    assert rows(merged(value_histogram(table.where(odd), period="1 hour"), value_histogram(table.where(~odd), period="1 hour"))) == rows(whole)


def test_quantiles_keep_their_bound(spark):
    data, table = samples(spark)
    probs = {"least": 0.0, "p10": 0.1, "p50": 0.5, "p99": 0.99, "most": 1.0}
    got = histogram_quantiles(value_histogram(table, period="1 day"), probs).collect()
    assert {r.metric for r in got} == {"a", "b"}
    for r in got:
        values = sorted(v for _, m, v in data if m == r.metric)
        assert r.n == len(values)
        for name, p in probs.items():
            exact = values[int(p * (len(values) - 1))]
            assert abs(r[name]) <= abs(exact) <= abs(r[name]) * (1 + 2**-5)
    assert histogram_quantiles(value_histogram(table.limit(0)), probs).collect() == []
