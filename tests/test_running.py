import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import same, with_time
from millrace.operators.running import (
    Blocks,
    running,
    running_count,
    running_last,
    running_max,
    running_min,
    running_sum,
)


def aggs():
    return {
        "total": running_sum(F.col("v")),
        "c": running_count(F.col("v")),
        "n": running_count(),
        "hi": running_max(F.col("v")),
        "lo": running_min(F.col("v")),
        "last": running_last(F.when(F.col("v") % 3 == 0, F.col("id"))),
    }


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one key, a third without a key, times with many ties."""
    rng = random.Random(3)
    data = []
    for i in range(1500):
        key = ("hot", None, f"k{rng.randrange(40)}")[i % 3]
        data.append((i, key, float(rng.randrange(200)), rng.choice([None, rng.randrange(-50, 50)])))
    rng.shuffle(data)
    return with_time(spark.createDataFrame(data, "id long, key string, s double, v long")).cache()


def plain(df, keys, order, inclusive):
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    return df.withColumns({n: a.over(w) for n, a in aggs().items()})


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("keys", [[], ["key"], ["key", "v"]])
def test_blocks_equal_one_window(skewed, keys, inclusive):
    order = ["ts", "id"]
    cut = running(skewed, keys, order, aggs(), inclusive, rows_per_block=50)
    assert same(cut, plain(skewed, keys, order, inclusive))


@pytest.mark.parametrize("partitions", ["1", "4", "16"])
def test_result_does_not_depend_on_partitions(spark, skewed, partitions):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        cut = running(skewed, ["key"], ["ts", "id"], aggs(), rows_per_block=70)
        assert same(cut, plain(skewed, ["key"], ["ts", "id"], True))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_one_time_for_a_third_of_the_rows_is_cut_by_the_tie(spark):
    df = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 7).alias("t"), F.lit(1).cast("long").alias("v")
    )
    blocks = Blocks.plan(df, [], ["t", "id"], rows_per_block=100)
    sizes = [r["count"] for r in blocks.assign(df).groupBy("_block").count().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 500
    total = running(df, [], ["t", "id"], {"n": running_count()}, rows_per_block=100)
    assert sorted(r.n for r in total.collect()) == list(range(1, 3001))


def test_number_of_blocks_is_bounded(skewed):
    blocks = Blocks.plan(skewed, ["key"], ["ts", "id"], rows_per_block=1, max_blocks=9)
    assert 0 < len(blocks.cuts) <= 8


def test_carry_table_has_at_most_one_row_per_block(skewed):
    blocks = Blocks.plan(skewed, ["key"], ["ts", "id"], rows_per_block=50)
    assigned = blocks.assign(skewed)
    spans = assigned.select("key", "_block").distinct().groupBy("key").count()
    carried = spans.agg(F.sum(F.col("count") - 1)).first()[0]
    assert carried <= len(blocks.cuts)


def test_small_groups_are_not_cut(skewed):
    assert Blocks.plan(skewed, ["key"], ["ts", "id"], rows_per_block=10_000).cuts == ()


def test_empty_input(spark, skewed):
    empty = skewed.limit(0)
    assert running(empty, [], ["ts", "id"], aggs()).count() == 0
    assert running(empty, ["key"], ["ts", "id"], aggs()).count() == 0


def test_carry_is_broadcast_and_rows_are_shuffled_once(skewed):
    plan = running(skewed, ["key"], ["ts", "id"], {"total": aggs()["total"]}, rows_per_block=50)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text
