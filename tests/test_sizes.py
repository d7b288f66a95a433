"""Results do not depend on block sizes, on hot groups or on how a table lies in files."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import check
from millrace.operators import joins, sessions, travel_time
from millrace.plans import inputs
from millrace.sources import readers

SF_DIR = "/root/testdata/sf0.001"
START = datetime(2024, 1, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_sessions_without_time(spark):
    data = [(1, START + timedelta(seconds=i) if i % 10 else None, i, float(i)) for i in range(199)]
    events = spark.createDataFrame(data, "k int, ts timestamp_ntz, id int, v double")
    whole, cut = (rows(sessions.sessions_any_skew(events, "k", "ts", "id", "v", rows_per_block=n)) for n in (1_000, 20))
    assert whole == cut and [r[3] for r in whole] == [179]


def test_model_sums_beyond_doubles(spark):
    """Terms near 2^57: sums of doubles would depend on where blocks are cut."""
    rides = inputs.rides_of(spark.read.parquet(f"{SF_DIR}/events.parquet"))
    far = F.col("ts") - F.expr("INTERVAL 300000 DAYS")
    rides = rides.withColumn("start_time", far)
    whole, cut = (rows(travel_time.travel_time_predictions(rides, inputs.GRID, rows_per_block=n)) for n in (10**6, 50))
    assert whole == cut and whole


@pytest.mark.parametrize("hot", ["left", "right", "both"])
def test_window_join_hot_sides(spark, hot):
    def side(name, many):
        n = 300 if many else 7
        data = [(1, START, i) for i in range(n)] + [(k, START, k) for k in range(2, 9)] + [(None, START, 0), (1, None, 0)]
        return spark.createDataFrame(data, f"k int, {name}_ts timestamp_ntz, {name}_id int")

    left, right = side("l", hot != "right"), side("r", hot != "left")
    plain = joins.window_join(left, right, "k", "l_ts", "r_ts")
    dealt = joins.window_join_any_skew(left, right, "k", "l_ts", "r_ts", rows_per_task=20)
    assert dealt.columns == plain.columns and rows(dealt) == rows(plain)


def test_null_keys_match_nothing(spark):
    left = spark.createDataFrame([(None, START, 1), (1, START, 2)], "k int, ts timestamp_ntz, id int")
    right = spark.createDataFrame([(None, START, 1, "x"), (1, START, 2, "y")], "k int, ts timestamp_ntz, id int, info string")
    assert {r.id: r.info for r in joins.asof_join(left, right, "k", "ts", "id", "info").collect()} == {1: joins.NO_INFO, 2: "y"}
    answered = joins.request_timeouts(left, right.select("k", F.col("ts").alias("at")), "k", "ts", "at", "1 second")
    assert {r.id: r["at"] is not None for r in answered.collect()} == {1: False, 2: True}


def test_topic_readers_share_no_group():
    assert set(readers.topic_options(["a", "b"], "host:1")) == {"kafka.bootstrap.servers", "subscribe"}


@pytest.mark.parametrize("name", ["stream_sessions", "stream_popular_places_tumbling", "stream_metric_counts"])
def test_streams_over_many_files(spark, tmp_path, monkeypatch, name):
    """Eight files in event order, two in each micro-batch, give what the batch form gives."""
    from millrace.plans import streams

    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    folder = tmp_path / "events.parquet"
    cuts = [r[0] for r in events.selectExpr("explode(percentile_approx(unix_micros(cast(ts as timestamp)), array(.125,.25,.375,.5,.625,.75,.875)))").collect()]
    micros = F.expr("unix_micros(cast(ts as timestamp))")
    for i, (low, high) in enumerate(zip([None, *cuts], [*cuts, None])):
        part = events.where((F.lit(low is None) | (micros > (low or 0))) & (F.lit(high is None) | (micros <= (high or 0))))
        part.coalesce(1).write.mode("append").parquet(str(folder))
    monkeypatch.setattr(streams, "FILES_PER_BATCH", 2)
    got = entry.queries()[name](spark, str(tmp_path))
    want = check.duck(SF_DIR).execute(entry.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert check.rows_of(got.columns, [tuple(r) for r in got.collect()]) == check.rows_of(names, want.fetchall())
