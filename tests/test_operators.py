import random
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import at, rows, same, with_time
from millrace.functions.text import tokens_nonempty
from millrace.functions.geo import GridSpec
from millrace.operators import inflight, iterate, joins, lateness, metrics, places, sessions, status, words
from millrace.operators import rows as row_ops
from millrace.operators import travel_time as tt

# Four lines of a play, and twelve clicks ten milliseconds apart.
LINES = [
    "To be, or not to be,--that is the question:--",
    "Whether 'tis nobler in the mind to suffer",
    "The slings and arrows of outrageous fortune",
    "Or to take arms against a sea of troubles,",
]
CLICKS = ["aA", "bA", "cA", "rA", "qB", "cB", "cB", "rB", "qC", "cC", "cC", "cC"]

GRID = GridSpec(west=0.0, east=4.0, south=0.0, north=4.0, dlon=1.0, dlat=1.0)


def clicks(spark):
    data = [(c[0], c[1], 10 * i, "PreProcessing", f"i{i:02}") for i, c in enumerate(CLICKS)]
    return spark.createDataFrame(
        data, "customer string, clicked_item string, event_time long, status string, id string"
    )


def test_word_counts_of_the_play(spark):
    lines = spark.createDataFrame([(i, l) for i, l in enumerate(LINES)], "i int, text string")
    counts = {r.word: r.n for r in words.word_counts(lines).collect()}
    assert sum(counts.values()) == 34 and len(counts) == 26
    assert (counts["to"], counts["the"]) == (4, 3)
    assert [counts[w] for w in ("be", "of", "or")] == [2, 2, 2]
    totals = words.word_running_totals(lines, "i", rows_per_block=5)
    assert [r.n for r in totals.where("word = 'to'").orderBy("i", "pos").collect()] == [1, 2, 3, 4]
    assert totals.count() == 34


def test_word_forms_differ_in_empty_tokens(spark):
    lines = spark.createDataFrame([("-x-",), ("",), ("--",)], "text string")
    assert rows(words.word_counts(lines)) == [("", 2), ("x", 1)]
    assert rows(words.word_counts(lines, tokens=tokens_nonempty)) == [("x", 1)]


def rides(spark, n=600, seed=1):
    rng = random.Random(seed)
    data = [
        (i, float(rng.randrange(0, 7200)), rng.random() < 0.5, *[rng.randrange(-2, 44) / 10 for _ in range(4)],
         float(rng.randrange(60, 3000)))
        for i in range(n)
    ]
    df = spark.createDataFrame(
        data,
        "ride_id long, s double, is_start boolean, start_lon double, start_lat double, end_lon double,"
        " end_lat double, d double",
    )
    df = with_time(df)
    return with_time(df.withColumn("s0", F.col("s") - F.col("d")), "s0", "start_time").withColumn("end_time", F.col("ts"))


def test_area_filter_includes_edges(spark):
    df = spark.createDataFrame(
        [(1, 0.0, 0.0, 4.0, 4.0), (2, -0.1, 0.0, 1.0, 1.0), (3, 1.0, 1.0, 1.0, 4.1)],
        "ride_id long, start_lon double, start_lat double, end_lon double, end_lat double",
    )
    assert [r.ride_id for r in row_ops.rides_inside(df, GRID).collect()] == [1]


@pytest.mark.parametrize("size, slide", [(900, 300), (60, 60), (600, 400)])
def test_pane_counts_equal_window_counts(spark, size, slide):
    hits = places.ride_hits(rides(spark), GRID)
    window = places.WindowSize(size, slide)
    assert same(places.cell_counts(hits, window), places.cell_counts_by_pane(hits, window))


def test_popular_places_threshold_and_types(spark):
    all_places = places.popular_places(rides(spark), GRID, places.FIFTEEN_BY_FIVE, threshold=1)
    popular = places.popular_places(rides(spark), GRID, places.FIFTEEN_BY_FIVE, threshold=3)
    assert same(popular, all_places.where("n >= 3")) and not popular.isEmpty()
    assert dict(popular.dtypes) == {
        "lon": "float", "lat": "float", "window_end_ms": "bigint", "is_start": "boolean", "n": "int"
    }


def test_session_edges(spark):
    data = [("a", float(s), s) for s in (0, 15, 29, 45)]
    df = with_time(spark.createDataFrame(data, "car_id string, s double, v long"))
    got = rows(sessions.sessions(df, "car_id", "ts", "v"))
    assert got == [("a", at(0), at(29), 3, 0, 29, 44 / 3), ("a", at(45), at(45), 1, 45, 45, 45.0)]


def test_sessions_with_a_hot_key_equal_the_built_in_ones(spark):
    rng = random.Random(5)
    data = [(i, rng.choice(["hot", "hot", "hot", f"k{i % 9}"]), float(rng.randrange(9000)), i % 11) for i in range(900)]
    df = with_time(spark.createDataFrame(data, "id long, key string, s double, v long"))
    cut = sessions.sessions_any_skew(df, "key", "ts", "id", "v", rows_per_block=40)
    assert same(cut, sessions.sessions(df, "key", "ts", "v"))


def test_metric_rollups(spark):
    data = [("requests", 0.0, 10), ("requests", 59.9, 30), ("requests", 60.0, 5), ("other", 1.0, None)]
    df = with_time(spark.createDataFrame(data, "m string, s double, value long"))
    df = df.withColumn("metric", metrics.metric_name("m"))
    assert rows(metrics.metric_counts(df)) == [
        (at(0), "sdp.heartbeat.other", 1), (at(0), "sdp.heartbeat.requests", 2), (at(60), "sdp.heartbeat.requests", 1),
    ]
    first = metrics.metric_summary(df).where("metric = 'sdp.heartbeat.requests' AND n = 2").first()
    assert (first.min_value, first.max_value, first.mean_value) == (10, 30, 20.0)


def test_exact_quantiles(spark):
    rng = np.random.default_rng(2)
    groups = {"hot": rng.integers(0, 400, 900), "one": np.array([7]), "few": np.array([1, 2, 10, 10])}
    data = [(k, int(v)) for k, vs in groups.items() for v in vs] + [("few", None), (None, 3), (None, 5)]
    df = spark.createDataFrame(data, "k string, v long")
    probs = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = {r.k: [r[p] for p in probs] for r in metrics.exact_quantiles(df, ["k"], "v", probs, 50).collect()}
    for k, vs in groups.items():
        assert got[k] == pytest.approx(np.quantile(vs, list(probs.values())))
    assert got[None] == [3.0, 4.0, 4.9, 5.0]


def test_observed_counters(spark):
    df, seen = metrics.observed(spark.range(10), "ten", rows=F.count(F.lit(1)), total=F.sum("id"))
    df.count()
    assert seen.get == {"rows": 10, "total": 45}


def test_window_join_edges(spark):
    left = with_time(spark.createDataFrame([(1, "l", 2.9), (None, "n", 2.9)], "k int, l string, s double"), name="lt").drop("s")
    right = with_time(
        spark.createDataFrame([(1, "r", 3.0), (1, "q", 0.0), (2, "p", 2.9), (None, "n", 2.9)], "k int, r string, s double"),
        name="rt",
    ).drop("s")
    got = joins.window_join(left, right, "k", "lt", "rt").select("k", "l", "r", "window_start")
    assert rows(got) == [(1, "l", "q", at(0))]


def test_salted_window_join_keeps_every_pair_once(spark):
    rng = random.Random(8)
    left = [(rng.choice([1, 1, 1, 2, 3]), i, float(rng.randrange(12))) for i in range(300)]
    left += [(1, 999, 1.0)] * 50
    right = [(rng.choice([1, 1, 2, 4]), i, float(rng.randrange(12))) for i in range(80)]
    l = with_time(spark.createDataFrame(left, "k int, l long, s double"), name="lt").drop("s")
    r = with_time(spark.createDataFrame(right, "k int, r long, s double"), name="rt").drop("s")
    salted = joins.window_join_any_skew(l, r, "k", "lt", "rt", rows_per_task=20)
    assert same(salted, joins.window_join(l, r, "k", "lt", "rt"))


@pytest.mark.parametrize("block", [1, 1000])
def test_asof_edges(spark, block):
    infos = with_time(spark.createDataFrame([(1, 5.0, 1, "five"), (1, 9.0, 2, "nine")], "k int, s double, id long, info string"))
    trades = with_time(
        spark.createDataFrame([(1, 4.0, 1), (1, 5.0, 2), (1, 8.0, 3), (1, 9.0, 4), (2, 9.0, 5)], "k int, s double, id long")
    ).drop("s")
    got = joins.asof_join(trades, infos, "k", "ts", "id", "info", rows_per_block=block)
    assert [r.info for r in got.orderBy("id").collect()] == [joins.NO_INFO, "five", "five", "nine", joins.NO_INFO]


@pytest.mark.parametrize("block", [1, 1000])
def test_running_max(spark, block):
    right = spark.createDataFrame([(1, 3), (3, 2), (5, 7)], "t long, v long")
    left = spark.createDataFrame([(0,), (2,), (4,), (6,)], "t long")
    for df in (left, right):
        assert df.count()
    l = left.withColumn("tie", F.col("t"))
    r = right.withColumn("tie", F.col("t"))
    got = joins.running_max_enrich(l, r, "t", "tie", "v", rows_per_block=block).orderBy("t")
    assert [x.max_so_far for x in got.collect()] == [0, 3, 3, 7]
    label = got.withColumn("id", F.lit("tom")).select(joins.running_max_label().alias("x"))
    assert label.first().x == "tom  0"
    keyed = joins.running_max_enrich(
        l.withColumn("k", F.col("t") % 4), r.withColumn("k", F.lit(2).cast("long")), "t", "tie", "v", ["k"], block
    ).orderBy("t")
    assert [x.max_so_far for x in keyed.collect()] == [0, 3, 0, 7]


def test_request_timeouts(spark):
    requests = with_time(spark.createDataFrame([("a", 0.0), ("b", 0.0), ("c", 10.0), ("d", 0.0)], "id string, s double"), name="asked").drop("s")
    answers = with_time(
        spark.createDataFrame([("a", 0.025), ("a", 0.5), ("b", 0.026), ("c", 9.0), ("c", 10.0)], "id string, s double"), name="answered"
    ).drop("s")
    got = joins.request_timeouts(requests, answers, "id", "asked", "answered", f"{joins.TIMEOUT_MS} milliseconds")
    assert {r.id: r.answered for r in got.collect()} == {"a": at(0.025), "b": None, "c": at(10), "d": None}


@pytest.mark.parametrize("block", [2, 1000])
def test_timers_of_the_twelve_clicks(spark, block):
    df = with_time(clicks(spark).withColumn("s", F.col("event_time") / 1000))
    df = df.select("ts", (F.col("event_time") / 10).cast("long").alias("n"))
    got = joins.timer_triggers(df, "ts", "n", "25 milliseconds", block)
    fired = {r.n: r.triggered_by for r in got.collect()}
    assert fired == {i: i + 3 if i + 3 < 12 else None for i in range(12)}


def test_lookup(spark):
    table = spark.createDataFrame([("a", "x"), ("b", "y")], "key string, result string")
    df = spark.createDataFrame([("a",), ("z",), (None,)], "key string")
    want = [("a", "x"), ("z", None), (None, None)]
    assert sorted(rows(joins.lookup(df, table, "key")), key=repr) == sorted(want, key=repr)
    big = joins.lookup(df, table, "key", max_broadcast_rows=1)
    assert sorted(rows(big), key=repr) == sorted(want, key=repr)
    wide = joins.lookup(df, table, "key", max_broadcast_bytes=10)
    assert sorted(rows(wide), key=repr) == sorted(want, key=repr)
    for plain in (big, wide):
        assert "ResolvedHint" not in plain._jdf.queryExecution().analyzed().toString()


def test_in_flight(spark):
    requests = with_time(spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0), ("a", 4.0)], "id string, s double")).drop("s")
    answers = with_time(
        spark.createDataFrame(
            [("z", 0.0, "ProcessingDone"), ("a", 3.0, "FeatureScoring"), ("a", 3.5, "ProcessingDone"),
             ("b", 3.6, "PreProcessing"), ("b", 5.0, "ProcessingDone")],
            "id string, s double, status string",
        )
    ).drop("s")
    for block in (2, 1000):
        got = inflight.in_flight_size(requests, answers, "ts", rows_per_block=block).orderBy("ts", "side", "id")
        assert [r.in_flight for r in got.collect()] == [0, 1, 2, 3, 2, 2, 2, 3, 2]
    assert rows(inflight.open_requests(requests, answers).select("id")) == [("c",)]


@pytest.mark.parametrize("block", [2, 1000])
def test_late_edge(spark, block):
    data = [(1, 100.0, 0), (2, 60.0, 1), (3, 60.001, 2), (4, 120.0, 3), (5, 79.0, 4), (6, 81.0, 5)]
    df = with_time(spark.createDataFrame(data, "id long, s double, seen long"))
    marked = lateness.mark_late(df, "ts", ["seen"], rows_per_block=block)
    assert {r.id: r.is_late for r in marked.collect()} == {1: False, 2: True, 3: False, 4: False, 5: True, 6: False}
    ordered = lateness.sorted_on_time(df.withColumn("k", F.lit(1)), "k", "ts", "id", ["seen"], rows_per_block=block)
    assert [r.id for r in ordered.orderBy("position").collect()] == [3, 6, 1, 4]


def test_event_time_layout_orders_across_partitions(spark):
    df = spark.range(1000).select("id", (F.col("id") * 37 % 1000).alias("ts"), (F.col("id") % 3).alias("k"))
    laid = lateness.event_time_layout(df, "k", "ts", "id", 4)
    got = [(r.k, r.ts) for r in laid.collect()]
    assert got == sorted(got) and laid.rdd.getNumPartitions() == 4


def brute_predictions(features):
    models, out = {}, {}
    for r in sorted(features, key=lambda r: (r.ts, r.ride_id)):
        xs, ys = models.setdefault((r.cell, r.bucket), ([], []))
        if not r.is_start:
            xs.append(r.distance)
            ys.append(r.duration)
        elif not xs:
            out[r.ride_id] = None
        else:
            slope, mean_x, mean_y = 0.0, np.mean(xs), np.mean(ys)
            if len(set(xs)) > 1:
                slope = np.sum((np.array(xs) - mean_x) * (np.array(ys) - mean_y)) / np.sum((np.array(xs) - mean_x) ** 2)
            out[r.ride_id] = (mean_y + slope * (r.distance - mean_x)) / 60000.0
    return out


@pytest.mark.parametrize("block", [5, 10_000])
def test_travel_times_against_brute_force(spark, block):
    df = rides(spark, 500, seed=4)
    want = brute_predictions(tt.ride_features(df, GRID).collect())
    got = {r.ride_id: r.minutes for r in tt.travel_time_predictions(df, GRID, rows_per_block=block).collect()}
    assert got.keys() == want.keys() and any(v is None for v in want.values())
    for ride, minutes in got.items():
        assert (minutes is None) == (want[ride] is None)
        if minutes is not None:
            assert abs(minutes - want[ride]) < 1.000001


def test_increment_loop(spark):
    loop = iterate.increment_until_odd(spark.range(1, 1001).toDF("v"), "v")
    assert [r.v for r in loop.output.orderBy("v").collect()] == list(range(3, 1002, 2))
    assert [r.v for r in loop.residue.orderBy("v").collect()] == list(range(2, 1001, 2))
    assert not loop.drained and loop.rounds == 2


def test_countdown_loop(spark):
    loop = iterate.countdown(spark.range(0, 1001).toDF("v"), "v", max_rounds=1001)
    assert rows(loop.output.groupBy("v").count()) == [(-1, 1), (0, 1000)]
    assert loop.drained and loop.rounds == 1000


def test_loop_stops_at_its_bound(spark):
    loop = iterate.countdown(spark.range(0, 10).toDF("v"), "v", max_rounds=3, fuse=2)
    assert (loop.rounds, loop.drained) == (3, False)
    assert loop.output.count() + loop.residue.count() == 10
    assert rows(loop.residue) == [(v,) for v in range(1, 7)]


def test_status_hops(spark):
    from millrace.functions import codec

    start = clicks(spark)
    wire = codec.encode_clicks(start, codec.REQUEST_TOPIC)
    scored = status.score_requests(wire)
    assert rows(scored.select("topic").distinct()) == [(codec.BUSINESS_TOPIC,)]
    assert same(codec.decode_clicks(scored, [codec.BUSINESS_TOPIC]), status.set_status(start, "FeatureScoring"))
    assert same(status.click_hops(start), status.set_status(start, "ProcessingDone"))
    assert status.score_requests(scored).isEmpty()
    items = {r.clicked_item: r["count"] for r in start.groupBy("clicked_item").count().collect()}
    people = {r.customer: r["count"] for r in start.groupBy("customer").count().collect()}
    assert items == {"A": 4, "B": 4, "C": 4} and people == {"a": 1, "b": 1, "c": 6, "r": 2, "q": 2}


def test_split_and_small_filters(spark):
    df = spark.createDataFrame([(1, "a"), (2, ""), (None, None)], "v int, c string")
    even, others = row_ops.split_by(df, F.col("v") % 2 == 0)
    assert rows(even) == [(2, "")] and others.count() == 2
    assert rows(row_ops.nonempty(df, "c")) == [(1, "a")]
    assert row_ops.rebalance(df, 3).rdd.getNumPartitions() == 3
