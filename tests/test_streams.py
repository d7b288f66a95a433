"""Streams in several micro-batches: late rows, corrections, restarts, agreement with batch."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import at, rows, same, with_time
from millrace.functions.codec import PROCESSING_DONE
from millrace.functions.text import tokens_nonempty
from millrace.functions.geo import GridSpec
from millrace.operators import joins, places, sessions, travel_time, words
from millrace.sources.readers import table_stream, text_lines
from millrace.sources.writers import drain, stream_to_table, stream_to_text, with_rocksdb
from millrace.streaming import builtin, global_order, ordered, stateful

GRID = GridSpec(west=0.0, east=4.0, south=0.0, north=4.0, dlon=1.0, dlat=1.0)
FAR = 10_000_000.0


@pytest.fixture
def feed(spark, tmp_path):
    """Write frames as files of one stream, in the given order, one file per micro-batch."""
    count = [0]

    def make(*frames):
        count[0] += 1
        folder = tmp_path / f"feed{count[0]}"
        for i, frame in enumerate(frames):
            target = tmp_path / f"part{count[0]}-{i}"
            frame.coalesce(1).write.parquet(str(target))
            part = next(target.glob("*.parquet"))
            folder.mkdir(exist_ok=True)
            (folder / f"{i:03}.parquet").write_bytes(part.read_bytes())
            import os

            os.utime(folder / f"{i:03}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
        return table_stream(spark, str(folder), frames[0].schema, max_files=1)

    return make


def timed(spark, data, schema):
    return with_time(spark.createDataFrame(data, schema)).drop("s")


def ntz(df, *names):
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


def test_late_rows_are_dropped_and_the_rest_is_sorted(spark, feed):
    schema = "id long, k string, s double"
    batches = [
        [(1, "a", 100.0), (2, "a", 90.0)],
        [(3, "a", 200.0), (4, "a", 95.0)],
        # The watermark is 200 - 40 = 160 s here: a row at it is late, one just after is not.
        [(5, "a", 160.0), (6, "a", 160.001), (7, "a", 150.0)],
        [(8, "a", FAR)],
        [(9, "a", FAR + 1)],
    ]
    stream = feed(*[timed(spark, b, schema) for b in batches])
    out = drain(stateful.sort_by_event_time(stream, "k", "ts", "id", "40 seconds", "1 hour"), "late")
    ordered = out.where(F.col("id") < 8).orderBy("slot_start", "position")
    assert [r.id for r in ordered.collect()] == [2, 4, 1, 6, 3]
    assert [r.position for r in ordered.collect()] == [1, 2, 3, 4, 5]


def test_sort_buffer_splits_a_key_by_slots(spark, feed):
    data = [(i, "a", float(i * 37 % 500)) for i in range(300)]
    schema = "id long, k string, s double"
    stream = feed(timed(spark, data, schema), timed(spark, [(999, "a", FAR)], schema), timed(spark, [(1000, "a", FAR)], schema))
    out = drain(stateful.sort_by_event_time(stream, "k", "ts", "id", "1 second", "1 minute"), "slots").where("id < 999")
    got = [r.id for r in out.orderBy("slot_start", "position").collect()]
    assert got == [i for _, i in sorted((s, i) for i, _, s in data)]


@pytest.mark.parametrize("salts", [1, 3])
def test_asof_answers_early_and_corrects_once(spark, feed, salts):
    schema = "k long, s double, id long, info string, trade boolean"
    batches = [
        [(1, 5.0, 100, "five", False), (1, 8.0, 1, None, True), (2, 8.0, 2, None, True)],
        # Known too late for the first answer to trade 1, in time for the final one.
        [(1, 7.0, 101, "seven", False), (1, 20.0, 3, None, True)],
        [(9, 1000.0, 4, None, True)],
        # Trade 5 is behind the watermark by now: one final answer, from what was kept.
        [(1, 9.0, 5, None, True), (9, 2000.0, 6, None, True)],
        [(9, 2001.0, 7, None, True)],
    ]
    frames = [timed(spark, b, schema) for b in batches]
    trades = feed(*[f.where("trade") for f in frames]).select("k", "ts", "id")
    infos = feed(*[f.where("NOT trade") for f in frames]).select("k", "ts", "id", "info")
    out = drain(
        stateful.asof_stream(trades, infos, "k", "ts", "id", "info", "10 seconds", salts=salts), f"asof{salts}"
    )
    got = {i: [] for i in range(1, 8)}
    for r in out.collect():
        got[r.id].append((r.info, r.is_final))
    assert sorted(got[1]) == [("five", False), ("seven", True)]
    assert got[2] == [(joins.NO_INFO, False)] and got[3] == [("seven", False)]
    assert got[5] == [("seven", True)]


def test_running_max_per_key_over_batches(spark, feed):
    schema = "k long, s double, id long, v double"
    lefts = [[(1, 1.0, 1, None)], [(1, 3.0, 3, None), (2, 3.0, 4, None)]]
    rights = [[(1, 0.5, 0, 4.0)], [(1, 2.0, 2, 3.0), (2, 2.5, 5, -1.0)]]
    left = feed(*[timed(spark, b, schema) for b in lefts]).select("k", "ts", "id")
    right = feed(*[timed(spark, b, schema) for b in rights])
    out = drain(stateful.running_max_stream(left, right, "k", "ts", "id", "v"), "runmax")
    assert {r.id: r.max_so_far for r in out.collect()} == {1: 4.0, 3: 4.0, 4: 0.0}


def test_running_max_of_the_whole_stream(spark, feed, tmp_path):
    rng = random.Random(6)
    data = [(float(i), i, rng.random() < 0.5, float(rng.randrange(100))) for i in range(200)]
    schema = "s double, id long, lefty boolean, v double"
    frames = [timed(spark, data[i : i + 50], schema) for i in range(0, 200, 50)]
    left = feed(*[f.where("lefty") for f in frames]).select("ts", "id")
    right = feed(*[f.where("NOT lefty") for f in frames]).select("ts", "id", "v")
    query = global_order.running_max_everywhere(
        left, right, "ts", "id", "v", str(tmp_path / "out"), str(tmp_path / "cp"), rows_per_block=20, once=True
    )
    query.awaitTermination()
    everything = timed(spark, data, schema)
    want = joins.running_max_enrich(
        everything.where("lefty").select("ts", "id"), everything.where("NOT lefty"), "ts", "id", "v"
    )
    assert same(spark.read.parquet(str(tmp_path / "out" / "rows")).drop("batch"), want)


def test_in_flight_changes_over_batches(spark, feed):
    schema = "id string, s double, status string"
    asked = [[("a", 1.0, None), ("b", 1.0, None)], [("a", 5.0, None)], [("c", 9.0, None)]]
    answered = [[("z", 1.0, PROCESSING_DONE)], [("a", 2.0, PROCESSING_DONE)], [("a", 8.0, "PreProcessing")]]
    requests = feed(*[timed(spark, b, schema) for b in asked]).drop("status")
    responses = feed(*[timed(spark, b, schema) for b in answered])
    out = drain(stateful.in_flight_stream(requests, responses, "ts", shards=2), "inflight")
    got = sorted((r.id, r.ts, r.change) for r in ntz(out, "ts").collect())
    assert got == [("a", at(1), 1), ("a", at(2), -1), ("a", at(5), 1), ("b", at(1), 1), ("c", at(9), 1), ("z", at(1), 0)]


def ride_frames(spark, n=400, parts=4):
    rng = random.Random(12)
    data = [
        (i, float(i * 20), rng.random() < 0.5, *[rng.randrange(0, 40) / 10 for _ in range(4)], float(rng.randrange(60, 3000)))
        for i in range(n)
    ]
    schema = (
        "ride_id long, s double, is_start boolean, start_lon double, start_lat double, end_lon double,"
        " end_lat double, d double"
    )

    def shape(chunk):
        df = with_time(spark.createDataFrame(chunk, schema))
        df = with_time(df.withColumn("s0", F.col("s") - F.col("d")), "s0", "start_time")
        return df.withColumn("end_time", F.col("ts")).drop("s", "s0", "d")

    size = n // parts
    return shape(data), [shape(data[i : i + size]) for i in range(0, n, size)]


def closing(rides):
    """A ride long after all others, inside the area."""
    return rides.limit(1).withColumn("ts", F.lit("2030-01-01 00:00:00").cast("timestamp_ntz"))


def test_travel_time_stream_equals_batch(spark, feed):
    everything, parts = ride_frames(spark)
    out = drain(ordered.travel_time_stream(feed(*parts, closing(everything)), GRID, slot_seconds=900), "travel", rocksdb=True)
    assert same(out, travel_time.travel_time_predictions(everything, GRID))


def test_popular_places_stream_equals_batch_on_closed_windows(spark, feed):
    everything, parts = ride_frames(spark)
    window = places.WindowSize(1200, 600)
    out = drain(builtin.popular_places_stream(feed(*parts), GRID, window, 2), "places")
    newest_ms = 1704067200000 + 399 * 20_000
    want = places.popular_places(everything, GRID, window, 2).where(F.col("window_end_ms") <= newest_ms - 60_000)
    assert same(out, want) and not out.isEmpty()


def test_sessions_stream_equals_batch_on_closed_sessions(spark, feed):
    rng = random.Random(9)
    data = [(f"k{rng.randrange(5)}", float(s), s) for s in range(0, 3000, 6)]
    schema = "car_id string, s double, v long"
    parts = [timed(spark, data[i : i + 100], schema) for i in range(0, 500, 100)]
    out = drain(builtin.sessions_stream(feed(*parts), "car_id", "ts", "v"), "sessions")
    want = sessions.sessions(timed(spark, data, schema), "car_id", "ts", "v")
    closed = want.where(F.col("session_end") <= F.lit(at(2994 - 55)).cast("timestamp_ntz"))
    assert same(ntz(out, "session_start", "session_end"), closed) and not out.isEmpty()


def test_window_join_stream_equals_batch(spark, feed):
    rng = random.Random(10)
    data = [(rng.randrange(3), i, float(i) / 2) for i in range(120)]
    frames = [timed(spark, data[i : i + 40], "k int, id long, s double") for i in range(0, 120, 40)]

    def side(df, parity, name):
        return df.where(F.col("id") % 2 == parity).select("k", F.col("id").alias(name), F.col("ts").alias(f"{name}_ts"))

    left, right = feed(*[side(f, 0, "l") for f in frames]), feed(*[side(f, 1, "r") for f in frames])
    out = drain(builtin.window_join_stream(left, right, "k", "l_ts", "r_ts"), "wjoin")
    everything = timed(spark, data, "k int, id long, s double")
    want = joins.window_join(side(everything, 0, "l"), side(everything, 1, "r"), "k", "l_ts", "r_ts")
    assert same(out.select("k", "l", "r"), want.select("k", "l", "r")) and not out.isEmpty()


def test_timeout_stream_gives_the_first_response_or_none(spark, feed):
    schema = "id string, s double, n bigint"
    asked = [[("a", 1.0, 1), ("b", 2.0, None), (None, 2.0, 7)], [("a", 1.01, 2), ("c", FAR, 3)], [("d", FAR, 4)]]
    answered = [[("a", 1.02), ("a", 1.005), ("a", 1.03)], [("b", 2.03), (None, 2.0), ("x", FAR)], [("y", FAR)]]
    requests = feed(*[timed(spark, b, schema) for b in asked])
    responses = feed(*[timed(spark, b, "id string, s double").withColumnRenamed("ts", "answered") for b in answered])
    found = ordered.first_response_stream(requests, responses, "id", "ts", "answered", "25 milliseconds", "1 second", 60, 4)
    out = ntz(drain(found, "timeouts", rocksdb=True), "ts", "answered")
    got = {(r.id, r.n): r.answered and (r.answered - at(0)).total_seconds() for r in out.collect()}
    assert got == {("a", 1): 1.005, ("a", 2): 1.02, ("b", None): None, (None, 7): None} and out.count() == 4


def test_word_counts_from_a_folder_that_grows(spark, tmp_path):
    source, out, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    source.mkdir()
    (source / "1.txt").write_text("to be\nor not\n")
    counts = words.word_counts(text_lines(spark, str(source), streaming=True), tokens=tokens_nonempty)
    updates = drain(counts, "words", mode="update")
    assert rows(updates.select("word", "n")) == [("be", 1), ("not", 1), ("or", 1), ("to", 1)]
    stream_to_text(text_lines(spark, str(source), streaming=True), out, progress, once=True).awaitTermination()
    assert rows(spark.read.text(f"{out}/batch=0")) == [("or not",), ("to be",)]


def test_restart_neither_loses_nor_repeats(spark, tmp_path):
    source, out, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    source.mkdir()

    def run():
        stream_to_table(text_lines(spark, str(source), streaming=True), out, progress, once=True).awaitTermination()

    (source / "1.txt").write_text("one\n")
    run()
    (source / "2.txt").write_text("two\n")
    run()
    run()
    assert rows(spark.read.parquet(out)) == [("one",), ("two",)]


def test_stateful_restart_continues_from_its_state(spark, tmp_path):
    """Predictions after a restart use what was learnt before it."""
    everything, parts = ride_frames(spark, 200, 2)
    source, out, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    source.mkdir()
    for i, part in enumerate([*parts, closing(everything)]):
        part.coalesce(1).write.parquet(str(tmp_path / f"p{i}"))
        file = next((tmp_path / f"p{i}").glob("*.parquet"))
        (source / f"{i}.parquet").write_bytes(file.read_bytes())
        stream = table_stream(spark, str(source), parts[0].schema)
        with with_rocksdb(spark):
            query = stream_to_table(ordered.travel_time_stream(stream, GRID, slot_seconds=900), out, progress, once=True)
        query.awaitTermination()
    assert same(spark.read.parquet(out), travel_time.travel_time_predictions(everything, GRID))
