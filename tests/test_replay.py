"""Streams over replayed tables: any file layout, disorder inside the delay, restarts, workers without the repository."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import check
from helpers import rows, with_time
from millrace.operators import inflight, joins
from millrace.sources.replay import lay_out, laid_out, replayed
from millrace.sources.writers import drain, stream_to_table
from millrace.streaming import global_order, ordered

SF_DIR = os.environ.get("MILLRACE_SF_DIR", "/root/testdata/sf0.001")
LAID = ["stream_travel_time", "stream_running_max", "stream_popular_places_tumbling", "stream_sessions", "stream_asof_join", "stream_asof_final", "stream_metric_counts"]


@pytest.fixture(scope="module")
def by_id(spark, tmp_path_factory):
    """The events in four files that each hold every fourth id."""
    folder = tmp_path_factory.mktemp("by_id")
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    events.repartition(4, F.expr("event_id % 4")).write.parquet(str(folder / "events.parquet"))
    return str(folder)


@pytest.mark.parametrize("name", LAID)
def test_layout_does_not_matter(spark, by_id, monkeypatch, name):
    from millrace.plans import streams

    monkeypatch.setattr(streams, "FILES_PER_BATCH", 1)
    got = entry.queries()[name](spark, by_id)
    want = check.duck(SF_DIR).execute(entry.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert check.rows_of(got.columns, [tuple(r) for r in got.collect()]) == check.rows_of(names, want.fetchall())


def timed(spark, data, schema):
    return with_time(spark.createDataFrame(data, schema)).drop("s")


def test_replay_is_in_order_and_closes(spark, tmp_path):
    data = [(i, float(i * 37 % 200), "x") for i in range(200)] + [(999, None, "no time")]
    table = timed(spark, data, "id long, s double, k string").repartition(5)
    lay_out(table, "ts", str(tmp_path / "r"), files=4, close_after="1 day", blank=["k"])
    seen = []
    stream = laid_out(spark, table, str(tmp_path / "r"), max_files=1)
    query = stream.writeStream.foreachBatch(lambda df, n: seen.append([tuple(r) for r in df.select("ts", "id", "k").collect()])).trigger(availableNow=True)
    query.option("checkpointLocation", str(tmp_path / "cp")).start().awaitTermination()
    times = [[t for t, *_ in batch if t] for batch in seen if batch]
    assert all(max(a) <= min(b) for a, b in zip(times, times[1:]) if a and b) and len(times) > 3
    assert seen[-1][0][2] is None and len(seen[-1]) == 1 and sum(map(len, seen)) == 202
    empty = table.limit(0)
    lay_out(empty, "ts", str(tmp_path / "e"), close_after="1 day")
    assert drain(laid_out(spark, empty, str(tmp_path / "e")), "none").count() == 0


def test_stopped_and_started_again(spark, tmp_path):
    """A replay that is stopped after some batches goes on from its log and repeats nothing."""
    table = timed(spark, [(i, float(i)) for i in range(60)], "id long, s double")
    lay_out(table, "ts", str(tmp_path / "r"), files=6)
    out, progress = str(tmp_path / "out"), str(tmp_path / "cp")
    query = stream_to_table(laid_out(spark, table, str(tmp_path / "r"), max_files=1), out, progress, interval="0 seconds")
    while not (query.lastProgress and query.lastProgress["batchId"] >= 1):
        query.exception() and pytest.fail(str(query.exception()))
    query.stop()
    stream_to_table(laid_out(spark, table, str(tmp_path / "r"), max_files=1), out, progress, once=True).awaitTermination()
    assert rows(spark.read.parquet(out).select("id")) == sorted(((i,) for i in range(60)), key=repr)


def test_final_as_of_answers_under_disorder(spark):
    data = [(i % 3 or None, float(i * 10), i, f"info {i}" if i % 4 == 0 else None) for i in range(1, 160)]
    data += [(1, 400.0, 500, "later tie"), (1, 400.0, 499, "earlier tie"), (1, 400.0, 501, None)]
    table = timed(spark, [(*d, d[1] + d[2] * 13 % 60) for d in data], "k long, s double, id long, info string, arrives double")
    table = table.withColumn("arrival", F.expr("timestampadd(MICROSECOND, cast(arrives * 1000000 as bigint), timestamp_ntz'2024-01-01 00:00:00')")).drop("arrives")
    for files in (1, 8):
        stream = replayed(table, "arrival", "asof", "1 day", files=files, max_files=1, times=["ts"])
        trades, infos = stream.where("info is null").select("k", "ts", "id"), stream.where("info is not null").select("k", "ts", "id", "info")
        found = drain(ordered.asof_refined_stream(trades, infos, "k", "ts", "id", "info", "70 seconds", 40), "asof", rocksdb=True)
        want = joins.asof_join(table.where("info is null").select("k", "ts", "id"), table.where("info is not null").select("k", "ts", "id", "info"), "k", "ts", "id", "info")
        final = {r.id: r.info for r in found.where("is_final").collect()}
        assert final == {r.id: r.info for r in want.collect()} and final[501] == "later tie"
        early = found.where("not is_final and year(ts) = 2024 and day(ts) = 1").collect()
        assert len({r.id for r in early}) == len(final)


def test_late_trades_get_no_final_answer(spark, tmp_path):
    schema = "k long, s double, id long, info string, n double"
    data = [(1, 5.0, 1, "five", 0.0), (1, 6.0, 2, None, 1.0), (1, 500.0, 3, "much later", 2.0), (1, 7.0, 4, None, 3.0), (1, 900.0, 5, None, 4.0)]
    table = timed(spark, data, schema).withColumn("arrival", F.expr("timestampadd(SECOND, cast(n as int), timestamp_ntz'2024-01-01 00:00:00')")).drop("n")
    stream = replayed(table, "arrival", "late", "1 day", files=5, max_files=1, times=["ts"])
    trades, infos = stream.where("info is null").select("k", "ts", "id"), stream.where("info is not null").select("k", "ts", "id", "info")
    found = drain(ordered.asof_refined_stream(trades, infos, "k", "ts", "id", "info", "10 seconds", 20), "late", rocksdb=True)
    assert {r.id: r.info for r in found.where("is_final").collect()} == {2: "five", 5: "much later"}


@pytest.mark.parametrize("files", [1, 9])
def test_in_flight_size_over_batches(spark, tmp_path, files):
    asked = [(i, float(i * 3)) for i in range(100)]
    answered = [(i, float(i * 3 + i * 11 % 50), "ProcessingDone") for i in range(0, 100, 2)]
    requests = timed(spark, asked, "id long, s double").withColumn("status", F.lit(None).cast("string"))
    both = requests.unionByName(timed(spark, answered, "id long, s double, status string"))
    stream = replayed(both, "ts", "open", files=files, max_files=1)
    path = str(tmp_path / "open")
    global_order.in_flight_size_everywhere(
        stream.where("status is null").drop("status"), stream.where("status is not null"), "ts", path, str(tmp_path / "cp"), once=True
    ).awaitTermination()
    got = spark.read.parquet(f"{path}/rows").withColumn("ts", F.col("ts").cast("timestamp_ntz")).drop("batch")
    want = inflight.in_flight_size(requests.drop("status"), both.where("status is not null"), "ts").where("change <> 0")
    assert rows(got.select("ts", "side", "id", "change", "in_flight")) == rows(want.select("ts", "side", "id", "change", "in_flight"))


def test_open_requests_expire(spark, tmp_path):
    asked = [(1, 0.0), (2, 5.0), (1, 30.0), (3, 100.0)]
    both = timed(spark, asked, "id long, s double").withColumn("status", F.lit(None).cast("string"))
    both = both.unionByName(timed(spark, [(2, 8.0, "ProcessingDone"), (1, 60.0, "ProcessingDone")], "id long, s double, status string"))
    for files in (1, 6):
        stream, path = replayed(both, "ts", "expire", files=files, max_files=1), str(tmp_path / f"x{files}")
        global_order.in_flight_size_everywhere(
            stream.where("status is null").drop("status"), stream.where("status is not null"), "ts", path, f"{path}-cp", expire_after="20 seconds", once=True
        ).awaitTermination()
        ends = {(r.id, r.side): r.change for r in spark.read.parquet(f"{path}/rows").where("change < 0").collect()}
        assert ends[2, 1] == -1 and (1, 1) not in ends and (3, 2) not in ends


def test_workers_need_no_repository(tmp_path):
    """State functions reach workers that cannot import the package from their folder."""
    code = f"""
import sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from millrace.session import local_session
import __spark_entry__ as entry
spark = local_session(2, "elsewhere", **{{"spark.sql.shuffle.partitions": "2"}})
for name in ("stream_travel_time", "stream_running_max"):
    print(name, entry.queries()[name](spark, {SF_DIR!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
