"""Streams as batch jobs over finished slots: busy keys, disorder, late rows, repeats of a micro-batch, a bounded log."""

import os
import random

import pytest
from pyspark.sql import functions as F

from helpers import rows, same, with_time
from millrace.operators import joins, sessions
from millrace.sources.replay import lay_out, laid_out, replayed
from millrace.streaming import global_order, slots


def timed(spark, data, schema):
    return with_time(spark.createDataFrame(data, schema)).drop("s")


def arriving(table):
    """Up to 20 seconds of disorder."""
    late = F.expr("INTERVAL '1' SECOND") * (F.col("id") * 13 % 20)
    return table.withColumn("arrival", F.col("ts") + late)


def stream_of(table, files):
    return replayed(arriving(table), "arrival", "slots", "1 day", files=files, max_files=1, times=["ts"]).drop("arrival")


def results(spark, path):
    return spark.read.parquet(f"{path}/rows").drop("batch")


def busy(spark, n=400):
    rng = random.Random(3)
    data = [(1 if i % 3 else rng.choice([2, 3, None]), i, rng.randrange(600) / 2, float(rng.randrange(100)) if i % 7 else None) for i in range(n)]
    data += [(1, n + i, 77.5, 5.0) for i in range(40)] + [(1, 5000, None, 1.0)]
    return timed(spark, data, "k int, id long, s double, v double")


@pytest.mark.parametrize("files, slot", [(1, None), (5, "9 seconds")])
def test_window_join(spark, tmp_path, files, slot):
    table = busy(spark)
    out = str(tmp_path / "out")

    def side(df, parity, name):
        return df.where(F.col("id") % 2 == parity).select("k", F.col("id").alias(name), F.col("ts").alias(f"{name}_ts"))

    events = stream_of(table, files)
    query = slots.window_join_finished(
        side(events, 0, "l"), side(events, 1, "r"), "k", "l_ts", "r_ts", out, f"{out}-cp", delay="20 seconds", slot=slot, rows_per_task=10, once=True
    )
    query.awaitTermination()
    want = joins.window_join(side(table, 0, "l"), side(table, 1, "r"), "k", "l_ts", "r_ts")
    assert same(results(spark, out), want) and want.count() > 400
    # The log keeps what is open and the slots of the last round, of 35.
    if files == 5:
        assert sum(f.startswith("_slot") for f in os.listdir(f"{out}/log")) < 25
    with pytest.raises(ValueError):
        slots.window_join_finished(side(events, 0, "l"), side(events, 1, "r"), "k", "l_ts", "r_ts", out, out, slot="4 seconds")


@pytest.mark.parametrize("files, slot, rows_per_block", [(1, "1 minute", 10**6), (5, "30 seconds", 15)])
def test_sessions(spark, tmp_path, files, slot, rows_per_block):
    table = busy(spark)
    # A session that lasts over many rounds.
    table = table.unionByName(timed(spark, [(9, 9000 + i, float(i * 4), 1.0) for i in range(200)], "k int, id long, s double, v double"))
    out = str(tmp_path / "out")
    slots.sessions_finished(
        stream_of(table, files), "k", "ts", "v", out, f"{out}-cp", 5, slot, "20 seconds", rows_per_block, once=True
    ).awaitTermination()
    want = sessions.sessions(table.where("ts is not null"), "k", "ts", "v", 5)
    assert rows(results(spark, out)) == rows(want.select(*results(spark, out).columns))
    assert [r.n for r in results(spark, out).where("k = 9").collect()] == [200]


@pytest.mark.parametrize("files, timeout", [(1, "25 seconds"), (5, "3 minutes")])
def test_timers(spark, tmp_path, files, timeout):
    table = busy(spark).select("id", "ts")
    # A pause much longer than a timeout and than a slot.
    table = table.unionByName(timed(spark, [(8000 + i, 4000.0 + i * 60) for i in range(20)], "id long, s double"))
    out = str(tmp_path / "out")
    slots.timer_triggers_finished(stream_of(table, files), "ts", "id", timeout, out, f"{out}-cp", "10 seconds", "20 seconds", 50, once=True).awaitTermination()
    still = slots.open_timers(table, "ts", timeout, out, "10 seconds")
    got = results(spark, out).select("id", "due", "triggered_by").unionByName(still.select("id", "due", F.lit(None).cast("bigint").alias("triggered_by")))
    want = joins.timer_triggers(table.where("ts is not null"), "ts", "id", timeout)
    assert same(got, want.select("id", "due", "triggered_by")) and 0 < still.count() < 10


def test_no_rows_and_late_rows(spark, tmp_path):
    empty, out = busy(spark).limit(0), str(tmp_path / "none")
    slots.sessions_finished(stream_of(empty, 1), "k", "ts", "v", out, f"{out}-cp", once=True).awaitTermination()
    assert spark.read.schema("n bigint").parquet(f"{out}/rows").isEmpty()
    assert slots.open_timers(empty, "ts", "1 minute", out).isEmpty()
    data = [(1, 1, 0.0, 1.0, 0), (1, 2, 500.0, 2.0, 1), (1, 3, 1.0, 9.0, 2), (1, 4, 501.0, 2.0, 3)]
    table = timed(spark, data, "k int, id long, s double, v double, n int")
    table = table.withColumn("arrival", F.expr("timestampadd(SECOND, n, timestamp_ntz'2024-01-01 00:00:00')"))
    out = str(tmp_path / "late")
    events = replayed(table, "arrival", "late", "1 day", files=4, max_files=1, times=["ts"])
    slots.sessions_finished(events, "k", "ts", "v", out, f"{out}-cp", 5, "10 seconds", "10 seconds", once=True).awaitTermination()
    assert sorted((r.n, r.max_value) for r in results(spark, out).collect()) == [(1, 1.0), (2, 2.0)]


def test_a_batch_that_runs_again_replaces_its_work(spark, tmp_path):
    """The log of progress forgets the last batch, as if the driver had been lost before it was committed."""
    table = busy(spark)
    lay_out(arriving(table), "arrival", str(tmp_path / "in"), 3, "1 day", ["ts"])
    out = str(tmp_path / "out")

    def run():
        events = laid_out(spark, arriving(table), str(tmp_path / "in"), 1).drop("arrival")
        slots.sessions_finished(events, "k", "ts", "v", out, f"{out}-cp", 5, "1 minute", "20 seconds", once=True).awaitTermination()
        return rows(results(spark, out))

    first = run()
    commits = f"{out}-cp/commits"
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        if os.path.exists(f"{commits}/{name}"):
            os.unlink(f"{commits}/{name}")
    assert run() == first == rows(sessions.sessions(table.where("ts is not null"), "k", "ts", "v", 5).select(*results(spark, out).columns))


@pytest.mark.parametrize("per_base", [2, 16])
def test_running_max_of_busy_keys(spark, tmp_path, per_base):
    table = busy(spark).where("ts is not null")
    out = str(tmp_path / "out")

    def sides(df):
        return df.where("id % 2 = 0").select("k", "ts", "id"), df.where("id % 2 = 1").select("k", "ts", "id", "v")

    events = replayed(table, "ts", "key-top", files=4, max_files=1)
    global_order.running_max_by_key(*sides(events), "k", "ts", "id", "v", out, f"{out}-cp", 20, per_base, once=True).awaitTermination()
    want = joins.running_max_enrich(*sides(table), "ts", "id", "v", ["k"])
    assert same(results(spark, out), want) and want.where("k is null").count() > 0
    tops = {f for f in os.listdir(f"{out}/top") if f.startswith("batch=")}
    assert len(tops) <= (3 if per_base == 2 else 5)
