"""Sources and sinks."""

import gzip

from pyspark.sql import functions as F

from helpers import rows
from millrace import schemas
from millrace.functions import codec
from millrace.session import checkpoint_root, durable, scratch_dir
from millrace.sources import readers, writers


def test_records_keep_the_corrupt_line(spark, tmp_path):
    path = tmp_path / "cars.csv"
    path.write_text("c1,1000,12.5\nc2,oops,1\n")
    got = readers.records(readers.text_lines(spark, str(path)), schemas.CAR_EVENT)
    assert rows(got) == [("c1", 1000, 12.5, None), ("c2", None, 1.0, "c2,oops,1")]


def test_literals_collections_and_ranges(spark):
    assert rows(readers.literal_rows(spark, [("a", 1)], "w string, n int")) == [("a", 1)]
    assert rows(readers.collection(spark, range(1, 4))) == [(1,), (2,), (3,)]
    whole = readers.integer_range(spark, 0, 1000)
    assert (whole.count(), whole.agg(F.max("v")).first()[0]) == (1001, 1000)


def test_compressed_rides(spark, tmp_path):
    path = tmp_path / "rides.csv.gz"
    with gzip.open(path, "wt") as f:
        f.write("1,true,2024-01-01 00:00:00,2024-01-01 00:10:00,1.0,2.0,3.0,4.0\n")
        f.write("1,false,2024-01-01 00:00:00,2024-01-01 00:10:00,1.0,2.0,3.0,4.0\n")
    got = readers.rides_file(spark, str(path))
    assert [str(r.ts) for r in got.orderBy("ts").collect()] == ["2024-01-01 00:00:00", "2024-01-01 00:10:00"]
    stream = readers.rides_file(spark, str(tmp_path), streaming=True)
    assert stream.isStreaming
    assert writers.drain(stream.select("ride_id", "ts"), "rides").count() == 2


def test_topics_through_files(spark, tmp_path):
    clicks = spark.createDataFrame(
        [("a", "A", 0, "PreProcessing", "i1"), ("b", "B", 1, "PreProcessing", "i2")],
        "customer string, clicked_item string, event_time long, status string, id string",
    )
    folder = str(tmp_path / "log")
    for topic in ("T", "U", "V"):
        writers.write_topic(codec.encode_clicks(clicks, topic), {}, "parquet", folder)
    options = readers.topic_options(["T", "U"], "broker:9092", earliest=True)
    assert options["subscribe"] == "T,U" and options["startingOffsets"] == "earliest"
    asked = readers.topic_options(["T"], "broker:9092", readers.CONSUMER_GROUP, readers.POLL_CAP)
    assert asked["kafka.group.id"] == "test-group1" and asked["kafka.max.poll.records"] == "50"
    batch = readers.topic_rows(spark, options, "parquet", path=folder, streaming=False)
    assert batch.columns == schemas.TOPIC_ROW.names and batch.count() == 4
    stream = readers.topic_rows(spark, options, "parquet", path=folder)
    out, progress = str(tmp_path / "hop"), str(tmp_path / "cp")
    hop = codec.encode_clicks(codec.decode_clicks(stream, ["T"]), "W")
    writers.stream_to_topic(hop, {}, progress, "parquet", out, once=True).awaitTermination()
    assert rows(codec.decode_clicks(spark.read.parquet(out), ["W"])) == rows(clicks)


def test_text_sink_overwrites_and_can_be_one_file(spark, tmp_path):
    out = tmp_path / "out"
    df = spark.range(6).select("id", F.lit("a,b").alias("t")).repartition(3)
    writers.write_text(df, str(out))
    writers.write_text(df, str(out), single_file=True)
    assert len(list(out.glob("part-*"))) == 1
    assert rows(spark.read.text(str(out)))[0] == ('0,"a,b"',)


def test_arrival_time(spark, tmp_path):
    (tmp_path / "x.txt").write_text("hello\n")
    got = readers.arrival_time(spark.read.text(str(tmp_path / "x.txt")))
    assert got.first().arrival_ts is not None


def test_print_plan_and_names(spark, capsys):
    df = writers.named(spark.range(2), "two rows")
    assert spark.sparkContext.getLocalProperty("spark.job.description") == "two rows"
    many = spark.range(1000, 1050)
    writers.print_rows(many)  # goes to the executors' own output
    writers._print_lines(iter(writers.as_text(many).collect()))
    assert capsys.readouterr().out.split() == [str(i) for i in range(1000, 1050)]
    writers.print_rows(df, rows=2)
    writers.show_plan(df)
    shown = capsys.readouterr().out
    assert "| 0" in shown or "|0" in shown
    assert "Physical Plan" in shown


def test_checkpoints_go_to_the_configured_folder(spark, tmp_path):
    root = checkpoint_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir", root)
    assert scratch_dir(spark, "x").startswith(root)
    assert rows(durable(spark.range(2))) == [(0,), (1,)]


def test_ride_codec(spark):
    from millrace.functions.ride_codec import decode_rides, encode_rides

    rides = spark.sql(
        "SELECT 1L AS ride_id, true AS is_start, timestamp'2024-01-01 00:00:00.5' AS start_time,"
        " timestamp'2024-01-01 00:10:00' AS end_time, -73.9D AS start_lon, 40.7D AS start_lat,"
        " 0.1D AS end_lon, 1D / 3 AS end_lat"
    )
    wire = encode_rides(rides)
    got = decode_rides(wire)
    assert rows(got.drop("ts")) == rows(rides)
    assert rows(got.select("ts")) == rows(rides.select("start_time"))
    bad = wire.withColumn("value", F.encode(F.lit("x,true,1,2,0,0,0,0"), "UTF-8"))
    assert decode_rides(bad).isEmpty() and decode_rides(wire, "other").isEmpty()
