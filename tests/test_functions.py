from pyspark.sql import functions as F

from helpers import rows
from millrace.functions import codec, text, times
from millrace.functions.geo import GridSpec, direction_deg, distance_km

GRID = GridSpec(west=0.0, east=1.0, south=0.0, north=1.0, dlon=0.25, dlat=0.5)


def test_tokens(spark):
    cases = ["", "--", "--x", "x--", "To be,--That", "aéb c", None]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, text string")
    batch = [r.t for r in df.orderBy("i").select(text.tokens_batch(F.col("text")).alias("t")).collect()]
    assert batch == [[""], [], ["", "x"], ["x"], ["to", "be", "that"], ["a", "b", "c"], None]
    stream = [r.t for r in df.orderBy("i").select(text.tokens_nonempty(F.col("text")).alias("t")).collect()]
    assert stream == [[], [], ["x"], ["x"], ["to", "be", "that"], ["a", "b", "c"], None]


def test_times(spark):
    df = spark.sql(
        "SELECT timestamp_ntz'2024-01-01 00:00:00.0015' AS a, timestamp_ntz'2024-01-01 00:01:30.0015' AS b"
    )
    got = df.select(
        times.epoch_ms(F.col("a")), times.epoch_us(F.col("a")),
        times.elapsed_minutes(F.col("a"), F.col("b")), times.plus_us(F.col("a"), -500).cast("string"),
        times.epoch_ms(times.from_epoch_ms(F.lit(1704067200001))),
    ).first()
    assert tuple(got) == (1704067200001, 1704067200001500, 1.5, "2024-01-01 00:00:00.001", 1704067200001)
    assert df.select((times.now_ms() > 1704067200000).alias("x")).first().x


def test_grid(spark):
    points = [(0.0, 1.0), (0.3, 0.9), (1.0, 0.0), (0.99, 0.49), (1.01, 0.5), (0.5, -0.1), (None, 0.5)]
    df = spark.createDataFrame(points, "lon double, lat double")
    lon, lat = F.col("lon"), F.col("lat")
    got = [tuple(r) for r in df.select(GRID.contains(lon, lat), GRID.cell(lon, lat)).collect()]
    assert got[:4] == [(True, 0), (True, 1), (True, 7), (True, 7)]
    assert [g[0] for g in got[4:]] == [False, False, None]
    cells = spark.range(8).select(
        (GRID.cell(GRID.center_lon(F.col("id")), GRID.center_lat(F.col("id"))) == F.col("id")).alias("same")
    )
    assert all(r.same for r in cells.collect())


def test_distance_and_direction(spark):
    df = spark.createDataFrame(
        [(0.0, 0.0, 1.0, 0.0), (0.0, 0.0, 0.0, 1.0), (0.0, 0.0, -1.0, 0.0), (0.0, 0.0, 0.0, -1.0)],
        "x1 double, y1 double, x2 double, y2 double",
    )
    args = [F.col(c) for c in ("x1", "y1", "x2", "y2")]
    got = [tuple(r) for r in df.select(F.round(distance_km(*args, 0.0), 2), direction_deg(*args, 0.0)).collect()]
    assert got == [(111.32, 0.0), (111.32, 90.0), (111.32, 180.0), (111.32, 270.0)]


def topic(spark, *values, name="T"):
    df = spark.createDataFrame([(v, name) for v in values], "v string, topic string")
    return df.select(F.encode("v", "UTF-8").alias("value"), "topic")


def test_codec_roundtrip_and_gate(spark):
    clicks = spark.createDataFrame(
        [("a", "A", 0, "PreProcessing", "i1"), ("ü", "B", -5, "FeatureScoring", "i2")],
        "customer string, clicked_item string, event_time long, status string, id string",
    )
    wire = codec.encode_clicks(clicks, "T")
    assert wire.columns == ["key", "value", "topic"]
    assert rows(wire.select(F.decode("key", "UTF-8"))) == [("a",), ("ü",)]
    assert rows(codec.decode_clicks(wire, ["T", "U"])) == rows(clicks)
    assert codec.decode_clicks(wire, ["U"]).isEmpty()


def test_corrupt_rows(spark):
    lines = ["a|A|0|P|i1", "a|A|0|P", "a|A|x|P|i", "a|A|1.5|P|i", "a|A|99999999999999999999|P|i", "a|A|0|P|", "",
             "a|A|7|P|i|extra", "a||3|P|i"]
    wire = topic(spark, *lines)
    good = rows(codec.decode_clicks(wire, ["T"]))
    assert good == [("a", "", 3, "P", "i"), ("a", "A", 0, "P", "i1"), ("a", "A", 7, "P", "i")]
    bad = rows(codec.corrupt_rows(wire, ["T"]).select(F.decode("value", "UTF-8")))
    assert bad == sorted(((l,) for l in lines[1:7]), key=repr)


def test_defaults(spark):
    df = spark.createDataFrame(
        [("a", "A", 0, None, None), ("a", "A", 0, "X", "i")],
        "customer string, clicked_item string, event_time long, status string, id string",
    )
    got = {r.status: r.id for r in codec.with_defaults(df).collect()}
    assert got["X"] == "i" and len(got["PreProcessing"]) == 36
