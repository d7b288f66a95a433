"""Registered streaming queries. Each runs over the whole table and returns what it wrote.

Only finished results are written. Tables are replayed in event-time order, so results do not depend on
how they lie in files, and a closing row ends the windows, sessions, slots and timeouts that are still open.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.codec import REQUEST_TOPIC, SCORED_TOPIC, decode_clicks, encode_clicks
from millrace.functions.text import tokens_nonempty
from millrace.functions.times import plus_us
from millrace.operators.histograms import histogram_quantiles, rolled_up
from millrace.operators.joins import lookup
from millrace.operators.places import WindowSize
from millrace.operators.rows import rides_inside
from millrace.operators.status import finish_scored, score_requests
from millrace.operators.words import word_counts
from millrace.plans import inputs, oracle
from millrace.plans.queries import LATE_DELAY, ONE_DAY, PLACES_THRESHOLD, SESSION_GAP, THREE_BY_ONE_DAY
from millrace.session import scratch_dir
from millrace.sources.readers import CORRUPT, records, table_stream, text_lines
from millrace.sources.replay import replayed
from millrace.sources.writers import drain, stream_to_text, stream_to_topic, write_text
from millrace.streaming import builtin, global_order, ordered, slots, stateful

HISTOGRAM_QUANTILES = {"p50": 0.5, "p90": 0.9, "p99": 0.99}

# How many files one micro-batch takes, so that its size does not grow with the table.
FILES_PER_BATCH = 64


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = inputs.table(spark, sf_dir, name).schema
    # A pattern, because a stream takes a directory or a pattern but not a single file.
    return table_stream(spark, f"{sf_dir}/{name}.parquet*", schema, FILES_PER_BATCH)


def _wall_clock(df: DataFrame, *columns: str) -> DataFrame:
    """Back to times without a zone, as in the tables."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _replayed(rows: DataFrame, ts: str, label: str, close_after: str | None = None, **more) -> DataFrame:
    """Rows in event-time order, however the table lies in files, with a row that closes what is open at the end."""
    return replayed(rows, ts, label, close_after, max_files=FILES_PER_BATCH, **more)


def stream_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = word_counts(_stream(spark, sf_dir, "documents"), tokens=tokens_nonempty)
    updates = drain(counts, "stream_word_count", mode="update")
    # Totals only grow, so the largest of a word is its latest.
    return updates.groupBy("word").agg(F.max("n").alias("n"))


def _places_stream(spark: SparkSession, sf_dir: str, window: WindowSize, label: str) -> DataFrame:
    inside = rides_inside(inputs.rides(spark, sf_dir), inputs.GRID)
    rides = _replayed(inside, "ts", label, "10 days")
    return drain(builtin.popular_places_stream(rides, inputs.GRID, window, PLACES_THRESHOLD), label)


def stream_popular_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _places_stream(spark, sf_dir, THREE_BY_ONE_DAY, "stream_popular_places")


def stream_popular_places_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _places_stream(spark, sf_dir, ONE_DAY, "stream_popular_places_tumbling")


def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.table(spark, sf_dir, "events").select("user_id", "ts", inputs.cents().alias("cents"))
    events = _replayed(rows, "ts", "stream_sessions", "10 days")
    found = builtin.sessions_stream(events, "user_id", "ts", "cents", SESSION_GAP)
    return _wall_clock(drain(found, "stream_sessions"), "session_start", "session_end")


def stream_metric_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = _replayed(inputs.metric_samples(inputs.table(spark, sf_dir, "events")), "ts", "stream_metric_counts", "1 day")
    counts = builtin.metric_counts_stream(samples, "ts", "1 minute", "40 seconds")
    return _wall_clock(drain(counts, "stream_metric_counts"), "period_start")


def stream_metric_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histograms per hour from a stream, added up to days and asked for quantiles."""
    samples = _replayed(inputs.metric_samples(inputs.table(spark, sf_dir, "events")), "ts", "stream_metric_quantiles", "1 day")
    by_hour = drain(builtin.value_histogram_stream(samples, "ts", "value", "1 hour", "40 seconds"), "stream_metric_quantiles")
    return _wall_clock(histogram_quantiles(rolled_up(by_hour, "1 day"), HISTOGRAM_QUANTILES), "period_start")


def stream_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of text files as a stream, through the text sink and back."""
    rows = inputs.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    source, path, progress = (scratch_dir(spark, f"stream_text-{part}") for part in ("in", "out", "progress"))
    write_text(rows, source)
    kept = records(text_lines(spark, source, streaming=True), rows.schema).drop(CORRUPT)
    stream_to_text(kept, path, progress, once=True).awaitTermination()
    return records(text_lines(spark, f"{path}/batch=*"), rows.schema).drop(CORRUPT)


def stream_window_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _stream(spark, sf_dir, "events")
    clicks = inputs.of_type(events, "click", user_id="user_id", click_id="event_id", click_ts="ts")
    events = _stream(spark, sf_dir, "events")
    views = inputs.of_type(events, "view", user_id="user_id", view_id="event_id", view_ts="ts")
    pairs = builtin.window_join_stream(clicks, views, "user_id", "click_ts", "view_ts", "1 hour")
    timed = drain(pairs, "stream_window_join").withColumns(
        {c: F.timestamp_micros(c) for c in ("click_ts", "view_ts")}
    )
    return _wall_clock(timed, "click_ts", "view_ts", "window_start")


def stream_request_timeout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first response of each request inside the timeout, as in batch form."""
    # The closing rows have no id, so they meet nothing.
    ends = {"close_after": "200 days", "blank": ["id"]}
    requests = _replayed(inputs.requests_of(inputs.table(spark, sf_dir, "orders")), "ts", "stream_requests", **ends)
    shipments = _replayed(inputs.shipments_of(inputs.table(spark, sf_dir, "lineitem")), "shipped", "stream_shipments", **ends)
    found = ordered.first_response_stream(requests, shipments, "id", "ts", "shipped", "90 days", "90 minutes", 60 * 24 * 3600, 8)
    return _wall_clock(drain(found, "stream_request_timeout", rocksdb=True), "ts", "shipped")


def stream_window_join_finished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The window join made when windows are over, a busy user's cut into a grid."""
    rows = inputs.table(spark, sf_dir, "events").where(F.col("event_type").isin("click", "view"))
    events = _replayed(rows, "ts", "stream_window_join_finished", "30 days")
    clicks = inputs.of_type(events, "click", user_id="user_id", click_id="event_id", click_ts="ts")
    views = inputs.of_type(events, "view", user_id="user_id", view_id="event_id", view_ts="ts")
    path, progress = scratch_dir(spark, "stream_pairs"), scratch_dir(spark, "stream_pairs-progress")
    slots.window_join_finished(clicks, views, "user_id", "click_ts", "view_ts", path, progress, "1 hour", slot="7 days", once=True).awaitTermination()
    return spark.read.parquet(f"{path}/rows").drop("batch")


def stream_sessions_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of finished slots, merged with those that were still open."""
    rows = inputs.table(spark, sf_dir, "events").select("user_id", "ts", inputs.cents().alias("cents"))
    events = _replayed(rows, "ts", "stream_sessions_merged", "30 days")
    path, progress = scratch_dir(spark, "stream_merged"), scratch_dir(spark, "stream_merged-progress")
    slots.sessions_finished(events, "user_id", "ts", "cents", path, progress, SESSION_GAP, "7 days", once=True).awaitTermination()
    return spark.read.parquet(f"{path}/rows").drop("batch")


def stream_timer_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's timer with what set it off, and those that are still open at the end."""
    rows = inputs.table(spark, sf_dir, "events").select("event_id", "ts")
    events = _replayed(rows, "ts", "stream_timer_trigger", "30 days")
    path, progress = scratch_dir(spark, "stream_timers"), scratch_dir(spark, "stream_timers-progress")
    slots.timer_triggers_finished(events, "ts", "event_id", "25 minutes", path, progress, "7 days", once=True).awaitTermination()
    still = slots.open_timers(rows, "ts", "25 minutes", path, "7 days")
    return spark.read.parquet(f"{path}/rows").drop("batch").unionByName(still.withColumn("triggered_by", F.lit(None).cast("bigint")))


def stream_event_time_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.table(spark, sf_dir, "events").select("user_id", "ts", "event_id")
    events = _replayed(rows, "ts", "stream_event_time_sort", "30 days")
    sorted_rows = stateful.sort_by_event_time(events, "user_id", "ts", "event_id", f"{LATE_DELAY} seconds", "7 days", 32)
    return _wall_clock(drain(sorted_rows, "stream_event_time_sort"), "ts", "slot_start")


def stream_travel_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides arrive out of order by up to two hours; the model is trained and asked in event order."""
    arriving = _arriving(inputs.rides(spark, sf_dir), "ride_id")
    rides = _replayed(arriving, "arrival_ts", "stream_travel_time", "60 days", times=["ts"])
    found = ordered.travel_time_stream(rides, inputs.GRID, "2 hours", 7 * 24 * 3600)
    return drain(found, "stream_travel_time", rocksdb=True)


def _arriving(rows: DataFrame, number: str) -> DataFrame:
    """When each row arrives: up to two hours after its time."""
    return rows.withColumn("arrival_ts", plus_us(F.col("ts"), (F.col(number) * 7919 % 7200) * 1_000_000))


def _trades_and_infos(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    keyed = {"user_id": "user_id", "ts": "ts", "event_id": "event_id"}
    info = F.concat(F.lit("signup "), F.col("event_id").cast("string"))
    return inputs.of_type(events, "purchase", **keyed), inputs.of_type(events, "signup", **keyed, info=info)


def stream_asof_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Early answers; in event order there is nothing to correct."""
    events = _replayed(inputs.table(spark, sf_dir, "events"), "ts", "stream_asof_join")
    trades, infos = _trades_and_infos(events)
    answers = stateful.asof_stream(trades, infos, "user_id", "ts", "event_id", "info", "1 hour")
    return _wall_clock(drain(answers, "stream_asof_join"), "ts")


def stream_asof_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The final answers where trades and infos arrive out of order by up to two hours."""
    rows = inputs.table(spark, sf_dir, "events").where(F.col("event_type").isin("purchase", "signup"))
    events = _replayed(_arriving(rows, "event_id"), "arrival_ts", "stream_asof_final", "60 days", times=["ts"])
    trades, infos = _trades_and_infos(events)
    answers = ordered.asof_refined_stream(trades, infos, "user_id", "ts", "event_id", "info", "2 hours", 7 * 24 * 3600)
    return _wall_clock(drain(answers, "stream_asof_final", rocksdb=True), "ts").where("is_final")


def stream_in_flight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders open when placed; each shipment answers, and only the first one after closes."""
    requests = inputs.requests_of(_stream(spark, sf_dir, "orders"))
    shipments = inputs.shipments_of(_stream(spark, sf_dir, "lineitem"))
    responses = shipments.select(
        "id", F.col("shipped").alias("ts"), F.lit(inputs.PROCESSING_DONE).alias("status")
    )
    changes = drain(stateful.in_flight_stream(requests, responses, "ts"), "stream_in_flight")
    return _wall_clock(changes, "ts").where("change <> 0")


def stream_in_flight_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of open orders after each order and each first shipment, over the whole stream."""
    requests = inputs.requests_of(inputs.table(spark, sf_dir, "orders"))
    first = inputs.first_shipments(requests, inputs.shipments_of(inputs.table(spark, sf_dir, "lineitem")))
    both = requests.withColumn("status", F.lit(inputs.PRE_PROCESSING)).unionByName(first)
    path, progress = scratch_dir(spark, "stream_open"), scratch_dir(spark, "stream_open-progress")
    events = _replayed(both, "ts", "stream_in_flight_size")
    asked, answered = events.where(F.col("status") == inputs.PRE_PROCESSING), events.where(F.col("status") == inputs.PROCESSING_DONE)
    global_order.in_flight_size_everywhere(asked.drop("status"), answered, "ts", path, progress, once=True).awaitTermination()
    return _wall_clock(spark.read.parquet(f"{path}/rows").drop("batch"), "ts")


def _clicks_and_views(spark: SparkSession, sf_dir: str, label: str) -> tuple[DataFrame, DataFrame]:
    keyed = {"user_id": "user_id", "ts": "ts", "event_id": "event_id"}
    events = _replayed(inputs.table(spark, sf_dir, "events"), "ts", label)
    return inputs.of_type(events, "click", **keyed), inputs.of_type(events, "view", **keyed, cents=inputs.cents())


def stream_running_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks, views = _clicks_and_views(spark, sf_dir, "stream_running_max")
    best = stateful.running_max_stream(clicks, views, "user_id", "ts", "event_id", "cents")
    return _wall_clock(drain(best, "stream_running_max"), "ts")


def stream_running_max_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over blocks, for users of any size."""
    clicks, views = _clicks_and_views(spark, sf_dir, "stream_running_max_by_key")
    path, progress = scratch_dir(spark, "stream_key_top"), scratch_dir(spark, "stream_key_top-progress")
    global_order.running_max_by_key(clicks, views, "user_id", "ts", "event_id", "cents", path, progress, once=True).awaitTermination()
    return spark.read.parquet(f"{path}/rows").drop("batch")


def stream_running_max_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks, views = _clicks_and_views(spark, sf_dir, "stream_running_max_global")
    path, progress = scratch_dir(spark, "stream_top"), scratch_dir(spark, "stream_top-progress")
    global_order.running_max_everywhere(
        clicks, views, "ts", "event_id", "cents", path, progress, once=True
    ).awaitTermination()
    return spark.read.parquet(f"{path}/rows").drop("batch")


def stream_status_hops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three streams joined by topics: requests, the first hop, the second hop."""
    wire = encode_clicks(inputs.clicks_of(_stream(spark, sf_dir, "events")), REQUEST_TOPIC)
    for label, hop in (("requests", None), ("scored", score_requests), ("finished", finish_scored)):
        path, progress = scratch_dir(spark, f"stream_{label}"), scratch_dir(spark, f"stream_{label}-progress")
        rows = hop(wire) if hop else wire
        stream_to_topic(rows, {}, progress, "parquet", path, once=True).awaitTermination()
        wire = table_stream(spark, path, rows.schema, FILES_PER_BATCH)
    return decode_clicks(spark.read.schema(wire.schema).parquet(path), [SCORED_TOPIC])


def stream_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream against a static table."""
    customers = _stream(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("key"))
    nations = inputs.table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("key"), F.col("n_name").alias("result")
    )
    return drain(lookup(customers, nations, "key"), "stream_lookup")


STREAMS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        stream_word_count,
        stream_popular_places,
        stream_popular_places_tumbling,
        stream_sessions,
        stream_metric_counts,
        stream_metric_quantiles,
        stream_text,
        stream_window_join,
        stream_window_join_finished,
        stream_sessions_merged,
        stream_request_timeout,
        stream_timer_trigger,
        stream_event_time_sort,
        stream_travel_time,
        stream_asof_join,
        stream_asof_final,
        stream_in_flight,
        stream_in_flight_size,
        stream_running_max,
        stream_running_max_by_key,
        stream_running_max_global,
        stream_status_hops,
        stream_lookup,
    )
}

STREAM_SQL: dict[str, str] = {
    "stream_word_count": oracle.WORDS_NONEMPTY,
    "stream_popular_places": oracle.BATCH["popular_places"],
    "stream_popular_places_tumbling": oracle.BATCH["popular_places_tumbling"],
    "stream_sessions": oracle.BATCH["sessions"],
    "stream_metric_counts": oracle.BATCH["metric_counts"],
    "stream_window_join": oracle.BATCH["window_join"],
    "stream_window_join_finished": oracle.BATCH["window_join"],
    "stream_sessions_merged": oracle.BATCH["sessions"],
    "stream_timer_trigger": oracle.BATCH["timer_trigger"],
    "stream_request_timeout": oracle.BATCH["request_timeout"],
    "stream_event_time_sort": """
SELECT user_id, ts, event_id, slot_start,
       row_number() OVER (PARTITION BY user_id, slot_start ORDER BY ts, event_id) AS position
FROM (SELECT *, time_bucket(INTERVAL 7 DAYS, ts, TIMESTAMP '1970-01-01') AS slot_start FROM events)""",
    "stream_travel_time": oracle.TRAVEL_TIME,
    "stream_asof_join": f"SELECT *, false AS is_final FROM ({oracle.ASOF})",
    "stream_metric_quantiles": f"""
WITH h AS ({oracle.HISTOGRAM.format(period='day')}),
r AS (SELECT *, sum(n) OVER (PARTITION BY period_start, metric ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY period_start, metric) AS size FROM h)
SELECT period_start, metric, CAST(max(size) AS BIGINT) AS n,
       {', '.join(f"min(bucket) FILTER (upto > floor({p!r} * (size - 1))) AS {name}" for name, p in HISTOGRAM_QUANTILES.items())}
FROM r GROUP BY period_start, metric""",
    "stream_text": "SELECT c_custkey, c_name, c_nationkey FROM customer",
    "stream_asof_final": f"SELECT *, true AS is_final FROM ({oracle.ASOF})",
    "stream_in_flight_size": oracle.BATCH["in_flight_size"],
    "stream_in_flight": """
WITH first_shipments AS (
  SELECT o_orderkey AS id, min(l_shipdate) AS ts FROM orders JOIN lineitem ON l_orderkey = o_orderkey
  WHERE l_shipdate >= o_orderdate GROUP BY o_orderkey)
SELECT o_orderkey AS id, o_orderdate AS ts, 0 AS side, 1 AS change FROM orders
UNION ALL SELECT id, ts, 1, -1 FROM first_shipments""",
    "stream_running_max_global": f"""
SELECT ts, event_id, CAST(max_so_far AS DOUBLE) AS max_so_far FROM ({oracle.BATCH['running_max_enrich']})""",
    "stream_status_hops": oracle.BATCH["status_hops"],
    "stream_lookup": oracle.BATCH["lookup_enrich"],
    "stream_running_max": f"""
SELECT user_id, ts, event_id, CAST(max_so_far AS DOUBLE) AS max_so_far FROM (
  SELECT *, coalesce(max({oracle.CENTS}) FILTER (event_type = 'view')
                     OVER (PARTITION BY user_id ORDER BY ts, event_id), 0) AS max_so_far
  FROM events) WHERE event_type = 'click'""",
}
STREAM_SQL["stream_running_max_by_key"] = STREAM_SQL["stream_running_max"]
