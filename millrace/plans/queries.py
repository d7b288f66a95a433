"""Registered queries: name -> (spark, sf_dir) -> DataFrame. All read whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions.codec import (
    REQUEST_TOPIC,
    click_text,
    decode_clicks,
    encode_clicks,
)
from millrace.functions.ride_codec import decode_rides, encode_rides
from millrace.functions.text import tokens_nonempty
from millrace.operators.histograms import rolled_up, value_histogram
from millrace.operators.inflight import in_flight_size, open_requests
from millrace.operators.iterate import countdown, increment_until_odd
from millrace.operators.joins import (
    asof_join,
    lookup,
    request_timeouts,
    running_max_enrich,
    running_max_label,
    timer_triggers,
    window_join_any_skew,
)
from millrace.operators.lateness import mark_late, sorted_on_time
from millrace.operators.metrics import metric_counts, metric_histogram
from millrace.operators.places import WindowSize, popular_places
from millrace.operators.rows import nonempty, rebalance, rides_inside, split_by, with_status
from millrace.operators.sessions import sessions_any_skew
from millrace.operators.status import click_hops, finish_scored, score_requests
from millrace.operators.travel_time import travel_time_predictions
from millrace.operators.words import word_counts, word_running_totals
from millrace.plans.inputs import (
    GRID,
    arrivals_of,
    cents,
    clicks_of,
    first_shipments,
    metric_samples,
    of_type,
    requests_of,
    rides,
    shipments_of,
    table,
)
from millrace.session import scratch_dir
from millrace.sources.readers import CORRUPT, records, rides_file, text_lines
from millrace.sources.writers import write_text

Query = Callable[[SparkSession, str], DataFrame]

DAY = 24 * 60 * 60
THREE_BY_ONE_DAY = WindowSize(3 * DAY, DAY)
ONE_DAY = WindowSize(DAY, DAY)
PLACES_THRESHOLD = 5
SESSION_GAP = 8 * 60 * 60
LATE_DELAY = 40 * 60
QUANTILES = {"p50": 0.5, "p75": 0.75, "p95": 0.95, "p98": 0.98, "p99": 0.99, "p999": 0.999}


def word_count_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_counts(table(spark, sf_dir, "documents"))


def word_count_nonempty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_counts(table(spark, sf_dir, "documents"), tokens=tokens_nonempty)


def word_running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_running_totals(table(spark, sf_dir, "documents"), "doc_id")


def ride_cleansing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rides_inside(rides(spark, sf_dir), GRID)


def popular_places_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return popular_places(rides(spark, sf_dir), GRID, THREE_BY_ONE_DAY, PLACES_THRESHOLD)


def popular_places_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return popular_places(rides(spark, sf_dir), GRID, ONE_DAY, PLACES_THRESHOLD)


def popular_places_via_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleansing and counting as two jobs with the ride topic between them."""
    wire = encode_rides(rides_inside(rides(spark, sf_dir), GRID))
    return popular_places(decode_rides(wire), GRID, THREE_BY_ONE_DAY, PLACES_THRESHOLD)


def travel_time_prequential(spark: SparkSession, sf_dir: str) -> DataFrame:
    return travel_time_predictions(rides(spark, sf_dir), GRID)


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("cents", cents())
    return sessions_any_skew(events, "user_id", "ts", "event_id", "cents", SESSION_GAP)


def late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = arrivals_of(table(spark, sf_dir, "events"))
    return mark_late(events, "ts", ["arrival_ts", "event_id"], LATE_DELAY)


def event_time_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = arrivals_of(table(spark, sf_dir, "events"))
    arrival = ["arrival_ts", "event_id"]
    return sorted_on_time(events, "user_id", "ts", "event_id", arrival, LATE_DELAY)


def window_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    clicks = of_type(events, "click", user_id="user_id", click_id="event_id", click_ts="ts")
    views = of_type(events, "view", user_id="user_id", view_id="event_id", view_ts="ts")
    return window_join_any_skew(clicks, views, "user_id", "click_ts", "view_ts", "1 hour")


def running_max_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    clicks = of_type(events, "click", ts="ts", event_id="event_id")
    views = of_type(events, "view", ts="ts", event_id="event_id", cents=cents())
    best = running_max_enrich(clicks, views, "ts", "event_id", "cents")
    return best.withColumn("label", running_max_label("event_id"))


def asof_join_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    trades = of_type(events, "purchase", user_id="user_id", ts="ts", event_id="event_id")
    info = F.concat(F.lit("signup "), F.col("event_id").cast("string"))
    infos = of_type(events, "signup", user_id="user_id", ts="ts", event_id="event_id", info=info)
    return asof_join(trades, infos, "user_id", "ts", "event_id", "info")


def _requests_and_responses(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    requests = requests_of(table(spark, sf_dir, "orders"))
    return requests, first_shipments(requests, shipments_of(table(spark, sf_dir, "lineitem")))


def in_flight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return open_requests(*_requests_and_responses(spark, sf_dir))


def in_flight_over_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests, responses = _requests_and_responses(spark, sf_dir)
    return in_flight_size(requests, responses, "ts")


def request_timeout(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = requests_of(table(spark, sf_dir, "orders"))
    shipments = shipments_of(table(spark, sf_dir, "lineitem"))
    return request_timeouts(requests, shipments, "id", "ts", "shipped", "90 days")


def timer_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return timer_triggers(events, "ts", "event_id", "25 minutes")


def lookup_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("key"))
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("result"))
    return lookup(customers, nations, "key")


def codec_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    wire = encode_clicks(clicks_of(table(spark, sf_dir, "events")), REQUEST_TOPIC)
    return decode_clicks(wire, [REQUEST_TOPIC]).withColumn("line", click_text())


def status_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in one status and the complement of the split, side by side."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    finished = with_status(orders, "F").withColumn("side", F.lit("finished"))
    _, others = split_by(orders, F.col("status") == "F")
    return finished.unionByName(others.withColumn("side", F.lit("other")))


def scored_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After the first hop, as it goes over the wire."""
    wire = encode_clicks(clicks_of(table(spark, sf_dir, "events")), REQUEST_TOPIC)
    return score_requests(wire).select(
        F.decode("key", "UTF-8").alias("key"), F.decode("value", "UTF-8").alias("value"), "topic"
    )


def finished_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After both hops, as it goes over the wire."""
    wire = encode_clicks(clicks_of(table(spark, sf_dir, "events")), REQUEST_TOPIC)
    return finish_scored(score_requests(wire)).select(
        F.decode("key", "UTF-8").alias("key"), F.decode("value", "UTF-8").alias("value"), "topic"
    )


def status_hops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return click_hops(clicks_of(table(spark, sf_dir, "events")))


def metric_counts_by_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_counts(metric_samples(table(spark, sf_dir, "events")))


def metric_histogram_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    histogram = metric_histogram(metric_samples(table(spark, sf_dir, "events")), QUANTILES, period="1 day")
    rounded = ["mean_value", "stddev_value", *QUANTILES]
    return histogram.withColumns({c: F.round(c, 4) for c in rounded})


def iterate_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").alias("v"))
    loop = increment_until_odd(keys, "v")
    left, stays = F.lit(True).alias("left_loop"), F.lit(False).alias("left_loop")
    return loop.output.select("*", left).unionByName(loop.residue.select("*", stays))


def iterate_countdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = (F.col("o_orderkey") % 100).alias("v")
    loop = countdown(table(spark, sf_dir, "orders").select("o_orderkey", start), "v", max_rounds=100)
    return loop.output


def metric_value_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mergeable histograms per minute, added up to hours."""
    samples = metric_samples(table(spark, sf_dir, "events"))
    return rolled_up(value_histogram(samples, "ts", "value", "1 minute"), "1 hour")


def popular_places_via_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides written as compressed delimited files and read again."""
    path = scratch_dir(spark, "ride-file")
    columns = [F.col(f.name).cast("timestamp" if "time" in f.name else f.dataType) for f in schemas.RIDE.fields]
    rides(spark, sf_dir).select(*columns).write.option("compression", "gzip").csv(path)
    read = rides_file(spark, path).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return popular_places(read, GRID, THREE_BY_ONE_DAY, PLACES_THRESHOLD)


def _event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", cents().alias("cents"))


def text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as lines of text, and records from the lines."""
    path, rows = scratch_dir(spark, "text"), _event_lines(spark, sf_dir)
    write_text(rows, path)
    return records(text_lines(spark, path), rows.schema).drop(CORRUPT)


def nonempty_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a source, dealt out evenly."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return rebalance(nonempty(docs, "source"), 16)


BATCH: dict[str, Query] = {
    "popular_places": popular_places_sliding,
    "popular_places_tumbling": popular_places_tumbling,
    "popular_places_via_topic": popular_places_via_topic,
    "ride_cleansing": ride_cleansing,
    "travel_time_prequential": travel_time_prequential,
    "word_count_batch": word_count_batch,
    "word_count_nonempty": word_count_nonempty,
    "word_running_total": word_running_total,
    "sessions": sessions,
    "late_events": late_events,
    "event_time_sort": event_time_sort,
    "window_join": window_join,
    "running_max_enrich": running_max_enriched,
    "asof_join": asof_join_latest,
    "in_flight": in_flight,
    "in_flight_size": in_flight_over_time,
    "request_timeout": request_timeout,
    "timer_trigger": timer_trigger,
    "lookup_enrich": lookup_enrich,
    "codec_roundtrip": codec_roundtrip,
    "status_filter": status_filter,
    "scored_requests": scored_requests,
    "finished_requests": finished_requests,
    "status_hops": status_hops,
    "metric_counts": metric_counts_by_minute,
    "metric_histogram": metric_histogram_by_day,
    "iterate_increment": iterate_increment,
    "iterate_countdown": iterate_countdown,
    "metric_value_histogram": metric_value_histogram,
    "popular_places_via_file": popular_places_via_file,
    "text_roundtrip": text_roundtrip,
    "nonempty_sources": nonempty_sources,
}
