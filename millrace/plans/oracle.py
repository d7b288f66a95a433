"""The SQL each registered query must agree with, in DuckDB's dialect."""

from __future__ import annotations

import math

from millrace.functions.codec import BUSINESS_TOPIC, FEATURE_SCORING, PROCESSING_DONE, SCORED_TOPIC
from millrace.functions.geo import EARTH_KM_PER_DEGREE
from millrace.operators.joins import LABEL_GAP, NO_INFO
from millrace.operators.metrics import PREFIX
from millrace.operators.travel_time import DIRECTION_BUCKETS
from millrace.plans.inputs import GRID
from millrace.plans.queries import LATE_DELAY, PLACES_THRESHOLD, QUANTILES, SESSION_GAP


def _num(value: float) -> str:
    """A DOUBLE literal (a plain one with a point would be a DECIMAL)."""
    return f"({value!r}e0)"


W, E, S, N = map(_num, (GRID.west, GRID.east, GRID.south, GRID.north))
DLON, DLAT = _num(GRID.dlon), _num(GRID.dlat)
COLS, ROWS = GRID.columns, GRID.rows
DAY_MS = 24 * 60 * 60 * 1000
CENTS = "CAST(round(value * 100) AS BIGINT)"

RIDES = f"""rides AS (
  SELECT event_id AS ride_id, ts, event_type IN ('click', 'view') AS is_start,
         ts - to_microseconds({CENTS} * 600000) AS start_time, ts AS end_time,
         {_num(-74.06)} + ((event_id * 7919 + user_id * 104729) % 320) / 1000e0 AS start_lon,
         {_num(40.54)} + ((event_id * 6101 + user_id * 31) % 320) / 1000e0 AS start_lat,
         {_num(-74.06)} + ((event_id * 4513 + user_id * 613) % 320) / 1000e0 AS end_lon,
         {_num(40.54)} + ((event_id * 3571 + user_id * 1009) % 320) / 1000e0 AS end_lat
  FROM events),
inside AS (
  SELECT * FROM rides
  WHERE start_lon BETWEEN {W} AND {E} AND start_lat BETWEEN {S} AND {N}
    AND end_lon BETWEEN {W} AND {E} AND end_lat BETWEEN {S} AND {N})"""


def _cell(lon: str, lat: str) -> str:
    return (
        f"CAST(least(floor(({lon} - {W}) / {DLON}), {COLS - 1})"
        f" + least(floor(({N} - {lat}) / {DLAT}), {ROWS - 1}) * {COLS} AS INTEGER)"
    )


def places(days: int, time: str = "ts") -> str:
    return f"""
WITH {RIDES},
hits AS (
  SELECT {time} AS ts, is_start, CASE WHEN is_start THEN {_cell('start_lon', 'start_lat')}
                            ELSE {_cell('end_lon', 'end_lat')} END AS cell FROM inside),
counted AS (
  SELECT cell, is_start, epoch_ms(date_trunc('day', ts)) + (k + 1) * {DAY_MS} AS window_end_ms, count(*) AS n
  FROM hits, range({days}) AS slides(k) GROUP BY ALL)
SELECT CAST({W} + (cell % {COLS} + 0.5e0) * {DLON} AS REAL) AS lon,
       CAST({N} - (floor(cell / {COLS}) + 0.5e0) * {DLAT} AS REAL) AS lat,
       CAST(window_end_ms AS BIGINT) AS window_end_ms, is_start, CAST(n AS INTEGER) AS n
FROM counted WHERE n >= {PLACES_THRESHOLD}"""


_EAST = _num(EARTH_KM_PER_DEGREE * math.cos(math.radians((GRID.south + GRID.north) / 2)))
_NORTH = _num(EARTH_KM_PER_DEGREE)
_BUCKET = 360 // DIRECTION_BUCKETS

TRAVEL_TIME = f"""
WITH {RIDES},
moved AS (
  SELECT *, (end_lon - start_lon) * {_EAST} AS dx, (end_lat - start_lat) * {_NORTH} AS dy,
         degrees(atan2((start_lat - end_lat) * {_NORTH}, (start_lon - end_lon) * {_EAST})) AS angle
  FROM inside),
features AS (
  SELECT ride_id, ts, is_start, {_cell('end_lon', 'end_lat')} AS cell,
         CAST(floor((CASE WHEN angle < 0 THEN angle + 360 ELSE angle END) / {_BUCKET}) AS INTEGER)
           % {DIRECTION_BUCKETS} AS bucket,
         round(sqrt(dx * dx + dy * dy) * 100e0) AS x,
         CAST(epoch_ms(end_time) - epoch_ms(start_time) AS DOUBLE) AS y
  FROM moved),
fitted AS (
  SELECT *, CAST(count(*) FILTER (NOT is_start) OVER w AS DOUBLE) AS n,
         sum(x) FILTER (NOT is_start) OVER w AS sx, sum(y) FILTER (NOT is_start) OVER w AS sy,
         sum(x * x) FILTER (NOT is_start) OVER w AS sxx, sum(x * y) FILTER (NOT is_start) OVER w AS sxy
  FROM features
  WINDOW w AS (PARTITION BY cell, bucket ORDER BY ts, ride_id ROWS UNBOUNDED PRECEDING)),
lines AS (
  SELECT *, CASE WHEN n * sxx - sx * sx <> 0 THEN (n * sxy - sx * sy) / (n * sxx - sx * sx) ELSE 0 END AS slope
  FROM fitted)
SELECT ride_id, cell, CAST(bucket AS INTEGER) AS bucket,
       CASE WHEN n > 0 THEN CAST(trunc(((sy - slope * sx) / n + slope * x) / 60000e0) AS INTEGER) END AS minutes
FROM lines WHERE is_start"""


_TRIMMED = r"regexp_replace(lower(text), '\W+\z', '')"
TOKENS_BATCH = rf"""unnest(CASE WHEN length(lower(text)) > 0 AND length({_TRIMMED}) = 0 THEN []::VARCHAR[]
                    ELSE regexp_split_to_array({_TRIMMED}, '\W+') END)"""
TOKENS_NONEMPTY = r"list_filter(regexp_split_to_array(lower(text), '\W+'), lambda t: t <> '')"

WORDS_NONEMPTY = f"""
SELECT word, count(*) AS n
FROM (SELECT unnest({TOKENS_NONEMPTY}) AS word FROM documents) GROUP BY word"""

SESSION_ROWS = f"""numbered AS (
  SELECT user_id, ts, {CENTS} AS cents, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nr
  FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)
                            <= INTERVAL {SESSION_GAP} SECONDS THEN 0 ELSE 1 END AS opens FROM events)),
found AS (
  SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n,
         min(cents) AS min_value, max(cents) AS max_value, CAST(sum(cents) AS DOUBLE) / count(*) AS avg_value
  FROM numbered GROUP BY user_id, nr)"""

ARRIVALS = f"""arrivals AS (
  SELECT event_id, user_id, ts, ts + to_seconds(event_id * 7919 % 7200) AS arrival_ts FROM events),
marked AS (
  SELECT *, coalesce(max(ts) OVER (ORDER BY arrival_ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                     - ts >= INTERVAL {LATE_DELAY} SECONDS, false) AS is_late FROM arrivals)"""

CLICKS = """clicks AS (
  SELECT CAST(user_id AS VARCHAR) AS customer, event_type AS clicked_item, epoch_us(ts) // 1000 AS event_time,
         CAST(event_id AS VARCHAR) AS id FROM events)"""


def _wire(status: str, topic: str) -> str:
    return f"""
WITH {CLICKS}
SELECT customer AS key, concat_ws('|', customer, clicked_item, event_time, '{status}', id) AS value,
       '{topic}' AS topic FROM clicks"""


FIRST_SHIPMENTS = """first_shipments AS (
  SELECT o_orderkey AS id, min(l_shipdate) AS ts FROM orders JOIN lineitem ON l_orderkey = o_orderkey
  WHERE l_shipdate >= o_orderdate GROUP BY o_orderkey)"""

_QUANTILES = ", ".join(f"round(quantile_cont({CENTS}, {p!r}), 4) AS {n}" for n, p in QUANTILES.items())

ASOF = f"""
SELECT t.user_id, t.ts, t.event_id, coalesce(i.info, '{NO_INFO}') AS info
FROM (SELECT * FROM events WHERE event_type = 'purchase') t
ASOF LEFT JOIN (SELECT user_id, ts, 'signup ' || event_id AS info FROM events WHERE event_type = 'signup') i
ON t.user_id = i.user_id AND t.ts >= i.ts"""

_WIDTH = "greatest(length(bin(abs(cents))) - 6, 0)"
HISTOGRAM = f"""
SELECT date_trunc('{{period}}', ts) AS period_start, '{PREFIX}.' || event_type AS metric,
       CAST(((abs(cents) >> {_WIDTH}) << {_WIDTH}) * sign(cents) AS BIGINT) AS bucket, count(*) AS n
FROM (SELECT *, {CENTS} AS cents FROM events) WHERE cents IS NOT NULL GROUP BY ALL"""

BATCH: dict[str, str] = {
    "popular_places": places(3),
    "popular_places_tumbling": places(1),
    "popular_places_via_topic": places(3, time="CASE WHEN is_start THEN start_time ELSE end_time END"),
    "ride_cleansing": f"WITH {RIDES} SELECT * FROM inside",
    "travel_time_prequential": TRAVEL_TIME,
    "word_count_batch": f"SELECT word, count(*) AS n FROM (SELECT {TOKENS_BATCH} AS word FROM documents) GROUP BY word",
    "word_count_nonempty": WORDS_NONEMPTY,
    "word_running_total": f"""
WITH listed AS (SELECT doc_id, {TOKENS_NONEMPTY} AS tokens FROM documents),
words AS (SELECT doc_id, unnest(tokens) AS word, CAST(generate_subscripts(tokens, 1) - 1 AS INTEGER) AS pos FROM listed)
SELECT doc_id, pos, word, count(*) OVER (PARTITION BY word ORDER BY doc_id, pos ROWS UNBOUNDED PRECEDING) AS n
FROM words""",
    "sessions": f"WITH {SESSION_ROWS} SELECT * FROM found",
    "late_events": f"WITH {ARRIVALS} SELECT * FROM marked",
    "event_time_sort": f"""
WITH {ARRIVALS}
SELECT event_id, user_id, ts, arrival_ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS position
FROM marked WHERE NOT is_late""",
    "window_join": """
SELECT c.user_id, date_trunc('hour', c.ts) AS window_start, c.event_id AS click_id, c.ts AS click_ts,
       v.event_id AS view_id, v.ts AS view_ts
FROM events c JOIN events v ON c.user_id = v.user_id AND date_trunc('hour', c.ts) = date_trunc('hour', v.ts)
WHERE c.event_type = 'click' AND v.event_type = 'view'""",
    "running_max_enrich": f"""
SELECT ts, event_id, max_so_far, event_id || '{LABEL_GAP}' || max_so_far AS label FROM (
  SELECT *, coalesce(max({CENTS}) FILTER (event_type = 'view') OVER (ORDER BY ts, event_id), 0) AS max_so_far
  FROM events) WHERE event_type = 'click'""",
    "asof_join": ASOF,
    "in_flight": f"""
WITH {FIRST_SHIPMENTS}
SELECT o_orderkey AS id, o_orderdate AS ts FROM orders WHERE o_orderkey NOT IN (SELECT id FROM first_shipments)""",
    "in_flight_size": f"""
WITH {FIRST_SHIPMENTS},
changes AS (
  SELECT o_orderdate AS ts, 0 AS side, o_orderkey AS id, 1 AS change FROM orders
  UNION ALL SELECT ts, 1, id, -1 FROM first_shipments)
SELECT *, CAST(sum(change) OVER (ORDER BY ts, side, id) AS BIGINT) AS in_flight FROM changes""",
    "request_timeout": """
SELECT o_orderkey AS id, o_orderdate AS ts, min(l_shipdate) AS shipped
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
 AND l_shipdate BETWEEN o_orderdate AND o_orderdate + INTERVAL 90 DAYS
GROUP BY o_orderkey, o_orderdate""",
    "timer_trigger": """
SELECT e.event_id, e.ts, e.ts + INTERVAL 25 MINUTES AS due, later.event_id AS triggered_by
FROM events e ASOF LEFT JOIN (SELECT min(event_id) AS event_id, ts FROM events GROUP BY ts) later
ON e.ts + INTERVAL 25 MINUTES <= later.ts""",
    "lookup_enrich": """
SELECT c_custkey, c_nationkey AS key, n_name AS result FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "codec_roundtrip": f"""
WITH {CLICKS}
SELECT customer, clicked_item, event_time, 'PreProcessing' AS status, id,
       concat_ws('|', customer, clicked_item, event_time, 'PreProcessing', id) AS line FROM clicks""",
    "status_filter": """
SELECT o_orderkey, o_orderstatus AS status, CASE WHEN o_orderstatus = 'F' THEN 'finished' ELSE 'other' END AS side
FROM orders""",
    "scored_requests": _wire(FEATURE_SCORING, BUSINESS_TOPIC),
    "finished_requests": _wire(PROCESSING_DONE, SCORED_TOPIC),
    "status_hops": f"""
WITH {CLICKS} SELECT customer, clicked_item, event_time, '{PROCESSING_DONE}' AS status, id FROM clicks""",
    "metric_counts": f"""
SELECT date_trunc('minute', ts) AS period_start, '{PREFIX}.' || event_type AS metric, count(*) AS n
FROM events GROUP BY ALL""",
    "metric_histogram": f"""
SELECT date_trunc('day', ts) AS period_start, '{PREFIX}.' || event_type AS metric, count(*) AS n,
       min({CENTS}) AS min_value, max({CENTS}) AS max_value, round(avg({CENTS}), 4) AS mean_value,
       round(stddev_samp({CENTS}), 4) AS stddev_value, {_QUANTILES}
FROM events GROUP BY 1, 2""",
    "iterate_increment": """
SELECT o_orderkey, o_orderkey + 1 AS v, (o_orderkey + 1) % 2 <> 0 AS left_loop FROM orders""",
    "iterate_countdown": """
WITH RECURSIVE rounds AS (
  SELECT o_orderkey, o_orderkey % 100 - 1 AS v FROM orders
  UNION ALL SELECT o_orderkey, v - 1 FROM rounds WHERE v > 0)
SELECT o_orderkey, v FROM rounds WHERE v <= 0""",
    "metric_value_histogram": HISTOGRAM.format(period="hour"),
    "popular_places_via_file": places(3, time="CASE WHEN is_start THEN start_time ELSE end_time END"),
    "text_roundtrip": f"SELECT event_id, user_id, event_type, {CENTS} AS cents FROM events",
    "nonempty_sources": "SELECT doc_id, source FROM documents WHERE length(source) > 0",
}
