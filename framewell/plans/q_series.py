"""Registered queries: series, metrics, retention, dates, config entries, scoring."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewell.functions.codec import decode_json
from framewell.functions.timefmt import (DISPLAY_TIME_PATTERN, OBJECT_DATE_PATTERN, OBJECT_TIME_PATTERN,
                                         as_ntz, parse_event_time, parse_request_date, shifted_epoch)
from framewell.operators import config, resets, series
from framewell.plans import fixtures as fx
from framewell.plans.registry import query
from framewell.plans.sqlparts import META, POINTS, with_


@query("group_series", with_(POINTS) + """
SELECT io_id, count(*) AS n_points, min(time) AS first_time, max(time) AS last_time,
       arg_min(value, time) AS first_value, arg_max(value, time) AS last_value,
       min(value) AS min_value, max(value) AS max_value,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS sum_value
FROM points GROUP BY io_id""")
def q_group_series(spark, d):
    """Per-series summary of a batch of points."""
    p = series.to_points(fx.points(spark, d))
    g = series.group_series(p, exact_scale=2)
    return g.select("io_id", "n_points", as_ntz("first_time").alias("first_time"),
                    as_ntz("last_time").alias("last_time"), "first_value", "last_value",
                    "min_value", "max_value", "sum_value")


@query("throughput", with_(META) + """
SELECT device_id, date_trunc('hour', event_datetime) AS window_start,
       date_trunc('hour', event_datetime) + INTERVAL 1 HOUR AS window_end, count(*) AS n_messages
FROM meta GROUP BY device_id, date_trunc('hour', event_datetime)""")
def q_throughput(spark, d):
    """Frames per device per hour."""
    return series.throughput(fx.frame_metadata(spark, d), "event_datetime", "1 hour", ["device_id"])


@query("fps_per_second", with_(META) + """
SELECT device_id, date_trunc('second', event_datetime) AS second, count(*) AS fps
FROM meta GROUP BY device_id, date_trunc('second', event_datetime)""")
def q_fps_per_second(spark, d):
    """T-W2 (window form): frames per device per second."""
    return series.fps_per_second(fx.frame_metadata(spark, d), "event_datetime", "device_id")


_LAT = """
lat AS (SELECT o.o_orderpriority, date_diff('day', o.o_orderdate, l.l_shipdate) AS latency_days
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


def _latency(spark, d):
    li = fx.table(spark, d, "lineitem").select("l_orderkey", "l_shipdate")
    o = fx.table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select("o_orderpriority",
                    F.datediff(F.col("l_shipdate"), F.col("o_orderdate")).cast("bigint").alias("latency_days"))


@query("latency_stats", with_(_LAT) + """
SELECT o_orderpriority, count(latency_days) AS n, round(avg(latency_days), 6) AS avg_latency,
       min(latency_days) AS min_latency, max(latency_days) AS max_latency,
       quantile_disc(latency_days, 0.5) AS p50_latency, quantile_disc(latency_days, 0.9) AS p90_latency,
       quantile_disc(latency_days, 0.99) AS p99_latency
FROM lat GROUP BY o_orderpriority""")
def q_latency_stats(spark, d):
    """Order-to-ship latency (days) per priority: mean, extremes, percentiles."""
    s = series.latency_stats(_latency(spark, d), "latency_days", ["o_orderpriority"])
    return s.withColumn("avg_latency", F.round("avg_latency", 6))


@query("latency_histogram", with_(_LAT) + """
SELECT le, count FROM (
  SELECT '30' AS le, CAST(count_if(latency_days <= 30) AS BIGINT) AS count, 1 AS o FROM lat
  UNION ALL SELECT '60', CAST(count_if(latency_days <= 60) AS BIGINT), 2 FROM lat
  UNION ALL SELECT '90', CAST(count_if(latency_days <= 90) AS BIGINT), 3 FROM lat
  UNION ALL SELECT '120', CAST(count_if(latency_days <= 120) AS BIGINT), 4 FROM lat
  UNION ALL SELECT '+Inf', count(latency_days), 5 FROM lat)""")
def q_latency_histogram(spark, d):
    """Cumulative latency buckets."""
    return series.latency_histogram(_latency(spark, d), "latency_days", [30, 60, 90, 120])


@query("retain_recent", """
SELECT event_id, user_id, ts FROM events
WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 1 DAY""")
def q_retain_recent(spark, d):
    """F11/T-W6: entries no older than one day before the newest."""
    ev = fx.table(spark, d, "events").select("event_id", "user_id", "ts")
    return series.retain_recent(ev, "ts", "1 day")


@query("parse_dates", """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 3 THEN o_orderdate END AS parsed,
       o_orderkey % 4 <> 3 AS ok,
       CASE WHEN o_orderkey % 4 <> 3 THEN strftime(o_orderdate, '%Y%m%d_%H%M%S') END AS object_time,
       CASE WHEN o_orderkey % 4 <> 3 THEN strftime(o_orderdate, '%Y_%m_%d') END AS object_date,
       CASE WHEN o_orderkey % 4 <> 3 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS display,
       CASE WHEN o_orderkey % 4 <> 3 THEN CAST(epoch(o_orderdate) AS BIGINT) + 9 * 3600 END AS playback_epoch
FROM orders""")
def q_parse_dates(spark, d):
    """Request date text in three formats; the rest rejected."""
    od = fx.order_dates(spark, d)
    p = parse_request_date(F.col("date_text"))
    return od.select("o_orderkey", as_ntz(p).alias("parsed"), p.isNotNull().alias("ok"),
                     F.date_format(p, OBJECT_TIME_PATTERN).alias("object_time"),
                     F.date_format(p, OBJECT_DATE_PATTERN).alias("object_date"),
                     F.date_format(p, DISPLAY_TIME_PATTERN).alias("display"),
                     shifted_epoch(p, 9).alias("playback_epoch"))


ARCHIVE_SCHEMA = T.StructType([
    T.StructField("event_datetime_str", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("category", T.StringType()), T.StructField("value", T.DoubleType())])


@query("parse_archive", """
SELECT event_id AS offset,
       'cam' || CAST(user_id % 8 AS VARCHAR) || '_' || json_extract_string(props, '$.k') || '.jpg' AS name,
       event_type AS category, value,
       CASE WHEN event_id % 40 <> 0 THEN ts END AS event_datetime, event_id % 40 <> 0 AS valid
FROM events""")
def q_parse_archive(spark, d):
    """Archive messages; the time text is popped and parsed."""
    a = fx.archive_events(spark, d)
    m = a.select("offset", decode_json("value", ARCHIVE_SCHEMA).alias("m")).select("offset", "m.*")
    t = parse_event_time("event_datetime_str")
    return m.select("offset", "name", "category", "value", as_ntz(t).alias("event_datetime"),
                    t.isNotNull().alias("valid"))


@query("flatten_config", """
SELECT event_id, k AS key, json_extract_string(props, '$.' || k) AS value,
       CASE json_type(props, '$.' || k) WHEN 'UBIGINT' THEN 'int' WHEN 'BIGINT' THEN 'int'
            WHEN 'DOUBLE' THEN 'float' WHEN 'VARCHAR' THEN 'str' WHEN 'BOOLEAN' THEN 'bool'
            WHEN 'ARRAY' THEN 'list' WHEN 'NULL' THEN 'NoneType' ELSE 'dict' END AS type
FROM events, unnest(json_keys(props)) AS t(k)""")
def q_flatten_config(spark, d):
    """Each event's nested properties as (key, value, type) entries."""
    ev = fx.table(spark, d, "events").select("event_id", "props")
    return config.flatten_config(ev, "props", ["event_id"])


@query("fps_resets", with_(META) + """,
m AS (SELECT device_id, event_datetime,
             row_number() OVER (PARTITION BY device_id ORDER BY event_datetime, name) AS rn FROM meta),
lim AS (SELECT device_id, rn, event_datetime + INTERVAL 1 SECOND AS lim FROM m),
nxt AS (SELECT l.device_id, l.rn, n.rn AS next_rn
        FROM lim l ASOF LEFT JOIN m n ON l.device_id = n.device_id AND l.lim < n.event_datetime),
chain AS (SELECT * FROM (WITH RECURSIVE c(device_id, rn, next_rn) AS (
            SELECT device_id, rn, next_rn FROM nxt WHERE rn = 1
            UNION ALL
            SELECT x.device_id, x.rn, x.next_rn FROM c JOIN nxt x ON x.device_id = c.device_id AND x.rn = c.next_rn)
          SELECT * FROM c)),
r AS (SELECT device_id, rn, lag(rn) OVER (PARTITION BY device_id ORDER BY rn) AS prev_rn FROM chain)
SELECT r.device_id, m.event_datetime AS reset_time,
       CASE WHEN r.prev_rn = 1 THEN r.rn ELSE r.rn - r.prev_rn END AS fps
FROM r JOIN m ON m.device_id = r.device_id AND m.rn = r.rn
WHERE r.prev_rn IS NOT NULL""")
def q_fps_resets(spark, d):
    """T-W2 exact: a window closes at the first frame more than 1 s after the
    last reset; resolved per time slice, never per whole device."""
    m = fx.frame_metadata(spark, d).select("device_id", "name", "event_datetime")
    out = resets.fps_resets(m, "event_datetime", "device_id", "name", 1.0, min_rows=500)  # so small that devices are cut
    return out.select("device_id", as_ntz("reset_time").alias("reset_time"), "fps")


@query("retain_recent_per_user", """
SELECT e.event_id, e.user_id, e.ts FROM events e
JOIN (SELECT user_id, max(ts) AS newest FROM events GROUP BY user_id) m USING (user_id)
WHERE e.ts >= m.newest - INTERVAL 1 DAY""")
def q_retain_recent_per_user(spark, d):
    """F11 per stream: each user's entries no older than one day before that
    user's newest (keyed max joined back)."""
    ev = fx.table(spark, d, "events").select("event_id", "user_id", "ts")
    return series.retain_recent(ev, "ts", "1 day", key="user_id").select("event_id", "user_id", "ts")


@query("retention_removed", """
SELECT CAST(count_if(ts < (SELECT max(ts) FROM events) - INTERVAL 1 DAY) AS BIGINT) AS removed_count FROM events""")
def q_retention_removed(spark, d):
    """how many entries one trim removes."""
    return series.removed_count(fx.table(spark, d, "events"), "ts", "1 day")
