"""Time series and metrics (A4, A7-A9, F11, K5 projection, T-W2 batch form).

Every metric is a keyed aggregate with map-side combine; no group is ever
collected into one row, one task or the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewell.functions.timefmt import epoch_to_timestamp


def to_points(df: DataFrame, io_col: str = "io_id", value_col: str = "value",
              epoch_col: str = "timestamp", measurement: str = "test") -> DataFrame:
    """K5 projection: (measurement, io_id, time, value) rows, tag = io_id."""
    return df.select(F.lit(measurement).alias("measurement"), F.col(io_col).alias("io_id"),
                     epoch_to_timestamp(epoch_col).alias("time"), F.col(value_col).alias("value"))


def group_series(points: DataFrame, key: str = "io_id", time_col: str = "time",
                 value_col: str = "value", exact_scale: int | None = None) -> DataFrame:
    """A4: per series the count, time span, first/last value and totals.

    A batch split by io_id ships each series' lists to the time-series store;
    the lists themselves are written by ``sinks.tables.write_points`` (one
    partitioned pass), so here only bounded summaries are computed.
    """
    v, t = F.col(value_col), F.col(time_col)
    # with ``exact_scale`` the total is a decimal sum (order-independent)
    total = (F.sum(v.cast(f"decimal(18,{exact_scale})")).cast("double") if exact_scale is not None
             else F.sum(v))
    return points.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_points"),
        F.min(t).alias("first_time"), F.max(t).alias("last_time"),
        F.min_by(v, t).alias("first_value"), F.max_by(v, t).alias("last_value"),
        F.min(v).alias("min_value"), F.max(v).alias("max_value"),
        total.alias("sum_value"))


def throughput(df: DataFrame, time_col: str, every: str = "1 hour",
               keys: Sequence[str] = ()) -> DataFrame:
    """Message count per tumbling window (and key)."""
    w = F.window(F.col(time_col), every)
    return (df.groupBy(*keys, w.alias("w")).agg(F.count(F.lit(1)).alias("n_messages"))
              .select(*keys, F.col("w.start").alias("window_start"),
                      F.col("w.end").alias("window_end"), "n_messages"))


def latency_stats(df: DataFrame, latency: Column | str, keys: Sequence[str] = (),
                  accuracy: int = 100_000) -> DataFrame:
    """Count, mean, extremes and percentiles of a latency column.

    Percentiles use the bounded-memory sketch (``percentile_approx``), never
    an exact per-group value list.
    """
    lat = F.col(latency) if isinstance(latency, str) else latency
    aggs = [F.count(lat).alias("n"), F.avg(lat).alias("avg_latency"),
            F.min(lat).alias("min_latency"), F.max(lat).alias("max_latency"),
            F.percentile_approx(lat, 0.5, accuracy).alias("p50_latency"),
            F.percentile_approx(lat, 0.9, accuracy).alias("p90_latency"),
            F.percentile_approx(lat, 0.99, accuracy).alias("p99_latency")]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def latency_histogram(df: DataFrame, latency: Column | str, bounds: Sequence[float],
                      keys: Sequence[str] = ()) -> DataFrame:
    """Cumulative bucket counts (le, count), with '+Inf' = all rows.

    One aggregate pass with one conditional count per bound, then the
    single summary row is unpivoted.
    """
    lat = F.col(latency) if isinstance(latency, str) else latency
    labels = [str(b) for b in bounds] + ["+Inf"]
    aggs = [F.count_if(lat <= F.lit(b)).alias(f"_le{i}") for i, b in enumerate(bounds)]
    aggs.append(F.count(lat).alias(f"_le{len(bounds)}"))
    wide = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    items = F.array(*[F.struct(F.lit(lbl).alias("le"), F.col(f"_le{i}").alias("count"))
                      for i, lbl in enumerate(labels)])
    return wide.select(*keys, F.explode(items).alias("_b")).select(*keys, "_b.le", "_b.count")


def fps_per_second(df: DataFrame, time_col: str, key: str = "device_id") -> DataFrame:
    """T-W2 (batch, window form): frames per device in each 1-second window."""
    w = F.window(F.col(time_col), "1 second")
    return (df.groupBy(key, w.alias("w")).agg(F.count(F.lit(1)).alias("fps"))
              .select(key, F.col("w.start").alias("second"), "fps"))


def retain_recent(df: DataFrame, time_col: str, ttl: str, key: str | None = None) -> DataFrame:
    """keep rows no older than ``ttl`` before the newest one.

    Global: the newest time is a scalar subquery (one small aggregate, no
    join). Per key: a keyed max joined back (AQE broadcasts it when small).
    """
    t = F.col(time_col)
    if key is None:
        newest = df.select(F.max(t)).scalar()
        return df.filter(t >= newest - F.expr(f"INTERVAL {ttl}"))
    mx = df.groupBy(key).agg(F.max(t).alias("_newest"))
    return (df.join(mx, key).filter(t >= F.col("_newest") - F.expr(f"INTERVAL {ttl}"))
              .drop("_newest"))


def removed_count(df: DataFrame, time_col: str, ttl: str) -> DataFrame:
    """how many rows retention removes (one-row frame)."""
    t = F.col(time_col)
    newest = df.select(F.max(t)).scalar()
    return df.agg(F.count_if(t < newest - F.expr(f"INTERVAL {ttl}")).alias("removed_count"))
