"""Order-dependent operators without single-task groups.

A key (a device, a name) may hold a third of all rows, so nothing here
partitions a window by the key alone:

* keep-last / latest use a keyed ``max_by`` aggregate, which combines
  map-side before the shuffle;
* sequence numbers and previous values are computed inside (key, slice)
  windows, and the slices are stitched with a per-slice summary (one row per
  key and slice), which is the only thing windowed by key. By default slices
  have equal depth, cut by rank (``adaptive_slices``); a fixed slice Column
  (e.g. ``date_trunc('hour', ts)``) may be passed instead.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewell.session import work_dir


def _list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _order_key(order: Sequence[str]) -> Column:
    cols = _list(order)
    return F.col(cols[0]) if len(cols) == 1 else F.struct(*[F.col(c) for c in cols])


def keep_last(df: DataFrame, key: str | Sequence[str] = "name",
              order: str | Sequence[str] = "event_id") -> DataFrame:
    """One row per key, the one last in ``order`` (arrival).

    Skipped when the key column is absent, as the batch writer does.
    """
    keys = _list(key)
    if not all(k in df.columns for k in keys):
        return df
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in rest])
    # a struct of the order columns is never null: null orders rank lowest
    order_key = F.struct(*[F.col(c) for c in _list(order)])
    out = df.groupBy(*keys).agg(F.max_by(packed, order_key).alias("_r"))
    return out.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns)


def keep_last_values(df: DataFrame, key: str | Sequence[str] = "name",
                     order: str | Sequence[str] = "event_id") -> DataFrame:
    """W1 for partial records: per key, each field's last non-null value.

    A null means "not supplied", so a later message that lacks a field
    does not erase an earlier value ($set semantics within one batch).
    One aggregate with one ``max_by`` per field (map-side combine).
    """
    keys = _list(key)
    ocols = _list(order)
    rest = [c for c in df.columns if c not in keys]
    o = _order_key(order)
    aggs = [F.max_by(F.col(c), o).alias(c) if c in ocols
            else F.max_by(F.col(c), F.when(F.col(c).isNotNull(), o)).alias(c) for c in rest]
    return df.groupBy(*keys).agg(*aggs).select(*df.columns)


def keep_first(df: DataFrame, key: str | Sequence[str], order: str | Sequence[str]) -> DataFrame:
    keys = _list(key)
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in rest])
    out = df.groupBy(*keys).agg(F.min_by(packed, _order_key(order)).alias("_r"))
    return out.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns)


def latest_per_key(df: DataFrame, key: str = "device_id",
                   order: Sequence[str] = ("event_datetime", "name")) -> DataFrame:
    """W2 for all keys: the newest row of each key."""
    return keep_last(df, key, order)


MIN_SLICE_ROWS = 100_000
RANGE_ROWS, RANGE_PARTS = 2_000_000, 20_000  # rows of a range partition, and the most of them


def adaptive_slices(df: DataFrame, key: Sequence[str], order: Sequence[str],
                    min_rows: int = MIN_SLICE_ROWS) -> DataFrame:
    """Add ``_b``: a slice of each key's rows, ascending with the order.

    While no key has more than ``min_rows`` rows, every key is one slice (a count per key,
    combined map-side, tells). Otherwise all rows are range-partitioned by key and order, sorted, and
    cut by rank into slices of at most max(min_rows, sqrt(rows of the largest key)) rows: the
    depth doesn't depend on how the times are spread, so a burst is cut as finely as a quiet
    hour, and a key that holds a third of all rows gets about its square root of slices.
    The rows are checkpointed once (reliable checkpoint), since their ranks follow from where they lie.
    """
    top = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("most"), F.sum("n").alias("total")).first()
    if top.most is None or top.most <= min_rows:
        return df.withColumn("_b", F.lit(0).cast("long"))
    spark = df.sparkSession
    work_dir(spark)
    depth = max(min_rows, math.isqrt(top.most))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(RANGE_PARTS, -(-top.total // RANGE_ROWS)))
    ranged = df.repartitionByRange(parts, *key, *order).sortWithinPartitions(*key, *order)
    # partition number and place in it: the id's upper and lower 33 bits
    at = F.monotonically_increasing_id()
    place = at.bitwiseAND((1 << 33) - 1)
    return ranged.withColumn("_b", at - place + F.floor(place / depth)).checkpoint()


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where null equals null; the keys appear once."""
    other = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(other, same, how).drop(*[f"_r_{k}" for k in keys])


def _sliced(df: DataFrame, key: Sequence[str], order: Sequence[str], bucket: Column | None,
            min_rows: int = MIN_SLICE_ROWS):
    d = df.withColumn("_b", bucket) if bucket is not None else adaptive_slices(df, key, order, min_rows)
    w = Window.partitionBy(*key, "_b").orderBy(*[F.col(c) for c in order])
    return d, w


def sequence_index(df: DataFrame, key: str | Sequence[str] = "device_id",
                   order: str | Sequence[str] = ("event_datetime", "name"),
                   bucket: Column | None = None, out: str = "frame_index",
                   min_rows: int = MIN_SLICE_ROWS) -> DataFrame:
    """0-based position of each row in its key's ordered sequence.

    Row numbers inside (key, bucket) plus the running count of earlier
    buckets of the same key; ``order`` must be unique within a key.
    """
    keys, order = _list(key), _list(order)
    d, w = _sliced(df, keys, order, bucket, min_rows)
    whole = Window.partitionBy(*keys, "_b")
    d = d.withColumn("_local", F.row_number().over(w) - 1).withColumn("_n", F.count(F.lit(1)).over(whole))
    # slice sizes from the same window pass: the big side is shuffled once
    counts = d.select(*keys, "_b", "_n").distinct()
    wk = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_b", F.coalesce(F.sum("_n").over(wk), F.lit(0)).alias("_off"))
    return (_join_null_safe(d, offsets, [*keys, "_b"])
             .withColumn(out, F.col("_local") + F.col("_off"))
             .drop("_b", "_local", "_off", "_n"))


def previous_value(df: DataFrame, value: str, key: str | Sequence[str] = "device_id",
                   order: str | Sequence[str] = ("event_datetime", "name"),
                   bucket: Column | None = None, out: str = "prev_value",
                   min_rows: int = MIN_SLICE_ROWS) -> DataFrame:
    """Value of the previous row of the same key (null for the first row)."""
    keys, order = _list(key), _list(order)
    d, w = _sliced(df, keys, order, bucket, min_rows)
    full = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    d = (d.withColumn("_first", F.row_number().over(w) == 1)
          .withColumn("_lag", F.lag(value).over(w))
          .withColumn("_slice_last", F.last(value).over(full)))
    # the last value of each slice from the same window pass (shared shuffle)
    last = d.select(*keys, "_b", F.col("_slice_last").alias("_last")).distinct()
    wk = Window.partitionBy(*keys).orderBy("_b")
    carry = last.select(*keys, "_b", F.lag("_last").over(wk).alias("_carry"))
    return (_join_null_safe(d, carry, [*keys, "_b"])
             .withColumn(out, F.when(F.col("_first"), F.col("_carry")).otherwise(F.col("_lag")))
             .drop("_b", "_first", "_lag", "_carry", "_slice_last"))


def emit_on_change(df: DataFrame, value: str = "img_path", key: str | Sequence[str] = "device_id",
                   order: str | Sequence[str] = ("event_datetime", "name"),
                   bucket: Column | None = None, min_rows: int = MIN_SLICE_ROWS) -> DataFrame:
    """Keep rows whose value differs from the previous row of the key."""
    prev = previous_value(df, value, key, order, bucket, out="_prev", min_rows=min_rows)
    return prev.filter(~F.col(value).eqNullSafe(F.col("_prev"))).drop("_prev")


def count_batches(df: DataFrame, max_size: int, key: str | Sequence[str] = "device_id",
                  order: str | Sequence[str] = ("event_datetime", "name"),
                  bucket: Column | None = None, min_rows: int = MIN_SLICE_ROWS) -> DataFrame:
    """Number rows into consecutive batches of at most ``max_size`` per key."""
    idx = sequence_index(df, key, order, bucket, out="_i", min_rows=min_rows)
    return idx.withColumn("batch_no", F.floor(F.col("_i") / F.lit(max_size))).drop("_i")


def sort_columns(spec: Sequence[str] | None, tie_break: str | Sequence[str] | None = None) -> list[Column]:
    """O1: '-field' is descending; a unique key is appended for determinism."""
    cols = []
    seen = set()
    for s in spec or []:
        name = s[1:] if s.startswith("-") else s
        seen.add(name)
        cols.append(F.col(name).desc() if s.startswith("-") else F.col(name).asc())
    for t in _list(tie_break) if tie_break else []:
        if t not in seen:
            cols.append(F.col(t).asc())
    return cols


def paginate(df: DataFrame, sort: Sequence[str] | None = None, page_size: int | None = None,
             page_num: int | None = None, tie_break: str | Sequence[str] | None = None) -> DataFrame:
    """O2: 1-based page of the sorted rows; no size -> all rows.

    Shallow pages plan as a bounded top-k per partition; for deep pages use
    ``keyset_page``.
    """
    cols = sort_columns(sort, tie_break)
    out = df.orderBy(*cols) if cols else df
    if page_size:
        page = max(1, page_num or 1)
        out = out.offset((page - 1) * page_size).limit(page_size)
    return out


def keyset_page(df: DataFrame, sort: Sequence[str], after: Sequence | None, page_size: int) -> DataFrame:
    """O2 for deep pages: rows strictly after the last seen sort key."""
    cols = sort_columns(sort)
    if after is not None:
        cond = None
        for i, s in enumerate(sort):
            name = s.lstrip("-")
            gt = (F.col(name) < F.lit(after[i])) if s.startswith("-") else (F.col(name) > F.lit(after[i]))
            eqs = [F.col(p.lstrip("-")) == F.lit(after[j]) for j, p in enumerate(sort[:i])]
            term = gt
            for e in eqs:
                term = term & e
            cond = term if cond is None else (cond | term)
        df = df.filter(cond)
    return df.orderBy(*cols).limit(page_size)


def page_count(total: Column, page_size: int) -> Column:
    """max(1, ceil(total / size))."""
    return F.greatest(F.lit(1), F.ceil(total / F.lit(page_size)))
