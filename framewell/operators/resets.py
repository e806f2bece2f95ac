"""Exact data-driven frame-rate windows (T-W2, exact form).

Per device, frames are counted until one arrives more than ``period``
seconds after the last reset; that frame closes the window (it is counted in
it) and becomes the next reset. The reset chain is sequential, so it is
resolved in three distributed steps without putting a device in one task:

1. per (device, slice) - slices of equal depth from ``adaptive_slices`` -
   the chain is simulated from every frame that could be the slice's first
   reset (frames within ``period`` of the slice start, plus one), giving
   entry -> last reset of the slice;
2. per device, over those small slice summaries, the actual entry of each
   slice is chosen in time order;
3. per slice, the chain is replayed from its entry and the resets are
   emitted; window sizes are differences of global frame indices
   (``sequence_index``), the previous reset of a slice's first one coming
   from step 2.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewell.operators.ordering import adaptive_slices, sequence_index
from framewell.session import work_dir


def _chain(t: np.ndarray, start: int, period: float, stop: dict | None = None):
    """Resets from ``start`` inside one slice; returns the list of positions."""
    out = [start]
    i = start
    while True:
        j = int(np.searchsorted(t, t[i] + period, side="right"))
        if j >= len(t):
            return out
        if stop is not None and j in stop:
            return out + [j]
        out.append(j)
        i = j


def _candidates(t: np.ndarray, period: float) -> list[int]:
    k = int(np.searchsorted(t, t[0] + period, side="right"))
    return list(range(0, min(k + 1, len(t))))


def fps_resets(df: DataFrame, time_col: str = "event_datetime", key: str = "device_id",
               tie: str = "name", period: float = 1.0, min_rows: int = 50_000) -> DataFrame:
    """T-W2 exact: one row per window close (key, reset_time, fps).

    The sliced frames are checkpointed (reliable checkpoint in ``spark.checkpoint.dir``)
    because two passes read them.
    """
    work_dir(df.sparkSession)
    secs = F.unix_micros(F.col(time_col).cast("timestamp")).cast("double") / F.lit(1e6)
    base = df.select(key, tie, F.col(time_col).alias("_time"), secs.alias("_secs"))
    idx = sequence_index(base, key, ["_time", tie], out="_i", min_rows=min_rows)
    sliced = adaptive_slices(idx, [key], ["_time", tie], min_rows).select(key, "_b", "_i", "_secs").checkpoint()
    kt = sliced.schema[key].dataType.simpleString()

    def summarize(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_i")
        t, gi = pdf["_secs"].to_numpy(), pdf["_i"].to_numpy()
        rows, memo = [], {}
        for c in _candidates(t, period):
            chain = _chain(t, c, period, memo)
            last = chain[-1]
            exit_pos = memo.get(last, last)
            for p in chain:
                memo.setdefault(p, exit_pos)
            rows.append((gi[c], t[c], gi[exit_pos], t[exit_pos]))
        out = pd.DataFrame(rows, columns=["cand_i", "cand_t", "exit_i", "exit_t"])
        out.insert(0, "_b", pdf["_b"].iloc[0])
        out.insert(0, key, pdf[key].iloc[0])
        out["last_t"] = t[-1]
        return out

    summ_schema = f"`{key}` {kt}, _b long, cand_i long, cand_t double, exit_i long, exit_t double, last_t double"
    summary = sliced.groupBy(key, "_b").applyInPandas(summarize, summ_schema)

    def resolve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_b", "cand_t"])
        chosen, threshold, prev_exit = [], -np.inf, -1
        for b, g in pdf.groupby("_b", sort=True):
            if g["last_t"].iloc[0] <= threshold:
                continue
            hit = g[g["cand_t"] > threshold]
            if hit.empty:
                continue
            row = hit.iloc[0]
            chosen.append((b, int(row["cand_i"]), prev_exit))
            threshold, prev_exit = row["exit_t"] + period, int(row["exit_i"])
        out = pd.DataFrame(chosen, columns=["_b", "entry_i", "prev_i"])
        out.insert(0, key, pdf[key].iloc[0])
        return out

    entries = summary.groupBy(key).applyInPandas(
        resolve, f"`{key}` {kt}, _b long, entry_i long, prev_i long")

    def emit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_i")
        t, gi = pdf["_secs"].to_numpy(), pdf["_i"].to_numpy()
        start = int(np.searchsorted(gi, pdf["entry_i"].iloc[0]))
        pos = np.asarray(_chain(t, start, period))
        g = gi[pos]
        prev = np.concatenate([[pdf["prev_i"].iloc[0]], g[:-1]])
        fps = g - prev + (prev == 0)
        keep = prev >= 0   # the very first frame opens the first window
        return pd.DataFrame({key: pdf[key].iloc[0], "_secs": t[pos][keep], "fps": fps[keep]})

    with_entry = sliced.join(entries, [key, "_b"], "inner")
    resets = with_entry.groupBy(key, "_b").applyInPandas(emit, f"`{key}` {kt}, _secs double, fps long")
    return resets.select(
        key, F.timestamp_micros(F.round(F.col("_secs") * 1e6).cast("long")).alias("reset_time"), "fps")
