"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A benchmark item's patterns are its windows of ``window`` consecutive words (an
item of fewer words is one window). Patterns of one length are searched together:
a shift table over blocks of two words says how far the search may jump, a hash
bucket per final block holds the windows that can end there, and a direct
comparison of all words confirms an occurrence. Only words of the patterns have
ids; all others are id 0, whose blocks always give the largest jump.

Windows are searched in blocks of at most about ``block_windows`` (documented
parameter), each block broadcast to its own pass over all texts, so nothing that
grows with the benchmark is held at once. Null or wordless texts have no words and
no hits; wordless or null items have no windows. A repeated item_id counts once a document, whatever texts it has;
windows of items without an id hit but name no item; ids may be of any type and are
sorted as strings. Repeated rows give equal rows; an empty table gives no rows, an empty benchmark no
hits; only the named columns are read. Item ids that share one text are expanded by a join.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewell.llm.common import append_columns, fresh, map_batches, materialise, utf8

WINDOW = 10
BLOCK_WINDOWS = 100_000  # about a million entries of shift tables in a worker

# Lower-cases A-Z and turns every other ASCII byte that is no digit or letter into a
# space; bytes of non-ASCII characters are word bytes.
_FOLD = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32
              for b in range(256))

HITS = T.StructType([T.StructField("n_words", T.LongType()),
                     T.StructField("n_hit", T.LongType()),
                     T.StructField("spans", T.ArrayType(T.IntegerType())),
                     T.StructField("windows", T.ArrayType(T.LongType()))])


def words(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(items, windows): items (item_id, rep) maps every item to the digest of its word sequence; windows
    (rep, win, wid) are the distinct windows of each sequence."""
    schema = T.StructType([T.StructField("item_id", benchmark.schema["item_id"].dataType), T.StructField("seq", T.StringType())])

    def make():
        def fn(batch):
            return [{"item_id": batch.column(0), "seq": [b" ".join(words(t)).decode("utf-8") for t in utf8(batch.column(1))]}]
        return fn

    seqs = map_batches(benchmark.select("item_id", "text"), schema, make).where("seq != ''").withColumn("rep", F.md5(F.col("seq").cast("binary")))
    items = materialise(seqs.where("item_id is not null").select("item_id", "rep").distinct(), "bench")
    reps = seqs.select("rep", "seq").distinct()
    cut = F.split("seq", " ")
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - window + 1)),
                        lambda i: F.concat_ws(" ", F.slice("w", i, window)))
    windows = (reps.select("rep", cut.alias("w")).select("rep", F.explode(F.array_distinct(grams)).alias("win"))
               .withColumn("wid", F.xxhash64("win")))
    return items, materialise(windows, "bench")


class WuManber:
    """Shift and bucket tables of one block of windows (lists of words)."""

    def __init__(self, patterns: list[tuple[str, int]]):
        self.ids: dict[bytes, int] = {}
        by_length: dict[int, list] = defaultdict(list)
        for win, wid in patterns:
            seq = [self.ids.setdefault(w, len(self.ids) + 1) for w in win.encode("utf-8").split(b" ")]
            by_length[len(seq)].append((seq, wid))
        self.tables = []
        self.base = len(self.ids) + 1
        for m, group in sorted(by_length.items()):
            step = min(2, m)  # words in a block
            shift: dict[int, int] = {}
            bucket: dict[int, list] = defaultdict(list)
            for seq, wid in group:
                for end in range(step, m + 1):
                    key = self.key(seq, end - 1, step)
                    shift[key] = min(shift.get(key, m), m - end)
                bucket[self.key(seq, m - 1, step)].append((seq, wid))
            self.tables.append((m, step, m - step + 1, shift, dict(bucket)))

    def key(self, seq: list[int], last: int, step: int) -> int:
        return seq[last - 1] * self.base + seq[last] if step == 2 else seq[last]

    def search(self, text: bytes | None) -> tuple[int, int, list[int], list[int]]:
        """(words, hit words, merged word spans as start, end, start, ..., window ids)."""
        get = self.ids.get
        seq = [get(w, 0) for w in words(text)]
        found: set[int] = set()
        spans: list[tuple[int, int]] = []
        n, base = len(seq), self.base
        for m, step, far, shift, bucket in self.tables:
            if n < m:
                continue
            jump = shift.get
            pos = m - 1
            while pos < n:
                last = seq[pos]
                # a block that holds a word of no pattern gives the largest jump
                key = (seq[pos - 1] * base + last if step == 2 else last) if last else -1
                hop = jump(key, far)
                if hop:
                    pos += hop
                    continue
                start = pos - m + 1
                for cand, wid in bucket[key]:
                    if seq[start:pos + 1] == cand:
                        found.add(wid)
                        spans.append((start, pos + 1))
                pos += 1
        merged: list[int] = []
        hit = 0
        for s, e in sorted(spans):
            if merged and s <= merged[-1]:
                hit += max(0, e - merged[-1])
                merged[-1] = max(merged[-1], e)
            else:
                hit += e - s
                merged += [s, e]
        return n, hit, merged, sorted(found)


def _searcher(spark, windows: DataFrame, part: int, parts: int):
    mine = (windows.where(F.pmod(F.xxhash64("wid"), F.lit(parts)) == part)
            .select("win", "wid").distinct().collect())
    patterns = spark.sparkContext.broadcast([(r.win, r.wid) for r in mine])

    def make():
        wm = WuManber(patterns.value)

        def fn(column):
            got = [wm.search(t) for t in utf8(column)]
            n, hit, spans, wids = zip(*got, strict=True) if got else ((), (), (), ())
            return {"n_words": list(n), "n_hit": list(hit), "spans": list(spans), "windows": list(wids)}
        return fn

    return make


def _merge_spans(df: DataFrame, name: str) -> DataFrame:
    """Spans of several passes, as one merged list, with the hit words counted anew."""
    def make():
        def fn(column):
            n_words, spans = column.field("n_words").to_pylist(), column.field("spans").to_pylist()
            out = []
            for flat in spans:
                merged: list[int] = []
                for s, e in sorted(zip(flat[::2], flat[1::2], strict=True)):
                    if merged and s <= merged[-1]:
                        merged[-1] = max(merged[-1], e)
                    else:
                        merged += [s, e]
                out.append(merged)
            hit = [int(np.sum(m[1::2]) - np.sum(m[::2])) for m in out]
            return {"n_words": n_words, "n_hit": hit, "spans": out, "windows": column.field("windows")}
        return fn

    got = fresh("merged")
    return append_columns(df, name, HITS, got, make).drop(name).withColumnRenamed(got, name)


def find_windows(docs: DataFrame, windows: DataFrame, name: str, text: str = "text",
                 block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """``docs`` with a struct column ``name`` (n_words, n_hit, spans, windows). With one block
    of windows this is a single map over the rows; with more, the passes are joined
    on the row's whole content."""
    spark = docs.sparkSession
    parts = max(1, -(-windows.count() // block_windows))
    if parts == 1:
        return append_columns(docs, text, HITS, name, _searcher(spark, windows, 0, 1))
    one = materialise(docs.withColumn(key := fresh("row"), F.monotonically_increasing_id()), "decontaminate")
    runs = None
    for part in range(parts):
        run = materialise(append_columns(one.select(key, text), text, HITS, name,
                                         _searcher(spark, windows, part, parts)).select(key, f"{name}.*"), "decontaminate")
        runs = run if runs is None else runs.unionAll(run)
    both = (runs.groupBy(key).agg(F.max("n_words").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
                                  F.flatten(F.collect_list("spans")).alias("spans"),
                                  F.array_distinct(F.flatten(F.collect_list("windows"))).alias("windows"))
            .select(key, F.struct("n_words", "n_hit", "spans", "windows").alias(name)))
    return one.join(_merge_spans(both, name), key).drop(key)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_hit, spans (merged hit word
    ranges as start, end, ...), n_items, item_ids (sorted as strings), contaminated."""
    items, windows = benchmark_windows(benchmark, window)
    hits, row = fresh("hits"), "row"
    found = materialise(find_windows(docs.select("doc_id", "text"), windows, hits, block_windows=block_windows)
                        .select("doc_id", f"{hits}.*").withColumn(row, F.monotonically_increasing_id()), "decontaminate")
    listed = (found.where("size(windows) > 0").select(row, F.explode("windows").alias("wid"))
              .join(windows.select("wid", "rep"), "wid").select(row, "rep").distinct()
              .join(items, "rep").select(row, "item_id").distinct().groupBy(row)
              .agg(F.sort_array(F.collect_list(F.col("item_id").cast("string"))).alias("item_ids")))
    return (found.join(listed, row, "left")
            .select("doc_id", "n_words", "n_hit", "spans",
                    F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
                    F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
                    (F.col("n_hit") > 0).alias("contaminated")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in which no window occurs, with their columns as they were."""
    _, windows = benchmark_windows(benchmark, window)
    hits = fresh("hits")
    return find_windows(docs, windows, hits).where(F.col(hits)["n_hit"] == 0).drop(hits)
