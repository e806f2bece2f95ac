"""N-gram Jaccard join by a prefix tree of globally ordered n-gram sets.

Two texts link when ``100 * intersection >= percent * union`` of their sets of distinct
``n``-word shingles. The steps, all exact (64-bit shingle hashes stand for shingles):

1. One pass hashes every text's shingle set to a digest (equal sets are one class, its
   head is the smallest doc_id) and counts all shingles in a sketch of fixed width.
   The sketch gives a global order: rare cells first, ties by hash.
2. Later passes cut the shingles anew from the texts they need instead of storing sets
   larger than the text. Which texts those are is told by a bitmap of fixed size
   over the wanted ids; an id that shares a cell with one is read in vain, nothing more.
3. Two sets that link share a shingle among the first ``size - ceil(t * size) + 1`` of
   this order. Shingle lists of these prefixes that have two classes or more make the
   candidates: first every member against the smallest member of its list, so that a group
   of g near copies costs about g comparisons and not g squared; then, only for lists
   that still join different components, all pairs across these components. A pair
   whose prefixes share too few shingles for any overlap of the rest is dropped.
4. Candidates of one probe are verified together: their sets, commonest shingle
   first, are walked as a trie (sorted order, each set sharing the overlap counted
   along its common prefix with the one before), and a subtree ends as soon as
   the remaining lengths cannot reach the needed overlap.
5. Verified links give components by min-label rounds.

Null and wordless texts have an empty set and link with nothing (component = own
id); repeated rows are one class. A null doc_id links with nothing and has a null
component; doc_id is a whole number. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from framewell.llm.common import SMALL_BATCH_BYTES, arrow_column, bound_batches, connected_components, fresh, map_batches, materialise

N, PERCENT = 5, 80
SKETCH_BITS = 18  # counters of the ordering sketch: 2^18, whatever the input
BITMAP_BITS = 26  # cells of an id bitmap: 2^26 bits = 8 MB, whatever the input
STRIDE, LOOK = 128, 12  # trie nodes walked between two looks at the bound, for one probe and for many
PAIR_LIST = 96  # lists of more members are joined in trie blocks, not as pairs of rows
CHUNK = 400  # candidate sets of one probe that are walked in one trie
CHUNK_SHINGLES = 200_000  # shingles of the sets that are walked in one trie, but for a longer single set
PIECE_BYTES = 1 << 18  # bytes hashed at once

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3],
                dtype=np.uint64)  # fixed odd multipliers, one per place in a shingle

SCAN = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_shingles", T.LongType()),
                     T.StructField("digest", T.BinaryType()), T.StructField("cells", T.ArrayType(T.IntegerType())),
                     T.StructField("counts", T.ArrayType(T.LongType()))])
PAIR = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _avalanche(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _byte_values() -> np.ndarray:
    """A 64-bit value for each byte, the same for A-Z as for a-z; 0 for white space."""
    v = _avalanche((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _MIX[0])
    v[65:91] = v[97:123]
    v[9:14] = v[32] = 0
    return v


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts laid end to end in ``data``, and where each text's words begin
    in them (one entry more than texts). Works through pieces of about PIECE_BYTES, cut at
    a text's end or at white space."""
    values = _byte_values()
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets[:-1]] = True
    hashes, starts, at = [], [], 0
    while at < len(data):
        end = min(len(data), at + PIECE_BYTES)
        while end < len(data) and not (first[end] or data[end] == 32 or 9 <= data[end] <= 13):
            end += 1
        v = values[data[at:end]]
        inside = v != 0
        begin = inside.copy()
        begin[1:] &= ~inside[:-1] | first[at + 1:end]
        where = np.flatnonzero(begin)
        if len(where):
            place = np.arange(len(v)) - np.repeat(np.append(0, where), np.diff(np.concatenate([[0], where, [len(v)]])))
            hashes.append(_avalanche(np.add.reduceat(v * _power(place), where)))
            starts.append(where + at)
        at = end
    if not hashes:
        return np.empty(0, dtype=np.uint64), np.zeros(len(offsets), dtype=np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offsets)


def _power(place: np.ndarray) -> np.ndarray:
    """The odd multiplier of a byte at each place in its word."""
    table = np.cumprod(np.full(int(place.max()) + 1, _MIX[1], dtype=np.uint64))
    return table[place]


def batch_shingles(column: pa.Array, n: int) -> list[np.ndarray]:
    """For each text the sorted array of the distinct 64-bit hashes of its shingles: ``n`` words
    each, or all words of a text that has fewer; none for null or wordless texts."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[offsets[0]:offsets[-1]] if raw is not None and len(offsets) else np.empty(0, np.uint8)
    words, begin = word_hashes(data, offsets - offsets[0])
    full = np.zeros(max(0, len(words) - n + 1), dtype=np.uint64)
    for k in range(n):
        full += _avalanche(words[k:len(full) + k] + _MIX[k % 8]) * _MIX[k % 8]
    full = _avalanche(full)
    out = []
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
        if b - a >= n:
            s = np.sort(full[a:b - n + 1])
            keep = np.ones(len(s), dtype=bool)
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            out.append(s[keep])
        elif b > a:
            few = [hashlib.blake2b(words[a:b].tobytes(), digest_size=8).digest()]
            out.append(np.frombuffer(few[0], dtype=np.uint64))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def scan(docs: DataFrame, n: int = N) -> DataFrame:
    """(doc_id, n_shingles, digest) of every row, and one row per task with its sketch counts
    (cells, counts)."""
    width = 1 << SKETCH_BITS
    arrow = to_arrow_schema(SCAN)

    def run(batches):
        total = np.zeros(width, dtype=np.int64)
        for batch in batches:
            sets = batch_shingles(batch.column(1), n)
            cells = np.concatenate([s >> np.uint64(64 - SKETCH_BITS) for s in sets] or [np.empty(0, np.uint64)])
            total += np.bincount(cells.astype(np.int64), minlength=width)
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            none = [None] * len(sets)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(digests, pa.binary()), pa.array(none, arrow.field(3).type), pa.array(none, arrow.field(4).type)],
                schema=arrow)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([None], pa.int64()), pa.array([None], pa.int64()), pa.array([None], pa.binary()),
             pa.array([at.astype(np.int32)], arrow.field(3).type), pa.array([total[at]], arrow.field(4).type)], schema=arrow)

    return docs.select("doc_id", "text").mapInArrow(run, SCAN)


def order_levels(scanned: DataFrame) -> np.ndarray:
    """A coarse level for each of the 2^SKETCH_BITS sketch cells: 0 for a usual count, one more for
    each doubling. Per-task counts are summed by Spark; the result has one size for any input."""
    rows = (scanned.where("cells is not null").select(F.inline(F.arrays_zip("cells", "counts")))
            .groupBy("cells").agg(F.sum("counts").alias("n")).toArrow())
    counts = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
    counts[rows.column("cells").to_numpy()] = rows.column("n").to_numpy()
    mean = float(np.mean(counts))
    unit = 4 * np.sqrt(mean) + 4  # what chance collisions of rare shingles hardly reach
    return np.maximum(0, np.ceil(np.log2(np.maximum(counts - mean, 1) / unit))).astype(np.uint8)


def id_bitmap(ids: DataFrame, *salt: int) -> np.ndarray:
    """A bitmap of 2^BITMAP_BITS cells over the hashes of the one column of ``ids``."""
    cell = F.shiftrightunsigned(F.xxhash64(F.col(ids.columns[0]), *map(F.lit, salt)), 64 - BITMAP_BITS)
    rows = (ids.select(cell.alias("cell")).where("cell is not null")
            .select(F.shiftright("cell", 6).alias("word"), F.expr("shiftleft(1L, cast(cell & 63 as int))").alias("bit"))
            .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow())
    out = np.zeros(1 << (BITMAP_BITS - 6), dtype=np.int64)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return out.view(np.uint64)


def _is_set(bitmap: np.ndarray, hashes: pa.Array) -> pa.Array:
    cell = hashes.to_numpy().view(np.uint64) >> np.uint64(64 - BITMAP_BITS)
    return pa.array((bitmap[(cell >> np.uint64(6)).astype(np.int64)] >> (cell & np.uint64(63))) & np.uint64(1) == 1)


def _in_bitmap(bitmap: np.ndarray, docs: DataFrame, *salt: int) -> Column:
    """Whether the cell of a row's doc_id is set."""
    bits = docs.sparkSession.sparkContext.broadcast(bitmap)
    return arrow_column(T.BooleanType(), lambda: lambda hashes: _is_set(bits.value, hashes),
                        F.xxhash64(F.col("doc_id").cast("long"), *map(F.lit, salt)))


def _map_wanted(docs: DataFrame, ids: DataFrame, schema: T.StructType, make) -> DataFrame:
    """``map_batches`` over (id, text) of the rows of ``docs`` whose id's cell is set in a bitmap of ``ids``: those in
    ``ids`` and few more. The test is part of the same Python stage, so a task needs one worker."""
    bits = docs.sparkSession.sparkContext.broadcast(id_bitmap(ids))

    def make_some():
        fn = make()

        def some(batch):
            keep = _is_set(bits.value, batch.column(2))
            rows = pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()).filter(keep), batch.column(1).filter(keep)], names=["id", "text"])
            return fn(rows) if len(rows) else ()
        return some

    rows = docs.where("doc_id is not null and text is not null").select("doc_id", "text", F.xxhash64(F.col("doc_id").cast("long")))
    return map_batches(rows, schema, make_some)


def _rarest_first(s: np.ndarray, levels: np.ndarray) -> np.ndarray:
    lv = levels[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
    return s[np.argsort(lv, kind="stable")] if lv.any() else s


def prefix_length(size: int, percent: int) -> int:
    """Shingles of which a linking set must share one: size - ceil(t * size) + 1."""
    return size - -(-percent * size // 100) + 1


def prefixes(docs: DataFrame, ids: DataFrame, levels: np.ndarray, n: int, percent: int) -> DataFrame:
    """(token, id, size): the rarest shingles of every text of ``ids``, of which a link cannot miss all."""
    schema = T.StructType([T.StructField("token", T.LongType()), T.StructField("id", T.LongType()),
                           T.StructField("size", T.IntegerType())])
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def make():
        lv = shared.value

        def fn(batch):
            sets = batch_shingles(batch.column(1), n)
            toks = [_rarest_first(s, lv)[:prefix_length(len(s), percent)] if len(s) else s for s in sets]
            lens = [len(t) for t in toks]
            if sum(lens):
                yield {"token": pa.array(np.concatenate(toks).view(np.int64)),
                       "id": pa.array(np.repeat(batch.column(0).to_numpy(), lens)),
                       "size": pa.array(np.repeat(np.array([len(s) for s in sets], dtype=np.int32), lens))}
        return fn

    return _map_wanted(docs, ids, schema, make)


def shingle_sets(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """(id, shingles) of the texts of ``ids``, and of few more."""
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("shingles", T.BinaryType())])

    def make():
        return lambda batch: [{"id": batch.column(0), "shingles": [s.tobytes() for s in batch_shingles(batch.column(1), n)]}]

    return _map_wanted(docs, ids, schema, make)


def trie_matches(probe: np.ndarray, sets: list[np.ndarray], levels: np.ndarray, percent: int) -> list[int]:
    """Indexes of the ``sets`` that link with ``probe``. The sets, each in the global order
    (commonest first), are sorted, which lists the leaves of their trie in depth-first
    order; ``path`` holds the overlap counted at every node of the branch walked last."""
    ordered = [_rarest_first(s, levels)[::-1] for s in sets]
    keys = [o.astype(">u8").tobytes() for o in ordered]
    n = len(probe)
    out = []
    branch, path = np.empty(0, dtype=np.uint64), np.zeros(1, dtype=np.int64)
    for i in sorted(range(len(ordered)), key=keys.__getitem__):
        o = ordered[i]
        size = len(o)
        need = -(-percent * (n + size) // (100 + percent))
        k = min(size, len(branch))
        differ = np.flatnonzero(o[:k] != branch[:k])
        depth = int(differ[0]) if len(differ) else k
        branch, path = branch[:depth], path[:depth + 1]
        # what is left of the set and of the probe below a node bounds the overlap
        while depth < size and path[-1] + min(size - depth, n - path[-1]) >= need:
            step = o[depth:depth + STRIDE]
            hit = probe[np.minimum(np.searchsorted(probe, step), n - 1)] == step
            path = np.concatenate([path, path[-1] + np.cumsum(hit)])
            branch = o[:depth + len(step)]
            depth += len(step)
        if depth == size and path[-1] >= need:
            out.append(i)
    return out


def _parts(count: Column, shingles: Column) -> Column:
    """How many parts to deal sets to, so that each has about CHUNK sets and CHUNK_SHINGLES shingles at most."""
    return (F.floor(F.greatest(count / CHUNK, shingles / CHUNK_SHINGLES)) + 1).cast("int")


def verify(pairs: DataFrame, docs: DataFrame, levels: np.ndarray, n: int, percent: int) -> DataFrame:
    """The pairs of ids whose texts link, of ``pairs`` (a, b, size of b's set). Grouped by probe ``a`` in chunks
    of bounded sets and shingles, so the candidates of one probe never meet in one task as a whole."""
    degree = pairs.groupBy("a").agg(_parts(F.count("*"), F.sum("sb")).alias("chunks"))
    dealt = materialise(pairs.join(degree, "a").withColumn("chunk", F.pmod(F.xxhash64("b"), F.col("chunks")))
                        .select("a", "b", "chunk"), "jaccard")
    sets = shingle_sets(docs, dealt.select(F.explode(F.array("a", "b")).alias("id")), n)
    # the probe stands in its group as the row whose id is a
    members = dealt.select("a", "chunk", F.col("b").alias("id")).unionAll(dealt.select("a", "chunk", F.col("a").alias("id")).distinct())
    shared = pairs.sparkSession.sparkContext.broadcast(levels)

    def walk(group: pa.Table) -> pa.Table:
        a, ids = group.column("a")[0].as_py(), group.column("id").to_pylist()
        sets = [np.frombuffer(x, dtype=np.uint64) for x in group.column("shingles").to_pylist()]
        others = [i for i, x in enumerate(ids) if x != a]
        got = set()
        for probe in (s for x, s in zip(ids, sets, strict=True) if x == a):  # one, unless rows share a doc_id
            got.update(ids[others[i]] for i in trie_matches(probe, [sets[i] for i in others], shared.value, percent))
        return pa.table({"a": pa.array([a] * len(got), pa.int64()), "b": pa.array(sorted(got), pa.int64())})

    return materialise(members.hint("merge").join(sets, "id").groupBy("a", "chunk").applyInArrow(walk, PAIR), "jaccard")


def _reachable(x: str, y: str, shared: str, percent: int):
    """Whether sets of sizes x and y can link that share ``shared`` shingles of their prefixes.
    Common shingles are in both prefixes, or after the end of the prefix that ends first."""
    rest = F.ceil(F.greatest(x, y) * percent / 100) - 1
    need = F.ceil((F.col(x) + F.col(y)) * percent / (100 + percent))
    return (F.least(x, y) * 100 >= F.greatest(x, y) * percent) & (F.expr(shared) + rest >= need)


def link_heads(docs: DataFrame, heads: DataFrame, levels: np.ndarray, n: int, percent: int) -> DataFrame:
    """(node, component) of every id of ``heads`` (one column) whose text links with another's."""
    # dealt by token once: the ends of every list and the join with them reuse that exchange
    post = prefixes(docs, heads, levels, n, percent).repartition("token")
    ends = (post.groupBy("token").agg(F.min("id").alias("low"), F.max("id").alias("high"),
                                      F.min_by("size", "id").alias("low_size"), F.max_by("size", "id").alias("high_size"))
            .where("low != high"))
    lists = materialise(post.join(ends, "token"), "jaccard")

    # round 1: every member of a list against both its ends
    stars = materialise(
        lists.select("id", "size", F.explode(F.array(F.struct(F.col("low").alias("a"), F.col("low_size").alias("sa")),
                                                     F.struct(F.col("high").alias("a"), F.col("high_size").alias("sa")))).alias("end"))
        .where("id != end.a").groupBy("end.a", F.col("id").alias("b"))
        .agg(F.first("end.sa").alias("sa"), F.first("size").alias("sb"), F.count("*").alias("shared"))
        .where(_reachable("sa", "sb", "shared", percent)).select("a", "b", "sb"), "jaccard")
    links = verify(stars, docs, levels, n, percent)
    first = materialise(connected_components(links), "jaccard")

    # round 2: lists that still join different components, all pairs across these. Linking sizes are
    # in one size class or in neighbours, so a list falls apart into lists of two classes each,
    # the members of the lower class (low) meeting the upper one's only.
    band = F.floor(F.log("size") / -math.log(percent / 100)).cast("int") if percent < 100 else F.col("size")
    named = (lists.join(first.withColumnRenamed("node", "id"), "id", "left")
             .select("token", "id", "size", F.coalesce("component", "id").alias("comp"), band.alias("band"))
             .withColumn("step", F.explode(F.array(F.lit(0), F.lit(1))))
             .select("token", (F.col("band") + F.col("step")).alias("band"), "id", "size", "comp", (F.col("step") == 1).alias("low"))
             .repartition("token", "band"))
    mixed = (named.groupBy("token", "band").agg(
        F.min("comp").alias("lc"), F.max("comp").alias("hc"), F.min("low").alias("all_low"), F.count("*").alias("n"), F.sum("size").alias("shingles"),
        F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("sum"), F.min("id").alias("li"), F.max("id").alias("hi"))
        .where("lc != hc and not all_low"))
    open_ = materialise(named.join(mixed.select("token", "band", "n", "shingles", "sum", "li", "hi"), ["token", "band"]), "jaccard")
    short = open_.where(F.col("n") <= PAIR_LIST)
    one = short.select("token", "band", F.col("comp").alias("c1"), F.col("id").alias("a"), F.col("size").alias("sa"), F.col("low").alias("la"))
    two = short.select("token", "band", F.col("comp").alias("c2"), F.col("id").alias("b"), F.col("size").alias("sb"), F.col("low").alias("lb"))
    across = (one.join(two, ["token", "band"]).where("c1 < c2 and a != b and not (la and lb)")
              .where(F.least("sa", "sb") * 100 >= F.greatest("sa", "sb") * percent)
              .groupBy("a", "b").agg(F.first("sa").alias("sa"), F.first("sb").alias("sb"), F.count("*").alias("shared"))
              .where(_reachable("sa", "sb", "shared", percent)).select("a", "b", "sb"))
    more = verify(materialise(across, "jaccard"), docs, levels, n, percent)
    # of the long lists that have the same members one stays
    same = ["band", "n", "sum", "li", "hi"]
    one_of = open_.where(F.col("n") > PAIR_LIST).groupBy(*same).agg(F.min("token").alias("token"))
    long_ = materialise(open_.join(one_of.select("token", "band"), ["token", "band"], "left_semi")
                        .select("token", "band", "id", "comp", "low", "n", "shingles"), "jaccard")
    return connected_components(links.unionAll(more).unionAll(block_links(long_, docs, levels, n, percent)))


def block_links(lists: DataFrame, docs: DataFrame, levels: np.ndarray, n: int, percent: int) -> DataFrame:
    """Links (a, b) between sets of different components that share a long list (token, band, id,
    comp, low, n, shingles). A list is dealt into blocks of bounded members and shingles; every two
    blocks meet once, one as the trie, the other as its probes. Of the links found, a spanning
    forest is returned."""
    sets = shingle_sets(docs, lists.select("id"), n)
    held = (lists.withColumn("blocks", _parts(F.col("n"), F.col("shingles")))
            .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("token", "band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "id", "comp", "low"))
    shared = lists.sparkSession.sparkContext.broadcast(levels)

    def walk(group: pa.Table) -> pa.Table:
        ids, comp = group.column("id").to_pylist(), group.column("comp").to_numpy()
        low = group.column("low").to_numpy(zero_copy_only=False)
        block = group.column("block").to_numpy()
        sets = [np.frombuffer(x, dtype=np.uint64) for x in group.column("shingles").to_pylist()]
        left = np.flatnonzero(block == group.column("i")[0].as_py())
        right = np.flatnonzero(block == group.column("j")[0].as_py())
        out = []
        for i, j in trie_join([sets[k] for k in left], [sets[k] for k in right], comp[left], comp[right], low[left], low[right],
                              shared.value, percent):
            out.append((ids[left[i]], ids[right[j]]))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return materialise(held.hint("merge").join(sets, "id").groupBy("token", "band", "i", "j").applyInArrow(walk, PAIR), "jaccard")


def trie_join(probes: list[np.ndarray], sets: list[np.ndarray], probe_comp: np.ndarray, set_comp: np.ndarray,
              probe_low: np.ndarray, set_low: np.ndarray, levels: np.ndarray, percent: int):
    """Pairs (probe, set) of different components, not both low, that link, one for every two
    components that meet; joined components are renamed in the given arrays. One depth-first walk of the trie of
    ``sets`` serves all probes: ``path`` holds at every node the overlaps of all probes."""
    if not probes or not sets:
        return
    sizes = np.array([len(p) for p in probes])
    tokens, at = np.unique(np.concatenate(probes), return_inverse=True)
    who = np.repeat(np.arange(len(probes)), sizes)[np.argsort(at, kind="stable")]
    first = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(tokens)))]).tolist()
    ordered = [_rarest_first(s, levels)[::-1] for s in sets]
    keys = [o.astype(">u8").tobytes() for o in ordered]
    branch, path = np.empty(0, dtype=np.uint64), [np.zeros(len(probes), dtype=np.int32)]
    for j in sorted(range(len(ordered)), key=keys.__getitem__):
        o = ordered[j]
        size = len(o)
        need = -(-percent * (sizes + size) // (100 + percent))
        need[(probe_comp == set_comp[j]) | (probe_low & set_low[j])] = size + 1  # never
        k = min(size, len(branch))
        differ = np.flatnonzero(o[:k] != branch[:k])
        depth = int(differ[0]) if len(differ) else k
        del path[depth + 1:]
        spot = np.searchsorted(tokens, o[depth:])
        spot = np.where(tokens[np.minimum(spot, len(tokens) - 1)] == o[depth:], spot, -1).tolist()
        start = depth
        while depth < size:
            seen = path[-1]
            if (depth - start) % LOOK == 0 and not (seen + np.minimum(size - depth, sizes - seen) >= need).any():
                break
            t = spot[depth - start]
            if t >= 0:
                seen = seen.copy()
                seen[who[first[t]:first[t + 1]]] += 1
            path.append(seen)
            depth += 1
        branch = o[:depth]
        if depth == size:
            hits = np.flatnonzero(path[-1] >= need)
            joined, at_ = np.unique(probe_comp[hits], return_index=True)
            for i in hits[at_].tolist():
                yield i, j
            if len(joined):  # one component from here on
                probe_comp[np.isin(probe_comp, joined)] = set_comp[j]
                set_comp[np.isin(set_comp, joined)] = set_comp[j]


def ngram_classes(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, digest of the set (null if
    empty), component_id."""
    bound_batches(docs.sparkSession, SMALL_BATCH_BYTES)
    scanned = materialise(scan(docs, n), "jaccard")
    rows = scanned.where("cells is null").select("doc_id", "n_shingles", "digest")
    heads = materialise(rows.where("doc_id is not null and digest is not null")
                        .groupBy("digest").agg(F.min("doc_id").alias("head")), "jaccard")
    comps = link_heads(docs, heads.select("head"), order_levels(scanned), n, percent)
    named = heads.join(comps.withColumnRenamed("node", "head"), "head", "left").select(
        "digest", F.coalesce("component", "head").alias("component"))
    return rows.join(named, "digest", "left").select(
        "doc_id", "n_shingles", "digest",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def without_ids(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id isn't in ``gone`` (distinct long doc_id). Two bitmaps of fixed size
    settle most rows where they stand: an id in no cell of ``gone`` stays, one in such a cell goes unless
    it is also in a cell of the staying ids that share one. The rest, up to all rows where the
    bitmaps are full, is settled by a merge join. Rows without a doc_id stay."""
    one, two = fresh("gone"), fresh("stays")
    first = id_bitmap(gone, 0)
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null")
    near = ids.where(_in_bitmap(first, docs, 0))
    second = id_bitmap(near.join(gone.hint("merge"), "doc_id", "left_anti"), 1)
    marked = docs.withColumn(one, _in_bitmap(first, docs, 0)).withColumn(two, _in_bitmap(second, docs, 1))
    unclear = marked.where(F.col("doc_id").isNotNull() & F.col(one) & F.col(two)).select(docs.columns)
    return (marked.where(F.col("doc_id").isNull() | ~F.col(one)).select(docs.columns)
            .unionAll(unclear.join(gone.hint("merge"), "doc_id", "left_anti").select(docs.columns)))


def keep_first(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row per component (its smallest doc_id); rows without a doc_id and
    empty texts stay as they are."""
    classes = materialise(ngram_classes(docs, n, percent), "jaccard")
    gone = classes.where("doc_id != component_id").select("doc_id").distinct()
    kept = without_ids(docs, gone)
    twice = (classes.where("doc_id = component_id and digest is not null")
             .groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"))
    if twice.isEmpty():
        return kept
    return (kept.join(twice, "doc_id", "left_anti")
            .unionByName(kept.join(twice, "doc_id", "left_semi").dropDuplicates(["doc_id"])).select(docs.columns))
