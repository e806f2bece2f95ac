"""Periodic runs of words by Baier grouping.

A run is a maximal stretch of consecutive words with smallest period q, at least
``least`` words and ``times`` periods long, that no neighbouring word extends keeping q.
Phase one of Baier's suffix sorter puts every place of the text into the group of its
longest Lyndon prefix, so the lengths of the groups' contexts are the Lyndon array. It is
done under the order of the word numbers and under the reversed order; every run has a
Lyndon root among the entries of one of both. Each root is extended in both directions by
longest common extensions, exact comparisons of blocks of 1, 2, 4, ... words, and what is long
enough is a run.

Only stretches that can hold a run are grouped: inside a run of length L and period q every
three words come again at most q places later, so a place belongs to a stretch of places
with a next occurrence no farther than a third of the stretch. No run is lost by this.

Words are the maximal runs of other characters than the six ASCII white spaces. A null or
empty text has no words and no run. Long texts are read whole, in one task each. Repeated
rows give equal rows, a null id is returned as it is, an empty table gives no rows, and
only the two named columns are read, so other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from framewell.llm.common import map_batches

LEAST = 6
TIMES = 4
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)

RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


def lyndon_array(codes: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word that starts at each place, by the order of ``codes``.

    Groups are taken from the highest down. The places of a group are finished; each points to
    the nearest unfinished place on its left, whose context grows by the group's once per
    pointer: places with equally many pointers out of one old group form the new group next
    above it.
    """
    n = len(codes)
    values, first = np.unique(codes, return_inverse=True)
    by_group = np.argsort(first, kind="stable")
    cuts = np.searchsorted(first[by_group], np.arange(len(values) + 1))
    members = [by_group[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    group = first.tolist()
    size = [len(m) for m in members]
    context = [1] * len(values)
    above = list(range(1, len(values))) + [-1]
    below = list(range(-1, len(values) - 1))
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    out = [0] * n
    g = len(values) - 1
    while g != -1:
        u = context[g]
        pointers: dict[int, int] = {}  # unfinished place -> pointers to it; members ascend, so places do
        for s in members[g]:
            if group[s] != g:
                continue  # it has moved to a higher group
            p, r = left[s], right[s]
            if p >= 0:
                right[p] = r
                pointers[p] = pointers.get(p, 0) + 1
            if r < n:
                left[r] = p
            out[s] = u
        members[g] = None
        if len(pointers) == 1:
            (p, times), = pointers.items()
            moved = {(times, group[p]): [p]}
        else:
            moved = {}
            for p, times in pointers.items():
                moved.setdefault((times, group[p]), []).append(p)
        for times, old in sorted(moved, reverse=True) if len(moved) > 1 else moved:
            places = moved[times, old]
            if size[old] == len(places):  # the whole old group moves: it is the new one
                context[old] += times * u
                continue
            size[old] -= len(places)
            new = len(context)
            context.append(context[old] + times * u)
            members.append(places)
            size.append(len(places))
            for p in places:
                group[p] = new
            up = above[old]
            above.append(up)
            below.append(old)
            above[old] = new
            if up != -1:
                below[up] = new
        g = below[g]
    return np.array(out, np.int64)


class Extensions:
    """Longest common extensions of pairs of places: numbers of the blocks of 2^k words, up to
    the first k whose blocks all differ."""

    def __init__(self, codes: np.ndarray):
        self.n = len(codes)
        self.blocks = [np.unique(codes, return_inverse=True)[1].astype(np.int64)]
        while True:
            last, step = self.blocks[-1], 1 << (len(self.blocks) - 1)
            if len(last) <= step:
                break
            pairs = last[:-step] * (int(last.max()) + 1) + last[step:]
            values, numbers = np.unique(pairs, return_inverse=True)
            if len(values) == len(pairs):
                break
            self.blocks.append(numbers.astype(np.int64))

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words from ``a`` on that equal those from ``b`` on; a < b."""
        got = np.zeros(len(a), np.int64)
        for k in reversed(range(len(self.blocks))):
            block = self.blocks[k]
            at = np.flatnonzero(b + got < len(block))
            same = at[block[a[at] + got[at]] == block[b[at] + got[at]]]
            got[same] += 1 << k
        return got

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words before ``a`` that equal those before ``b``; a < b."""
        got = np.zeros(len(a), np.int64)
        for k in reversed(range(len(self.blocks))):
            block, step = self.blocks[k], 1 << k
            at = np.flatnonzero(a - got >= step)
            same = at[block[a[at] - got[at] - step] == block[b[at] - got[at] - step]]
            got[same] += step
        return got


def string_runs(codes: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """(start, length, period) of every run of one string of word numbers, sorted."""
    if len(codes) == 0:
        return np.empty((0, 3), np.int64)
    places = np.arange(len(codes), dtype=np.int64)
    starts, periods = [], []
    for order in (codes, -codes):
        root = lyndon_array(order)
        inside = places + root < len(codes)
        starts.append(places[inside])
        periods.append(root[inside])
    a, q = np.concatenate(starts), np.concatenate(periods)
    if len(a) == 0:
        return np.empty((0, 3), np.int64)
    extend = Extensions(codes)
    before = extend.backward(a, a + q)
    length = before + q + extend.forward(a, a + q)
    long = length >= np.maximum(least, times * q)
    return np.unique(np.stack([(a - before)[long], length[long], q[long]], axis=1), axis=0)


def candidate_stretches(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint (begin, end) outside of which no run has a word. ``ends`` is the end of the text
    that each place stands in; the filter is for runs of at least 6 words and 4 periods."""
    none = np.empty(0, np.int64)
    n = len(codes)
    if n < LEAST:
        return none, none
    wide = codes.astype(np.uint64)
    # equal triples have equal keys; a clash only makes a next occurrence nearer
    keys = wide[:-2] * _MIX[0] + wide[1:-1] * _MIX[1] + wide[2:] * _MIX[2]
    order = np.argsort(keys, kind="stable")
    follows = keys[order[1:]] == keys[order[:-1]]
    gap = np.full(n - 2, np.iinfo(np.int64).max)
    gap[order[:-1][follows]] = (order[1:] - order[:-1])[follows]
    at = np.arange(n - 2)
    good = (gap < n) & (at + np.minimum(gap, n) + 2 < ends[:-2])
    while True:
        edge = np.flatnonzero(np.diff(np.concatenate([[0], good.view(np.int8), [0]])))
        begin, end = edge[::2], edge[1::2]
        if len(begin) == 0:
            return none, none
        size = end - begin
        most = np.where(size < LEAST - 3, 0, (size + 2) // 3)  # the longest period that fits
        bad = good.copy()
        bad[good] = gap[good] > np.repeat(most, size)
        if not bad.any():
            break
        good &= ~bad
    end = np.minimum(end + most + 2, ends[begin])
    reach = np.maximum.accumulate(end)
    new = np.concatenate([[True], begin[1:] >= reach[:-1]])
    first = np.flatnonzero(new)
    return begin[first], reach[np.concatenate([first[1:] - 1, [len(end) - 1]])]


def text_runs(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(text, start, length, period) of every run of several texts; text i holds the words
    offsets[i] to offsets[i + 1]. Sorted by text, start, period."""
    sizes = np.diff(offsets)
    begin, end = candidate_stretches(codes, np.repeat(offsets[1:], sizes))
    if len(begin) == 0:
        return np.empty((0, 4), np.int64)
    # one string of all stretches, each closed by a word of its own, which no run crosses
    size = end - begin
    shift = np.concatenate([[0], np.cumsum(size + 1)])
    source = np.arange(shift[-1]) + np.repeat(begin - shift[:-1], size + 1)
    last = shift[1:] - 1
    source[last] = 0
    joined = codes[source].astype(np.int64)
    joined[last] = int(codes.max()) + 1 + np.arange(len(last))
    runs = string_runs(joined)
    stretch = np.searchsorted(shift, runs[:, 0], side="right") - 1
    start = runs[:, 0] - shift[stretch] + begin[stretch]
    text = np.searchsorted(offsets, start, side="right") - 1
    out = np.stack([text, start - offsets[text], runs[:, 1], runs[:, 2]], axis=1)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def word_numbers(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, pa.Array]:
    """(words of the dictionary, word numbers, offsets, texts with single spaces) of a string column."""
    trimmed = pc.ascii_trim_whitespace(pc.fill_null(texts, ""))
    lists = pc.ascii_split_whitespace(trimmed)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    numbers = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(offsets)
    blank = pc.equal(trimmed, "").to_numpy(zero_copy_only=False)  # split into one empty word
    keep = np.repeat(~blank, sizes)
    offsets = np.concatenate([[0], np.cumsum(np.where(blank, 0, sizes))])
    return coded.dictionary, numbers[keep], offsets, pc.binary_join(lists, " ")


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period; ties: smallest start, then period."""
    best = None
    for run in runs:  # sorted by start and period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def find_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
              rewrite: Callable[[object, int], np.ndarray | None] | None = None) -> DataFrame:
    """One row per row of ``docs``: the id, n_words, runs (array of start, length, period, by start
    and period), best (the run with the greatest exponent or null) and collapsed (the words
    joined by one space, without those that a run holds after its first period).

    ``rewrite(id, number of words)`` may return word numbers that the text is made of instead
    of its own words in order.
    """
    schema = T.StructType([T.StructField(doc_id, docs.schema[doc_id].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(RUN)), T.StructField("best", RUN), T.StructField("collapsed", T.StringType())])

    def make():
        def fn(batch):
            ids = batch.column(0)
            words, codes, offsets, collapsed = word_numbers(batch.column(1))
            changed = set()
            if rewrite is not None:
                for i, key in enumerate(ids.to_pylist()):
                    a, b = offsets[i], offsets[i + 1]
                    order = rewrite(key, int(b - a))
                    if order is not None:
                        codes[a:b] = codes[a:b][order]
                        changed.add(i)
            found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(ids))]
            for i, *run in text_runs(codes, offsets).tolist():
                found[i].append(tuple(run))
            joined = collapsed.to_pylist() if changed or any(found) else None
            for i, runs in enumerate(found):
                if runs or i in changed:
                    mine = codes[offsets[i]:offsets[i + 1]]
                    if runs:
                        cover = np.zeros(len(mine) + 1, np.int64)
                        for start, length, period in runs:
                            cover[start + period] += 1
                            cover[start + length] -= 1
                        mine = mine[np.cumsum(cover[:-1]) == 0]
                    joined[i] = " ".join(words.take(pa.array(mine)).to_pylist())
            names = ("start", "length", "period")
            yield {doc_id: ids, "n_words": pa.array(np.diff(offsets)),
                   "runs": [[dict(zip(names, r, strict=True)) for r in runs] for runs in found],
                   "best": [dict(zip(names, b, strict=True)) if (b := strongest(runs)) else None for runs in found],
                   "collapsed": joined if joined is not None else collapsed}
        return fn

    return map_batches(docs.select(doc_id, text), schema, make)
