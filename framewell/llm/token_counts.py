"""Token counts by count-only Viterbi over a unigram vocabulary.

Every word (a space-marked piece of the text) is matched against the vocabulary by an
Aho-Corasick automaton; dynamic programming over its places carries the best score and the
piece count of the best segmentation, no segmentation is stored. The rules are those of the
public unigram tokenizer with word marks and byte fallback: matches that end at a
place are tried from the longest, a later one wins only with a strictly better score; a
character that is no piece costs the least score less ``UNKNOWN`` and counts the bytes of
the run of such characters it stands in, or one for the run if the vocabulary lacks a byte.

The vocabulary's path is a parameter. A null or empty text has no tokens; any text is read
whole; repeated rows give equal rows, whichever words a worker knows already; an empty table gives
no rows; other columns are not read, so their names can't clash.
"""

from __future__ import annotations

from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from framewell.llm.common import append_columns, fresh, vocabulary_matches, worker_cache

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN = 10.0
KNOWN_WORDS = 400_000  # words whose counts a worker process remembers
TOGETHER, SHORT = 20_000, 64  # words solved in one pass, and the most characters of each

COUNT = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("score", T.DoubleType())])


def load_vocabulary(path: str = VOCABULARY) -> tuple[list[tuple[str, float]], int]:
    """([(piece, score)], index of the unknown piece) of a sentencepiece model."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())], model.unk_id()


class CountOnly:
    """Best score and piece count of words under one vocabulary."""

    def __init__(self, vocabulary: list[tuple[str, float]], unknown: int):
        self.trie = ahocorasick.Automaton()
        for i, (piece, _) in enumerate(vocabulary):
            if i != unknown and piece:
                self.trie.add_word(piece, i)
        self.trie.make_automaton()
        self.size = np.array([len(p) for p, _ in vocabulary], np.int64)
        self.score = np.array([s for _, s in vocabulary], np.float64)
        self.least = float(self.score.min()) - UNKNOWN
        names = {p for p, _ in vocabulary}
        self.has_byte = [f"<0x{b:02X}>" in names for b in range(256)]

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(pieces, scores) of the best segmentation of each text."""
        pieces, scores = np.zeros(len(texts), np.int64), np.zeros(len(texts))
        short = [i for i, t in enumerate(texts) if len(t) <= SHORT]
        for a in range(0, len(short), TOGETHER):
            some = short[a:a + TOGETHER]
            pieces[some], scores[some] = self.together([texts[i] for i in some])
        for i, t in enumerate(texts):
            if len(t) > SHORT:
                pieces[i], scores[i] = self.word(t)
        return pieces, scores

    def together(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for short texts, place by place over all of them. Places are those of the joined texts: text
        w has the places ``offsets[w]`` to ``offsets[w] + lengths[w]``."""
        joined, offsets, lengths, end, piece = vocabulary_matches(self.trie, texts)
        start = end - self.size[piece]
        text_at = np.repeat(np.arange(len(texts)), lengths + 1)  # of each place
        place = end - offsets[text_at[end]]
        order = np.argsort(place.astype(np.uint16), kind="stable")  # by place, then by text as before
        start, end, gain, place = start[order], end[order], self.score[piece[order]], place[order]
        single = np.zeros(len(joined) + 1, bool)
        single[end[end - start == 1]] = True
        run_size, bad = self._byte_sums(joined)
        score, count, run = np.zeros(len(joined) + 1), np.zeros(len(joined) + 1, np.int64), np.full(len(joined) + 1, -1)

        def closed(at: np.ndarray) -> np.ndarray:
            """Pieces up to a place, its open run of unknown characters included."""
            since = np.where(run[at] >= 0, run[at], at)
            whole = np.where(bad[at] == bad[since], run_size[at] - run_size[since], 1)
            return count[at] + np.where(since < at, whole, 0)

        cut = np.searchsorted(place, np.arange(int(lengths.max(initial=0)) + 2))
        for k in range(1, len(cut) - 1):
            here = offsets[lengths >= k] + k
            a, b = cut[k], cut[k + 1]
            # unknown characters first; where a match ends and is at least as good it takes their place
            lone = here[~single[here]]
            score[lone] = score[lone - 1] + self.least
            run[lone] = np.where(run[lone - 1] >= 0, run[lone - 1], lone - 1)
            count[lone] = count[lone - 1]
            if a == b:
                continue
            at, first, times = np.unique(end[a:b], return_index=True, return_counts=True)
            got = score[start[a:b]] + gain[a:b]
            best = np.maximum.reduceat(got, first)
            longest = np.minimum.reduceat(np.where(got == np.repeat(best, times), start[a:b], len(joined)), first)
            wins = single[at] | (best >= score[at])
            at, best, longest = at[wins], best[wins], longest[wins]
            score[at], count[at], run[at] = best, closed(longest) + 1, -1
        return closed(offsets + lengths), score[offsets + lengths]

    def _byte_sums(self, joined: str) -> tuple[np.ndarray, np.ndarray]:
        """Bytes before each place, and characters before it with a byte that the vocabulary lacks."""
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        size = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
        lacks = np.zeros(len(points), np.int64)
        if not all(self.has_byte):
            kinds, which = np.unique(points, return_inverse=True)
            lacks = np.array([not all(self.has_byte[b] for b in chr(c).encode()) for c in kinds], np.int64)[which]
        return np.concatenate([[0], np.cumsum(size)]), np.concatenate([[0], np.cumsum(lacks)])

    def word(self, text: str) -> tuple[int, float]:
        """(pieces, score) of the best segmentation."""
        n = len(text)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        single = [False] * n
        for last, i in self.trie.iter(text):
            size = int(self.size[i])
            ends[last + 1].append((last + 1 - size, float(self.score[i])))
            single[last] |= size == 1
        # per place: score, pieces before the open run of unknowns, where that run starts (-1: none)
        score, count, run = [0.0] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        for end in range(1, n + 1):
            best = None
            for start, s in sorted(ends[end]):
                got = score[start] + s
                if best is None or got > best:
                    best, come = got, start
            if not single[end - 1]:
                got = score[end - 1] + self.least
                if best is None or got > best:
                    score[end], run[end] = got, run[end - 1] if run[end - 1] >= 0 else end - 1
                    count[end] = count[end - 1]
                    continue
            score[end], count[end] = best, count[come] + self.open_run(text, run[come], come) + 1
        return count[n] + self.open_run(text, run[n], n), score[n]

    def open_run(self, text: str, start: int, end: int) -> int:
        """Pieces of the run of unknown characters text[start:end]."""
        if start < 0:
            return 0
        raw = text[start:end].encode("utf-8")
        return len(raw) if all(self.has_byte[b] for b in raw) else 1


def split_words(text: str | None) -> list[str]:
    """The text's words, each without its leading mark."""
    if not text:
        return []
    marked = text.replace(" ", MARK)
    return (marked if marked[0] == MARK else MARK + marked).split(MARK)[1:]


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_tokens, n_words, score."""
    shared = docs.sparkSession.sparkContext.broadcast(load_vocabulary(vocabulary))
    got = fresh("count")

    def make():
        counter, known, table = worker_cache(("token_counts", vocabulary), lambda: (CountOnly(*shared.value), {}, [np.zeros(0, np.int64), np.zeros(0)]))

        def fn(column):
            each = [Counter(split_words(t)) for t in column.to_pylist()]
            if len(known) > KNOWN_WORDS:
                known.clear()
                table[:] = [x[:0] for x in table]
            new = list({w: None for c in each for w in c if w not in known})
            if new:
                known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
                table[:] = [np.concatenate(x) for x in zip(table, counter.words([MARK + w for w in new]), strict=True)]
            tokens, words, scores = (np.zeros(len(each), kind) for kind in (np.int64, np.int64, np.float64))
            for i, c in enumerate(each):
                at = np.fromiter(map(known.__getitem__, c), np.int64, len(c))
                times = np.fromiter(c.values(), np.int64, len(c))
                tokens[i], words[i], scores[i] = times @ table[0][at], times.sum(), times @ table[1][at]
            return {"n_tokens": pa.array(tokens), "n_words": pa.array(words), "score": pa.array(scores)}
        return fn

    return append_columns(docs.select("doc_id", "text"), "text", COUNT, got, make).select("doc_id", f"{got}.*")
