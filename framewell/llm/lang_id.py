"""Language identification by segmentation-marginalised unigrams.

Every language has one probability for each piece of a fixed public vocabulary. A word's
probability is the sum over all its segmentations into pieces, computed by the forward
algorithm over the lattice of vocabulary matches (Aho-Corasick); a text's score is the
posterior of its best language under equal priors. The probabilities are learned by
expectation-maximisation over the word counts of at most ``per_lang`` labelled texts of
a language (documented bound; chosen by hash of doc_id among all labelled texts).

Words are the maximal runs of letters of the lower-cased text, each led by the
vocabulary's word mark. Words of any length are scored over all their segmentations; in
learning, words longer than ``PART`` letters are counted in parts. A letter that is no piece of the
vocabulary has the same floor probability in every language. A text that is null or has no
letter is ``und`` with score 0, and so is every text if there is nothing to learn from. Ties
go to the first language in sorted order. Repeated rows get equal rows; an empty table gives no rows; other
columns pass through unread, names that clash with the results' are no matter.
"""

from __future__ import annotations

import re
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from framewell.llm.common import arrow_column, byte_slices, fresh, materialise, vocabulary_matches

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
PER_LANG = 2000
ROUNDS = 3
PART = 48
KNOWN_WORDS = 150_000  # words whose scores a task remembers
SCALE = 24.0  # per letter, keeps sums over segmentations near 1; the same for all languages
FLOOR = 1e-7
_LETTERS = re.compile(r"[^\W\d_]+")

PIECE_BYTES = 1 << 20  # of texts whose words are counted at once
MARGIN, LEAST_LETTERS = 3.0, 20  # see ``keep_identified``

GUESS = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                      T.StructField("letters", T.LongType()), T.StructField("fit", T.DoubleType())])
GUESS_ARROW = list(to_arrow_schema(GUESS))


def load_pieces(path: str = VOCABULARY) -> list[str]:
    """The lower-case letter pieces of a sentencepiece vocabulary, in id order."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    return [p for p in pieces if p == p.lower() and (_LETTERS.fullmatch(p.removeprefix(MARK)) or p == MARK)]


def text_words(text: str | None) -> list[str]:
    return _LETTERS.findall(text.lower()) if text else []


class Lattice:
    """All vocabulary matches of a list of words, and sums over their segmentations."""

    def __init__(self, pieces: list[str]):
        self.trie = ahocorasick.Automaton()
        for i, p in enumerate(pieces):
            self.trie.add_word(p, i)
        self.trie.make_automaton()
        self.size = np.array([len(p) for p in pieces], np.int64)
        self.unknown = len(pieces)  # index of the floor probability

    def edges(self, words: list[str]):
        """(word, start, end, piece) of every match and the words' lengths."""
        joined, offsets, lengths, end, piece = vocabulary_matches(self.trie, words)
        start = end - self.size[piece]
        text_at = np.repeat(np.arange(len(words)), lengths + 1)
        strange = np.ones(len(joined) + 1, bool)  # places after a character that is no piece
        strange[end[end - start == 1]] = False
        strange[offsets] = False
        at = np.flatnonzero(strange[:len(text_at)])
        start, end = np.concatenate([start, at - 1]), np.concatenate([end, at])
        word = text_at[end] if len(end) else end
        cols = np.array([word, start - offsets[word], end - offsets[word], np.concatenate([piece, np.full(len(at), self.unknown)])])
        return cols, lengths

    def log_sum(self, word: str, prob: np.ndarray) -> np.ndarray:
        """Log of the summed probability of all segmentations of a word of any length, per language. Keeps
        the places that a piece can reach back to, rescaled at every place."""
        (_, start, end, piece), _ = self.edges([word])
        order = np.argsort(end, kind="stable")
        start, piece = start[order], piece[order]
        cut = np.searchsorted(end[order], np.arange(1, len(word) + 2))
        width = int(self.size.max(initial=1)) + 1
        sums, scale = np.zeros((width, prob.shape[1])), np.zeros(prob.shape[1])
        sums[0] = 1.0
        for place in range(1, len(word) + 1):
            a, b = cut[place - 1], cut[place]
            now = (sums[start[a:b] % width] * prob[piece[a:b]]).sum(axis=0)
            sums[place % width] = now
            sums /= now
            scale += np.log(now)
        return scale

    @staticmethod
    def forward(cols: np.ndarray, lengths: np.ndarray, prob: np.ndarray, back: bool = False) -> np.ndarray:
        """alpha[word, place, language]: summed probability of all segmentations up to a
        place (``back``: from a place to the word's end)."""
        words, places = len(lengths), int(lengths.max(initial=0)) + 1
        sums = np.zeros((words, places, prob.shape[1]))
        into, come = (1, 2) if back else (2, 1)
        if back:
            sums[np.arange(words), lengths] = 1.0
        else:
            sums[:, 0] = 1.0
        order = np.lexsort((cols[0], cols[into]))
        cols = cols[:, order]
        cut = np.searchsorted(cols[into], np.arange(places + 1))
        for place in (range(places - 2, -1, -1) if back else range(1, places)):
            a, b = cut[place], cut[place + 1]
            if a == b:
                continue
            w = cols[0, a:b]
            part = sums[w, cols[come, a:b]] * prob[cols[3, a:b]]
            first = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
            sums[w[first], place] += np.add.reduceat(part, first)
        return sums


def scaled(pieces: list[str], prob: np.ndarray) -> np.ndarray:
    """Piece probabilities times SCALE per letter, with the floor row last."""
    lengths = np.array([len(p) for p in pieces] + [1])
    return np.concatenate([prob, np.full((1, prob.shape[1]), FLOOR)]) * (SCALE ** lengths)[:, None]


def marked(word: str) -> list[str]:
    """A word with its mark, in parts of at most PART letters."""
    text = MARK + word
    return [text[i:i + PART] for i in range(0, len(text), PART)]


def learn(labelled: DataFrame, pieces: list[str], per_lang: int = PER_LANG, rounds: int = ROUNDS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, probabilities[piece, language], log-likelihood per letter of the learned texts of each language
    before the last round) from rows (doc_id, text, lang). Gathers at most languages x pieces sums on the
    driver in each round."""
    sizes = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return [], np.zeros((len(pieces), 0)), np.zeros(0)
    share = F.create_map(*(x for k in langs for x in (F.lit(k), F.lit(min(1.0, per_lang / sizes[k])))))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    chosen = labelled.where(draw < share[F.col("lang")]).select("lang", "text")

    counted = T.StructType([T.StructField("lang", T.StringType()), T.StructField("word", T.StringType()),
                            T.StructField("n", T.LongType())])

    def count(batches):
        for batch in batches:
            total: Counter = Counter()
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total.update((lang, part) for w in text_words(text) for part in marked(w))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in total], pa.string()), pa.array([k[1] for k in total], pa.string()),
                 pa.array(list(total.values()), pa.int64())], names=["lang", "word", "n"])

    words = materialise(chosen.mapInArrow(count, counted).groupBy("lang", "word").agg(F.sum("n").alias("n")), "lang_id")
    places = {k: i for i, k in enumerate(langs)}
    expected = T.StructType([T.StructField("piece", T.IntegerType()), T.StructField("lang", T.IntegerType()),
                             T.StructField("n", T.DoubleType())])
    sc = labelled.sparkSession.sparkContext
    prob = np.full((len(pieces), len(langs)), 1.0 / len(pieces))
    fit = np.zeros(len(langs))
    for _ in range(rounds):
        shared = sc.broadcast((pieces, scaled(pieces, prob)))

        def expect(batches):
            names, p = shared.value
            lattice = Lattice(names)
            total = np.zeros((len(names) + 3, p.shape[1]))  # the last two: log-likelihood, letters
            for batch in batches:
                text = batch.column(1).to_pylist()
                lang = np.array([places[k] for k in batch.column(0).to_pylist()], dtype=np.int64)
                n = batch.column(2).to_numpy()
                cols, lengths = lattice.edges(text)
                if not cols.size:
                    continue
                ahead, behind = lattice.forward(cols, lengths, p), lattice.forward(cols, lengths, p, back=True)
                w, s, e, i = cols
                k = lang[w]
                whole = ahead[w, lengths[w], k]
                np.add.at(total, (i, k), ahead[w, s, k] * p[i, k] * behind[w, e, k] / whole * n[w])
                mine = np.log(ahead[np.arange(len(text)), lengths, lang]) - lengths * np.log(SCALE)
                np.add.at(total[-2], lang, mine * n)
                np.add.at(total[-1], lang, (lengths - [t[0] == MARK for t in text]) * n)
            total[-3] = 0.0  # the floor is fixed
            at = np.nonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at[0].astype(np.int32)), pa.array(at[1].astype(np.int32)), pa.array(total[at])],
                names=["piece", "lang", "n"])

        rows = (words.mapInArrow(expect, expected).groupBy("piece", "lang").agg(F.sum("n").alias("n")).toArrow())
        sums = np.zeros((len(pieces) + 3, len(langs)))
        sums[rows.column("piece").to_numpy(), rows.column("lang").to_numpy()] = rows.column("n").to_numpy()
        fit = sums[-2] / np.maximum(sums[-1], 1)
        sums = sums[:-3] + 0.01
        prob = sums / sums.sum(axis=0)
    return langs, prob, fit


def guess(docs: DataFrame, langs: list[str], pieces: list[str], prob: np.ndarray, name: str, text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``name``: lang_pred, score, letters, and the log-likelihood per letter
    under the predicted language (fit)."""
    shared = docs.sparkSession.sparkContext.broadcast((langs, pieces, scaled(pieces, prob) if langs else None))

    def make():
        langs, pieces, p = shared.value
        lattice = Lattice(pieces)
        known: dict[str, int] = {}
        scores = np.zeros((0, len(langs)))

        def learn_words(new: list[str]) -> None:
            nonlocal scores
            new.sort(key=len)
            total = np.zeros((len(new), len(langs)))
            usual = sum(len(w) < PART for w in new)
            for a in range(0, usual, 4000):
                some = [MARK + w for w in new[a:min(usual, a + 4000)]]
                cols, lengths = lattice.edges(some)
                total[a:a + len(some)] = np.log(lattice.forward(cols, lengths, p)[np.arange(len(some)), lengths])
            for a in range(usual, len(new)):
                total[a] = lattice.log_sum(MARK + new[a], p)
            known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
            scores = np.concatenate([scores, total])

        def some_texts(column):
            nonlocal scores
            texts = [Counter(text_words(t)) for t in column.to_pylist()]
            if len(known) > KNOWN_WORDS:
                known.clear()
                scores = scores[:0]
            if langs:
                new = list({w: None for c in texts for w in c if w not in known})
                if new:
                    learn_words(new)
            for c in texts:
                if not c or not langs:
                    yield "und", 0.0, 0, None
                    continue
                at = np.fromiter(map(known.__getitem__, c), dtype=np.int64, count=len(c))
                times = np.fromiter(c.values(), dtype=np.float64, count=len(c))
                letters = int(np.fromiter(map(len, c), np.int64, len(c)) @ times)
                total = times @ scores[at]
                k = int(total.argmax())
                # the scale of a letter or mark taken out again
                fit = (total[k] - np.log(SCALE) * (letters + times.sum())) / letters
                yield langs[k], float(1.0 / np.exp(total - total[k]).sum()), letters, float(fit)

        def fn(column):
            rows = [r for some in byte_slices(column, PIECE_BYTES) for r in some_texts(some)]
            cols = list(zip(*rows, strict=True)) or [()] * len(GUESS)
            return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(cols, GUESS_ARROW, strict=True)], fields=GUESS_ARROW)
        return fn

    return docs.withColumn(name, arrow_column(GUESS, make, F.col(f"`{text}`")))


def held_out(doc_id) -> Column:
    """Whether a document is kept out of learning: crc32 of its id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn_from(docs: DataFrame, vocabulary: str = VOCABULARY, per_lang: int = PER_LANG):
    """(languages, pieces, probabilities, usual fits) learned from the labelled rows that are not held out."""
    pieces = load_pieces(vocabulary)
    labelled = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    langs, prob, fit = learn(labelled.select("doc_id", "text", "lang"), pieces, per_lang)
    return langs, pieces, prob, fit


def identify(docs: DataFrame, vocabulary: str = VOCABULARY, per_lang: int = PER_LANG) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang): doc_id, held_out, lang_pred, score."""
    langs, pieces, prob, _ = learn_from(docs, vocabulary, per_lang)
    got = fresh("guess")
    return (guess(docs.select("doc_id", "text"), langs, pieces, prob, got)
            .select("doc_id", held_out("doc_id").alias("held_out"), f"{got}.lang_pred", f"{got}.score"))


def keep_identified(docs: DataFrame, min_score: float = 0.5, vocabulary: str = VOCABULARY, margin: float = MARGIN) -> DataFrame:
    """The rows of ``docs`` whose language is identified, their columns as they were: the score is
    ``min_score`` or more, and a text of LEAST_LETTERS letters or more fits its language, which means
    that its log-likelihood per letter is at most ``margin`` less than that of the language's learned
    texts (letter junk falls short by more)."""
    langs, pieces, prob, usual = learn_from(docs, vocabulary)
    got = fresh("guess")
    least = F.lit(None).cast("double")
    for k, fit in zip(langs, usual.tolist(), strict=True):
        least = F.when(F.col(got)["lang_pred"] == k, fit - margin).otherwise(least)
    fits = (F.col(got)["letters"] < LEAST_LETTERS) | (F.col(got)["fit"] >= least)
    return guess(docs, langs, pieces, prob, got).where((F.col(got)["score"] >= min_score) & fits).drop(got)
