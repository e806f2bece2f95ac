"""Nothing is cut at a length: values, words, attributes and items beyond former bounds; batched solutions equal the plain ones."""

import datetime
import random
import re

import numpy as np
import pytest

import corpus_pipeline
from framewell.llm import common, decontaminate, lang_id, mixing, page_text, pseudonyms, token_counts

KEY = b"tests only"


def there_and_back(text):
    new, spans = pseudonyms.Pseudonyms(KEY).apply(text)
    assert pseudonyms.Pseudonyms(KEY, inverse=True).apply(new)[0] == text
    return new, [kind for _, _, kind, _ in spans]


def test_long_names_tokens_and_far_dates_are_replaced_whole():
    name = "a" * 70 + ".b" * 60
    new, kinds = there_and_back(f"x {name}@example.org y")
    assert kinds == ["email"] and len(new) == len(name) + 16 and name[:10] not in new
    token = "Ab1." * 300 + "x"
    new, kinds = there_and_back(f'token = "{token}"')
    assert kinds == ["secret"] and [c == "." for c in new[9:-1]] == [c == "." for c in token]
    for text, shape in (("1799-01-02", r"\d{4}-\d\d-\d\d"), ("2201-03-04", r"\d{4}-\d\d-\d\d"), ("0001-01-01", r"\d{4}-\d\d-\d\d"), ("31/12/9999", r"\d\d/\d\d/\d{4}"),
                        ("1/5/2020", r"[1-9]/[1-9]/\d{4}"), ("2020-1-5", r"\d{4}-[1-9]-[1-9]"), ("1/25/2020", r"[1-9]/[1-3]\d/\d{4}"), ("13.7.1801", r"[1-3]\d\.[1-9]\.\d{4}")):
        new, kinds = there_and_back(text)
        assert re.fullmatch(shape, new) and len(kinds) == 1, (text, new)
    for text in ("2020-13-40", "99/99/2020", "1.2.3", "2020-02-30"):
        assert there_and_back(text) == (text, [])


def test_many_at_signs_take_linear_time():
    text = "a" * 3000 + "@" + "b@" * 20_000
    assert pseudonyms.Pseudonyms(KEY).apply(text)[0] == text


def test_dates_of_one_form_are_permuted_among_themselves():
    names = pseudonyms.Pseudonyms(KEY)
    days = [(datetime.date(1790, 1, 1) + datetime.timedelta(days=i)).isoformat() for i in range(8000)]
    new = [names.apply(d)[0] for d in days]
    assert len(set(new)) == len(days)
    assert all(("1800" <= a[:4] < "2200") == ("1800" <= b[:4] < "2200") for a, b in zip(days, new, strict=True))


@pytest.mark.parametrize("length", [1000, 70_000, 300_000])
def test_attributes_of_any_length(length):
    page = f'<body><article><p>one <img alt="a > b {"A" * length}"> two</p></article></body>'
    assert page_text.main_text(page_text.page_lines(page), None)[0] == "one two"


def test_open_quotes_are_searched_once():
    page = "<article><p>" + '<a b="c>x ' * 30_000 + "</p></article>"
    assert "x" in page_text.main_text(page_text.page_lines(page), None)[0]


def test_vocabulary_matches_equal_a_search_of_each_word():
    pieces = ["a", "ab", "b", "ba", "aba", "▁", "▁a", "é"]
    lattice = lang_id.Lattice(pieces)
    rng = random.Random(2)
    words = ["▁" + "".join(rng.choice("abéx") for _ in range(rng.randint(0, 12))) for _ in range(200)] + ["", "x"]
    cols, lengths = lattice.edges(words)
    want = set()
    for w, t in enumerate(words):
        for s in range(len(t)):
            for e in range(s + 1, len(t) + 1):
                if t[s:e] in pieces:
                    want.add((w, s, e, pieces.index(t[s:e])))
            if t[s] not in pieces:
                want.add((w, s, s + 1, len(pieces)))
    assert {tuple(c) for c in cols.T.tolist()} == want and cols.shape[1] == len(want)
    assert lengths.tolist() == [len(w) for w in words]


def test_forward_sums_of_words_of_any_length_equal_all_segmentations():
    pieces = ["a", "ab", "b", "ba", "aba", "▁", "▁a"]
    lattice = lang_id.Lattice(pieces)
    prob = lang_id.scaled(pieces, np.random.default_rng(1).random((len(pieces), 2)))

    def brute(t, row):
        sums = [1.0] + [0.0] * len(t)
        for e in range(1, len(t) + 1):
            for s in range(e):
                if t[s:e] in pieces:
                    sums[e] += sums[s] * row[pieces.index(t[s:e])]
            if t[e - 1] not in pieces:
                sums[e] += sums[e - 1] * row[-1]
        return np.log(sums[-1])

    for word in ("▁", "▁abab", "▁xxabax", "▁" + "ab" * 60):
        for k in range(2):
            assert abs(lattice.log_sum(word, prob)[k] - brute(word, prob[:, k])) < 1e-9
    assert np.isfinite(lattice.log_sum("▁" + "abx" * 30_000, prob)).all()


def test_letter_junk_goes_and_clean_texts_stay(spark):
    rng = random.Random(3)
    bag = "the of and to in is that it was for on are with as his they at be this have from or had by word".split()
    rows = [(i, " ".join(rng.choices(bag, k=60)), "en") for i in range(40)]
    rows += [(100, " ".join("".join(rng.choices("qxzjkvwbcd", k=8)) for _ in range(30)), None), (101, "zq", None), (102, None, None), (103, "12 34", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.doc_id for r in lang_id.keep_identified(docs).collect()} == {*range(40), 101}


def test_token_counts_of_batches_equal_single_words():
    vocabulary = [("<unk>", 0.0), *((f"<0x{b:02X}>", 0.0) for b in range(256) if b != 0xC3)]
    rng = random.Random(4)
    vocabulary += [(p, -rng.randint(1, 6) / 2) for p in {"".join(rng.choices("ab▁", k=rng.randint(1, 4))) for _ in range(60)}]
    counter = token_counts.CountOnly(vocabulary, 0)
    words = ["▁" + "".join(rng.choices("abéx漢", k=rng.randint(0, 80))) for _ in range(400)]
    pieces, scores = counter.words(words)
    assert [(int(p), float(s)) for p, s in zip(pieces, scores, strict=True)] == [counter.word(w) for w in words]
    assert [len(x) for x in counter.words([])] == [0, 0]


def test_items_repeated_named_by_text_or_nameless(spark):
    words = [f"w{i}" for i in range(30)]
    text = " ".join(words)
    items = spark.createDataFrame([("b", text), ("b", text), ("b", " ".join(words[:12])), ("a", text), (None, " ".join(words[20:])), ("c", "nothing here")], "item_id string, text string")
    docs = spark.createDataFrame([(1, text, 9), (2, " ".join(words[19:]), 9), (3, None, 9)], "doc_id long, text string, n_hit int")
    got = {r.doc_id: r for r in decontaminate.decontaminate(docs, items).collect()}
    assert got[1].item_ids == ["a", "b"] and (got[1].n_items, got[1].n_hit) == (2, 30)
    assert got[2].item_ids == ["a", "b"] and got[2].n_hit == 11
    assert (got[3].n_words, got[3].contaminated) == (0, False)
    nameless = decontaminate.decontaminate(docs, items.where("item_id is null")).where("doc_id = 2").first()
    assert (nameless.n_hit, nameless.n_items, nameless.contaminated) == (10, 0, True)
    assert decontaminate.decontaminate(docs.limit(0), items).collect() == []
    assert {r.n_hit for r in decontaminate.decontaminate(docs, items.limit(0)).collect()} == {0}


LABELS = "doc_id long, quality int, toxic int"


def test_rates_pass_all_columns(spark):
    docs = spark.createDataFrame([(i, f"good words {i}" if i % 2 else "bad stuff", "x", 5) for i in range(20)] + [(None, None, None, None), (3, "good words 3", "x", 5)],
                                 "doc_id long, text string, _mix_id string, mix_rate int")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(10)], LABELS)
    out = mixing.with_rates(docs, labels)
    assert out.columns == ["doc_id", "text", "_mix_id", "mix_rate", "mix_copies"]
    rows = out.collect()
    assert all(r.mix_copies > 0 and (r._mix_id == "x" or r.doc_id is None) for r in rows)
    assert mixing.with_rates(docs.limit(0), labels).collect() == [] == mixing.with_rates(docs.limit(0), labels.limit(0)).collect()


def test_words_by_bucket_equal_a_split_by_white_space(spark):
    texts = ["A b\tC\n d\x0b\x0ce\r\rf ", "", None, " \t", "ÄÖ x y", "one"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select(mixing._buckets("text").alias("b"))
    sizes = [len(r.b) for r in df.collect()]
    assert sizes == [len(re.split(r"[ \t\n\x0b\x0c\r]+", t.strip(" \t\n\x0b\x0c\r"))) if t and t.strip(" \t\n\x0b\x0c\r") else 0 for t in texts]


def brute_kept(rows):
    """The pipeline's first stages by hand: the language stage keeps texts with letters, of near copies the smallest id stays."""
    sets = {}
    for i, t in rows:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    kept = []
    for i, t in sorted(rows):
        if t and re.search("[a-z]", t) and not any(100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) for j in kept if sets[i] and sets[j]):
            kept.append(i)
    return kept


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(8)
    bag = "the of and to in is that it was for on are with as his they at be this have from or had by word not but what all were".split()
    base = [" ".join(rng.choices(bag, k=50)) for _ in range(30)]
    leak = " ".join(f"leak{i} the" for i in range(8))
    rows = list(enumerate(base)) + [(100 + i, base[i]) for i in range(5)] + [(200 + i, base[i] + " end") for i in range(5)]
    rows += [(300, base[0][:100] + " " + leak + " " + base[1][:100]), (301, None), (302, "12 34"), (303, "write to anna.smith@example.org on 2020-01-05 " + base[7][:150])]
    spark.createDataFrame([(i, t, "en" if i < 30 else None, "web", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(20)], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    docs = common.table(spark, str(tmp_path), "documents")
    kept = brute_kept(rows)
    wanted = [[i for i, t in rows if t and re.search("[a-z]", t)], kept, [i for i in kept if i != 300], [i for i in kept if i != 300]]
    for (name, stage), ids in zip(corpus_pipeline.STAGES[:4], wanted, strict=True):
        docs = common.materialise(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert sorted(r.doc_id for r in docs.select("doc_id").collect()) == sorted(ids), name
    changed = docs.where("doc_id = 303").first().text
    assert "anna.smith@" not in changed and "2020-01-05" not in changed and len(changed) == len(dict(rows)[303])
    assert {r.doc_id: r.text for r in docs.collect() if r.doc_id != 303} == {i: t for i, t in rows if i in wanted[3] and i != 303}
    last = corpus_pipeline.STAGES[4][1](spark, docs, str(tmp_path))
    assert {r.doc_id for r in last.collect()} <= set(wanted[3])


def test_pipeline_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
