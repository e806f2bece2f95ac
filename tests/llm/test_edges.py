"""Empty tables, clashing column names, very long and repeated rows of the vector, licence, token, archive and page operators."""

import hashlib

import pytest

from framewell.llm import archives, licenses, near_vectors, page_text, token_counts


def test_vectors(spark):
    schema = "vec_id long, embedding array<float>, label int, n_links string, kept int, pivot long, block long"
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (None, [1.0, 0.0], 1), (3, None, 1), (4, [1.0, 0.0], None), (1, [1.0, 0.0], 1)]
    df = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], schema)
    got = {}
    for r in near_vectors.near_vectors(df).collect():
        got.setdefault(r.vec_id, []).append((r.component_id, r.kept))
    assert got[2] == [(1, False)] and got[3] == [(3, True)] and got[4] == [(4, True)] and got[None] == [(None, got[None][0][1])]
    assert near_vectors.near_vectors(df.limit(0)).collect() == []
    assert near_vectors.near_vectors(df.where("vec_id = 3")).first().component_id == 3


def test_licences(spark):
    long = "word " * 400_000 + "\nAll rights reserved.\n" + "more\n" * 20_000
    df = spark.createDataFrame([(1, long, 5, "x"), (2, None, 5, "x"), (3, "All rights reserved.", 5, "x"), (3, "All rights reserved.", 5, "x")],
                               "doc_id long, text string, n_lines int, digest string")
    got = sorted((tuple(r) for r in licenses.scan(df).select("doc_id", "text_license", "line_licenses").collect()), key=str)
    name = "LicenseRef-all-rights-reserved"
    assert got == [(1, None, name), (2, None, None), (3, name, name), (3, name, name)]
    assert licenses.scan(df.limit(0)).collect() == []


def test_token_counts(spark):
    df = spark.createDataFrame([(1, "one two one", 7), (1, "one two one", 7), (2, None, 7), (3, "one two one" * 50_000, 7)], "doc_id long, text string, n_tokens int")
    got = [tuple(r) for r in token_counts.count_tokens(df).select("doc_id", "n_tokens", "n_words", "score").collect()]
    assert got[0] == got[1] and got[2][1:3] == (0, 0) and got[3][2] == 100_001
    assert token_counts.count_tokens(df.limit(0)).collect() == []


def test_archives(spark):
    long = "<p>" + "é" * 1_500_000
    rows = [(1, "http://a/x", long), (2, "http://a/y", long), (2, "http://a/y", long), (3, None, None), (None, "http://a/ z", "tiny")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, payload_digest string, rid int")
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in archives.pages_through_archives(df).collect()), key=str)
    size = len(long.encode())
    assert got == sorted([(1, size, "revisit", 2), (2, size, "response", None), (2, size, "revisit", 2), (3, 0, "response", None), (None, 4, "response", None)], key=str)
    digests = {r.payload_digest for r in archives.pages_through_archives(df).collect()}
    assert hashlib.sha1(long.encode()).hexdigest() in digests
    assert archives.pages_through_archives(df.limit(0)).collect() == []


@pytest.mark.parametrize("words", [10, 300_000])
def test_pages(spark, words):
    body = "lorem &amp; ipsum " * words
    rows = [(1, "http://h/a", f"<nav>menu</nav><article><p>{body}</p><p>second</p></article>"), (2, None, None), (1, "http://h/a", f"<article><p>{body}</p><p>second</p></article>")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, key int, shared string")
    got = page_text.extract(df).collect()
    want = ("lorem & ipsum " * words).strip() + "\nsecond"
    assert sorted((r.page_id, r.text, r.n_chars) for r in got) == [(1, want, len(want))] * 2 + [(2, "", 0)]
    assert page_text.extract(df.limit(0)).collect() == []
