"""Periodic runs, centroid clustering and line deduplication: against brute force and SQL, with nulls,
empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from framewell.llm import centroids, line_dedup, periodic_runs, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---- periodic runs

def brute_runs(words, least=6, times=4):
    out = set()
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(least, times * q):
                w = words[i:i + length]
                if not any(w[r:] == w[:-r] for r in range(1, q)):
                    out.add((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def random_words(rng, n, k):
    s = [rng.randrange(k) for _ in range(n)]
    if rng.random() < 0.6 and n > 8:
        a, p = rng.randrange(n), rng.randint(1, 14)
        s = [s[i] if i < a else s[min(n - 1, a + (i - a) % p)] for i in range(n)]
    return s


def test_lyndon_arrays_by_definition():
    rng = random.Random(1)
    for _ in range(400):
        s = random_words(rng, rng.randint(1, 50), rng.randint(1, 4))
        for sign in (1, -1):
            t = [sign * x for x in s]
            want = []
            for i in range(len(t)):
                j = i + 1
                while j < len(t) and t[j:] >= t[i:]:
                    j += 1
                want.append(j - i)
            assert periodic_runs.lyndon_array(np.array(t)).tolist() == want


def test_runs_of_several_texts_equal_brute_force():
    rng = random.Random(2)
    for _ in range(250):
        texts = [random_words(rng, rng.randint(0, 130), rng.choice([1, 2, 3, 5, 40])) for _ in range(rng.randint(1, 6))]
        offsets = np.cumsum([0, *map(len, texts)]).astype(np.int64)
        got = periodic_runs.text_runs(np.array([w for t in texts for w in t], np.int64), offsets).tolist()
        assert got == [[i, *r] for i, t in enumerate(texts) for r in brute_runs(t)]


def test_extensions_of_a_hard_string():
    s = np.array(([0] * 300 + [1]) * 2 + [2])
    ext = periodic_runs.Extensions(s)
    a = np.arange(300)
    assert ext.forward(a, np.full(300, 301)).tolist() == [LC(s, i, 301) for i in range(300)]
    assert ext.backward(np.array([0, 300]), np.array([301, 601])).tolist() == [0, 300]


def LC(s, a, b):
    n = 0
    while b + n < len(s) and s[a + n] == s[b + n]:
        n += 1
    return n


def digest_row(doc_id, text, tail=True):
    w = WORD.findall(text or "")
    order = queries.repeated_tail(doc_id, len(w)) if tail else None
    if order is not None:
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        assert [w[i] for i in order] == w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
        w = [w[i] for i in order]
    runs = brute_runs(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_periodic_runs_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{x}" for x in random_words(rng, rng.randint(0, 200), rng.choice([2, 4, 60])))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, " \t\n\x0b\x0c\r "), (1003, " a b\ta\nb a b  a b "), (1004, "é é " * 9), (None, "x " * 7),
             (5, rows[5][1]), (1005, "a A a A a A a A"), (1006, " ".join(f"v{i % 7000}" for i in range(70_000))), (1007, "q " * 20_000)]
    spark.createDataFrame([(i, t, 9, "s") for i, t in rows], "doc_id long, text string, runs int, best string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.op11_periodic_runs(spark, str(tmp_path)).collect()]
    quick = {1006, 1007}
    want = [digest_row(i, t) for i, t in rows if i not in quick]
    key = lambda r: tuple((x is None, x) for x in map(str, r))
    assert sorted((r for r in got if r[0] not in quick), key=key) == sorted(want, key=key)
    by_id = {r[0]: r for r in got}
    assert by_id[1007][1:6] == (1, 0, 20_000, 1, 20_000_000)
    if queries.repeated_tail(1006, 70_000) is None:
        assert by_id[1006][1:5] == (1, 0, 70_000, 7000)


def test_no_rewrite_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b a b a b a b c")], "doc_id long, text string")
    row = periodic_runs.find_runs(df).first()
    assert (row.n_words, row.best.asDict(), row.collapsed) == (9, {"start": 0, "length": 8, "period": 2}, "a b c")
    assert periodic_runs.find_runs(df.limit(0)).collect() == []
    texts = pa.array(["x", None, "", " a  b "]).slice(1)
    words, codes, offsets, joined = periodic_runs.word_numbers(texts)
    assert offsets.tolist() == [0, 0, 0, 2] and joined.to_pylist() == ["", "", "a b"]
    assert words.take(pa.array(codes)).to_pylist() == ["a", "b"]


# ---- centroids

def brute_clusters(rows, size=64, k=16):
    kept = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == size and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: ((r[0] is None), hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    centre = [v for _, v in first]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centre))
    for _ in range(3):
        mine = defaultdict(list)
        for _, v in kept:
            mine[near(v)[1]].append(v)
        centre = [[sum(x) // len(mine[j]) for x in zip(*mine[j], strict=True)] if mine[j] else c for j, c in enumerate(centre)]
    out = [(i, *near(v)[::-1]) for i, v in kept]
    each = defaultdict(int)
    for _, c, d in out:
        each[c] += d
    return sorted(((i, c, d, each[c], sum(each.values()), hashlib.sha256(",".join(map(str, centre[c])).encode()).hexdigest())
                   for i, c, d in out), key=lambda r: tuple((x is None, str(x)) for x in r))


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, 3, 4, "q") for i, v in rows], "vec_id long, embedding array<float>, q int, cluster int, dots string")


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=64) * 0.4 + i % 5]) for i in range(90)]
    good = rows[0][1]
    rows += [(200, None), (201, []), (202, good[:63]), (203, [*good, 1.0]), (204, [None, *good[1:]]), (205, [float("nan"), *good[1:]]),
             (206, [float("-inf"), *good[1:]]), (207, [0.0] * 64), (3, rows[3][1]), (4, good), (None, good), (208, [-0.001] * 64)]
    return rows


def test_clusters_equal_brute_force(spark, vectors):
    key = lambda r: tuple((x is None, str(x)) for x in r)
    got = sorted((tuple(r) for r in centroids.clustered(vectors_of(spark, vectors)).collect()), key=key)
    assert got == brute_clusters(vectors)
    few = vectors[:5] + vectors[:2]
    assert sorted((tuple(r) for r in centroids.clustered(vectors_of(spark, few)).collect()), key=key) == brute_clusters(few)


def test_incremental_products_are_exact(spark, vectors):
    state, final = centroids.cluster(vectors_of(spark, vectors))
    for r in state.collect():
        q = np.array(r.q)
        assert r.dots == (final @ q).tolist() and r.norm == int(q @ q)


def test_clusters_edges(spark, vectors):
    frame = vectors_of(spark, vectors)
    assert centroids.clustered(frame.limit(0)).collect() == []
    assert centroids.clustered(frame.where("vec_id in (200, 201, 202)")).collect() == []
    assert centroids.clustered(frame.limit(0)).columns == centroids.clustered(frame).columns
    huge = vectors_of(spark, [(1, [1e30] * 64), (2, [1.0] * 64)])
    assert [tuple(r)[:3] for r in centroids.clustered(huge).collect()] == [(2, 0, 0)]


# ---- lines

def brute_lines(rows, least=20, copies=3):
    def key(line):
        bare = line.strip(" \t\n\x0b\x0c\r")
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in bare)

    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= least:
                holders[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(holders.get(key(x), ())) < copies or i == max(holders[key(x)])]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r))


@pytest.fixture(scope="module")
def lined():
    rng = random.Random(6)
    bag = [f"Shared line number {i} of the bag with Ünïcode" if i % 3 else f"plain SHARED line of the bag {i}" for i in range(40)]
    rows = []
    for i in range(400):
        lines = [rng.choice(bag) if rng.random() < 0.4 else f"own line {i} {rng.random()}" for _ in range(rng.randint(0, 30))]
        if i % 3 == 0:
            lines.insert(0, "  The Very Common Line of One Third\t")
        if i % 7 == 0:
            lines = [x.swapcase() if rng.random() < 0.3 else f"\x0b {x}" for x in lines]
        rows.append((i, "\n".join(lines)))
    rows += [(500, None), (501, ""), (502, "\n\n"), (3, rows[3][1]), (3, "the very common line of one third\nown"), (None, bag[0] + "\n" + bag[1]),
             (503, "nineteen characters"), (504, "nineteen characters"), (505, "nineteen characters"), (506, "\n".join([bag[0], "x"] * 3000)),
             (507, "exactly twenty chars"), (508, "exactly twenty chars"), (508, "exactly twenty chars"), (509, "ÄÖÜ exactly 20 chars"),
             (510, "ÄÖÜ Exactly 20 chars"), (511, "äÖÜ exactly 20 chars\nÄÖÜ exactly 20 Chars "), (512, bag[2] + "\r\n" + bag[2])]
    return rows


def lines_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, "d", 2) for i, t in rows], "doc_id long, text string, n_lines int, drops string, lines int")


@pytest.mark.parametrize("hot", [1000, 4, 1])
def test_line_dedup_equals_brute_force(spark, lined, tmp_path, monkeypatch, hot):
    monkeypatch.setattr(line_dedup, "HOT", hot)
    monkeypatch.setattr(line_dedup, "SAMPLE", 64 if hot == 1000 else 1)
    lines_of(spark, lined).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.op13_line_dedup(spark, str(tmp_path)).collect()]
    assert sorted(got, key=lambda r: tuple((x is None, x) for x in r)) == brute_lines(lined)


def test_hot_hashes_are_dealt_apart(spark, lined, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT", 12)
    monkeypatch.setattr(line_dedup, "SAMPLE", 1)
    hashes = line_dedup.line_hashes(lines_of(spark, lined))
    n = hashes.count()
    hot = line_dedup.hot_hashes(hashes)
    assert 1 <= hot.count() <= 12
    assert all(r.n * 12 > n for r in hashes.join(hot, ["h1", "h2"]).groupBy("h1", "h2").count().withColumnRenamed("count", "n").collect())


def test_line_dedup_sql_says_the_same(spark, lined):
    rows = [r for r in lined if r[0] is not None]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert sorted(con.execute(line_dedup.dedup_sql()).fetchall()) == brute_lines(rows)


def test_line_dedup_operator(spark, lined):
    frame = lines_of(spark, lined)
    out = line_dedup.drop_lines(frame)
    assert out.columns == ["doc_id", "text", "lines", "n_lines", "n_dropped", "drops"]
    row = {r.doc_id: r for r in out.where("doc_id in (500, 506, 503)").collect()}
    assert row[500].text is None and row[500].n_lines == 1 and row[503].drops is None
    gone = [64 * d.word + b for d in row[506].drops or [] for b in range(64) if d.bits >> b & 1]
    assert len(gone) == row[506].n_dropped
    assert line_dedup.drop_lines(frame.limit(0)).collect() == []
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
