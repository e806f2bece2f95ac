"""The llm operators on small inputs: nulls, empty and long texts, ties, repeated rows, empty tables,
extra columns with clashing names; against brute force, exact round trips or held-out accuracy."""

import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

from framewell.llm import archives, common, decontaminate, lang_id, licenses, mixing, near_vectors, ngram_join, page_text, pseudonyms, token_counts

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row long, hits int, guess string"
RNG = random.Random(5)


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t), 7, 8, "x") for i, t, lang in rows], DOCS)


def words(n, bag="abcdefgh"):
    return " ".join(RNG.choice(bag) + RNG.choice(bag) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """Near copies of one text, exact copies, nulls, empty, short and one very long text."""
    base = words(60, "abcdefghijklmnop").split()
    rows = [(i, " ".join([*base[:i], "zz%d" % i, *base[i + 1:]]), "en") for i in range(20, 40)]
    rows += [(100 + i, words(40, "qrstuvwxyz"), "de") for i in range(10)]
    rows += [(200, rows[0][1].upper(), "en"), (201, rows[0][1], None), (7, None, "en"), (8, "", "en"), (9, " \t\n", None), (5, "one two", "en"),
             (6, "One\ttwo", "en"), (None, "one two", "en"), (300, words(30000), "en"), (20, rows[0][1], "en")]
    return rows


def test_connected_components(spark):
    edges = [(9, 8), (8, 7), (7, 1), (3, 2), (5, 5)] + [(100, 100 + i) for i in range(1, 50)]
    got = dict(tuple(r) for r in common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {9: 1, 8: 1, 7: 1, 1: 1, 3: 2, 2: 2, **{100 + i: 100 for i in range(50)}}
    assert common.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def _jaccard_classes(rows):
    sets = {}
    for i, t, _ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    comp = {i: i for i in sets if i is not None}
    for _ in comp:
        for a in comp:
            for b in comp:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                    comp[a] = comp[b] = min(comp[a], comp[b])
    return sets, comp


@pytest.mark.parametrize("longest_pair_list", [ngram_join.PAIR_LIST, 2])
def test_ngram_join_equals_brute_force(spark, corpus, monkeypatch, longest_pair_list):
    monkeypatch.setattr(ngram_join, "PAIR_LIST", longest_pair_list)
    sets, comp = _jaccard_classes(corpus)
    got = ngram_join.ngram_classes(docs_of(spark, corpus)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter((i, len(sets[i]), comp.get(i)) for i, _, _ in corpus)


def test_keep_first_and_empty_table(spark, corpus):
    docs = docs_of(spark, corpus)
    _, comp = _jaccard_classes(corpus)
    kept = ngram_join.keep_first(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([i for i in comp if comp[i] == i] + [None])
    assert ngram_join.keep_first(docs.limit(0)).count() == 0


@pytest.mark.parametrize("bits", [ngram_join.BITMAP_BITS, 8])
def test_without_ids_is_exact(spark, monkeypatch, bits):
    monkeypatch.setattr(ngram_join, "BITMAP_BITS", bits)  # 256 cells: many ids share one
    rows = [(i, "t%d" % i, "en") for i in [*range(400), 3, 4]] + [(None, "x", None)]
    gone = spark.createDataFrame([(i,) for i in range(0, 400, 4)], "doc_id long")
    got = ngram_join.without_ids(docs_of(spark, rows), gone)
    assert got.columns == DOCS.replace(",", "").split()[::2]
    assert Counter(r.doc_id for r in got.collect()) == Counter(i for i, _, _ in rows if i is None or i % 4)
    assert ngram_join.without_ids(docs_of(spark, rows), gone.limit(0)).count() == len(rows)


def test_trie_join_equals_pairwise():
    levels = np.zeros(1 << ngram_join.SKETCH_BITS, dtype=np.uint8)
    pool = ngram_join._avalanche(np.arange(1, 60, dtype=np.uint64))
    sets = [np.unique(np.array(RNG.sample(pool.tolist(), RNG.randrange(1, 50)), dtype=np.uint64)) for _ in range(60)]
    sets += [np.delete(s, 0) for s in sets if len(s) > 1]
    for percent in (50, 80):
        for i, s in enumerate(sets[:20]):
            want = [j for j, t in enumerate(sets) if 100 * len(np.intersect1d(s, t)) >= percent * len(np.union1d(s, t))]
            assert sorted(ngram_join.trie_matches(s, sets, levels, percent)) == want, i


@pytest.mark.parametrize("block", [decontaminate.BLOCK_WINDOWS, 20])
def test_decontaminate_equals_brute_force(spark, corpus, block):
    long_text = corpus[-2][1].split()
    bench = [(1, " ".join(long_text[50:75])), (2, "Two, ONE"), (3, "one-two"), (4, None), (5, "..."), (33, "one two"), (33, "one two")]
    rx, fold = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), {i: i + 32 for i in range(65, 91)}
    windows = defaultdict(set)
    for i, t in bench:
        w = rx.findall((t or "").translate(fold))
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k:k + 10])].add(i)
    want = Counter()
    for i, t, _ in corpus:
        w, hit, items = rx.findall((t or "").translate(fold)), set(), set()
        for m in {len(k) for k in windows}:
            for k in range(len(w) - m + 1):
                if tuple(w[k:k + m]) in windows:
                    hit |= set(range(k, k + m))
                    items |= windows[tuple(w[k:k + m])]
        want[i, len(w), len(hit), tuple(sorted(map(str, items)))] += 1
    docs, items = docs_of(spark, corpus), spark.createDataFrame(bench, "item_id long, text string")
    got = Counter((r.doc_id, r.n_words, r.n_hit, tuple(sorted(set(r.item_ids)))) for r in decontaminate.decontaminate(docs, items, block_windows=block).collect())
    assert got == want
    assert decontaminate.drop_contaminated(docs, items).count() == sum(n for k, n in want.items() if not k[2])
    assert decontaminate.drop_contaminated(docs, items.limit(0)).count() == len(corpus)


def test_language_id_sums_segmentations_and_holds_out(spark):
    pieces = [lang_id.MARK + "a", "a", "b", "ab", lang_id.MARK]
    prob = np.array([[0.2], [0.3], [0.1], [0.25], [0.15]])
    lattice = lang_id.Lattice(pieces)
    cols, lengths = lattice.edges([lang_id.MARK + "ab"])
    whole = lattice.forward(cols, lengths, lang_id.scaled(pieces, prob))[0, 3, 0] / lang_id.SCALE ** 3
    assert whole == pytest.approx(0.2 * 0.1 + 0.15 * 0.3 * 0.1 + 0.15 * 0.25)
    rows = [(i, words(30, "abcdefg"), "en") for i in range(60)] + [(100 + i, words(30, "stuvwxyz"), "de") for i in range(60)]
    rows += [(500, None, "en"), (501, "12 !?", "de"), (None, "ab", None), (1, rows[1][1], "en")]
    got = {r.doc_id: r for r in lang_id.identify(docs_of(spark, rows)).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in rows[:120])
    assert any(r.held_out for r in got.values()) and (got[500].lang_pred, got[500].score, got[501].lang_pred) == ("und", 0.0, "und")
    assert lang_id.keep_identified(docs_of(spark, rows)).count() == len(rows) - 2
    assert {r.lang_pred for r in lang_id.identify(docs_of(spark, [(1, "ab", None)])).collect()} == {"und"}


def test_feistel_permutes_and_inverts():
    net = pseudonyms.Feistel(b"key")
    for n in (1, 2, 7, 100, 1000):
        image = [net.permute("k", n, i) for i in range(n)]
        assert sorted(image) == list(range(n)) and [net.permute("k", n, i, inverse=True) for i in image] == list(range(n))


def test_pseudonyms_round_trip(spark):
    text = ("a.b@mail.example.com +1 (017) 555-7713 4111 1111 1111 1111 DE89 3704 0044 0532 0130 00 1984-02-29 31/12/1999 10.0.0.1 "
            "078-05-1120 token = \"b44e15e09fd311c3\"")
    clean = "4111111111111112 300.1.1.1 2020-13-40 version 3.0 " + "x" * 100000
    rows = [(1, text, "en"), (2, text + " " + text, "en"), (3, clean, "en"), (4, None, "en"), (5, "", "en"), (1, text, "en")]
    got = {r.doc_id: r for r in pseudonyms.pseudonymise(docs_of(spark, rows)).collect()}
    assert got[1].n_found == 9 and got[2].text == got[1].text + " " + got[1].text
    for value in re.findall(r"\S*\d\S*", text):
        assert value not in got[1].text.split() or len(value) < 4
    assert pseudonyms.Pseudonyms(inverse=True).apply(got[1].text)[0] == text
    assert got[3].text == clean and got[4].text is None and got[5].text == ""
    back = pseudonyms.with_pseudonyms(docs_of(spark, rows))
    assert back.columns == DOCS.replace(",", "").split()[::2] and {r.n_chars == (None if r.text is None else len(r.text)) for r in back.collect()} == {True}


def test_near_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 16)).astype(np.float32)
    vecs = [b + rng.normal(scale=0.03, size=16).astype(np.float32) for b in base for _ in range(6)] + [base[0]] * 3
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(vecs)]
    odd = [(900, None, 0), (901, [0.0] * 16, 0), (902, [float("nan")] * 16, 0), (903, [None] * 16, 0), (904, vecs[0].tolist(), None), (905, [1.0, 2.0], 0)]
    got = {r.vec_id: r for r in near_vectors.near_vectors(spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int")).collect()}
    v = np.array([r[1] for r in rows])
    unit, label = v / np.linalg.norm(v, axis=1)[:, None], np.array([r[2] for r in rows])
    linked = (unit @ unit.T >= near_vectors.COSINE) & (label[:, None] == label)
    np.fill_diagonal(linked, False)
    found = sum(got[i].n_links for i in range(len(rows)))
    assert 0.9 * linked.sum() <= found <= linked.sum()
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in range(900, 906))


def test_near_vectors_of_one_narrow_group(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=16)
    copies = [(base + rng.normal(scale=0.08, size=16)).tolist() for _ in range(60)]  # one group: cosines about COSINE
    cone = [(4 * np.eye(12)[0] + 0.2 * rng.normal(size=12)).tolist() for _ in range(60)]
    rows = [(i, v, i % 2) for i, v in enumerate(copies + cone)] + [(500, [1.0, 2.0], 0), (501, [2.0, 4.0], 0), (502, [1.0, 2.0, 3.0], 0)]
    got = {r.vec_id: r for r in near_vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    links = Counter()
    for i, a, la in rows:
        for j, b, lb in rows:
            if i != j and la == lb and len(a) == len(b):
                links[i] += np.dot(a, b) >= near_vectors.COSINE * np.linalg.norm(a) * np.linalg.norm(b)
    assert all(sum(links[i] for i in part) > 0 for part in (range(60), range(60, 120)))
    assert {i: r.n_links for i, r in got.items()} == {i: links[i] for i, _, _ in rows}
    assert (got[501].component_id, got[501].kept, got[502].n_links) == (500, False, 0)


def test_archives_round_trip(spark, tmp_path):
    big = "é" * 600
    rows = [(1, "http://a/x y", big), (2, None, big), (3, "u", "short"), (4, "u", "short"), (5, "v", None), (6, "w", "a\r\n\r\nWARC/1.0\r\n\n" * 90), (None, "z", big)]
    got = {r.page_id: r for r in archives.pages_through_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert {k: (r.record_type, r.refers_to) for k, r in got.items()} == {
        1: ("revisit", 2), 2: ("response", None), 3: ("response", None), 4: ("response", None), 5: ("response", None), 6: ("response", None), None: ("revisit", 2)}
    assert all(r.intact for r in got.values()) and got[1].payload_bytes == 1200 and got[5].payload_bytes == 0
    assert archives.pages_through_archives(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_alignment_is_a_longest_common_subsequence(monkeypatch):
    def longest(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        return t[-1][-1]

    for bits in (page_text.BITS, 4):
        monkeypatch.setattr(page_text, "BITS", bits)
        for _ in range(500):
            a, b = ([RNG.randrange(4) for _ in range(RNG.randrange(9))] for _ in "ab")
            at, rest = sorted(page_text.aligned(a, b)), iter(b)
            assert len(at) == longest(a, b) and all(a[i] in rest for i in at)


def test_page_text(spark):
    article = "<nav>menu</nav><div class='ad'>buy</div><article><h1>T&amp;t</h1><p>a <b>b</b>\n c<br>d<script>x='</p>'</script></article><footer>f</footer>"
    shared = "<div>site name</div>{}<p>all rights</p>"
    rows = [(1, "http://h/a/1", article), (2, "http://h/a/2", None), (3, "http://g/a/1", shared.format("<p>one</p>")),
            (4, "http://g/a/2", shared.format("<p>two</p>")), (5, None, ""), (5, None, ""), (6, "http://k/1", "<p>same</p>"), (7, "http://k/2", "<p>same</p>")]
    got = page_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert Counter((r.page_id, r.text) for r in got) == Counter([(1, "T&t\na b c d"), (2, ""), (3, "one"), (4, "two"), (5, ""), (5, ""), (6, "same"), (7, "same")])


def test_page_text_of_near_copies_without_article(spark):
    def page(*lines):
        return "<div>Home</div><div>About us</div>" + "".join(f"<p>{t}</p>" for t in lines) + "<div>all rights</div>"

    story, passage = [words(30, "ijklmnop") for _ in range(4)], words(25, "uvwxyz")
    texts = {1: ["Title", *story, "3 May"], 2: ["Title", *story, "4 May"], 3: [words(40), passage], 4: [words(40), passage], 5: [words(40)],
             6: ["Short", *story[:2], "5 May"], 7: ["Short", *story[:2], "6 May"]}
    at = {i: f"http://{'h' if i < 6 else 'two'}/{i}" for i in texts}
    got = {r.page_id: r.text.split("\n") for r in page_text.extract(spark.createDataFrame(
        [(i, at[i], page(*t)) for i, t in texts.items()], "page_id long, url string, html string")).collect()}
    assert all(got[i] == texts[i] for i in range(1, 6))
    assert all(set(texts[i]) <= set(got[i]) for i in (6, 7))  # two pages, all but a line shared: nothing tells the menu


@pytest.mark.parametrize("page", [
    "<div class='content-sidebar-wrap'><main><article>{}</article></main></div>", "<div class='site has-sidebar'><article>{}</article></div>",
    "<div class='wrapper fixed-header'><article>{}</article></div>", "<form id='aspnetForm'><div role='main'>{}</div></form>",
    "<form id='aspnetForm'><label>name</label><article>{}</article></form>", "<form id='aspnetForm'><nav>menu</nav><div>{}</div></form>",
    "<div class='site has-sidebar'><div>{}</div><div class='sidebar'>side</div></div>", "<fieldset><main>{}</main></fieldset>",
    "<div class='cookies-not-set'><header>h</header><div>{}</div></div>", "<div class='sidebar'><main>{}</main></div>",
    "<p>top</p><main><form id='aspnetForm'>{}</form></main>"])
def test_page_text_in_containers(page):
    assert page_text.main_text(page_text.page_lines(page.format("<h1>t</h1><p>a <b>b</b></p>")), None)[0] == "t\na b"


@pytest.mark.parametrize("part", [
    "<aside><article>x</article></aside>", "<div id='comments'><article>x</article></div>", "<div class='post-comments'><article>x</article></div>",
    "<div class='site-header'>x</div>", "<div class='sidebar'><article>x</article></div>", "<form>x</form>", "<div hidden><main>x</main></div>",
    "<article class='related'>x</article>", "<article>y<div class='share-buttons'>x</div></article>"])
def test_page_text_without_other_parts(part):
    for page in (f"<article>y</article>{part}", f"{part}<main>y</main>"):
        assert set(page_text.main_text(page_text.page_lines(page), None)[0]) <= {"y", "\n"}


def test_licenses(spark):
    mit = "Copyright (c) 2020 Someone\n" + dict(reversed(licenses.KNOWN))["ISC"].upper().replace(",", " ;")
    rows = [(1, mit, "en"), (2, "x\nreleased under the  MIT Licence", "en"), (3, None, "en"), (4, "", "en"), (5, "free text", "en"), (5, "free text", "en")]
    got = Counter((r.doc_id, r.text_license, r.line_licenses) for r in licenses.scan(docs_of(spark, rows)).collect())
    assert got == Counter([(1, "ISC", None), (2, None, "MIT"), (3, None, None), (4, None, None), (5, None, None), (5, None, None)])


BSD3_FILE = """BSD 3-Clause License

{}
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""


def test_licenses_of_standard_files(spark):
    mit = dict(licenses.KNOWN[:-1])["MIT"]
    notices = ("Copyright (c) 2024, Someone", "(c) 2024 Someone", "\u00a9 Someone 2024", "Copyright \u00a9 2024 Someone", "Copyright Someone")
    rows = [(i, BSD3_FILE.format(n), "en") for i, n in enumerate(notices)]
    rows += [(20 + i, f"{t}\n\n(c) 2024 Someone\n\n{mit}", "en") for i, t in enumerate(("MIT License", "The MIT License (MIT)"))]
    rows += [(30, "some words\nAll rights reserved.", "en"), (31, "(c) 2024 Someone", "en")]
    want = {**{i: "BSD-3-Clause" for i in range(len(notices))}, 20: "MIT", 21: "MIT", 30: None, 31: None}
    shared = Path("/usr/share/common-licenses")
    for i, (f, name) in enumerate((("Apache-2.0", "Apache-2.0"), ("GPL-3", "GPL-3.0-only"), ("MPL-2.0", "MPL-2.0"))):
        if (shared / f).exists():
            rows.append((40 + i, (shared / f).read_text(), "en"))
            want[40 + i] = name
    got = {r.doc_id: r for r in licenses.scan(docs_of(spark, rows)).collect()}
    assert {i: r.text_license for i, r in got.items()} == want
    assert got[30].line_licenses == got[0].line_licenses == "LicenseRef-all-rights-reserved"


def test_token_counts_equal_the_public_tokenizer(spark):
    from tokenizers import Tokenizer, models, pre_tokenizers

    vocabulary, unknown = token_counts.load_vocabulary()
    public = Tokenizer(models.Unigram(vocabulary, unknown, True))
    public.pre_tokenizer = pre_tokenizers.Metaspace(replacement=token_counts.MARK, prepend_scheme="always", split=True)
    texts = ["", " ", "  a  b", "<s>hi</s>", "日本語😀😀 x", "▁▁a ▁b", "\n\n\t", "ᚠᚢ abc ᚠ", "x" * 20000]
    texts += ["".join(RNG.choice("ab eé▁ \n😀ᚠtheingon") for _ in range(RNG.randrange(40))) for _ in range(500)]
    rows = [(i, t, "en") for i, t in enumerate(texts)] + [(9999, None, "en")]
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs_of(spark, rows)).collect()}
    assert got == {**{i: len(public.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}, 9999: 0}


def test_mixing_meets_targets(spark):
    rows = [(i, words(30, "abcd") + (" scum trash" if i % 5 == 0 else " fine good" if i % 5 < 4 else " poor weak"), "en") for i in range(200)]
    rows += [(900, None, "en"), (901, "", "en"), (None, "fine good", "en"), (3, rows[3][1], "en")]
    labels = spark.createDataFrame([(i, int(i % 5 < 4), int(i % 5 == 0)) for i in range(100)] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    out = mixing.mix(docs_of(spark, rows), labels).collect()
    assert len(out) == len(rows) and all(r.rate >= 0 for r in out)
    # plain projected steps by brute force; soft memberships may leave the targets out of reach, and the last part converges slowly
    domains = sorted(mixing.TARGETS)
    n, soft = np.array([r.n_tokens for r in out]), np.array([[r[f"p_{d}"] for d in domains] for r in out])
    goal, share = np.array([mixing.TARGETS[d] for d in domains]), n / n.sum()
    rate = np.ones(len(out))
    for _ in range(500):
        rate = np.maximum(0, rate - soft @ (soft.T @ (rate * share) - goal))
    off = [np.linalg.norm(soft.T @ (x * share) - goal) for x in (np.array([r.rate for r in out]), rate, np.ones(len(out)))]
    assert off[0] <= off[1] + 0.002 and off[0] < off[2]
    by_id = {r.doc_id: r for r in out}
    assert by_id[150].p_toxic > by_id[151].p_toxic and by_id[154].p_low > by_id[151].p_low
    assert {r.rate for r in out if r.doc_id in (900, 901)} <= {r.rate for r in out}
    assert mixing.mix(docs_of(spark, rows).limit(0), labels.limit(0)).count() == 0
