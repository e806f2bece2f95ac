"""Main text of web pages by differencing each page with its nearest URL.

A page's html is cut into text blocks (lines) in page order. Pages are sorted by host and URL
path; each is paired with the neighbour of its host that shares the longer start of its path
(the one before, if equal), the two lists of lines are aligned by longest common
subsequence, and shared lines are deleted as the site's boilerplate.

Differencing alone gives wrong results where articles repeat (copies and common passages
would go) and where a page's menus and adverts are its own (nothing is shared), so the
page's markup has a say: a line inside ``article``, ``main`` or role=main is never deleted as shared,
lines outside go if the page has such a part, and parts that are marked as menus, headers,
footers, sidebars, notices, adverts, forms, comments, scripts or styles go anywhere. A form, or an
element with such a word as a part of a class name only (fixed-header, cookies-not-set), may be a
container of the page: an ``article`` in it is kept, and so is its text if the page has no other. ``main``
and role=main are kept in any element that is not hidden. What
is left to the alignment are the unmarked lines of pages without a marked article. Of these a
shared line goes only if it is on MANY pages of the host and on more of them than the page's own
text is, so near copies and passages that two pages have in common stay. A host of fewer pages has
nothing to count: there short shared lines go if all that is shared is short. A page
all of whose lines are shared is a copy, not boilerplate: it keeps them.

Null or empty html gives an empty text; repeated rows get equal texts; a null URL has no
neighbour; pages and attributes of any length are read whole; an empty table gives no rows; other columns
are not read, so their names can't clash.
"""

from __future__ import annotations

import hashlib
import html as entities
import re

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewell.llm.common import map_batches, materialise

# Fixed names of HTML and of common page templates.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td
    tfoot th thead tr ul""".split())
RAW = frozenset("script style textarea title noscript template xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROP = frozenset("nav header footer aside form button select option menu dialog head svg math object canvas audio video map label fieldset".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form".split())
DROP_WORDS = frozenset("""ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies
    consent gdpr notice notices notification alert sidebar sidenav menu menubar nav navbar navigation breadcrumb breadcrumbs footer header
    masthead topbar comment comments disqus replies reply respond share sharing social related recommended newsletter subscribe
    subscription signup login popup modal overlay paywall widget pagination pager toolbar""".split())
# Those of them that mark parts with articles of their own, which are not the page's.
MINOR_WORDS = frozenset("""ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promotion comment comments
    disqus replies reply respond related recommended""".split())
STATES = ("has", "with", "no", "without", "content")  # has-sidebar, content-sidebar-wrap: what a container has, not what it is
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

_ATTR = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")
MANY = 3  # pages of a host that hold a line of the site's furniture, at least
LINE_WORDS, COPY_WORDS = 12, 50  # words of a sentence, and of shared lines that are a copy's, at least
PAGE = 0  # stands for a line that every page has
BITS = 1 << 26  # bits of alignment rows that are held at once

OUTSIDE, PLAIN, ARTICLE, DOUBTFUL, INSIDE = 0, 1, 2, 3, 4  # what the markup says of a line
STAYS, MAYBE, GOES, HIDDEN = 0, 1, 2, 3  # what it says of an element: whether its text goes


def _tag_end(page: str, at: int, closed: dict[str, int]) -> int:
    """Index after the tag that starts at ``at``: the next > outside quotes, or the next > at all. ``closed`` notes
    for the page from where on a quote has none that closes it, so that this is searched once."""
    plain = page.find(">", at)
    end = plain
    pos = at
    while 0 <= end:
        quotes = [q for q in (page.find('="', pos, end), page.find("='", pos, end)) if q >= 0]
        if not quotes:
            return end + 1
        q = min(quotes) + 1
        close = page.find(page[q], q + 1) if q < closed.get(page[q], len(page)) else -1
        if close < 0:
            closed[page[q]] = min(q, closed.get(page[q], q))
            break
        pos = close + 1
        if close > end:
            end = page.find(">", pos)
    return plain + 1 if plain >= 0 else len(page)


def _class_drops(value: str) -> int:
    """STAYS, MAYBE or GOES for the value of a class or id."""
    drop = STAYS
    for name in value.split():
        if name in DROP_WORDS:
            return GOES
        words = [w for w in re.split(r"[^a-z0-9]+", name) if w]
        if words and words[0] not in STATES:
            if any(w in MINOR_WORDS for w in words):
                return GOES
            if any(w in DROP_WORDS for w in words):
                drop = MAYBE
    return drop


def _dropped(name: str, tag: str) -> tuple[int, int]:
    """(whether the element's text goes, whether it is the article: 0, 1 for article, 2 for main) from name
    and attributes."""
    main = 2 if name == "main" else 1 if name == "article" else 0
    drop = MAYBE if name == "form" else GOES if name in DROP else STAYS
    if "=" not in tag and "hidden" not in tag:
        return drop, main
    for m in _ATTR.finditer(tag, len(name) + 1):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key == "role":
            if value in DROP_ROLES:
                drop = max(drop, MAYBE if value == "form" else GOES)
            if value == "main":
                main = 2
        elif key in ("class", "id") and name not in ("body", "html", "article", "main"):
            drop = max(drop, _class_drops(value))
        elif key in ("class", "id") and name == "article":
            if any(w in ("comment", "comments", "reply", "related", "ad", "ads", "promo", "advert") for w in re.split(r"[^a-z0-9]+", value)):
                drop = max(drop, GOES)
        elif key == "hidden" or (key == "aria-hidden" and value == "true"):
            drop = HIDDEN
    return drop, main


def page_lines(page: str | None) -> list[tuple[str, int]]:
    """(text, OUTSIDE / PLAIN / ARTICLE / DOUBTFUL / INSIDE: doubtful in the article) of the text blocks of a page in order."""
    lines: list[tuple[str, int]] = []
    closed: dict[str, int] = {}
    held: list[str] = []
    stack: list[tuple[str, int, bool]] = []  # open elements: name, whether the text goes, in the article
    if not page:
        return lines

    def flush() -> None:
        if held:
            text = _SPACE.sub(" ", entities.unescape("".join(held))).strip()
            held.clear()
            if text:
                gone, main = stack[-1][1:] if stack else (STAYS, False)
                kind = OUTSIDE if gone > MAYBE else (INSIDE if main else DOUBTFUL) if gone else ARTICLE if main else PLAIN
                lines.append((text, kind))

    at, n = 0, len(page)
    while at < n:
        tag = page.find("<", at)
        if tag < 0:
            held.append(page[at:])
            break
        if tag > at:
            held.append(page[at:tag])
        c = page[tag + 1:tag + 2]
        if page.startswith("<!--", tag):
            end = page.find("-->", tag + 4)
            at = end + 3 if end >= 0 else n
            continue
        if c in ("!", "?"):
            end = page.find(">", tag)
            at = end + 1 if end >= 0 else n
            continue
        close = c == "/"
        first = page[tag + 2:tag + 3] if close else c
        if not (first.isascii() and first.isalpha()):
            if close:  # a bogus comment
                end = page.find(">", tag)
                at = end + 1 if end >= 0 else n
            else:
                held.append("<")
                at = tag + 1
            continue
        at = _tag_end(page, tag, closed)
        inner = page[tag + 1 + close:at - (page[at - 1] == ">")]
        name = re.match(r"[^\s/>]+", inner)[0].lower()
        if name in BLOCKS:
            flush()
        elif name == "br":
            held.append(" ")
        if close:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    if any(s[1] for s in stack[i:]) or name not in BLOCKS:
                        flush() if name in BLOCKS or stack[i][1] else None
                    del stack[i:]
                    break
            continue
        if name in RAW:
            if name == "noscript" or not inner.endswith("/"):
                end = re.compile(f"</{re.escape(name)}[\\s/>]", re.I).search(page, at)
                at = n if end is None else _tag_end(page, end.start(), closed)
            continue
        if name in VOID or inner.endswith("/") and name not in BLOCKS:
            continue
        if name in CLOSES and stack and stack[-1][0] in CLOSES[name]:
            stack.pop()
        elif name in BLOCKS:  # a block ends an open paragraph
            while stack and stack[-1][0] == "p":
                stack.pop()
        gone, main = _dropped(name, inner)
        up = stack[-1] if stack else ("", STAYS, False)
        # a container's flag ends at the article, any other part's at main; nothing hidden is shown
        kept = up[1] if up[1] == HIDDEN or main < min(up[1], 2) else STAYS
        if max(gone, kept) != up[1] and name not in BLOCKS:
            flush()
        stack.append((name, max(gone, kept), bool(main) or up[2]))
    flush()
    return lines


def _bit_rows(a: list[int], b: list[int]) -> list[int]:
    """Bit-parallel rows of the longest-common-subsequence table; bit j of row i is 0 where the
    length grows at b[j] for the first i elements of a."""
    places: dict[int, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row, rows = full, [full]
    for x in a:
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    return rows


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Longest common subsequence of all of ``a`` with each start of ``b``."""
    places: dict[int, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[:len(b)]
    return np.concatenate([[0], np.cumsum(bits == 0)])


def aligned(a: list[int], b: list[int]) -> set[int]:
    """Indexes of ``a`` in one longest common subsequence of a and b. Long lists are halved where
    the two halves' lengths add up best, so memory stays within BITS."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    out = set(range(start)) | set(range(len(a) - end, len(a)))
    x, y = a[start:len(a) - end], b[start:len(b) - end]
    if not x or not y or not set(x) & set(y):
        return out
    if len(x) * len(y) > BITS and len(x) > 1:
        half = len(x) // 2
        total = _lengths(x[:half], y) + _lengths(x[half:][::-1], y[::-1])[::-1]
        cut = int(total.argmax())
        found = aligned(x[:half], y[:cut]) | {half + i for i in aligned(x[half:], y[cut:])}
    else:
        rows, found, i, j = _bit_rows(x, y), set(), len(x), len(y)
        while i and j:
            if not rows[i] >> (j - 1) & 1 and rows[i - 1] >> (j - 1) & 1 and x[i - 1] == y[j - 1]:
                found.add(i - 1)
                i, j = i - 1, j - 1
            elif rows[i] >> (j - 1) & 1:
                j -= 1
            else:
                i -= 1
    return out | {start + i for i in found}


def _hash(line: str) -> int:
    return int.from_bytes(hashlib.blake2b(line.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def shared_start(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def neighbours(keys: DataFrame) -> DataFrame:
    """(key, mate): the row of the same host whose path is nearest, null if there is none. Rows are
    range-partitioned by host, path and key, so a host of any size is spread; the ends of the
    ranges (two rows a range) are matched across ranges."""
    me = F.struct("host", "path", "key")
    laid = materialise(keys.repartitionByRange("host", "path", "key").withColumn("part", F.spark_partition_id()), "page_text")
    inside = Window.partitionBy("part").orderBy("host", "path", "key")
    ends = laid.groupBy("part").agg(F.min(me).alias("low"), F.max(me).alias("high"))
    across = Window.partitionBy(F.lit(0)).orderBy("part")  # one row per range
    ends = ends.select("part", F.lag("high").over(across).alias("earlier"), F.lead("low").over(across).alias("later"))
    near = (laid.withColumn("prev", F.lag(me).over(inside)).withColumn("next", F.lead(me).over(inside)).join(F.broadcast(ends), "part")
            .withColumn("prev", F.coalesce("prev", "earlier")).withColumn("next", F.coalesce("next", "later")))
    near = near.select("key", "path", *(F.when(F.col(f"{s}.host") == F.col("host"), F.col(f"{s}.{c}")).alias(f"{s}_{c}")
                                        for s in ("prev", "next") for c in ("path", "key")))
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("mate", T.LongType())])

    def make():
        def fn(batch):
            mates = []
            for _, path, p_path, p_key, n_path, n_key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                before = shared_start(path, p_path) if p_key is not None else -1
                after = shared_start(path, n_path) if n_key is not None else -1
                mates.append(p_key if before >= after else n_key)
            yield {"key": batch.column(0), "mate": mates}
        return fn

    return map_batches(near, schema, make)


def furniture(shared: list[int], lines: list[int], words: list[int], pages: dict[int, int]) -> list[int]:
    """The shared line numbers of a page without a marked article that are the site's. ``words`` counts
    the words that may be the page's text, ``pages`` the pages of the host that hold a line, from MANY on."""
    if PAGE not in pages:
        return [i for i in shared if words[i] < LINE_WORDS] if sum(words[i] for i in shared) < COPY_WORDS else []
    text = [i for i, w in enumerate(words) if w >= LINE_WORDS] or range(len(words))
    # the page's own text is on so many pages: the least count that a quarter of its words do not exceed
    own, seen, total = 0, 0, sum(words[i] for i in text)
    for own, n in sorted((pages.get(lines[i], 0), words[i]) for i in text):
        seen += n
        if 4 * seen >= total:
            break
    return [i for i in shared if pages.get(lines[i], 0) > own]


def host_counts(cut: DataFrame) -> DataFrame:
    """(key, counts): for every page without a marked article those of its lines, and PAGE, that are on MANY pages
    of its host or more, with the number of pages."""
    bare = cut.where("host is not null and not marked")
    line = F.explode(F.array_distinct(F.concat("lines", F.array(F.lit(PAGE).cast("long"))))).alias("line")
    many = (cut.join(bare.select("host").distinct(), "host", "left_semi").select("host", line)
            .groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= MANY))
    return (bare.select("key", "host", line).join(many, ["host", "line"]).groupBy("key")
            .agg(F.collect_list(F.struct("line", "n")).alias("counts")))


def boilerplate(pages: DataFrame) -> DataFrame:
    """(key, shared): for every distinct row (key, url, html) the line numbers that its nearest page
    shares; without a marked article, those of them that are the site's furniture."""
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("host", T.StringType()), T.StructField("path", T.StringType()),
                           T.StructField("lines", T.ArrayType(T.LongType())), T.StructField("marked", T.BooleanType()),
                           T.StructField("words", T.ArrayType(T.IntegerType()))])

    def make():
        def fn(batch):
            hosts, paths, lines, marks, words = [], [], [], [], []
            for url, page in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                m = re.match(r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)([^?#]*)", url or "")
                hosts.append(m[1].lower() if m else None)
                paths.append(m[2] if m else None)
                cut = page_lines(page)
                lines.append([_hash(t) for t, _ in cut])
                marks.append(marked(cut) != 0)
                words.append(None if marks[-1] else [0 if mark == OUTSIDE else len(t.split()) for t, mark in cut])
            yield {"key": batch.column(0), "host": hosts, "path": paths, "lines": lines, "marked": marks, "words": words}
        return fn

    cut = materialise(map_batches(pages, schema, make), "page_text").dropDuplicates(["key"])
    mates = neighbours(cut.where("host is not null").select("host", "path", "key")).where("mate is not null")
    both = (mates.join(cut.select("key", "lines", "words"), "key").join(host_counts(cut), "key", "left")
            .join(cut.select(F.col("key").alias("mate"), F.col("lines").alias("others")), "mate")
            .select("key", "lines", "others", "words", "counts"))
    out = T.StructType([T.StructField("key", T.LongType()), T.StructField("shared", T.ArrayType(T.IntegerType()))])

    def align():
        def fn(batch):
            got = []
            for a, b, words, counts in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                shared = sorted(aligned(a, b))
                got.append(shared if words is None else furniture(shared, a, words, {c["line"]: c["n"] for c in counts or ()}))
            yield {"key": batch.column(0), "shared": got}
        return fn

    return map_batches(both, out, align).where("size(shared) > 0")


def marked(lines: list[tuple[str, int]]) -> int:
    """The kind of a page's lines that are its marked article (a form may hold all of it), or 0."""
    return next((kind for kind in (ARTICLE, INSIDE) if any(mark == kind for _, mark in lines)), 0)


def main_text(lines: list[tuple[str, int]], shared: list[int] | None) -> tuple[str, int]:
    """(text, lines deleted as shared) of a page."""
    kind = marked(lines)
    if kind:
        return "\n".join(t for t, mark in lines if mark == kind), len(shared or ())
    gone = set(shared or ())
    if len(gone) == len(lines):
        gone = set()
    kind = PLAIN if any(mark == PLAIN for _, mark in lines) else DOUBTFUL
    return "\n".join(t for i, (t, mark) in enumerate(lines) if mark == kind and i not in gone), len(gone)


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars, n_shared."""
    keyed = pages.select(F.xxhash64("page_id", "url", "html").alias("key"), "page_id", "url", "html")
    shared = materialise(boilerplate(keyed.select("key", "url", "html")), "page_text")
    schema = T.StructType([T.StructField("page_id", pages.schema["page_id"].dataType), T.StructField("url", T.StringType()),
                           T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("n_shared", T.LongType())])

    def make():
        def fn(batch):
            got = [main_text(page_lines(page), gone) for page, gone in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield {"page_id": batch.column(0), "url": batch.column(1), "text": [t for t, _ in got],
                   "n_chars": [len(t) for t, _ in got], "n_shared": [n for _, n in got]}
        return fn

    return map_batches(keyed.join(shared, "key", "left").select("page_id", "url", "html", "shared"), schema, make)
