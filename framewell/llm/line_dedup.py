"""Line deduplication by range-partitioned hashes; DataFrame and SQL functions only.

A line's key is the line without the ASCII white space at its ends, A-Z in lower case. Keys of
at least ``least`` code points found in at least ``copies`` documents lose all their lines
except those of the largest doc_id that holds the key.

The 128-bit hashes of the keys are range-partitioned and sorted by document (descending) and
position; in that order the first document of a hash is the one that keeps it, the others are
marked while the stream goes by. A hash with more than one in ``HOT`` of the lines (found in a
fixed hash sample of the lines, at most ``HOT`` of them; it steers the dealing alone, not the
result) is dealt by document to ``SLICES`` ranges, whose counts and last documents are
combined. What comes back per document is a compressed bitmap: one (word, bits) entry per
64 lines that hold a dropped line. Texts take part again only where lines are taken out.

Defined cases: a null or empty text is one empty line; rows of the same doc_id are one document when
documents are counted, and each keeps or loses its own lines; a row without doc_id
keeps all its lines and counts for nothing; an empty table gives no rows; other columns
pass through ``drop_lines`` (a column of the name of one it adds is replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewell.llm.common import fresh, materialise

LEAST, COPIES = 20, 3
HOT, SLICES, SAMPLE = 1000, 4096, 64
UPPER, LOWER, BLANK = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line's key. ``lower`` is the fast way where a line is ASCII only."""
    bare = F.btrim(line, F.lit(BLANK))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def line_hashes(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, digest, pos, h1, h2) of every line whose key has ``least`` code points or more;
    ``digest`` tells apart rows of one doc_id."""
    lines = docs.where("doc_id is not null and text is not null").select(
        "doc_id", F.xxhash64("text").alias("digest"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    keys = lines.where(F.length("line") >= least).select("doc_id", "digest", "pos", line_key(F.col("line")).alias("key"))
    return keys.where(F.length("key") >= least).select(
        "doc_id", "digest", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"))


def hot_hashes(hashes: DataFrame) -> DataFrame:
    """(h1, h2) of the at most ``HOT`` hashes with more than one in ``HOT`` of a fixed sample of lines."""
    sample = hashes.where(F.pmod(F.xxhash64("doc_id", "pos"), F.lit(SAMPLE)) == 0)
    return (sample.groupBy("h1", "h2").agg(F.count("*").alias("n"))
            .where(F.col("n") * HOT > sample.select(F.count("*")).scalar()).select("h1", "h2"))


def line_marks(docs: DataFrame, least: int = LEAST, copies: int = COPIES) -> DataFrame:
    """(doc_id, digest, drops) of every document row that loses a line; ``drops`` is its bitmap, an array of
    (word, bits) in ascending words: bit b of a word is line 64 * word + b."""
    hashes = materialise(line_hashes(docs, least), "lines")
    hot = hot_hashes(hashes).withColumn("hot", F.lit(True))
    dealt = hashes.join(F.broadcast(hot), ["h1", "h2"], "left").select(  # HOT rows at most
        "h1", "h2", F.when(F.col("hot"), 1 + F.pmod(F.xxhash64("doc_id"), F.lit(SLICES))).otherwise(0).alias("slice"),
        "doc_id", "digest", "pos")
    ranged = dealt.repartitionByRange("h1", "h2", "slice").sortWithinPartitions(
        "h1", "h2", "slice", F.desc("doc_id"), "digest", "pos")
    group = Window.partitionBy("h1", "h2", "slice")
    stream = group.orderBy(F.desc("doc_id"))
    seen = (ranged.withColumn("rank", F.dense_rank().over(stream)).withColumn("last", F.first("doc_id").over(stream))
            .withColumn("n", F.max("rank").over(group)))
    marked = materialise(seen.where((F.col("slice") > 0) | ((F.col("n") >= copies) & (F.col("rank") > 1))), "lines")
    whole = (marked.where("slice > 0").groupBy("h1", "h2", "slice").agg(F.max("n").alias("n"), F.max("last").alias("last"))
             .groupBy("h1", "h2").agg(F.sum("n").alias("hot_n"), F.max("last").alias("hot_last")))
    dropped = marked.join(F.broadcast(whole), ["h1", "h2"], "left").where(  # HOT rows at most
        (F.col("slice") == 0) | ((F.col("hot_n") >= copies) & (F.col("doc_id") < F.col("hot_last"))))
    words = dropped.groupBy("doc_id", "digest", F.floor(F.col("pos") / 64).cast("int").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, pos % 64))").alias("bits"))
    return words.groupBy("doc_id", "digest").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("drops"))


def dropped_lines(drops: str) -> Column:
    """The line numbers of a bitmap, ascending; none for null."""
    return F.expr(f"coalesce(flatten(transform({drops}, d -> transform("
                  f"filter(sequence(0, 63), b -> getbit(d.bits, b) = 1), b -> d.word * 64 + b))), array())")


def drop_lines(docs: DataFrame, least: int = LEAST, copies: int = COPIES) -> DataFrame:
    """The rows of ``docs`` with ``text`` less its dropped lines (null stays null where nothing goes), and
    n_lines (before), n_dropped and drops (the bitmap, null if nothing goes)."""
    parts, doc, digest, part = fresh("parts"), fresh("doc"), fresh("digest"), fresh("part")
    plain = docs.drop("n_lines", "n_dropped", "drops")
    marks = line_marks(docs, least, copies).select(F.col("doc_id").alias(doc), F.col("digest").alias(digest), "drops")
    both = plain.join(marks, (plain["doc_id"] == F.col(doc)) & (F.xxhash64(plain["text"]) == F.col(digest)), "left")
    # a generator, so that the split and the bitmap are computed once a row and not once a line
    split = both.withColumn(parts, F.array(F.struct(
        F.split(F.coalesce("text", F.lit("")), "\n").alias("lines"), dropped_lines("drops").alias("gone"))))
    rows = split.select(*(F.col(f"`{c}`") for c in plain.columns if c != "text"), "text", "drops", F.explode(parts).alias(part))
    kept = F.expr(f"array_join(transform(array_except(sequence(0, size({part}.lines) - 1), {part}.gone), i -> get({part}.lines, i)), '\n')")
    others = [f"`{c}`" for c in plain.columns]
    return rows.withColumn("text", F.when(F.col("drops").isNull(), F.col("text")).otherwise(kept)).select(
        *others, F.size(f"{part}.lines").cast("long").alias("n_lines"), F.size(f"{part}.gone").cast("long").alias("n_dropped"), "drops")


def dedup_sql(least: int = LEAST, copies: int = COPIES) -> str:
    """The per-document digest in SQL."""
    blank = "' ' || " + " || ".join(f"chr({c})" for c in (9, 10, 11, 12, 13))
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
l AS (SELECT r, doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, {blank}), '{UPPER}', '{LOWER}') AS key FROM l),
c AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= {least} GROUP BY key HAVING count(DISTINCT doc_id) >= {copies}),
m AS (SELECT k.*, coalesce(k.doc_id < c.last, FALSE) AS gone FROM k LEFT JOIN c ON k.key = c.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY r"""
