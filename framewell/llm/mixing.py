"""Mixing sources to target weights by soft membership; DataFrame and SQL functions only.

A multinomial classifier over hashed lower-case words, fitted on at most ``MAX_LABELLED``
rows of the labelled table (documented bound, chosen by hash of doc_id), gives every
document posterior domain memberships; the log-likelihood is divided by the square root of
the word count, which keeps memberships soft for long texts. Then nonnegative document
rates are fitted by least squares so that the expected words of each domain (rate x
words x membership) match the targets: accelerated projected gradient from rate 1, in the
metric of the documents' words. A step needs only the domains' sums, one distributed
aggregate; steps are replayed on each row and the state is written every ``SPAN`` steps.

A null or empty text has no words, prior memberships and rate 1. Without labelled rows
memberships are equal. Repeated rows count each; a null doc_id is a document like any
other but has no label. Labels of one document are combined by their largest values. An
empty table gives no rows. ``with_rates`` replaces columns mix_rate and mix_copies and keeps all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewell.llm.common import fresh, materialise

DOMAINS = ("high", "low", "toxic")
TARGETS = {"high": 0.80, "low": 0.18, "toxic": 0.02}
BUCKETS = 4096
SHRINK = 100.0  # words that the distribution of all domains weighs in each
MAX_LABELLED = 20_000
STEPS, SPAN = 60, 10
TOLERANCE = 1e-4


def label_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the labelled documents: toxic, else high or low quality."""
    one = labels.where("doc_id is not null and (quality is not null or toxic is not null)").groupBy("doc_id").agg(
        F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    return one.select("doc_id", F.when(F.col("toxic") > 0, "toxic").when(F.col("quality") > 0, "high").otherwise("low").alias("domain"))


def _buckets(text: str) -> Column:
    """The buckets of a text's lower-case white-space words, in order. White space becomes blanks first, so that
    the split needs no regular expression."""
    flat = F.lower(F.coalesce(text, F.lit("")))
    for c in "\t\n\x0b\x0c\r":
        flat = F.replace(flat, F.lit(c), F.lit(" "))
    words = F.filter(F.split(flat, " "), lambda w: w != "")
    return F.transform(words, lambda w: F.pmod(F.hash(w), F.lit(BUCKETS)))


def fit_classifier(docs: DataFrame, labelled: DataFrame, domains=DOMAINS, most: int = MAX_LABELLED) -> tuple[DataFrame, list[float]]:
    """(model, priors): model has BUCKETS rows (bucket, one log-probability column per domain), whatever
    the input. ``labelled`` is (doc_id, domain)."""
    known = labelled.where(F.col("domain").isin(*domains))
    n = known.count()
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < int(1_000_003 * min(1.0, most / max(n, 1))) + (n <= most))
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most about MAX_LABELLED small rows
    counts = sample.select("domain", F.explode(_buckets("text")).alias("bucket")).groupBy("bucket").agg(
        *(F.sum(F.when(F.col("domain") == d, 1).otherwise(0)).alias(d) for d in domains))
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    full = materialise(every.join(counts, "bucket", "left").na.fill(0), "mixing")
    total = full.agg(*(F.sum(d).alias(d) for d in domains)).first()
    # every domain shrinks towards the words of all, so a small one isn't at a disadvantage
    shared = (sum((F.col(d) for d in domains), F.lit(0.5))) / (sum(total[d] for d in domains) + 0.5 * BUCKETS)
    model = materialise(full.select("bucket", *(F.log((F.col(d) + SHRINK * shared) / (total[d] + SHRINK)).alias(d) for d in domains)), "mixing")
    size = {r.domain: r.n for r in chosen.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    every_doc = sum(size.values()) + len(domains)
    return model, [(size.get(d, 0) + 1) / every_doc for d in domains]


def memberships(docs: DataFrame, model: DataFrame, priors: list[float], domains=DOMAINS) -> DataFrame:
    """(doc_id, digest, n_tokens, p_<domain>...) of every row; ``digest`` is the text's hash. A projection: the
    model's BUCKETS rows are array literals, looked up by bucket."""
    by_bucket = sorted(model.collect(), key=lambda r: r["bucket"])
    words = docs.select("doc_id", F.xxhash64("text").alias("digest"), _buckets("text").alias("at"))

    def summed(domain):
        table = F.array(*(F.lit(float(r[domain])) for r in by_bucket))
        return F.aggregate("at", F.lit(0.0), lambda total, i: total + F.get(table, i))

    scored = words.select("doc_id", "digest", F.size("at").cast("long").alias("n_tokens"), *(summed(d).alias(d) for d in domains))
    log = [F.log(F.lit(w)) + F.col(d) / F.sqrt(F.greatest("n_tokens", F.lit(1))) for d, w in zip(domains, priors, strict=True)]
    top = F.greatest(*log) if len(log) > 1 else log[0]
    parts = scored.select("doc_id", "digest", "n_tokens", *(F.exp(x - top).alias(d) for d, x in zip(domains, log, strict=True)))
    whole = sum((F.col(d) for d in domains[1:]), F.col(domains[0]))
    return parts.select("doc_id", "digest", "n_tokens", *((F.col(d) / whole).alias(f"p_{d}") for d in domains))


def _replay(steps: list[tuple[float, list[float]]], domains) -> Column:
    """The pair (rate, rate before) after more steps (momentum, domain forces)."""
    if not steps:
        return F.col("state")
    moves = F.array(*(F.struct(F.lit(m).alias("m"), *(F.lit(f).alias(d) for f, d in zip(force, domains, strict=True))) for m, force in steps))

    def move(s, x):
        ahead = s["rate"] + x["m"] * (s["rate"] - s["before"])
        push = sum((x[d] * F.col(f"p_{d}") for d in domains[1:]), x[domains[0]] * F.col(f"p_{domains[0]}"))
        return F.struct(F.greatest(F.lit(0.0), ahead - push).alias("rate"), s["rate"].alias("before"))

    return F.aggregate(moves, F.col("state"), move)


def fit_rates(soft: DataFrame, targets: dict[str, float], domains=DOMAINS, steps: int = STEPS, tolerance: float = TOLERANCE) -> DataFrame:
    """``soft`` with a column ``rate``: minimises the squared difference between the domains' expected
    words and their target share of all words."""
    p = [F.col(f"p_{d}") for d in domains]
    k = range(len(domains))
    n = F.col("n_tokens")
    first = soft.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), *(F.coalesce(F.sum(n * p[i] * p[j]), F.lit(0.0)) for i in k for j in k)).first()
    total = max(float(first[0]), 1.0)
    gram = [[first[1 + i * len(domains) + j] / total for j in k] for i in k]
    length = 1.0 / max(max(sum(map(abs, row)) for row in gram), 1e-12)  # 1 / bound of the largest eigenvalue
    goal = [targets[d] / sum(targets.values()) * total for d in domains]
    state = materialise(soft.withColumn("state", F.struct(F.lit(1.0).alias("rate"), F.lit(1.0).alias("before"))), "mixing")
    done: list[tuple[float, list[float]]] = []
    t = 1.0
    for step in range(1, steps + 1):
        t, last = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        momentum = (last - 1) / t
        if len(done) == SPAN:
            state = materialise(state.withColumn("state", _replay(done, domains)), "mixing")
            done = []
        now = state.withColumn("state", _replay(done, domains))
        ahead = F.col("state.rate") + momentum * (F.col("state.rate") - F.col("state.before"))
        sums = now.agg(*(F.coalesce(F.sum(ahead * n * q), F.lit(0.0)) for q in p)).first()
        off = [(s - g) / total for s, g in zip(sums, goal, strict=True)]
        if step > 1 and max(map(abs, off)) < tolerance:
            break
        done.append((momentum, [length * x for x in off]))
    return state.withColumn("state", _replay(done, domains)).withColumn("rate", F.col("state.rate")).drop("state")


def copies(rate: Column, row: Column) -> Column:
    """Whole copies whose expectation over rows is the rate: its floor, and one more for a hash
    below its fraction."""
    draw = F.pmod(F.xxhash64(row, F.lit("copies")), F.lit(1_000_003)) / F.lit(1_000_003.0)
    return (F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")).cast("long")


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, digest, n_tokens, p_<domain>..., rate, copies."""
    domains = tuple(sorted(targets))
    model, priors = fit_classifier(docs, label_domains(labels), domains)
    soft = materialise(memberships(docs, model, priors, domains), "mixing")
    rated = fit_rates(soft, targets, domains)
    return rated.withColumn("copies", copies(F.col("rate"), F.coalesce(F.col("doc_id"), F.col("digest"))))


def with_rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """The rows of ``docs`` with ``mix_rate`` and ``mix_copies`` (replacing such columns); rows of no copy go."""
    doc, digest = fresh("doc"), fresh("digest")
    rated = materialise(mix(docs, labels, targets).dropDuplicates(["doc_id", "digest"])
                        .select(F.col("doc_id").alias(doc), F.col("digest").alias(digest),
                                F.col("rate").alias("mix_rate"), F.col("copies").alias("mix_copies")), "mixing")
    plain = docs.drop("mix_rate", "mix_copies")
    same = plain["doc_id"].eqNullSafe(rated[doc]) & F.xxhash64(plain["text"]).eqNullSafe(rated[digest])
    return plain.join(rated.hint("merge"), same).where("mix_copies > 0").drop(doc, digest)
