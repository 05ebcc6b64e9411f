"""Soft-membership mixing of a corpus to target domain weights.

The labelled table (quality, toxic) names the domain of some documents. A
multinomial logistic regression on hashed words, fitted on a bounded sample of
them, gives every document a posterior over domains. Nonnegative document rates
r are then fitted by projected gradient descent so that the expected token
totals of the domains,

    T_d = sum over documents of r_i * tokens_i * P(d | i),

match their targets in weighted least squares. Starting from r = 1 (the corpus
as it is), each step is one aggregate over a slim table of token counts and
posteriors; only the domain totals come to the driver.

DataFrame and pyspark.ml functions only: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludex.llm.common import columns_of, free_name, read_table, row_key
from ludex.session import stage_table

# Labelled documents used to fit the classifier, at most about (a hash of the
# id picks them), and the size of its feature space.
MAX_LABELLED = 20_000
FEATURES = 1 << 13
# Target weight of each domain as a multiple of its own share (then scaled to
# add up to 1), and the total as a multiple of the corpus' tokens.
MULTIPLES = {"good": 1.0, "good_toxic": 0.4, "bad": 0.4, "bad_toxic": 0.2}
BUDGET = 1.0
STEPS, KEEP_STEPS, TOLERANCE = 48, 8, 2e-4

# Fixed values.
SPACES = r"[\t-\r ]+"
WORD_ENDS = r'[\t-\r .,;:!?()"]+'
SYMBOLS = r"[#*$%&|<>]+"


def domain_of(quality: Column, toxic: Column) -> Column:
    return F.concat(F.when(quality > 0, "good").otherwise("bad"),
                    F.when(toxic > 0, "_toxic").otherwise(""))


def _featured(docs: DataFrame, *keep: str) -> DataFrame:
    """Token count (white-space words) and distinct word features. Texts are cut
    by regular expressions, which is cheaper than ``translate`` and a split."""
    cut = docs.withColumn("text", F.coalesce("text", F.lit("")))
    words = F.array_remove(F.split(F.lower("text"), WORD_ENDS), "")
    marked = F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))
    upper = F.length(F.regexp_replace("text", r"[^\p{Lu}]+", ""))
    edges = F.when(F.length("text") == 0, 1).otherwise(
        F.col("text").rlike(f"^{SPACES}").cast("int") + F.col("text").rlike(f"{SPACES}\\z").cast("int"))
    tokens = F.size(F.split("text", SPACES)) - edges
    cut = cut.select(*keep, words.alias("words"), marked.alias("marked"), upper.alias("upper"),
                     F.greatest(F.length("text"), F.lit(1)).alias("length"), tokens.alias("tokens"))
    cut = cut.withColumn("distinct", F.array_distinct("words"))
    size = F.greatest(F.size("words"), F.lit(1))
    flag = lambda name, value, *cuts: [F.when(value > c, F.lit(f"\x01{name}>{c}"))
                                       for c in cuts]
    flags = F.array_compact(F.array(*flag("marks", F.col("marked") / size, 0.05, 0.3),
                                    *flag("upper", F.col("upper") / F.col("length"), 0.2),
                                    *flag("repeat", 1 - F.size("distinct") / size, 0.6, 0.85)))
    return cut.select(*keep, F.col("tokens").cast("bigint").alias("n_tokens"),
                      F.concat("distinct", flags).alias("words"))


def _quotas(held: dict[str, int], most: int) -> dict[str, int]:
    """Rows to take of each domain, ``most`` in all: whole domains from the
    smallest on, as long as they hold no more than an equal part of what is left."""
    quotas, left = {}, most
    for i, (domain, n) in enumerate(sorted(held.items(), key=lambda h: (h[1], h[0]))):
        quotas[domain] = max(1, min(n, left // (len(held) - i)))
        left = max(0, left - quotas[domain])
    return quotas


def _sampled(named: DataFrame, held: dict[str, int], most: int) -> DataFrame:
    """At most about ``most`` rows of ``named`` (id, domain), by a hash of the
    id; at least one of each domain."""
    quotas, scale = _quotas(held, most), 1 << 40
    at = F.pmod(F.xxhash64("id"), F.lit(scale))
    share = F.lit(0).cast("bigint")
    for domain, n in held.items():
        share = F.when(F.col("domain") == domain, scale * quotas[domain] // n).otherwise(share)
    # The row of the lowest hash of a domain is in it whatever the share.
    first = (named.groupBy("domain").agg(F.min(F.struct(at.alias("at"), F.col("id"))).alias("f"))
             .select("f.id", "domain"))
    return named.where(at < share).unionByName(first.select("id", "domain")).distinct()


def posteriors(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED,
               features: int = FEATURES) -> tuple[DataFrame, list[str]]:
    """One row per document: doc_id, rk, n_tokens and p0, p1, ... for the
    domains returned (sorted names)."""
    docs = docs.select("doc_id", "text").withColumn("rk", row_key("doc_id", "text"))
    named = (labels.where("doc_id is not null and quality is not null and toxic is not null")
             .groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
             .select(F.col("doc_id").alias("id"), domain_of(F.col("q"), F.col("t")).alias("domain")))
    # All labels that name a document; equal ids are one label.
    known_ids = docs.select(F.col("doc_id").alias("id")).where("id is not null").distinct()
    named = stage_table(named.join(known_ids, "id", "left_semi"), "named")
    held = {r["domain"]: r["count"] for r in named.groupBy("domain").count().collect()}
    domains = sorted(held)
    sample = _sampled(named, held, max_labelled)
    counted = _featured(docs, "doc_id", "rk")
    if len(domains) < 2:  # nothing to tell apart
        return (stage_table(counted.select("doc_id", "rk", "n_tokens", F.lit(1.0).alias("p0")),
                            "posteriors"), domains or ["unlabelled"])
    number = F.array_position(F.array(*map(F.lit, domains)), F.col("domain")) - 1
    # The sample is bounded by max_labelled rows of two short columns.
    labelled = docs.join(F.broadcast(sample.withColumn("label", number.cast("double"))),
                         F.col("doc_id") == F.col("id"))
    known = _featured(labelled, "label")
    hashing = HashingTF(inputCol="words", outputCol="features", numFeatures=features, binary=True)
    train = stage_table(known, "labelled")
    # Rare domains weigh as much as common ones would at the square root; a row
    # of the sample stands for as many labels as its domain has for each.
    taken = {int(r["label"]): r["count"] for r in train.groupBy("label").count().collect()}
    total, rows = sum(held.values()), sum(taken.values())
    raw = {i: (held[d] / total / len(domains)) ** 0.5 / taken[i] for i, d in enumerate(domains)}
    scale = rows / sum(w * taken[i] for i, w in raw.items())
    weight = F.lit(1.0)
    for i, w in raw.items():
        weight = F.when(F.col("label") == i, w * scale).otherwise(weight)
    model = LogisticRegression(maxIter=25, regParam=0.002, weightCol="weight",
                               family="multinomial").fit(
        hashing.transform(train.withColumn("weight", weight)))
    scored = model.transform(hashing.transform(counted)).withColumn(
        "p", vector_to_array("probability"))
    return (stage_table(scored.select("doc_id", "rk", "n_tokens", *[
        F.col("p")[i].alias(f"p{i}") for i in range(len(domains))]), "posteriors"), domains)


def target_shares(domains: list[str], sizes: list[float],
                  targets: dict[str, float] | None) -> list[float]:
    """Target share of each domain; they add up to 1. ``targets`` are shares:
    unnamed domains share what the named ones leave, by size; targets of absent
    domains fall away. None: the multiples of ``MULTIPLES``."""
    if targets is None:
        raw = [s * MULTIPLES.get(d, 1.0) for d, s in zip(domains, sizes, strict=True)]
    else:
        free = sum(s for d, s in zip(domains, sizes, strict=True) if d not in targets)
        left = max(0.0, 1.0 - sum(targets.values()))
        raw = [targets[d] if d in targets else (left * s / free if free else 0.0)
               for d, s in zip(domains, sizes, strict=True)]
    total = sum(raw)
    return [x / total for x in raw] if total else [1.0 / len(domains)] * len(domains)


def fit_rates(post: DataFrame, domains: list[str], targets: dict[str, float] | None = None,
              budget: float = BUDGET, steps: int = STEPS) -> tuple[DataFrame, list[float]]:
    """(``post`` with the fitted ``rate`` of each row, the expected domain totals
    it gives, as shares of the corpus' tokens).

    Minimises 1/2 sum_d w_d (T_d / N - target_d)^2 over r >= 0 with w_d the
    inverse of the domain's share, in the metric in which a document counts by
    its tokens. The gradient of a document then is sum_d w_d e_d P(d | i), the
    Hessian's largest eigenvalue is 1, and a step of length 1 is safe. The
    rates are written every ``KEEP_STEPS`` steps; between, the steps taken are
    an array in the plan (data, not code: every step runs the same plan)."""
    p = [F.col(f"p{i}") for i in range(len(domains))]
    rated, slopes = post.withColumn("rate", F.lit(1.0)), []

    def stepped() -> DataFrame:
        if not slopes:
            return rated
        rows = F.array(*[F.array(*map(F.lit, s)) for s in slopes])
        return rated.withColumn("rate", F.aggregate(rows, F.col("rate"), lambda r, s: F.greatest(
            F.lit(0.0), r - sum((s[i] * x for i, x in enumerate(p)), F.lit(0.0)))))

    def totals() -> tuple[list[float], float]:
        row = stepped().agg(F.sum("n_tokens"),
                            *[F.sum(F.col("n_tokens") * F.col("rate") * x) for x in p]).first()
        n = float(row[0] or 0)
        return [float(x or 0.0) / n if n else 0.0 for x in row[1:]], n

    sizes, n = totals()
    goal = [budget * t for t in target_shares(domains, sizes, targets)]
    now = sizes
    for _ in range(steps if n else 0):
        error = [a - b for a, b in zip(now, goal, strict=True)]
        if max(map(abs, error)) < TOLERANCE:
            break
        slopes.append([e / s if s > 1e-9 else 0.0 for e, s in zip(error, sizes, strict=True)])
        now, _ = totals()
        if len(slopes) == KEEP_STEPS:
            rated, slopes = stage_table(stepped(), "rates"), []
    return stepped(), now


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None,
        budget: float = BUDGET, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``docs`` (doc_id, text), ``labels`` (doc_id, quality, toxic) -> one row
    per document: doc_id, rk, n_tokens, domain (the most probable), p_domain
    (its probability), rate, copies (whole copies to take: the rate, rounded up
    or down by a hash of the row so that the expectation is the rate).

    Cases: NULL and empty texts have no tokens but a rate like others. Label
    rows with a NULL are left out; of several rows for a document the worst
    quality and the worst toxicity count. With labels of one domain or none,
    all documents are of one domain. Equal rows have one rate, each. Other
    columns are ignored. An empty table gives an empty table."""
    return mix_with_totals(docs, labels, targets, budget, max_labelled)[0]


def mix_with_totals(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None,
                    budget: float = BUDGET,
                    max_labelled: int = MAX_LABELLED) -> tuple[DataFrame, dict[str, float]]:
    """``mix`` and the expected token total of each domain that its rates reach,
    as shares of the corpus' tokens (targets that no nonnegative rates meet are
    met as nearly as the least squares allow)."""
    post, domains = posteriors(docs, labels, max_labelled)
    rated, reached = fit_rates(post, domains, targets, budget)
    best = F.greatest(*[F.col(f"p{i}") for i in range(len(domains))]) if len(domains) > 1 \
        else F.col("p0")
    domain = F.lit(domains[0])
    for i, name in enumerate(domains[1:], 1):
        domain = F.when(F.col(f"p{i}") == best, name).otherwise(domain)
    chance = F.pmod(F.xxhash64("rk"), F.lit(1 << 30)) / float(1 << 30)
    return rated.select(
        "doc_id", "rk", "n_tokens", domain.alias("domain"), best.alias("p_domain"), "rate",
        (F.floor("rate") + F.when(chance < F.col("rate") - F.floor("rate"), 1).otherwise(0))
        .cast("bigint").alias("copies")), dict(zip(domains, reached, strict=True))


def mixed_docs(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None,
               budget: float = BUDGET) -> DataFrame:
    """``docs`` (all columns), each row as often as ``mix`` says."""
    key, copies, copy = (free_name(docs, f"_lx_{n}") for n in ("rk", "copies", "copy"))
    taken = (mix(docs, labels, targets, budget).where("copies > 0")
             .select(F.col("rk").alias(key), F.col("copies").cast("int").alias(copies)).distinct())
    return (docs.withColumn(key, row_key("doc_id", "text")).join(taken, key)
            .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies))))
            .select(*columns_of(docs)))


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents"),
               read_table(spark, sf_dir, "labels")).drop("rk")
