"""Quality rules as weak supervision, in DataFrame functions only.

Each rule looks at one measure of a document and votes +1 (good), -1 (bad) or
0 (abstains). Rules err, so no single vote decides. With the rules independent
given the true class, expectation-maximisation estimates from the votes alone
how each rule votes on good and on bad documents and how common good documents
are; a document is kept when the posterior probability of its being good is at
least one half. Documents enter the estimation as counts of vote patterns (at
most 3 ** rules rows), so its cost does not depend on the corpus.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludex.llm.common import columns_of, free_name, read_table, row_key
from ludex.session import stage_table

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
ROUNDS = 30
# Prior pseudo-counts of a vote, by how a rule is meant (see ``fit``).
PRIOR_WEIGHT, PRIOR_RIGHT = 20.0, 0.8
PRIOR_GOOD = 0.8

# The measured characters.
SPACES = "\t\n\x0b\x0c\r "
SYMBOLS = "#*$%&|<>"

# Rules: (name, measure, good up to, bad from). A value between abstains, and
# so does a rule without a good side where it sees nothing bad: that a document
# lacks one kind of junk says little about the others.
RULES = [
    ("symbols", "n_symbols / n_words", None, 0.10),
    ("bars", "n_bars / n_words", None, 0.15),
    ("other_characters", "(word_chars - n_letters) / word_chars", 0.06, 0.12),
    ("capitals", "n_upper / n_letters", None, 0.40),
    ("marks", "n_marks / n_words", None, 0.80),
    ("repeats", "n_repeat_words / n_words", None, 0.30),
    ("dup_lines", "n_dup_lines / n_lines", None, 0.30),
    ("same_words", "(n_words - n_distinct) / n_words", None, 0.85),
]


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more."""
    windows = F.zip_with(F.zip_with(words, F.slice(words, 2, F.size(words)),
                                    lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
                         F.slice(words, 3, F.size(words)),
                         lambda p, c: F.xxhash64(p["a"], p["b"], c))
    # The tuples at the end lack a word and are cut off.
    return F.when(F.size(words) < 3, F.array().cast("array<bigint>")).otherwise(
        F.slice(windows, 1, F.greatest(F.size(words) - 2, F.lit(1))))


def measures(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with the measures of each document: n_words,
    word_chars, n_symbols, n_dup_lines, n_repeat_words (see the query's
    contract) and those that only the rules use. NULL texts count as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    plain = docs.select("doc_id", text.alias("text")).select(
        "doc_id", "text",
        F.array_remove(F.split(F.translate("text", SPACES, " " * len(SPACES)), " "),
                       "").alias("words"),
        F.filter(F.split("text", "\n"),
                 lambda line: F.length(F.translate(line, SPACES, "")) > 0).alias("lines"))
    hashed = plain.withColumn("h", _repeat_words(F.col("words")))
    # Windows in order of their hash: neighbours of one hash are repeats.
    ordered = F.when(F.size(F.array_distinct("h")) == F.size("h"),
                     F.lit(None).cast("array<struct<h:bigint,i:int>>")).otherwise(
        F.sort_array(F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    found = hashed.withColumn("o", ordered)
    # Each repeat marks itself and the one before it.
    marked = F.zip_with(
        F.slice("o", 1, F.greatest(F.size("o") - 1, F.lit(0))), F.slice("o", 2, F.size("o")),
        lambda a, b: F.when(a["h"] == b["h"],
                            F.array(*[x["i"] + k for x in (a, b) for k in range(3)]))
        .otherwise(F.array().cast("array<int>")))
    repeat = F.when(F.col("o").isNull(), 0).otherwise(
        F.size(F.array_distinct(F.flatten(marked))))
    upper = F.length(F.regexp_replace("text", r"[^\p{Lu}]+", ""))
    letters = F.length(F.regexp_replace("text", r"[^\p{L}]+", ""))
    return found.select(
        "doc_id", F.size("words").cast("bigint").alias("n_words"),
        F.length(F.translate("text", SPACES, "")).cast("bigint").alias("word_chars"),
        _count(F.col("text"), SYMBOLS).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        repeat.cast("bigint").alias("n_repeat_words"),
        F.size("lines").alias("n_lines"), upper.alias("n_upper"), letters.alias("n_letters"),
        _count(F.col("text"), "!?.,;:").alias("n_marks"),
        F.size(F.array_distinct("words")).alias("n_distinct"),
        _count(F.col("text"), "|").alias("n_bars"))


def votes(measured: DataFrame) -> DataFrame:
    """Adds ``vote_<rule>``; a rule whose measure has no value abstains."""
    out = measured
    for name, measure, good, bad in RULES:
        value = F.try_divide(*map(F.expr, measure.split(" / ")))
        vote = F.when(value >= bad, -1)
        vote = vote if good is None else vote.when(value <= good, 1)
        out = out.withColumn(f"vote_{name}", vote.otherwise(0))
    return out


def _log_odds(votes_: Column, names: list[str], model: dict) -> Column:
    """Log odds of good against bad for an array of votes."""
    def weight(p: float, q: float) -> Column:
        return F.lit(math.log(p / q))

    shares = [[model["p", name, v] for v in (1, -1)] for name in names]
    up = F.array(*[weight(*s[0]) for s in shares])
    down = F.array(*[weight(*s[1]) for s in shares])
    none = F.array(*[weight(*(1 - s[0][i] - s[1][i] for i in (0, 1))) for s in shares])
    steps = F.transform(votes_, lambda v, i: F.when(v == 1, F.get(up, i)).when(
        v == -1, F.get(down, i)).otherwise(F.get(none, i)))
    start = F.lit(math.log(model["good"] / (1 - model["good"])))
    return F.aggregate(steps, start, lambda total, step: total + step)


def fit(voted: DataFrame, rounds: int = ROUNDS) -> dict:
    """Estimates, by expectation-maximisation over vote patterns, P(good) and
    for each rule P(vote | good) and P(vote | bad). Pseudo-counts keep every
    probability off 0 and 1 and say which class is called good: a rule's votes
    are expected right. Each round is one aggregate over the pattern table;
    only its sums (one row per rule and vote) come to the driver. Without
    documents the prior is the answer."""
    names = [r[0] for r in RULES]
    patterns = stage_table(
        voted.groupBy(F.array(*[f"vote_{n}" for n in names]).alias("votes"))
        .agg(F.count(F.lit(1)).alias("n")).coalesce(1).sortWithinPartitions("votes"), "patterns")
    right, wrong = PRIOR_RIGHT / 2, (1 - PRIOR_RIGHT) / 2
    prior = {1: (right, wrong), -1: (wrong, right)}
    model: dict = {"good": PRIOR_GOOD}
    model |= {("p", name, v): prior[v] for name in names for v in (1, -1)}
    for _ in range(rounds):
        good = 1 / (1 + F.exp(-_log_odds(F.col("votes"), names, model)))
        rows = (patterns.select("n", (F.col("n") * good).alias("good"), F.posexplode("votes"))
                .groupBy("pos", "col").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
                .collect())
        sums = {(names[r["pos"]], r["col"]): (r["good"], r["n"]) for r in rows}
        first = [sums.get((names[0], v), (0.0, 0)) for v in (1, 0, -1)]
        is_good, n = sum(x[0] for x in first), sum(x[1] for x in first)
        new: dict = {"good": (is_good + PRIOR_WEIGHT * PRIOR_GOOD) / (n + PRIOR_WEIGHT)}
        for name in names:
            for v in (1, -1):
                g, all_ = sums.get((name, v), (0.0, 0))
                new["p", name, v] = (
                    (g + PRIOR_WEIGHT * prior[v][0]) / (is_good + PRIOR_WEIGHT),
                    (all_ - g + PRIOR_WEIGHT * prior[v][1]) / (n - is_good + PRIOR_WEIGHT))
        moved = max([abs(new["good"] - model["good"])]
                    + [abs(x - y) for k in new if k != "good"
                       for x, y in zip(new[k], model[k], strict=True)])
        model = new
        if moved < 1e-5:
            break
    return model


def judge(docs: DataFrame) -> DataFrame:
    """One row per document: the measures, the votes, ``p_good``, base_failed
    (fewer than ``MIN_WORDS`` words, or more than ``MAX_REPEAT_PERCENT`` % of
    them in repeated 3-word windows) and kept (not base_failed, and p_good at
    least one half).

    Cases: NULL and empty texts have 0 words and fail. Copies and repeated
    rows are judged alike, each. doc_id may be NULL. Other columns are ignored.
    An empty table gives an empty table."""
    voted = stage_table(votes(measures(docs)), "votes")
    model = fit(voted.where(f"n_words >= {MIN_WORDS}"))
    names = [r[0] for r in RULES]
    given = F.array(*[f"vote_{n}" for n in names])
    good = 1 / (1 + F.exp(-_log_odds(given, names, model)))
    failed = ((F.col("n_words") < MIN_WORDS)
              | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    return (voted.withColumn("p_good", good).withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= 0.5)))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) that ``judge`` keeps. Rows are told
    apart by id and text."""
    key = free_name(docs, "_lx_rk")
    keyed = docs.withColumn(key, row_key("doc_id", "text"))
    found = judge(keyed.select(F.col(key).alias("doc_id"), "text"))
    kept = found.where("kept").select(F.col("doc_id").alias(key)).distinct()
    return keyed.join(kept, key, "left_semi").select(*columns_of(docs))


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    return judge(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "p_good")
