import pytest
from pyspark.sql import functions as F

from ludex.llm import mixing as mx


def test_rates_reach_targets(spark):
    # Three soft domains; rates must match reachable targets exactly.
    import random

    rnd = random.Random(2)
    rows = []
    for i in range(3000):
        lead = rnd.choice([0, 0, 0, 1, 1, 2])
        p = [0.05, 0.05, 0.05]
        p[lead] = 0.9
        rows.append((i, rnd.randint(0, 200), *p))
    post = spark.createDataFrame(rows, "doc_id int, n_tokens int, p0 double, p1 double, p2 double")
    goal = {"a": 0.2, "b": 0.3, "c": 0.5}
    rated, got = mx.fit_rates(post, ["a", "b", "c"], goal, budget=0.8)
    assert got == pytest.approx([0.16, 0.24, 0.4], abs=2e-3)
    assert rated.count() == 3000 and rated.agg(F.min("rate")).first()[0] >= 0


def test_unreachable_targets_stay_nonnegative(spark):
    post = spark.createDataFrame([(1, 10, 0.9, 0.1), (2, 10, 0.8, 0.2)],
                                 "doc_id int, n_tokens int, p0 double, p1 double")
    rated, got = mx.fit_rates(post, ["a", "b"], {"a": 0.0, "b": 1.0})
    assert rated.agg(F.min("rate")).first()[0] >= 0
    # Least squares by brute force over a grid of rates.
    def loss(r1, r2):
        t = [(r1 * 9 + r2 * 8) / 20, (r1 * 1 + r2 * 2) / 20]
        return (t[0] - 0) ** 2 / 0.85 + (t[1] - 1) ** 2 / 0.15
    best = min(loss(a / 50, b / 50) for a in range(200) for b in range(400))
    assert (got[0]) ** 2 / 0.85 + (got[1] - 1) ** 2 / 0.15 <= best * 1.05 + 1e-6


def test_held_out_domains(spark):
    """Accuracy on labels that the classifier did not see."""
    d = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    held = labels.where("doc_id % 4 = 0")
    post, domains = mx.posteriors(docs, labels.where("doc_id % 4 <> 0"))
    best = F.greatest(*[F.col(f"p{i}") for i in range(len(domains))])
    guess = F.lit(domains[0])
    for i, name in enumerate(domains):
        guess = F.when(F.col(f"p{i}") == best, name).otherwise(guess)
    rows = post.join(held, "doc_id").select(
        guess.alias("g"), mx.domain_of(F.col("quality"), F.col("toxic")).alias("d")).collect()
    quality = sum(r["g"].startswith("good") == r["d"].startswith("good") for r in rows) / len(rows)
    assert quality > 0.9 and sum(r["g"] == r["d"] for r in rows) / len(rows) > 0.8


def test_edges(spark, edge_docs, edge_rows, no_docs):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int, text string")
    one = spark.createDataFrame([(4, 1, 0, "x"), (4, None, 0, "x"), (None, 1, 1, "x")], none.schema)
    two = spark.createDataFrame([(4, 1, 0, "x"), (9, 0, 0, "x"), (9, 1, 1, "x"), (77, 0, 1, "x")],
                                none.schema)
    for labels in (none, one, two):
        out = mx.mix(edge_docs, labels).collect()
        assert len(out) == len(edge_rows) and all(r["rate"] >= 0 for r in out)
    assert mx.mix(no_docs, two).count() == 0
    assert mx.mixed_docs(edge_docs, none).count() == len(edge_rows)
    assert mx.mixed_docs(edge_docs, two).columns == edge_docs.columns


@pytest.fixture(scope="module")
def skewed(spark):
    words = {"good": "calm river", "bad": "cheap pills", "good_toxic": "angry shout"}
    rows = [(i, "good" if i % 2 else "bad") for i in range(2000)]
    rows += [(5000 + i, "good_toxic") for i in range(3)]
    docs = spark.createDataFrame([(i, f"{words[d]} w{i % 5}") for i, d in rows],
                                 "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(d != "bad"), int("toxic" in d)) for i, d in rows],
                                   "doc_id bigint, quality int, toxic int")
    return docs, labels


def test_rare_domains_are_in_the_fit(skewed):
    post, domains = mx.posteriors(*skewed, max_labelled=40)
    assert domains == ["bad", "good", "good_toxic"]
    rare = post.where("doc_id >= 5000").agg(F.min("p2")).first()[0]
    assert rare > post.where("doc_id < 5000").agg(F.max("p2")).first()[0]


def test_domains_without_documents(skewed):
    docs, labels = skewed
    out = mx.mix(docs.where("doc_id < 5000"), labels).collect()
    assert {r["domain"] for r in out} == {"bad", "good"} and len(out) == 2000
    assert all(r["rate"] >= 0 for r in out)


def test_quotas():
    assert mx._quotas({"a": 3, "b": 1000, "c": 1000}, 41) == {"a": 3, "b": 19, "c": 19}
    assert mx._quotas({"a": 3, "b": 5}, 100) == {"a": 3, "b": 5}


def least_squares(tokens, p, goal, rounds=20000):
    """Domain totals of the nonnegative least squares, by plain projected
    gradient on the documents until it stands still."""
    import numpy as np

    share = tokens / tokens.sum()
    sizes = share @ p
    rate = np.ones(len(tokens))
    for _ in range(rounds):
        error = (share * rate) @ p - goal
        rate = np.maximum(0.0, rate - p @ (error / sizes))
    return (share * rate) @ p


@pytest.mark.parametrize("targets", [
    None, {"bad": 0.5, "bad_toxic": 0.1, "good": 0.3, "good_toxic": 0.1},
    {"bad": 0.0, "bad_toxic": 0.0, "good": 1.0, "good_toxic": 0.0}])
def test_rates_against_least_squares(spark, fitted, targets):
    import numpy as np

    post, domains = fitted
    rows = post.toPandas()
    p = rows[[f"p{i}" for i in range(len(domains))]].to_numpy()
    tokens = rows["n_tokens"].to_numpy(float)
    sizes = list((tokens / tokens.sum()) @ p)
    goal = mx.BUDGET * np.array(mx.target_shares(domains, sizes, targets))
    _, got = mx.fit_rates(post, domains, targets)
    assert got == pytest.approx(least_squares(tokens, p, goal), abs=5e-3)


@pytest.fixture(scope="module")
def fitted(spark, sf_small):
    docs, labels = (spark.read.parquet(f"{sf_small}/{t}.parquet") for t in ("documents", "labels"))
    return mx.posteriors(docs, labels)


def test_reached_totals(skewed):
    targets = {"good": 0.7, "bad": 0.3}
    rows, reached = mx.mix_with_totals(*skewed, targets, budget=0.9)
    assert reached["good"] == pytest.approx(0.63, abs=5e-3)
    assert reached["bad"] == pytest.approx(0.27, abs=5e-3)
    assert rows.count() == 2003
