"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame.
Queries past the profiling ones are eager in part: the lag, the rated log, pair
cells, codes and quantiles write tables to the shared folder when the query is
built, and ALS queries fit their model.

Inputs are the two adapters of ``ludex.sources.adapters``: the behaviour
log from ``events`` and the purchase basket from ``orders`` x ``lineitem``.
Every floating output is rounded with ``rnd`` so that an independent SQL
engine can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludex.functions.columns import PLAY, PURCHASE, rnd
from ludex.operators import als as als_op
from ludex.operators import bitmaps as bm
from ludex.operators import classify, tuning
from ludex.operators import evaluate as ev
from ludex.operators import features as fe
from ludex.operators import profile as pr
from ludex.operators import recommend as rc
from ludex.operators import similarity as si
from ludex.operators.indexing import dense_index, extend_index
from ludex.operators.lsh import lsh_cosine
from ludex.operators.split import train_test, with_split
from ludex.sources.adapters import basket_log, behaviour_log
from ludex.session import shared_path
from ludex.sources.readers import read_behaviour_lines, read_table

CORR_COLUMNS = ["user_id", "item", "hours", "weight", "mean_hours", "rating"]
# Means of hours with few decimals often end in a 5 at the seventh place, where
# a last bit decides the sixth; nine places are past that.
MEAN_DIGITS = 9
LOG4 = ["user_id", "item", "behaviour", "hours"]

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------- inputs

def log(spark, d) -> DataFrame:
    return behaviour_log(spark, d)


def distinct_log(spark, d) -> DataFrame:
    return log(spark, d).select(*LOG4).distinct()


def rated(spark, d, profile: str = "knn") -> DataFrame:
    return fe.rated_log(log(spark, d), profile)


def rated_basket(spark, d, with_priority: bool = False, materialize: bool = True,
                 train_keys: bool = True) -> DataFrame:
    """The basket rated with the ALS profile, first purchases kept. All its
    rows are purchases, so this equals ``fe.rated_log(basket, 'als',
    keep_first=True)`` without the lag (checked in the tests)."""
    return fe.rated_purchases(basket_log(spark, d, with_priority), materialize, train_keys)


def knn_train_test(spark, d) -> tuple[DataFrame, DataFrame]:
    return train_test(rated(spark, d, "knn"))


# ----------------------------------------------------------- profiling

def q01_log_project(spark, d):
    return log(spark, d).select("event_id", *LOG4)


def q02_null_profile(spark, d):
    ev_ = pr.null_profile(read_table(spark, d, "events"), "events")
    docs = pr.null_profile(read_table(spark, d, "documents"), "documents")
    lg = pr.null_profile(log(spark, d).select(*LOG4), "behaviour_log")
    return ev_.unionByName(docs).unionByName(lg)


def q03_duplicate_groups(spark, d):
    return pr.duplicate_groups(read_table(spark, d, "events"), ["user_id", "event_type", "value"])


def q04_distinct_rows(spark, d):
    return distinct_log(spark, d)


def q05_cardinalities(spark, d):
    return pr.cardinalities(log(spark, d))


def q06_sparsity(spark, d):
    return pr.sparsity(log(spark, d), "behaviour_log").unionByName(
        pr.sparsity(basket_log(spark, d), "basket"))


def q07_top_items(spark, d):
    return pr.top_items(distinct_log(spark, d))


def q08_top_purchased(spark, d):
    return pr.top_by_behaviour(distinct_log(spark, d), PURCHASE)


def q09_top_played(spark, d):
    return pr.top_by_behaviour(distinct_log(spark, d), PLAY)


def q10_describe_hours(spark, d):
    return pr.describe(log(spark, d), "hours")


def q11_iqr_bounds(spark, d):
    return pr.quartile_bounds(distinct_log(spark, d), "hours")


def q12_outlier_flags(spark, d):
    return pr.outlier_flags(distinct_log(spark, d), "hours", ["user_id", "item", "behaviour"])


def q13_box_summary(spark, d):
    return pr.box_summary(distinct_log(spark, d), "hours")


def q14_low_hours(spark, d):
    return pr.low_hours(log(spark, d))


# ------------------------------------------------------------ features

def q15_prev_behaviour(spark, d):
    return fe.lagged_log(log(spark, d)).select("event_id", *LOG4, "prev", "weight")


def q16_transitions_als(spark, d):
    return fe.transitions(fe.lagged_log(log(spark, d)), "als") \
        .select("event_id", "user_id", "item", "behaviour", "prev", "weight")


def q17_transitions_knn(spark, d):
    return fe.transitions(fe.lagged_log(log(spark, d)), "knn") \
        .select("event_id", "user_id", "item", "behaviour", "prev", "weight")


def q18_item_mean(spark, d):
    kept = fe.transitions(fe.lagged_log(log(spark, d)), "knn")
    return fe.item_means(kept).select("item", rnd(F.col("mean_hours"), MEAN_DIGITS).alias("mean_hours"), "n_rows")


def q19_ratings(spark, d):
    return rated(spark, d, "knn").select(
        "event_id", *LOG4, "weight", rnd(F.col("mean_hours"), MEAN_DIGITS).alias("mean_hours"), "rating")


def q20_rating_histogram(spark, d):
    return pr.value_histogram(rated(spark, d, "als"), "rating")


def q21_correlation(spark, d):
    return pr.correlation(rated(spark, d, "als"), CORR_COLUMNS)


def q22_rating_skew(spark, d):
    return pr.rating_skew(rated(spark, d, "als"))


def q23_item_codes(spark, d):
    return dense_index(rated(spark, d, "als"), "item", "code")


def q24_split_counts(spark, d):
    a = with_split(rated(spark, d, "knn")).groupBy("split").agg(F.count(F.lit(1)).alias("n")) \
        .select(F.lit("behaviour_log").alias("dataset"), "split", "n")
    b = with_split(rated_basket(spark, d)).groupBy("split").agg(F.count(F.lit(1)).alias("n")) \
        .select(F.lit("basket").alias("dataset"), "split", "n")
    return a.unionByName(b)


def q25_residuals(spark, d):
    train, _ = train_test(rated_basket(spark, d))
    r = fe.residuals(train)
    return r.select("user_id", "item", "rkey", "rating",
                    rnd(F.col("user_mean")).alias("user_mean"),
                    rnd(F.col("item_mean")).alias("item_mean"),
                    rnd(F.col("global_mean")).alias("global_mean"),
                    rnd(F.col("interaction")).alias("interaction"))


# ----------------------------------------------------------------- ALS

def _als_run(spark, d):
    # Only test rows are put out with their keys.
    return als_op.fit(rated_basket(spark, d, materialize=False, train_keys=False))


def q26_als_predict(spark, d):
    p = als_op.predictions(_als_run(spark, d))
    return p.select("user_id", "item", "rkey", "rating",
                    rnd(F.col("residual_prediction")).alias("residual_prediction"),
                    rnd(F.col("prediction")).alias("prediction"))


def q27_als_rmse(spark, d):
    """RMSE on the rating scale and on the raw residual scale, one pass."""
    p = als_op.predictions(_als_run(spark, d))
    r = F.col("rating").cast("double")
    e1, e2 = F.col("prediction") - r, F.col("residual_prediction") - r
    wide = p.agg(F.sqrt(F.avg(e1 * e1)).alias("rating_scale"),
                 F.sqrt(F.avg(e2 * e2)).alias("residual_scale"), F.count(F.lit(1)).alias("n"))
    long = wide.unpivot(["n"], ["rating_scale", "residual_scale"], "mode", "rmse")
    return long.select("mode", rnd(F.col("rmse")).alias("rmse"), "n")


def q28_als_topn(spark, d):
    return als_op.recommend_all(_als_run(spark, d), rc.TOP_N) \
        .select("user_id", "item", rnd(F.col("score")).alias("score"), "rank")


def q29_als_topn_named(spark, d, n: int = rc.TOP_N):
    """Top-n unseen items per user on the rating scale, with the part name
    (exact; see ``als.recommend_unseen``)."""
    owned = basket_log(spark, d).select("user_id", "item")
    top = als_op.recommend_unseen(_als_run(spark, d), owned, n)
    parts = read_table(spark, d, "part").select(F.col("p_partkey").alias("item"), "p_name")
    return top.join(parts, "item", "left").select(
        "user_id", "rank", "item", "p_name", rnd(F.col("score")).alias("score"))


# ------------------------------------------------ utility / full cosine

def q30_utility_pivot(spark, d):
    """Utility cells in long form: mean rating per item and order priority,
    over the values that occur (a wide pivot needs a list of them)."""
    r = rated_basket(spark, d, with_priority=True)
    r = r.filter(F.col("user_id").isNotNull() & F.col("item").isNotNull()
                 & F.col("rating").isNotNull())
    return r.groupBy("item", "priority").agg(rnd(F.avg("rating")).alias("rating"))


def q31_l2_normalised(spark, d):
    n = si.l2_normalised(rated(spark, d, "als"))
    return n.select("item", "user_id", rnd(F.col("value")).alias("value"),
                    rnd(F.col("norm")).alias("norm"), rnd(F.col("norm_value")).alias("norm_value"))


def q32_full_cosine(spark, d):
    return si.full_cosine(rated(spark, d, "als")).select(
        "i1", "i2", rnd(F.col("similarity")).alias("similarity"))


# ----------------------------------------------------------- item KNN

def q33_item_history(spark, d):
    """The whole history of every item: each rated row as an (item, user,
    event, rating) row."""
    return rated(spark, d, "knn").select("item", "user_id", "event_id", "rating")


def q34_item_pairs(spark, d):
    train, _ = knn_train_test(spark, d)
    return si.pair_rows(si.cells(train, "rating"))


def cosine_neighbours(train: DataFrame) -> DataFrame:
    return si.top_k(si.co_rated_cosine(train))


def q35_cosine_pairs(spark, d):
    train, _ = knn_train_test(spark, d)
    return si.co_rated_cosine(train).select(
        "i1", "i2", "sx", "sy", "sxy", rnd(F.col("similarity")).alias("similarity"))


def q35b_cosine_pairs_basket(spark, d):
    """The same operator on the purchase basket (many more pairs per user)."""
    train, _ = train_test(rated_basket(spark, d, materialize=False))
    return si.co_rated_cosine(train).select(
        "i1", "i2", "sx", "sy", "sxy", rnd(F.col("similarity")).alias("similarity"))


def q36_cosine_topk(spark, d):
    train, _ = knn_train_test(spark, d)
    return cosine_neighbours(train).select(
        "i1", "i2", rnd(F.col("similarity")).alias("similarity"), "rank")


def q37_knn_scores(spark, d):
    train, _ = knn_train_test(spark, d)
    s = rc.neighbour_sums(train, cosine_neighbours(train))
    return s.select("item", "item_nn", rnd(F.col("total_ratings")).alias("total_ratings"),
                    rnd(F.col("sim_total")).alias("sim_total"))


def _cosine_rmse(train, test, nn=None):
    nn = nn if nn is not None else cosine_neighbours(train)
    scores = rc.neighbour_scores(train, nn)
    user = ev.rmse(test.join(scores.filter(F.col("score").isNotNull()), ["user_id", "item"], "inner"),
                   "score", "rating")
    # Item mode: each train row, repeated once per neighbour of its item (or
    # once without neighbours), predicts every held-out rating of the item.
    times = nn.groupBy(F.col("i1").alias("item")).agg(F.count(F.lit(1)).alias("k"))
    pred = ev.side_sums(train, "item", "rating").join(times, "item", "left")
    k = F.coalesce("k", F.lit(1))
    pred = pred.select("item", *[(F.col(c) * k).alias(c) for c in "nsq"])
    item = ev.rmse_of_sums(pred, ev.side_sums(test, "item", "rating"), "item")
    return user, item


def q38_cosine_rmse(spark, d):
    train, test = knn_train_test(spark, d)
    user, item = _cosine_rmse(train, test)
    return (user.select(F.lit("user").alias("mode"), "rmse", "n")
            .unionByName(item.select(F.lit("item").alias("mode"), "rmse", "n"))
            .select("mode", rnd(F.col("rmse")).alias("rmse"), "n"))


def q39_centred(spark, d):
    train, _ = knn_train_test(spark, d)
    c = fe.centred(train)
    return c.select("user_id", "item", "event_id", "rating",
                    rnd(F.col("user_mean")).alias("user_mean"),
                    rnd(F.col("deviation")).alias("deviation"))


def pearson_neighbours(train: DataFrame, mode: str = "intended") -> DataFrame:
    return si.top_k(si.damped_pearson(train, mode))


def q40_damped_pearson(spark, d):
    train, _ = knn_train_test(spark, d)
    sums = si.pair_sums(train, "rating", centre=True)
    out = None
    for mode in ("intended", "faithful"):
        s = si.damped_pearson(None, mode, sums=sums).select(
            F.lit(mode).alias("mode"), "i1", "i2", rnd(F.col("similarity")).alias("similarity"))
        out = s if out is None else out.unionByName(s)
    return out


def q41_pearson_topk(spark, d):
    train, _ = knn_train_test(spark, d)
    return pearson_neighbours(train).select(
        "i1", "i2", rnd(F.col("similarity")).alias("similarity"), "rank")


def _pearson_items(train, nn=None):
    nn = nn if nn is not None else pearson_neighbours(train)
    s = rc.neighbour_sums(train, nn, factor=2.0)
    return s.withColumn("prediction", F.try_divide(F.col("total_ratings"), F.col("sim_total")))


def q42_pearson_items(spark, d):
    train, _ = knn_train_test(spark, d)
    return _pearson_items(train).select("item", "item_nn", rnd(F.col("prediction")).alias("prediction"))


def _pearson_rmse(train, test, nn=None):
    c = fe.centred(train)
    nn = nn if nn is not None else pearson_neighbours(train)
    dev = rc.neighbour_scores(c, nn, value="deviation")
    um = fe.user_means(train)
    sc = dev.filter(F.col("score").isNotNull()).join(um, "user_id", "inner") \
        .withColumn("prediction", F.col("user_mean") + F.col("score"))
    user = ev.rmse(test.join(sc, ["user_id", "item"], "inner"), "prediction", "rating")
    # Item mode: each (item, neighbour) value predicts every held-out rating
    # of the neighbour; a missing value counts as 0.
    it = _pearson_items(train, nn).filter(F.col("item_nn").isNotNull()).select(
        F.col("item_nn").alias("item"), F.coalesce(F.col("prediction"), F.lit(0.0)).alias("p"))
    item = ev.rmse_all_pairs(it, test.select("item", F.col("rating").alias("t")), "item", "p", "t")
    return user, item


def q43_pearson_rmse(spark, d):
    train, test = knn_train_test(spark, d)
    user, item = _pearson_rmse(train, test)
    return (user.select(F.lit("user").alias("mode"), "rmse", "n")
            .unionByName(item.select(F.lit("item").alias("mode"), "rmse", "n"))
            .select("mode", rnd(F.col("rmse")).alias("rmse"), "n"))


def q44_user_summary(spark, d):
    train, _ = knn_train_test(spark, d)
    s = rc.user_summary(train)
    return s.select("user_id", "n_ratings", rnd(F.col("user_mean")).alias("user_mean"),
                    rnd(F.col("global_mean")).alias("global_mean"))


def recommend(spark, d, n: int = rc.TOP_N) -> DataFrame:
    """Flagship: rated log (KNN transitions) -> md5 train split -> co-rated
    cosine -> 5 neighbours per item -> per-user neighbour scores -> drop
    items the user has in the log (bought or played, kept or not) -> n best
    per user."""
    lg = log(spark, d)
    train, _ = train_test(fe.rated_log(lg, "knn"))
    scores = rc.neighbour_scores(train, cosine_neighbours(train))
    top = rc.unseen_top_n(scores, lg, n)
    return top.select("user_id", "item", rnd(F.col("score")).alias("score"), "rank")


def q45_recommend(spark, d):
    return recommend(spark, d)


def q46_model_comparison(spark, d):
    """RMSE of the two neighbour models per (user, item), on one rated log and
    split. Times are in ``bench.py``, the ALS figure on the same log in
    q47."""
    train, test = knn_train_test(spark, d)
    out = None
    for name, measure in (("cosine", _cosine_rmse), ("pearson", _pearson_rmse)):
        user, _ = measure(train, test)
        row = user.select(F.lit(name).alias("model"), rnd(F.col("rmse")).alias("rmse"), "n")
        out = row if out is None else out.unionByName(row)
    return out


def q47_als_rmse_log(spark, d):
    """RMSE of ALS on the log and split of q46."""
    p = als_op.predictions(als_op.fit(rated(spark, d, "knn")))
    return ev.rmse(p, "prediction", "rating").select(
        F.lit("als").alias("model"), rnd(F.col("rmse")).alias("rmse"), "n")


def q48_als_scored(spark, d):
    """The held-out rows that ALS can score (user and item in train), with the
    bias-only prediction user mean + item mean - global mean."""
    train, test = train_test(rated_basket(spark, d))
    um, im, gm = fe.train_means(train)
    return (test.join(um, "user_id").join(im, "item").select(
        "user_id", "item", "rkey", "rating",
        rnd(F.col("user_mean") + F.col("item_mean") - gm).alias("bias")))


def q49_bias_rmse(spark, d):
    """RMSE of the bias-only prediction: the yardstick of the ALS figure."""
    train, test = train_test(rated_basket(spark, d))
    um, im, gm = fe.train_means(train)
    scored = test.join(um, "user_id").join(im, "item").select(
        "rating", (F.col("user_mean") + F.col("item_mean") - gm).alias("bias"))
    return ev.rmse(scored, "bias", "rating").select(rnd(F.col("rmse")).alias("rmse"), "n")


def q50_als_candidates(spark, d):
    """Per user: items of the basket the user owns, and those left to
    recommend."""
    basket = basket_log(spark, d)
    items = basket.select(F.count_distinct("item")).scalar()
    return (basket.groupBy("user_id").agg(F.count_distinct("item").alias("n_owned"))
            .withColumn("n_unseen", items - F.col("n_owned")))


def q51_name_codes(spark, d):
    """Alphabetical codes of a text column: part names."""
    return dense_index(read_table(spark, d, "part"), "p_name", "code")


def q52_recommend_named(spark, d):
    """q45 with the names of the items."""
    parts = read_table(spark, d, "part").select(F.col("p_partkey").alias("item"), "p_name")
    return recommend(spark, d).join(parts, "item", "left").select(
        "user_id", "rank", "item", "p_name", "score")


# ------------------------------------------------- search, tuning, checks

def q53_lsh_neighbours(spark, d):
    """The five nearest items by whole-vector cosine, among LSH candidates."""
    return si.top_k(lsh_cosine(rated(spark, d, "als"))).select(
        "i1", "i2", rnd(F.col("similarity")).alias("similarity"), "rank")


def q54_als_folds(spark, d):
    """Rows of the folds of the model search."""
    train, _ = knn_train_test(spark, d)
    return tuning.fold_rows(train)


def q55_als_tuning(spark, d):
    """The model search: RMSE of every fold and parameters, and of the best ones
    fitted on all train rows on the test rows (fold -1)."""
    trials, _, best = tuning.search(rated(spark, d, "knn"))
    return spark.createDataFrame([(t.fold, t.rank, t.reg, t.rmse, t.n) for t in [*trials, best]],
                                 "fold int, rank int, reg double, rmse double, n bigint")


def q56_behaviour_features(spark, d):
    f = classify.sequence_features(log(spark, d))
    return f.select("event_id", "behaviour", *[rnd(F.col(c)).alias(c) for c in classify.FEATURES])


def q57_behaviour_confusion(spark, d):
    return classify.confusion(log(spark, d))


def paired_errors(train: DataFrame, test: DataFrame) -> DataFrame:
    """Errors of the cosine and the Pearson model on the held-out rows that both
    can score: rkey, cosine, pearson."""
    cos = rc.neighbour_scores(train, cosine_neighbours(train)).select(
        "user_id", "item", F.col("score").alias("_c"))
    dev = rc.neighbour_scores(fe.centred(train), pearson_neighbours(train), value="deviation")
    pea = dev.join(fe.user_means(train), "user_id").select(
        "user_id", "item", (F.col("user_mean") + F.col("score")).alias("_p"))
    both = test.join(cos, ["user_id", "item"]).join(pea, ["user_id", "item"])
    return both.where("_c is not null and _p is not null").select(
        "rkey", (F.col("_c") - F.col("rating")).alias("cosine"),
        (F.col("_p") - F.col("rating")).alias("pearson"))


def q58_model_difference(spark, d):
    """Is the RMSE of cosine and Pearson really different? A paired bootstrap."""
    found = ev.compare_rmse(paired_errors(*knn_train_test(spark, d)), "cosine", "pearson")
    return found.select("n", *[rnd(F.col(c)).alias(c) for c in
                               ("rmse_cosine", "rmse_pearson", "difference", "low", "high")], "differ")


# Titles of parts sold before this day make the first load of q59.
FIRST_LOAD = "1995-01-01"


def q59_stable_codes(spark, d):
    """Codes of item titles after a second load: those of the first load (parts
    sold before FIRST_LOAD) stay, the others follow."""
    title = F.concat_ws(" #", "p_name", F.col("p_partkey").cast("string")).alias("title")
    parts = read_table(spark, d, "part").select("p_partkey", title)
    sold = basket_log(spark, d).where(F.col("ts") < F.lit(FIRST_LOAD).cast("date")).select(
        F.col("item").alias("p_partkey"))
    first = dense_index(parts.join(sold, "p_partkey", "left_semi"), "title", "code")
    return extend_index(first, parts, "title", "code")


def q60_recommend_active(spark, d):
    """q45 for the users found among those with a click: a semi join."""
    active = read_table(spark, d, "events").where("event_type = 'click'").select("user_id").distinct()
    return recommend(spark, d).join(active, "user_id", "left_semi")


def q61_csv_rejects(spark, d):
    """The events as behaviour CSV lines, of which those of other types are
    broken in different ways, read back: lines per reason ('' if none)."""
    e, kind = read_table(spark, d, "events"), F.col("event_type")
    user = F.col("user_id").cast("string")
    title = F.concat(F.lit('"item, '), F.get_json_object("props", "$.k"), F.lit('"'))
    hours = F.when(kind == "view", F.col("value").cast("string")).otherwise("1.0")
    what = F.when(kind == "view", F.lit("play")).otherwise(F.lit("purchase"))
    comma = F.lit(",")
    line = (F.when(kind == "error", F.concat(user, comma, title))
            .when(kind == "click", F.concat(F.lit("u"), user, comma, title, comma, what, comma, hours))
            .when(kind == "signup", F.concat(user, comma, title, F.lit(",joined,n/a,0")))
            .otherwise(F.concat(user, comma, title, comma, what, comma, hours, F.lit(",0"))))
    path = shared_path(spark, "lines")
    e.select(F.coalesce(line, F.lit("")).alias("value")).write.text(path)
    rows, rejects = read_behaviour_lines(spark, path)
    return (rows.select(F.lit("").alias("reason")).unionByName(rejects.select("reason"))
            .groupBy("reason").agg(F.count(F.lit(1)).alias("n")))


def q62_median_fill(spark, d):
    """Hours of purchases (no more than a mark in the log) replaced by the
    median hours of the item's plays."""
    filled = pr.fill_by_group(log(spark, d), "item", "hours", F.col("behaviour") == PLAY, "filled")
    return filled.select("event_id", "item", "behaviour", "hours", "filled")


def q63_basket_topk(spark, d):
    """Top-5 neighbours of both models on the basket, whose many sparse items
    close early (see ``similarity.top_k_bounded``)."""
    train, _ = train_test(rated_basket(spark, d, materialize=False))
    hubs = si.hubs_of(train)  # both models read them
    out = None
    for kind in ("cosine", "pearson"):
        top = si.top_k_bounded(train, kind, hubs=hubs).select(
            F.lit(kind).alias("model"), "i1", "i2", rnd(F.col("similarity")).alias("similarity"), "rank")
        out = top if out is None else out.unionByName(top)
    return out


def q64_owned_bitmaps(spark, d):
    """What each user has in the log as bitmaps of item codes: per chunk its
    items, its non-empty words and these (number:hexadecimal bits)."""
    lg = log(spark, d)
    held = bm.bitmaps(lg, dense_index(lg, "item"))
    words = F.transform(F.array_sort(F.map_entries("words")), lambda w: F.concat_ws(
        ":", w["key"].cast("string"), F.hex(w["value"])))
    return held.select("user_id", "chunk", bm.size(F.col("words")).alias("n_items"),
                       F.size("words").cast("bigint").alias("n_words"),
                       F.array_join(words, ",").alias("words"))


def q65_recommend_bitmaps(spark, d):
    """q45 with the owned items taken out by bit tests."""
    lg = log(spark, d)
    codes = dense_index(lg, "item")
    train, _ = train_test(fe.rated_log(lg, "knn"))
    scores = rc.neighbour_scores(train, cosine_neighbours(train)).dropna(subset=["score"])
    top = rc.best_n(bm.lacking(scores, bm.bitmaps(lg, codes), codes))
    return top.select("user_id", "item", rnd(F.col("score")).alias("score"), "rank")


def q66_bought_and_played(spark, d):
    """Per user: items bought, played, and both, from two sets of bitmaps; and
    purchase lines of items that the user also plays (a semi join by bit tests)."""
    lg = log(spark, d)
    codes = dense_index(lg, "item")
    bought, played = (lg.where(F.col("behaviour") == b) for b in (PURCHASE, PLAY))
    plays = bm.bitmaps(played, codes)
    sets = bm.set_sizes(bm.bitmaps(bought, codes), plays)
    lines = (bm.having(bought.select("user_id", "item"), plays, codes)
             .groupBy("user_id").agg(F.count(F.lit(1)).alias("n_lines")))
    return sets.join(lines, "user_id", "left").select(
        "user_id", F.col("n_left").alias("n_bought"), F.col("n_right").alias("n_played"), "n_both",
        F.coalesce("n_lines", F.lit(0)).alias("n_lines"))


QUERIES: dict[str, Query] = {
    name: fn for name, fn in sorted(globals().items())
    if name.startswith("q") and name[1:3].isdigit() and callable(fn)
}

# Queries without an SQL oracle (model fitting); checked on rows only.
MODEL_QUERIES = {"q26_als_predict", "q27_als_rmse", "q28_als_topn", "q29_als_topn_named",
                 "q47_als_rmse_log", "q55_als_tuning", "q57_behaviour_confusion"}
