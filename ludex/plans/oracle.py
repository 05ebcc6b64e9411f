"""DuckDB SQL for each SQL-expressible query, over the fixture tables as
views. Written independently of the Spark plans and, where it matters, in
the plain textbook form (for example, pair sums straight from a self-join
of rating rows, not from the per-(user, item) cells the Spark plan uses), so
the comparison also checks the Spark-side rewrites.
"""

from __future__ import annotations


def R(x: str, d: int = 6) -> str:
    """Rounded double, negative zero folded to zero."""
    return f"(round(CAST({x} AS DOUBLE), {d}) + 0.0)"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


LOG = """log AS (
  SELECT user_id,
         TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS item,
         CASE WHEN event_type = 'purchase' THEN 'purchase' ELSE 'play' END AS behaviour,
         CASE WHEN event_type = 'purchase' THEN CAST(1.0 AS DOUBLE) ELSE value END AS hours,
         ts, event_id, concat_ws('|', event_id, user_id) AS rkey
  FROM events WHERE event_type IN ('purchase', 'view'))"""

DLOG = """dlog AS (SELECT DISTINCT user_id, item, behaviour, hours FROM log)"""

BASKET = """basket AS (
  SELECT o.o_custkey AS user_id, l.l_partkey AS item, 'purchase' AS behaviour,
         l.l_quantity AS hours, o.o_orderdate AS ts,
         l.l_orderkey * 1000 + l.l_linenumber AS event_id,
         concat_ws('|', l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey) AS rkey,
         o.o_orderpriority AS priority
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


def lagged(src: str, name: str) -> str:
    return f"""{name} AS (
  SELECT *, CASE WHEN prev = 'purchase' AND behaviour = 'play' THEN 2 ELSE 1 END AS weight
  FROM (SELECT *, lag(behaviour) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev
        FROM {src}))"""


KEEP = {
    "als": "(prev = 'purchase' AND behaviour = 'play') OR (prev = 'purchase' AND behaviour = 'purchase')"
           " OR (prev = 'play' AND behaviour = 'purchase')",
    "knn": "(prev = 'purchase' AND behaviour = 'play') OR (prev = 'purchase' AND behaviour = 'purchase')"
           " OR (prev = 'play' AND behaviour = 'play')",
}


def rated(src: str, name: str, profile: str, keep_first: bool = False) -> str:
    keep = KEEP[profile]
    if keep_first:
        keep += " OR (prev IS NULL AND behaviour = 'purchase')"
    return f"""{name}_lag AS (
  SELECT *, CASE WHEN prev = 'purchase' AND behaviour = 'play' THEN 2 ELSE 1 END AS weight
  FROM (SELECT *, lag(behaviour) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev
        FROM {src})),
{name}_kept AS (SELECT * FROM {name}_lag WHERE {keep}),
{name}_means AS (SELECT item, avg(hours) AS mean_hours
                 FROM {name}_kept GROUP BY item),
{name} AS (
  SELECT k.*, m.mean_hours,
         CASE WHEN k.hours = m.mean_hours * k.weight THEN 1
              WHEN k.hours >= CAST(0.9 AS DOUBLE) * m.mean_hours * k.weight THEN 5
              WHEN k.hours >= CAST(0.7 AS DOUBLE) * m.mean_hours * k.weight THEN 4
              WHEN k.hours >= CAST(0.4 AS DOUBLE) * m.mean_hours * k.weight THEN 3
              WHEN k.hours >= CAST(0.1 AS DOUBLE) * m.mean_hours * k.weight THEN 2
              ELSE 0 END AS rating
  FROM {name}_kept k JOIN {name}_means m ON k.item = m.item)"""


def bucket(key: str) -> str:
    return f"(CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT) % 100)"


def split(src: str) -> str:
    return f"""train AS (SELECT * FROM {src} WHERE {bucket('rkey')} < 80),
test AS (SELECT * FROM {src} WHERE {bucket('rkey')} >= 80)"""


RATED_KNN = rated("log", "rknn", "knn")
RATED_ALS = rated("log", "rals", "als")
RATED_BASKET = rated("basket", "rbas", "als", keep_first=True)
KNN = with_(LOG, RATED_KNN, split("rknn"))

# Co-rated pair sums straight from rating rows (both orders).
COSINE = """pairsum AS (
  SELECT a.item AS i1, b.item AS i2,
         sum(CAST(a.rating AS DOUBLE) * a.rating) AS sx,
         sum(CAST(b.rating AS DOUBLE) * b.rating) AS sy,
         sum(CAST(a.rating AS DOUBLE) * b.rating) AS sxy
  FROM train a JOIN train b ON a.user_id = b.user_id AND a.item <> b.item
  GROUP BY a.item, b.item),
cos AS (SELECT *, coalesce(sxy / nullif(sqrt(sx) * sqrt(sy), 0), 0) AS similarity FROM pairsum),
cos_nn AS (
  SELECT * FROM (
    SELECT i1, i2, similarity,
           row_number() OVER (PARTITION BY i1 ORDER BY round(similarity, 9) DESC, i2) AS rank
    FROM cos) WHERE rank <= 5)"""

CENTRED = """umean AS (SELECT user_id, avg(rating) AS user_mean FROM train GROUP BY user_id),
centred AS (SELECT t.*, u.user_mean, t.rating - u.user_mean AS deviation
            FROM train t JOIN umean u ON t.user_id = u.user_id)"""

PEARSON = """psum AS (
  SELECT a.item AS i1, b.item AS i2,
         sum(a.deviation * a.deviation) AS sx,
         sum(b.deviation * b.deviation) AS sy,
         sum(a.deviation * b.deviation) AS sxy
  FROM centred a JOIN centred b ON a.user_id = b.user_id AND a.item <> b.item
  GROUP BY a.item, b.item),
pea AS (SELECT i1, i2, coalesce(sxy / nullif(sqrt(sx) * sqrt(sy) + 0.5, 0), 0) AS similarity,
               coalesce(sx / nullif(sqrt(sx) * sqrt(sx) + 0.5, 0), 0) AS faithful
        FROM psum),
pea_nn AS (
  SELECT * FROM (
    SELECT i1, i2, similarity,
           row_number() OVER (PARTITION BY i1 ORDER BY round(similarity, 9) DESC, i2) AS rank
    FROM pea) WHERE rank <= 5)"""

COS_SCORES = """cscore AS (
  SELECT t.user_id, n.i2 AS item, sum(t.rating * n.similarity) AS num,
         sum(abs(n.similarity)) AS den
  FROM train t JOIN cos_nn n ON t.item = n.i1 GROUP BY t.user_id, n.i2),
cscored AS (SELECT *, num / nullif(den, 0) AS score FROM cscore)"""

PEA_ITEMS = """pitems AS (
  SELECT t.item, n.i2 AS item_nn,
         sum(t.rating * n.similarity * 2.0) / nullif(sum(n.similarity + n.similarity), 0) AS prediction
  FROM train t LEFT JOIN pea_nn n ON t.item = n.i1 GROUP BY t.item, n.i2)"""


def _q_recommend() -> str:
    return KNN.rstrip("\n") + ",\n" + COSINE + ",\n" + COS_SCORES + """,
owned AS (SELECT DISTINCT user_id, item FROM log),
cand AS (SELECT s.* FROM cscored s
         WHERE s.score IS NOT NULL
           AND NOT EXISTS (SELECT 1 FROM owned o WHERE o.user_id = s.user_id AND o.item = s.item)),
ranked AS (SELECT user_id, item, score,
                  row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, item) AS rank
           FROM cand)
SELECT user_id, item, """ + R("score") + """ AS score, CAST(rank AS BIGINT) AS rank
FROM ranked WHERE rank <= 5"""


def _null_profile(table: str, cols: list[tuple[str, bool]], src: str) -> str:
    parts = []
    for c, is_float in cols:
        cond = f"{c} IS NULL" + (f" OR isnan({c})" if is_float else "")
        parts.append(f"SELECT '{table}' AS table_name, '{c}' AS column_name, "
                     f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT) AS n_missing FROM {src}")
    return "\nUNION ALL\n".join(parts)


CORR_COLUMNS = ["user_id", "item", "hours", "weight", "mean_hours", "rating"]


def _corr() -> str:
    parts = []
    cols = CORR_COLUMNS
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            parts.append(f"SELECT '{a}' AS a, '{b}' AS b, {R(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))')} AS r FROM rals")
    return with_(LOG, RATED_ALS) + "\nUNION ALL\n".join(parts)


def _sparsity(src: str, label: str) -> str:
    return f"""SELECT '{label}' AS dataset, count(*) AS n_rows, count(DISTINCT user_id) AS n_users,
       count(DISTINCT item) AS n_items,
       {R("(1.0 - count(*) / (count(DISTINCT user_id) * count(DISTINCT item))) * 100.0")} AS sparsity_pct
FROM (SELECT DISTINCT user_id, item, behaviour, hours FROM {src})"""


QUARTILES = """qb AS (
  SELECT quantile_disc(hours, 0.25) AS q1, quantile_disc(hours, 0.5) AS median,
         quantile_disc(hours, 0.75) AS q3 FROM dlog),
bounds AS (SELECT *, q3 - q1 AS iqr, q1 - (q3 - q1) * CAST(1.5 AS DOUBLE) AS lower,
                  q3 + (q3 - q1) * CAST(1.5 AS DOUBLE) AS upper FROM qb)"""


def _rmse_modes(user_sql: str, item_sql: str) -> str:
    return f"""SELECT 'user' AS mode, {R('sqrt(avg((p - t) * (p - t)))')} AS rmse, count(*) AS n FROM ({user_sql})
UNION ALL
SELECT 'item' AS mode, {R('sqrt(avg((p - t) * (p - t)))')} AS rmse, count(*) AS n FROM ({item_sql})"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["q01_log_project"] = with_(LOG) + "SELECT event_id, user_id, item, behaviour, hours FROM log"
    q["q02_null_profile"] = with_(LOG) + "\nUNION ALL\n".join([
        _null_profile("events", [("event_id", False), ("ts", False), ("user_id", False),
                                 ("event_type", False), ("value", True), ("props", False)], "events"),
        _null_profile("documents", [("doc_id", False), ("text", False), ("lang", False),
                                    ("source", False), ("n_chars", False)], "documents"),
        _null_profile("behaviour_log", [("user_id", False), ("item", False), ("behaviour", False),
                                        ("hours", True)], "log"),
    ])
    q["q03_duplicate_groups"] = """SELECT user_id, event_type, value, count(*) AS n
FROM events GROUP BY user_id, event_type, value HAVING count(*) > 1"""
    q["q04_distinct_rows"] = with_(LOG) + "SELECT DISTINCT user_id, item, behaviour, hours FROM log"
    q["q05_cardinalities"] = with_(LOG) + """SELECT count(*) AS n_rows,
  CAST(count(DISTINCT user_id) + max(CASE WHEN user_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_user_id,
  CAST(count(DISTINCT item) + max(CASE WHEN item IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_item,
  CAST(count(DISTINCT hours) + max(CASE WHEN hours IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_hours,
  (SELECT count(*) FROM (SELECT DISTINCT user_id, item, behaviour, hours FROM log)) AS n_distinct_rows
FROM log"""
    q["q06_sparsity"] = with_(LOG, BASKET) + _sparsity("log", "behaviour_log") + \
        "\nUNION ALL\n" + _sparsity("basket", "basket")
    q["q07_top_items"] = with_(LOG, DLOG) + f"""SELECT item, n_rows, {R('total_hours')} AS total_hours FROM (
  SELECT item, count(hours) AS n_rows, sum(hours) AS total_hours FROM dlog GROUP BY item
  ORDER BY n_rows DESC, item LIMIT 10)"""
    for name, beh in (("q08_top_purchased", "purchase"), ("q09_top_played", "play")):
        q[name] = with_(LOG, DLOG) + f"""SELECT item, behaviour, count(*) AS n FROM dlog
WHERE behaviour = '{beh}' GROUP BY item, behaviour ORDER BY n DESC, item LIMIT 10"""
    q["q10_describe_hours"] = with_(LOG) + "\nUNION ALL\n".join(
        f"SELECT '{s}' AS statistic, {R(e)} AS value FROM log" for s, e in [
            ("count", "count(hours)"), ("mean", "avg(hours)"), ("stddev", "stddev_samp(hours)"),
            ("min", "min(hours)"), ("max", "max(hours)")])
    q["q11_iqr_bounds"] = with_(LOG, DLOG, QUARTILES) + \
        "SELECT q1, median, q3, iqr, lower, upper FROM bounds"
    q["q12_outlier_flags"] = with_(LOG, DLOG, QUARTILES) + """SELECT d.user_id, d.item, d.behaviour, d.hours,
  CASE WHEN NOT (d.hours BETWEEN b.lower AND b.upper) THEN 'yes' ELSE 'no' END AS hours_outlier
FROM dlog d, bounds b"""
    q["q13_box_summary"] = with_(LOG, DLOG, QUARTILES) + """SELECT b.q1, b.median, b.q3,
  min(CASE WHEN d.hours BETWEEN b.lower AND b.upper THEN d.hours END) AS whisker_low,
  max(CASE WHEN d.hours BETWEEN b.lower AND b.upper THEN d.hours END) AS whisker_high,
  CAST(sum(CASE WHEN d.hours IS NOT NULL AND NOT (d.hours BETWEEN b.lower AND b.upper) THEN 1 ELSE 0 END) AS BIGINT) AS n_outliers,
  count(d.hours) AS n
FROM dlog d, bounds b GROUP BY b.q1, b.median, b.q3"""
    q["q14_low_hours"] = with_(LOG) + """SELECT CAST(sum(CASE WHEN hours < 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_low,
  count(*) AS n_rows FROM log"""

    q["q15_prev_behaviour"] = with_(LOG, lagged("log", "lg")) + \
        "SELECT event_id, user_id, item, behaviour, hours, prev, weight FROM lg"
    for name, prof in (("q16_transitions_als", "als"), ("q17_transitions_knn", "knn")):
        q[name] = with_(LOG, lagged("log", "lg")) + \
            f"SELECT event_id, user_id, item, behaviour, prev, weight FROM lg WHERE {KEEP[prof]}"
    q["q18_item_mean"] = with_(LOG, lagged("log", "lg")) + f"""SELECT item,
  {R('avg(hours)', 9)} AS mean_hours,
  count(*) AS n_rows FROM lg WHERE {KEEP['knn']} GROUP BY item"""
    q["q19_ratings"] = with_(LOG, RATED_KNN) + f"""SELECT event_id, user_id, item, behaviour, hours, weight,
  {R('mean_hours', 9)} AS mean_hours, rating FROM rknn"""
    q["q20_rating_histogram"] = with_(LOG, RATED_ALS) + \
        "SELECT rating, count(*) AS n FROM rals GROUP BY rating"
    q["q21_correlation"] = _corr()
    q["q22_rating_skew"] = with_(LOG, RATED_ALS) + """SELECT 'user' AS kind, user_id AS key, count(*) AS n_ratings
FROM rals GROUP BY user_id
UNION ALL
SELECT 'item' AS kind, item AS key, count(*) AS n_ratings FROM rals GROUP BY item"""
    q["q23_item_codes"] = with_(LOG, RATED_ALS) + """SELECT item, CAST(dense_rank() OVER (ORDER BY item) - 1 AS BIGINT) AS code
FROM (SELECT DISTINCT item FROM rals WHERE item IS NOT NULL)"""
    q["q24_split_counts"] = with_(LOG, RATED_KNN, BASKET, RATED_BASKET) + f"""SELECT 'behaviour_log' AS dataset,
  CASE WHEN {bucket('rkey')} < 80 THEN 'train' ELSE 'test' END AS split, count(*) AS n
FROM rknn GROUP BY 2
UNION ALL
SELECT 'basket' AS dataset, CASE WHEN {bucket('rkey')} < 80 THEN 'train' ELSE 'test' END AS split,
  count(*) AS n FROM rbas GROUP BY 2"""
    q["q25_residuals"] = with_(BASKET, RATED_BASKET, split("rbas")) + f""", um AS (SELECT user_id, avg(rating) AS user_mean FROM train GROUP BY user_id),
im AS (SELECT item, avg(rating) AS item_mean FROM train GROUP BY item),
gm AS (SELECT avg(rating) AS global_mean FROM train)
SELECT t.user_id, t.item, t.rkey, t.rating, {R('um.user_mean')} AS user_mean,
  {R('im.item_mean')} AS item_mean, {R('gm.global_mean')} AS global_mean,
  {R('t.rating - (um.user_mean + im.item_mean - gm.global_mean)')} AS interaction
FROM train t JOIN um ON t.user_id = um.user_id JOIN im ON t.item = im.item, gm"""

    q["q30_utility_pivot"] = with_(BASKET, RATED_BASKET) + f"""SELECT item, priority,
  {R('avg(rating)')} AS rating
FROM rbas WHERE user_id IS NOT NULL AND item IS NOT NULL AND rating IS NOT NULL
GROUP BY item, priority"""
    norm = """u AS (SELECT item, user_id, avg(rating) AS value FROM rals
       WHERE user_id IS NOT NULL AND item IS NOT NULL AND rating IS NOT NULL GROUP BY item, user_id),
nrm AS (SELECT item, sqrt(sum(value * value)) AS norm FROM u GROUP BY item),
nv AS (SELECT u.item, u.user_id, u.value, n.norm, coalesce(u.value / nullif(n.norm, 0), 0) AS norm_value
       FROM u JOIN nrm n ON u.item = n.item)"""
    q["q31_l2_normalised"] = with_(LOG, RATED_ALS, norm) + \
        f"SELECT item, user_id, {R('value')} AS value, {R('norm')} AS norm, {R('norm_value')} AS norm_value FROM nv"
    q["q32_full_cosine"] = with_(LOG, RATED_ALS, norm) + f"""SELECT a.item AS i1, b.item AS i2,
  {R('sum(a.norm_value * b.norm_value)')} AS similarity
FROM nv a JOIN nv b ON a.user_id = b.user_id AND a.item <> b.item GROUP BY a.item, b.item"""

    q["q33_item_history"] = with_(LOG, RATED_KNN) + \
        "SELECT item, user_id, event_id, rating FROM rknn"
    q["q34_item_pairs"] = KNN + """SELECT a.user_id, a.item AS i1, b.item AS i2,
  sum(CAST(a.rating AS DOUBLE) * a.rating) AS xx, sum(CAST(b.rating AS DOUBLE) * b.rating) AS yy,
  sum(CAST(a.rating AS DOUBLE) * b.rating) AS xy
FROM train a JOIN train b ON a.user_id = b.user_id AND a.item < b.item
GROUP BY a.user_id, a.item, b.item"""
    knn_cos = KNN.rstrip("\n") + ",\n" + COSINE + "\n"
    q["q35_cosine_pairs"] = knn_cos + f"SELECT i1, i2, sx, sy, sxy, {R('similarity')} AS similarity FROM cos"
    q["q35b_cosine_pairs_basket"] = with_(BASKET, RATED_BASKET, split("rbas"), COSINE) + \
        f"SELECT i1, i2, sx, sy, sxy, {R('similarity')} AS similarity FROM cos"
    q["q36_cosine_topk"] = knn_cos + \
        f"SELECT i1, i2, {R('similarity')} AS similarity, CAST(rank AS BIGINT) AS rank FROM cos_nn"
    q["q37_knn_scores"] = knn_cos + f"""SELECT t.item, n.i2 AS item_nn,
  {R('sum(t.rating * n.similarity)')} AS total_ratings, {R('sum(n.similarity + n.similarity)')} AS sim_total
FROM train t LEFT JOIN cos_nn n ON t.item = n.i1 GROUP BY t.item, n.i2"""
    q["q38_cosine_rmse"] = KNN.rstrip("\n") + ",\n" + COSINE + ",\n" + COS_SCORES + "\n" + _rmse_modes(
        "SELECT s.score AS p, x.rating AS t FROM test x JOIN cscored s ON x.user_id = s.user_id "
        "AND x.item = s.item WHERE s.score IS NOT NULL",
        "SELECT r.rating AS p, x.rating AS t FROM (SELECT t.item, t.rating FROM train t "
        "LEFT JOIN cos_nn n ON t.item = n.i1) r JOIN test x ON r.item = x.item")
    cosine_user = ("SELECT s.score AS p, x.rating AS t FROM test x JOIN cscored s "
                   "ON x.user_id = s.user_id AND x.item = s.item WHERE s.score IS NOT NULL")
    knn_c = KNN.rstrip("\n") + ",\n" + CENTRED + "\n"
    q["q39_centred"] = knn_c + f"""SELECT user_id, item, event_id, rating, {R('user_mean')} AS user_mean,
  {R('deviation')} AS deviation FROM centred"""
    knn_p = KNN.rstrip("\n") + ",\n" + CENTRED + ",\n" + PEARSON + "\n"
    q["q40_damped_pearson"] = knn_p + f"""SELECT 'intended' AS mode, i1, i2, {R('similarity')} AS similarity FROM pea
UNION ALL
SELECT 'faithful' AS mode, i1, i2, {R('faithful')} AS similarity FROM pea"""
    q["q41_pearson_topk"] = knn_p + \
        f"SELECT i1, i2, {R('similarity')} AS similarity, CAST(rank AS BIGINT) AS rank FROM pea_nn"
    q["q42_pearson_items"] = knn_p.rstrip("\n") + ",\n" + PEA_ITEMS + \
        f"\nSELECT item, item_nn, {R('prediction')} AS prediction FROM pitems"
    pdev = """pdev AS (
  SELECT c.user_id, n.i2 AS item, sum(c.deviation * n.similarity) / nullif(sum(abs(n.similarity)), 0) AS score
  FROM centred c JOIN pea_nn n ON c.item = n.i1 GROUP BY c.user_id, n.i2)
"""
    pearson_user = ("SELECT u.user_mean + s.score AS p, x.rating AS t FROM test x JOIN pdev s "
                    "ON x.user_id = s.user_id AND x.item = s.item "
                    "JOIN umean u ON s.user_id = u.user_id WHERE s.score IS NOT NULL")
    q["q43_pearson_rmse"] = knn_p.rstrip("\n") + ",\n" + PEA_ITEMS + ",\n" + pdev + _rmse_modes(
        pearson_user,
        "SELECT coalesce(pi.prediction, 0) AS p, x.rating AS t FROM pitems pi JOIN test x "
        "ON pi.item_nn = x.item")
    q["q44_user_summary"] = KNN + f"""SELECT user_id, count(*) AS n_ratings, {R('avg(rating)')} AS user_mean,
  {R('(SELECT avg(rating) FROM train)')} AS global_mean FROM train GROUP BY user_id"""
    q["q45_recommend"] = _q_recommend()
    one = "SELECT '{}' AS model, " + R("sqrt(avg((p - t) * (p - t)))") + " AS rmse, count(*) AS n FROM ({})"
    q["q46_model_comparison"] = (
        KNN.rstrip("\n") + ",\n" + COSINE + ",\n" + COS_SCORES + ",\n" + CENTRED + ",\n" + PEARSON
        + ",\n" + pdev + one.format("cosine", cosine_user) + "\nUNION ALL\n"
        + one.format("pearson", pearson_user))
    bias = with_(BASKET, RATED_BASKET, split("rbas")) + """, um AS (
  SELECT user_id, avg(rating) AS user_mean FROM train GROUP BY user_id),
im AS (SELECT item, avg(rating) AS item_mean FROM train GROUP BY item),
gm AS (SELECT avg(rating) AS global_mean FROM train),
scored AS (SELECT t.*, um.user_mean + im.item_mean - gm.global_mean AS bias
           FROM test t JOIN um ON t.user_id = um.user_id JOIN im ON t.item = im.item, gm)
"""
    q["q48_als_scored"] = bias + f"SELECT user_id, item, rkey, rating, {R('bias')} AS bias FROM scored"
    q["q49_bias_rmse"] = bias + (f"SELECT {R('sqrt(avg((bias - rating) * (bias - rating)))')} AS rmse, "
                                 "count(*) AS n FROM scored")
    q["q50_als_candidates"] = with_(BASKET) + """SELECT user_id, count(DISTINCT item) AS n_owned,
  (SELECT count(DISTINCT item) FROM basket) - count(DISTINCT item) AS n_unseen
FROM basket GROUP BY user_id"""
    q["q51_name_codes"] = """SELECT p_name, CAST(dense_rank() OVER (ORDER BY p_name) - 1 AS BIGINT) AS code
FROM (SELECT DISTINCT p_name FROM part WHERE p_name IS NOT NULL)"""
    q["q52_recommend_named"] = f"""SELECT r.user_id, r.rank, r.item, p.p_name, r.score
FROM ({q["q45_recommend"]}) r LEFT JOIN part p ON r.item = p.p_partkey"""
    # Table t of the hashing takes its four signs from hexadecimal digit t of the md5s.
    q["q53_lsh_neighbours"] = with_(LOG, RATED_ALS, norm, """cells AS (
  SELECT item, user_id, norm_value AS v,
         md5(concat_ws('|', user_id, 0)) || md5(concat_ws('|', user_id, 1)) AS noise
  FROM nv WHERE norm > 0),
digits AS (SELECT item, v, t, CAST('0x' || noise[t + 1] AS BIGINT) AS d
           FROM cells, (SELECT unnest(range(0, 48)) AS t)),
sigs AS (
  SELECT item, t, [round(sum(CASE WHEN d & 1 = 1 THEN v ELSE -v END), 9) > 0,
                   round(sum(CASE WHEN d & 2 = 2 THEN v ELSE -v END), 9) > 0,
                   round(sum(CASE WHEN d & 4 = 4 THEN v ELSE -v END), 9) > 0,
                   round(sum(CASE WHEN d & 8 = 8 THEN v ELSE -v END), 9) > 0] AS sig
  FROM digits GROUP BY item, t),
met AS (SELECT DISTINCT a.item AS i1, b.item AS i2 FROM sigs a JOIN sigs b
        ON a.t = b.t AND a.sig = b.sig AND a.item <> b.item),
near AS (
  SELECT a.item AS i1, b.item AS i2, sum(a.v * b.v) AS similarity
  FROM cells a JOIN cells b ON a.user_id = b.user_id JOIN met ON met.i1 = a.item AND met.i2 = b.item
  GROUP BY a.item, b.item)""") + f"""SELECT i1, i2, {R('similarity')} AS similarity, CAST(rank AS BIGINT) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY i1 ORDER BY round(similarity, 9) DESC, i2) AS rank
      FROM near) WHERE rank <= 5"""
    q["q54_als_folds"] = KNN.rstrip("\n") + """,
fold AS (SELECT *, CAST('0x' || substr(md5('fold|' || rkey), 1, 8) AS BIGINT) % 3 AS fold FROM train)
SELECT f.fold, count(*) AS n_held, (SELECT count(*) FROM fold g WHERE g.fold <> f.fold) AS n_fit,
  count(*) FILTER (WHERE EXISTS (SELECT 1 FROM fold g WHERE g.fold <> f.fold AND g.user_id = f.user_id)
                   AND EXISTS (SELECT 1 FROM fold g WHERE g.fold <> f.fold AND g.item = f.item)) AS n_scored
FROM fold f GROUP BY f.fold"""
    q["q56_behaviour_features"] = with_(LOG) + f"""SELECT event_id, behaviour,
  {R('coalesce(hours, -1)')} AS hours,
  CAST(CASE WHEN p1 IS NULL THEN -1 WHEN p1 = 'purchase' THEN 1 ELSE 0 END AS DOUBLE) AS prev_purchase,
  CAST(CASE WHEN p2 IS NULL THEN -1 WHEN p2 = 'purchase' THEN 1 ELSE 0 END AS DOUBLE) AS prev2_purchase,
  {R('coalesce(h1, -1)')} AS prev_hours,
  {R('coalesce((epoch_us(ts) - epoch_us(t1)) / 3600000000.0, -1)')} AS gap_hours
FROM (SELECT *, lag(behaviour) OVER w AS p1, lag(behaviour, 2) OVER w AS p2, lag(hours) OVER w AS h1,
             lag(ts) OVER w AS t1 FROM log WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"""
    limits = [1580030169, 3160060337, 3950075422, 4213413783, 4279248374, 4292415292, 4294609778,
              4294923276, 4294962463, 4294966817, 4294967253, 4294967292]
    drawn = " + ".join(f"CASE WHEN bits >= {x} THEN 1 ELSE 0 END" for x in limits)
    q["q58_model_difference"] = (
        KNN.rstrip("\n") + ",\n" + COSINE + ",\n" + COS_SCORES + ",\n" + CENTRED + ",\n" + PEARSON
        + ",\n" + pdev.rstrip() + f""",
err AS (
  SELECT x.rkey, c.score - x.rating AS a, u.user_mean + s.score - x.rating AS b
  FROM test x JOIN cscored c ON c.user_id = x.user_id AND c.item = x.item
  JOIN pdev s ON s.user_id = x.user_id AND s.item = x.item JOIN umean u ON u.user_id = x.user_id
  WHERE c.score IS NOT NULL AND s.score IS NOT NULL),
draw AS (SELECT a, b, r, CASE WHEN r = 0 THEN 1 ELSE {drawn} END AS w
         FROM (SELECT a, b, r, CAST('0x' || substr(md5(concat_ws('|', rkey, r)), 1, 8) AS BIGINT) AS bits
               FROM err, (SELECT unnest(range(0, 201)) AS r))),
rep AS (SELECT r, CAST(sum(w) AS BIGINT) AS n, sqrt(sum(a * a * w) / nullif(sum(w), 0)) AS x,
               sqrt(sum(b * b * w) / nullif(sum(w), 0)) AS y FROM draw GROUP BY r),
ends AS (SELECT max(d) FILTER (p = 5) AS low, max(d) FILTER (p = 196) AS high
         FROM (SELECT d, row_number() OVER (ORDER BY d) AS p
               FROM (SELECT coalesce(x - y, 0) AS d FROM rep WHERE r > 0)))
SELECT n, {R('x')} AS rmse_cosine, {R('y')} AS rmse_pearson, {R('x - y')} AS difference,
  {R('low')} AS low, {R('high')} AS high, low > 0 OR high < 0 AS differ FROM rep, ends WHERE r = 0""")
    q["q59_stable_codes"] = with_(BASKET) + """, title AS (
  SELECT p_name || ' #' || p_partkey AS title,
         EXISTS (SELECT 1 FROM basket b WHERE b.item = p.p_partkey AND b.ts < DATE '1995-01-01') AS old
  FROM part p)
SELECT title, CAST(row_number() OVER (ORDER BY NOT old, title) - 1 AS BIGINT) AS code FROM title"""
    q["q60_recommend_active"] = f"""SELECT * FROM ({q["q45_recommend"]}) r
WHERE EXISTS (SELECT 1 FROM events e WHERE e.event_type = 'click' AND e.user_id = r.user_id)"""
    q["q61_csv_rejects"] = """SELECT CASE event_type WHEN 'error' THEN 'behaviour,hours' WHEN 'click' THEN 'user_id'
  WHEN 'signup' THEN 'behaviour,hours' ELSE '' END AS reason, count(*) AS n FROM events GROUP BY 1"""
    q["q62_median_fill"] = with_(LOG) + """SELECT l.event_id, l.item, l.behaviour, l.hours,
  CASE WHEN l.behaviour = 'play' AND l.hours IS NOT NULL THEN l.hours ELSE m.mid END AS filled
FROM log l LEFT JOIN (SELECT item, quantile_disc(hours, 0.5) AS mid FROM log WHERE behaviour = 'play'
                      GROUP BY item) m ON l.item IS NOT DISTINCT FROM m.item"""
    q["q63_basket_topk"] = with_(BASKET, RATED_BASKET, split("rbas"), COSINE, CENTRED, PEARSON) + f"""
SELECT 'cosine' AS model, i1, i2, {R('similarity')} AS similarity, CAST(rank AS BIGINT) AS rank FROM cos_nn
UNION ALL
SELECT 'pearson' AS model, i1, i2, {R('similarity')} AS similarity, CAST(rank AS BIGINT) AS rank FROM pea_nn"""
    q["q64_owned_bitmaps"] = with_(LOG) + """, coded AS (
  SELECT DISTINCT user_id, dense_rank() OVER (ORDER BY item) - 1 AS code
  FROM log WHERE item IS NOT NULL),
word AS (
  SELECT user_id, code // 32768 AS chunk, code % 32768 // 64 AS w, count(*) AS n,
         bit_or(CAST(1 AS UBIGINT) << CAST(code % 64 AS UBIGINT)) AS bits
  FROM coded WHERE user_id IS NOT NULL GROUP BY ALL)
SELECT user_id, CAST(chunk AS BIGINT) AS chunk, CAST(sum(n) AS BIGINT) AS n_items, count(*) AS n_words,
       string_agg(w || ':' || to_hex(bits), ',' ORDER BY w) AS words
FROM word GROUP BY user_id, chunk"""
    q["q65_recommend_bitmaps"] = q["q45_recommend"]
    q["q66_bought_and_played"] = with_(LOG) + """, have AS (
  SELECT user_id, item, count(*) FILTER (behaviour = 'purchase') AS b,
         count(*) FILTER (behaviour = 'play') AS p
  FROM log WHERE user_id IS NOT NULL AND item IS NOT NULL GROUP BY user_id, item)
SELECT user_id, count(*) FILTER (b > 0) AS n_bought, count(*) FILTER (p > 0) AS n_played,
       count(*) FILTER (b > 0 AND p > 0) AS n_both,
       CAST(coalesce(sum(b) FILTER (p > 0), 0) AS BIGINT) AS n_lines
FROM have GROUP BY user_id"""
    return q
