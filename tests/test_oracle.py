"""The driver's gate in small: Spark result vs DuckDB SQL on sf0.001 for a
representative subset (the full set runs with
``python -m ludex.plans.compare /root/testdata/sf0.01``)."""

import pytest

import __spark_entry__ as entry
from ludex.plans.compare import compare, duckdb_conn

SUBSET = ["q02_null_profile", "q05_cardinalities", "q11_iqr_bounds", "q13_box_summary",
          "q15_prev_behaviour", "q19_ratings", "q23_item_codes", "q25_residuals",
          "q30_utility_pivot", "q32_full_cosine", "q33_item_history", "q35_cosine_pairs",
          "q38_cosine_rmse", "q40_damped_pearson", "q42_pearson_items", "q43_pearson_rmse",
          "q45_recommend", "q46_model_comparison", "q48_als_scored", "q49_bias_rmse",
          "q50_als_candidates", "q51_name_codes", "q52_recommend_named", "q54_als_folds",
          "q56_behaviour_features", "q58_model_difference", "q59_stable_codes",
          "q60_recommend_active", "q61_csv_rejects", "q62_median_fill", "q63_basket_topk",
          "q64_owned_bitmaps", "q65_recommend_bitmaps", "q66_bought_and_played"]


@pytest.fixture(scope="module")
def con(sf_small):
    return duckdb_conn(sf_small)


def test_every_sql_query_is_registered():
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs)
    from ludex.plans.queries import MODEL_QUERIES, QUERIES
    assert set(QUERIES) - set(sqls) == MODEL_QUERIES


@pytest.mark.parametrize("name", SUBSET)
def test_matches_duckdb(spark, con, sf_small, name):
    r = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], sf_small)
    assert r["match"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["user_id", "item", "score", "rank"]
    assert df.count() > 0
