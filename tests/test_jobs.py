"""End-to-end: the three jobs on the smallest test tables (small forests)."""

import tempfile

import pytest

from retention.plans import jobs as J

SF = "/root/testdata/sf0.001"


def test_exploration_job_writes_churn_data(spark):
    client, price, _ = J.load_test_inputs(spark, SF)
    out = tempfile.mkdtemp(prefix="retention-job-")
    tables = J.exploration_job(client, price, out_dir=out)
    n = spark.read.parquet(out + "/churn_data").count()
    assert n == tables["churn_data"].count() == 43  # ids with prices in all three windows
    assert tables["class_share"].count() == 2


def test_feature_job(spark):
    client, price, _ = J.load_test_inputs(spark, SF)
    out = tempfile.mkdtemp(prefix="retention-job-")
    tables = J.feature_job(client, price, out_dir=out, num_trees=20)
    m = tables["metrics"].first()
    assert m["tn"] + m["fp"] + m["fn"] + m["tp"] == tables["scored"].count()
    scored = spark.read.parquet(out + "/scored")
    assert {"id", "churn", "prediction", "churn_probability", "cons_12m", "tenure"} <= set(scored.columns)
    as_csv = spark.read.option("header", True).csv(out + "/scored_csv")
    assert as_csv.columns == scored.columns and as_csv.count() == scored.count()
    corr = {r["col_a"] for r in tables["feature_corr"].collect()}
    assert {"num_years_antig", "forecast_cons_year"} <= corr
    assert tables["describe_skewed_after"].count() == 10
    assert tables["density_kde_cons_gas_12m"].count() == 200
    assert sum(r["count"] for r in tables["value_counts_channel"].collect()) == tables["feature_table"].count()


def test_repeated_client_id_raises(spark):
    client, price, _ = J.load_test_inputs(spark, SF)
    with pytest.raises(ValueError, match="more than once"):
        J.exploration_job(client.unionByName(client.limit(1)), price)


def test_tuned_job_small_grid(spark):
    client, price, order = J.load_test_inputs(spark, SF)
    tables = J.tuned_job(client, price, order, grid=dict(num_trees=(5,), max_depth=(3,), min_leaf=(1,)), folds=3)
    assert tables["grid"].count() == 1
    assert tables["tuned_metrics"].first()["accuracy"] >= 0.0
