"""CSV inputs end to end: the mapped tables written as the reference's two CSV
files (dates as strings), read back with the explicit schemas, and run
through the feature pipeline; results equal the Parquet-view run."""

import tempfile

import pytest
from pyspark.sql import functions as F

from retention.operators import prices as P
from retention.plans import jobs as J
from retention.sources import files as S
from retention.sources.views import account_view, price_view

SF = "/root/testdata/sf0.001"


def test_csv_roundtrip_features(spark):
    d = tempfile.mkdtemp(prefix="retention-csvjob-")
    client = account_view(spark, SF)
    price = price_view(spark, SF, with_tiebreak=True)
    ordered = price.orderBy("id", "price_date", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                            "l_extendedprice").drop("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                                    "l_extendedprice")
    # client CSV in the logical column order with string ids and dates
    cols = [f.name for f in S.CLIENT_SCHEMA.fields]
    client.select(*[F.col(c).cast("string").alias(c) for c in cols]).coalesce(1).write.option(
        "header", True).csv(d + "/client")
    ordered.select(F.col("id").cast("string").alias("id"), F.col("price_date").cast("string").alias("price_date"),
                   *[c for c in ordered.columns if c.startswith("price_") and c != "price_date"]).coalesce(1).write.option(
        "header", True).csv(d + "/price")
    c2, p2, order = J.load_csv_inputs(spark, d + "/client", d + "/price")
    assert order == ["row_order"]
    assert dict(c2.dtypes)["date_activ"] == "date" and dict(p2.dtypes)["price_date"] == "date"
    a = {r["id"]: r for r in P.price_features(p2).collect()}
    b = {str(r["id"]): r for r in P.price_features(price_view(spark, SF)).collect()}
    assert set(a) == set(b)
    for i in a:
        assert a[i]["offpeak_diff_dec_january_energy"] == pytest.approx(b[i]["offpeak_diff_dec_january_energy"])
        assert a[i]["mean_3m_price_off_peak_fix"] == pytest.approx(b[i]["mean_3m_price_off_peak_fix"])
    # file order is kept: the half-year block over row_order equals the tie-broken one
    h_csv = {r["id"]: r for r in P.half_year_block(p2, None, order_cols=["row_order"]).collect()}
    h_pq = {str(r["id"]): r for r in P.half_year_block(price, None).collect()}
    for i in h_pq:
        assert h_csv[i]["AVG_FIXED"] == pytest.approx(h_pq[i]["AVG_FIXED"])
        assert h_csv[i]["VARIABLE_price_off_peak"] == pytest.approx(h_pq[i]["VARIABLE_price_off_peak"])


def test_all_jobs_from_csv_files_with_other_columns(spark):
    """Shuffled and extra columns, prices over several files; the dates come from the command line."""
    d = tempfile.mkdtemp(prefix="retention-csvall-")
    client, price, tiebreak = J.load_test_inputs(spark, SF)
    names = [f.name for f in S.CLIENT_SCHEMA.fields]
    text = [F.col(c).cast("string").alias(c) for c in reversed(names)]
    client.select(F.lit("x").alias("note"), *text).coalesce(1).write.option("header", True).csv(d + "/client")
    files = price.orderBy("id", "price_date", *tiebreak).drop(*tiebreak).coalesce(1)
    files.select(*reversed(files.columns)).write.option("header", True).option("maxRecordsPerFile", 700).csv(d + "/price")
    dates = ["--cut-6m", "2001-01-01", "--cut-3m", "2001-05-01", "--reference-date", "2001-08-01"]
    csv = ["--client-csv", d + "/client", "--price-csv", d + "/price"]
    J.main(["exploration", *csv, *dates, "--out", d + "/out"])
    assert {r["rejected"] for r in spark.read.parquet(d + "/out/rejects").collect()} == {0}
    got = {r["id"]: r for r in spark.read.parquet(d + "/out/churn_data").collect()}
    want = {str(r["id"]): r for r in J.exploration_job(client, price)["churn_data"].collect()}
    assert set(got) == set(want) and all(r["note"] == "x" for r in got.values())
    for i, r in want.items():
        assert got[i]["mean_3m_price_off_peak_fix"] == pytest.approx(r["mean_3m_price_off_peak_fix"])
    assert spark.read.option("header", True).csv(d + "/out/churn_data_csv").count() == len(want)
    c, p, order = J.load_csv_inputs(spark, d + "/client", d + "/price")
    small = dict(num_trees=(3,), max_depth=(3,), min_leaf=(1,))
    got = {r["id"]: r for r in J.tuned_job(c, p, order, grid=small, folds=2)["premodel"].collect()}
    want = {str(r["id"]): r for r in J.tuned_job(client, price, tiebreak, grid=small, folds=2)["premodel"].collect()}
    assert set(got) == set(want)
    for i, r in want.items():
        assert got[i]["AVG_FIXED"] == pytest.approx(r["AVG_FIXED"])
    tables = J.feature_job(c, p, num_trees=5)
    assert tables["feature_table"].count() == 43 and tables["scored"].count() > 0


def test_rejected_values_are_counted(spark):
    d = tempfile.mkdtemp(prefix="retention-csvbad-")
    names = [f.name for f in S.CLIENT_SCHEMA.fields]
    rows = [{"id": "a", "date_activ": "2010-13-45", "has_gas": "x", "churn": "1.0"}, {"id": "a", "date_activ": "2010-01-02", "has_gas": "t", "churn": "0.5"}]
    spark.createDataFrame([tuple(r.get(c) for c in names) for r in rows], ", ".join(f"{c} string" for c in names)).coalesce(
        1).write.option("header", True).csv(d + "/client")
    prices = [f.name for f in S.PRICE_SCHEMA.fields]
    spark.createDataFrame([("a", "soon") + (None,) * 6], ", ".join(f"{c} string" for c in prices)).write.option(
        "header", True).csv(d + "/price")
    client, price = S.load_client_csv(spark, d + "/client"), S.load_price_csv(spark, d + "/price")
    assert sorted(r["churn"] is None for r in client.rows.collect()) == [False, True]
    found = J.csv_rejects(client, price)
    got = {r["column"]: r["rejected"] for r in found["rejects"].collect() if r["rejected"]}
    assert got == {"date_activ": 1, "has_gas": 1, "churn": 1, "price_date": 1}
    assert sorted((r["line"], r["column"], r["value"]) for r in found["reject_rows"].collect()) == [
        (2, "date_activ", "2010-13-45"), (2, "has_gas", "x"), (2, "price_date", "soon"), (3, "churn", "0.5")]


def test_jobs_leave_no_stored_tables(spark):
    import os
    d = tempfile.mkdtemp(prefix="retention-scope-")
    before = set(os.listdir(spark.conf.get("spark.checkpoint.dir"))), {t.name for t in spark.catalog.listTables()}
    J.main(["exploration", "--sf-dir", SF, "--out", d])
    after = set(os.listdir(spark.conf.get("spark.checkpoint.dir"))), {t.name for t in spark.catalog.listTables()}
    assert after == before and spark.read.parquet(d + "/churn_data").count() > 0


def test_further_numeric_columns_reach_the_summaries(spark):
    d = tempfile.mkdtemp(prefix="retention-csvmore-")
    client = account_view(spark, SF)
    cols = [f.name for f in S.CLIENT_SCHEMA.fields]
    client.select(*[F.col(c).cast("string").alias(c) for c in cols if c != "churn"], F.col("churn").cast("double").cast("string").alias("churn"),
                  (F.col("id") % 7).cast("string").alias("score"), F.lit("word").alias("word")).coalesce(1).write.option("header", True).csv(d + "/client")
    price_view(spark, SF).select(*[F.col(f.name).cast("string").alias(f.name) for f in S.PRICE_SCHEMA.fields]).write.option(
        "header", True).csv(d + "/price")
    c, p, _ = J.load_csv_inputs(spark, d + "/client", d + "/price")
    assert dict(c.dtypes)["score"] == "bigint" and c.where("churn is null").count() == 0       # labels written as 1.0
    tables = J.exploration_job(c, p)
    described = {r["column_name"]: r for r in tables["describe_client"].collect()}
    assert described["score"]["max"] == 6.0 and "word" not in described
    ft = J.feature_job(c, p, num_trees=3)
    assert {r["col_a"] for r in ft["feature_corr"].collect()} >= {"score"} and "score" in {r["features"] for r in ft["importances"].collect()}
