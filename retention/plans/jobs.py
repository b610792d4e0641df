"""The three reference jobs as Spark jobs.

* ``exploration_job`` -- profile, distributions, price windows, correlation,
  and the published ``churn_data`` table (EDA).
* ``feature_job``     -- feature table, 75/25 split, 1000-tree forest,
  metrics, importances, scored test rows (FE).
* ``tuned_job``       -- premodel table, 80/20 split, 100-tree forest,
  grid search, tuned 200-tree forest, metrics (RF).

Each returns a dict of result DataFrames (lazy where possible); with
``out_dir`` the tables that the reference wrote to disk are written as
Parquet (``<name>``, typed stage boundaries) and CSV (``<name>_csv``).

Command line (test views, or CSV files with their own dates)::

    python -m retention.plans.jobs exploration --sf-dir /root/testdata/sf0.01 --out /shared/out
    python -m retention.plans.jobs features --client-csv c.csv --price-csv p.csv --out /shared/out \\
        --cut-6m 2015-06-01 --cut-3m 2015-10-01 --reference-date 2016-01-01
"""

from __future__ import annotations

import argparse
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retention.config import DEFAULT, Params
from retention.operators import distributions as D
from retention.operators import evaluate as EV
from retention.operators import model as M
from retention.operators import prices as P
from retention.operators import profile as PR
from retention.operators import relations as R
from retention.operators.columns import drop_columns
from retention.plans import features as FT
from retention.session import bucketed, materialize, stored_scope
from retention.sources import files as S
from retention.plans.table_queries import CONSUMPTION, FORECAST, HIST_ALL, SKEWED
from retention.sources.schemas import PRICE_COLUMNS
from retention.sources.views import PRICE_TIEBREAK, account_view, price_view


# Columns of the density plots and the rows they take, once flags are 0 and 1 -- fixed values.
DENSITY_ROWS = {"cons_12m": "true", "cons_gas_12m": "has_gas = 1", "cons_last_month": "true"}


def load_test_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """Client and price tables mapped from the star-schema test tables;
    the third value is the row-order columns of the price table."""
    return account_view(spark, sf_dir), price_view(spark, sf_dir, with_tiebreak=True), list(PRICE_TIEBREAK)


def load_csv_inputs(spark: SparkSession, client_path: str, price_path: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """Client and price CSV files; price rows keep their file order as ``row_order``."""
    client, price = S.load_client_csv(spark, client_path), S.load_price_csv(spark, price_path, "row_order")
    return client.rows, price.rows, ["row_order"]


def csv_rejects(*loaded: S.LoadedCsv) -> dict[str, DataFrame]:
    """``rejects`` (column, rejected), the counts of the loading reads, and ``reject_rows``
    (file, line, column, value)."""
    spark = loaded[0].rows.sparkSession
    rows = [item for x in loaded for item in x.rejected.items()]
    listed = reduce(DataFrame.unionByName, (x.rejects for x in loaded))
    return {"rejects": spark.createDataFrame(rows, "column string, rejected bigint"), "reject_rows": listed}


def _write(tables: dict, names: list[str], out_dir: str | None) -> None:
    if not out_dir:
        return
    for n in names:
        S.write_table(tables[n], f"{out_dir.rstrip('/')}/{n}")
        S.write_csv(tables[n], f"{out_dir.rstrip('/')}/{n}_csv")


def _cut(client: DataFrame, enabled: bool) -> DataFrame:
    """The client table (one row per client) feeds a dozen summaries: write it
    once, bucketed by id, instead of recomputing its plan and shuffling it for each join.
    Joins on ``id`` need it to be unique: a repeated one raises."""
    client = bucketed(client, "client") if enabled else client
    if twice := client.groupBy("id").count().filter("count > 1").select("id").head(3):
        raise ValueError(f"client ids that occur more than once, such as {[r['id'] for r in twice]}")
    return client


def exploration_job(client: DataFrame, price: DataFrame, params: Params = DEFAULT,
                    out_dir: str | None = None, cut_client: bool = True) -> dict[str, DataFrame]:
    client = _cut(client, cut_client)
    price = materialize(price.select("id", "price_date", *PRICE_COLUMNS), "price")
    numeric = PR.numeric_columns(client, exclude=("id",))
    means = bucketed(P.window_means(price, params), "window-means")
    churn_data = FT.churn_data(client, price, params, means=means)
    corr_cols = P.window_mean_columns() + ["churn"]
    price_churn = materialize(means.join(client.select("id", "churn"), "id", "inner"), "price-churn")
    corr = R.correlation(price_churn, corr_cols)
    tables = {
        "info_client": PR.info(client),
        "info_price": PR.info(price),
        "shape_client": PR.shape(client),
        "shape_price": PR.shape(price),
        "describe_client": PR.describe(client, numeric),
        "describe_price": PR.describe(price, PRICE_COLUMNS),
        "nulls_client": PR.null_counts(client),
        "nulls_price": PR.null_counts(price),
        "class_share": D.class_share(client),
        "box_stats": D.box_stats(client, CONSUMPTION + FORECAST, by="churn"),
        "hist_by_churn": D.histogram(client, HIST_ALL, params.hist_bins, by="churn"),
        "hist_gas_by_churn": D.histogram(client.filter(F.col("has_gas") == "t"), ["cons_gas_12m"],
                                         params.hist_bins, by="churn"),
        "freq_of_freq_price": PR.freq_of_freq(price, "id"),
        "value_counts_price_date": PR.value_counts(price, "price_date"),
        "hist_price": D.histogram(price, PRICE_COLUMNS, params.price_bins),
        "price_churn_corr": corr,
        "churn_data": churn_data,
    }
    _write(tables, ["churn_data", "price_churn_corr"], out_dir)
    return tables


def feature_job(client: DataFrame, price: DataFrame, params: Params = DEFAULT, out_dir: str | None = None,
                num_trees: int = 1000, cut_client: bool = True) -> dict[str, DataFrame]:
    client = _cut(client, cut_client)
    price = price.select("id", "price_date", *PRICE_COLUMNS)
    engineered = bucketed(FT.engineered_table(client, price, params), "engineered")
    ft = drop_columns(engineered, FT.CORRELATED_DROP)
    merged = client.join(engineered.select("id"), "id", "left_semi")      # ids are unique: the clients of the merged table
    train, test = M.split(ft, params.test_share_fe, params.seed)
    feats = M.feature_columns(ft)
    model = M.fit_forest(train, feats, M.ForestConfig(num_trees=num_trees, seed=params.seed))
    scored = materialize(M.score(model, test, keep=feats), "scored")
    densities = {f"density_{kind}_{c}": t for c, rows in DENSITY_ROWS.items()
                 for kind, t in zip(("hist", "kde"), D.density(engineered.filter(rows), c))}
    tables = {
        "feature_table": ft,
        "churn_by_tenure": R.rate_by(engineered, "tenure"),
        "churn_by_gas": R.rate_by(engineered, "has_gas"),
        "value_counts_channel": PR.value_counts(merged, "channel_sales"),
        "value_counts_origin": PR.value_counts(merged, "origin_up"),
        "describe_skewed_before": PR.describe(merged, SKEWED),
        "describe_skewed_after": PR.describe(engineered, SKEWED),
        **densities,
        "feature_corr": R.correlation(engineered, PR.numeric_columns(engineered, exclude=("id",))),
        "test_labels": EV.label_distribution(scored, "label"),
        "metrics": EV.metrics(scored),
        "importances": M.importances(model, feats),
        "scored": scored,
    }
    if out_dir:
        S.write_scored(scored, f"{out_dir.rstrip('/')}/scored")
        S.write_csv(scored.sparkSession.read.parquet(f"{out_dir.rstrip('/')}/scored"), f"{out_dir.rstrip('/')}/scored_csv")
        _write(tables, ["feature_table", "importances", "metrics"], out_dir)
    return tables


def tuned_job(client: DataFrame, price: DataFrame, order_cols: list[str], params: Params = DEFAULT,
              out_dir: str | None = None, grid: dict | None = None, folds: int = 5,
              cut_client: bool = True) -> dict[str, DataFrame]:
    client = _cut(client, cut_client)
    price = materialize(price.select("id", "price_date", *order_cols, *PRICE_COLUMNS), "price-rows")
    pm = bucketed(FT.premodel(client, price, params, order_cols=order_cols), "premodel")
    train, test = M.split(pm, params.test_share_rf, params.seed)
    feats = M.feature_columns(pm)
    base = M.fit_forest(train, feats, M.ForestConfig(num_trees=100, seed=params.seed))
    grid = grid or {}
    found = M.grid_search(train, feats, seed=params.seed, folds=folds, **grid)
    tuned = M.fit_forest(train, feats, M.ForestConfig(num_trees=200, max_depth=30, min_instances_per_node=1,
                                                      seed=params.seed))
    tables = {
        "premodel": pm,
        "baseline_metrics": EV.metrics(M.score(base, test)),
        "grid": found.table,
        "grid_best_metrics": EV.metrics(M.score(found.model, test)),
        "tuned_metrics": EV.metrics(M.score(tuned, test)),
    }
    _write(tables, ["premodel", "baseline_metrics", "grid", "tuned_metrics"], out_dir)
    return tables


def main(argv=None) -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("job", choices=["exploration", "features", "tuned"])
    ap.add_argument("--sf-dir")
    ap.add_argument("--client-csv")
    ap.add_argument("--price-csv")
    ap.add_argument("--out", required=True)
    ap.add_argument("--cut-6m", default=DEFAULT.cut_6m, help="the 6-month window takes prices after this date")
    ap.add_argument("--cut-3m", default=DEFAULT.cut_3m, help="the 3-month window takes prices after this date")
    ap.add_argument("--reference-date", default=DEFAULT.reference_date, help="months are counted up to this date")
    args = ap.parse_args(argv)
    params = replace(DEFAULT, cut_6m=args.cut_6m, cut_3m=args.cut_3m, reference_date=args.reference_date)
    from retention.session import build_session
    spark = SparkSession.getActiveSession() or build_session()
    with stored_scope(spark):       # results are written inside; stage tables go at the end
        if args.sf_dir:
            client, price, order = load_test_inputs(spark, args.sf_dir)
        else:
            loaded = S.load_client_csv(spark, args.client_csv), S.load_price_csv(spark, args.price_csv, "row_order")
            _write(csv_rejects(*loaded), ["rejects", "reject_rows"], args.out)
            client, price, order = loaded[0].rows, loaded[1].rows, ["row_order"]
        if args.job == "exploration":
            exploration_job(client, price, params, out_dir=args.out)
        elif args.job == "features":
            feature_job(client, price, params, out_dir=args.out)
        else:
            tuned_job(client, price, order, params, out_dir=args.out)


if __name__ == "__main__":
    main()
