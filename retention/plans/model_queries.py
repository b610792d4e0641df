"""Registered composed tables (churn_data, feature_table, premodel), the split,
rule-score evaluation and forest queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from retention.config import DEFAULT
from retention.functions.scalars import log10p1
from retention.operators import evaluate as EV
from retention.operators import model as M
from retention.operators import prices as P
from retention.operators import profile as PR
from retention.operators import relations as R
from retention.session import materialize, stored_path
from retention.plans import features as FT
from retention.plans.price_queries import (
    _endpoint_body,
    _window_means_sql_body,
    half_year_sql_body,
    price_feature_columns,
    price_features_sql_body,
)
from retention.plans.registry import finish, q, register, round_outer
from retention.plans.table_queries import (
    ACCOUNT_DOUBLES,
    ACCOUNT_DTYPES,
    CHANNEL_LEVELS,
    MERGED_SQL,
    ORIGIN_LEVELS,
    SKEWED,
    TENURE_SQL,
    _corr_sql,
    _dummy_sql,
    _log_sql,
    _months_sql,
)
from retention.sources.views import account_view, price_view, with_views

CLIENT_NO_CHURN = [c for c, _ in ACCOUNT_DTYPES if c != "churn"]


# ---------------------------------------------------------------- composed tables
def _churn_data_sql():
    cols = [f"a.{c}" for c in CLIENT_NO_CHURN] + [f"w.{c}" for c in P.window_mean_columns()] + ["a.churn"]
    body = f"SELECT {', '.join(cols)} FROM account a JOIN ({_window_means_sql_body()}) w ON a.id = w.id"
    return with_views(round_outer(body, ACCOUNT_DOUBLES + P.window_mean_columns()))


@register("churn_data", _churn_data_sql)
def q_churn_data(spark, d):
    return finish(FT.churn_data(account_view(spark, d), price_view(spark, d)))


def feature_table_sql_parts(dropped=FT.CORRELATED_DROP):
    """(SQL body, output column names, double columns) of the feature table without the columns ``dropped``."""
    dates = set(FT.DATE_COLUMNS)
    drop = set(dropped)
    cols, names = [], []
    for c in CLIENT_NO_CHURN:
        if c in dates or c in drop or c in ("channel_sales", "origin_up"):
            continue
        if c in DEFAULT.log_columns:
            cols.append(f"{_log_sql('a.' + c)} AS {c}")
        elif c == "has_gas":
            cols.append("CASE WHEN a.has_gas = 't' THEN 1 WHEN a.has_gas = 'f' THEN 0 END AS has_gas")
        else:
            cols.append(f"a.{c}")
        names.append(c)
    cols += [f"f.{c}" for c in price_feature_columns()] + ["a.churn"]
    names += price_feature_columns() + ["churn"]
    cols += [TENURE_SQL.replace("date_", "a.date_") + " AS tenure",
             _months_sql("a.date_activ") + " AS months_activ",
             _months_sql("a.date_end", True) + " AS months_to_end",
             _months_sql("a.date_modif_prod") + " AS months_modif_prod",
             _months_sql("a.date_renewal") + " AS months_renewal"]
    names += ["tenure", "months_activ", "months_to_end", "months_modif_prod", "months_renewal"]
    cols += _dummy_sql("a.channel_sales", "channel", CHANNEL_LEVELS) + _dummy_sql("a.origin_up", "origin_up", ORIGIN_LEVELS)
    names += [f"channel_{v}" for v in CHANNEL_LEVELS] + [f"origin_up_{v}" for v in ORIGIN_LEVELS]
    body = f"SELECT {', '.join(cols)} FROM account a JOIN ({price_features_sql_body()}) f ON a.id = f.id"
    doubles = [c for c in ACCOUNT_DOUBLES if c not in drop] + price_feature_columns()
    return body, names, doubles


def _feature_table_sql():
    body, _, doubles = feature_table_sql_parts()
    return with_views(round_outer(body, doubles))


@register("feature_table", _feature_table_sql)
def q_feature_table(spark, d):
    return finish(FT.feature_table(account_view(spark, d), price_view(spark, d)))


def _feature_corr_sql():
    body, names, _ = feature_table_sql_parts(dropped=())
    return with_views(_corr_sql(body, [c for c in names if c != "id"]))


@register("feature_corr", _feature_corr_sql)
def q_feature_corr(spark, d):
    """A15 over the feature job's table, long form, before the review of this result drops columns."""
    ft = materialize(FT.engineered_table(account_view(spark, d), price_view(spark, d)), "engineered")
    return finish(R.correlation(ft, [c for c in ft.columns if c != "id"]))


def _describe_skewed_sql(body):
    parts = []
    for c in SKEWED:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS column_name, count({x}) AS count, avg({x}) AS mean, stddev_samp({x}) AS std, "
            f"min({x}) AS min, quantile_cont({x}, 0.25) AS p25, quantile_cont({x}, 0.5) AS p50, "
            f"quantile_cont({x}, 0.75) AS p75, max({x}) AS max FROM ft")
    inner = f"WITH ft AS ({body}) " + " UNION ALL ".join(parts)
    return with_views(round_outer(inner, ["mean", "std", "min", "p25", "p50", "p75", "max"]))


@register("describe_skewed_log", lambda: _describe_skewed_sql(feature_table_sql_parts(dropped=())[0]))
def q_describe_skewed(spark, d):
    """P3 on the skewed columns of the merged table after the log step."""
    merged = FT.merged_clients(account_view(spark, d), price_view(spark, d))
    logs = [log10p1(F.col(c)).alias(c) if c in DEFAULT.log_columns else F.col(c) for c in SKEWED]
    return finish(PR.describe(materialize(merged.select(*logs), "skewed-log"), SKEWED))


@register("describe_skewed_raw", lambda: _describe_skewed_sql(f"SELECT * FROM {MERGED_SQL} m"))
def q_describe_skewed_raw(spark, d):
    """P3 on the skewed columns of the merged table before the log step."""
    merged = FT.merged_clients(account_view(spark, d), price_view(spark, d))
    return finish(PR.describe(materialize(merged.select(*SKEWED), "skewed-raw"), SKEWED))


PREMODEL_DOUBLES = ["cons_12m", "cons_gas_12m", "cons_last_month", "forecast_discount_energy",
                    "margin_gross_pow_ele", "margin_net_pow_ele", "pow_max", "AVG_VARIABLE", "AVG_FIXED",
                    *P.ENDPOINT_COLUMNS]


def premodel_sql_body() -> str:
    keep = [c for c in FT.PREMODEL_KEEP if c not in ("channel_sales", "origin_up", "churn", "AVG_VARIABLE", "AVG_FIXED")]
    cols = [f"a.{c}" for c in keep] + ["h.AVG_VARIABLE", "h.AVG_FIXED"]
    cols += _dummy_sql("a.origin_up", "origin_up", ORIGIN_LEVELS) + _dummy_sql("a.channel_sales", "channel_sales", CHANNEL_LEVELS)
    cols += [f"e.{c}" for c in P.ENDPOINT_COLUMNS] + ["a.churn"]
    return (f"SELECT {', '.join(cols)} FROM account a JOIN ({half_year_sql_body()}) h ON a.id = h.id "
            f"JOIN ({_endpoint_body()}) e ON a.id = e.id WHERE a.churn IS NOT NULL")


@register("premodel", lambda: with_views(round_outer(premodel_sql_body(), PREMODEL_DOUBLES)))
def q_premodel(spark, d):
    return finish(_premodel(spark, d))


def _premodel(spark, d):
    # the joined price rows feed the half-year block and the endpoint delta: join them once
    price = materialize(price_view(spark, d, with_tiebreak=True), "price-rows")
    return FT.premodel(account_view(spark, d), price)


# ---------------------------------------------------------------- split and rule score
def _bucket_sql(key: str, seed: int) -> str:
    return f"(('0x' || substr(md5(CAST({key} AS VARCHAR) || '{seed}'), 1, 8))::BIGINT % 10000)"


@register("hash_split", lambda: with_views(
    f"SELECT id, CASE WHEN {_bucket_sql('id', DEFAULT.seed)} < {int(round(DEFAULT.test_share_rf * 10000))} "
    "THEN 'test' ELSE 'train' END AS split FROM account"))
def q_hash_split(spark, d):
    return M.with_split(account_view(spark, d).select("id"), DEFAULT.test_share_rf, DEFAULT.seed)


@register("hash_split_fe", lambda: with_views(
    f"SELECT id, CASE WHEN {_bucket_sql('id', DEFAULT.seed)} < {int(round(DEFAULT.test_share_fe * 10000))} "
    f"THEN 'test' ELSE 'train' END AS split FROM {MERGED_SQL} m"))
def q_hash_split_fe(spark, d):
    """M1: the feature job's 75/25 split of the merged clients."""
    merged = FT.merged_clients(account_view(spark, d), price_view(spark, d))
    return M.with_split(merged.select("id"), DEFAULT.test_share_fe, DEFAULT.seed)


def exact_test_ids_sql(body: str, share: float) -> str:
    """SQL for the ids of the exact split's test rows: the ceil(share * n) of smallest hash, ties by id."""
    h = f"('0x' || substr(md5(CAST(id AS VARCHAR) || '{DEFAULT.seed}'), 1, 15))::BIGINT"
    return (f"SELECT id FROM (SELECT id, row_number() OVER (ORDER BY {h}, id) AS k, count(*) OVER () AS n FROM ({body}) b) r "
            f"WHERE k <= ceil({share} * n)")


def _exact_split_sql(body: str, share: float) -> str:
    return with_views(f"SELECT id, CASE WHEN id IN ({exact_test_ids_sql(body, share)}) THEN 'test' ELSE 'train' END AS split FROM ({body}) t")


@register("exact_split", lambda: _exact_split_sql("SELECT id FROM account", DEFAULT.test_share_rf))
def q_exact_split(spark, d):
    """M1: the tuned job's 80/20 split, exactly ceil(0.2 n) test rows."""
    return M.with_exact_split(account_view(spark, d).select("id"), DEFAULT.test_share_rf, DEFAULT.seed)


@register("exact_split_fe", lambda: _exact_split_sql(f"SELECT id FROM {MERGED_SQL} m", DEFAULT.test_share_fe))
def q_exact_split_fe(spark, d):
    """M1: the feature job's 75/25 split of the merged clients, exactly ceil(0.25 n) test rows."""
    merged = materialize(FT.merged_clients(account_view(spark, d), price_view(spark, d)).select("id"), "merged-ids")
    return M.with_exact_split(merged, DEFAULT.test_share_fe, DEFAULT.seed)


@register("stratified_folds", lambda: with_views(
    "SELECT id, churn, CAST((row_number() OVER (PARTITION BY churn ORDER BY id) - 1) % 5 AS INTEGER) AS fold FROM account"))
def q_stratified_folds(spark, d):
    """Five folds dealt within each label by id."""
    return M.with_folds(account_view(spark, d).select("id", "churn"), 5)


# Deterministic rule used to test the evaluation operators without a model.
RULE_SQL = "CAST(CASE WHEN nb_prod_act < 10 THEN 1.0 ELSE 0.0 END AS DOUBLE)"


def _rule_scored(spark, d):
    a = materialize(account_view(spark, d).select("id", "churn", "nb_prod_act"), "rule-rows")
    _, test = M.split(a, DEFAULT.test_share_rf, DEFAULT.seed)
    return test.select(F.col("churn").cast("double").alias("label"),
                       F.when(F.col("nb_prod_act") < 10, F.lit(1.0)).otherwise(F.lit(0.0)).alias("prediction"))


def _rule_test_sql():
    return (f"SELECT CAST(churn AS DOUBLE) AS label, {RULE_SQL} AS prediction FROM account "
            f"WHERE id IN ({exact_test_ids_sql('SELECT id FROM account', DEFAULT.test_share_rf)})")


def _confusion_sql():
    return (f"SELECT count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn, "
            f"count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp, "
            f"count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn, "
            f"count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp FROM ({_rule_test_sql()}) s")


@register("rule_confusion", lambda: with_views(_confusion_sql()))
def q_rule_confusion(spark, d):
    return EV.confusion(_rule_scored(spark, d))


def _metrics_sql():
    r = "CASE WHEN ({b}) <> 0 THEN ({a}) / ({b}) ELSE 0.0 END"
    prec = r.format(a="CAST(tp AS DOUBLE)", b="CAST(tp + fp AS DOUBLE)")
    rec = r.format(a="CAST(tp AS DOUBLE)", b="CAST(tp + fn AS DOUBLE)")
    body = (f"SELECT tn, fp, fn, tp, {r.format(a='CAST(tp + tn AS DOUBLE)', b='CAST(tn + fp + fn + tp AS DOUBLE)')} AS accuracy, "
            f"{prec} AS precision, {rec} AS recall, "
            f"CASE WHEN ({prec}) + ({rec}) <> 0 THEN 2.0 * ({prec}) * ({rec}) / (({prec}) + ({rec})) ELSE 0.0 END AS f1 "
            f"FROM ({_confusion_sql()}) c")
    return with_views(round_outer(body, ["accuracy", "precision", "recall", "f1"]))


@register("rule_metrics", _metrics_sql)
def q_rule_metrics(spark, d):
    return finish(EV.metrics(_rule_scored(spark, d)))


@register("rule_confusion_long", lambda: with_views(
    f"SELECT label, prediction, count(*) AS n FROM ({_rule_test_sql()}) s GROUP BY label, prediction"))
def q_rule_confusion_long(spark, d):
    return EV.confusion_long(_rule_scored(spark, d))


@register("test_label_distribution", lambda: with_views(
    f"SELECT label, count(*) AS count FROM ({_rule_test_sql()}) s GROUP BY label"))
def q_test_labels(spark, d):
    return EV.label_distribution(_rule_scored(spark, d), "label")


# ---------------------------------------------------------------- forests
_STORED: dict[tuple, dict[str, str]] = {}


def _stored(spark, d: str, name: str, build) -> dict:
    """The tables that ``build`` returns, stored once per session and input folder: several views read one forest."""
    key = (spark.sparkContext.applicationId, spark.sparkContext.startTime, d, name)
    if key not in _STORED:
        paths = {}
        for n, df in build().items():
            paths[n] = stored_path(spark, f"{name}-{n}")
            df.write.parquet(paths[n])
        _STORED[key] = paths
    return {n: spark.read.parquet(p) for n, p in _STORED[key].items()}


def _forest(spark, d: str, name: str, table, share: float, cfg: M.ForestConfig) -> dict:
    """M2-M6, M9: a fitted forest's scored test rows, importances, and parameters as the fitted model holds them."""
    def build():
        rows = materialize(table(spark, d), name)
        train, test = M.split(rows, share, DEFAULT.seed)
        feats = M.feature_columns(rows)
        model = M.fit_forest(train, feats, cfg)
        return {"scored": M.score(model, test), "importances": M.importances(model, feats), "parameters": M.parameters(model)}
    return _stored(spark, d, name, build)


def _base_forest(spark, d):
    """M3: 100 trees on the tuned job's table, seed 42, 80/20 split."""
    return _forest(spark, d, "forest-base", _premodel, DEFAULT.test_share_rf, M.ForestConfig(num_trees=100, seed=DEFAULT.seed))


def _tuned_forest(spark, d):
    """M4: 200 trees, depth 30, leaf 1, seed 42."""
    return _forest(spark, d, "forest-tuned", _premodel, DEFAULT.test_share_rf,
                   M.ForestConfig(num_trees=200, max_depth=30, min_instances_per_node=1, seed=DEFAULT.seed))


def _fe_forest(spark, d):
    """M2: 1000 trees on the feature job's table, 75/25 split."""
    return _forest(spark, d, "forest-fe", lambda s, p: FT.feature_table(account_view(s, p), price_view(s, p)), DEFAULT.test_share_fe,
                   M.ForestConfig(num_trees=1000, seed=DEFAULT.seed))


@register("forest_scores")
def q_forest_scores(spark, d):
    """M3 + M5 + M6: scored test rows of the 100-tree forest."""
    return _base_forest(spark, d)["scored"]


@register("forest_metrics")
def q_forest_metrics(spark, d):
    """M3 + M7 + M8: confusion counts and metrics of the 100-tree forest."""
    return EV.metrics(q_forest_scores(spark, d))


@register("forest_tuned_metrics")
def q_forest_tuned(spark, d):
    """M4 + M7 + M8: metrics of the tuned forest."""
    return EV.metrics(_tuned_forest(spark, d)["scored"])


@register("forest_importance")
def q_forest_importance(spark, d):
    """M9 + O2: importances of the 1000-tree forest, ascending."""
    return _fe_forest(spark, d)["importances"].orderBy("importance", "features")


@register("forest_fe_metrics")
def q_forest_fe_metrics(spark, d):
    """M2 + M7 + M8: metrics of the 1000-tree forest on its 25 % test rows."""
    return EV.metrics(_fe_forest(spark, d)["scored"])


# What must hold of any fitted forest, with an SQL twin for the rows it must hold of.
def _test_rows_sql(body: str, share: float) -> str:
    return f"SELECT id, CAST(churn AS DOUBLE) AS label FROM ({body}) t WHERE id IN ({exact_test_ids_sql(body, share)})"


@register("forest_scores_check", lambda: with_views(
    "SELECT id, label, true AS is_class, true AS is_probability, true AS follows_probability "
    f"FROM ({_test_rows_sql(premodel_sql_body(), DEFAULT.test_share_rf)}) s"))
def q_forest_scores_check(spark, d):
    """M3 + M5 + M6: exactly the split's test rows are scored, with a class that follows the probability."""
    p, yes = F.col("prediction"), F.col("churn_probability")
    return q_forest_scores(spark, d).select(
        "id", "label", p.isin(0.0, 1.0).alias("is_class"), yes.between(0.0, 1.0).alias("is_probability"),
        ((p == 1.0) == (yes > 0.5)).alias("follows_probability"))


def _forest_check(forest: dict):
    """Counts and accuracy of the metrics against the scored rows themselves, and the parameters that arrived in the model.

    ``above_floor``: the accuracy is at most 0.02 under the share of the larger class.
    """
    right = F.avg((F.col("prediction") == F.col("label")).cast("double"))
    rows = forest["scored"].agg(F.count("*").alias("rows"), right.alias("right"), F.avg("label").alias("yes"))
    m = EV.metrics(forest["scored"])
    n = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    return m.crossJoin(rows).crossJoin(forest["parameters"]).select(      # one row each
        n.alias("n_rows"), (F.col("fn") + F.col("tp")).alias("n_positive"),
        ((F.abs(F.col("accuracy") - F.col("right")) < 1e-9) & (n == F.col("rows"))).alias("accuracy_holds"),
        (F.col("accuracy") >= F.greatest("yes", 1 - F.col("yes")) - 0.02).alias("above_floor"),
        "num_trees", "max_depth", "min_leaf", "seed", "feature_subset", "impurity", "bootstrap", "n_features")


def _forest_check_sql(body: str, names: list[str], share: float, cfg: M.ForestConfig) -> str:
    n_features = len([c for c in names if c not in ("id", "churn")])
    return with_views(
        "SELECT count(*) AS n_rows, count(*) FILTER (WHERE label = 1) AS n_positive, true AS accuracy_holds, true AS above_floor, "
        f"{cfg.num_trees} AS num_trees, {cfg.max_depth} AS max_depth, {cfg.min_instances_per_node} AS min_leaf, "
        f"CAST({cfg.seed} AS BIGINT) AS seed, '{cfg.feature_subset}' AS feature_subset, 'gini' AS impurity, true AS bootstrap, "
        f"{n_features} AS n_features FROM ({_test_rows_sql(body, share)}) s")


PREMODEL_NAMES = ([c for c in FT.PREMODEL_KEEP if c not in ("channel_sales", "origin_up")] + list(P.ENDPOINT_COLUMNS)
                  + [f"channel_sales_{v}" for v in CHANNEL_LEVELS] + [f"origin_up_{v}" for v in ORIGIN_LEVELS])


@register("forest_base_check", lambda: _forest_check_sql(premodel_sql_body(), PREMODEL_NAMES, DEFAULT.test_share_rf, M.ForestConfig(100)))
def q_forest_base_check(spark, d):
    """M3 + M7 + M8: the 100-tree forest."""
    return _forest_check(_base_forest(spark, d))


@register("forest_tuned_check", lambda: _forest_check_sql(premodel_sql_body(), PREMODEL_NAMES, DEFAULT.test_share_rf, M.ForestConfig(200)))
def q_forest_tuned_check(spark, d):
    """M4 + M7 + M8: the tuned forest."""
    return _forest_check(_tuned_forest(spark, d))


@register("forest_fe_check", lambda: _forest_check_sql(*feature_table_sql_parts()[:2], DEFAULT.test_share_fe, M.ForestConfig(1000)))
def q_forest_fe_check(spark, d):
    """M2 + M7 + M8: the 1000-tree forest."""
    return _forest_check(_fe_forest(spark, d))


@register("forest_importance_check", lambda: "SELECT unnest([" + ", ".join(
    f"'{c}'" for c in feature_table_sql_parts()[1] if c not in ("id", "churn")) + "]) AS features, "
    "true AS in_range, true AS sum_is_one")
def q_forest_importance_check(spark, d):
    """M9 + E6 + D7: one importance in [0, 1] for each feature column, one in sum
    (zero in a forest of single leaves, as where the training rows have one label)."""
    imp, p = q_forest_importance(spark, d), _fe_forest(spark, d)["parameters"].first()
    total = imp.agg(F.sum("importance")).first()[0] + (p["n_nodes"] == p["num_trees"])
    return imp.select("features", F.col("importance").between(0.0, 1.0).alias("in_range"),
                      F.lit(abs(total - 1.0) < 1e-9).alias("sum_is_one"))


def _grid(spark, d):
    def build():
        pm = materialize(_premodel(spark, d), "premodel")
        train, test = M.split(pm, DEFAULT.test_share_rf, DEFAULT.seed)
        found = M.grid_search(train, M.feature_columns(pm), folds=5, seed=DEFAULT.seed)
        accuracy = EV.metrics(M.score(found.model, test)).first()["accuracy"]
        return {"grid": found.table.withColumn("best_test_accuracy", F.lit(accuracy)), "parameters": M.parameters(found.model)}
    return _stored(spark, d, "forest-grid", build)


@register("forest_grid")
def q_forest_grid(spark, d):
    """M10 + M11: the full grid (27 settings x 5 stratified folds, accuracy), the
    best setting and the refit best model's test accuracy."""
    return _grid(spark, d)["grid"]


@register("forest_grid_check", lambda: (
    "SELECT n AS num_trees, d AS max_depth, l AS min_leaf, true AS in_range, true AS above_floor, 1 AS n_best, true AS best_is_highest, "
    "true AS refit_is_best, true AS folds_even FROM unnest([100, 200, 300]) t(n), unnest([10, 20, 30]) u(d), unnest([1, 2, 4]) v(l)"))
def q_forest_grid_check(spark, d):
    """M10 + M11: all 27 settings, accuracies in [0, 1] and at most 0.02 under the larger class, one best setting, the
    highest, which the refit model has, and folds that differ by at most one row per label."""
    parts = _grid(spark, d)
    grid, p = parts["grid"], parts["parameters"].first()
    pm = materialize(_premodel(spark, d).select("id", "churn"), "premodel-labels")
    train, _ = M.split(pm, DEFAULT.test_share_rf, DEFAULT.seed)
    even = M.with_folds(train, 5).groupBy("churn", "fold").count().groupBy("churn").agg(
        (F.max("count") - F.min("count") <= 1).alias("even"), F.sum("count").alias("n")).collect()     # one row per label
    floor = max(r["n"] for r in even) / sum(r["n"] for r in even) - 0.02
    best = grid.agg(F.sum(F.col("is_best").cast("int")).alias("n_best"), F.max("accuracy").alias("top"),
                    F.max(F.when(F.col("is_best"), F.col("accuracy"))).alias("chosen"))
    same = ((F.col("num_trees") == p["num_trees"]) & (F.col("max_depth") == p["max_depth"]) & (F.col("min_leaf") == p["min_leaf"]))
    return grid.crossJoin(best).select(      # one row of sums
        "num_trees", "max_depth", "min_leaf", F.col("accuracy").between(0.0, 1.0).alias("in_range"),
        (F.col("accuracy") >= floor).alias("above_floor"), F.col("n_best").cast("int").alias("n_best"),
        (F.col("top") == F.col("chosen")).alias("best_is_highest"), (same == F.col("is_best")).alias("refit_is_best"),
        F.lit(all(r["even"] for r in even)).alias("folds_even"))
