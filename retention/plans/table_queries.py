"""Registered profile, distribution, relation, encoding and composed-table
queries with their SQL oracles (DuckDB dialect)."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retention.config import DEFAULT
from retention.functions.scalars import log10p1, months_between_ref, recode_flag, tenure_years
from retention.operators import columns as C
from retention.operators import distributions as D
from retention.operators import prices as P
from retention.operators import profile as PR
from retention.operators import relations as R
from retention.operators.encode import entry_sums, fit_one_hot, fit_sparse
from retention.plans import features as FT
from retention.plans.registry import ORACLES, finish, q, r6_sql, register, round_outer
from retention.session import materialize
from retention.sources.schemas import PRICE_COLUMNS
from retention.sources.views import PRICE_TIEBREAK, account_view, price_view, read_table, with_views

# Spark dtypes of the mapped views (used to write the oracle of ``info``) -- fixed values.
ACCOUNT_DTYPES = [
    ("id", "bigint"), ("channel_sales", "string"), ("cons_12m", "double"), ("cons_gas_12m", "double"),
    ("cons_last_month", "double"), ("date_activ", "date"), ("date_end", "date"),
    ("date_modif_prod", "date"), ("date_renewal", "date"), ("forecast_cons_12m", "double"),
    ("forecast_cons_year", "double"), ("forecast_discount_energy", "double"),
    ("forecast_meter_rent_12m", "double"), ("forecast_price_energy_off_peak", "double"),
    ("forecast_price_energy_peak", "double"), ("forecast_price_pow_off_peak", "double"),
    ("has_gas", "string"), ("imp_cons", "double"), ("margin_gross_pow_ele", "double"),
    ("margin_net_pow_ele", "double"), ("nb_prod_act", "bigint"), ("num_years_antig", "int"),
    ("origin_up", "string"), ("pow_max", "double"), ("churn", "int"),
]
PRICE_DTYPES = [("id", "bigint"), ("price_date", "date")] + [(c, "double") for c in PRICE_COLUMNS]
ACCOUNT_DOUBLES = [c for c, t in ACCOUNT_DTYPES if t == "double"]
ACCOUNT_NUMERIC = [c for c, t in ACCOUNT_DTYPES if t in ("double", "bigint", "int") and c != "id"]
# Measures plotted by class in the exploration job -- fixed values.
CONSUMPTION = ["cons_12m", "cons_gas_12m", "cons_last_month", "imp_cons"]
FORECAST = ["forecast_cons_12m", "forecast_cons_year", "forecast_discount_energy", "forecast_meter_rent_12m",
            "forecast_price_energy_off_peak", "forecast_price_energy_peak", "forecast_price_pow_off_peak"]
# Columns the feature job calls skewed (described before and after the log step) -- fixed values.
SKEWED = ["cons_12m", "cons_gas_12m", "cons_last_month", "forecast_cons_12m", "forecast_cons_year",
          "forecast_discount_energy", "forecast_meter_rent_12m", "forecast_price_energy_off_peak",
          "forecast_price_energy_peak", "forecast_price_pow_off_peak"]
HIST_ALL = ["cons_12m", "cons_last_month", "imp_cons"] + FORECAST
# Category levels of the mapped test data (TPC-H segments and regions) -- fixed values.
CHANNEL_LEVELS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
ORIGIN_LEVELS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


def _acct(spark, d):
    return account_view(spark, d)


def _client_table(spark, d, cols, where=None):
    """The needed columns and rows of the client view, written once to the
    checkpoint folder: operators that make several passes (quantile selection,
    bounds then counts) re-read a stored table instead of recomputing the
    order/line aggregates each time."""
    a = account_view(spark, d)
    return materialize((a if where is None else a.filter(where)).select(*cols), "client")


def _price_table(spark, d):
    """The six price columns written once, for operators that make several passes."""
    return materialize(price_view(spark, d).select(*PRICE_COLUMNS), "price")


def _merged(spark, d):
    """Clients of the feature job's merged table (prices in all three windows)."""
    return FT.merged_clients(account_view(spark, d), price_view(spark, d))


# The same clients in SQL.
MERGED_SQL = ("(SELECT * FROM account WHERE id IN (SELECT id FROM price GROUP BY id "
              f"HAVING count(*) FILTER (WHERE price_date > DATE '{DEFAULT.cut_6m}') > 0 "
              f"AND count(*) FILTER (WHERE price_date > DATE '{DEFAULT.cut_3m}') > 0))")


def _price(spark, d):
    return price_view(spark, d)


# ---------------------------------------------------------------- profiles
def _info_sql(table, dtypes):
    parts = [f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS dtype, count({q(c)}) AS non_null FROM {table}"
             for i, (c, t) in enumerate(dtypes)]
    return with_views(" UNION ALL ".join(parts))


@register("profile_info_account", lambda: _info_sql("account", ACCOUNT_DTYPES))
def q_info_account(spark, d):
    return finish(PR.info(_acct(spark, d)))


@register("profile_info_price", lambda: _info_sql("price", PRICE_DTYPES))
def q_info_price(spark, d):
    return finish(PR.info(_price(spark, d)))


@register("profile_shape_account",
          lambda: with_views(f"SELECT count(*) AS n_rows, {len(ACCOUNT_DTYPES)} AS n_columns FROM account"))
def q_shape_account(spark, d):
    return PR.shape(_acct(spark, d))


@register("profile_shape_price",
          lambda: with_views(f"SELECT count(*) AS n_rows, {len(PRICE_DTYPES)} AS n_columns FROM price"))
def q_shape_price(spark, d):
    return PR.shape(_price(spark, d))


def _describe_sql(table, cols):
    parts = []
    for c in cols:
        x = f"CAST({q(c)} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS column_name, count({x}) AS count, avg({x}) AS mean, stddev_samp({x}) AS std, "
            f"min({x}) AS min, quantile_cont({x}, 0.25) AS p25, quantile_cont({x}, 0.5) AS p50, "
            f"quantile_cont({x}, 0.75) AS p75, max({x}) AS max FROM {table}")
    body = " UNION ALL ".join(parts)
    return with_views(round_outer(body, ["mean", "std", "min", "p25", "p50", "p75", "max"]))


@register("profile_describe_account", lambda: _describe_sql("account", ACCOUNT_NUMERIC))
def q_describe_account(spark, d):
    return finish(PR.describe(_client_table(spark, d, ACCOUNT_NUMERIC), ACCOUNT_NUMERIC))


@register("profile_describe_price", lambda: _describe_sql("price", PRICE_COLUMNS))
def q_describe_price(spark, d):
    return finish(PR.describe(_price_table(spark, d), PRICE_COLUMNS))


def _nulls_sql(table, dtypes):
    parts = [f"SELECT {i} AS position, '{c}' AS column_name, count(*) FILTER (WHERE {q(c)} IS NULL) AS null_count, "
             f"CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE {q(c)} IS NULL) * 100.0 / count(*) END AS null_pct "
             f"FROM {table}" for i, (c, _) in enumerate(dtypes)]
    return with_views(round_outer(" UNION ALL ".join(parts), ["null_pct"]))


@register("null_counts_account", lambda: _nulls_sql("account", ACCOUNT_DTYPES))
def q_nulls_account(spark, d):
    return finish(PR.null_counts(_acct(spark, d)))


@register("null_counts_price", lambda: _nulls_sql("price", PRICE_DTYPES))
def q_nulls_price(spark, d):
    return finish(PR.null_counts(_price(spark, d)))


@register("value_counts_channel", lambda: with_views(
    f"SELECT channel_sales, count(*) AS count FROM {MERGED_SQL} m WHERE channel_sales IS NOT NULL GROUP BY channel_sales"))
def q_vc_channel(spark, d):
    return PR.value_counts(_merged(spark, d), "channel_sales")


@register("value_counts_origin", lambda: with_views(
    f"SELECT origin_up, count(*) AS count FROM {MERGED_SQL} m WHERE origin_up IS NOT NULL GROUP BY origin_up"))
def q_vc_origin(spark, d):
    return PR.value_counts(_merged(spark, d), "origin_up")


@register("value_counts_price_date", lambda: with_views(
    "SELECT price_date, count(*) AS count FROM price WHERE price_date IS NOT NULL GROUP BY price_date"))
def q_vc_price_date(spark, d):
    return PR.value_counts(_price(spark, d), "price_date")


@register("freq_of_freq_price", lambda: with_views(
    "SELECT n_rows, count(*) AS n_keys FROM (SELECT id, count(*) AS n_rows FROM price "
    "WHERE id IS NOT NULL GROUP BY id) t GROUP BY n_rows"))
def q_fof_price(spark, d):
    return PR.freq_of_freq(_price(spark, d), "id")


@register("preview_price", lambda: with_views(
    "SELECT id, price_date, " + ", ".join(PRICE_COLUMNS) + " FROM price ORDER BY id, price_date, "
    + ", ".join(PRICE_TIEBREAK) + " LIMIT 5"))
def q_preview_price(spark, d):
    p = price_view(spark, d, with_tiebreak=True)
    return PR.preview(p, ["id", "price_date", *PRICE_TIEBREAK], 5).select("id", "price_date", *PRICE_COLUMNS)


@register("preview_account", lambda: with_views(round_outer("SELECT * FROM account ORDER BY id LIMIT 5", ACCOUNT_DOUBLES)))
def q_preview_account(spark, d):
    # the five clients first, so that only their orders and lines are aggregated
    return finish(PR.preview(account_view(spark, d, first_clients=5), ["id"], 5))


# ---------------------------------------------------------------- shares and rates
def _class_share_sql():
    body = ("SELECT churn, companies, share, CASE WHEN lbl <> 0 THEN lbl END AS share_label FROM ("
            "SELECT churn, companies, share, "
            "floor(floor(share * 1e9 + 0.5) / 1e9 * 10.0 + 0.5) / 10.0 AS lbl "
            "FROM (SELECT churn, companies, companies * 100.0 / sum(companies) OVER () AS share FROM ("
            "SELECT churn, count(id) AS companies FROM account GROUP BY churn) c) s) t")
    return with_views(round_outer(body, ["share", "share_label"]))


@register("class_share", _class_share_sql)
def q_class_share(spark, d):
    return finish(D.class_share(_acct(spark, d)))


@register("class_share_wide", lambda: with_views(round_outer(
    "SELECT max(share) FILTER (WHERE churn = 0) AS share_0, max(share) FILTER (WHERE churn = 1) AS share_1 FROM ("
    "SELECT churn, companies * 100.0 / sum(companies) OVER () AS share FROM ("
    "SELECT churn, count(id) AS companies FROM account GROUP BY churn) c) s", ["share_0", "share_1"])))
def q_class_share_wide(spark, d):
    return finish(D.class_share_wide(_acct(spark, d)))


TENURE_SQL = "CAST(trunc(datediff('day', date_activ, date_end) / 365.2425) AS INTEGER)"


def _months_sql(col, negate=False):
    e = f"CAST(trunc(datediff('day', {col}, DATE '{DEFAULT.reference_date}') / 30.436875) AS INTEGER)"
    return f"(-{e})" if negate else e


@register("churn_by_tenure", lambda: with_views(round_outer(
    f"SELECT tenure, avg(CAST(churn AS DOUBLE)) AS churn FROM (SELECT {TENURE_SQL} AS tenure, churn FROM {MERGED_SQL} m) t "
    "GROUP BY tenure", ["churn"])))
def q_churn_by_tenure(spark, d):
    a = _merged(spark, d).withColumn("tenure", tenure_years(F.col("date_end"), F.col("date_activ")))
    return finish(R.rate_by(a, "tenure"))


@register("churn_by_gas", lambda: with_views(round_outer(
    "SELECT has_gas, avg(CAST(churn AS DOUBLE)) AS churn FROM (SELECT CASE WHEN has_gas = 't' THEN 1 "
    f"WHEN has_gas = 'f' THEN 0 END AS has_gas, churn FROM {MERGED_SQL} m) t GROUP BY has_gas", ["churn"])))
def q_churn_by_gas(spark, d):
    a = _merged(spark, d).withColumn("has_gas", recode_flag(F.col("has_gas")))
    return finish(R.rate_by(a, "has_gas"))


@register("months_features", lambda: with_views(
    f"SELECT id, {TENURE_SQL} AS tenure, {_months_sql('date_activ')} AS months_activ, "
    f"{_months_sql('date_end', True)} AS months_to_end, {_months_sql('date_modif_prod')} AS months_modif_prod, "
    f"{_months_sql('date_renewal')} AS months_renewal FROM account"))
def q_months(spark, d):
    a = FT.add_date_features(_acct(spark, d))
    return a.select("id", "tenure", "months_activ", "months_to_end", "months_modif_prod", "months_renewal")


def _log_sql(c):
    return f"CASE WHEN {c} + 1.0 > 0 THEN log10({c} + 1.0) END"


@register("log_scaled", lambda: with_views(round_outer(
    "SELECT id, " + ", ".join(f"{_log_sql(c)} AS {c}" for c in DEFAULT.log_columns) + " FROM account",
    list(DEFAULT.log_columns))))
def q_log_scaled(spark, d):
    a = _acct(spark, d)
    return finish(a.select("id", *[log10p1(F.col(c)).alias(c) for c in DEFAULT.log_columns]))


def _dummy_sql(col, prefix, levels):
    return [f"CAST(coalesce({col} = '{v}', false) AS INTEGER) AS {q(prefix + '_' + v)}" for v in levels]


@register("one_hot_account", lambda: with_views(
    "SELECT id, " + ", ".join(_dummy_sql("channel_sales", "channel", CHANNEL_LEVELS)
                              + _dummy_sql("origin_up", "origin_up", ORIGIN_LEVELS)) + " FROM account"))
def q_one_hot(spark, d):
    a = _acct(spark, d).select("id", "channel_sales", "origin_up")
    a = fit_one_hot(a, "channel_sales", "channel").transform(a)
    return fit_one_hot(a, "origin_up", "origin_up").transform(a)


# Levels without a dummy column, and the count below which a level gets none -- fixed values.
DROPPED_CHANNELS = ["FURNITURE"]


@register("one_hot_sparse", ORACLES["one_hot_account"])
def q_one_hot_sparse(spark, d):
    """The same columns, read from the entries of sparse vectors."""
    a = account_view(spark, d).select("id", "channel_sales", "origin_up")
    named = {}
    for column, prefix in (("channel_sales", "channel"), ("origin_up", "origin_up")):
        levels = fit_sparse(a, column, prefix)
        a = levels.transform(a).withColumn(prefix, vector_to_array(prefix))
        named |= {c: F.get(F.col(prefix), F.lit(i)).cast("int") for i, c in enumerate(levels.levels.output_columns)}
    return a.select("id", *[v.alias(c) for c, v in named.items()])


@register("one_hot_sparse_wide", lambda: (
    "SELECT CAST(l_partkey AS VARCHAR) AS level, count(*) AS n_rows FROM lineitem GROUP BY 1 HAVING count(*) >= 20"))
def q_one_hot_sparse_wide(spark, d):
    """A column of thousands of levels as sparse vectors, rare levels without an entry; their sum by entry."""
    rows = read_table(spark, d, "lineitem", ["l_partkey"]).select(F.col("l_partkey").cast("string").alias("part"))
    levels = fit_sparse(rows, "part", min_count=20)
    return entry_sums(levels.transform(rows), "part").join(levels.names(), "entry").select("level", F.col("total").cast("bigint").alias("n_rows"))


@register("one_hot_dropped", lambda: with_views(
    "SELECT id, " + ", ".join(_dummy_sql("channel_sales", "channel", [v for v in CHANNEL_LEVELS if v not in DROPPED_CHANNELS]))
    + " FROM account"))
def q_one_hot_dropped(spark, d):
    """Chosen dummies left out."""
    a = _acct(spark, d).select("id", "channel_sales")
    return fit_one_hot(a, "channel_sales", "channel", drop_levels=DROPPED_CHANNELS).transform(a)


@register("column_edits", lambda: with_views(
    "SELECT id AS client, CAST(has_gas = 't' AS INTEGER) AS gas, CAST(churn = 1 AS INTEGER) AS gone, 0.0::DOUBLE AS spent "
    "FROM account"))
def q_column_edits(spark, d):
    """Flags found by type and made numbers, a constant column, names by map and by place."""
    a = _acct(spark, d).select("id", "has_gas", "churn")
    a = C.apply_to_columns(a, ["has_gas"], lambda c: c == "t")
    a = C.set_constant(C.apply_to_columns(a, ["churn"], lambda c: c == 1), ["spent"], 0.0)
    a = C.apply_to_columns(a, C.columns_of_type(a), lambda c: c.cast("int"))
    return C.rename_positional(C.rename(a, {"churn": "gone"}), ["client", "gas", "gone", "spent"])


# ---------------------------------------------------------------- distributions
def _box_sql(cols):
    parts = []
    for c in cols:
        parts.append(f"SELECT '{c}' AS column_name, churn, CAST({c} AS DOUBLE) AS value FROM account WHERE {c} IS NOT NULL")
    long = " UNION ALL ".join(parts)
    stats = ("SELECT column_name, churn, count(*) AS n, min(value) AS min, max(value) AS max, "
             "quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, "
             f"quantile_cont(value, 0.75) AS q3 FROM ({long}) l GROUP BY column_name, churn")
    body = (f"SELECT s.column_name, s.churn, s.n, s.min, s.q1, s.median, s.q3, s.max, "
            "min(l.value) FILTER (WHERE l.value >= s.q1 - 1.5 * (s.q3 - s.q1) AND l.value <= s.q3 + 1.5 * (s.q3 - s.q1)) AS whisker_low, "
            "max(l.value) FILTER (WHERE l.value >= s.q1 - 1.5 * (s.q3 - s.q1) AND l.value <= s.q3 + 1.5 * (s.q3 - s.q1)) AS whisker_high, "
            "count(*) FILTER (WHERE NOT (l.value >= s.q1 - 1.5 * (s.q3 - s.q1) AND l.value <= s.q3 + 1.5 * (s.q3 - s.q1))) AS n_outliers "
            f"FROM ({stats}) s JOIN ({long}) l ON s.column_name = l.column_name AND s.churn = l.churn "
            "GROUP BY s.column_name, s.churn, s.n, s.min, s.q1, s.median, s.q3, s.max")
    return with_views(round_outer(body, ["min", "q1", "median", "q3", "max", "whisker_low", "whisker_high"]))


@register("box_stats", lambda: _box_sql(CONSUMPTION + FORECAST))
def q_box_stats(spark, d):
    cols = CONSUMPTION + FORECAST
    return finish(D.box_stats(_client_table(spark, d, ["churn", *cols]), cols, by="churn"))


def _hist_sql(table, cols, bins, by=None, where=""):
    keep = f"{by}, " if by else ""
    parts = []
    for c in cols:
        b = (f"(SELECT CASE WHEN min({c}) = max({c}) THEN min({c}) - 0.5 ELSE min({c}) END AS lo, "
             f"CASE WHEN min({c}) = max({c}) THEN max({c}) + 0.5 ELSE max({c}) END AS hi FROM {table} {where})")
        parts.append(
            f"SELECT '{c}' AS column_name, {keep}CAST(least({bins - 1}, floor((CAST({c} AS DOUBLE) - b.lo) * {float(bins)} "
            f"/ (b.hi - b.lo))) AS INTEGER) AS bin, b.lo, b.hi FROM {table}, {b} b "
            f"WHERE {c} IS NOT NULL {('AND ' + where[6:]) if where else ''}")
    long = " UNION ALL ".join(parts)
    body = (f"SELECT column_name, {keep}bin, count(*) AS count, lo + bin * ((hi - lo) / {float(bins)}) AS bin_lo, "
            f"lo + (bin + 1) * ((hi - lo) / {float(bins)}) AS bin_hi FROM ({long}) l "
            f"GROUP BY column_name, {keep}bin, lo, hi")
    return with_views(round_outer(body, ["bin_lo", "bin_hi"]))


@register("hist_by_churn", lambda: _hist_sql("account", HIST_ALL, DEFAULT.hist_bins, "churn"))
def q_hist_by_churn(spark, d):
    return finish(D.histogram(_client_table(spark, d, ["churn", *HIST_ALL]), HIST_ALL, DEFAULT.hist_bins, by="churn"))


@register("hist_gas_by_churn", lambda: _hist_sql("account", ["cons_gas_12m"], DEFAULT.hist_bins, "churn",
                                                  where="WHERE has_gas = 't'"))
def q_hist_gas(spark, d):
    a = _client_table(spark, d, ["churn", "cons_gas_12m"], F.col("has_gas") == "t")
    return finish(D.histogram(a, ["cons_gas_12m"], DEFAULT.hist_bins, by="churn"))


@register("hist_price", lambda: _hist_sql("price", PRICE_COLUMNS, DEFAULT.price_bins))
def q_hist_price(spark, d):
    return finish(D.histogram(_price_table(spark, d), PRICE_COLUMNS, DEFAULT.price_bins))


def _density_stats_sql(expr, where):
    v = f"SELECT {expr} AS v FROM {MERGED_SQL} m WHERE {expr} IS NOT NULL AND {where}"
    return (f"WITH v AS ({v}), s AS (SELECT count(*) AS n, min(v) AS lo, max(v) AS hi, stddev_samp(v) AS sd, "
            "quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM v), "
            "k AS (SELECT n, lo, hi, sd, CASE WHEN 2.0 * (q3 - q1) * pow(n, -1.0 / 3.0) > 0 AND hi > lo "
            "THEN least(50, greatest(1, CAST(ceil((hi - lo) / (2.0 * (q3 - q1) * pow(n, -1.0 / 3.0))) AS INTEGER))) "
            "ELSE 1 END AS nb, sd * pow(n, -0.2) AS bw FROM s)")


# Columns of the density plots (after the log step) with the rows they take -- fixed values.
DENSITIES = [("cons_12m", "true"), ("cons_gas_12m", "has_gas = 't'"), ("cons_last_month", "true")]


def _density_union_sql(one, doubles):
    parts = [f"SELECT '{c}' AS column_name, * FROM ({one(_density_stats_sql(_log_sql(c), where))}) d" for c, where in DENSITIES]
    return with_views(round_outer(" UNION ALL ".join(parts), doubles))


def _density_hist_sql():
    return _density_union_sql(lambda stats: (
            stats + " SELECT bin, count(*) AS count, "
            "count(*) / (max(k.n) * ((max(k.hi) - max(k.lo)) / max(k.nb))) AS density, "
            "max(k.lo) + bin * ((max(k.hi) - max(k.lo)) / max(k.nb)) AS bin_lo, "
            "max(k.lo) + (bin + 1) * ((max(k.hi) - max(k.lo)) / max(k.nb)) AS bin_hi FROM ("
            "SELECT CAST(least(k.nb - 1, floor((v.v - k.lo) * CAST(k.nb AS DOUBLE) / (k.hi - k.lo))) AS INTEGER) AS bin "
            "FROM v, k) b, k GROUP BY bin"), ["density", "bin_lo", "bin_hi"])


def _density_kde_sql():
    return _density_union_sql(lambda stats: (
            stats + ", g AS (SELECT range AS point FROM range(200)), "
            "w AS (SELECT v, count(*) AS w FROM v GROUP BY v) "
            "SELECT g.point, (k.lo - 3.0 * k.bw) + g.point * (((k.hi + 3.0 * k.bw) - (k.lo - 3.0 * k.bw)) / 199) AS x, "
            "sum(w.w * exp(-0.5 * (((k.lo - 3.0 * k.bw) + g.point * (((k.hi + 3.0 * k.bw) - (k.lo - 3.0 * k.bw)) / 199) - w.v) / k.bw) "
            "* (((k.lo - 3.0 * k.bw) + g.point * (((k.hi + 3.0 * k.bw) - (k.lo - 3.0 * k.bw)) / 199) - w.v) / k.bw))) "
            f"* (1.0 / (k.n * k.bw * {math.sqrt(2.0 * math.pi)!r})) AS density "
            "FROM g, w, k GROUP BY g.point, k.lo, k.hi, k.bw, k.n"), ["x", "density"])


def _densities(spark, d, which):
    logs = [log10p1(F.col(c)).alias(c) for c, _ in DENSITIES]
    stored = materialize(_merged(spark, d).select("has_gas", *logs), "density")
    parts = [D.density(stored.filter(where), c)[which].select(F.lit(c).alias("column_name"), "*") for c, where in DENSITIES]
    return finish(reduce(DataFrame.unionByName, parts))


@register("density_hist", _density_hist_sql)
def q_density_hist(spark, d):
    return _densities(spark, d, 0)


@register("density_kde", _density_kde_sql)
def q_density_kde(spark, d):
    return _densities(spark, d, 1)


# ---------------------------------------------------------------- correlation
CORR_COLUMNS = P.window_mean_columns() + ["churn"]


def _corr_sql(table_sql, cols):
    parts = [f"SELECT id, '{c}' AS col, CAST({q(c)} AS DOUBLE) AS v FROM t WHERE {q(c)} IS NOT NULL" for c in cols]
    long = " UNION ALL ".join(parts)
    body = (f"WITH t AS ({table_sql}), l AS ({long}) "
            "SELECT a.col AS col_a, b.col AS col_b, "
            "CASE WHEN var_pop(a.v) * var_pop(b.v) > 0 THEN covar_pop(a.v, b.v) / sqrt(var_pop(a.v) * var_pop(b.v)) END AS corr "
            "FROM l a JOIN l b ON a.id = b.id GROUP BY a.col, b.col")
    return round_outer(body, ["corr"])


def _price_churn_sql():
    from retention.plans.price_queries import _window_means_sql_body
    return f"SELECT w.*, a.churn FROM ({_window_means_sql_body()}) w JOIN account a ON w.id = a.id"


def _price_churn(spark, d):
    means = P.window_means(_price(spark, d))
    return means.join(_acct(spark, d).select("id", "churn"), "id", "inner")


@register("corr_price_churn", lambda: with_views(_corr_sql(_price_churn_sql(), CORR_COLUMNS)))
def q_corr(spark, d):
    # the per-client input is written once; the correlation passes re-read it
    # instead of re-aggregating the price history per pass
    return finish(R.correlation(materialize(_price_churn(spark, d), "price-churn"), CORR_COLUMNS))


def _corr_gaps_sql():
    parts = []
    for a in PRICE_COLUMNS:
        for b in PRICE_COLUMNS:
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, CASE WHEN min(x) < max(x) AND min(y) < max(y) "
                         "THEN covar_pop(x, y) / sqrt(var_pop(x) * var_pop(y)) END AS corr "
                         f"FROM (SELECT {a} AS x, {b} AS y FROM p WHERE {a} IS NOT NULL AND {b} IS NOT NULL) t")
    gaps = ", ".join(f"nullif({c}, 0.0) AS {c}" for c in PRICE_COLUMNS)
    return with_views(round_outer(f"WITH p AS (SELECT {gaps} FROM price) " + " UNION ALL ".join(parts), ["corr"]))


@register("corr_price_gaps", _corr_gaps_sql)
def q_corr_gaps(spark, d):
    """A15 with NULLs: the price columns of all price rows, a zero price being no price."""
    gaps = _price(spark, d).select(*[F.nullif(F.col(c), F.lit(0.0)).alias(c) for c in PRICE_COLUMNS])
    return finish(R.correlation(materialize(gaps, "price-gaps"), PRICE_COLUMNS))


@register("correlated_pairs", lambda: with_views(
    f"SELECT * FROM ({_corr_sql(_price_churn_sql(), CORR_COLUMNS)}) c "
    "WHERE col_a < col_b AND abs(corr) >= 0.9"))
def q_corr_pairs(spark, d):
    return R.correlated_pairs(q_corr(spark, d), 0.9)
