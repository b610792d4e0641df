"""Registered price-feature queries (A1-A12) and their SQL oracles."""

from __future__ import annotations

from retention.config import DEFAULT
from retention.operators import prices as P
from retention.plans.registry import finish, register, round_outer
from retention.sources.schemas import PRICE_COLUMNS
from retention.sources.views import account_view, price_view, with_views

CUT6 = f"DATE '{DEFAULT.cut_6m}'"
CUT3 = f"DATE '{DEFAULT.cut_3m}'"


def _window_means_sql() -> str:
    return with_views(round_outer(_window_means_sql_body(), P.window_mean_columns()))


@register("price_window_means", _window_means_sql)
def q_price_window_means(spark, sf_dir):
    return finish(P.window_means(price_view(spark, sf_dir)))


def _monthly_sql(cols) -> str:
    return ("SELECT id, price_date, " + ", ".join(f"avg({c}) AS {c}" for c in cols)
            + " FROM price GROUP BY id, price_date")


def _endpoint_sql() -> str:
    return with_views(round_outer(_endpoint_body(), P.ENDPOINT_COLUMNS))


@register("endpoint_delta", _endpoint_sql)
def q_endpoint_delta(spark, sf_dir):
    return finish(P.endpoint_delta(price_view(spark, sf_dir)))


def _spread_sql_cols(src_fmt: str, kind: str) -> list[str]:
    out = []
    for vf in ("var", "fix"):
        for name, a, b in P.SPREAD_PAIRS:
            out.append(f"{src_fmt.format(f'price_{a}_{vf}')} - {src_fmt.format(f'price_{b}_{vf}')} "
                       f"AS {name}_{vf}_{kind}")
    return out


def _mean_spread_sql() -> str:
    body = ("SELECT id, " + ", ".join(_spread_sql_cols("avg({})", "mean_diff"))
            + " FROM price GROUP BY id")
    return with_views(round_outer(body, P.spread_names("mean_diff")))


@register("mean_band_spread", _mean_spread_sql)
def q_mean_band_spread(spark, sf_dir):
    return finish(P.mean_band_spread(price_view(spark, sf_dir)))


def _max_monthly_sql() -> str:
    return with_views(round_outer(_max_monthly_body(), P.spread_names("max_monthly_diff")))


@register("max_monthly_spread", _max_monthly_sql)
def q_max_monthly_spread(spark, sf_dir):
    return finish(P.max_monthly_spread(price_view(spark, sf_dir)))


def half_year_sql_body(half: int = DEFAULT.half_len) -> str:
    """SQL of the half-year block joined onto all accounts (zeros by default)."""
    ranked = ("SELECT *, row_number() OVER (PARTITION BY id ORDER BY price_date, l_orderkey, "
              "l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn FROM price")
    halves = []
    for c in PRICE_COLUMNS:
        halves.append(f"coalesce(max_by({c}, rn) FILTER (WHERE rn <= {half} AND {c} <> 0), 0.0) AS {c}_h1")
        halves.append(f"coalesce(max_by({c}, rn) FILTER (WHERE rn > {half} AND rn <= {2 * half} AND {c} <> 0), 0.0) AS {c}_h2")
    h = f"SELECT id, {', '.join(halves)} FROM ({ranked}) r GROUP BY id"

    def diff(c):
        return f"CASE WHEN {c}_h1 = 0 OR {c}_h2 = 0 THEN 0.0 ELSE {c}_h2 - {c}_h1 END"

    def avg(c):
        return f"CASE WHEN {c}_h1 = 0 OR {c}_h2 = 0 THEN 0.0 ELSE ({c}_h1 + {c}_h2) / 2.0 END"

    def nz_mean(cs):
        vals = [avg(c) for c in cs]
        total = " + ".join(f"(CASE WHEN ({v}) <> 0 THEN ({v}) ELSE 0.0 END)" for v in vals)
        cnt = " + ".join(f"(CASE WHEN ({v}) <> 0 THEN 1 ELSE 0 END)" for v in vals)
        return f"CASE WHEN ({cnt}) > 0 THEN ({total}) / ({cnt}) ELSE 0.0 END"

    var = ["price_off_peak_var", "price_peak_var", "price_mid_peak_var"]
    fix = ["price_off_peak_fix", "price_peak_fix", "price_mid_peak_fix"]
    blk = (f"SELECT id, {diff(var[0])} AS VARIABLE_price_off_peak, {diff(var[1])} AS VARIABLE_price_peak, "
           f"{diff(var[2])} AS VARIABLE_price_mid_peak, {diff(fix[0])} AS FIXED_price_off_peak, "
           f"{diff(fix[1])} AS FIXED_price_peak, {diff(fix[2])} AS FIXED_price_mid_peak, "
           f"{nz_mean(var)} AS AVG_VARIABLE, {nz_mean(fix)} AS AVG_FIXED FROM ({h}) h")
    cols = ", ".join(f"coalesce(b.{c}, 0.0) AS {c}" for c in P.HALF_YEAR_COLUMNS)
    return f"SELECT a.id, {cols} FROM account a LEFT JOIN ({blk}) b ON a.id = b.id"


@register("half_year_block", lambda: with_views(round_outer(half_year_sql_body(), P.HALF_YEAR_COLUMNS)))
def q_half_year_block(spark, sf_dir):
    price = price_view(spark, sf_dir, with_tiebreak=True)
    return finish(P.half_year_block(price, account_view(spark, sf_dir)))


def price_features_sql_body() -> str:
    """Fused per-id price features as independent joins of the parts."""
    wm = _window_means_sql_body()
    ep = _endpoint_body()
    ms = "SELECT id, " + ", ".join(_spread_sql_cols("avg({})", "mean_diff")) + " FROM price GROUP BY id"
    mm = _max_monthly_body()
    cols = (["w.*"] + [f"e.{c}" for c in P.ENDPOINT_COLUMNS] + [f"s.{c}" for c in P.spread_names("mean_diff")]
            + [f"x.{c}" for c in P.spread_names("max_monthly_diff")])
    return (f"SELECT {', '.join(cols)} FROM ({wm}) w JOIN ({ep}) e ON w.id = e.id "
            f"JOIN ({ms}) s ON w.id = s.id JOIN ({mm}) x ON w.id = x.id")


def _window_means_sql_body() -> str:
    # independent form: three filtered aggregates and two inner joins
    def agg(prefix, where):
        cols = ", ".join(f"avg({c}) AS mean_{prefix}_{c}" for c in PRICE_COLUMNS)
        return f"SELECT id, {cols} FROM price {where} GROUP BY id"
    sel = ["y.id"]
    for w, alias in (("year", "y"), ("6m", "s"), ("3m", "t")):
        sel += [f"{alias}.mean_{w}_{c}" for c in PRICE_COLUMNS]
        sel += [f"{alias}.mean_{w}_price_{a}_var + {alias}.mean_{w}_price_{a}_fix AS mean_{w}_price_{n}"
                for n, a in P.BAND_TOTALS]
    return (f"SELECT {', '.join(sel)} FROM ({agg('year', '')}) y "
            f"JOIN ({agg('6m', f'WHERE price_date > {CUT6}')}) s ON y.id = s.id "
            f"JOIN ({agg('3m', f'WHERE price_date > {CUT3}')}) t ON y.id = t.id")


def _endpoint_body() -> str:
    m = _monthly_sql(["price_off_peak_var", "price_off_peak_fix"])
    return (
        "SELECT id, "
        "max_by(price_off_peak_var, price_date) FILTER (WHERE price_off_peak_var IS NOT NULL) "
        "- min_by(price_off_peak_var, price_date) FILTER (WHERE price_off_peak_var IS NOT NULL) "
        "AS offpeak_diff_dec_january_energy, "
        "max_by(price_off_peak_fix, price_date) FILTER (WHERE price_off_peak_fix IS NOT NULL) "
        "- min_by(price_off_peak_fix, price_date) FILTER (WHERE price_off_peak_fix IS NOT NULL) "
        "AS offpeak_diff_dec_january_power "
        f"FROM ({m}) m GROUP BY id")


def _max_monthly_body() -> str:
    m = _monthly_sql(PRICE_COLUMNS)
    inner = "SELECT id, " + ", ".join(_spread_sql_cols("{}", "mean_diff")) + f" FROM ({m}) m"
    out_cols = P.spread_names("max_monthly_diff")
    return ("SELECT id, " + ", ".join(
        f"max({n}) AS {o}" for n, o in zip(P.spread_names("mean_diff"), out_cols))
        + f" FROM ({inner}) d GROUP BY id")


def price_feature_columns() -> list[str]:
    return (P.window_mean_columns() + P.ENDPOINT_COLUMNS + P.spread_names("mean_diff")
            + P.spread_names("max_monthly_diff"))


@register("price_features", lambda: with_views(round_outer(price_features_sql_body(), price_feature_columns())))
def q_price_features(spark, sf_dir):
    return finish(P.price_features(price_view(spark, sf_dir)))
