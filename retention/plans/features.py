"""Composed tables of the three reference jobs.

* ``churn_data``    -- exploration job: client x per-id window means (EDA).
* ``feature_table`` -- feature job: churn_data + endpoint delta + spreads +
  tenure, months, flags, one-hot and log transforms (FE).
* ``premodel``      -- tuned-model job: narrowed client + half-year block
  averages + one-hot + endpoint delta, label last (RF).

All price features for one table come from one fused aggregation
(``prices.price_features``), so the price history is scanned once and
shuffled twice (by (id, date) and by id) after map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retention.config import DEFAULT, Params
from retention.functions.scalars import log10p1, months_between_ref, recode_flag, tenure_years
from retention.operators import prices as P
from retention.operators.columns import drop_columns, move_last, select_columns
from retention.operators.encode import OneHotLevels, fit_one_hot_many

DATE_COLUMNS = ["date_activ", "date_end", "date_modif_prod", "date_renewal"]
# Columns dropped by the feature job after the correlation review -- fixed values.
CORRELATED_DROP = ["num_years_antig", "forecast_cons_year"]
# Columns kept by the tuned-model job -- fixed values.
PREMODEL_KEEP = [
    "id", "channel_sales", "cons_12m", "cons_gas_12m", "cons_last_month", "forecast_discount_energy",
    "margin_gross_pow_ele", "margin_net_pow_ele", "nb_prod_act", "num_years_antig", "origin_up",
    "pow_max", "AVG_VARIABLE", "AVG_FIXED", "churn",
]


def churn_data(client: DataFrame, price: DataFrame, params: Params = DEFAULT,
               means: DataFrame | None = None) -> DataFrame:
    """Exploration output: client columns, the 27 window means, churn last; only ids
    with prices in all three windows (the reference's inner joins).
    ``means`` may be passed when the caller already built ``window_means``."""
    means = means if means is not None else P.window_means(price, params)
    client_cols = [c for c in client.columns if c != "churn"]
    joined = client.join(means, "id", "inner")
    return joined.select(*[F.col(c) for c in client_cols], *[F.col(c) for c in P.window_mean_columns()],
                         F.col("churn"))


def add_date_features(df: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Tenure in whole years and whole months to the reference date."""
    ref = params.reference_date
    return df.withColumns({
        "tenure": tenure_years(F.col("date_end"), F.col("date_activ")),
        "months_activ": months_between_ref(ref, F.col("date_activ")),
        "months_to_end": months_between_ref(ref, F.col("date_end"), negate=True),
        "months_modif_prod": months_between_ref(ref, F.col("date_modif_prod")),
        "months_renewal": months_between_ref(ref, F.col("date_renewal")),
    })


def merged_clients(client: DataFrame, price: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """The clients of the merged table (prices in all three windows), client columns only.

    The feature job's summaries describe these clients. One narrow aggregate
    of the price history (id and date), no price column is read.
    """
    return client.join(P.ids_in_all_windows(price, params), "id", "left_semi")


def engineered_table(client: DataFrame, price: DataFrame, params: Params = DEFAULT,
                     channel_levels: OneHotLevels | None = None,
                     origin_levels: OneHotLevels | None = None,
                     drop_channel=(), drop_origin=(), min_count: int = 0) -> DataFrame:
    """The feature job's table before the correlation review drops columns.

    Encoders may be passed in already fitted (e.g. fitted on a training
    table); otherwise they are fitted on the client table here.
    ``drop_channel`` and ``drop_origin`` name levels without a dummy column,
    ``min_count`` leaves out the dummies of rarer levels.
    """
    feats = P.price_features(price, params)
    client_cols = [c for c in client.columns if c != "churn"]
    df = client.join(feats, "id", "inner").select(
        *client_cols, *P.window_mean_columns(), "churn", *P.ENDPOINT_COLUMNS,
        *P.spread_names("mean_diff"), *P.spread_names("max_monthly_diff"))
    df = add_date_features(df, params)
    df = drop_columns(df, DATE_COLUMNS)
    df = df.withColumn("has_gas", recode_flag(F.col("has_gas")))
    if channel_levels is None or origin_levels is None:
        channel_levels, origin_levels = fit_one_hot_many(
            client, [("channel_sales", "channel", drop_channel), ("origin_up", "origin_up", drop_origin)],
            min_count=min_count)
    df = channel_levels.transform(df)
    df = origin_levels.transform(df)
    return df.withColumns({c: log10p1(F.col(c)) for c in params.log_columns})


def feature_table(client: DataFrame, price: DataFrame, params: Params = DEFAULT, **encoders) -> DataFrame:
    """The modelling table of the feature job: ``engineered_table`` without the columns dropped on review."""
    return drop_columns(engineered_table(client, price, params, **encoders), CORRELATED_DROP)


def premodel(client: DataFrame, price_tb: DataFrame, params: Params = DEFAULT,
             origin_levels: OneHotLevels | None = None,
             channel_levels: OneHotLevels | None = None,
             order_cols: list[str] | None = None) -> DataFrame:
    """Tuned-model input: narrowed client + AVG_VARIABLE/AVG_FIXED (zero when a client
    has no prices) + dummies + endpoint delta (inner), ``churn`` last, rows
    with a NULL label dropped."""
    block = P.half_year_block(price_tb, None, params, order_cols=order_cols)
    df = client.join(block, "id", "left").withColumns(
        {c: F.coalesce(F.col(c), F.lit(0.0)) for c in P.HALF_YEAR_COLUMNS})
    df = select_columns(df, PREMODEL_KEEP)
    if origin_levels is None or channel_levels is None:
        origin_levels, channel_levels = fit_one_hot_many(
            client, [("origin_up", "origin_up", ()), ("channel_sales", "channel_sales", ())])
    df = origin_levels.transform(df)
    df = channel_levels.transform(df)
    delta = P.endpoint_delta(price_tb.select("id", "price_date", "price_off_peak_var", "price_off_peak_fix"))
    df = df.join(delta, "id", "inner")
    df = move_last(df, "churn")
    return df.na.drop(subset=["churn"])
