"""Per-client price features (the core of the reference's feature work).

All operators take a price table ``(id, price_date, <six prices>)`` and return
one row per id. Aggregates are algebraic (sum/count/min/max/min_by/max_by), so
Spark runs a map-side partial aggregate before every exchange: a client that
holds a third of all rows is reduced to one partial row per map task before
the shuffle.

Naming follows the reference's output columns; where it renamed all windows to
``mean_year_*`` by a copy-paste slip, windows are named ``mean_year_*``,
``mean_6m_*`` and ``mean_3m_*`` here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retention.config import DEFAULT, Params
from retention.functions.scalars import nonzero_mean
from retention.sources.schemas import PRICE_COLUMNS
from retention.sources.views import PRICE_TIEBREAK

# Band pairs of the spread features, in output order -- fixed values.
SPREAD_PAIRS = [
    ("off_peak_peak", "off_peak", "peak"),
    ("peak_mid_peak", "peak", "mid_peak"),
    ("off_peak_mid_peak", "off_peak", "mid_peak"),
]
# Window names and band totals (A3); the "mid" total is named "med" -- fixed values.
WINDOWS = ("year", "6m", "3m")
BAND_TOTALS = [("off_peak", "off_peak"), ("peak", "peak"), ("med_peak", "mid_peak")]

ENDPOINT_COLUMNS = ["offpeak_diff_dec_january_energy", "offpeak_diff_dec_january_power"]
HALF_YEAR_COLUMNS = [
    "VARIABLE_price_off_peak", "VARIABLE_price_peak", "VARIABLE_price_mid_peak",
    "FIXED_price_off_peak", "FIXED_price_peak", "FIXED_price_mid_peak",
    "AVG_VARIABLE", "AVG_FIXED",
]


def spread_names(kind: str) -> list[str]:
    """Output names of the six spread columns, e.g. ``off_peak_peak_var_mean_diff``."""
    return [f"{name}_{vf}_{kind}" for vf in ("var", "fix") for name, _, _ in SPREAD_PAIRS]


def _spread_exprs(value_of, kind: str) -> list[Column]:
    out = []
    for vf in ("var", "fix"):
        for name, a, b in SPREAD_PAIRS:
            out.append((value_of(f"price_{a}_{vf}") - value_of(f"price_{b}_{vf}")).alias(f"{name}_{vf}_{kind}"))
    return out


def _window_cond(window: str, params: Params) -> Column:
    if window == "year":
        return F.lit(True)
    cut = params.cut_6m if window == "6m" else params.cut_3m
    return F.col("price_date") > F.lit(cut).cast("date")


def _totals(prefix: str) -> list[Column]:
    return [
        (F.col(f"{prefix}_price_{a}_var") + F.col(f"{prefix}_price_{a}_fix")).alias(f"{prefix}_price_{name}")
        for name, a in BAND_TOTALS
    ]


def window_means(price: DataFrame, params: Params = DEFAULT, keep_all_windows: bool = True) -> DataFrame:
    """A1-A3 + F3 + J1/J2: mean of each price over the whole history and the
    rows after the 6-month and 3-month cuts (strict ``>``), plus var+fix totals.

    One ``groupBy('id')`` with conditional averages replaces three filtered
    aggregates and two inner joins. ``keep_all_windows`` keeps only ids with at
    least one row in each window, which is what the inner joins did.
    """
    aggs = []
    for w in WINDOWS:
        cond = _window_cond(w, params)
        aggs.append(F.count(F.when(cond, F.lit(1))).alias(f"_rows_{w}"))
        aggs += [F.avg(F.when(cond, F.col(c))).alias(f"mean_{w}_{c}") for c in PRICE_COLUMNS]
    out = price.groupBy("id").agg(*aggs)
    if keep_all_windows:
        out = out.filter(" AND ".join(f"_rows_{w} > 0" for w in WINDOWS))
    cols = [F.col("id")]
    for w in WINDOWS:
        cols += [F.col(f"mean_{w}_{c}") for c in PRICE_COLUMNS]
        cols += _totals(f"mean_{w}")
    return out.select(*cols)


def ids_in_all_windows(price: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Ids with at least one row in each window: those that ``window_means`` keeps."""
    return price.groupBy("id").agg(
        F.max("price_date").alias("_last")).filter(
        F.col("_last") > F.lit(max(params.cut_6m, params.cut_3m)).cast("date")).select("id")


def window_mean_columns() -> list[str]:
    cols = []
    for w in WINDOWS:
        cols += [f"mean_{w}_{c}" for c in PRICE_COLUMNS]
        cols += [f"mean_{w}_price_{name}" for name, _ in BAND_TOTALS]
    return cols


def monthly_means(price: DataFrame, cols: list[str] = PRICE_COLUMNS) -> DataFrame:
    """A4: mean of each price per (id, price_date)."""
    return price.groupBy("id", "price_date").agg(*[F.avg(c).alias(c) for c in cols])


def _first_last(value: str, order: str = "price_date") -> tuple[Column, Column]:
    """First/last non-null value by ``order`` (A5); a NULL order skips the row."""
    ordering = F.when(F.col(value).isNotNull(), F.col(order))
    return F.min_by(F.col(value), ordering), F.max_by(F.col(value), ordering)


def endpoint_delta(price: DataFrame) -> DataFrame:
    """Last minus first monthly mean of off-peak energy and power price.

    Named after December/January by the reference, but it is the last and
    first available date of each id.
    """
    monthly = monthly_means(price, ["price_off_peak_var", "price_off_peak_fix"])
    e_first, e_last = _first_last("price_off_peak_var")
    p_first, p_last = _first_last("price_off_peak_fix")
    return monthly.groupBy("id").agg(
        (e_last - e_first).alias(ENDPOINT_COLUMNS[0]),
        (p_last - p_first).alias(ENDPOINT_COLUMNS[1]),
    )


def mean_band_spread(price: DataFrame) -> DataFrame:
    """Differences between band means over all raw rows of an id."""
    means = price.groupBy("id").agg(*[F.avg(c).alias(c) for c in PRICE_COLUMNS])
    return means.select("id", *_spread_exprs(F.col, "mean_diff"))


def max_monthly_spread(price: DataFrame) -> DataFrame:
    """Per id, the (signed) maximum over dates of the monthly band spreads."""
    monthly = monthly_means(price).select("id", *_spread_exprs(F.col, "mean_diff"))
    names = spread_names("mean_diff")
    return monthly.groupBy("id").agg(
        *[F.max(n).alias(n.replace("_mean_diff", "_max_monthly_diff")) for n in names])


def price_features(price: DataFrame, params: Params = DEFAULT, keep_all_windows: bool = True) -> DataFrame:
    """A2+A3, A6, A7 and A12 fused into two aggregation stages.

    Stage A aggregates to one row per (id, price_date) carrying sum and
    non-null count of each price, so raw-row means (A2, A7) are rebuilt exactly
    from partials while month means (A6, A12) come from the same rows.
    Stage B is a single ``groupBy('id')``. Both stages aggregate map-side first.
    """
    part = [F.count(F.lit(1)).alias("_n")]
    for c in PRICE_COLUMNS:
        part += [F.sum(c).alias(f"{c}__s"), F.count(c).alias(f"{c}__c")]
    monthly = price.groupBy("id", "price_date").agg(*part)
    monthly = monthly.select(
        "*", *[F.try_divide(F.col(f"{c}__s"), F.col(f"{c}__c")).alias(f"{c}__m") for c in PRICE_COLUMNS])

    aggs = []
    for w in WINDOWS:
        cond = _window_cond(w, params)
        aggs.append(F.sum(F.when(cond, F.col("_n"))).alias(f"_rows_{w}"))
        for c in PRICE_COLUMNS:
            aggs.append(F.try_divide(F.sum(F.when(cond, F.col(f"{c}__s"))),
                                     F.sum(F.when(cond, F.col(f"{c}__c")))).alias(f"mean_{w}_{c}"))
    e_first, e_last = _first_last("price_off_peak_var__m")
    p_first, p_last = _first_last("price_off_peak_fix__m")
    aggs += [(e_last - e_first).alias(ENDPOINT_COLUMNS[0]), (p_last - p_first).alias(ENDPOINT_COLUMNS[1])]
    monthly_spreads = _spread_exprs(lambda c: F.col(f"{c}__m"), "mean_diff")
    aggs += [F.max(e).alias(n.replace("_mean_diff", "_max_monthly_diff"))
             for e, n in zip(monthly_spreads, spread_names("mean_diff"))]
    out = monthly.groupBy("id").agg(*aggs)
    if keep_all_windows:
        out = out.filter(" AND ".join(f"_rows_{w} > 0" for w in WINDOWS))
    # A7 from the year-window raw means
    a7 = _spread_exprs(lambda c: F.col(f"mean_year_{c}"), "mean_diff")
    cols = [F.col("id")]
    for w in WINDOWS:
        cols += [F.col(f"mean_{w}_{c}") for c in PRICE_COLUMNS] + _totals(f"mean_{w}")
    cols += [F.col(n) for n in ENDPOINT_COLUMNS] + a7
    cols += [F.col(n) for n in spread_names("max_monthly_diff")]
    return out.select(*cols)


def half_year_block(price_tb: DataFrame, clients: DataFrame | None = None, params: Params = DEFAULT,
                    order_cols: list[str] | None = None) -> DataFrame:
    """A8-A11 (+ J3/J4): half-year price change per band and the mean of the
    non-zero half-year averages.

    Rows of an id are numbered by (price_date, tie-break). In rows [0, 6) and
    [6, 12) the last non-zero price is taken (0.0 if none); the change is
    h2 - h1 and the average (h1 + h2) / 2, both 0.0 if either half is 0.0.
    ``row_number() <= 12`` lets Spark insert a partial window-group limit
    before the exchange, so at most 12 rows per id and map task are shuffled
    however large one id's history is.

    With ``clients`` the block is left-joined onto every client and missing
    values default to 0.0 (the reference pre-set zeros and updated in place).
    """
    order_cols = order_cols if order_cols is not None else PRICE_TIEBREAK
    h = params.half_len
    w = Window.partitionBy("id").orderBy(F.col("price_date"), *[F.col(c) for c in order_cols])
    ranked = (price_tb.select("id", "price_date", *order_cols, *PRICE_COLUMNS)
              .withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") <= 2 * h))
    aggs = []
    for c in PRICE_COLUMNS:
        nz = F.col(c) != 0
        first_half = F.max_by(F.col(c), F.when(nz & (F.col("_rn") <= h), F.col("_rn")))
        second_half = F.max_by(F.col(c), F.when(nz & (F.col("_rn") > h), F.col("_rn")))
        aggs += [F.coalesce(first_half, F.lit(0.0)).alias(f"{c}__h1"),
                 F.coalesce(second_half, F.lit(0.0)).alias(f"{c}__h2")]
    halves = ranked.groupBy("id").agg(*aggs)

    def change(c):
        h1, h2 = F.col(f"{c}__h1"), F.col(f"{c}__h2")
        zero = (h1 == 0) | (h2 == 0)
        return (F.when(zero, F.lit(0.0)).otherwise(h2 - h1),
                F.when(zero, F.lit(0.0)).otherwise((h1 + h2) / F.lit(2.0)))

    diffs, avgs = {}, {}
    for c in PRICE_COLUMNS:
        diffs[c], avgs[c] = change(c)
    block = halves.select(
        "id",
        diffs["price_off_peak_var"].alias("VARIABLE_price_off_peak"),
        diffs["price_peak_var"].alias("VARIABLE_price_peak"),
        diffs["price_mid_peak_var"].alias("VARIABLE_price_mid_peak"),
        diffs["price_off_peak_fix"].alias("FIXED_price_off_peak"),
        diffs["price_peak_fix"].alias("FIXED_price_peak"),
        diffs["price_mid_peak_fix"].alias("FIXED_price_mid_peak"),
        nonzero_mean(avgs["price_off_peak_var"], avgs["price_peak_var"], avgs["price_mid_peak_var"]).alias("AVG_VARIABLE"),
        nonzero_mean(avgs["price_off_peak_fix"], avgs["price_peak_fix"], avgs["price_mid_peak_fix"]).alias("AVG_FIXED"),
    )
    if clients is None:
        return block
    joined = clients.select("id").join(block, "id", "left")
    return joined.select("id", *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in HALF_YEAR_COLUMNS])
