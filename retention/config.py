"""Job parameters.

The reference hard-codes its cut-off dates and reference date against its
own data (2015 prices, reference 2016-01-01). Here they are parameters; the
defaults fit the mapped test tables (orders run 1995-01 .. 2001-08).
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Params:
    # strict lower bounds of the "6 month" and "3 month" price windows
    cut_6m: str = "2001-01-01"
    cut_3m: str = "2001-05-01"
    # reference date for month features (tenure-like counts)
    reference_date: str = "2001-08-01"
    # test mapping only: start of the "last month" and "forecast year" sums
    last_month_from: str = "2001-07-01 00:00:00"
    year_from: str = "2001-01-01 00:00:00"
    # rows of the per-client series used by the half-year block: [0, 6) and [6, 12)
    half_len: int = 6
    # histogram bins for the account plots and the price plots
    hist_bins: int = 50
    price_bins: int = 100
    # split fractions (test share) and seed salt
    test_share_fe: float = 0.25
    test_share_rf: float = 0.20
    seed: int = 42
    # columns log10(x + 1) transformed by the feature job (fixed list)
    log_columns: tuple = field(default=(
        "cons_12m", "cons_gas_12m", "cons_last_month", "forecast_cons_12m",
        "forecast_cons_year", "forecast_meter_rent_12m", "imp_cons",
    ))


DEFAULT = Params()
