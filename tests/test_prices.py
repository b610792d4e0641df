"""Hand-computed price features on inline fixtures."""

import datetime as dt

import pytest

from retention.config import Params
from retention.operators import prices as P

PARAMS = Params(cut_6m="2015-06-01", cut_3m="2015-10-01")
COLS = "id long, price_date date, price_off_peak_var double, price_peak_var double, price_mid_peak_var double, " \
       "price_off_peak_fix double, price_peak_fix double, price_mid_peak_fix double, seq long"


def d(m, y=2015):
    return dt.date(y, m, 1)


def row(i, date, ov=0.0, pv=0.0, mv=0.0, of=0.0, pf=0.0, mf=0.0, seq=0):
    return (i, date, ov, pv, mv, of, pf, mf, seq)


@pytest.fixture(scope="module")
def prices(spark):
    rows = [
        # dup month: two rows in January with unequal values
        row(1, d(1), ov=1.0, of=2.0, seq=1), row(1, d(1), ov=3.0, of=4.0, seq=2), row(1, d(2), ov=5.0, of=9.0, seq=3),
        # nulls: first month NULL in one band only; id 3 all NULL energy
        row(2, d(1), ov=None, of=10.0, seq=1), row(2, d(2), ov=4.0, of=12.0, seq=2),
        row(3, d(1), ov=None, of=1.0, seq=1), row(3, d(2), ov=None, of=1.0, seq=2),
        # cut: a row exactly on the 6m cut, one after, one in the 3m window
        row(4, d(6), ov=1.0, seq=1), row(4, d(7), ov=2.0, seq=2), row(4, d(11), ov=6.0, seq=3),
        # id 5 absent from the 3m window
        row(5, d(7), ov=1.0, seq=1),
    ]
    return spark.createDataFrame(rows, COLS)


def by_id(df):
    return {r["id"]: r.asDict() for r in df.collect()}


def test_endpoint_delta_first_last_skip_nulls(prices):
    out = by_id(P.endpoint_delta(prices))
    assert out[1]["offpeak_diff_dec_january_energy"] == pytest.approx(5.0 - 2.0)  # month means 2.0 -> 5.0
    assert out[1]["offpeak_diff_dec_january_power"] == pytest.approx(9.0 - 3.0)
    assert out[2]["offpeak_diff_dec_january_energy"] == pytest.approx(0.0)  # only Feb is non-null
    assert out[2]["offpeak_diff_dec_january_power"] == pytest.approx(2.0)
    assert out[3]["offpeak_diff_dec_january_energy"] is None


def test_raw_mean_vs_month_mean(prices):
    spread = by_id(P.mean_band_spread(prices))
    # raw-row mean of off-peak var for id 1 is (1+3+5)/3 = 3; peak var is 0
    assert spread[1]["off_peak_peak_var_mean_diff"] == pytest.approx(3.0)
    mx = by_id(P.max_monthly_spread(prices))
    # month means 2.0 and 5.0 -> max spread 5.0
    assert mx[1]["off_peak_peak_var_max_monthly_diff"] == pytest.approx(5.0)


def test_window_means_strict_cut_and_inner_keep(prices):
    out = by_id(P.window_means(prices, PARAMS))
    assert set(out) == {4}  # only id 4 has rows in the 6m and 3m windows
    r = out[4]
    assert r["mean_year_price_off_peak_var"] == pytest.approx(3.0)
    assert r["mean_6m_price_off_peak_var"] == pytest.approx(4.0)  # June 1st is excluded (strict >)
    assert r["mean_3m_price_off_peak_var"] == pytest.approx(6.0)
    assert r["mean_3m_price_off_peak"] == pytest.approx(6.0)  # var + fix, fix = 0
    all_ids = by_id(P.window_means(prices, PARAMS, keep_all_windows=False))
    assert all_ids[5]["mean_3m_price_off_peak_var"] is None


def test_fused_equals_parts(prices):
    fused = by_id(P.price_features(prices, PARAMS, keep_all_windows=False))
    ep = by_id(P.endpoint_delta(prices))
    ms = by_id(P.mean_band_spread(prices))
    mx = by_id(P.max_monthly_spread(prices))
    wm = by_id(P.window_means(prices, PARAMS, keep_all_windows=False))
    for i in fused:
        for part in (ep, ms, mx, wm):
            for k, v in part[i].items():
                assert fused[i][k] == pytest.approx(v) if v is not None else fused[i][k] is None, (i, k)


def test_half_year_block(spark):
    rows = []
    ov = [1, 2, 3, 4, 5, 0, 7, 8, 0, 0, 9, 0, 100, 100]
    pf = [0] * 6 + [3] * 8
    for n in range(14):
        date = dt.date(2015 + (n // 12), n % 12 + 1, 1)
        rows.append(row(6, date, ov=float(ov[n]), pv=0.0, mv=2.0, of=10.0, pf=float(pf[n]), mf=0.0, seq=n))
    for n in range(5):
        rows.append(row(7, d(n + 1), ov=1.0, of=1.0, seq=n))
    prices = spark.createDataFrame(rows, COLS)
    clients = spark.createDataFrame([(6,), (7,), (8,)], "id long")
    out = by_id(P.half_year_block(prices, clients, Params(), order_cols=["seq"]))
    assert set(out) == {6, 7, 8}
    r = out[6]
    assert r["VARIABLE_price_off_peak"] == pytest.approx(9 - 5)  # last non-zero of each half
    assert r["VARIABLE_price_peak"] == 0.0
    assert r["VARIABLE_price_mid_peak"] == 0.0
    assert r["AVG_VARIABLE"] == pytest.approx((7 + 2) / 2)  # zero averages are skipped
    assert r["FIXED_price_peak"] == 0.0  # first half all zero
    assert r["AVG_FIXED"] == pytest.approx(10.0)
    assert all(v == 0.0 for k, v in out[7].items() if k != "id")  # second half empty
    assert all(v == 0.0 for k, v in out[8].items() if k != "id")  # no prices -> zeros
