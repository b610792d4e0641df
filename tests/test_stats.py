"""Profile, distributions and correlation invariants."""

import math
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from retention.operators import distributions as D
from retention.operators import profile as PR
from retention.operators import relations as R


@pytest.fixture(scope="module")
def small(spark):
    rows = [(1, 1.0, 5.0, 10.0, 0), (2, 2.0, 5.0, None, 1), (3, 3.0, 5.0, 30.0, 0), (4, 4.0, 5.0, 40.0, 1),
            (5, 100.0, 5.0, 50.0, 0)]
    return spark.createDataFrame(rows, "id int, x double, const double, y double, churn int")


def test_describe_matches_pandas_rules(small):
    out = {r["column_name"]: r for r in PR.describe(small, ["x", "y"]).collect()}
    x = out["x"]
    assert x["count"] == 5 and x["mean"] == pytest.approx(22.0)
    assert x["std"] == pytest.approx(statistics.stdev([1.0, 2.0, 3.0, 4.0, 100.0]))  # sample std
    assert (x["p25"], x["p50"], x["p75"]) == (2.0, 3.0, 4.0)
    assert out["y"]["count"] == 4 and out["y"]["p25"] == pytest.approx(25.0)  # linear interpolation


def test_nulls_info_shape(small):
    nulls = {r["column_name"]: r for r in PR.null_counts(small).collect()}
    assert nulls["y"]["null_count"] == 1 and nulls["y"]["null_pct"] == pytest.approx(20.0)
    info = {r["column_name"]: r for r in PR.info(small).collect()}
    assert info["y"]["non_null"] == 4 and info["x"]["dtype"] == "double"
    assert PR.shape(small).first().asDict() == {"n_rows": 5, "n_columns": 5}


def test_histogram_invariants(small):
    h = D.histogram(small, ["x", "const", "y"], bins=10, by="churn").collect()
    per = {}
    for r in h:
        per.setdefault(r["column_name"], 0)
        per[r["column_name"]] += r["count"]
        assert 0 <= r["bin"] < 10 and r["bin_lo"] < r["bin_hi"]
    assert per == {"x": 5, "const": 5, "y": 4}  # counts sum to non-null rows
    top = [r for r in h if r["column_name"] == "x" and r["bin"] == 9]
    assert sum(r["count"] for r in top) == 1  # the max lands in the last (closed) bin
    const = [r for r in h if r["column_name"] == "const"]
    assert {r["bin"] for r in const} == {5}  # degenerate range -> [v - 0.5, v + 0.5]


def test_box_stats(small):
    out = {r["column_name"]: r for r in D.box_stats(small, ["x"], by=None).collect()}["x"]
    assert (out["q1"], out["median"], out["q3"]) == (2.0, 3.0, 4.0)
    assert out["whisker_high"] == 4.0 and out["n_outliers"] == 1  # 100 is an outlier


def test_class_share(small):
    out = {r["churn"]: r for r in D.class_share(small).collect()}
    assert out[0]["companies"] == 3 and out[0]["share"] == pytest.approx(60.0)
    assert out[0]["share"] + out[1]["share"] == pytest.approx(100.0)
    assert out[1]["share_label"] == 40.0


def test_correlation_invariants(small):
    cols = ["x", "const", "y", "churn"]
    rows = R.correlation(small, cols).collect()
    m = {(r["col_a"], r["col_b"]): r["corr"] for r in rows}
    assert len(m) == 16
    for a in cols:
        for b in cols:
            assert m[(a, b)] == m[(b, a)] or (m[(a, b)] is None and m[(b, a)] is None)
            if m[(a, b)] is not None:
                assert -1.0 - 1e-12 <= m[(a, b)] <= 1.0 + 1e-12
    assert m[("const", "x")] is None  # zero variance -> NULL, not an error
    assert m[("x", "x")] == pytest.approx(1.0)
    # pairwise complete: (x, y) uses the 4 rows where y is present
    xs, ys = [1.0, 3.0, 4.0, 100.0], [10.0, 30.0, 40.0, 50.0]
    mx, my = sum(xs) / 4, sum(ys) / 4
    cov = sum((a - mx) * (b - my) for a, b in zip(xs, ys)) / 4
    r = cov / math.sqrt(sum((a - mx) ** 2 for a in xs) / 4 * sum((b - my) ** 2 for b in ys) / 4)
    assert m[("x", "y")] == pytest.approx(r)


def test_density(small, spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 2, 3, 3, 3, 4, 4, 5, 9]], "v double")
    hist, kde = D.density(df, "v")
    h = hist.collect()
    assert sum(r["count"] for r in h) == 10
    assert sum(r["density"] * (r["bin_hi"] - r["bin_lo"]) for r in h) == pytest.approx(1.0)
    k = sorted(kde.collect(), key=lambda r: r["point"])
    assert len(k) == 200
    step = k[1]["x"] - k[0]["x"]
    assert sum(r["density"] for r in k) * step == pytest.approx(1.0, abs=0.02)  # integrates to ~1


def test_value_counts_and_freq(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, None)], "id int, c string")
    assert [(r["c"], r["count"]) for r in PR.value_counts(df, "c").collect()] == [("a", 2), ("b", 1)]
    assert {(r["n_rows"], r["n_keys"]) for r in PR.freq_of_freq(df).collect()} == {(2, 1), (1, 2)}
    assert [r["id"] for r in PR.preview(df, ["id", "c"], 2).collect()] == [1, 1]


def test_correlation_of_pairs_with_gaps(spark):
    """NaN is a gap; a column that is constant on a pair's common rows has no correlation there."""
    import pandas as pd
    nan = float("nan")
    rows = [(1.1, 5.3, 2.0, None), (1.1, 7.7, nan, None), (9.9, None, 4.0, None), (3.3, None, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(3)
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in R.correlation(df, ["a", "b", "c", "d"]).collect()}
    want = pd.DataFrame(rows, columns=list("abcd"), dtype=float).corr(min_periods=2)
    assert len(got) == 16
    assert got["a", "b"] is None and got["b", "a"] is None and got["d", "d"] is None and got["b", "d"] is None
    for p, q in [("a", "a"), ("a", "c"), ("c", "a"), ("b", "b")]:
        assert got[p, q] == pytest.approx(want.loc[p, q])


@pytest.mark.parametrize("shape", ["normal", "heavy tail", "ties", "two far apart"])
def test_density_equals_the_plain_sum(spark, shape):
    """Cells and their moments against the kernel summed value by value."""
    rng = np.random.default_rng(2)
    v = {"normal": rng.normal(10, 3, 3000), "heavy tail": rng.pareto(1.1, 3000), "ties": np.repeat([1.0, 1.5, 9.0], [2000, 5, 900]),
         "two far apart": np.array([0.0, 1000.0])}[shape]
    df = spark.createDataFrame([(float(x),) for x in v] + [(None,), (float("nan"),)], "v double").repartition(3)
    _, kde = D.density(df, "v")
    rows = kde.orderBy("point").collect()
    h = v.std(ddof=1) * len(v) ** -0.2
    x = np.array([r["x"] for r in rows])
    want = np.exp(-0.5 * ((x[:, None] - v[None]) / h) ** 2).sum(1) / (len(v) * h * np.sqrt(2 * np.pi))
    assert len(rows) == 200 and np.abs(np.array([r["density"] for r in rows]) - want).max() < 1e-9 * want.max()
    plan = kde._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan[plan.rindex("Aggregate"):]      # below the sums by cell no row is multiplied
