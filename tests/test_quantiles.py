"""Exact distributed quantiles equal numpy's linear interpolation, including
the narrowing rounds (forced with a tiny bracket limit) and heavy ties."""

import numpy as np
import pytest

from retention.operators.quantiles import exact_quantiles, quantile_table


@pytest.mark.parametrize("max_bracket,accuracy", [(1_000_000, 10000), (40, 100), (7, 30)])
def test_matches_numpy(spark, max_bracket, accuracy):
    rng = np.random.default_rng(7)
    rows = []
    for g, n in (("a", 1000), ("b", 333), ("c", 1), ("d", 2)):
        vals = np.round(rng.lognormal(3, 1.5, n), 1)
        if g == "a":
            vals[:300] = 5.0  # a heavy tie
        rows += [(g, float(v)) for v in vals]
    rows.append(("b", None))
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = exact_quantiles(df, ["g"], "v", probs, max_bracket=max_bracket, accuracy=accuracy)
    for g in ("a", "b", "c", "d"):
        vals = np.array([v for k, v in rows if k == g and v is not None])
        want = np.quantile(vals, probs)
        assert got[g] == pytest.approx(list(want), rel=1e-12), g


def test_table_keeps_key_types(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 3.0), (2, 5.0)], "k int, v double")
    t = quantile_table(df, ["k"], "v", [0.5], ["med"])
    assert dict(t.dtypes)["k"] == "int"
    assert {r["k"]: r["med"] for r in t.collect()} == {1: 2.0, 2: 5.0}


from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(min_value=-50, max_value=50), min_size=1, max_size=60),
       st.sampled_from([(1_000_000, 10000), (5, 20)]))
def test_property_matches_numpy(spark, values, cfg):
    max_bracket, accuracy = cfg
    df = spark.createDataFrame([(float(v) / 4,) for v in values], "v double")
    probs = [0.1, 0.25, 0.5, 0.9]
    got = exact_quantiles(df, [], "v", probs, max_bracket=max_bracket, accuracy=accuracy)[""]
    want = np.quantile(np.array(values, dtype=float) / 4, probs)
    assert got == pytest.approx(list(want), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("accuracy", [2, 30])
def test_never_ranks_more_than_a_bracket(spark, monkeypatch, accuracy):
    """Heavy ties, zeros of both signs and far-out values: only brackets of the allowed size are ranked."""
    from retention.operators import quantiles
    rng = np.random.default_rng(3)
    vals = np.concatenate([np.full(700, 5.0), np.full(200, -0.0), np.full(50, 0.0), rng.normal(5, 1e-9, 400), [1e300, -1e300]])
    df = spark.createDataFrame([(float(v),) for v in vals] + [(None,), (float("nan"),)], "v double").repartition(3)
    ranked = []

    def spy(data, keys, key_types, state, inner=quantiles._rank):
        ranked.extend(s["m"] for s in state.values() if s["lo"] < s["hi"])
        return inner(data, keys, key_types, state)

    monkeypatch.setattr(quantiles, "_rank", spy)
    probs = [0.0, 0.1, 0.15, 0.5, 0.9, 1.0]
    got = exact_quantiles(df, [], "v", probs, max_bracket=3, accuracy=accuracy)[""]
    assert got == pytest.approx(list(np.quantile(vals, probs)), rel=1e-12)
    assert all(m <= 3 for m in ranked)


def test_too_many_groups_raise(spark):
    df = spark.createDataFrame([(i, 1.0) for i in range(5)], "k int, v double")
    with pytest.raises(ValueError):
        exact_quantiles(df, ["k"], "v", [0.5], max_groups=4)


@pytest.mark.parametrize("ties", [0.0, 0.5, 0.999])
def test_two_scans(spark, monkeypatch, ties):
    """However many rows tie: one scan sketches, one counts and stores a small part; the rest works on that part."""
    from retention.operators import quantiles
    rng = np.random.default_rng(11)
    vals = np.where(rng.random(40_000) < ties, 3.25, rng.normal(3, 2, 40_000))
    df = spark.createDataFrame([("g" if i % 3 else "h", float(v)) for i, v in enumerate(vals)], "g string, v double").repartition(4)
    scans, stored = [], []
    monkeypatch.setattr(quantiles, "_select", lambda *a, inner=quantiles._select: scans.append(1) or inner(*a))
    monkeypatch.setattr(quantiles, "materialize", lambda x, name, inner=quantiles.materialize: stored.append(inner(x, name)) or stored[-1])
    probs = [0.1, 0.25, 0.5, 0.75, 0.9]
    got = exact_quantiles(df, ["g"], "v", probs, accuracy=1000, max_bracket=20)
    for name, want in (("g", [v for i, v in enumerate(vals) if i % 3]), ("h", [v for i, v in enumerate(vals) if not i % 3])):
        assert got[name] == pytest.approx(list(np.quantile(want, probs)), rel=1e-12)
    assert len(scans) == 1 and len(stored) == 1
    assert stored[0].where("_v is not null").count() <= 40_000 * 5 * 8 / 1000      # within the brackets: at most 2 x 4 errors of the sketch


def test_a_sketch_that_misses_is_put_right(spark):
    """A bracket that does not hold its rank, as a base row says it does."""
    df = spark.createDataFrame([(float(v),) for v in range(100)], "v double")
    base = [{"_n": 100, "_lo": 0.0, "_hi": 99.0, "_q": [5.0, 6.0]}]
    assert exact_quantiles(df, [], "v", [0.5], base=base)[""] == [49.5]
