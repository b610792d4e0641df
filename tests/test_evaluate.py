"""Confusion matrix and metrics on fixed (label, prediction) pairs."""

import pytest

from retention.operators import evaluate as EV


def test_metrics_mixed(spark):
    pairs = [(0.0, 0.0)] * 5 + [(0.0, 1.0)] * 1 + [(1.0, 0.0)] * 2 + [(1.0, 1.0)] * 2
    df = spark.createDataFrame(pairs, "label double, prediction double")
    r = EV.metrics(df).first()
    assert (r["tn"], r["fp"], r["fn"], r["tp"]) == (5, 1, 2, 2)
    assert r["accuracy"] == pytest.approx(0.7)
    assert r["precision"] == pytest.approx(2 / 3)
    assert r["recall"] == pytest.approx(0.5)
    assert r["f1"] == pytest.approx(2 * (2 / 3) * 0.5 / (2 / 3 + 0.5))
    assert r["tn"] + r["fp"] + r["fn"] + r["tp"] == df.count()


def test_metrics_no_predicted_positive(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0)], "label double, prediction double")
    r = EV.metrics(df).first()
    assert r["precision"] == 0.0 and r["recall"] == 0.0 and r["f1"] == 0.0  # zero denominators -> 0


def test_metrics_all_correct(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0)], "label double, prediction double")
    r = EV.metrics(df).first()
    assert (r["accuracy"], r["precision"], r["recall"], r["f1"]) == (1.0, 1.0, 1.0, 1.0)
    assert {(x["label"], x["prediction"], x["n"]) for x in EV.confusion_long(df).collect()} == {(0.0, 0.0, 1), (1.0, 1.0, 1)}
