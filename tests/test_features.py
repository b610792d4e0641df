"""Scalar features, flags and the one-hot encoder."""

import datetime as dt

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from retention.functions.scalars import (log10p1, months_between_ref, nonzero_mean, r6, recode_flag,
                                         round_half_up, tenure_years)
from retention.operators import model as M
from retention.operators.forests import CutForest
from retention.operators.encode import SparseLevels, StoredLevels, bool_columns_to_int, entry_sums, fit_one_hot, fit_sparse
from retention.operators.columns import drop_columns, move_last, rename, select_columns


def test_dates(spark):
    rows = [(dt.date(2010, 1, 1), dt.date(2012, 1, 1)),   # two years
            (dt.date(2012, 1, 1), dt.date(2010, 1, 1)),   # end before start -> -1 (truncate toward 0)
            (None, dt.date(2010, 1, 1))]
    df = spark.createDataFrame(rows, "a date, e date")
    out = df.select(tenure_years("e", "a").alias("t"), months_between_ref("2016-01-01", "a").alias("m"),
                    months_between_ref("2016-01-01", "e", negate=True).alias("neg")).collect()
    assert out[0]["t"] == 1  # 730 days / 365.2425 = 1.998 -> 1
    assert out[1]["t"] == -1
    assert out[2]["t"] is None
    assert out[0]["m"] == 71  # 2191 days / 30.436875 = 71.98
    assert out[0]["neg"] == -48  # 1461 days / 30.436875 = 48.0


def test_log_and_flags(spark):
    df = spark.createDataFrame([(-1.0, "t"), (-2.0, "f"), (0.0, "x"), (9.0, None)], "x double, g string")
    out = df.select(log10p1("x").alias("l"), recode_flag("g").alias("f")).collect()
    assert out[0]["l"] is None and out[1]["l"] is None
    assert out[2]["l"] == 0.0 and out[3]["l"] == pytest.approx(1.0)
    assert [r["f"] for r in out] == [1, 0, None, None]


def test_nonzero_mean_and_rounding(spark):
    df = spark.createDataFrame([(0.0, 3.0, 6.0), (0.0, 0.0, 0.0), (None, 2.0, 0.0)], "a double, b double, c double")
    assert [r[0] for r in df.select(nonzero_mean("a", "b", "c")).collect()] == [4.5, 0.0, 2.0]
    v = spark.createDataFrame([(0.1234565,), (-0.0,), (2.25,)], "x double")
    assert [r[0] for r in v.select(r6("x")).collect()] == [0.123457, 0.0, 2.25]
    assert [r[0] for r in v.select(round_half_up("x", 1)).collect()] == [0.1, 0.0, 2.3]


def test_one_hot_levels_nulls_and_drops(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "MISSING"), (5, "a"), (6, "rare")],
                               "id int, c string")
    enc = fit_one_hot(df, "c", "ch", drop_levels=("MISSING",), min_count=2)
    assert enc.levels == ["MISSING", "a", "b", "rare"]
    assert enc.output_columns == ["ch_a"]  # MISSING listed, b and rare below min_count
    full = fit_one_hot(df, "c", "ch")
    out = {r["id"]: r for r in full.transform(df).collect()}
    assert "c" not in full.transform(df).columns
    assert sum(out[3][c] for c in full.output_columns) == 0  # NULL -> all zeros
    assert all(sum(out[i][c] for c in full.output_columns) == 1 for i in (1, 2, 4, 5, 6))
    unseen = spark.createDataFrame([(9, "zzz")], "id int, c string")
    assert sum(full.transform(unseen).first()[c] for c in full.output_columns) == 0


def test_column_edits(spark):
    df = spark.createDataFrame([(1, True, 2.0)], "id int, flag boolean, churn double")
    assert bool_columns_to_int(df).dtypes[1] == ("flag", "int")
    assert move_last(df, "id").columns == ["flag", "churn", "id"]
    assert rename(df, {"flag": "f", "nope": "x"}).columns == ["id", "f", "churn"]
    with pytest.raises(KeyError):
        drop_columns(df, ["absent"])
    with pytest.raises(KeyError):
        select_columns(df, ["absent"])


def test_fit_many_equals_single(spark):
    from retention.operators.encode import fit_one_hot_many
    df = spark.createDataFrame([("a", "x"), ("b", None), ("a", "y"), (None, "y")], "c1 string, c2 string")
    many = fit_one_hot_many(df, [("c1", "p1", ()), ("c2", "p2", ("x",))])
    single = [fit_one_hot(df, "c1", "p1"), fit_one_hot(df, "c2", "p2", drop_levels=("x",))]
    assert [(m.levels, m.output_columns) for m in many] == [(s.levels, s.output_columns) for s in single]


def test_sparse_levels_equal_named_columns(spark):
    df = spark.createDataFrame([(i, ["b", "a", None, "MISSING", "a", "rare", "b"][i % 7] if i < 70 else None) for i in range(72)], "id int, c string")
    named, sparse = fit_one_hot(df, "c", "ch", ("MISSING",), 3), fit_sparse(df, "c", "ch", ("MISSING",), 3)
    unseen = df.unionByName(spark.createDataFrame([(99, "new")], "id int, c string"))
    a = {r["id"]: [r[c] for c in named.output_columns] for r in named.transform(unseen).collect()}
    rows = sparse.transform(unseen)
    assert rows.columns == ["id", "ch"] and M.feature_names(rows, ["id", "ch"]) == ["id", *named.output_columns]
    b = {r["id"]: r["ch"].toArray().astype(int).tolist() for r in rows.collect()}
    assert a == b and a[99] == a[2] == [0] * len(named.output_columns)
    assert sparse.transform(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        fit_sparse(df.where("c is null"), "c").transform(df)


def test_more_levels_than_a_schema_names(spark):
    """Levels in a stored table give the same vectors as levels in the schema; entries are summed without a buffer of all of them."""
    df = spark.createDataFrame([(i, f"v{i * i % 41}" if i % 9 else None) for i in range(400)], "id int, c string")
    unseen = df.unionByName(spark.createDataFrame([(900, "new"), (900, "v1")], "id int, c string"))
    named, stored = (fit_sparse(df, "c", "ch", ("v4",), 15, n) for n in (100, 3))
    assert isinstance(stored, StoredLevels) and isinstance(named, SparseLevels) and stored.size == len(named.levels.output_columns) > 3
    a, b = (sorted((r["id"], r["ch"].toArray().tolist()) for r in x.transform(unseen).collect()) for x in (named, stored))
    assert a == b and len(a) == 402
    assert sorted(named.names().collect()) == sorted(stored.names().collect())
    want = {i: n for i, n in enumerate(np.sum([v for _, v in a], axis=0).tolist())}
    for x in (named, stored):
        assert {r["entry"]: r["total"] for r in entry_sums(x.transform(unseen), "ch").collect()} == want
    assert stored.transform(df.limit(0)).count() == 0 and stored.transform(unseen, keep_source=True).columns == ["id", "c", "ch"]
    mixed = spark.createDataFrame([(1, Vectors.dense(1, 0, 2)), (2, Vectors.sparse(3, [2], [5.0])), (3, None)], ["i", "v"])
    assert sorted(map(tuple, entry_sums(mixed, "v").collect())) == [(0, 1.0), (1, 0.0), (2, 7.0)]
    with pytest.raises(ValueError):
        fit_sparse(df, "c", "ch", (), 10_000, 3)


def test_a_forest_trains_on_sparse_levels(spark):
    """The scores of named columns and of the vector are the same, and so are the importances by name."""
    df = spark.createDataFrame([(i, float(i % 11), f"level{i % 23}", int(i % 23 < 9)) for i in range(600)], "id long, a double, c string, churn int")
    cfg = M.ForestConfig(num_trees=5, max_depth=6, seed=3, feature_subset="all")
    out = []
    for enc in (fit_one_hot(df, "c"), fit_sparse(df, "c")):
        rows = enc.transform(df)
        feats = M.feature_columns(rows)
        pipe = M.forest_pipeline(feats, cfg)
        pipe.getStages()[-1].setBootstrap(False)     # a bootstrap's draws depend on how files are packed into partitions
        model = pipe.fit(M.with_label(rows))
        out.append((sorted((r["id"], r["prediction"], round(r["churn_probability"], 9)) for r in M.score(model, rows).collect()),
                    [(r["features"], round(r["importance"], 9)) for r in M.importances(model, M.feature_names(rows, feats)).collect()]))
    assert M.fit_forest(rows, feats, cfg).stages[-1].getNumTrees == 5       # a vector column among the features
    assert out[0] == out[1] and len(out[0][1]) == 24 and sum(v for _, v in out[0][1]) == pytest.approx(1.0, abs=1e-6)
    cut = CutForest.of(model.stages[-1], spark)     # splits by the two categories of an entry
    data = model.stages[0].transform(M.with_label(rows))
    assert cut.accuracies(data, [5], [30])[5, 30] == pytest.approx(sum(p == (i % 23 < 9) for i, p, _ in out[1][0]) / 600)
