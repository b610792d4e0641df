"""Split invariants and forest behaviour on a separable toy set."""

import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from retention.operators import evaluate as EV
from retention.operators import model as M
from retention.operators import ranks
from retention.operators.forests import CutForest


@pytest.fixture(scope="module")
def toy(spark):
    rows = [(i, float(i % 7), float((i * 13) % 11), 1 if (i % 7) >= 4 else 0) for i in range(400)]
    return spark.createDataFrame(rows, "id long, a double, b double, churn int")


def test_split_disjoint_and_complete(toy):
    train, test = M.split(toy, 0.2, 42)
    ids_tr = {r["id"] for r in train.select("id").collect()}
    ids_te = {r["id"] for r in test.select("id").collect()}
    assert not ids_tr & ids_te
    assert len(ids_tr | ids_te) == 400
    assert len(ids_te) == 80
    # stable under repartitioning
    again = {r["id"] for r in M.split(toy.repartition(7), 0.2, 42)[1].select("id").collect()}
    assert again == ids_te


@pytest.mark.parametrize("n, share", [(0, 0.2), (1, 0.2), (7, 0.25), (400, 0.07), (400, 1.0), (9000, 0.25), (9000, 0.0)])
def test_exact_split_sizes(spark, n, share):
    """ceil(share * n) rows, the same ones however the input is partitioned; by brute force over the hashes."""
    df = spark.range(n).withColumnRenamed("id", "key")
    want = {k for _, k in sorted((int(hashlib.md5(f"{k}42".encode()).hexdigest()[:15], 16), k) for k in range(n))[:math.ceil(Fraction(str(share)) * n)]}
    for rows in (df, df.repartition(5), df.orderBy(F.desc("key"))):
        split = M.with_exact_split(rows, share, 42, "key")
        assert {r["key"] for r in split.filter("split = 'test'").collect()} == want and split.count() == n


def test_exact_split_narrows_and_breaks_ties(spark, monkeypatch):
    """Few rows a range, and hashes that all agree: the id decides."""
    monkeypatch.setattr(ranks, "hash_long", lambda key, seed: F.expr(f"cast({key} % 3 as bigint) * 7"))
    df = spark.range(1000)
    assert ranks.smallest_bound(df, 350, "id", 1, bits=3, at_most=5) == (7, 46)    # 334 rows at 0, then the 16th of 1, 4, 7, ...
    assert ranks.smallest_bound(df, 334, "id", 1, bits=3, at_most=5) == (0, 999)


def test_numbers_without_gaps(spark):
    rows = [(i, i % 3 if i % 10 else None, i * 7919 % 1000) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, g int, v long").repartition(6)
    got = {r["id"]: r["k"] for r in ranks.numbered(df, ["v"], ["g"], "k").collect()}
    for g in (None, 0, 1, 2):
        own = sorted((v, i) for i, gg, v in rows if gg == g)
        assert [got[i] for _, i in own] == list(range(len(own)))
    assert sorted(r["k"] for r in ranks.numbered(df, ["v"], name="k").collect()) == list(range(1000))
    assert ranks.numbered(df.limit(0), ["v"], ["g"]).count() == 0


def test_folds_are_stratified(toy):
    sizes = {}
    for r in M.with_folds(toy, 5).groupBy("churn", "fold").count().collect():
        sizes.setdefault(r["churn"], []).append(r["count"])
    assert len(sizes) == 2 and all(len(s) == 5 and max(s) - min(s) <= 1 for s in sizes.values())
    assert sum(map(sum, sizes.values())) == 400


def _vectors(df):
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(M.with_label(df))


def test_all_trees_score_as_the_model(spark, toy):
    noisy = toy.withColumn("churn", F.when(F.col("id") % 5 == 0, 1 - F.col("churn")).otherwise(F.col("churn"))).withColumn(
        "b", F.col("b") + F.col("id") % 13 / 10)
    data = M.materialize(_vectors(noisy), "toy")
    model = M.forest(M.ForestConfig(num_trees=12, max_depth=9, seed=5)).fit(data)
    cut = CutForest.of(model, spark)
    assert len(cut.root) == 12 and len(cut.left) == model.totalNumNodes
    rows = model.transform(data).select("features", vector_to_array("probability").alias("p"), "prediction", "label").collect()
    x = np.array([r["features"].toArray() for r in rows])
    p = cut.probabilities(x, [12], 30)[12]
    assert np.abs(p - np.array([r["p"] for r in rows])).max() < 1e-12
    assert cut.accuracies(data, [3, 12], [4, 30])[12, 30] == pytest.approx(np.mean([r["prediction"] == r["label"] for r in rows]))
    # the first trees are those of the model's own list
    first = [t.transform(data.select("features")).select(vector_to_array("probability").alias("p")).collect() for t in model.trees[:3]]
    want = np.mean([[r["p"] for r in t] for t in first], axis=0)
    assert np.abs(cut.probabilities(x, [3], 30)[3] - want).max() < 1e-12


@pytest.mark.parametrize("depth", [0, 1, 2, 3, 5, 8])
def test_a_cut_tree_is_a_tree_of_that_depth(spark, toy, depth):
    """Without random draws the forest of a smaller depth is the deep one cut, leaf for leaf."""
    noisy = toy.withColumn("churn", F.pmod(F.hash("id"), F.lit(3)) % 2).withColumn("b", F.col("b") + F.col("id") / 500)
    data = M.materialize(_vectors(noisy), "toy")
    cfg = dict(numTrees=1, featureSubsetStrategy="all", bootstrap=False, seed=1, featuresCol="features", labelCol="label")
    deep = CutForest.of(RandomForestClassifier(maxDepth=12, **cfg).fit(data), spark)
    small = RandomForestClassifier(maxDepth=depth, **cfg).fit(data)
    rows = small.transform(data).select("features", vector_to_array("probability").alias("p")).collect()
    x = np.array([r["features"].toArray() for r in rows])
    assert np.abs(deep.probabilities(x, [1], depth)[1] - np.array([r["p"] for r in rows])).max() < 1e-12


def test_forest_fit_score_importance(toy):
    train, test = M.split(toy, 0.25, 42)
    feats = M.feature_columns(toy)
    assert feats == ["a", "b"]
    model = M.fit_forest(train, feats, M.ForestConfig(num_trees=10, max_depth=5, seed=42))
    scored = M.score(model, test)
    rows = scored.collect()
    assert all(0.0 <= r["churn_probability"] <= 1.0 for r in rows)
    acc = EV.metrics(scored).first()["accuracy"]
    majority = max(sum(r["label"] for r in rows), len(rows) - sum(r["label"] for r in rows)) / len(rows)
    assert acc >= majority - 0.05
    imp = M.importances(model, feats).collect()
    assert sum(r["importance"] for r in imp) == pytest.approx(1.0)
    assert max(imp, key=lambda r: r["importance"])["features"] == "a"


def test_importances_are_sorted(toy):
    model = M.fit_forest(toy, ["b", "a"], M.ForestConfig(num_trees=3, max_depth=3))
    assert [r["features"] for r in M.importances(model, ["b", "a"]).collect()] == ["b", "a"]


def test_grid_search(toy):
    train, _ = M.split(toy, 0.25, 42)
    found = M.grid_search(train, ["a", "b"], num_trees=(4, 2), max_depth=(3, 1, 3), min_leaf=(1, 300), folds=4)
    rows = [tuple(r) for r in found.table.collect()]
    assert [r[:3] for r in rows] == [(n, d, leaf) for n in (2, 4) for d in (1, 3) for leaf in (1, 300)]
    assert all(0.0 <= r[3] <= 1.0 for r in rows) and sum(r[4] for r in rows) == 1
    best = max(rows, key=lambda r: r[3])
    assert best[4] and best[3] > 0.9 and min(r[3] for r in rows if r[2] == 300) < 0.7     # no split leaves 300 rows on both sides
    p = M.parameters(found.model).first()
    assert (p["num_trees"], p["max_depth"], p["min_leaf"]) == best[:3] and p["n_features"] == 2


def test_recommended_conf_scales_with_input():
    from retention.session import recommended_conf
    small = recommended_conf(10 << 20, 8)
    big = recommended_conf(100 * (1 << 40), 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    assert int(big["spark.sql.shuffle.partitions"]) == 409600  # 100 TB / 256 MB


def test_same_seed_same_forest_however_partitioned(toy):
    cfg = M.ForestConfig(num_trees=5, max_depth=4, seed=7)
    scores = []
    for part in (toy, toy.repartition(7), toy.orderBy(F.desc("id")).coalesce(2)):
        model = M.fit_forest(part, ["a", "b"], cfg)
        scores.append([tuple(r) for r in M.score(model, toy).orderBy("id").collect()])
    assert scores[0] == scores[1] == scores[2]


def _noisy(toy):
    return toy.withColumn("churn", F.when(F.col("id") % 5 == 0, 1 - F.col("churn")).otherwise(F.col("churn"))).withColumn(
        "b", F.col("b") + F.col("id") % 13 / 10)


def test_a_forest_in_parts_is_one_forest(toy):
    """No fit has more than its share of the nodes; votes and importances are those of all trees."""
    data = _noisy(toy)
    model = M.fit_forest(data, ["a", "b"], M.ForestConfig(num_trees=12, max_depth=8, seed=5, nodes_per_fit=500))
    fitted = [m.stages[-1] for m in model.models()]
    assert len(fitted) > 2 and len({rf.getOrDefault("seed") for rf in fitted}) == len(fitted)
    assert sum(rf.getNumTrees for rf in fitted) == 12 and max(rf.totalNumNodes for rf in fitted) < 700
    p = M.parameters(model).first()
    assert (p["num_trees"], p["seed"], p["n_nodes"]) == (12, 5, sum(rf.totalNumNodes for rf in fitted))
    vectors = _vectors(data).select("id", "features")
    trees = [t for rf in fitted for t in rf.trees]
    votes = [{r["id"]: r["p"] for r in t.transform(vectors).select("id", vector_to_array("probability").alias("p")).collect()} for t in trees]
    for r in M.score(model, data).collect():
        want = np.mean([v[r["id"]] for v in votes], axis=0)
        assert r["churn_probability"] == pytest.approx(want[1]) and (abs(want[1] - 0.5) < 1e-9 or r["prediction"] == want.argmax())
    every = np.mean([t.featureImportances.toArray() for t in trees], axis=0)
    assert [r["importance"] for r in M.importances(model, ["a", "b"]).orderBy("features").collect()] == pytest.approx(every.tolist())


def test_parts_score_repeated_and_null_ids(spark, toy):
    """Votes are added up by row, not by id; columns of the rows stay."""
    data = _noisy(toy)
    model = M.fit_forest(data, ["a", "b"], M.ForestConfig(num_trees=9, max_depth=4, seed=5, nodes_per_fit=1300))
    assert len(model.parts) > 1
    rows = data.withColumn("id", F.when(F.col("id") >= 10, F.col("id") % 50))
    got = sorted(tuple(r)[1:] for r in M.score(model, rows, keep=["b"]).collect())
    assert got == sorted(tuple(r)[1:] for r in M.score(model, data, keep=["b"]).collect()) and len(got) == 400


def test_a_small_forest_is_one_fit(toy):
    """As large forests before: the model of one fit with the given seed, scored as it scores itself."""
    model = M.fit_forest(_noisy(toy), ["a", "b"], M.ForestConfig(num_trees=10, max_depth=5, seed=3))
    assert len(model.parts) == 1
    own = model.parts[0].transform(M.with_label(_noisy(toy))).select("id", "label", "prediction", vector_to_array("probability")[1]).collect()
    assert sorted(map(tuple, own)) == sorted(map(tuple, M.score(model, _noisy(toy)).collect()))
    assert model.importance == model.parts[0].stages[-1].featureImportances.toArray().tolist()


def test_parts_bound_the_counts_of_rows_and_trees(toy):
    """Trees of few nodes: the executors' counts and node ids, not the nodes, decide how many trees a fit takes."""
    model = M.fit_forest(_noisy(toy), ["a", "b"], M.ForestConfig(num_trees=30, max_depth=1, seed=5, counts_per_fit=400 * 8))
    trees = [m.stages[-1].getNumTrees for m in model.models()]
    assert sum(trees) == 30 == model.num_trees and max(trees) <= 8
    one = M.fit_forest(_noisy(toy), ["a", "b"], M.ForestConfig(num_trees=2, max_depth=1, seed=5, counts_per_fit=1))
    assert [m.stages[-1].getNumTrees for m in one.models()] == [1, 1]


def test_node_statistics_leave_an_executor_room(toy):
    """Two tasks' statistics take a small share of a heap of 1800 MB."""
    assert M.forest(M.ForestConfig()).getMaxMemoryInMB() <= 64
