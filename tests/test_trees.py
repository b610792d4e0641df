"""Forests whose trees are grown in tasks: held against ``pyspark.ml``, against single trees, and over other partitionings."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from retention.operators import evaluate as EV
from retention.operators import model as M
from retention.operators import trees as T


@pytest.fixture(scope="module")
def rows(spark):
    """Two informative columns, one of many values, one constant, with noise in the label."""
    out = [(i, float(i % 7), float((i * 13) % 11) + i % 13 / 10, float(i * 7919 % 997), 3.0, int((i % 7) >= 4) if i % 5 else 1 - int((i % 7) >= 4))
           for i in range(900)]
    return M.materialize(spark.createDataFrame(out, "id long, a double, b double, c double, d double, churn int"), "trees")


FEATURES = ["a", "b", "c", "d"]
IN_TASKS = dict(counts_for_tasks=0)


@pytest.mark.parametrize("depth, leaf", [(0, 1), (1, 1), (3, 1), (6, 4), (12, 1), (12, 25)])
def test_a_tree_is_the_librarys_tree(rows, depth, leaf):
    """Without random draws: the same nodes, leaf shares and importances."""
    data = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(M.with_label(rows)).orderBy("id").coalesce(1)
    want = RandomForestClassifier(numTrees=1, maxDepth=depth, minInstancesPerNode=leaf, featureSubsetStrategy="all", bootstrap=False, seed=1,
                                  featuresCol="features", labelCol="label").fit(data)
    got = want.transform(data).select(vector_to_array("features").alias("x"), "label", vector_to_array("probability").alias("p")).collect()
    x, y = np.array([r["x"] for r in got]), np.array([r["label"] for r in got])
    points = T.split_points(x, 32)
    bytes_ = np.column_stack([T.binned(x, points), y.astype(np.uint8), np.ones(len(y), dtype=np.uint8)])
    tree = T.grow(bytes_, 2, 32, 4, depth, leaf, np.random.default_rng(0)).pruned()
    assert len(tree.feature) == want.totalNumNodes
    assert np.abs(tree.shares()[tree.reached(bytes_[:, :4])] - np.array([r["p"] for r in got])).max() < 1e-12
    assert np.abs(tree.importance(4) - want.featureImportances.toArray()).max() < 1e-9


def test_slices_of_rows_and_nodes_make_no_difference(monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 32, (3000, 5), dtype=np.uint8)
    y = ((x[:, 0] > 15) ^ (rng.random(3000) < 0.2)).astype(np.uint8) + (x[:, 1] > 25)
    bytes_ = np.column_stack([x, y, rng.integers(1, 4, 3000, dtype=np.uint8)])
    whole = T.grow(bytes_, 3, 32, 5, 30, 1, rng)
    monkeypatch.setattr(T, "ROWS_AT_ONCE", 17)
    monkeypatch.setattr(T, "NODES_AT_ONCE", 3)
    for a, b in zip(whole.to_bytes().values(), T.grow(bytes_, 3, 32, 5, 30, 1, rng).to_bytes().values()):
        assert a == b
    counts = whole.stats[whole.feature < 0].sum(axis=0)
    assert counts.tolist() == np.bincount(y, bytes_[:, -1], 3).tolist()         # every row is in one leaf
    assert ((whole.stats > 0).sum(axis=1)[whole.feature < 0] == 1).mean() > 0.9    # grown until the classes are apart


def test_a_large_forest_is_grown_in_tasks(spark, rows):
    """Whatever the depth it takes a fixed number of Spark's jobs: no pass over the rows for a level or a group of nodes."""
    sc, jobs = spark.sparkContext, []
    for depth in (2, 15):
        sc.setJobGroup(f"depth-{depth}", "")
        model = M.fit_forest(rows, FEATURES, M.ForestConfig(num_trees=20, max_depth=depth, seed=5, **IN_TASKS))
        jobs.append(len(sc.statusTracker().getJobIdsForGroup(f"depth-{depth}")))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1]
    assert isinstance(model, T.StoredForest) and model.trees.count() == model.num_trees == 20
    p = M.parameters(model).first().asDict()
    assert p == {"num_trees": 20, "max_depth": 15, "min_leaf": 1, "seed": 5, "feature_subset": "sqrt", "impurity": "gini", "bootstrap": True,
                 "n_features": 4, "n_nodes": model.n_nodes}
    imp = {r["features"]: r["importance"] for r in M.importances(model, FEATURES).collect()}
    library = M.fit_forest(rows, FEATURES, M.ForestConfig(num_trees=20, max_depth=15, seed=5))
    assert sum(imp.values()) == pytest.approx(1.0) and imp["d"] == 0.0
    assert np.abs(np.array([imp[c] for c in FEATURES]) - library.importance).max() < 0.1
    accuracy = [EV.metrics(M.score(m, rows)).first()["accuracy"] for m in (model, library)]
    assert abs(accuracy[0] - accuracy[1]) < 0.05 and min(accuracy) > 0.8


def test_votes_are_those_of_all_trees(spark, rows, monkeypatch):
    """Row by row, whatever the ids, by whole trees; in several groups of trees and chunks of rows too."""
    model = M.fit_forest(rows, FEATURES, M.ForestConfig(num_trees=9, max_depth=6, seed=5, min_instances_per_node=2, **IN_TASKS))
    trees = [T.Tree.of_bytes(r.asDict()) for r in sorted(model.trees.collect())]
    held = rows.orderBy("id").toPandas()
    x = T.binned(held[FEATURES].to_numpy(), model.points)
    want = np.mean([t.shares()[t.reached(x)] for t in trees], axis=0)[:, 1]
    for nodes, at_once in ((10**6, 10**6), (1, 200)):
        monkeypatch.setattr(T, "NODES_A_TASK", nodes)
        monkeypatch.setattr(T, "ROWS_A_TASK", at_once)
        got = M.score(model, rows, keep=["c"]).orderBy("id").toPandas()
        assert got.columns.tolist() == ["id", "c", "label", "prediction", "churn_probability"]
        assert np.abs(got["churn_probability"] - want).max() < 1e-12 and (got["label"] == held["churn"]).all() and (got["c"] == held["c"]).all()
        assert ((got["prediction"] == (want > 0.5)) | (np.abs(want - 0.5) < 1e-9)).all()
    odd = rows.withColumn("id", F.when(F.col("id") >= 10, F.col("id") % 50))
    got = sorted(r["churn_probability"] for r in M.score(model, odd).collect())
    assert len(got) == 900 and np.abs(np.array(got) - np.sort(want)).max() < 1e-12
    assert M.score(model, rows.limit(0)).count() == 0


def test_trees_depend_on_rows_and_seed_alone(rows):
    def nodes(df, seed):
        model = M.fit_forest(df, FEATURES, M.ForestConfig(num_trees=6, max_depth=5, seed=seed, **IN_TASKS))
        return [(r["tree"], bytes(r["feature"]), bytes(r["bin"]), bytes(r["stats"])) for r in sorted(model.trees.collect())]

    first = nodes(rows, 7)
    assert first == nodes(rows.repartition(5, "b"), 7) and first != nodes(rows, 8)
    assert len({x[1:] for x in first}) == 6         # each tree has its own draws


def test_a_bootstrap_draws_rows_with_replacement(rows):
    model = M.fit_forest(rows, FEATURES, M.ForestConfig(num_trees=30, max_depth=2, seed=1, **IN_TASKS))
    weight = [T.Tree.of_bytes(r.asDict()).stats[0].sum() for r in model.trees.collect()]
    assert len(set(weight)) > 10 and abs(np.mean(weight) - 900) < 30


def test_forests_in_tasks_refuse_what_others_refuse(spark, rows):
    gaps = rows.withColumn("b", F.when(F.col("id") != 5, F.col("b")))
    for cfg in (M.ForestConfig(num_trees=3), M.ForestConfig(num_trees=3, **IN_TASKS)):
        with pytest.raises(Exception, match="null"):
            M.fit_forest(gaps, FEATURES, cfg)
    one = M.fit_forest(rows.withColumn("churn", F.lit(0)), FEATURES, M.ForestConfig(num_trees=3, **IN_TASKS))
    assert one.n_nodes == one.num_trees == 3 and {tuple(r)[2:] for r in M.score(one, rows).collect()} == {(0.0, 0.0)}


@pytest.mark.parametrize("depth, leaf, at_once", [(9, 1, 2000), (9, 12, 10**6), (1, 1, 10**6), (0, 1, 10**6)])
def test_tops_of_trees_are_grown_over_the_blocks(spark, rows, monkeypatch, depth, leaf, at_once):
    """Where a task can't hold the table: whole trees to their depth and leaf size, the same however the input was partitioned."""
    monkeypatch.setattr(T, "COUNTS_A_PASS", at_once)
    cfg = dict(num_trees=3, max_depth=depth, min_instances_per_node=leaf, seed=5, **IN_TASKS)
    split = M.fit_forest(rows, FEATURES, M.ForestConfig(bytes_per_task=6 * 150, **cfg))
    again = M.fit_forest(rows.repartition(3), FEATURES, M.ForestConfig(bytes_per_task=6 * 150, **cfg))
    trees = [[r.asDict() for r in sorted(m.trees.collect())] for m in (split, again)]
    assert trees[0] == trees[1] and [r["tree"] for r in trees[0]] == [0, 1, 2] and split.held["maxDepth"] == depth
    for r in trees[0]:
        t = T.Tree.of_bytes(r)
        inner = np.flatnonzero(t.feature >= 0)
        assert np.array_equal(t.stats[t.left[inner]] + t.stats[t.left[inner] + 1], t.stats[inner])      # no row is lost at a split
        assert abs(t.stats[0].sum() - 900) < 150 and t.stats[1:].sum(axis=1).min(initial=leaf) >= leaf
        assert len(t.feature) == 1 + 2 * len(inner) and sorted([0, *t.left[inner], *t.left[inner] + 1]) == list(range(len(t.feature)))
    assert sum(split.importance) == pytest.approx(float(depth > 0))
    if depth > 1:
        whole = M.fit_forest(rows, FEATURES, M.ForestConfig(**cfg))
        accuracy = [EV.metrics(M.score(m, rows)).first()["accuracy"] for m in (split, whole)]
        assert abs(accuracy[0] - accuracy[1]) < 0.08


@pytest.mark.parametrize("depth, leaf", [(9, 1), (30, 3), (2, 1)])
def test_tops_and_what_is_below_are_the_whole_tree(rows, monkeypatch, depth, leaf):
    """Without draws: the nodes of one task."""
    monkeypatch.setattr(T.Grower, "bag", lambda self, rows, rng: np.column_stack([rows[:, :-1], np.ones(len(rows), dtype=np.uint8)]))
    data, est = M.materialize(M.with_label(rows), "plain"), M.forest(M.ForestConfig(1, depth, leaf, feature_subset="all"))
    points = T.find_points(data, FEATURES, est, 900)
    grower, blocks = T.Grower.of(est, 4, 2), T._row_blocks(data, FEATURES, points).drop("fold")
    t = blocks.toArrow()
    want = grower.tree(T._in_place(t, 6), 0)
    tops = T._Top(0)
    held = T._in_place(t, 6)
    bag = grower.bag(held, None)
    while tops.passed:
        tree, k = tops.tree(2), len(tops.passed)
        slot = np.full(len(tree.feature), -1)
        slot[tops.passed] = np.arange(k)
        slot = slot[tree.reached(np.ascontiguousarray(bag[:, :4]))]
        drawn = np.tile(np.arange(4), (k, 1))
        sums = np.cumsum(T._histogram(bag[slot >= 0].reshape(-1), 6, slot[slot >= 0], drawn, 2, 32).reshape(2, 4, k, 32), axis=3)
        total = sums[:, 0, :, -1].T
        chosen, best, won = T._best(sums, total, leaf)
        tops.split(dict(total=total, chosen=chosen, best=best, won=won, below=sums[:, chosen, np.arange(k), best].T), drawn, grower, 100)
    top = tops.tree(2)
    at = top.reached(np.ascontiguousarray(bag[:, :4]))
    got = top.with_below({n: grower.below(bag[at == n], tops.depth[n], np.random.default_rng(0)) for n in tops.ready}).pruned()
    assert np.array_equal(got.levels, want.levels) and (depth < 3 or tops.ready)
    nodes = [sorted(zip(t.feature.tolist(), t.bin.tolist(), t.stats.tolist(), t.gain.round(9).tolist())) for t in (got, want)]
    assert nodes[0] == nodes[1]         # in another order within a level
    assert np.array_equal(got.stats[got.reached(held[:, :4])], want.stats[want.reached(held[:, :4])])


def test_subset_sizes():
    assert [T.subset_size(s, 23, 100) for s in ("sqrt", "auto", "all", "log2", "onethird", "7", "0.5")] == [5, 5, 23, 5, 8, 7, 12]
    assert T.subset_size("auto", 23, 1) == 23


@pytest.mark.parametrize("depth", [0, 1, 2, 4, 7])
def test_a_cut_tree_is_one_grown_to_that_depth(depth):
    """Without draws: the same leaf shares for each row, and the same leaves."""
    rng = np.random.default_rng(4)
    x = rng.integers(0, 32, (1500, 4), dtype=np.uint8)
    bytes_ = np.column_stack([x, ((x[:, 0] > 15) ^ (rng.random(1500) < 0.3)).astype(np.uint8), rng.integers(1, 3, 1500, dtype=np.uint8)])
    deep, small = (T.grow(bytes_, 2, 32, 4, d, 1, rng).pruned() for d in (12, depth))
    at = deep.ends(depth)[deep.reached(x)]
    assert np.array_equal(deep.shares()[at], small.shares()[small.reached(x)]) and len(set(at)) == (small.feature < 0).sum()


def test_a_large_grid_is_scored_in_tasks(spark, rows, monkeypatch):
    """The accuracies are those of forests grown on the other folds with the same trees, whatever rows are counted at once."""
    grid = dict(num_trees=(6, 3), max_depth=(5, 2), min_leaf=(1, 40), folds=3, seed=9, cfg=M.ForestConfig(**IN_TASKS))
    found = M.grid_search(rows, FEATURES, **grid)
    table = [tuple(r) for r in found.table.collect()]
    assert [r[:3] for r in table] == [(n, d, leaf) for n in (3, 6) for d in (2, 5) for leaf in (1, 40)] and sum(r[4] for r in table) == 1
    monkeypatch.setattr(T, "FOLD_ROWS_A_TASK", 70)
    assert [tuple(r) for r in M.grid_search(rows, FEATURES, **grid).table.collect()] == table
    p = M.parameters(found.model).first()
    assert (p["num_trees"], p["max_depth"], p["min_leaf"]) == next(r[:3] for r in table if r[4]) and isinstance(found.model, T.StoredForest)

    data = M.materialize(M.in_fixed_order(M.with_folds(M.with_label(rows), 3)), "folds")
    held = data.toPandas()
    for n, d, leaf, accuracy, _ in table:
        each = []
        for fold in range(3):
            est = M.forest(M.ForestConfig(num_trees=6, max_depth=5, min_instances_per_node=leaf, seed=9))
            model = T.StoredForest.fit(M.materialize(M.in_fixed_order(data.where(F.col("fold") != fold)), "train"), FEATURES, est, 600, 2, 600)
            trees = [T.Tree.of_bytes(r.asDict()) for r in sorted(model.trees.collect())][:n]
            own = held[held["fold"] == fold]
            x = T.binned(own[FEATURES].to_numpy(), model.points)
            if d == 5:
                votes = sum(t.shares()[t.reached(x)] for t in trees)
                each.append((votes.argmax(axis=1) == own["label"]).mean())
        if each:
            assert accuracy == pytest.approx(np.mean(each))
    small = M.grid_search(rows, FEATURES, **{**grid, "cfg": M.ForestConfig()}).table.collect()
    assert max(abs(a[3] - b[3]) for a, b in zip(table, small)) < 0.12
