"""Model selection, training and scoring with ``pyspark.ml``.

* The split takes the rows of smallest md5 hash of the id, exactly as many as
  the share asks for (``randomSplit`` depends on partitioning; this one does
  not and has an SQL twin). A cheaper split by hash bucket is there too.
* Folds for cross validation are dealt within each label by row number;
  numbers come from ranges, so no window sees a whole label.
* The input is written to the checkpoint folder before iterative fitting,
  cutting the lineage back to the raw price history.
* ``pyspark.ml`` grows a forest's nodes in the driver, so a large forest is
  fitted and scored in stored parts of some trees each (``Forest``). Where rows
  times trees are many, tasks grow whole trees instead (``trees.StoredForest``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from fractions import Fraction
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retention.functions.scalars import hash_bucket, hash_long
from retention.operators.forests import CutForest
from retention.operators.ranks import numbered, smallest_bound
from retention.operators.trees import StoredForest, fold_hits
from retention.session import checkpoint_dir, materialize, stored_path

# Spark caps tree depth at 30; an unbounded depth request maps onto it.
MAX_DEPTH = 30


def with_split(df: DataFrame, test_share: float, seed: int = 42, key: str = "id") -> DataFrame:
    """M1: add ``split`` = 'test' for md5 buckets below test_share * 10000, else 'train'."""
    b = hash_bucket(F.col(key), seed)
    return df.withColumn("split", F.when(b < F.lit(int(round(test_share * 10000))), F.lit("test"))
                         .otherwise(F.lit("train")))


def with_exact_split(df: DataFrame, test_share: float, seed: int = 42, key: str = "id") -> DataFrame:
    """M1: add ``split``: 'test' for the ceil(test_share * rows) rows of smallest hash of the id, ties by id, else 'train'.

    Ids are unique and not null. The bound is found by counting hash ranges (two
    or three aggregations of the id column); the split itself is one
    comparison per row, so it goes with any plan.
    """
    rows = df.select(key)
    # the share as written: 0.07 * 100 is a little above 7 in binary
    bound = smallest_bound(rows, math.ceil(Fraction(str(test_share)) * rows.count()), key, seed)
    if bound is None:
        return df.withColumn("split", F.lit("train"))
    h = hash_long(key, seed)
    inside = (h < F.lit(bound[0])) | ((h == F.lit(bound[0])) & (F.col(key) <= F.lit(bound[1])))
    return df.withColumn("split", F.when(inside, F.lit("test")).otherwise(F.lit("train")))


def split(df: DataFrame, test_share: float, seed: int = 42, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """(train, test) by ``with_exact_split``."""
    s = with_exact_split(df, test_share, seed, key)
    return (s.filter(F.col("split") == "train").drop("split"),
            s.filter(F.col("split") == "test").drop("split"))


def feature_columns(df: DataFrame, label: str = "churn", exclude=("id",)) -> list[str]:
    """Every column but the label, the excluded ones (the id) and text, date or other
    columns without a number (such as a file's further columns). Vectors (sparse encodings) count."""
    return [f.name for f in df.schema.fields if f.name != label and f.name not in exclude and f.name != "split"
            and isinstance(f.dataType, (T.NumericType, T.BooleanType, VectorUDT))]


def feature_names(df: DataFrame, features: list[str]) -> list[str]:
    """The names of the assembled entries: a vector column has one per entry, from its metadata."""
    out = []
    for c in features:
        field = df.schema[c]
        if isinstance(field.dataType, VectorUDT):
            entries = sorted((a["idx"], a["name"]) for of in field.metadata["ml_attr"]["attrs"].values() for a in of)
            out += [f"{c}_{name}" for _, name in entries]
        else:
            out.append(c)
    return out


def with_label(df: DataFrame, label: str = "churn") -> DataFrame:
    return df.withColumn("label", F.col(label).cast("double"))


@dataclass
class ForestConfig:
    num_trees: int = 100
    max_depth: int = MAX_DEPTH
    min_instances_per_node: int = 1
    seed: int = 42
    feature_subset: str = "sqrt"
    max_bins: int = 32
    # memory for node statistics per pass and task: more nodes split per pass
    # over the data means fewer passes for deep trees
    max_memory_mb: int = 64
    # nodes that the driver grows in one fit, about; the trees of a larger forest come in several fits
    nodes_per_fit: int = 200_000
    # rows times trees of one fit: for each the executors hold a bootstrap count and node ids
    counts_per_fit: int = 30_000_000
    # rows times trees over which tasks grow the trees, and the bytes (one for each row and feature) that such a task holds
    counts_for_tasks: int = 4_000_000
    bytes_per_task: int = 48_000_000


# Seeds of a forest's parts lie apart: ``pyspark.ml`` adds the partition's number to them.
SEED_STEP = 1_000_003


def in_fixed_order(df: DataFrame, key: str = "id") -> DataFrame:
    """Rows by hash of the id, sorted inside each partition: bootstrap samples
    are drawn per partition and row, so one seed then gives one forest however
    the input was partitioned (for a given ``spark.sql.shuffle.partitions``)."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, key).sortWithinPartitions(key)


def forest(cfg: ForestConfig) -> RandomForestClassifier:
    """M2-M4 estimator: random forest (gini, bootstrap, sqrt features)."""
    return RandomForestClassifier(
        featuresCol="features", labelCol="label", numTrees=cfg.num_trees,
        maxDepth=min(cfg.max_depth, MAX_DEPTH), minInstancesPerNode=cfg.min_instances_per_node,
        featureSubsetStrategy=cfg.feature_subset, maxBins=cfg.max_bins, seed=cfg.seed,
        impurity="gini", bootstrap=True, cacheNodeIds=True, checkpointInterval=10,
        maxMemoryInMB=cfg.max_memory_mb)


def forest_pipeline(features: list[str], cfg: ForestConfig) -> Pipeline:
    """The assembler of the feature columns and the forest."""
    assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error")
    return Pipeline(stages=[assembler, forest(cfg)])


@dataclass
class Forest:
    """A fitted forest: a model, or the paths of several, each with some of the trees, of which the driver holds one at a time."""

    parts: list[PipelineModel | str]
    #: as ``pyspark.ml`` gives it for all trees: each tree's importances sum to 1, and so do the forest's
    importance: list[float]
    num_trees: int
    n_nodes: int
    n_features: int
    #: parameters as the first fitted model holds them
    held: dict

    def models(self) -> Iterator[PipelineModel]:
        return (PipelineModel.load(p) if isinstance(p, str) else p for p in self.parts)

    @property
    def stages(self) -> list:
        """The assembler and the model of a forest that is one fit."""
        only, = self.models()
        return only.stages


def _as_forest(model: Forest | StoredForest | PipelineModel) -> Forest | StoredForest:
    """A fitted pipeline is a forest of one part."""
    if isinstance(model, (Forest, StoredForest)):
        return model
    rf = model.stages[-1]
    return Forest([model], rf.featureImportances.toArray().tolist(), rf.getNumTrees, rf.totalNumNodes, rf.numFeatures, {})


def in_tasks(data: DataFrame, features: list[str], cfg: ForestConfig, n_rows: int) -> bool:
    """Whether a forest's trees are grown in tasks: many of them, and plain numbers as features, of which the driver holds a sample."""
    plain = len(features) <= 1000 and all(isinstance(data.schema[c].dataType, (T.NumericType, T.BooleanType)) for c in features)
    return n_rows * cfg.num_trees > cfg.counts_for_tasks and plain and cfg.max_bins <= 256


def rows_per_task(features: list[str], cfg: ForestConfig) -> int:
    return cfg.bytes_per_task // (len(features) + 2)


def fit_forest(train: DataFrame, features: list[str], cfg: ForestConfig = ForestConfig(),
               label: str = "churn", cut_lineage: bool = True) -> Forest | StoredForest:
    """M2-M4: all ``cfg.num_trees`` trees, in fits of about ``cfg.nodes_per_fit`` nodes
    and at most ``cfg.counts_per_fit`` rows times trees each (a fit has one tree at least).

    A tree has fewer than two nodes a row, mostly far fewer: the first fit takes
    as many trees as there may be at one node for two rows, the others as many
    as the trees seen so far allow. Trees of a random forest are drawn
    independently, so the parts together are a forest; each has its own seed.

    A forest of more than ``cfg.counts_for_tasks`` rows times trees is grown by
    tasks, each with the table as bytes, or with a node's rows where that has more than
    ``cfg.bytes_per_task``.
    """
    data = with_label(train, label)
    spark = data.sparkSession
    checkpoint_dir(spark)  # node-id cache checkpoints need a shared folder
    if cut_lineage:
        data = materialize(in_fixed_order(data.select("id", "label", *features)), "forest-train")
    n_rows = max(data.count(), 1)
    if cut_lineage and in_tasks(data, features, cfg, n_rows):
        n_classes = int(data.agg(F.max("label")).first()[0]) + 1
        return StoredForest.fit(data, features, forest(cfg), n_rows, n_classes, rows_per_task(features, cfg))
    parts, n_trees, n_nodes, most = [], 0, 0, max(n_rows // 2, 1)
    total, grown, held = 0.0, 0, {}
    while left := cfg.num_trees - n_trees:
        at_once = max(1, min(cfg.nodes_per_fit // most, cfg.counts_per_fit // n_rows))
        n = math.ceil(left / math.ceil(left / at_once)) if parts else min(left, at_once)
        model = forest_pipeline(features, replace(cfg, num_trees=n, seed=cfg.seed + len(parts) * SEED_STEP)).fit(data)
        rf = model.stages[-1]
        held = held or {k: rf.getOrDefault(k) for k in ("maxDepth", "minInstancesPerNode", "seed", "featureSubsetStrategy", "impurity", "bootstrap")}
        # a tree that is one leaf has no importances
        split = 1 if n == cfg.num_trees else sum(tree.depth > 0 for tree in rf.trees)
        total, grown = total + rf.featureImportances.toArray() * split, grown + split
        n_trees, n_nodes = n_trees + rf.getNumTrees, n_nodes + rf.totalNumNodes
        each = math.ceil(rf.totalNumNodes / n)
        most = max(most, each) if parts else each
        if n == cfg.num_trees:
            parts.append(model)
        else:
            parts.append(stored_path(spark, "forest-part"))
            model.write().save(parts[-1])
    return Forest(parts, (total / max(grown, 1)).tolist(), n_trees, n_nodes, rf.numFeatures, held)


def score(model: Forest | StoredForest | PipelineModel, df: DataFrame, label: str = "churn", key: str = "id", keep=()) -> DataFrame:
    """M5 + M6 + S5 rows: id, the columns ``keep``, label, prediction, probability of class 1
    (0 where the training rows held class 0 alone). The votes of the forest's parts are
    added up row by row, part after part."""
    model, rows = _as_forest(model), with_label(df, label)
    if isinstance(model, StoredForest):
        names = dict.fromkeys([key, *keep, "label", *model.features])
        rows = materialize(rows.select(*[F.col(f"`{c}`") for c in names], F.monotonically_increasing_id().alias("_row")), "forest-rows")
        rows = rows.join(model.votes(rows, rows.count()), "_row")
    for k, part in enumerate([] if isinstance(model, StoredForest) else model.models()):
        votes = vector_to_array("rawPrediction")
        inputs = part.stages[0].getInputCols()
        out = part.transform(rows).withColumn("_votes", F.zip_with("_votes", votes, lambda a, b: a + b) if k else votes)
        rows = out.select(*[F.col(f"`{c}`") for c in dict.fromkeys([key, *keep, "label", *inputs, "_votes"])])
        if k < len(model.parts) - 1:
            rows = materialize(rows, "forest-votes")
    every = F.aggregate("_votes", F.lit(0.0), lambda a, b: a + b)
    return rows.select(F.col(key), *[F.col(f"`{c}`") for c in keep], F.col("label"),
                       (F.array_position("_votes", F.array_max("_votes")) - 1).cast("double").alias("prediction"),
                       F.coalesce(F.try_divide(F.get("_votes", F.lit(1)), every), F.lit(0.0)).alias("churn_probability"))


def importances(model: Forest | StoredForest | PipelineModel, features: list[str]) -> DataFrame:
    """M9 (+ O2): (features, importance) sorted ascending, impurity based, sums to 1.
    The table has one row per feature (``feature_names``), built from the fitted model's vector."""
    session = SparkSession.getActiveSession()
    rows = [(name, float(v)) for name, v in zip(features, _as_forest(model).importance)]
    return session.createDataFrame(rows, "features string, importance double").orderBy("importance", "features")


def parameters(model: Forest | StoredForest) -> DataFrame:
    """The parameters that the fitted forest holds, one row."""
    p = model.held
    return SparkSession.getActiveSession().createDataFrame(
        [(model.num_trees, p["maxDepth"], p["minInstancesPerNode"], p["seed"], p["featureSubsetStrategy"], p["impurity"], p["bootstrap"],
          model.n_features, model.n_nodes)],
        "num_trees int, max_depth int, min_leaf int, seed long, feature_subset string, impurity string, bootstrap boolean, n_features int, "
        "n_nodes long")


def with_folds(df: DataFrame, k: int = 5, label: str = "churn", key: str = "id") -> DataFrame:
    """``fold`` for cross validation, dealt within each label by id: fold sizes per label differ by one at most."""
    rows = numbered(df, [key], [label], "_number")
    return rows.withColumn("fold", F.pmod("_number", F.lit(k)).cast("int")).drop("_number")


@dataclass
class GridResult:
    """M10 + M11: the fitted best model, its setting and the table of all settings."""

    model: Forest
    best: dict
    table: DataFrame


def _grid_fits(folded: DataFrame, features: list[str], largest: list[ForestConfig], folds: int, trees: list[int], depths: list[int],
               parallelism: int | None) -> list[tuple]:
    """(trees, depth, leaf size, accuracy) of each setting and fold, by fits of ``pyspark.ml``."""
    spark = folded.sparkSession
    assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error")
    # one table of vectors for all fits, with the rows of a seed's bootstrap in a fixed order
    data = materialize(in_fixed_order(assembler.transform(folded).select("id", "label", "fold", "features")), "forest-cv")

    def accuracies(job: tuple[ForestConfig, int]) -> list[tuple]:
        cfg, fold = job
        grown = forest(cfg).fit(data.where(F.col("fold") != fold))
        return [(n, d, cfg.min_instances_per_node, acc)
                for (n, d), acc in CutForest.of(grown, spark).accuracies(data.where(F.col("fold") == fold), trees, depths).items()]

    jobs = [(cfg, fold) for cfg in largest for fold in range(folds)]
    pool = ThreadPool(min(len(jobs), parallelism or max(1, spark.sparkContext.defaultParallelism // 2)))
    try:
        return [row for rows in pool.map(inheritable_thread_target(spark)(accuracies), jobs) for row in rows]
    finally:
        pool.close()


def grid_search(train: DataFrame, features: list[str], num_trees=(100, 200, 300), max_depth=(MAX_DEPTH, 10, 20, 30),
                min_leaf=(1, 2, 4), folds: int = 5, seed: int = 42, parallelism: int | None = None,
                label: str = "churn", cfg: ForestConfig = ForestConfig()) -> GridResult:
    """M10 + M11: grid over trees x depth x leaf size, stratified folds, accuracy; the best setting fitted on all rows.

    One forest per fold and leaf size is grown, with the most trees and the
    greatest depth. The first n of its trees are a forest of n trees, and its
    trees cut at a depth are trees grown to that depth (``forests.CutForest``),
    so all settings of the other two parameters are scored from it in one
    pass over the fold. Ties go to the setting that comes first. Where the
    forests are large (``in_tasks``) and a task can hold the table, tasks grow their trees and score the fold.

    sklearn's ``min_samples_split`` has no Spark parameter and is left out;
    depth "None" collapses onto 30 (duplicates are removed).
    """
    spark = train.sparkSession
    checkpoint_dir(spark)   # node-id cache checkpoints need a shared folder
    folded = with_folds(with_label(train.select("id", label, *features), label), folds, label)
    depths = sorted({min(d, MAX_DEPTH) for d in max_depth})
    trees, leaves = sorted(set(num_trees)), sorted(set(min_leaf))
    largest = [replace(cfg, num_trees=max(trees), max_depth=max(depths), min_instances_per_node=leaf, seed=seed) for leaf in leaves]
    n_rows = train.count()
    total: dict[tuple, float] = {}
    if folds > 1 and in_tasks(train, features, largest[0], n_rows) and n_rows <= rows_per_task(features, cfg):
        data = materialize(in_fixed_order(folded.select("id", "label", "fold", *features)), "forest-cv")
        n_classes = int(data.agg(F.max("label")).first()[0]) + 1
        found = fold_hits(data, features, [forest(c) for c in largest], folds, trees, depths, n_rows, n_classes)
        for (n, d, leaf, _), acc in sorted(found.items()):
            total[n, d, leaf] = total.get((n, d, leaf), 0.0) + acc
    else:
        for n, d, leaf, acc in _grid_fits(folded, features, largest, folds, trees, depths, parallelism):
            total[n, d, leaf] = total.get((n, d, leaf), 0.0) + acc
    settings = [(n, d, leaf, total[n, d, leaf] / folds) for n in trees for d in depths for leaf in leaves]
    best = max(settings, key=lambda s: s[3])
    n, d, leaf, _ = best
    model = fit_forest(train, features, replace(cfg, num_trees=n, max_depth=d, min_instances_per_node=leaf, seed=seed), label)
    table = spark.createDataFrame([(*s, s is best) for s in settings],
                                  "num_trees int, max_depth int, min_leaf int, accuracy double, is_best boolean")
    return GridResult(model, {"num_trees": n, "max_depth": d, "min_leaf": leaf, "accuracy": best[3]}, table)
