"""Random forests whose trees are grown in tasks, for tables that ``pyspark.ml`` takes too long for.

The method is that of ``pyspark.ml``: at most ``maxBins`` quantile bins a
feature, a Poisson bootstrap a tree, a random subset of the features a node,
the split of largest Gini gain, leaves of one parent that predict the same
class merged. ``pyspark.ml`` passes over the table for each group of
nodes, and each partition sends a histogram of each node. Here a row's features are
a byte each, a task gets the table of bytes and grows whole trees from it, all
nodes of a level at once; the nodes are stored by the tasks, the driver never
holds them. Of a table too large for that, passes over its blocks grow the top of
each tree until a task can hold a node's rows, and tasks grow what is below.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retention.session import materialize, stored_path

#: a gain below is rounding: the smallest real one is about one over the square of the rows
NO_GAIN = 1e-14
# Rows and nodes worked on at once: their histograms stay in a core's cache.
ROWS_AT_ONCE, NODES_AT_ONCE = 16_384, 256
# Nodes and rows of a scoring task; rows whose votes a grid's fold counts at once.
NODES_A_TASK, ROWS_A_TASK, FOLD_ROWS_A_TASK = 1_000_000, 262_144, 65_536
# Rows times trees of a growing task: its trees' nodes are fewer than that, mostly far fewer.
COUNTS_A_TASK = 8_000_000
# Rows times trees whose tops are grown together; below them each row in a tree's bootstrap is shuffled once.
COUNTS_A_PASS = 60_000_000


def subset_size(strategy: str, n_features: int, n_trees: int) -> int:
    """Features tried at a node, as ``pyspark.ml`` reads ``featureSubsetStrategy``."""
    if strategy == "auto":
        strategy = "all" if n_trees == 1 else "sqrt"
    named = {"all": n_features, "sqrt": math.ceil(math.sqrt(n_features)), "log2": max(1, math.ceil(math.log2(n_features))),
             "onethird": math.ceil(n_features / 3)}
    if strategy in named:
        return named[strategy]
    return min(int(strategy), n_features) if strategy.isdigit() else math.ceil(float(strategy) * n_features)


def split_points(sample: np.ndarray, max_bins: int) -> list[np.ndarray]:
    """Candidate thresholds of each column: all midpoints of a column of few values, else midpoints at quantiles."""
    out = []
    for x in sample.T:
        values, counts = np.unique(x, return_counts=True)
        middles = (values[:-1] + values[1:]) / 2
        if len(middles) >= max_bins:
            stride, target, at, below = len(x) / max_bins, len(x) / max_bins, [], np.cumsum(counts)
            for i in range(1, len(values)):
                if abs(below[i - 1] - target) < abs(below[i] - target):
                    at.append(i - 1)
                    target += stride
            middles = middles[at[:max_bins - 1]]
        out.append(middles)
    return out


def binned(x: np.ndarray, points: list[np.ndarray]) -> np.ndarray:
    """The number of thresholds below each value."""
    out = np.empty(x.shape, dtype=np.uint8)
    for k, p in enumerate(points):
        out[:, k] = np.searchsorted(p, x[:, k])
    return out


@dataclass
class Tree:
    """Nodes in order of depth, children side by side: a row goes to ``left``, or one on if its bin is above ``bin``."""

    feature: np.ndarray     # -1 in a leaf
    bin: np.ndarray
    left: np.ndarray
    stats: np.ndarray       # weight of each class
    gain: np.ndarray
    levels: np.ndarray      # the first node of each depth, and the number of nodes

    def leaves(self, depth: int) -> np.ndarray:
        """Which nodes end the tree when it is cut at ``depth``; leaves of one parent that predict the same class are merged."""
        leaf = self.feature < 0
        leaf[self.levels[min(depth, len(self.levels) - 1)]:] = True
        says = self.stats.argmax(axis=1)
        for a, b in zip(self.levels[-2::-1], self.levels[:0:-1]):
            at = a + np.flatnonzero(~leaf[a:b])
            to = self.left[at]
            leaf[at[leaf[to] & leaf[to + 1] & (says[to] == says[to + 1])]] = True
        return leaf

    def pruned(self) -> Tree:
        """Without the nodes below merged leaves."""
        leaf = self.leaves(len(self.levels))
        kept = np.zeros(len(leaf), dtype=bool)
        kept[0] = True
        for a, b in zip(self.levels[:-1], self.levels[1:]):
            at = a + np.flatnonzero(kept[a:b] & ~leaf[a:b])
            kept[self.left[at]] = kept[self.left[at] + 1] = True
        number = np.append(0, np.cumsum(kept))
        levels = np.unique(number[self.levels])
        inner = ~leaf[kept]
        return Tree(np.where(inner, self.feature[kept], -1), self.bin[kept], np.where(inner, number[self.left[kept]], 0), self.stats[kept],
                    np.where(inner, self.gain[kept], 0.0), levels)

    def importance(self, n_features: int) -> np.ndarray:
        """Gains by feature, weighted by the nodes' rows; 1 in sum, or zeros of a single leaf."""
        inner = self.feature >= 0
        total = np.bincount(self.feature[inner], self.gain[inner] * self.stats[inner].sum(axis=1), n_features)
        return total / total.sum() if total.sum() > 0 else total

    def reached(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row of bins."""
        flat, width = x.ravel(), x.shape[1]
        at, live = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
        while True:
            node = at[live]
            f = self.feature[node]
            inner = f >= 0
            if not inner.all():
                live, node, f = live[inner], node[inner], f[inner]
            if not len(live):
                return at
            at[live] = self.left[node] + (flat[live * width + f] > self.bin[node])

    def ends(self, depth: int) -> np.ndarray:
        """For each node the leaf that its rows are in when the tree is cut at ``depth``."""
        leaf, end = self.leaves(depth), np.arange(len(self.feature))
        for a, b in zip(self.levels[:-1], self.levels[1:]):
            at = a + np.flatnonzero(self.feature[a:b] >= 0)
            cut = at[leaf[at] | (end[at] != at)]
            end[self.left[cut]] = end[self.left[cut] + 1] = end[cut]
        return end

    def shares(self) -> np.ndarray:
        total = self.stats.sum(axis=1, keepdims=True)
        return np.divide(self.stats, total, out=np.zeros_like(self.stats), where=total > 0)

    def to_bytes(self) -> dict:
        return {"feature": self.feature.astype("<i2").tobytes(), "bin": self.bin.astype("u1").tobytes(), "left": self.left.astype("<i4").tobytes(),
                "stats": self.stats.astype("<f8").tobytes()}

    def with_below(self, below: dict[int, Tree]) -> Tree:
        """With trees in place of some leaves, by the leaf's number."""
        depth = [np.repeat(np.arange(len(self.levels) - 1), np.diff(self.levels))]
        columns, n = [[c.copy()] for c in (self.feature, self.bin, self.left, self.stats, self.gain)], len(self.feature)
        for at, tree in below.items():
            left = np.where(tree.feature >= 0, tree.left + (n - 1), 0)      # its root is the leaf, the others come last
            for out, c in zip(columns, (tree.feature, tree.bin, left, tree.stats, tree.gain)):
                out[0][at] = c[0]
                out.append(c[1:])
            depth.append(depth[0][at] + np.repeat(np.arange(len(tree.levels) - 1), np.diff(tree.levels))[1:])
            n += len(tree.feature) - 1
        depth = np.concatenate(depth)
        order = depth.argsort(kind="stable")        # children stay side by side
        number = np.empty(n, dtype=np.int64)
        number[order] = np.arange(n)
        feature, bin_, left, stats, gain = (np.concatenate(c)[order] for c in columns)
        return Tree(feature, bin_, np.where(feature >= 0, number[left], 0), stats, gain, np.append(0, np.cumsum(np.bincount(depth))))

    @classmethod
    def of_bytes(cls, row: dict) -> Tree:
        feature, left = np.frombuffer(row["feature"], "<i2").astype(np.int64), np.frombuffer(row["left"], "<i4").astype(np.int64)
        return cls(feature, np.frombuffer(row["bin"], "u1"), left, np.frombuffer(row["stats"], "<f8").reshape(len(feature), -1),
                   np.zeros(0), np.zeros(0, dtype=np.int64))


def grow(rows: np.ndarray, n_classes: int, n_bins: int, tried: int, max_depth: int, min_leaf: int, rng: np.random.Generator) -> Tree:
    """One tree on rows of bytes: a bin for each feature, then the class and the weight. ``tried`` features are drawn for each node.

    The rows of open nodes lie side by side, so each level is a few passes over
    slices of them: class histograms of the drawn features of all
    nodes of a slice, the best split of each, and the rows dealt to the children.
    """
    n_features, width, least = rows.shape[1] - 2, rows.shape[1], max(min_leaf, 1)
    here = np.bincount(rows[:, -2], rows[:, -1], n_classes)[None]       # weight of each class in the nodes of the level
    is_open = _splits(here, least)
    rows, sizes = np.ascontiguousarray(rows).reshape(-1), np.array([len(rows)])      # sizes: rows of the open nodes
    features, bins, lefts, stats, gains, levels, n_nodes = [], [], [], [here], [], [0], 1
    for depth in range(max_depth + 1):
        levels.append(n_nodes)
        feature, bin_, left, gain = (np.full(len(here), v, dtype=t) for v, t in ((-1, np.int64), (0, np.uint8), (0, np.int64), (0, float)))
        features.append(feature), bins.append(bin_), lefts.append(left), gains.append(gain)
        if depth == max_depth or not is_open.any():
            break
        nodes = np.flatnonzero(is_open)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        slices = np.flatnonzero(np.diff(starts // ROWS_AT_ONCE + np.arange(len(nodes)) // NODES_AT_ONCE, prepend=-1))
        children, opened, kept, kept_sizes = [], [], [], []
        for a, b in zip(slices, np.append(slices[1:], len(nodes))):
            k, own, flat, n = b - a, nodes[a:b], rows[starts[a] * width:ends[b - 1] * width], ends[b - 1] - starts[a]
            total = here[own]
            drawn = _drawn(rng, k, n_features, tried)
            slot, sums = np.repeat(np.arange(k), sizes[a:b]), np.zeros(n_classes * tried * k * n_bins)
            for i in range(0, n, ROWS_AT_ONCE):
                of = slot[i:i + ROWS_AT_ONCE]
                sums += _histogram(flat[i * width:(i + len(of)) * width], width, of, drawn, n_classes, n_bins)
            sums = np.cumsum(sums.reshape(n_classes, tried, k, n_bins), axis=3)
            chosen, best, won = _best(sums, total, least)
            split = np.flatnonzero(won > NO_GAIN)
            if not len(split):
                continue
            chosen = chosen[split]
            f, at = drawn[split, chosen], best[split]
            feature[own[split]], bin_[own[split]], gain[own[split]] = f, at, won[split]
            left[own[split]] = n_nodes + np.arange(0, 2 * len(split), 2)
            n_nodes += 2 * len(split)
            below = np.empty((2 * len(split), n_classes))
            below[::2] = sums[:, chosen, split, at].T
            below[1::2] = total[split] - below[::2]
            goes_on = _splits(below, least) & (depth + 1 < max_depth)
            children.append(below), opened.append(goes_on)
            if not goes_on.any():
                continue
            child, f_of, bin_of = np.full(k, len(goes_on)), np.zeros(k, dtype=np.int64), np.zeros(k, dtype=np.uint8)
            child[split], f_of[split], bin_of[split] = np.arange(0, 2 * len(split), 2), f, at
            to = np.repeat(child, sizes[a:b]) + (flat.take(np.arange(0, n * width, width) + np.repeat(f_of, sizes[a:b])) > np.repeat(bin_of, sizes[a:b]))
            live = np.flatnonzero(np.append(goes_on, [False, False])[to])
            to = to[live].astype(np.int16)      # at most two children a node: sorted by radix
            kept.append(flat.view(f"V{width}").take(live[to.argsort(kind="stable")]).view(np.uint8))
            kept_sizes.append(np.bincount(to, minlength=len(goes_on))[goes_on])
        if not children:
            break
        here, is_open = np.concatenate(children), np.concatenate(opened)
        stats.append(here)
        rows, sizes = (np.concatenate(kept), np.concatenate(kept_sizes)) if kept else (rows[:0], sizes[:0])
    return Tree(*(np.concatenate(c) for c in (features, bins, lefts, stats, gains)), np.array(levels))


def _histogram(flat: np.ndarray, width: int, slot: np.ndarray, drawn: np.ndarray, n_classes: int, n_bins: int) -> np.ndarray:
    """Weights by class, drawn feature, node and bin, of rows of bytes one after another, each in the node ``slot``."""
    (k, tried), first = drawn.shape, np.arange(0, len(flat), width)
    weight = flat.take(first + (width - 1)).astype(float)
    cell = flat.take(first + drawn.T.take(slot, axis=1)) + (np.arange(0, tried * k * n_bins, k * n_bins)[:, None] + (
        slot * n_bins + flat.take(first + (width - 2)).astype(np.int64) * (tried * k * n_bins)))
    return np.bincount(cell.ravel(), np.tile(weight, tried), n_classes * tried * k * n_bins)


def _best(sums: np.ndarray, total: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each node the drawn feature (by its place) and bin to split at, and the gain, from weights up to each bin."""
    worth, allowed = 0.0, True
    for side in (sums, total.T[:, None, :, None] - sums):
        n_side = side.sum(axis=0)
        allowed = allowed & (n_side >= least)
        part = np.einsum("cjkb,cjkb->jkb", side, side)
        np.divide(part, n_side, out=part, where=n_side > 0)
        worth = worth + part
    worth = np.where(allowed, worth, -1.0)
    by_feature = worth.argmax(axis=2)
    best = np.take_along_axis(worth, by_feature[:, :, None], axis=2)[:, :, 0]
    chosen, k = best.argmax(axis=0), np.arange(len(total))
    n_here = total.sum(axis=1)
    return chosen, by_feature[chosen, k], (best[chosen, k] - (total * total).sum(axis=1) / n_here) / n_here


def _drawn(rng: np.random.Generator, k: int, n_features: int, tried: int) -> np.ndarray:
    """``tried`` features for each of ``k`` nodes."""
    return rng.random((k, n_features)).argpartition(tried - 1, axis=1)[:, :tried] if tried < n_features else np.tile(np.arange(tried), (k, 1))


def _splits(stats: np.ndarray, min_leaf: int) -> np.ndarray:
    """Nodes of more than one class with weight for two leaves."""
    return ((stats > 0).sum(axis=1) > 1) & (stats.sum(axis=1) >= 2 * max(min_leaf, 1))


# ---------------------------------------------------------------- in Spark
def find_points(data: DataFrame, features: list[str], est: RandomForestClassifier, n_rows: int, folds: int = 0) -> list[list[np.ndarray]]:
    """The features' candidate thresholds, from a sample as large as ``pyspark.ml`` takes for them; with ``folds``
    for each fold from rows that it leaves to training."""
    bins = min(est.getMaxBins(), n_rows)
    share = max(est.getMaxBins() ** 2, 10_000) / n_rows * (folds / (folds - 1) if folds else 1)
    rows = _assembled(data, features).select("x", *(["fold"] if folds else []))
    found = (rows.sample(False, share, est.getSeed()) if share < 1 else rows).toArrow().combine_chunks()
    x, fold = _matrix(found.column("x").combine_chunks(), len(features)), np.asarray(found.column("fold")) if folds else None
    return [split_points(x[fold != k] if folds else x, bins) for k in range(max(folds, 1))]


def _assembled(data: DataFrame, features: list[str]) -> DataFrame:
    """With the features as an array ``x``; a NULL among them is an error."""
    out = VectorAssembler(inputCols=features, outputCol="_features", handleInvalid="error").transform(data)
    return out.withColumn("x", vector_to_array("_features")).drop("_features")


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    return np.asarray(lists.flatten(), dtype=float).reshape(-1, width)


def _joined(column: pa.ChunkedArray, dtype: str, width: int | None = None) -> np.ndarray:
    out = np.frombuffer(b"".join(column.to_pylist()), dtype)
    return out.reshape(-1, width) if width else out


def _row_blocks(data: DataFrame, features: list[str], points: list[list[np.ndarray]]) -> DataFrame:
    """Blocks of the rows of a stored table: each row's bins, class and one more byte, and its place in the table's files.
    With the thresholds of several folds there are blocks for each ``fold``; the byte is 1 in rows that the fold holds out."""
    place = F.expr("cast(regexp_extract(_metadata.file_name, 'part-([0-9]+)', 1) as long) * 8589934592 + _metadata.row_index")
    rows = data.select("label", (F.col("fold") if len(points) > 1 else F.lit(-1)).alias("_fold"), place.alias("_place"), *[f"`{c}`" for c in features])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            label = np.asarray(b.column("label").to_numpy(zero_copy_only=False), dtype=float)
            if not ((label >= 0) & (label < 256) & (label == np.floor(label))).all():
                raise ValueError("labels must be whole numbers from 0")
            x, place, own = _matrix(b.column("x"), len(features)), np.asarray(b.column("_place")).tobytes(), np.asarray(b.column("_fold"))
            for fold, p in enumerate(points):
                block = np.column_stack([binned(x, p), np.column_stack([label, own == fold]).astype(np.uint8)])
                yield pa.RecordBatch.from_arrays([pa.array([fold], pa.int32()), pa.array([place], pa.binary()), pa.array([block.tobytes()], pa.binary())],
                                                 names=["fold", "place", "rows"])

    return _assembled(rows, features).select("_place", "_fold", "label", "x").mapInArrow(run, "fold int, place binary, rows binary")


def _in_place(t: pa.Table, width: int) -> np.ndarray:
    """A table's rows from its blocks, in the order of its files however these were read."""
    place, rows = _joined(t.column("place"), "<i8"), _joined(t.column("rows"), "u1", width)
    return rows if (place[1:] > place[:-1]).all() else rows[place.argsort()]


def _dealt(blocks: DataFrame, n: int, folds: int = 1):
    """A group with all blocks of a fold for each of ``n`` tasks a fold, numbered task * folds + fold."""
    each = blocks.withColumn("group", F.explode(F.sequence("fold", F.lit((n - 1) * folds) + F.col("fold"), F.lit(folds))))
    return each.repartition(4 * n * folds, "group").groupBy("group")      # more partitions than groups: few share one


@dataclass(frozen=True)
class Grower:
    """What a task needs to grow a forest's trees; as the estimator has it."""

    n_features: int
    n_classes: int
    n_bins: int
    tried: int
    max_depth: int
    min_leaf: int
    seed: int
    rate: float

    @classmethod
    def of(cls, est: RandomForestClassifier, n_features: int, n_classes: int) -> Grower:
        return cls(n_features, n_classes, est.getMaxBins(), subset_size(est.getFeatureSubsetStrategy(), n_features, est.getNumTrees()),
                   est.getMaxDepth(), est.getMinInstancesPerNode(), est.getSeed(), est.getSubsamplingRate())

    def rng(self, *of: int) -> np.random.Generator:
        return np.random.default_rng([self.seed & (2**63 - 1), *of])

    def bag(self, rows: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """The rows that a bootstrap draws, each once with its weight."""
        weight = rng.poisson(self.rate, len(rows))
        bag = rows[weight > 0]
        bag[:, -1] = weight[weight > 0]
        return bag

    def tree(self, rows: np.ndarray, number: int) -> Tree:
        """A tree of the forest; it depends on the rows and their order, the seed and its number alone."""
        rng = self.rng(number)
        return self.below(self.bag(rows, rng), 0, rng).pruned()

    def below(self, bag: np.ndarray, depth: int, rng: np.random.Generator) -> Tree:
        """What grows from a node at ``depth`` with these rows."""
        return grow(bag, self.n_classes, self.n_bins, self.tried, self.max_depth - depth, self.min_leaf, rng)

    def row(self, number: int, tree: Tree) -> dict:
        """A pruned tree as a row of the stored table."""
        return {"tree": number, "n_nodes": len(tree.feature), "importance": tree.importance(self.n_features).tolist()} | tree.to_bytes()


_TREE = "tree int, n_nodes long, importance array<double>, feature binary, bin binary, left binary, stats binary"
_TREE_ARROW = pa.schema([("tree", pa.int32()), ("n_nodes", pa.int64()), ("importance", pa.list_(pa.float64())),
                         *[(c, pa.binary()) for c in ("feature", "bin", "left", "stats")]])


def _given(f, **held):
    """``f`` of one argument, as Spark wants it."""
    return lambda x: f(x, **held)


class _Top:
    """The top of a tree, as the driver has it: its nodes so far, those to be split by the next pass, and those whose rows a task can hold."""

    def __init__(self, number: int):
        self.number, self.nodes, self.depth, self.passed, self.ready = number, [[-1, 0, 0, None, 0.0]], [0], [0], []

    def tree(self, n_classes: int) -> Tree:
        feature, bin_, left, stats, gain = zip(*self.nodes)     # by depth: a pass makes a level
        return Tree(np.array(feature), np.array(bin_, dtype=np.uint8), np.array(left), np.array([np.zeros(n_classes) if x is None else x for x in stats]),
                    np.array(gain, dtype=float), np.append(0, np.cumsum(np.bincount(self.depth))))

    def split(self, found: dict, drawn: np.ndarray, grower: Grower, rows_per_task: int) -> None:
        """Takes the best splits of the nodes that a pass went over."""
        nodes, self.passed = self.passed, []
        for i, at in enumerate(nodes):
            total = np.array(found["total"][i])
            self.nodes[at][3] = total
            if not _splits(total[None], grower.min_leaf)[0] or found["won"][i] <= NO_GAIN or self.depth[at] >= grower.max_depth:
                continue
            self.nodes[at][:3] = int(drawn[i, found["chosen"][i]]), found["best"][i], len(self.nodes)
            self.nodes[at][4] = found["won"][i]
            for stats in (np.array(found["below"][i]), total - np.array(found["below"][i])):
                self.nodes.append([-1, 0, 0, stats, 0.0])
                self.depth.append(self.depth[at] + 1)
                if _splits(stats[None], grower.min_leaf)[0] and self.depth[-1] < grower.max_depth:
                    (self.passed if stats.sum() > rows_per_task else self.ready).append(len(self.nodes) - 1)


def _grown_from_tops(blocks: DataFrame, grower: Grower, n_trees: int, n_rows: int, rows_per_task: int) -> DataFrame:
    """The stored trees of a table of which a task can't hold all rows.

    A pass over the blocks makes a level of the tops of some trees: class
    histograms of the nodes with more than ``rows_per_task`` rows, which a task
    a tree adds up. Then the rows of each node left are brought together, and
    a task grows what is below it.
    """
    spark, width, g = blocks.sparkSession, grower.n_features, grower
    blocks = materialize(blocks, "forest-blocks")
    path = stored_path(spark, "forest-trees")
    at_once = max(1, COUNTS_A_PASS // n_rows)

    def bags(t: pa.RecordBatch, numbers: list[int]) -> Iterator[tuple[int, int, np.ndarray]]:
        for place, rows in zip(t.column("place"), t.column("rows")):
            first, rows = int(np.frombuffer(place.as_py(), "<i8")[0]), np.frombuffer(rows.as_py(), "u1").reshape(-1, width + 2)
            for number in numbers:
                yield first, number, g.bag(rows, g.rng(number, first, 0))

    def histograms(batches, tops: dict, drawn: dict) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        for b in batches:
            for _, number, bag in bags(b, list(drawn)):
                tree, passed = tops[number]
                slot = np.full(len(tree.feature), -1)
                slot[passed] = np.arange(len(passed))
                slot = slot[tree.reached(np.ascontiguousarray(bag[:, :width]))]
                bag, slot = bag[slot >= 0], slot[slot >= 0]
                sums[number] = sums.get(number, 0.0) + _histogram(bag.reshape(-1), width + 2, slot, drawn[number], g.n_classes, g.n_bins)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["tree", "sums"])

    def choose(t: pa.Table) -> pa.Table:
        sums = np.sum([np.frombuffer(x, "<f8") for x in t.column("sums").to_pylist()], axis=0)
        sums = np.cumsum(sums.reshape(g.n_classes, g.tried, -1, g.n_bins), axis=3)
        total = sums[:, 0, :, -1].T
        with np.errstate(invalid="ignore", divide="ignore"):
            chosen, best, won = _best(sums, total, max(g.min_leaf, 1))
        below = sums[:, chosen, np.arange(len(total)), best].T
        return pa.table({"tree": t.column("tree")[:1], "chosen": [chosen.tolist()], "best": [best.tolist()], "won": [np.nan_to_num(won).tolist()],
                         "total": [total.tolist()], "below": [below.tolist()]},
                        schema=pa.schema([("tree", pa.int32()), ("chosen", pa.list_(pa.int64())), ("best", pa.list_(pa.int64())), ("won", pa.list_(pa.float64())),
                                          ("total", pa.list_(pa.list_(pa.float64()))), ("below", pa.list_(pa.list_(pa.float64())))]))

    def deal(batches, tops: dict) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, number, bag in bags(b, list(tops)):
                tree, ready = tops[number]
                at = tree.reached(np.ascontiguousarray(bag[:, :width]))
                found = [(int(n), bag[at == n].tobytes()) for n in np.intersect1d(at, ready)]
                yield pa.RecordBatch.from_arrays([pa.array([number] * len(found), pa.int32()), pa.array([n for n, _ in found], pa.int64()),
                                                  pa.array([first] * len(found), pa.int64()), pa.array([x for _, x in found], pa.binary())],
                                                 names=["tree", "node", "place", "rows"])

    def grow_below(t: pa.Table, depth: dict) -> pa.Table:
        number, node = t.column("tree")[0].as_py(), t.column("node")[0].as_py()
        order = np.asarray(t.column("place")).argsort()
        bag = np.frombuffer(b"".join(t.column("rows").take(pa.array(order)).to_pylist()), "u1").reshape(-1, width + 2)
        tree = g.below(bag, depth[number][node], g.rng(number, node, 1))
        return pa.Table.from_pylist([{"tree": number, "node": node, "gain": tree.gain.tobytes(), "levels": tree.levels.tobytes()} | tree.to_bytes()], schema=pa.schema(
            [("tree", pa.int32()), ("node", pa.int64()), *[(c, pa.binary()) for c in ("feature", "bin", "left", "stats", "gain", "levels")]]))

    def join(t: pa.Table, tops: dict) -> pa.Table:
        number, below = t.column("tree")[0].as_py(), {}
        for r in sorted((r for r in t.to_pylist() if r["node"] is not None), key=lambda r: r["node"]):
            below[r["node"]] = Tree.of_bytes(r)
            below[r["node"]].gain, below[r["node"]].levels = np.frombuffer(r["gain"], "<f8"), np.frombuffer(r["levels"], "<i8")
        return pa.Table.from_pylist([g.row(number, tops[number][0].with_below(below).pruned())], schema=_TREE_ARROW)

    for start in range(0, n_trees, at_once):
        growing = [_Top(number) for number in range(start, min(start + at_once, n_trees))]
        while any(top.passed for top in growing):
            tops = {top.number: (top.tree(g.n_classes), np.array(top.passed)) for top in growing if top.passed}
            drawn = {top.number: _drawn(g.rng(top.number, len(top.nodes), 2), len(top.passed), width, g.tried) for top in growing if top.passed}
            found = (blocks.mapInArrow(_given(histograms, tops=tops, drawn=drawn), "tree int, sums binary").groupBy("tree").applyInArrow(
                choose, "tree int, chosen array<long>, best array<long>, won array<double>, total array<array<double>>, below array<array<double>>").collect())
            for r in found:
                growing[r["tree"] - start].split(r, drawn[r["tree"]], g, rows_per_task)
        tops = {top.number: (top.tree(g.n_classes), np.array(top.ready, dtype=np.int64)) for top in growing}
        dealt = blocks.mapInArrow(_given(deal, tops=tops), "tree int, node long, place long, rows binary").groupBy("tree", "node")
        below = dealt.applyInArrow(_given(grow_below, depth={top.number: top.depth for top in growing}),
                                   "tree int, node long, feature binary, bin binary, left binary, stats binary, gain binary, levels binary")
        every = spark.range(start, start + len(growing)).select(F.col("id").cast("int").alias("tree"))      # a top may be a whole tree
        every.unionByName(below, allowMissingColumns=True).groupBy("tree").applyInArrow(_given(join, tops=tops), _TREE).write.mode("append").parquet(path)
    return spark.read.parquet(path)


@dataclass
class StoredForest:
    """A fitted forest whose trees are rows of a stored table."""

    trees: DataFrame
    features: list[str]
    points: list[np.ndarray]
    n_classes: int
    importance: list[float]
    num_trees: int
    n_nodes: int
    n_features: int
    #: the parameters that the trees were grown with
    held: dict

    @classmethod
    def fit(cls, data: DataFrame, features: list[str], est: RandomForestClassifier, n_rows: int, n_classes: int, rows_per_task: int) -> StoredForest:
        """All trees of ``est`` on the stored table ``data`` (``label`` and the features); a task holds ``rows_per_task`` rows' bytes at most."""
        points, grower, n_trees = find_points(data, features, est, n_rows), Grower.of(est, len(features), n_classes), est.getNumTrees()
        n = min(n_trees, max(4 * data.sparkSession.sparkContext.defaultParallelism, -(-n_trees * n_rows // COUNTS_A_TASK)))

        def run(t: pa.Table) -> pa.Table:
            group, rows = t.column("group")[0].as_py(), _in_place(t, grower.n_features + 2)
            out = []
            for number in range(group * n_trees // n, (group + 1) * n_trees // n):
                out.append(grower.row(number, grower.tree(rows, number)))
            return pa.Table.from_pylist(out, schema=_TREE_ARROW)

        blocks = _row_blocks(data, features, points)
        trees = (materialize(_dealt(blocks, n).applyInArrow(run, _TREE), "forest-trees") if n_rows <= rows_per_task else
                 _grown_from_tops(blocks, grower, n_trees, n_rows, rows_per_task))
        grown = sorted(trees.select("tree", "n_nodes", "importance").collect())       # one row per tree
        total = np.sum([r["importance"] for r in grown], axis=0)
        held = {k: est.getOrDefault(k) for k in ("maxDepth", "minInstancesPerNode", "seed", "featureSubsetStrategy", "impurity", "bootstrap")}
        return cls(trees, features, points[0], n_classes, (total / (total.sum() or 1.0)).tolist(), len(grown), sum(r["n_nodes"] for r in grown),
                   len(features), held)

    def votes(self, rows: DataFrame, n_rows: int) -> DataFrame:
        """(_row, _votes): the class shares of the leaves that each row reaches, added up over the trees, for rows with a unique ``_row``.

        A task has some blocks of rows and some trees; a block's sums over
        groups of trees are added in the trees' order.
        """
        points, n_classes, n_trees, width = self.points, self.n_classes, self.num_trees, self.n_features
        groups = min(n_trees, max(-(-self.n_nodes // NODES_A_TASK), rows.sparkSession.sparkContext.defaultParallelism))
        chunks = max(1, -(-n_rows // ROWS_A_TASK))

        def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                ids = np.asarray(b.column("_row"))
                if len(ids):
                    yield pa.RecordBatch.from_arrays([pa.array([int(ids[0])], pa.int64()), pa.array([ids.tobytes()], pa.binary()),
                                                      pa.array([binned(_matrix(b.column("x"), width), points).tobytes()], pa.binary())], names=["block", "ids", "rows"])

        def score(blocks: pa.Table, trees: pa.Table) -> pa.Table:
            held = sorted(trees.to_pylist(), key=lambda r: r["tree"])
            found = [(np.frombuffer(r["rows"], "u1").reshape(-1, width), np.zeros((len(r["ids"]) // 8, n_classes)), r) for r in blocks.to_pylist()]
            for row in held:
                tree = Tree.of_bytes(row)
                shares = tree.shares()
                for x, votes, _ in found:
                    votes += shares[tree.reached(x)]
            group = held[0]["group"] if held else 0
            return pa.Table.from_pylist([{"block": r["block"], "group": group, "ids": r["ids"], "votes": votes.tobytes()} for _, votes, r in found],
                                        schema=pa.schema([("block", pa.int64()), ("group", pa.int32()), ("ids", pa.binary()), ("votes", pa.binary())]))

        def add(parts: pa.Table) -> pa.Table:
            held = sorted(parts.to_pylist(), key=lambda r: r["group"])
            votes = np.sum([np.frombuffer(r["votes"], "<f8").reshape(-1, n_classes) for r in held], axis=0)
            return pa.table({"_row": pa.array(np.frombuffer(held[0]["ids"], "<i8")), "_votes": pa.array(votes.tolist(), pa.list_(pa.float64()))})

        x = _assembled(rows.select("_row", *[f"`{c}`" for c in self.features]), self.features).select("_row", "x")
        blocks = (x.mapInArrow(to_blocks, "block long, ids binary, rows binary").withColumn("chunk", F.expr(f"pmod(xxhash64(block), {chunks})"))
                  .withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))))
        trees = (self.trees.select("tree", "feature", "bin", "left", "stats", F.expr(f"cast(tree * {groups} div {n_trees} as int)").alias("group"))
                 .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long")))))
        n, keys = 4 * groups * chunks, ("chunk", "group")
        parts = blocks.repartition(n, *keys).groupBy(*keys).cogroup(trees.repartition(n, *keys).groupBy(*keys)).applyInArrow(
            score, "block long, group int, ids binary, votes binary")
        return parts.groupBy("block").applyInArrow(add, "_row long, _votes array<double>")


def fold_hits(data: DataFrame, features: list[str], ests: list[RandomForestClassifier], folds: int, trees: list[int], depths: list[int],
              n_rows: int, n_classes: int) -> dict[tuple[int, int, int, int], float]:
    """(trees, depth, leaf size, fold) -> accuracy on the fold: a forest for each of ``ests`` (which differ in leaf size)
    and fold, grown on the other folds of the stored table ``data``, its first trees, cut at each depth.

    A task grows some trees of one forest and scores the fold's rows with
    them; what leaves it are sums of votes.
    """
    width, growers = len(features), [Grower.of(est, len(features), n_classes) for est in ests]
    parts = max(1, -(-4 * data.sparkSession.sparkContext.defaultParallelism // (len(ests) * folds * len(trees))), -(-max(trees) * n_rows // COUNTS_A_TASK) // len(trees))
    jobs = [(of, a + (b - a) * i // parts, a + (b - a) * (i + 1) // parts) for of in range(len(ests)) for a, b in zip([0, *trees], trees) for i in range(parts)]

    def run(t: pa.Table) -> pa.Table:
        (of, start, stop), fold = jobs[t.column("group")[0].as_py() // folds], t.column("fold")[0].as_py()
        rows = _in_place(t, width + 2)
        out = rows[:, -1] == 1
        train, held = rows[~out], rows[out]
        votes = np.zeros((len(depths), len(held), n_classes))
        for number in range(start, stop):
            tree = growers[of].tree(train, number)
            at, shares = tree.reached(np.ascontiguousarray(held[:, :width])), tree.shares()
            for d, depth in enumerate(depths):
                votes[d] += shares[tree.ends(depth)[at]]
        cuts = range(0, len(held), FOLD_ROWS_A_TASK)
        return pa.Table.from_pylist([{"of": of, "fold": fold, "chunk": i, "start": start, "stop": stop, "label": held[i:i + FOLD_ROWS_A_TASK, -2].tobytes(),
                                      "votes": votes[:, i:i + FOLD_ROWS_A_TASK].tobytes()} for i in cuts],
                                    schema=pa.schema([*[(c, pa.int32()) for c in ("of", "fold", "chunk", "start", "stop")], ("label", pa.binary()), ("votes", pa.binary())]))

    def count(t: pa.Table) -> pa.Table:
        out, total = [], 0.0
        for r in sorted(t.to_pylist(), key=lambda r: (r["start"], r["stop"])):
            label = np.frombuffer(r["label"], "u1")
            total = total + np.frombuffer(r["votes"], "<f8").reshape(len(depths), len(label), n_classes)
            if r["stop"] in trees and r["start"] < r["stop"]:
                out += [{"n": r["stop"], "depth": depth, "of": r["of"], "fold": r["fold"], "hits": int((p.argmax(axis=1) == label).sum()), "rows": len(label)}
                        for depth, p in zip(depths, total)]
        return pa.Table.from_pylist(out, schema=pa.schema([*[(c, pa.int32()) for c in ("n", "depth", "of", "fold")], ("hits", pa.int64()), ("rows", pa.int64())]))

    blocks = _row_blocks(data, features, find_points(data, features, ests[0], n_rows, folds))
    sums = _dealt(blocks, len(jobs), folds).applyInArrow(run, "of int, fold int, chunk int, start int, stop int, label binary, votes binary")
    found = (sums.groupBy("of", "fold", "chunk").applyInArrow(count, "n int, depth int, of int, fold int, hits long, rows long")
             .groupBy("n", "depth", "of", "fold").agg(F.sum("hits").alias("hits"), F.sum("rows").alias("rows")).collect())     # one row per setting and fold
    return {(r["n"], r["depth"], ests[r["of"]].getMinInstancesPerNode(), r["fold"]): r["hits"] / r["rows"] for r in found}
