"""Approximate nearest neighbours with balanced posting lists.

Centroids are fitted on a bounded sample by k-means with a penalty on full
lists, and linked to their nearest centroids in a graph. Every vector goes to
its nearest list, and a boundary vector also to further lists that are nearly
as near, unless a list already chosen lies nearer to that list than the
vector does. A query walks the centroid graph, and searches the lists whose
distance is within a ratio of the nearest, nearest first, until they own a
number of vectors. Both bounds are fixed and do not grow with the rows; they
are widened only where a sample of queries, searched against all rows, shows that
they would miss more than ``target`` allows (vectors without any clusters).
Lists are stored in blocks of bounded size, so a hot list is many blocks;
queries meet blocks in blocks.

Largest inner product becomes smallest distance by one more coordinate,
sqrt(max norm^2 - norm^2), on the candidates and 0 on the queries. Where norms
are uneven, that coordinate would outweigh all others; so the vectors of
largest norm are kept out of the lists then, and the maximum is that of the
others. They lie in lists by norm, and a query searches such a list only if
the list's largest norm times its own reaches its k-th score so far.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from retention.llm.common import Scratch


@dataclass(frozen=True)
class Params:
    sample: int = 20_000        # rows that centroids are fitted on, at most
    list_rows: int = 128        # aimed list length; the centroid count grows with the rows
    max_lists: int = 16_384     # centroids held in memory, at most (64 dimensions: 4 MB)
    degree: int = 16            # links of a centroid in the graph
    store_beam: int = 16        # centroids kept while a vector looks for its lists
    search_beam: int = 24       # centroids kept while a query looks for its lists, at least
    replicas: int = 4           # lists of one vector, at most
    replica_ratio: float = 1.2  # a further list's distance against the nearest one's
    head_share: float = 0.05    # vectors of largest norm kept out of the lists, where norms are uneven
    head_ratio: float = 1.5     # uneven: the largest squared norm against that of the others
    probe_ratio: float = 1.35   # a searched list's distance against the nearest one's
    probe_rows: int = 8192      # vectors that the lists searched by a query own, about
    tried: int = 64             # queries searched against all rows to measure what the lists would miss
    target: float = 0.95        # their true neighbours that either bound alone must let through
    block_rows: int = 1024      # vectors of a stored block, about
    query_rows: int = 256       # queries that meet a list together, about
    merge_rows: int = 500_000   # finds a task gathers before it keeps the best of each query


def fit_centroids(sample: np.ndarray, n_lists: int, rounds: int = 12, penalty: float = 0.3) -> np.ndarray:
    """k-means in which a full list looks farther away; the start is an even walk through the sample.

    The sample lies on a sphere, and the centroids are put back on it: else
    they would lie nearer to each other than vectors to them, and no list
    would be told apart from its neighbours. Copies of a vector count once, so
    that a very common one doesn't become many centroids.
    """
    sample = np.unique(sample, axis=0)
    sample = sample[np.random.RandomState(0).permutation(len(sample))]
    n_lists = min(n_lists, len(sample))
    centre = sample[np.linspace(0, len(sample) - 1, n_lists).astype(int)].copy()
    load = np.zeros(n_lists)
    aim = len(sample) / n_lists
    for _ in range(rounds):
        own = np.empty(len(sample), dtype=np.int64)
        scale = None
        for a in range(0, len(sample), 4096):
            x = sample[a:a + 4096]
            far = (x * x).sum(1)[:, None] - 2 * x @ centre.T + (centre * centre).sum(1)
            if scale is None:
                scale = max(1e-12, float(np.median(far.min(1))))
            own[a:a + 4096] = (far + penalty * scale * np.maximum(load / aim - 1, 0)).argmin(1)
        load = np.bincount(own, minlength=n_lists).astype(float)
        total = np.zeros_like(centre)
        np.add.at(total, own, sample)
        filled = load > 0
        centre[filled] = total[filled] / load[filled, None]
    length = np.sqrt((centre * centre).sum(1, keepdims=True))
    radius = np.sqrt((sample * sample).sum(1).max())
    return np.unique(np.where(length > 1e-12, centre / np.maximum(length, 1e-12) * radius, centre).astype(np.float32), axis=0)


class CentroidGraph:
    """Centroids linked to their nearest ones; searched by a beam from spread-out entries, many points at once."""

    def __init__(self, centre: np.ndarray, degree: int):
        self.centre, self.norm = centre, (centre * centre).sum(1)
        n = len(centre)
        self.links = np.empty((n, min(degree, max(1, n - 1))), dtype=np.int64)
        for a in range(0, n, 1024):
            far = self.far(centre[a:a + 1024])
            far[np.arange(len(far)), np.arange(a, a + len(far))] = -1      # itself first
            k = self.links.shape[1]
            near = np.argpartition(far, min(k, n - 1), axis=1)[:, :k + 1]
            near = np.take_along_axis(near, np.argsort(np.take_along_axis(far, near, 1), axis=1, kind="stable"), 1)
            self.links[a:a + 1024] = near[:, 1:] if near.shape[1] > k else near[:, :k]
        self.entry = np.linspace(0, n - 1, min(n, max(16, int(n ** 0.5)))).astype(np.int64)

    def far(self, x: np.ndarray) -> np.ndarray:
        return (x * x).sum(1)[:, None] - 2 * x @ self.centre.T + self.norm      # float32, as the centroids are

    def _far_to(self, x: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return (x * x).sum(1)[:, None] - 2 * np.einsum("qd,qkd->qk", x, self.centre[ids]) + self.norm[ids]

    def search(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, squared distances) of about the nearest ``beam`` centroids of each point, nearest first."""
        k, x = min(beam, len(self.centre)), x.astype(np.float32)
        ids = np.broadcast_to(self.entry, (len(x), len(self.entry)))
        far = self._far_to(x, ids)
        opened = np.zeros(ids.shape, dtype=bool)
        rows = np.arange(len(x))[:, None]
        while True:
            width = min(4, ids.shape[1])
            pick = np.argsort(np.where(opened, np.inf, far), axis=1, kind="stable")[:, :width]
            fresh = ~opened[rows, pick] & np.isfinite(far[rows, pick])
            if not fresh.any():
                break
            opened = opened.copy()
            opened[rows, pick] = True
            more = self.links[ids[rows, pick]].reshape(len(x), -1)
            ids = np.concatenate([ids, more], axis=1)
            far = np.concatenate([far, self._far_to(x, more)], axis=1)
            opened = np.concatenate([opened, np.zeros(more.shape, dtype=bool)], axis=1)
            # a centroid met twice keeps its opened entry; the others go out of the beam
            order = np.lexsort((~opened, ids), axis=1)
            ids, far, opened = ids[rows, order], far[rows, order], opened[rows, order]
            far[:, 1:] = np.where(ids[:, 1:] == ids[:, :-1], np.inf, far[:, 1:])
            order = np.argsort(far, axis=1, kind="stable")[:, :k]
            ids, far, opened = ids[rows, order], far[rows, order], opened[rows, order]
        return ids, np.maximum(far, 0)


def choose_lists(graph: CentroidGraph, x: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, list, primary) of the lists each vector is stored in."""
    ids, far = graph.search(x, p.store_beam)
    rows, lists, primary = [np.arange(len(x))], [ids[:, 0]], [np.ones(len(x), dtype=bool)]
    chosen = ids[:, :1]
    for k in range(1, min(ids.shape[1], 4 * p.replicas)):
        c = ids[:, k]
        ok = np.isfinite(far[:, k]) & (far[:, k] <= p.replica_ratio ** 2 * far[:, 0])
        between = ((graph.centre[chosen] - graph.centre[c][:, None]) ** 2).sum(2)
        between = np.where(chosen >= 0, between, np.inf)
        ok &= (between > far[:, k][:, None]).all(1) & ((chosen >= 0).sum(1) < p.replicas)
        chosen = np.concatenate([chosen, np.where(ok, c, -1)[:, None]], axis=1)
        rows.append(np.flatnonzero(ok))
        lists.append(c[ok])
        primary.append(np.zeros(int(ok.sum()), dtype=bool))
    return np.concatenate(rows), np.concatenate(lists), np.concatenate(primary)


@dataclass(frozen=True)
class Bounds:
    """Which lists a query searches: up to ``ratio`` times the nearest one's distance, until they own ``rows`` vectors."""

    ratio: float
    rows: int
    beam: int


def probe_lists(graph: CentroidGraph, x: np.ndarray, sizes: np.ndarray, k: int, bounds: Bounds) -> tuple[np.ndarray, np.ndarray]:
    """(row, list) of the lists each query searches: within the bounds, and on until they own over ``k`` vectors."""
    ids, far = graph.search(x, bounds.beam)
    held = np.cumsum(np.where(np.isfinite(far), sizes[ids], 0), axis=1)
    before = np.concatenate([np.zeros((len(x), 1)), held[:, :-1]], axis=1)
    take = np.isfinite(far) & ((far <= bounds.ratio ** 2 * far[:, :1]) & (before < bounds.rows) | (before <= k))
    short = held[:, -1] <= k        # the beam owns too few: every list, nearest or not
    row, col = np.nonzero(take & ~short[:, None])
    rest = np.flatnonzero(short)
    return (np.concatenate([row, np.repeat(rest, len(sizes))]),
            np.concatenate([ids[row, col], np.tile(np.arange(len(sizes)), len(rest))]))


def needed(graph: CentroidGraph, x: np.ndarray, sizes: np.ndarray, lists: list[list[list[int]]], p: Params) -> Bounds:
    """Bounds that let through ``target`` of true neighbours; ``lists`` has, per query, the lists of each of them."""
    far = np.maximum(graph.far(x.astype(np.float32)), 0)
    order = np.argsort(far, axis=1, kind="stable")
    ratios, rows = [], []
    for q, of in enumerate(lists):
        place = np.empty(len(sizes), dtype=np.int64)
        place[order[q]] = np.arange(len(sizes))
        held = np.cumsum(sizes[order[q]])
        nearest = max(float(far[q, order[q, 0]]), 1e-30)
        for own in of:
            ratios.append(min(float(far[q, i]) / nearest for i in own) ** 0.5)
            rows.append(min(int(held[place[i]]) for i in own))
    def reach(values, least):
        return max(least, float(np.quantile(values, p.target, method="higher"))) if values else least
    bound_rows = int(reach(rows, p.probe_rows))
    beam = max(p.search_beam, int(np.ceil(1.25 * bound_rows / max(1.0, float(np.median(sizes[sizes > 0])))))) if len(sizes) else p.search_beam
    return Bounds(reach(ratios, p.probe_ratio) * (1 + 1e-6), bound_rows, beam)


def best_of_block(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, vec_ids: np.ndarray, k: int):
    """The ``k`` best of a block for each query, ties to the smaller id.

    A matrix product finds who may be among them; their scores are then added
    up one by one in one order, so that equal vectors tie exactly.
    """
    rough = queries @ vectors.T
    rough[query_ids[:, None] == vec_ids[None, :]] = -np.inf
    n = rough.shape[1]
    slack = 1e-9 * np.sqrt((queries * queries).sum(1).max() * (vectors * vectors).sum(1).max())
    least = np.partition(rough, n - k, axis=1)[:, n - k] - slack if n > k else np.full(len(queries), -np.inf)
    row, col = np.nonzero((rough >= least[:, None]) & (rough > -np.inf))
    # many may be as good as the last one, to rounding: in pieces, so that a block of copies takes no more room than another
    score = np.concatenate([np.einsum("rd,rd->r", queries[row[i:i + 65536]], vectors[col[i:i + 65536]]) for i in range(0, max(1, len(row)), 65536)])
    return best_of_all(query_ids[row], vec_ids[col], score, k)


def best_of_all(query: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int):
    """The ``k`` best finds of each query, a vector found in several lists once."""
    order = np.lexsort((vec, -score, query))
    query, vec, score = query[order], vec[order], score[order]
    new = np.ones(len(query), dtype=bool)
    new[1:] = (query[1:] != query[:-1]) | (vec[1:] != vec[:-1])
    query, vec, score = query[new], vec[new], score[new]
    head = np.ones(len(query), dtype=bool)
    head[1:] = query[1:] != query[:-1]
    start = np.flatnonzero(head)
    keep = np.arange(len(query)) - start[np.cumsum(head) - 1] < k if len(query) else head
    return query[keep], vec[keep], score[keep]


def _matrix(column, width: int) -> np.ndarray:
    flat = column.flatten()
    return np.asarray(flat, dtype=np.float64).reshape(-1, width)


def nearest_neighbours(vectors: DataFrame, k: int = 20, query_step: int = 20, params: Params = Params(),
                       vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each id divisible by ``query_step`` the ``k`` vectors of largest inner product found.

    Ties go to the smaller id. Rows without an id or vector, zero vectors,
    vectors with null or non-finite components and vectors of another than the
    commonest length take no part; of rows that share an id the one with the
    smallest vector counts. With k candidates or fewer all are returned. Other
    columns are ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "neighbours")
    x = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), x.alias("vec")).where(
        F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0)
        & F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
        & F.exists("vec", lambda v: v != 0))
    common = rows.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    out_schema = "query_id long, rank int, vec_id long, score double"
    if common is None:
        return spark.createDataFrame([], out_schema)
    dim = common["d"]
    norm = F.aggregate("vec", F.lit(0.0), lambda s, v: s + v * v)
    rows = rows.where(F.size("vec") == dim).groupBy("vec_id").agg(F.min("vec").alias("vec"))
    # a power of two that keeps squares finite: no bit of a product changes, and huge scores get their sign
    largest = rows.agg(F.max(F.array_max(F.transform("vec", F.abs)))).first()[0]
    scale = 2.0 ** math.frexp(largest)[1] if not 2.0 ** -400 < largest < 2.0 ** 400 else 1.0
    if scale != 1.0:
        rows = rows.withColumn("vec", F.transform("vec", lambda v: v / F.lit(scale)))
    rows = scratch.store(rows.withColumn("norm", norm), "vectors")
    low, most, n = rows.agg(F.percentile_approx("norm", 1 - params.head_share, 10_000), F.max("norm"), F.count("*")).first()
    uneven = most > params.head_ratio * low
    in_head = F.col("norm") > F.lit(low) if uneven else F.lit(False)
    most = low if uneven else most
    n_head = rows.where(in_head).count() if uneven else 0
    sample = rows.where(~in_head).orderBy(F.xxhash64("vec_id"), "vec_id").limit(params.sample).select("vec", "norm").toArrow()
    vec = _matrix(sample.column("vec").combine_chunks(), dim)
    extra = np.sqrt(np.maximum(most - np.asarray(sample.column("norm")), 0))
    n_lists = int(min(params.max_lists, len(vec), max(1, -(-(n - n_head) // params.list_rows))))
    graph = CentroidGraph(fit_centroids(np.column_stack([vec, extra]), n_lists), params.degree)
    shared = spark.sparkContext.broadcast(graph)     # at most max_lists centroids and their links
    p, top, n_lists = params, float(most), len(graph.centre)

    def post(batches):
        graph = shared.value
        for b in batches:
            for a in range(0, b.num_rows, 1024):
                part = b.slice(a, 1024)
                v = _matrix(part.column("vec"), dim)
                full = np.column_stack([v, np.sqrt(np.maximum(top - np.asarray(part.column("norm")), 0))])
                row, lists, primary = choose_lists(graph, full, p)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(lists, pa.int32()), part.column("vec_id").take(take),
                                                  part.column("vec").take(take), pa.array(primary)],
                                                 names=["list", "vec_id", "vec", "primary"])

    posted = rows.where(~in_head).mapInArrow(post, "list int, vec_id long, vec array<double>, primary boolean")
    posted = scratch.store(posted, "posted")
    counts = scratch.store(posted.groupBy("list").agg(
        F.count("*").alias("n"), F.sum(F.col("primary").cast("long")).alias("own")), "counts")
    sizes = np.zeros(n_lists, dtype=np.int64)
    for r in counts.collect():      # one row per centroid
        sizes[r["list"]] = r["own"]
    parts = counts.select(F.col("list").alias("l"), F.ceil(F.col("n") / p.block_rows).cast("int").alias("parts"))
    blocks = _blocks(posted.join(F.broadcast(parts), F.col("list") == F.col("l")), F.pmod(F.xxhash64("vec_id"), F.col("parts")))
    queries = rows.where(F.col("vec_id") % query_step == 0)
    bounds = _measured(rows.where(~in_head), queries, posted, graph, sizes, k, dim, p)
    blocks = scratch.store(blocks, "blocks")
    scratch.drop("posted", "counts")

    def probe(batches):
        for b in batches:
            for a in range(0, b.num_rows, 1024):
                part = b.slice(a, 1024)
                v = _matrix(part.column("vec"), dim)
                row, lists = probe_lists(shared.value, np.column_stack([v, np.zeros(len(v))]), sizes, k, bounds)
                yield pa.RecordBatch.from_arrays([pa.array(lists, pa.int32()), part.column("vec_id").take(pa.array(row))],
                                                 names=["list", "vec_id"])

    def asked(pairs, name):
        pairs = scratch.store(pairs, name)
        cut = pairs.groupBy(F.col("list").alias("l")).agg(F.ceil(F.count("*") / p.query_rows).cast("int").alias("parts"))    # a row per list
        grouped = (pairs.join(F.broadcast(cut), F.col("list") == F.col("l"))
                   .join(queries.select(F.col("vec_id").alias("v"), "vec"), F.col("vec_id") == F.col("v"))
                   .groupBy("list", F.pmod(F.xxhash64("vec_id"), F.col("parts")).alias("g")).agg(
                       F.collect_list(F.struct("vec_id", "vec")).alias("q")))
        return grouped.select(F.col("list").alias("ql"), F.col("q.vec_id").alias("query_ids"), F.flatten("q.vec").alias("query_flat"))

    def search(batches):
        got, held = [], 0

        def best():
            q, v, s = best_of_all(*(np.concatenate(x) for x in zip(*got)), k)
            return pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.float64())],
                                              names=["query_id", "vec_id", "score"])

        for b in batches:
            for i in range(b.num_rows):
                one = lambda c: np.asarray(b.column(c)[i].values)  # noqa: E731, B023
                got.append(best_of_block(one("query_flat").reshape(-1, dim), one("query_ids"),
                                         one("flat").reshape(-1, dim), one("ids"), k))
                held += len(got[-1][0])
                if held > p.merge_rows:
                    yield best()
                    got, held = [], 0
        if got:
            yield best()

    def searched(pairs, blocks, name):
        met = asked(pairs, name).join(blocks, F.col("ql") == F.col("list")).select("query_ids", "query_flat", "ids", "flat")
        return met.mapInArrow(search, "query_id long, vec_id long, score double")

    def best_k(found):
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return found.distinct().withColumn("rank", rank).where(F.col("rank") <= k)      # replicas score alike

    found = best_k(searched(queries.mapInArrow(probe, "list int, vec_id long"), blocks, "asked"))
    if n_head:
        found = scratch.store(found, "found")
        found = best_k(found.drop("rank").unionByName(searched(
            *_head(rows.where(in_head), queries, found, n_head, k, scratch, p), "asked-head")))
    return found.select("query_id", "rank", "vec_id", (F.col("score") * F.lit(scale) * F.lit(scale)).alias("score"))


def _blocks(listed: DataFrame, block) -> DataFrame:
    """Vectors (``list``, ``vec_id``, ``vec``) as blocks of a list: ``list``, ``ids``, ``flat``."""
    grouped = listed.groupBy("list", block.alias("block")).agg(F.collect_list(F.struct("vec_id", "vec")).alias("held"))
    return grouped.select("list", "block", F.col("held.vec_id").alias("ids"), F.flatten("held.vec").alias("flat"))


def _measured(rows: DataFrame, queries: DataFrame, posted: DataFrame, graph: CentroidGraph, sizes: np.ndarray, k: int, dim: int,
              p: Params) -> Bounds:
    """The bounds of the search: ``tried`` queries are searched against all listed rows, and the lists of what they find are looked up."""
    tried = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(p.tried).select("vec_id", "vec").toArrow()
    ids, x = np.asarray(tried.column("vec_id")), _matrix(tried.column("vec").combine_chunks(), dim)
    if not len(ids):
        return Bounds(p.probe_ratio, p.probe_rows, p.search_beam)
    shared = rows.sparkSession.sparkContext.broadcast((ids, x))     # at most ``tried`` rows

    def exact(batches):
        ids, x = shared.value
        got = None
        for b in batches:
            for a in range(0, b.num_rows, p.block_rows):
                part = b.slice(a, p.block_rows)
                new = best_of_block(x, ids, _matrix(part.column("vec"), dim), np.asarray(part.column("vec_id")), k)
                got = best_of_all(*(np.concatenate(c) for c in zip(*([got] if got else []), new)), k)
        if got:
            yield pa.RecordBatch.from_arrays([pa.array(got[0], pa.int64()), pa.array(got[1], pa.int64()), pa.array(got[2], pa.float64())],
                                             names=["query_id", "near", "score"])

    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "near"))
    near = rows.select("vec_id", "vec").mapInArrow(exact, "query_id long, near long, score double").withColumn("r", rank).where(F.col("r") <= k)
    lists: dict[tuple, list[int]] = {}
    for r in posted.select("list", "vec_id").join(F.broadcast(near), F.col("near") == F.col("vec_id")).collect():   # tried x k x replicas
        lists.setdefault((r["query_id"], r["near"]), []).append(r["list"])
    of = [[own for (q, _), own in lists.items() if q == i] for i in ids.tolist()]
    return needed(graph, np.column_stack([x, np.zeros(len(x))]), sizes, of, p)


def _head(head: DataFrame, queries: DataFrame, found: DataFrame, n_head: int, k: int, scratch: Scratch, p: Params):
    """(query, list) pairs and blocks of the vectors of largest norm, in lists by norm.

    A list takes part only where its largest norm times the query's reaches
    the query's k-th score so far: by the Cauchy-Schwarz inequality no vector
    of another list can be among the k best.
    """
    n_lists = max(1, -(-n_head // p.block_rows))
    placed = scratch.store(head.repartitionByRange(n_lists, F.desc("norm"), "vec_id").withColumn("list", F.spark_partition_id()), "head")
    # a list of ties may be longer than a block: it is cut as any other
    counts = placed.groupBy("list").agg(F.count("*").alias("n"), F.max("norm").alias("top")).orderBy("list").collect()   # one row per list
    numbers, tops = np.array([r["list"] for r in counts], dtype=np.int32), np.sqrt([r["top"] for r in counts])
    parts = head.sparkSession.createDataFrame([(r["list"], -(-r["n"] // p.block_rows)) for r in counts], "l int, parts int")
    blocks = scratch.store(_blocks(placed.join(F.broadcast(parts), F.col("list") == F.col("l")), F.pmod(F.xxhash64("vec_id"), F.col("parts"))),
                           "head-blocks")
    least = found.groupBy(F.col("query_id").alias("q")).agg(F.min("score").alias("kth"), F.count("*").alias("n_found"))
    asked = queries.join(least, F.col("vec_id") == F.col("q"), "left").select(
        "vec_id", "norm", F.when(F.col("n_found") == k, F.col("kth")).otherwise(F.lit(float("-inf"))).alias("kth"))

    def reach(batches):
        for b in batches:
            norm, kth = np.sqrt(np.asarray(b.column("norm"))), np.asarray(b.column("kth"))
            # lists come by falling norm: a query takes the first few; the slack is more than rounding can add
            upto = np.array([np.searchsorted(-tops * x * (1 + 1e-9), -y, side="right") for x, y in zip(norm, kth)], dtype=np.int64)
            row = pa.array(np.repeat(np.arange(b.num_rows), upto))
            lists = np.concatenate([numbers[:m] for m in upto.tolist()]) if b.num_rows else numbers[:0]
            yield pa.RecordBatch.from_arrays([pa.array(lists, pa.int32()), b.column("vec_id").take(row)], names=["list", "vec_id"])

    return asked.mapInArrow(reach, "list int, vec_id long"), blocks
