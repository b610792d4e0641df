"""Helpers shared by the operators: stored tables, running totals, components."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from retention.session import checkpoint_dir

#: Words and ASCII lower-casing as the contracts define them. ``bytes.split()``
#: cuts at exactly \x20 and \x09-\x0D, ``bytes.lower()`` changes only A-Z.
SPACES = b" \t\n\r\x0b\x0c"

_CLEANUP = ("spark.sql.shuffleDependency.fileCleanup.enabled",
            "spark.sql.classic.shuffleDependency.fileCleanup.enabled")


class Scratch:
    """Tables of one operator run in the shared checkpoint folder.

    ``store`` writes a table and reads it back, which cuts the lineage: after a
    lost executor Spark starts again from the stored files. ``drop`` deletes
    tables that nothing needs any more. What a returned DataFrame still reads
    is never deleted here.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def store(self, df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
        kept = {k: self.spark.conf.get(k, None) for k in _CLEANUP}
        for k in _CLEANUP:  # shuffle files of a finished write are of no more use
            self.spark.conf.set(k, "true")
        try:
            df.write.mode("overwrite").option("compression", codec).parquet(self.path(name))
        finally:
            for k, v in kept.items():
                self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        jvm, jsc = self.spark._jvm, self.spark._jsc
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def running_totals(df: DataFrame, order: Sequence[str], totals: dict[str, str], scratch: Scratch,
                   name: str, by: Sequence[str] = ()) -> DataFrame:
    """Exclusive running sums over an order of any length, without one task that sees all rows.

    ``totals`` maps a value column to the name of its running sum. Rows are
    range-partitioned by (``by``, ``order``) and stored with their partition's
    number, summed inside each partition, and each partition is shifted by the
    sums of those before it (a table of one row per partition and ``by`` key).
    A hot ``by`` key is cut into as many ranges as its rows need. Rows that tie
    on the whole order may come in either order among themselves.
    """
    spark = df.sparkSession
    keys = [*by, *order]
    ranged = scratch.store(
        df.repartitionByRange(shuffle_partitions(spark), *keys).withColumn("_range", F.spark_partition_id()), name)
    inner = Window.partitionBy("_range", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("_range", *by).agg(*[F.sum(v).alias(v) for v in totals])
    shift = sums.select("_range", *by, *[
        F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"_before_{v}") for v in totals])
    shift = shift.select(F.col("_range").alias("_r"), *[F.col(b).alias(f"_by_{b}") for b in by],
                         *[f"_before_{v}" for v in totals])
    local = ranged.select("*", *[F.coalesce(F.sum(v).over(inner), F.lit(0)).alias(f"_local_{v}") for v in totals])
    on = F.col("_range") == F.col("_r")
    for b in by:
        on = on & F.col(b).eqNullSafe(F.col(f"_by_{b}"))
    joined = local.join(shift, on)
    return joined.select(*df.columns, *[
        (F.col(f"_local_{v}") + F.col(f"_before_{v}")).cast("long").alias(out) for v, out in totals.items()])


def with_groups(df: DataFrame, keys: Sequence[str], aggs: Sequence, scratch: Scratch, name: str, where: str | None = None) -> DataFrame:
    """The rows of a stored table with aggregates of their group (those of groups that meet ``where``).

    The aggregate is stored before the join. Both sides of the join then are
    plain exchanges, and Spark splits a partition that a hot key made large
    over several tasks; an aggregate that ends between exchange and sort
    would keep all rows of the key in one.
    """
    groups = df.groupBy(*keys).agg(*aggs)
    groups = scratch.store((groups.where(where) if where else groups).withColumnsRenamed({k: f"_of_{k}" for k in keys}), name)
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return df.join(groups, on).drop(*(f"_of_{k}" for k in keys))


def connected_components(edges: DataFrame, scratch: Scratch, max_rounds: int = 60) -> DataFrame:
    """Smallest node reachable for every node of ``edges`` (long columns ``a``, ``b``): (``node``, ``root``).

    Alternating large-star and small-star steps over DataFrames. Each step
    takes minima with map-side partial sums and joins them back, so a node
    with very many neighbours is neither collected nor expanded to pairs; a
    stored table ends each round, and the rounds grow with the logarithm of
    the number of nodes. Raises if ``max_rounds`` does not settle it.
    """
    def step(e: DataFrame, large: bool, name: str) -> DataFrame:
        # e: distinct pairs with a > b
        if large:
            side = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            side = e
        # stored: a node with very many neighbours is then split over tasks by the join
        low = scratch.store(side.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("n"), F.least("a", "m").alias("m") if large else F.col("m")), name)
        if large:   # every larger neighbour of n moves to the smallest neighbour of n
            moved = side.join(low, side["a"] == low["n"]).where(F.col("b") > F.col("n")).select(
                F.col("b").alias("a"), F.col("m").alias("b"))
        else:       # every smaller neighbour of n, and n itself, moves to the smallest one
            moved = side.join(low, side["a"] == low["n"]).where(F.col("b") != F.col("m")).select(
                F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
                low.select(F.col("n").alias("a"), F.col("m").alias("b")))
        return moved.where("a > b").distinct()

    def digest(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    cur = scratch.store(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .where("a > b").distinct(), "cc0")
    seen, last = digest(cur), "cc0"
    for i in range(1, max_rounds + 1):
        half = scratch.store(step(cur, True, "low-large"), f"cc{i}-large")
        cur = scratch.store(step(half, False, "low-small"), f"cc{i}")
        scratch.drop(last, f"cc{i}-large", "low-large", "low-small")
        now, last = digest(cur), f"cc{i}"
        if now == seen:
            roots = cur.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return cur.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
        seen = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
