"""Row numbers and smallest rows without a window that sees a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from retention.functions.scalars import hash_long
from retention.session import materialize


def numbered(df: DataFrame, order: Sequence[str], by: Sequence[str] = (), name: str = "row_number") -> DataFrame:
    """``df`` with gapless numbers from 0 by ``order``, in each group of ``by`` on its own.

    Rows are range-partitioned by (``by``, ``order``), sorted and stored with
    their partition and their place in it. A group's rows are a run in each of
    its partitions, so a row's number is its place, less the place of the
    run's first row, plus the group's rows in earlier partitions: one small
    row per partition and group is joined. A group of any size is
    spread over as many partitions as its rows need. ``order`` should tell
    rows apart; rows that tie may be numbered either way.
    """
    keys = [*by, *order]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(
        df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
        .withColumns({"_part": F.spark_partition_id(), "_place": F.monotonically_increasing_id()}), "numbered")
    runs = materialize(placed.groupBy(*by, "_part").agg(F.min("_place").alias("_first"), F.count("*").alias("_n")), "runs")
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = runs.select(*[F.col(b).alias(f"_by_{b}") for b in by], F.col("_part").alias("_p"),
                        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    on = F.col("_part") == F.col("_p")
    for b in by:
        on = on & F.col(b).eqNullSafe(F.col(f"_by_{b}"))
    return placed.join(shift, on).select(*df.columns, (F.col("_place") + F.col("_shift")).alias(name))


def smallest_bound(df: DataFrame, k: int, key: str, seed: int, bits: int = 12, at_most: int = 4096) -> tuple[int, object] | None:
    """(hash, key) of the ``k``-th row by hash of the key and then by the key itself; None for ``k`` = 0.

    The range that holds the k-th hash is cut into ``2 ** bits`` equal ranges
    and these are counted, until at most ``at_most`` rows are left in it:
    each pass is one aggregation with map-side sums, and no row is sorted.
    Keys that share a whole 60-bit hash are ordered by themselves.
    """
    if k < 1:
        return None
    low, width, rest = 0, 60, k
    rows = df.select(F.col(key), hash_long(key, seed).alias("_hash"))
    while True:
        step = max(0, width - bits)
        inside = rows.where(F.col("_hash").between(low, low + (1 << width) - 1))
        counts = sorted(inside.groupBy(F.shiftright(F.col("_hash") - F.lit(low), step).alias("range")).count().collect())
        for place, n in counts:
            if rest <= n:
                break
            rest -= n
        else:
            raise ValueError(f"fewer than {k} rows")
        low, width = low + (place << step), step
        if n <= at_most or not width:
            break
    # at most ``at_most`` rows, or the rows of one 60-bit hash: distinct keys share it by chance alone
    last = rows.where(F.col("_hash").between(low, low + (1 << width) - 1)).orderBy("_hash", key).limit(rest).collect()[-1]
    return last["_hash"], last[key]
