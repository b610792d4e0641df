"""Sharding by a minimax contiguous partition.

Equal texts form one atomic group. The groups are laid in a line (by their
smallest id, then digest); the smallest capacity for which a greedy left-to-right
walk fits the line into ``n_shards`` pieces is found by binary search, and the
line is cut there. Only DataFrame operations run; what the driver holds of the
line is bounded (see ``Line``).
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retention.llm.common import Scratch, running_totals, with_groups


class Line:
    """Group ends on the line, known to the driver by ranges: (first end, last end, how many) of each.

    A look-up "last end up to x" is exact unless x falls inside a range of
    more than two ends; ``refine`` has Spark split such ranges. The driver
    never holds more than a few times ``limit`` ranges, whatever the table.
    """

    def __init__(self, ends: DataFrame, total: int, limit: int = 20_000):
        self.ends, self.limit = ends, limit
        self.ranges: list[tuple[int, int, int]] = []
        self._split([(1, total)])

    def _split(self, hit: list[tuple[int, int]]) -> None:
        parts = max(2, self.limit // len(hit))
        spans: list[list[int]] = []         # the ranges joined where they touch: what the scan has to read
        for a, b in hit:
            if spans and a - spans[-1][1] <= 1:
                spans[-1][1] = b
            else:
                spans.append([a, b])
        end = F.col("end")
        number = F.size(F.filter(F.lit([a for a, _ in hit]), lambda a: a <= end))
        rows = (self.ends.where(reduce(or_, [end.between(a, b) for a, b in spans]))
                .select("end", number.alias("range"))
                .withColumn("part", F.floor((end - F.element_at(F.lit([a for a, _ in hit]), F.col("range")))
                                            / F.element_at(F.lit([-(-(b - a + 1) // parts) for a, b in hit]), F.col("range"))))
                .groupBy("range", "part").agg(F.min("end"), F.max("end"), F.count("*")).collect())
        gone = set(hit)
        self.ranges = sorted([r for r in self.ranges if (r[0], r[1]) not in gone] + [(r[2], r[3], r[4]) for r in rows])
        self.first = [r[0] for r in self.ranges]

    def bounds(self, x: int) -> tuple[int, int]:
        """Bounds of the last end up to x (0 if there is none); equal if it is known."""
        i = bisect_right(self.first, x) - 1
        if i < 0:
            return 0, 0
        a, b, n = self.ranges[i]
        return (b, b) if b <= x else (a, a) if n <= 2 else (a, x)

    def greedy(self, capacity: int, n_shards: int) -> list[tuple[int, int]]:
        """Bounds of each cut of the greedy walk with this capacity."""
        low = high = 0
        out = []
        for _ in range(n_shards - 1):
            low, high = self.bounds(low + capacity)[0], self.bounds(high + capacity)[1]
            out.append((low, high))
        return out

    def refine(self, spans: list[tuple[int, int]]) -> bool:
        """Splits the ranges that overlap a span and are not fully known; False if there are none."""
        hit = [(r[0], r[1]) for r in self.ranges if r[2] > 2 and any(r[0] <= b and a <= r[1] for a, b in spans)]
        if hit:
            self._split(hit)
        return bool(hit)


def smallest_capacity(ends: DataFrame, total: int, largest: int, n_shards: int, limit: int = 20_000) -> tuple[int, list[int]]:
    """The smallest feasible capacity by binary search, and the cuts of its greedy walk.

    ``ceil(total / n) + largest`` is always feasible and nothing below
    ``max(ceil(total / n), largest)`` is. While some capacities are neither
    surely feasible nor surely not, the ranges that their walks meet are refined.
    """
    line = Line(ends, total, limit)
    low, high = max(-(-total // n_shards), largest), -(-total // n_shards) + largest

    def last(capacity: int) -> tuple[int, int]:
        return line.greedy(capacity, n_shards)[-1] if n_shards > 1 else (0, 0)

    while True:
        every = range(low, high + 1)
        surely = low + bisect_left(every, True, key=lambda c: last(c)[0] + c >= total)
        maybe = low + bisect_left(every, True, key=lambda c: last(c)[1] + c >= total)
        low, high = maybe, min(high, surely)
        walk = list(zip(line.greedy(low, n_shards), line.greedy(high, n_shards)))
        if not line.refine([(a[0], b[1] + 1) for a, b in walk if low < high or a[0] < b[1]]):
            return high, [a for a, _ in line.greedy(high, n_shards)]


def shard_documents(docs: DataFrame, n_shards: int = 16, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, capacity``, one row per input row.

    Law ``bytes``: the largest shard is as small as any contiguous cut of whole
    groups allows. A null text counts as a group of its own with size 1 and
    CRC 0; rows without an id come first; repeated rows each keep a slot; an
    empty table gives an empty result. Other columns are ignored.
    A hot group is one atom by contract, yet its rows are spread over range
    partitions, and only (id, size, digest) is shuffled, never a text.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "shards")
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col(text).cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(F.unhex(F.sha2(text, 256)), F.lit(b"null")).alias("group"))
    rows = scratch.store(rows, "rows")      # texts are read and hashed once
    placed = with_groups(rows, ["group"], [F.min("doc_id").alias("first_id")], scratch, "first").withColumn("one", F.lit(1))
    line = scratch.store(running_totals(placed, ["first_id", "group", "doc_id"],
                                        {"size": "start", "one": "index"}, scratch, "ranged"), "line")
    scratch.drop("ranged", "rows", "first")
    ends = line.groupBy("group").agg(F.max(F.col("start") + F.col("size")).alias("end"), F.sum("size").alias("bytes"),
                                     (F.max("index") + 1).alias("rows"))
    ends = scratch.store(ends.repartitionByRange("end").sortWithinPartitions("end"), "ends")
    total, largest = ends.agg(F.max("end"), F.max("bytes")).first()
    capacity, cuts = smallest_capacity(ends, total, largest, n_shards) if total else (0, [])
    rows_at = {r["end"]: r["rows"] for r in ends.where(F.col("end").isin(cuts or [0])).collect()} | {0: 0}
    scratch.drop("ends")
    shard = sum(((F.col("start") >= c).cast("int") for c in cuts), F.lit(0))
    begin = F.element_at(F.array(*[F.lit(int(rows_at[c])).cast("long") for c in [0, *cuts]]), F.col("shard") + 1)
    return line.withColumn("shard", shard).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("index") - begin).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        F.lit(capacity).cast("long").alias("capacity"))
