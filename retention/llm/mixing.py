"""Mixing sources to target weights by Pfair windows and earliest deadline first.

Each source's documents (by id) are cut into blocks of ``block_bytes``. With a
target weight of p/D, block j (from 0) of a source is released at slot
floor(j*D/p) and due at ceil((j+1)*D/p). Handing each slot to the released
block with the earliest deadline keeps every source within one block of its
exact share at every moment. The weights are whole parts of a period of D
slots, so the schedule of one period is the schedule of all: it is folded once
with SQL array functions, and each row's slot follows from its block number by
arithmetic. Only DataFrame operations run.

A source that has run out leaves its slots empty; they are closed up, so the
others go on in proportion to their weights. No row is dropped or repeated.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from retention.llm.common import Scratch, running_totals, shuffle_partitions

#: One period: state c = blocks handed out by source, o = source of each slot so far.
_EDF = """
aggregate(sequence(0L, d - 1), named_struct('c', transform(parts, p -> 0L), 'o', cast(array() as array<int>)),
  (acc, t) -> named_struct(
    'c', transform(acc.c, (x, i) -> x + if(i = {pick}, 1L, 0L)),
    'o', array_append(acc.o, {pick})),
  acc -> acc.o)
"""
_PICK = """array_min(transform(
  filter(sequence(0, size(parts) - 1), i -> acc.c[i] < parts[i] and (acc.c[i] * d) div parts[i] <= t),
  i -> struct(((acc.c[i] + 1) * d + parts[i] - 1) div parts[i] as due, i as i))).i"""


def target_parts(sizes: DataFrame, weights: dict[str, float] | None, alpha: float, period: int, slots: int = 8) -> DataFrame:
    """(``src``, ``size``, ``parts``, ``d``): whole parts of the period by largest remainder, at least 1 each.

    ``weights`` names a weight per source (missing ones get the smallest
    given); None takes bytes ** ``alpha``. The period has ``period`` slots, or
    ``slots`` per source where that is more.
    """
    if weights:
        entry = F.create_map(*[F.lit(x) for k, w in weights.items() for x in (k, float(w))])
        weight = F.coalesce(F.element_at(entry, F.col("src")), F.lit(float(min(weights.values()))))
    else:
        weight = F.pow(F.col("size").cast("double"), F.lit(alpha))
    every = Window.partitionBy(F.lit(0))   # one row per source
    w = sizes.withColumn("w", weight).withColumn("k", F.count("*").over(every)).withColumn(
        "d", F.greatest(F.lit(period).cast("long"), F.col("k") * slots))
    exact = (F.col("d") - F.col("k")) * F.col("w") / F.sum("w").over(every)
    w = w.withColumn("exact", exact).withColumn("base", F.floor("exact").cast("long"))
    rank = F.row_number().over(every.orderBy((F.col("exact") - F.col("base")).desc(), "src"))
    left = F.col("d") - F.col("k") - F.sum("base").over(every)
    return w.select("src", "size", "d", (1 + F.col("base") + (rank <= left).cast("long")).alias("parts"))


def mix_documents(docs: DataFrame, weights: dict[str, float] | None = None, alpha: float = 0.5,
                  block_bytes: int = 1 << 16, period: int = 1000, slots: int = 8, max_sources: int = 10_000,
                  text: str = "text", key: str = "doc_id", source: str = "source") -> DataFrame:
    """``doc_id, source, size, tie, block, release, deadline, block_slot, start, copies, position``.

    One row per distinct (id, source, text); ``copies`` equal rows stand next
    to each other from ``position`` (gapless from 0 over all rows) on.
    A null source is a source of its own, named ``(null)``; a null text counts
    as empty; every row weighs its UTF-8 bytes plus 1; rows without an id come
    first; a text longer than a block takes several blocks of its source. An
    empty table gives an empty result. Weights are rounded to whole slots of a
    period of ``period`` slots (``slots`` per source with more sources than that). More than ``max_sources`` sources raise.
    A hot source is spread over range partitions by ``running_totals``.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mix")
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(source), F.lit("(null)")).alias("src"),
        F.coalesce(F.xxhash64(text), F.lit(0)).alias("tie"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("bytes"))
    units = rows.groupBy("doc_id", "src", "tie").agg(F.sum("bytes").alias("size"), F.count("*").alias("copies"))
    units = scratch.store(running_totals(units, ["doc_id", "tie"], {"size": "start"}, scratch, "ranged", by=["src"]),
                          "units")
    scratch.drop("ranged")
    sizes = scratch.store(units.groupBy("src").agg(F.sum("size").alias("size")), "sizes")
    if sizes.count() > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    parts = scratch.store(target_parts(sizes, weights, alpha, period, slots), "parts")
    table = parts.groupBy("d").agg(F.sort_array(F.collect_list(F.struct("src", "parts"))).alias("s")).select(
        "d", F.col("s.src").alias("srcs"), F.col("s.parts").alias("parts"))
    slots = table.select("srcs", F.posexplode(F.expr(_EDF.format(pick=_PICK))).alias("slot", "i")).select(
        F.element_at("srcs", F.col("i") + 1).alias("s_src"), "slot")
    nth = F.row_number().over(Window.partitionBy("s_src").orderBy("slot")) - 1
    slots = scratch.store(slots.withColumn("s_nth", nth), "slots")   # one row per slot of the period
    p = parts.select(F.col("src").alias("p_src"), "parts", "d")
    block = F.floor(F.col("start") / F.lit(block_bytes)).cast("long")
    rows = units.withColumn("block", block).join(F.broadcast(p), F.col("src") == F.col("p_src"))
    rows = rows.withColumn("nth", F.col("block") % F.col("parts")).join(
        F.broadcast(slots), (F.col("src") == F.col("s_src")) & (F.col("nth") == F.col("s_nth")))
    rows = rows.select(
        "doc_id", F.col("src").alias("source"), "size", "tie", "block",
        F.expr("(block * d) div parts").alias("release"), F.expr("((block + 1) * d + parts - 1) div parts").alias("deadline"),
        F.expr("(block div parts) * d + slot").alias("block_slot"), "start", "copies")
    out = scratch.store(running_totals(rows, ["block_slot", "start"], {"copies": "position"}, scratch, "ordered"), "mixed")
    scratch.drop("ordered", "units", "sizes", "parts", "slots")
    return out


def in_mixed_order(docs: DataFrame, mixed: DataFrame, text: str = "text", key: str = "doc_id",
                   source: str = "source") -> DataFrame:
    """The rows of ``docs`` with their own columns, range-partitioned and sorted in mixed order."""
    place = mixed.select(F.col("doc_id").alias("_m_id"), F.col("source").alias("_m_src"), F.col("tie").alias("_m_tie"),
                         F.col("position").alias("_m_position"))
    on = (docs[key].cast("long").eqNullSafe(place["_m_id"])
          & (F.coalesce(docs[source], F.lit("(null)")) == place["_m_src"])
          & (F.coalesce(F.xxhash64(docs[text]), F.lit(0)) == place["_m_tie"]))
    at = place["_m_position"]
    return (docs.join(place, on).repartitionByRange(shuffle_partitions(docs.sparkSession), at)
            .sortWithinPartitions(at).select(*[docs[c] for c in docs.columns]))


def with_position(docs: DataFrame, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``step``'s rows with ``position``, the place (gapless from 0) of each row in the written order of ``docs``.

    ``docs`` is a table read from files as ``in_mixed_order`` wrote it: part
    files are in the order of their numbers, rows in that of the file, however
    Spark packs files into tasks. ``step`` hands ``_file`` and ``_row`` on
    (columns of ``docs`` by these names are not seen).
    """
    rows = docs.select(*[c for c in docs.columns if c not in ("_file", "_row")], F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    part = F.regexp_extract("_file", r"part-(\d+)[^/]*$", 1).cast("long")
    before = Window.partitionBy(F.lit(0)).orderBy(part, "_file").rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("_file").agg(F.count("*").alias("n"))      # one row per part file
    files = files.select(F.col("_file").alias("_f"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    done = step(rows).join(F.broadcast(files), F.col("_file") == F.col("_f"))
    position = (F.col("_before") + F.col("_row")).alias("position")
    return done.select(*[c for c in done.columns if c not in ("_file", "_row", "_f", "_before")], position)
