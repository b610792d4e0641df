"""SimHash near-duplicates with covering locality-sensitive hashing.

Fingerprints within ``radius`` bits are found by structured masks: the bits are
dealt to the nonzero vectors of GF(2)^(radius+1), and the mask of a nonzero
vector v keeps the bits whose vector has odd inner product with v. Any
``radius`` vectors leave some v orthogonal to all of them, so two fingerprints
that differ in at most ``radius`` bits agree under at least one of the
2^(radius+1) - 1 masks: no link is missed. Equal fingerprints are merged
before the tables are built.

A bucket (mask, kept bits) that holds more than ``bucket`` fingerprints is cut
by a covering family of its own over the bits its mask left out, and so on.
The bits a bucket has fixed stay in the key of all buckets cut from it, and
every further mask fixes one bit more at least: since the bits run out, every
bucket becomes small, without a cap. Inside a small bucket fingerprints are
compared and only a spanning set of links leaves it, so no step emits all
pairs of a group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from retention.llm.batches import text_slices, utf8, with_columns
from retention.llm.common import Scratch, connected_components, with_groups

_BITS = 64


def fingerprint(text: bytes, size: int = 3) -> int:
    """Bit i is set if over half of the word shingles (repeats included) have bit i in their XXH64, seed 42."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < size:
        shingles = [b" ".join(words)]
    else:
        shingles = [b" ".join(s) for s in zip(*(words[i:] for i in range(size)))]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter([digest(s, 42) for s in shingles], dtype=np.uint64, count=len(shingles))
    counts = np.zeros(_BITS, dtype=np.int64)
    for a in range(0, len(h), 1 << 16):     # a long text in pieces: its bit matrix stays small
        part = np.ascontiguousarray(h[a:a + (1 << 16)].astype(">u8")).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(h)).tobytes(), "big")


def covering_masks(bits: list[int], radius: int) -> list[int]:
    """The masks over the given bit numbers, of which there are more than ``radius``.

    The unit vectors are dealt first: they span all vectors, so each mask keeps
    one bit at least, however few there are, and no two masks are equal.
    """
    n = (1 << (radius + 1)) - 1
    vectors = sorted(range(1, n + 1), key=lambda v: (v.bit_count() > 1, v))
    vector = {b: vectors[i % n] for i, b in enumerate(bits)}
    return [sum(1 << b for b in bits if (vector[b] & v).bit_count() % 2) for v in range(1, n + 1)]


def finer_masks(fixed: int, radius: int) -> list[int]:
    """The masks that cut a bucket whose ``fixed`` bits agree: these bits and those of a covering family over the others."""
    return [fixed | m for m in covering_masks([b for b in range(_BITS) if not fixed >> b & 1], radius)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _spanning_links(groups: list[np.ndarray], radius: int) -> tuple[list[int], list[int]]:
    """For each small group, links (member, component's first member) of its closeness graph."""
    left, right = [], []
    for fps in groups:
        fps = np.unique(fps)
        low = np.arange(len(fps))
        near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
        while True:
            new = np.where(near, low[None, :], len(fps)).min(axis=1)
            new = new[new]
            if (new == low).all():
                break
            low = new
        moved = np.flatnonzero(low != np.arange(len(fps)))
        left += fps[moved].astype(np.int64).tolist()
        right += fps[low[moved]].astype(np.int64).tolist()
    return left, right


def close_links(fps: DataFrame, radius: int, scratch: Scratch, bucket: int = 128) -> DataFrame:
    """Links (``a``, ``b``) whose connected components are those of "at most ``radius`` bits apart".

    ``fps`` has distinct fingerprints ``fp`` (long). See the module text for buckets.
    """
    def cut(batches):
        families: dict[int, np.ndarray] = {}
        for b in batches:
            fp, fixed = (np.asarray(b.column(c)) for c in ("fp", "fixed"))
            for f in np.unique(fixed).tolist():
                if f not in families:
                    families[f] = np.array([_signed(m) for m in finer_masks(f & (1 << _BITS) - 1, radius)], dtype=np.int64)
                own, masks = fp[fixed == f], families[f]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(own, len(masks))), pa.array(np.tile(masks, len(own)))],
                                                 names=["fp", "fixed"])

    def span(batches):
        for b in batches:
            groups = [np.asarray(g, dtype=np.int64).view(np.uint64) for g in b.column("members").to_pylist()]
            left, right = _spanning_links(groups, radius)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    first = F.array(*[F.lit(_signed(m)) for m in finer_masks(0, radius)])
    rows = fps.select("fp", F.explode(first).alias("fixed"))
    # with radius free bits or fewer all members are close, and 2**radius at most
    hot = (F.col("n") > bucket) & (F.bit_count("fixed") < _BITS - radius)
    links, depth = [], 0
    while True:
        rows = scratch.store(rows.withColumn("kept", F.col("fp").bitwiseAND(F.col("fixed"))), f"table{depth}")
        shared = scratch.store(with_groups(rows, ["fixed", "kept"], [F.count("*").alias("n")], scratch, f"sizes{depth}", "n > 1"),
                               f"shared{depth}")
        scratch.drop(f"table{depth}", f"sizes{depth}")
        links.append(scratch.store(shared.where(~hot).groupBy("fixed", "kept").agg(F.collect_list("fp").alias("members"))
                                   .select("members").mapInArrow(span, "a long, b long").distinct(), f"links{depth}"))
        level = shared.where(hot).select("fp", "fixed")
        if level.isEmpty():
            break
        # two masks may be made the same by different further ones
        rows = level.mapInArrow(cut, "fp long, fixed long").distinct()
        depth += 1
    out = links[0]
    for more in links[1:]:
        out = out.unionByName(more)
    return out


def near_duplicates(docs: DataFrame, size: int = 3, radius: int = 3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, fingerprint, component_id`` (and ``fp, tie, root``, long), one row per input row.

    Texts without words (null, empty, white space) have fingerprint zero and
    are linked like any other. ``component_id`` is the smallest id reachable
    over links, null if no row of the component has an id; repeated rows keep
    a row each; other columns are ignored; an empty table gives no rows.
    A group of copies of any size is one fingerprint from the first
    aggregation on, which adds up in every task before the shuffle.
    """
    scratch = Scratch(docs.sparkSession, "simhash")

    def run(batches):
        for b in text_slices(batches, "text"):
            fps = np.array([fingerprint(t, size) for t in utf8(b.column("text"))], dtype=np.uint64)
            yield with_columns(b, ["doc_id", "tie"], fp=pa.array(fps.view(np.int64), pa.int64()))

    rows = scratch.store(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), _tie(text))
                         .mapInArrow(run, "doc_id long, tie long, fp long"), "fingerprints")
    classes = scratch.store(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    links = close_links(classes, radius, scratch)
    parts = connected_components(links, scratch)
    root = scratch.store(classes.join(parts, F.col("fp") == F.col("node"), "left").select(
        F.col("fp").alias("f"), "first_id", F.coalesce("root", "fp").alias("root")), "roots")
    named = scratch.store(with_groups(root, ["root"], [F.min("first_id").alias("component_id")], scratch, "components")
                          .select("f", "component_id", "root"), "named")
    scratch.drop("classes", "roots", "components")
    return rows.join(named, F.col("fp") == F.col("f")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "fp", "tie", "root")


def _tie(text: str):
    return F.coalesce(F.xxhash64(text), F.lit(0)).alias("tie")


def one_of_each(docs: DataFrame, size: int = 3, radius: int = 3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the one of smallest id stays.

    Rows without an id come last, rows that share an id are ordered by their
    text's hash, and of rows equal in both one stays.
    """
    found = near_duplicates(docs, size, radius, text, key)
    # by root: components may share a smallest id where texts share an id, or have none
    stay = found.groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("none"), "doc_id", "tie")).alias("s")).select(
        F.coalesce("s.doc_id", F.lit(0)).alias("_s_id"), F.col("s.none").alias("_s_none"), F.col("s.tie").alias("_s_tie"))
    rows = docs.select(F.struct("*").alias("_row"), F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("_id"),
                       F.col(key).isNull().alias("_none"), _tie(text).alias("_tie"))
    rows = rows.join(stay, (F.col("_id") == F.col("_s_id")) & (F.col("_none") == F.col("_s_none"))
                     & (F.col("_tie") == F.col("_s_tie")))
    nth = F.row_number().over(Window.partitionBy("_id", "_none", "_tie").orderBy("_id"))
    return rows.withColumn("_nth", nth).where("_nth = 1").select("_row.*")
