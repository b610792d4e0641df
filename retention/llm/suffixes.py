"""Suffix-array removal of repeated byte strings.

A byte is removed if a string of ``length`` bytes that covers it also starts
earlier (in a document of smaller id, or earlier in the same one).

1. Equal texts are reduced to their first document.
2. Anchors: in every window of ``length`` bytes the ``GRAM``-byte gram with the
   smallest hash is chosen. Equal strings choose equal grams, so a string can
   only repeat where its anchor does. Runs of windows with one anchor are the
   segments; those of anchors that occur once are done with.
3. A segment's bytes are a piece. Equal pieces are merged (first place kept).
4. Pieces go to shards by anchor, a hot anchor to several. Each shard builds
   its suffix array by Larsson-Sadakane refinement and the common prefixes by
   Kasai's walk; runs with common prefixes of at least ``length`` are the
   equal strings, whose first place stays.
5. Strings of hot anchors are merged across their shards: each shard's sorted
   strings are looked up by binary search among those of all.

No step pairs documents, and what a task holds is bounded by one text or one
shard (a piece has at most ``_PIECE`` windows). Comparisons that decide are made on bytes (equal whole texts and
pieces: on SHA-256).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retention.llm.batches import text_slices, utf8, with_columns
from retention.llm.common import Scratch, shuffle_partitions, with_groups

GRAM = 32
_LAST = (1 << 63) - 1
_MULTIPLIERS = tuple(np.uint64(x) for x in (
    0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))
_POSITION_BITS = 23     # the lowest bits of an anchor's rank; texts are walked in chunks that they can number
_CHUNK = 1 << 22        # bytes of a chunk of a long text, half of what the bits can number
_PIECE = 1 << 16        # windows of a piece, at most
_SLICE = 1 << 18        # texts handled together, in bytes: what fits a core's cache


def packed_words(buf: np.ndarray, n: int, big: bool) -> np.ndarray:
    """The 8 bytes from every offset as one number; ``buf`` has 8 spare bytes at its end."""
    view = np.ndarray((n,), dtype=">u8" if big else "<u8", buffer=buf, strides=(1,))
    return view.astype(np.uint64)


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of ``width`` values, from block-wise prefix and suffix minima."""
    n = len(v)
    pad = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    pad[:n] = v
    rows = pad.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def segments(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """Segments of several texts: (text number, anchor hash, first window, last window, several places).

    Neighbouring segments with the same hash (as in a run of one character)
    are one segment that counts as two places. Together the texts have at most ``2 ** _POSITION_BITS`` bytes.
    """
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(texts) else 0
    empty = tuple(np.zeros(0, dtype=t) for t in (np.int64, np.uint64, np.int64, np.int64, bool))
    if total < length:
        return empty
    buf = np.frombuffer(b"".join(texts) + bytes(GRAM + 8), dtype=np.uint8)
    words = packed_words(buf, total + GRAM, big=False)
    grams = total - GRAM + 1
    h = words[:grams] * _MULTIPLIERS[0]
    for k in range(1, GRAM // 8):
        h += (words[8 * k:8 * k + grams] ^ (words[8 * k:8 * k + grams] >> np.uint64(31))) * _MULTIPLIERS[k]
    h ^= h >> np.uint64(32)
    h *= _MULTIPLIERS[1]
    h ^= h >> np.uint64(29)
    bits = np.uint64(_POSITION_BITS)
    # order by the hash's upper bits, ties to the left: the same choice wherever, and in however long a text, the same bytes stand
    rank = (h >> bits << bits) | np.arange(grams, dtype=np.uint64)
    at = (sliding_min(rank, length - GRAM + 1) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), sizes)[:len(at)]
    ok = np.arange(len(at)) + length <= ends[doc]
    start = np.flatnonzero(ok)
    if not len(start):
        return empty
    at, doc = at[start], doc[start]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    hashes, docs = h[at[first]], doc[first]
    joined = np.zeros(len(first), dtype=bool)
    joined[1:] = (hashes[1:] == hashes[:-1]) & (docs[1:] == docs[:-1]) & (start[first[1:]] == start[last[:-1]] + 1)
    head = np.flatnonzero(~joined)
    tail = np.append(head[1:], len(first)) - 1
    base = (ends - sizes)[docs[head]]
    return docs[head], hashes[head], start[first[head]] - base, start[last[tail]] - base, tail > head


def cut_segments(texts: list[bytes], length: int, chunk: int = _CHUNK, piece: int = _PIECE) -> tuple[np.ndarray, ...]:
    """``segments`` of texts of any size, none of more than ``piece`` windows.

    A long text is walked in chunks that share ``length - 1`` bytes, so each
    window lies in one. A segment is cut between windows: its parts have the
    same anchor, and each string still starts in one part.
    """
    if sum(map(len, texts)) <= 2 * chunk:
        found = segments(texts, length)
    else:
        parts = []
        for i, t in enumerate(texts):
            for a in range(0, max(1, len(t) - length + 1), chunk):
                _, h, s, e, many = segments([t[a:a + chunk + length - 1]], length)
                parts.append((np.full(len(h), i), h, s + a, e + a, many))
        found = tuple(map(np.concatenate, zip(*parts)))
    doc, h, s, e, many = found
    n = (e - s) // piece + 1
    if (n > 1).any():
        inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        doc, h, s, e, many = (np.repeat(x, n) for x in (doc, h, s, e, many))
        s = s + inner * piece
        e = np.minimum(e, s + piece - 1)
    return doc, h, s, e, many


def suffix_array(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, rank) by Larsson-Sadakane refinement: groups that are still tied after h bytes are
    sorted by the rank of the suffix h bytes on, h doubling. The end of the text sorts before every byte."""
    n = len(text)
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    buf = np.frombuffer(text + bytes(8), dtype=np.uint8)
    h = 7       # 7 bytes, each counted from 1 so that the end is 0: nine bits each in 63
    key = np.zeros(n, dtype=np.int64)
    for k in range(h):
        key <<= 9
        if n > k:
            key[:n - k] += buf[k:n].astype(np.int64) + 1
    sa = np.argsort(key, kind="stable")
    ordered = key[sa]
    start = np.ones(n, dtype=bool)
    start[1:] = ordered[1:] != ordered[:-1]
    group = np.maximum.accumulate(np.where(start, np.arange(n), 0))     # a group is named by its first slot
    rank = np.empty(n, dtype=np.int64)
    rank[sa] = group
    alone = start & np.append(start[1:], True)
    open_ = np.flatnonzero(~alone)      # slots of the groups that are not single
    while len(open_):
        pos, own = sa[open_], rank[sa[open_]]
        on = pos + h
        after = np.where(on < n, rank[np.minimum(on, n - 1)] + 1, 0)
        mixed = own * (n + 1) + after
        order = np.argsort(mixed, kind="stable")
        pos, mixed = pos[order], mixed[order]
        sa[open_] = pos
        start = np.ones(len(pos), dtype=bool)
        start[1:] = mixed[1:] != mixed[:-1]
        rank[pos] = open_[np.maximum.accumulate(np.where(start, np.arange(len(pos)), 0))]
        open_ = open_[~(start & np.append(start[1:], True))]
        h *= 2
    return sa, rank


def common_prefixes(text: bytes, sa: np.ndarray, cap: int, lane: int = 256) -> np.ndarray:
    """Common prefix (up to ``cap``) of each suffix and the one before it in the array, by Kasai's walk.

    The walk through the text drops at most one byte a step; lanes of ``lane``
    positions walk side by side.
    """
    n = len(text)
    if n < 2:
        return np.zeros(n, dtype=np.int64)
    buf = np.frombuffer(text + bytes(cap + 24), dtype=np.uint8)
    words = packed_words(buf, n + cap + 16, big=True)
    before = np.empty(n, dtype=np.int64)
    before[sa[1:]] = sa[:-1]
    before[sa[0]] = -1
    out = np.zeros(n, dtype=np.int64)
    heads = np.arange(0, n, lane)
    have = np.zeros(len(heads), dtype=np.int64)
    for step in range(min(lane, n)):
        i = heads + step
        if i[-1] >= n:
            i, have = i[:-1], have[:-1]
            heads = heads[:-1]
            if not len(i):
                break
        j = before[i]
        have = np.where(j < 0, 0, np.maximum(have - 1, 0))
        live = np.flatnonzero((j >= 0) & (have < cap))
        while len(live):
            diff = words[i[live] + have[live]] ^ words[j[live] + have[live]]
            same = np.full(len(live), 8, dtype=np.int64)
            apart = diff != 0
            # the highest nonzero byte tells how many leading bytes agree
            same[apart] = 7 - np.floor(np.log2(diff[apart].astype(np.float64))).astype(np.int64).clip(0, 63) // 8
            have[live] += same
            live = live[~apart]
            live = live[have[live] < cap]
        have = np.minimum(np.minimum(have, n - i), np.where(j < 0, 0, n - j)).clip(0, cap)
        out[i] = have
    lcp = out[sa]
    lcp[0] = 0
    return lcp


def repeated_starts(pieces: list[bytes], places: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Within one shard: (piece, offset) of the strings that start earlier in the shard, and of the first of each string.

    ``places`` orders the pieces by their first place. Pieces are joined with
    a zero byte between; strings lie wholly inside a piece, so it never takes part.
    """
    sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
    text = b"\0".join(pieces)
    begin = np.cumsum(sizes + 1) - sizes - 1
    owner = np.repeat(np.arange(len(pieces)), sizes + 1)
    sa, _ = suffix_array(text)
    run = np.cumsum(common_prefixes(text, sa, length) < length)
    piece = owner[sa]
    offset = sa - begin[piece]
    valid = offset + length <= sizes[piece]
    run, piece, offset = run[valid], piece[valid], offset[valid]
    place = places[piece] * (int(sizes.max()) + 1) + offset
    head = np.flatnonzero(np.append(True, run[1:] != run[:-1])) if len(run) else run
    least = np.repeat(np.minimum.reduceat(place, head), np.diff(np.append(head, len(run)))) if len(run) else run
    first = place == least
    return piece[~first], offset[~first], piece[first], offset[first]


def _by_owner(owner: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Spans per owner: (owner, begin, end)."""
    order = np.lexsort((start, owner))
    owner, start = owner[order], start[order]
    if not len(owner):
        return owner, start, start
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (start[1:] - start[:-1] > length)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(owner)) - 1
    return owner[head], start[head], start[tail] + length


class Repeats:
    """The job over one table; ``spans`` is its outcome by (``ord``, ``dg``), ``firsts`` the first of each text."""

    def __init__(self, docs: DataFrame, length: int = 100, shard_bytes: int = 1 << 19, text: str = "text", key: str = "doc_id"):
        if length < GRAM + 1:
            raise ValueError(f"strings under {GRAM + 1} bytes have no anchors")
        self.length, self.shard_bytes = length, shard_bytes
        self.scratch = Scratch(docs.sparkSession, "repeats")
        digest = F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
        self.rows = docs.select(
            F.coalesce(F.col(key).cast("long"), F.lit(_LAST)).alias("ord"), F.col(key).cast("long").alias("doc_id"),
            F.coalesce(F.col(text), F.lit("")).alias("text"), digest.alias("digest"))
        self._distinct()
        self._segments()
        self._pieces()
        self._shards()

    def _distinct(self) -> None:
        rows = self.rows.where(F.octet_length("text") >= self.length)
        first = rows.groupBy("digest").agg(F.min("ord").alias("ord"), F.first("text").alias("text"))
        self.texts = self.scratch.store(first.select("ord", self.tie(F.col("digest")).alias("dg"), "text"), "texts")

    @staticmethod
    def tie(digest):
        """Orders texts that share an id: the first 60 bits of the digest."""
        return F.conv(F.substring(F.hex(digest), 1, 15), 16, 10).cast("long")

    def _segments(self) -> None:
        length = self.length

        def find(batches):
            for b in text_slices(batches, "text", _SLICE):
                doc, h, s, e, many = cut_segments(utf8(b.column("text")), length)
                take = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [b.column("ord").take(take), b.column("dg").take(take), pa.array(h.view(np.int64)),
                     pa.array((s << 31 | e) * 2 + many)], names=["ord", "dg", "h", "place"])

        found = self.scratch.store(self.texts.mapInArrow(find, "ord long, dg long, h long, place long"), "anchors")
        segs = self.scratch.store(with_groups(found, ["h"], [F.sum(1 + F.col("place") % 2).alias("n")], self.scratch, "twice", "n > 1")
                                  .drop("n"), "segments")
        self.scratch.drop("anchors", "twice")
        by_doc = segs.groupBy(F.col("ord").alias("o"), F.col("dg").alias("d")).agg(
            F.sort_array(F.collect_list(F.struct("place", "h"))).alias("segs"))
        self.found = self.scratch.store(
            self.texts.join(by_doc, (F.col("ord") == F.col("o")) & (F.col("dg") == F.col("d")))
            .select("ord", "dg", "text", F.col("segs.place").alias("place"), F.col("segs.h").alias("h")), "found")
        self.scratch.drop("segments", "texts")

    def _pieces(self) -> None:
        length = self.length

        def cut(batches):
            for b in text_slices(batches, "text", 1 << 20):
                cols = {n: b.column(n).to_pylist() for n in ("ord", "dg", "place", "h")}
                out = {n: [] for n in ("h", "id", "ord", "dg", "s", "piece")}
                for i, t in enumerate(utf8(b.column("text"))):
                    for place, h in zip(cols["place"][i], cols["h"][i]):
                        s, e = place >> 32, place >> 1 & 0x7FFFFFFF
                        out["piece"].append(t[s:e + length])
                        out["s"].append(s)
                        out["h"].append(h)
                    n = len(cols["h"][i])
                    out["ord"] += [cols["ord"][i]] * n
                    out["dg"] += [cols["dg"][i]] * n
                out["id"] = [hashlib.sha256(p).digest()[:20] for p in out["piece"]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out["h"], pa.int64()), pa.array(out["id"], pa.binary()), pa.array(out["ord"], pa.int64()),
                     pa.array(out["dg"], pa.int64()), pa.array(out["s"], pa.int64()), pa.array(out["piece"], pa.binary())],
                    names=list(out))

        pieces = self.found.mapInArrow(cut, "h long, id binary, ord long, dg long, s long, piece binary")
        place = F.struct("ord", "dg", "s")
        self.pieces = self.scratch.store(
            pieces.groupBy("h", "id").agg(F.min(place).alias("first"), F.first("piece").alias("piece"), F.count("*").alias("n"))
            .select("h", "id", "first.*", "piece", "n", F.octet_length("piece").alias("size")), "pieces")
        again = self.pieces.where("n > 1").select(
            F.col("h").alias("h2"), F.col("id").alias("id2"), F.struct("ord", "dg", "s").alias("first"))
        # later places of a merged piece repeat as a whole; the places come again from the segments, without bytes
        sized = pieces.select("h", "id", "ord", "dg", "s", F.octet_length("piece").alias("size"))
        self.whole = self.scratch.store(
            sized.join(again, (F.col("h") == F.col("h2")) & (F.col("id") == F.col("id2")))
            .where(place != F.col("first")).select("ord", "dg", F.col("s").alias("a"), (F.col("s") + F.col("size")).alias("b")),
            "whole")

    def _shards(self) -> None:
        length, spark = self.length, self.texts.sparkSession
        total = self.pieces.agg(F.sum("size")).first()[0] or 0
        shards = max(shuffle_partitions(spark), -(-total // self.shard_bytes))
        hot = self.scratch.store(
            self.pieces.groupBy("h").agg(F.sum("size").alias("size")).where(F.col("size") > self.shard_bytes)
            .select(F.col("h").alias("hot"), F.ceil(F.col("size") / self.shard_bytes).alias("parts")), "hot")
        # broadcast only if Spark measures it as small
        placed = self.pieces.join(hot, F.col("h") == F.col("hot"), "left").withColumn(
            "part", F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64("id"), F.col("parts"))).otherwise(0))
        placed = placed.select(F.pmod(F.xxhash64("h", "part"), F.lit(shards)).alias("shard"), "ord", "dg", "s", "piece",
                               F.col("parts").isNotNull().alias("shared"))

        def solve(table: pa.Table) -> pa.Table:
            pieces = table.column("piece").to_pylist()
            ords, dgs, s = (np.asarray(table.column(n)) for n in ("ord", "dg", "s"))
            shared = np.asarray(table.column("shared"))
            places = np.empty(len(pieces), dtype=np.int64)
            places[np.lexsort((s, dgs, ords))] = np.arange(len(pieces))
            again, offset, head, at = repeated_starts(pieces, places, length)
            owner, a, b = _by_owner(again, offset, length)
            keep = shared[head]
            head, at = head[keep], at[keep]
            strings = [pieces[p][o:o + length] for p, o in zip(head.tolist(), at.tolist())]
            who = np.concatenate([owner, head])
            return pa.table({
                "ord": pa.array(ords[who]), "dg": pa.array(dgs[who]), "a": pa.array(np.concatenate([a, at]) + s[who]),
                "b": pa.array(np.concatenate([b, at + length]) + s[who]),
                "string": pa.array([None] * len(owner) + strings, pa.binary())})

        solved = self.scratch.store(placed.groupBy("shard").applyInArrow(
            solve, "ord long, dg long, a long, b long, string binary"), "solved")

        def merge(batches):
            """Looks the strings of the shards up in one sorted list; all but the first place of each repeat."""
            got = [b for b in batches if b.num_rows]
            if not got:
                return
            rows = pa.Table.from_batches(got)
            text = np.array(rows.column("string").to_pylist(), dtype=f"S{length}")
            # numpy drops trailing zero bytes on comparison, all strings have one length: this stays exact
            ords, dgs, a = (np.asarray(rows.column(n)) for n in ("ord", "dg", "a"))
            order = np.lexsort((a, dgs, ords, text))
            known = text[order]
            leads = order[np.searchsorted(known, text, side="left")]
            later = np.flatnonzero(leads != np.arange(len(text)))
            yield from rows.select(["ord", "dg", "a", "b"]).take(pa.array(later)).to_batches()

        shared = solved.where("string is not null")
        merged = shared.repartition(max(1, int(shards)), F.xxhash64("string")).mapInArrow(
            merge, "ord long, dg long, a long, b long")
        spans = self.whole.unionByName(solved.where("string is null").drop("string")).unionByName(merged)
        self.spans = self.scratch.store(spans.groupBy("ord", "dg").agg(
            F.sort_array(F.collect_list(F.struct("a", "b"))).alias("spans")), "spans")
        self.scratch.drop("pieces", "whole", "solved", "hot")


def _union(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for x in spans:
        a, b = x["a"], x["b"]
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def cut_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, out = 0, []
    for a, b in spans:
        out.append(text[at:a])
        at = b
    out.append(text[at:])
    return b"".join(out)


def remove_repeats(docs: DataFrame, length: int = 100, shard_bytes: int = 1 << 19, text: str = "text",
                   key: str = "doc_id") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256``, one row per input row.

    A null text counts as empty. Of rows with equal texts the one with the
    smallest id comes first; rows without an id come last; texts that share an
    id are ordered by digest; of rows equal in id and text one is the first.
    Texts shorter than ``length`` bytes stay whole. Other columns are ignored;
    an empty table gives no rows.
    """
    job = Repeats(docs, length, shard_bytes, text, key)
    slim = job.scratch.store(job.rows.select("ord", "doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"),
                                             F.monotonically_increasing_id().alias("uid")), "rows")
    rows = with_groups(slim, ["digest"], [F.min(F.struct("ord", "uid")).alias("first")], job.scratch, "first-rows")

    def cut(batches):
        for b in text_slices(batches, "text"):
            spans = [_union(s) for s in b.column("spans").to_pylist()]
            kept = [hashlib.sha256(cut_spans(t, s)).hexdigest() for t, s in zip(utf8(b.column("text")), spans)]
            yield with_columns(b, ["ord", "dg"], removed=pa.array([sum(y - x for x, y in s) for s in spans], pa.int64()),
                               parts=pa.array([len(s) for s in spans], pa.int64()), kept=kept)

    spans = job.spans.select(F.col("ord").alias("o"), F.col("dg").alias("g"), "spans")
    changed = job.scratch.store(
        job.found.join(spans, (F.col("ord") == F.col("o")) & (F.col("dg") == F.col("g")))
        .select("ord", "dg", "text", "spans").mapInArrow(cut, "ord long, dg long, removed long, parts long, kept string")
        .withColumnsRenamed({"ord": "o", "dg": "g"}), "changed")
    job.scratch.drop("found", "spans")
    rows = rows.withColumn("dg", Repeats.tie(F.col("digest"))).withColumn("later", F.struct("ord", "uid") != F.col("first"))
    rows = rows.join(changed, (F.col("ord") == F.col("o")) & (F.col("dg") == F.col("g")), "left")
    gone = F.col("later") & (F.col("n_bytes") >= length)
    return rows.select(
        "doc_id", "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(gone, 1).otherwise(F.coalesce("parts", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept", F.lower(F.hex("digest")))).alias("kept_sha256"))


def without_repeats(docs: DataFrame, length: int = 100, shard_bytes: int = 1 << 19, text: str = "text",
                    key: str = "doc_id") -> DataFrame:
    """``docs`` with repeated bytes cut out of its texts; every row and every other column stays.

    What is left of a character that was cut in two is dropped. Later copies of
    a whole text become empty; a null text stays null; rows equal in id and
    text are one document here and all keep the same rest.
    """
    job = Repeats(docs, length, shard_bytes, text, key)
    firsts = job.rows.groupBy("digest").agg(F.min("ord").alias("_first"))      # a row per text; what is joined to the rows is stored
    cuts = firsts.select("_first", Repeats.tie(F.col("digest")).alias("_tie"), F.col("digest").alias("_digest")).join(
        job.spans.select(F.col("ord").alias("_o"), F.col("dg").alias("_d"), "spans"),
        (F.col("_first") == F.col("_o")) & (F.col("_tie") == F.col("_d")), "left")
    cuts = job.scratch.store(cuts.select("_digest", "_first", F.col("spans").alias("_spans")), "cuts")
    job.scratch.drop("found", "spans")
    on = F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)) == F.col("_digest")
    later = F.coalesce(F.col(key).cast("long"), F.lit(_LAST)) != F.col("_first")
    rows = docs.join(cuts, on).withColumn("_later", later & (F.octet_length(text) >= length))
    columns = docs.columns
    keep = [c for c in columns if c != text]

    def cut(batches):
        for b in text_slices(batches, text):
            out = []
            for t, s, gone in zip(b.column(text).to_pylist(), b.column("_spans").to_pylist(), b.column("_later").to_pylist()):
                if t is not None and gone:
                    t = ""
                elif t is not None and s:
                    t = cut_spans(t.encode(), _union(s)).decode(errors="ignore")
                out.append(t)
            done = with_columns(b, keep, **{text: pa.array(out, b.column(text).type)})
            yield done.select(columns)

    return rows.select(*docs.columns, "_spans", "_later").mapInArrow(cut, docs.schema)


def repeats_sql(length: int = 100) -> str:
    """DuckDB SQL for the rows of ``remove_repeats`` (ids that are unique and not null): every string of every text, by its hex digits."""
    return f"""
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        parts AS (SELECT doc_id, a, substring(h, 2 * a + 1, 2 * (256 + {length - 1})) AS c FROM (
                  SELECT doc_id, h, unnest(range(0, length(h) // 2 - {length - 1}, 256)) AS a FROM d WHERE length(h) >= {2 * length})),
        strings AS (SELECT doc_id, a + q AS p, substring(c, 2 * q + 1, {2 * length}) AS g FROM (
                    SELECT doc_id, a, c, unnest(range(0, length(c) // 2 - {length - 1})) AS q FROM parts)),
        firsts AS (SELECT g, min(struct_pack(doc_id := doc_id, p := p)) AS f FROM strings GROUP BY g HAVING count(*) > 1),
        again AS (SELECT s.doc_id, s.p FROM strings s JOIN firsts USING (g) WHERE s.doc_id <> f.doc_id OR s.p <> f.p),
        runs AS (SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= {length} THEN 0 ELSE 1 END AS fresh FROM again),
        numbered AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM runs),
        spans AS (SELECT doc_id, min(p) AS a, max(p) + {length} AS b FROM numbered GROUP BY doc_id, run),
        gone AS (SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*)::BIGINT AS n_spans, list(a ORDER BY a) AS a, list(b ORDER BY a) AS b
                 FROM spans GROUP BY doc_id),
        kept AS (SELECT d.doc_id, h, n_removed, n_spans, CASE WHEN n_spans IS NULL THEN h ELSE array_to_string(list_transform(range(0, n_spans + 1),
                 lambda i: substring(h, 2 * (CASE WHEN i = 0 THEN 0 ELSE b[i] END) + 1,
                                     2 * ((CASE WHEN i = n_spans THEN length(h) // 2 ELSE a[i + 1] END) - (CASE WHEN i = 0 THEN 0 ELSE b[i] END)))), '') END AS rest
                 FROM d LEFT JOIN gone USING (doc_id))
        SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
               sha256(unhex(rest)) AS kept_sha256 FROM kept"""
