"""Benchmark decontamination: a positional inverted index of the training texts, searched for phrases.

The index is stored in segments. A segment holds some texts (a long text is
cut between words, neighbouring pieces overlap), the distinct words of these,
and for each word the ascending list of its positions. The query side cuts
the benchmark items into windows of consecutive words. A window's words are
ordered by their count over the whole index, rarest first; the rarest word's
list, moved back by the word's place in the window, gives the candidate
starts, and each further word's list, moved back by its own place, is
intersected with what is left. What stays are exact phrase matches; with
``within`` a word may instead stand anywhere that close to the rarest one.

Items are searched in blocks of bounded size, each block against the whole
index; only a block is ever on the driver or broadcast.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retention.llm.batches import text_slices, utf8
from retention.llm.common import Scratch, running_totals

#: A-Z to lower case, every other ASCII character that is no letter or digit to a space
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 0x80 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))

#: words that neighbouring pieces of a long text share
OVERLAP = 64

SEGMENT = ("docs array<struct<uid: long, doc_id: long, n_words: long>>, uid array<long>, base array<long>, first array<long>, "
           "terms binary, counts binary, places binary")
MATCHES = "uid long, spans array<struct<a: long, b: long>>, items array<string>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


def pieces_of(text: bytes, size: int, overlap: int) -> Iterator[tuple[int, list[bytes], bool]]:
    """(number of the first word, words, whether it is the last) of pieces of about ``size`` bytes."""
    if len(text) <= size:
        yield 0, words_of(text), True
        return
    low, at, first, kept = text.translate(_WORDS), 0, 0, []
    while True:
        end = low.find(b" ", at + size)
        words = kept + low[at:end if end >= 0 else len(low)].split()
        at = end
        if end >= 0 and len(words) <= overlap:      # very long words: the piece goes on
            kept = words
            continue
        yield first, words, end < 0
        if end < 0:
            return
        kept = words[len(words) - overlap:]
        first += len(words) - len(kept)


def _ints(values, kind=np.int32) -> bytes:
    return np.asarray(values, dtype=kind).tobytes()


class _SegmentWriter:
    """Collects the words of texts one after the other; a free position after each keeps phrases inside a text."""

    def __init__(self):
        self.words, self.docs, self.pieces, self.holes = [], [], [], []

    def add(self, uid: int, first: int, words: list[bytes]) -> None:
        if words:
            self.pieces.append((uid, len(self.words) + len(self.holes), first))
            self.words += words
            self.holes.append(len(self.words))

    def row(self) -> dict:
        number: dict = defaultdict(count().__next__)
        term = np.fromiter(map(number.__getitem__, self.words), dtype=np.int32, count=len(self.words))
        place = np.arange(len(term), dtype=np.int32)
        place += np.searchsorted(np.asarray(self.holes, dtype=np.int32), place, side="right").astype(np.int32)
        uid, base, first = zip(*self.pieces) if self.pieces else ((), (), ())
        return {"docs": self.docs, "uid": uid, "base": base, "first": first, "terms": b" ".join(number),
                "counts": _ints(np.bincount(term, minlength=len(number))), "places": _ints(place[np.argsort(term, kind="stable")])}


def build_index(docs: DataFrame, scratch: Scratch, text: str = "text", key: str = "doc_id",
                segment_bytes: int = 1 << 22, overlap: int = OVERLAP) -> DataFrame:
    """The stored index of all whole texts, a row per segment (``SEGMENT``). One pass, nothing is shuffled.

    ``uid`` numbers the rows of the table (ids may be null or repeated); a row
    stands in ``docs`` once, with the word count of its whole text.
    """
    kind = pa.list_(pa.struct([("uid", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64())]))
    schema = pa.schema([("docs", kind), *((n, pa.list_(pa.int64())) for n in ("uid", "base", "first")),
                        *((n, pa.binary()) for n in ("terms", "counts", "places"))])

    def run(batches):
        uids = count(TaskContext.get().partitionId() << 40)
        for b in text_slices(batches, "text", segment_bytes):
            out = _SegmentWriter()
            for doc_id, uid, t in zip(b.column("doc_id").to_pylist(), uids, utf8(b.column("text"))):
                for first, words, last in pieces_of(t, segment_bytes, overlap):
                    out.add(uid, first, words)
                    if last:
                        out.docs.append({"uid": uid, "doc_id": doc_id, "n_words": first + len(words)})
                    elif out.words:
                        yield pa.RecordBatch.from_pylist([out.row()], schema)
                        out = _SegmentWriter()
            yield pa.RecordBatch.from_pylist([out.row()], schema)

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, SEGMENT)
    return scratch.store(rows, "index")


class Windows:
    """The distinct windows of a block of items, with their words by corpus frequency, rarest first."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        number: dict = defaultdict(count().__next__)
        owners: dict[tuple, set[str]] = {}
        for item, words in items:
            ids = tuple(map(number.__getitem__, words.split()))
            for i in range(max(1, len(ids) - window + 1)):
                owners.setdefault(ids[i:i + window], set()).add(item)
        self.vocabulary = list(number)
        self.owners = [sorted(x) for x in owners.values()]
        self.length = np.fromiter(map(len, owners), dtype=np.int64, count=len(owners))
        self.words = np.full((len(owners), window), -1, dtype=np.int64)
        for row, ids in zip(self.words, owners):
            row[:len(ids)] = ids
        self.order = np.empty_like(self.words)

    def rank(self, frequency: np.ndarray) -> None:
        """Orders each window's words; windows with a word that the index lacks are dropped."""
        filled = self.words >= 0
        n = np.where(filled, frequency[self.words], np.iinfo(np.int64).max)
        live = np.flatnonzero((n > 0).all(axis=1))
        self.owners = [self.owners[i] for i in live.tolist()]
        self.words, self.length = self.words[live], self.length[live]
        self.order = np.argsort(n[live], axis=1, kind="stable")


class Segment:
    """A segment's lists, and the words of ``vocabulary`` among them."""

    def __init__(self, row: dict, vocabulary: list[bytes]):
        self.uid, self.base, self.first = (np.asarray(row[n], dtype=np.int64) for n in ("uid", "base", "first"))
        counts = np.frombuffer(row["counts"], dtype=np.int32).astype(np.int64)
        self.places = np.frombuffer(row["places"], dtype=np.int32).astype(np.int64)
        number = {t: i for i, t in enumerate(row["terms"].split())}
        self.local = np.fromiter((number.get(w, -1) for w in vocabulary), dtype=np.int64, count=len(vocabulary))
        self.counts, self.begin = counts, np.cumsum(counts) - counts
        #: one ascending key per posting: word, then position; the gap above each word's last keeps moved places apart
        self.span = int(self.places.max(initial=0)) + 4 * OVERLAP
        self.keys = np.repeat(np.arange(len(counts)), counts) * self.span + self.places

    def holds(self, term: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each word stands at a place from ``low`` to ``high``, and the first such place."""
        at = np.minimum(np.searchsorted(self.keys, term * self.span + low), len(self.keys) - 1)
        place = self.keys[at] - term * self.span
        return (place >= low) & (place <= high), place

    def matches(self, w: Windows, within: int | None = None, most: int = 1 << 21) -> tuple[np.ndarray, ...]:
        """(window, first place, last place) of all matches; ``most`` bounds the candidates held at a time."""
        found = [(np.empty(0, dtype=np.int64),) * 3]
        if len(self.keys) and len(w.words):
            term = np.where(w.words >= 0, self.local[w.words], 0)
            live = np.flatnonzero((term >= 0).all(axis=1))
            rarest = w.order[live, 0]
            n = self.counts[term[live, rarest]]
            run = np.cumsum(n) // most
            for part in np.split(np.arange(len(live)), np.flatnonzero(np.diff(run)) + 1):
                if len(part):
                    found.append(self._intersect(w, term, live[part], rarest[part], n[part], within))
        return tuple(map(np.concatenate, zip(*found)))

    def _intersect(self, w, term, rows, rarest, n, within):
        window = np.repeat(rows, n)
        inner = np.arange(len(window)) - np.repeat(np.cumsum(n) - n, n)
        anchor = self.places[np.repeat(self.begin[term[rows, rarest]], n) + inner]
        first = last = anchor
        if within is None:
            first = anchor - np.repeat(rarest, n)
        else:
            piece = np.searchsorted(self.base, anchor, side="right") - 1
            lower = np.maximum(anchor - within, self.base[piece])
            upper = np.minimum(anchor + within, np.append(self.base[1:] - 2, self.span)[piece])
        for j in range(1, w.words.shape[1]):
            more = j < w.length[window]
            k = w.order[window, j]
            low, high = (first + k,) * 2 if within is None else (lower, upper)
            good, place = self.holds(term[window, k], low, high)
            if within is not None:
                first, last = (np.where(more, f(x, place), x) for f, x in ((np.minimum, first), (np.maximum, last)))
            keep = good | ~more
            window, first, last = window[keep], first[keep], last[keep]
            if within is not None:
                lower, upper = lower[keep], upper[keep]
        return window, first, first + w.length[window] - 1 if within is None else last


def merged(a: np.ndarray, b: np.ndarray) -> list[dict]:
    """The union of word spans (both ends in) as spans that lie apart, ascending."""
    order = np.argsort(a, kind="stable")
    a, b = a[order], np.maximum.accumulate(b[order])
    head = np.flatnonzero(np.append(True, a[1:] > b[:-1] + 1))
    tail = np.append(head[1:], len(a)) - 1
    return [{"a": x, "b": y} for x, y in zip(a[head].tolist(), b[tail].tolist())]


def item_blocks(items: DataFrame, scratch: Scratch, window: int, block_bytes: int, text: str, key: str) -> DataFrame:
    """Distinct pieces of the items' words (``item``, ``words``) with the number of their ``block``, stored.

    A long item is cut into pieces that share ``window - 1`` words, so that each window stands whole in one.
    """
    def cut(batches):
        for b in text_slices(batches, "text"):
            rows = [(i or "", b" ".join(words)) for i, t in zip(b.column("item").to_pylist(), utf8(b.column("text")))
                    for first, words, _ in pieces_of(t, max(1 << 10, block_bytes // 16), window - 1)
                    if len(words) >= (window if first else 1)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())],
                                             names=["item", "words"])

    pieces = (items.select(F.col(key).cast("string").alias("item"), F.col(text).alias("text"))
              .mapInArrow(cut, "item string, words binary").distinct()
              .withColumn("size", F.octet_length("words").cast("long") + 64).withColumn("digest", F.xxhash64("words")))
    placed = running_totals(pieces, ["item", "digest"], {"size": "at"}, scratch, "items")
    return scratch.store(placed.select("item", "words", F.floor(F.col("at") / block_bytes).alias("block")), "blocks")


def search(index: DataFrame, items: DataFrame, scratch: Scratch, window: int = 10, within: int | None = None,
           block_bytes: int = 1 << 20, text: str = "text", key: str = "item_id") -> DataFrame:
    """The matches of all windows of all items: ``MATCHES``, a row per index piece (and block) with one.

    ``spans`` are the word numbers covered in the whole text, ``items`` the
    ids of the items met, as strings. ``within`` (at most ``OVERLAP // 2``)
    asks for the window's words, in any order, each at most so many words from
    the rarest; without it a match is the exact phrase.
    """
    if within is not None and not 0 < 2 * within <= OVERLAP or window > OVERLAP:
        raise ValueError(f"windows of up to {OVERLAP} words and distances of up to {OVERLAP // 2} are supported")
    spark = index.sparkSession
    blocks = item_blocks(items, scratch, window, block_bytes, text, key)
    out = []
    # a block holds about ``block_bytes`` of words: its rows, vocabulary and windows are bounded by that
    for block in sorted(r[0] for r in blocks.select("block").distinct().collect()):
        w = Windows([(r["item"], bytes(r["words"])) for r in blocks.where(F.col("block") == block).collect()], window)
        vocabulary = spark.sparkContext.broadcast(w.vocabulary)

        def occurrences(batches, vocabulary=vocabulary):
            total = np.zeros(len(vocabulary.value), dtype=np.int64)
            for b in batches:
                for terms, counts in zip(b.column("terms").to_pylist(), b.column("counts").to_pylist()):
                    n = dict(zip(terms.split(), np.frombuffer(counts, dtype=np.int32).tolist()))
                    total += np.fromiter((n.get(x, 0) for x in vocabulary.value), dtype=np.int64, count=len(total))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["word", "n"])

        frequency = np.zeros(len(w.vocabulary), dtype=np.int64)
        for r in index.select("terms", "counts").mapInArrow(occurrences, "word long, n long").groupBy("word").agg(F.sum("n")).collect():
            frequency[r[0]] = r[1]
        w.rank(frequency)
        shared = spark.sparkContext.broadcast(w)

        def find(batches, shared=shared):
            w = shared.value
            for b in batches:
                for row in b.to_pylist():
                    s = Segment(row, w.vocabulary)
                    win, a, z = s.matches(w, within)
                    piece = np.searchsorted(s.base, a, side="right") - 1
                    order = np.argsort(piece, kind="stable")
                    rows = []
                    for part in np.split(order, np.flatnonzero(np.diff(piece[order])) + 1):
                        if len(part):
                            p = piece[part[0]]
                            move = s.first[p] - s.base[p]
                            rows.append({"uid": int(s.uid[p]), "spans": merged(a[part] + move, z[part] + move),
                                         "items": sorted(set().union(*(w.owners[i] for i in np.unique(win[part]).tolist())))})
                    yield pa.RecordBatch.from_pylist(rows, _MATCHES)

        name = f"matches-{block}"
        scratch.store(index.select("uid", "base", "first", "terms", "counts", "places").mapInArrow(find, MATCHES), name)
        out.append(scratch.path(name))
    return spark.read.schema(MATCHES).parquet(*out) if out else spark.createDataFrame([], MATCHES)


_MATCHES = pa.schema([("uid", pa.int64()), ("spans", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
                      ("items", pa.list_(pa.string()))])


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, within: int | None = None, block_bytes: int = 1 << 20,
                  segment_bytes: int = 1 << 22, text: str = "text", key: str = "doc_id", item_text: str = "text",
                  item_key: str = "item_id") -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans, items``, one row per document row.

    ``n_hit`` counts the words inside any match, ``spans`` are these words'
    numbers, ``items`` the distinct ids of the items met, sorted as strings.
    A null or empty text has no words; an item without words has no window, a
    shorter item than a window is one; a null item id counts as an empty
    string; items that share an id are one item of several texts. Repeated rows and
    null ids keep their rows; other columns are ignored; without items nothing
    is hit, without documents there are no rows.
    """
    scratch = Scratch(docs.sparkSession, "postings")
    index = build_index(docs, scratch, text, key, segment_bytes)
    found = search(index, items, scratch, window, within, block_bytes, item_text, item_key)
    # a row per piece and block with a match: the lists of one text together
    met = found.groupBy("uid").agg(F.flatten(F.collect_list("spans")).alias("spans"),
                                   F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))

    def close(batches):
        for b in batches:
            rows = []
            for r in b.to_pylist():
                a, z = (np.array([s[n] for s in r["spans"]], dtype=np.int64) for n in ("a", "b"))
                spans = merged(a, z)
                rows.append({"uid": r["uid"], "n_hit": sum(s["b"] - s["a"] + 1 for s in spans), "spans": spans, "items": r["items"],
                             "items_sha256": hashlib.sha256(",".join(r["items"]).encode()).hexdigest()})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([
                _MATCHES.field("uid"), ("n_hit", pa.int64()), _MATCHES.field("spans"), _MATCHES.field("items"), ("items_sha256", pa.string())]))

    hits = scratch.store(met.mapInArrow(
        close, "uid long, n_hit long, spans array<struct<a: long, b: long>>, items array<string>, items_sha256 string"
    ).withColumnRenamed("uid", "u"), "hits")
    rows = index.select(F.explode("docs").alias("d")).select("d.*")
    return rows.join(hits, rows["uid"] == hits["u"], "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"), "spans", "items")


def decontaminate_sql(window: int = 10) -> str:
    """DuckDB SQL for the rows of ``decontaminate`` (without ``spans`` and ``items``)."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = (f"regexp_extract_all(translate(coalesce(text, ''), '{letters.upper()}', '{letters}'), "
             r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
    return f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
        i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {words} AS w FROM benchmark),
        win AS (SELECT DISTINCT item, w[s:s + {window - 1}] AS win
                FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {window - 2}, 2))) AS s FROM i WHERE len(w) > 0)),
        occ AS (SELECT r, s, n, w[s:s + n - 1] AS win FROM (
                SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT len(win) AS n FROM win) WHERE len(w) >= n)),
        hit AS (SELECT r, s, n, item FROM occ JOIN win USING (win)),
        n_hit AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(s, s + n)) AS p FROM hit) GROUP BY r),
        met AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM d LEFT JOIN n_hit USING (r) LEFT JOIN met USING (r)"""
