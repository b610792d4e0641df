"""BPE encoding and decoding through a minimal acyclic transducer lexicon.

Spark counts the chunks (runs without ASCII white space) of the corpus. The
words of the most frequent ones are encoded once and compiled into a minimal
acyclic automaton: states with equal futures are shared, and the numbers on
the edges add up to a word's ordinal, which points at its ids. The compiled
arrays lie in one file that Spark ships to the executors, where tasks
memory-map it. Words that the lexicon lacks are merged exactly by rank. A
text's ids are those of its chunks in a row, as neither the normalizer nor the
pre-tokenizer of the vocabulary joins anything across white space.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import os
import re
import tempfile
from collections import Counter
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from retention.llm.batches import text_slices, utf8, with_columns
from retention.llm.common import Scratch


#: white space beyond the six ASCII characters that cut chunks, to the normalizer or to Python (more does no harm)
_WIDE_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]")
_SHIFT = 20
_NONE = 1 << 62


class WordMerger:
    """Exact BPE of words: the vocabulary file's own normalizer and splitter, then merges by rank."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer
        data = json.loads(spec)
        self.vocab = data["model"]["vocab"]
        self.suffix = data["model"].get("end_of_word_suffix") or ""
        pairs = [m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"]]
        # pair of ids -> rank and joined id, both in one number that sorts by rank
        self.joined = {self.vocab[a] << _SHIFT | self.vocab[b]: i << _SHIFT | self.vocab[a + b]
                       for i, (a, b) in enumerate(pairs)}
        self.pairs = np.array(sorted(self.joined), dtype=np.int64)
        self.ranks = np.array([self.joined[p] for p in self.pairs.tolist()], dtype=np.int64)
        self.special = {t["content"]: t["id"] for t in data["added_tokens"] if t["special"] and not t["normalized"]}
        self.tokens = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        lib = Tokenizer.from_str(spec)
        self.normalizer, self.splitter = lib.normalizer, lib.pre_tokenizer

    def letters(self, word: str) -> list[int]:
        """Ids of the single letters, the last one with the word-end mark; letters the vocabulary lacks are left out."""
        names = [*word[:-1], word[-1] + self.suffix]
        return [self.vocab[c] for c in names if c in self.vocab]

    def merge_all(self, words: list[str]) -> list[list[int]]:
        """Ids of pre-tokens: the adjacent pair of lowest rank is joined, leftmost first, until none is left.

        Words of one number of letters advance together, a join of each at a time.
        """
        out: list[list[int]] = [[] for _ in words]
        at = np.array([i for i, w in enumerate(words) if 0 < len(w) <= 200], dtype=np.int64)
        for i, w in enumerate(words):
            if len(w) > 200:
                out[i] = self.merge_long(w)
        if not len(at):
            return out
        size = np.array([len(words[i]) for i in at.tolist()], dtype=np.int64)
        codes, where = np.unique(np.frombuffer("".join([words[i] for i in at.tolist()]).encode("utf-32-le"), dtype="<u4"),
                                 return_inverse=True)
        inner, final = (np.array([self.vocab.get(chr(c) + end, -1) for c in codes.tolist()], dtype=np.int64)
                        for end in ("", self.suffix))
        ends = np.cumsum(size)
        letters = inner[where]
        letters[ends - 1] = final[where[ends - 1]]
        owner = np.repeat(np.arange(len(at)), size)[letters >= 0]     # letters the vocabulary lacks are left out
        letters = letters[letters >= 0]
        size = np.bincount(owner, minlength=len(at))
        begin = np.cumsum(size) - size
        for n in np.unique(size[size > 0]).tolist():
            own = np.flatnonzero(size == n)
            ids = letters[begin[own][:, None] + np.arange(n)]
            rank = self._rank(ids[:, :-1], ids[:, 1:])
            own = at[own]
            while True:
                pick = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(ids), dtype=np.int64)
                low = rank[np.arange(len(ids)), pick] if rank.shape[1] else np.full(len(ids), _NONE)
                live = low != _NONE
                for i, row in zip(own[~live].tolist(), ids[~live].tolist()):
                    out[i] = row
                ids, rank, own, pick, low = ids[live], rank[live], own[live], pick[live], low[live]
                if not len(ids):
                    break
                row = np.arange(len(ids))
                ids[row, pick] = low & (1 << _SHIFT) - 1
                ids = ids[np.arange(ids.shape[1]) != pick[:, None] + 1].reshape(len(ids), -1)
                rank = rank[np.arange(rank.shape[1]) != pick[:, None]].reshape(len(ids), -1)
                for k, ok in ((pick - 1, pick > 0), (pick, pick < rank.shape[1])):
                    r, k = row[ok], k[ok]
                    rank[r, k] = self._rank(ids[r, k], ids[r, k + 1])
        return out

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.pairs):
            return np.full(left.shape, _NONE)
        pair = left << _SHIFT | right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pair, self.ranks[at], _NONE)

    def merge_long(self, word: str) -> list[int]:
        """The same joins of one word with a heap of pairs over a linked list, for words of any length."""
        ids, get = self.letters(word), self.joined.get
        n = len(ids)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (r := get(a << _SHIFT | b, _NONE)) != _NONE]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = rank & (1 << _SHIFT) - 1, -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] >= 0:
                    pair = ids[k], ids[after[k]]
                    if (r := get(pair[0] << _SHIFT | pair[1], _NONE)) != _NONE:
                        heapq.heappush(heap, (r, k, *pair))
        return [i for i in ids if i >= 0]

    def words(self, text: str) -> list[str]:
        return [w for w, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text))] if text else []

    def words_of(self, chunks: list[str]) -> tuple[list[str], np.ndarray]:
        """All words of many chunks by one call of the splitter, and how many each chunk has.

        A chunk with white space beyond ASCII adds blanks or loses one beside
        it: these chunks are cut one by one, before the call.
        """
        if _WIDE_SPACE.search("".join(chunks)):
            wide = {i: self.words(c) for i, c in enumerate(chunks) if _WIDE_SPACE.search(c)}
            words, count = self.words_of([c for i, c in enumerate(chunks) if i not in wide])
            ends = np.cumsum(count).tolist()
            plain = iter(words[a:b] for a, b in zip([0, *ends], ends))
            each = [wide[i] if i in wide else next(plain) for i in range(len(chunks))]
            return [w for e in each for w in e], np.array([len(e) for e in each], dtype=np.int64)
        if not chunks:
            return [], np.zeros(0, dtype=np.int64)
        whole = self.normalizer.normalize_str(" ".join(chunks))
        spaces = np.flatnonzero(np.frombuffer(whole.encode("utf-32-le"), dtype="<u4") == 32)
        if len(spaces) != len(chunks) - 1:      # a normalizer that makes blanks of other characters
            each = [self.words(c) for c in chunks]
            return [w for e in each for w in e], np.array([len(e) for e in each], dtype=np.int64)
        found = self.splitter.pre_tokenize_str(whole)
        owner = np.searchsorted(spaces, np.fromiter((at[0] for _, at in found), dtype=np.int64, count=len(found)))
        return [w for w, _ in found], np.bincount(owner, minlength=len(chunks))

    def parts(self, chunk: str) -> list[str | int]:
        """Words of a chunk and ids of the special tokens in it, which are cut out of the raw text, leftmost first."""
        out: list[str | int] = []
        while found := min(((chunk.find(s), s) for s in self.special if s in chunk), default=None):
            at, s = found
            out += [*self.words(chunk[:at]), self.special[s]]
            chunk = chunk[at + len(s):]
        return out + self.words(chunk)


class Lexicon:
    """Minimal acyclic automaton over byte strings; a word's ordinal is the sum of the numbers on its path.

    Arrays: ``start`` (first edge of each state), ``label``/``target``/``number``
    of the edges (sorted by label), ``final`` of the states, and the id lists
    by ordinal (``id_start``, ``ids``). ``find`` walks all words of a batch together.
    """

    NAMES = ("start", "label", "target", "number", "final", "id_start", "ids")

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.__dict__.update(arrays)

    @classmethod
    def build(cls, words: dict[bytes, list[int]]) -> Lexicon:
        ordered = sorted(words)
        shared: dict[tuple, int] = {}
        states: list[tuple] = []       # (final, ((label, target), ...)) of each frozen state

        def freeze(node: list) -> int:
            key = (node[0], tuple(node[1]))
            if key not in shared:
                shared[key] = len(states)
                states.append(key)
            return shared[key]

        path: list[list] = [[False, []]]   # open states of the last word: [final, edges frozen so far]
        last = b""

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                done = freeze(path.pop())
                path[-1][1].append((last[len(path) - 1], done))

        for word in ordered:
            common = len(os.path.commonprefix([last, word]))
            close(common)
            path += [[False, []] for _ in word[common:]]
            path[-1][0] = True
            last = word
        close(0)
        root = freeze(path[0])
        count = [0] * len(states)          # words below a state; targets are frozen before their sources
        for s, (final, edges) in enumerate(states):
            count[s] = final + sum(count[t] for _, t in edges)
        start, label, target, number = [0], [], [], []
        for final, edges in states:
            before = int(final)
            for b, t in edges:
                label.append(b)
                target.append(t)
                number.append(before)
                before += count[t]
            start.append(len(label))
        lists = [words[w] for w in ordered]
        as32 = lambda x: np.asarray(x, dtype=np.int32)
        return cls({"start": as32(start), "label": as32(label), "target": as32(target), "number": as32(number),
                    "final": as32([f for f, _ in states] + [root]),   # the root's number stands last
                    "id_start": as32(np.concatenate([[0], np.cumsum([len(x) for x in lists])])),
                    "ids": as32([i for x in lists for i in x])})

    def to_bytes(self) -> bytes:
        parts = [getattr(self, n) for n in self.NAMES]
        return b"".join([np.asarray([len(p) for p in parts], dtype=np.int64).tobytes(), *(p.tobytes() for p in parts)])

    @classmethod
    def mapped(cls, data: bytes) -> Lexicon:
        """The automaton on a memory map: pages are read as they are walked. The file has no name and goes with the process."""
        with tempfile.TemporaryFile() as f:
            f.write(data)
            f.flush()
            space = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        sizes = np.frombuffer(space, dtype=np.int64, count=len(cls.NAMES))
        whole = np.frombuffer(space, dtype=np.int32, offset=sizes.nbytes)
        ends = np.cumsum(sizes)
        return cls({n: whole[e - s:e] for n, s, e in zip(cls.NAMES, sizes, ends)})

    def find(self, words: list[bytes]) -> np.ndarray:
        """The ordinal of each word, -1 for words that are not in the lexicon."""
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        text = np.frombuffer(b"".join(words), dtype=np.uint8)
        offset = np.cumsum(size) - size
        state = np.full(len(words), int(self.final[-1]), dtype=np.int64)
        total = np.zeros(len(words), dtype=np.int64)
        live = np.flatnonzero(size > 0)
        step = 0
        while len(live):
            byte = text[offset[live] + step]
            low, high = self.start[state[live]].astype(np.int64), self.start[state[live] + 1].astype(np.int64)
            end = high.copy()
            while (open_ := low < high).any():      # binary search of the edge, all words at once
                mid = (low + high) // 2
                less = open_ & (self.label[np.minimum(mid, len(self.label) - 1)] < byte)
                low, high = np.where(less, mid + 1, low), np.where(open_ & ~less, mid, high)
            edge = np.minimum(low, max(0, len(self.label) - 1))
            hit = (low < end) & (self.label[edge] == byte) if len(self.label) else np.zeros(len(live), bool)
            total[live] = np.where(hit, total[live] + self.number[edge], -1) if len(self.label) else -1
            state[live[hit]] = self.target[edge[hit]]
            live = live[hit]
            step += 1
            live = live[size[live] > step]
        ok = (total >= 0) & (self.final[state] == 1)
        return np.where(ok, total, -1)

    def ids_of(self, ordinal: int) -> list[int]:
        return self.ids[self.id_start[ordinal]:self.id_start[ordinal + 1]].tolist()


def frequent_chunks(docs: DataFrame, top: int, text: str = "text") -> list[bytes]:
    """At most ``top`` chunks: all of the corpus above some count. Chunks that tie on it are all in or all out."""
    def count(batches):
        total: Counter = Counter()
        for b in text_slices(batches, "text"):
            for t in utf8(b.column("text")):
                total.update(t.split())
            if len(total) > 200_000:     # hand on partial counts, Spark adds them up
                yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())],
                                                 names=["chunk", "n"])
                total.clear()
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())],
                                         names=["chunk", "n"])

    counted = (docs.select(F.col(text).alias("text")).mapInArrow(count, "chunk binary, n long")
               .where(F.octet_length("chunk") <= 64).groupBy("chunk").agg(F.sum("n").alias("n")).where("n > 1"))
    scratch = Scratch(docs.sparkSession, "chunks")
    counted = scratch.store(counted, "counted")
    # the least count that no more than top chunks reach, from how many chunks have each count
    above = F.sum("chunks").over(Window.orderBy(F.desc("n")))
    least = (counted.groupBy("n").agg(F.count("*").alias("chunks")).withColumn("above", above)
             .where(F.col("above") <= top).agg(F.min("n")).first()[0])
    best = counted.where(F.col("n") >= least).select("chunk").toArrow().column("chunk").to_pylist() if least else []
    scratch.drop("counted")
    return best


class Encoder:
    """Lexicon, exact merger and a bounded memory of the chunks and words met last, for one task."""

    def __init__(self, spec: str, lexicon: Lexicon, remember: int = 400_000):
        self.merger, self.lexicon, self.remember = WordMerger(spec), lexicon, remember
        self.chunks: dict[bytes, bytes] = {}        # chunk -> its ids as decimal text
        self.old: dict[bytes, bytes] = {}
        self.known: dict[str, bytes] = {}           # word -> the same
        self.number = {i: b"%d" % i for i in self.merger.tokens}
        self.name = {b"%d" % i: t.encode() for i, t in self.merger.tokens.items()}

    def learn(self, chunks: set[bytes]) -> None:
        """Makes every chunk known to ``chunks``; what was met longest ago is forgotten."""
        if len(self.chunks) + len(chunks) > self.remember:
            self.chunks, self.old = {}, self.chunks
        missing = chunks.difference(self.chunks)
        self.chunks.update((c, self.old[c]) for c in missing if c in self.old)
        new = list(missing.difference(self.chunks))
        if len(self.known) > self.remember:
            self.known.clear()
        whole = b" ".join(new)
        marks = [s.encode() for s in self.merger.special]
        if any(m in whole for m in marks):
            marked = [c for c in new if any(m in c for m in marks)]
            new = list(set(new).difference(marked))
            whole = b" ".join(new)
            for c in marked:
                parts = self.merger.parts(c.decode())
                self._learn_words({p for p in parts if isinstance(p, str)})
                ids = [self.known[p] if isinstance(p, str) else b"%d" % p for p in parts]
                self.chunks[c] = b" ".join(filter(None, ids))
        if new:
            words, count = self.merger.words_of(whole.decode().split(" "))
            self._learn_words(set(words))
            ids = list(map(self.known.__getitem__, words))
            ends = np.cumsum(count)
            for c, a, b in zip(new, (ends - count).tolist(), ends.tolist()):
                self.chunks[c] = ids[a] if b - a == 1 else b" ".join(filter(None, ids[a:b]))

    def _learn_words(self, words: set[str]) -> None:
        fresh = list(words.difference(self.known))
        number = self.number
        found = self.lexicon.find([w.encode() for w in fresh]).tolist()
        unseen = [w for w, at in zip(fresh, found) if at < 0]
        for w, ids in [*zip(unseen, self.merger.merge_all(unseen)),
                       *((w, self.lexicon.ids_of(at)) for w, at in zip(fresh, found) if at >= 0)]:
            self.known[w] = b" ".join([number[i] for i in ids])

    def encode(self, chunks: list[bytes]) -> bytes:
        return b" ".join(filter(None, map(self.chunks.__getitem__, chunks)))

    def decode(self, ids: bytes) -> bytes:
        return b" ".join(map(self.name.__getitem__, ids.split()))


def encode_documents(docs: DataFrame, spec_path: str, top: int = 100_000, text: str = "text", key: str = "doc_id",
                     with_ids: bool = False, with_decoded: bool = False, carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` (and ``ids``, ``decoded`` if asked for), a row per document.

    The columns named by ``carry`` are handed on.

    ``ids`` is the list of ids, ``decoded`` their tokens joined as the
    vocabulary's decoder does (tokens of this vocabulary are joined by one
    space, specials stay). A null text counts as empty: no ids, both digests
    those of the empty string. Repeated rows, null ids and other columns need
    no care; an empty table gives no rows. ``top`` bounds the lexicon, not
    the texts: what it lacks is merged exactly.
    """
    spark = docs.sparkSession
    with open(spec_path, encoding="utf-8") as f:
        spec = f.read()
    if json.loads(spec).get("decoder") is not None:
        raise ValueError("only vocabularies without a decoder of their own are supported")
    merger = WordMerger(spec)
    frequent = sorted({p for c in frequent_chunks(docs, top, text) for p in merger.parts(c.decode()) if isinstance(p, str)})
    words = dict(zip((w.encode() for w in frequent), merger.merge_all(frequent)))
    lexicon = spark.sparkContext.broadcast(Lexicon.build(words).to_bytes())      # bounded by ``top``
    shared = spark.sparkContext.broadcast(spec)     # the vocabulary file, of fixed size

    def run(batches):
        enc = Encoder(shared.value, Lexicon.mapped(lexicon.value))
        for b in text_slices(batches, "text", 2 << 20):
            split = [t.split() for t in utf8(b.column("text"))]
            enc.learn(set().union(*split))
            ids = [enc.encode(chunks) for chunks in split]
            decoded = [enc.decode(i) for i in ids]
            new = {"n_tokens": pa.array([i.count(b" ") + (i != b"") for i in ids], pa.int64()),
                   "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
                   "decoded_sha256": [hashlib.sha256(x).hexdigest() for x in decoded]}
            if with_ids:
                flat = np.fromstring(b" ".join(filter(None, ids)), dtype=np.int32, sep=" ") if any(ids) else np.zeros(0, np.int32)
                ends = np.concatenate([[0], np.cumsum(np.asarray(new["n_tokens"]))]).astype(np.int32)
                new["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            if with_decoded:
                new["decoded"] = pa.array([x.decode() for x in decoded], pa.string())
            yield with_columns(b, ["doc_id", *carry], **new)

    kinds = [f", {c} {docs.schema[c].dataType.simpleString()}" for c in carry]
    schema = "doc_id long" + "".join(kinds) + ", n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), *carry).mapInArrow(
        run, schema + ", ids array<int>" * with_ids + ", decoded string" * with_decoded)
