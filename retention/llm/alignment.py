"""Cross-tokenizer alignment: which tokens of two tokenizers meet on a text's bytes.

Each side's tokens form an incidence matrix over the bytes (a row per token, a
one at each byte that it covers) in compressed sparse rows. Gustavson's row
products A x B' give the overlap links: for each pair of tokens that share
bytes, how many. The pairs that end on the same byte close the groups; the
group-incidence matrices' product gives the pairs that share a group.

Tokens of one place end together, so the bytes of one are a suffix of the
other's: the pairs of ids that can ever be linked are listed from the two
vocabularies alone (some hundred thousand), and corpus-wide counts by pair
are an array of that length, whatever the size of the corpus.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retention.llm.batches import text_slices, utf8, with_columns
from retention.llm.common import Scratch

#: a run of white space on which the pattern of the faster encoder may run out of stack
_LONG_BLANK = re.compile(r"\s{1000}")


# ---------------------------------------------------------------- sparse rows
@dataclass
class Rows:
    """Compressed sparse rows: row i has columns ``indices[indptr[i]:indptr[i + 1]]`` with ``values`` of the same places."""

    indptr: np.ndarray
    indices: np.ndarray
    values: np.ndarray
    width: int

    def __len__(self) -> int:
        return len(self.indptr) - 1

    def row_block(self, a: int, b: int) -> Rows:
        lo, hi = self.indptr[a], self.indptr[b]
        return Rows(self.indptr[a:b + 1] - lo, self.indices[lo:hi], self.values[lo:hi], self.width)

    def transposed(self) -> Rows:
        order = np.argsort(self.indices, kind="stable")
        owner = np.repeat(np.arange(len(self)), np.diff(self.indptr))
        ptr = np.concatenate([[0], np.cumsum(np.bincount(self.indices, minlength=self.width))])
        return Rows(ptr, owner[order], self.values[order], len(self))


def byte_incidence(ends: np.ndarray, n_bytes: int) -> Rows:
    """Tokens that end before the bytes ``ends`` and cover ``n_bytes`` without gap or overlap."""
    return Rows(np.concatenate([[0], ends]), np.arange(n_bytes), np.ones(n_bytes, dtype=np.int64), n_bytes)


def group_incidence(group: np.ndarray, n_groups: int) -> Rows:
    return Rows(np.arange(len(group) + 1), group, np.ones(len(group), dtype=np.int64), n_groups)


def gustavson(a: Rows, b: Rows) -> Rows:
    """The product of two sparse matrices, row by row: row i of it is the sum of b's rows k, times a[i, k]."""
    reach = b.indptr[a.indices + 1] - b.indptr[a.indices]
    owner = np.repeat(np.repeat(np.arange(len(a)), np.diff(a.indptr)), reach)
    place = np.repeat(b.indptr[a.indices] - (np.cumsum(reach) - reach), reach) + np.arange(len(owner))
    column, value = b.indices[place], np.repeat(a.values, reach) * b.values[place]
    at = owner * b.width + column
    if len(at) and (np.diff(at) < 0).any():     # else each row's columns come in order already
        order = np.argsort(at, kind="stable")
        at, owner, column, value = at[order], owner[order], column[order], value[order]
    head = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else at
    ptr = np.concatenate([[0], np.cumsum(np.bincount(owner[head], minlength=len(a)))])
    return Rows(ptr, column[head], np.add.reduceat(value, head) if len(head) else value, b.width)


def products(a: Rows, b: Rows, most: int = 1 << 20):
    """``gustavson`` over runs of rows that reach about ``most`` places: (first row, product)."""
    work = np.concatenate([[0], np.cumsum(b.indptr[a.indices + 1] - b.indptr[a.indices])])[a.indptr]
    cuts = np.unique(np.concatenate([[0], np.searchsorted(work, np.arange(most, work[-1] + most, most), side="right") - 1, [len(a)]]))
    for lo, hi in zip(cuts.tolist(), cuts[1:].tolist()):
        yield lo, gustavson(a.row_block(lo, hi), b)


# ---------------------------------------------------------------- the two vocabularies
def byte_alphabet() -> dict[str, int]:
    """The characters by which a byte-level vocabulary writes bytes: printable ones stand for themselves, the others follow 255."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """A byte-level BPE file (A). Encodes a space and the text; special tokens' strings are plain text."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        self.bytes = {i: bytes(alphabet[c] for c in t) for t, i in spec["model"]["vocab"].items()}
        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        self.fast = None
        merges = [m if isinstance(m, str) else " ".join(m) for m in spec["model"]["merges"]]
        vocab = spec["model"]["vocab"]
        if (spec.get("normalizer") is None and spec["pre_tokenizer"] == _PLAIN_BYTES and not spec["model"].get("ignore_merges")
                and [vocab[m.replace(" ", "")] for m in merges] == list(range(256, 256 + len(merges)))):
            self.fast = tiktoken.Encoding("plain", pat_str=_PATTERN, mergeable_ranks={b: i for i, b in self.bytes.items()}, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        out = [None if self.fast is None or _LONG_BLANK.search(t) else self.fast.encode_ordinary(" " + t) for t in texts]
        left = [i for i, ids in enumerate(out) if ids is None]
        for i, e in zip(left, self.slow.encode_batch_fast([" " + texts[i] for i in left], add_special_tokens=False)):
            out[i] = e.ids
        return out


# fixed values: the settings and the pattern of byte-level pre-tokenization
_PLAIN_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Pieces:
    """A sentence-piece model with byte fallback (B); it puts the space before the text itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        self.model = SentencePieceProcessor(model_file=path)
        self.bytes = {i: bytes([int(p[1:-1], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in enumerate(map(self.model.id_to_piece, range(self.model.vocab_size())))}

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1) if texts else []


def linkable_pairs(a: dict[int, bytes], b: dict[int, bytes], width: int) -> np.ndarray:
    """All ``a * width + b`` of ids whose tokens can end together, ascending: one's bytes are a suffix of the other's."""
    def ids_by_bytes(side):
        out: dict[bytes, list[int]] = {}
        for i, x in side.items():
            out.setdefault(x, []).append(i)
        return out
    in_a, in_b = ids_by_bytes(a), ids_by_bytes(b)
    pairs = {i * width + j for i, x in a.items() for k in range(len(x)) for j in in_b.get(x[k:], ())}
    pairs |= {i * width + j for j, x in b.items() for k in range(1, len(x)) for i in in_a.get(x[k:], ())}
    return np.array(sorted(pairs), dtype=np.int64)


# ---------------------------------------------------------------- alignment
class Aligner:
    """Aligns lists of texts; one per task."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")    # Spark's tasks are the parallelism
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.width = max(self.b.bytes) + 1
        self.high = max(self.a.bytes) + 1
        self.size_a, self.size_b = (np.array([len(side.bytes.get(i, b"")) for i in range(n)], dtype=np.int64)
                                    for side, n in ((self.a, self.high), (self.b, self.width)))
        a, b = ([side.bytes.get(i, b"") for i in range(n)] for side, n in ((self.a, self.high), (self.b, self.width)))
        self.pieces_a, self.pieces_b = a, b
        #: by code: an A id inside or at the end of its group's A side, a B id inside or at the end of the group
        self.names = [b"%d%s" % (i, mark) for n, mark in ((self.high, b","), (self.high, b"|"), (self.width, b","), (self.width, b";"))
                      for i in range(n)]

    def pairs(self) -> np.ndarray:
        return linkable_pairs(self.a.bytes, self.b.bytes, self.width)

    def tokens(self, texts: list[bytes]) -> tuple[list, list]:
        """Ids of both sides; both are empty where the text is or a side's tokens do not give it back."""
        plain = [t.decode() for t in texts]
        out_a, out_b = [], []
        for t, a, b in zip(texts, self.a.encode(plain), self.b.encode(plain)):
            whole = b" " + t
            fits = t and b"".join(map(self.pieces_a.__getitem__, a)) == whole == b"".join(map(self.pieces_b.__getitem__, b))
            out_a.append(a if fits else [])
            out_b.append(b if fits else [])
        return out_a, out_b

    def align(self, texts: list[bytes]) -> Aligned:
        return Aligned(self, *self.tokens(texts))


class Aligned:
    """Overlap links and groups of some texts, laid end to end: every text's end is a common end, so none is linked to another."""

    def __init__(self, v: Aligner, ids_a: list[list[int]], ids_b: list[list[int]]):
        self.v = v
        self.n_a, self.n_b = (np.fromiter(map(len, x), dtype=np.int64, count=len(x)) for x in (ids_a, ids_b))
        self.a, self.b = (np.fromiter((i for x in ids for i in x), dtype=np.int64, count=int(n.sum()))
                          for ids, n in ((ids_a, self.n_a), (ids_b, self.n_b)))
        end_a, end_b = np.cumsum(v.size_a[self.a]), np.cumsum(v.size_b[self.b])
        n_bytes = int(end_a[-1]) if len(end_a) else 0
        self.by_a, self.by_b = byte_incidence(end_a, n_bytes), byte_incidence(end_b, n_bytes)
        rows, columns, shared = [], [], []
        for first, part in products(self.by_a, self.by_b.transposed()):
            rows.append(np.repeat(np.arange(first, first + len(part)), np.diff(part.indptr)))
            columns.append(part.indices)
            shared.append(part.values)
        #: overlap links: A token, B token, bytes that both cover
        self.row, self.column, self.shared = (np.concatenate(x) if x else np.empty(0, dtype=np.int64) for x in (rows, columns, shared))
        ends = end_a[self.row] == end_b[self.column]
        #: links that end together, one closes each group
        self.link_a, self.link_b = self.row[ends], self.column[ends]
        self.last_a, self.last_b = np.zeros(len(self.a), dtype=bool), np.zeros(len(self.b), dtype=bool)
        self.last_a[self.link_a], self.last_b[self.link_b] = True, True
        self.group_a, self.group_b = (np.cumsum(x) - x for x in (self.last_a, self.last_b))
        self.n_groups = len(self.link_a)
        self.cuts_a, self.cuts_b = (np.concatenate([[0], np.cumsum(n)]) for n in (self.n_a, self.n_b))

    def by_text(self, values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Sums of a value per token, by text."""
        total = np.concatenate([[0], np.cumsum(values)])
        return total[cuts[1:]] - total[cuts[:-1]]

    def shared_groups(self):
        """(first A token, product) runs of the links between tokens of one group, group incidence times group incidence."""
        return products(group_incidence(self.group_a, self.n_groups), group_incidence(self.group_b, self.n_groups).transposed())

    def shared_counts(self) -> np.ndarray:
        """How many shared-group links each A token has: the sums of that product's rows."""
        sums = [np.empty(0, dtype=np.int64)]
        for _, part in self.shared_groups():
            total = np.concatenate([[0], np.cumsum(part.values)])
            sums.append(total[part.indptr[1:]] - total[part.indptr[:-1]])
        return np.concatenate(sums)

    def group_digests(self) -> list[str]:
        """SHA-256 of the groups' ids, ``a,a|b;a|b,b``, by text; '' for a text without tokens."""
        v = self.v
        sizes_a, sizes_b = (np.bincount(g, minlength=self.n_groups) for g in (self.group_a, self.group_b))
        code = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        code[np.arange(len(self.a)) + (np.cumsum(sizes_b) - sizes_b)[self.group_a]] = self.a + v.high * self.last_a
        code[np.arange(len(self.b)) + np.cumsum(sizes_a)[self.group_b]] = 2 * v.high + self.b + v.width * self.last_b
        cuts = (self.cuts_a + self.cuts_b).tolist()
        return [hashlib.sha256(b"".join(map(v.names.__getitem__, code[x:y].tolist()))[:-1]).hexdigest() if y > x else ""
                for x, y in zip(cuts, cuts[1:])]


def align_documents(docs: DataFrame, path_a: str, path_b: str, text: str = "text", key: str = "doc_id",
                    with_links: bool = False) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_shared``, one row per document row.

    Links are the pairs of an A and a B token that end on the same byte; a
    pair of ids counts as many links as hold it in the whole table.
    ``n_best`` are the links whose count is the highest of their B id,
    ``count_sum`` is over links, ``n_shared`` counts the pairs of tokens in
    one group. ``with_links`` adds ``a_ids``, ``b_ids`` and ``overlaps``, all
    pairs that share bytes, by place, with the number of these.

    A null or empty text, or one that either side's tokens do not give back
    byte for byte, has no tokens: zeros and ''. Repeated rows and null ids
    keep their rows and count each; other columns are ignored; an empty table
    gives no rows. The tokenizers take whole texts; the matrices of a long
    one are multiplied in runs of rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "alignment")
    aligner = Aligner(path_a, path_b)
    # bounded by the two vocabularies: the ids of each byte string's suffixes
    shared = spark.sparkContext.broadcast(aligner.pairs())
    n_pairs, width = len(shared.value), aligner.width
    links = ", a_ids array<int>, b_ids array<int>, overlaps array<struct<a: int, b: int, n_bytes: int>>" if with_links else ""

    def run(batches):
        v = Aligner(path_a, path_b)
        pairs = shared.value.astype(np.uint64)
        for b in text_slices(batches, "text", 1 << 20):
            x = v.align(utf8(b.column("text")))
            slot = np.searchsorted(pairs, (x.a[x.link_a] * width + x.b[x.link_b]).astype(np.uint64)).astype("<u4")
            n_links = x.by_text(x.last_a, x.cuts_a)
            cuts = np.concatenate([[0], np.cumsum(n_links)]).tolist()
            new = {"n_a": x.n_a, "n_b": x.n_b, "n_groups": n_links, "n_shared": x.by_text(x.shared_counts(), x.cuts_a),
                   "groups_sha256": x.group_digests(),
                   "slots": pa.array([slot[i:j].tobytes() for i, j in zip(cuts, cuts[1:])], pa.binary())}
            if with_links:
                at = np.searchsorted(x.row, x.cuts_a).tolist()
                own = zip(at, at[1:], x.cuts_a.tolist(), x.cuts_b.tolist())
                new |= {"a_ids": pa.array([p.tolist() for p in np.split(x.a, x.cuts_a[1:-1])], pa.list_(pa.int32())),
                        "b_ids": pa.array([p.tolist() for p in np.split(x.b, x.cuts_b[1:-1])], pa.list_(pa.int32())),
                        "overlaps": pa.array([[{"a": p, "b": q, "n_bytes": n} for p, q, n in zip(
                            (x.row[i:j] - a).tolist(), (x.column[i:j] - c).tolist(), x.shared[i:j].tolist())] for i, j, a, c in own],
                            pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n_bytes", pa.int32())])))}
            yield with_columns(b, ["doc_id"], **new)

    found = scratch.store(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, n_a long, n_b long, n_groups long, n_shared long, groups_sha256 string, slots binary" + links), "aligned")

    def tally(batches):
        total = np.zeros(n_pairs, dtype=np.int64)
        for b in batches:
            total += np.bincount(np.frombuffer(b"".join(b.column("slots").to_pylist()), dtype="<u4"), minlength=n_pairs)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["slot", "n"])

    count = np.zeros(n_pairs, dtype=np.int64)
    counted = found.select("slots").mapInArrow(tally, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    count[np.asarray(counted.column("slot"))] = np.asarray(counted.column("n"))     # as many rows as linkable pairs at most
    highest = np.zeros(width, dtype=np.int64)
    np.maximum.at(highest, shared.value % width, count)
    known = spark.sparkContext.broadcast((count, count == highest[shared.value % width]))
    keep = ["doc_id", "n_a", "n_b", "n_groups", "n_shared", "groups_sha256"] + (["a_ids", "b_ids", "overlaps"] if with_links else [])

    def close(batches):
        count, best = known.value
        for b in batches:
            data = b.column("slots").to_pylist()
            ends = np.cumsum([0, *(len(x) // 4 for x in data)])
            slot = np.frombuffer(b"".join(data), dtype="<u4")
            sums = [np.concatenate([[0], np.cumsum(x[slot])]) for x in (count, best)]
            total, tops = (x[ends[1:]] - x[ends[:-1]] for x in sums)
            yield with_columns(b, keep, n_links=np.diff(ends), n_best=tops, count_sum=total)

    return found.mapInArrow(close, "doc_id long, n_a long, n_b long, n_groups long, n_shared long, groups_sha256 string" + links
                            + ", n_links long, n_best long, count_sum long")
