"""Quality rules: line labels by Viterbi decoding of a linear-chain CRF.

Every line of a text becomes a set of binary features. A two-label chain
(1 content, 0 boilerplate) scores a line by its features and a neighbouring
pair by a 2x2 transition table; Viterbi gives the best labels of the whole
text. A document is kept if the lines labelled content hold at least
``min_share`` of its words and the base rules hold. Base rules and labels use
every whole text.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retention.llm.batches import text_slices, utf8, with_columns

# fixed values of the base rules
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PERCENT = 30

FEATURES = ("always", "few symbols per word", "many symbols per word", "mostly capitals", "no end punctuation",
            "under three words", "equals an earlier line", "few distinct words", "many digits", "cells",
            "many exclamation marks", "very long words")
_N = len(FEATURES)
_SYMBOL_TABLE = bytes(c for c in range(256) if c not in SYMBOLS)
_NOT_UPPER = bytes(c for c in range(256) if not 65 <= c <= 90)
_NOT_LOWER = bytes(c for c in range(256) if not 97 <= c <= 122)
_NOT_DIGIT = bytes(c for c in range(256) if not 48 <= c <= 57)
_CONTINUED = bytes(range(0x80, 0xC0))
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Chain:
    """Weights of the chain: content minus boilerplate per feature, and the transition table."""

    emit: list[float] = field(default_factory=lambda: [
        2.0, -1.5, -3.0, -3.5, -0.3, -0.3, -1.5, -3.0, -1.5, -3.0, -3.0, -1.0])  # used where no labels exist
    move: list[list[float]] = field(default_factory=lambda: [[0.5, -0.5], [-0.5, 0.5]])


def line_bits(line: bytes, words: list[bytes], seen: bool) -> int:
    """The features of one line as bits; a line without words has only the first."""
    n = len(words)
    if not n:
        return 1
    chars = sum(map(len, words))
    symbols = len(line.translate(None, _SYMBOL_TABLE))
    upper = len(line.translate(None, _NOT_UPPER))
    lower = len(line.translate(None, _NOT_LOWER))
    last = words[-1][-1:]
    flags = (True, symbols > 0.1 * n, symbols > 0.5 * n, upper > 2 * lower and upper > 5, last not in b".!?:;\"')",
             n < 3, seen, n >= 12 and 3 * len(set(words)) < n, len(line.translate(None, _NOT_DIGIT)) > 0.2 * chars,
             5 * line.count(b"|") > n, 2 * line.count(b"!!") > n, chars > 15 * n)
    return sum(1 << i for i, f in enumerate(flags) if f)


def repeated_window_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words that lie in a ``size``-word window found twice or more in the text."""
    n = len(words)
    if n <= size:
        return 0
    ids: dict[bytes, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.uint64, count=n)
    mixed = (codes + np.uint64(1)) * _MIX
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    m = n - size + 1
    key = np.zeros(m, dtype=np.uint64)
    for i in range(size):
        key = key * np.uint64(0x100000001B3) + mixed[i:i + m]
    order = np.sort(key)
    if not (order[1:] == order[:-1]).any():
        return 0
    same = np.isin(key, order[1:][order[1:] == order[:-1]])
    at = np.flatnonzero(same)
    windows = codes[at[:, None] + np.arange(size)]    # compare the words themselves, not their hash
    _, where, count = np.unique(windows, axis=0, return_inverse=True, return_counts=True)
    at = at[count[where.ravel()] > 1]
    covered = np.zeros(n + 1, dtype=np.int64)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + size, -1)
    return int((np.cumsum(covered[:-1]) > 0).sum())


def read_lines(text: bytes) -> tuple[tuple, list[int], list[int]]:
    """Base numbers of a text, and bits and word count of each of its lines."""
    bits, counts, words, seen, repeats = [], [], [], set(), 0
    for line in text.split(b"\n"):
        own = line.split()
        again = False
        if own:
            again = line in seen
            repeats += again
            seen.add(line)
        bits.append(line_bits(line, own, again))
        counts.append(len(own))
        words += own
    joined = b"".join(words)
    return ((len(words), len(joined.translate(None, _CONTINUED)), len(text.translate(None, _SYMBOL_TABLE)), repeats,
             repeated_window_words(words)), bits, counts)


#: texts that are still worth a vector step
_FEW = 4


def viterbi(bits: list[list[int]], chain: Chain) -> list[np.ndarray]:
    """Best label sequence of each text; all texts of a batch advance one line at a time. Ties go to content.

    Where few texts are left, the longest, each goes on by itself with plain numbers, in the same arithmetic.
    """
    emit = (np.arange(1 << _N)[:, None] >> np.arange(_N) & 1) @ np.asarray(chain.emit)
    move = np.asarray(chain.move)
    order = sorted(range(len(bits)), key=lambda d: -len(bits[d]))
    length = np.array([len(bits[d]) for d in order])
    first = np.concatenate([[0], np.cumsum(length)])[:-1]
    gain = emit[np.concatenate([np.asarray(bits[d], dtype=np.int64) for d in order])] / 2 if order else emit[:0]
    back = np.zeros((len(gain), 2), dtype=np.int8)
    score = np.stack([-gain[first], gain[first]], axis=1)
    few = min(_FEW, len(order))
    steps = int(length[few]) if len(order) > few else 1 if order else 0    # together; further on at most ``few`` are left
    for t in range(1, steps):
        live = int(np.searchsorted(-length, -t, side="left"))   # texts with more than t lines
        at = first[:live] + t
        came = score[:live, :, None] + move[None]                # from, to
        back[at] = came[:, 1] >= came[:, 0]
        score[:live] = came.max(axis=1) + np.stack([-gain[at], gain[at]], axis=1)
    labels = np.zeros(len(gain), dtype=np.int8)
    (m00, m01), (m10, m11) = move.tolist()
    alone = {}
    for k in range(few):
        s0, s1 = score[k].tolist()
        at, end = int(first[k]) + steps, int(first[k] + length[k])
        came = bytearray()
        for g in gain[at:end].tolist():
            a0, a1, b0, b1 = s0 + m00, s1 + m10, s0 + m01, s1 + m11
            came.append((a1 >= a0) + 2 * (b1 >= b0))
            s0, s1 = (a1 if a1 > a0 else a0) - g, (b1 if b1 > b0 else b0) + g
        score[k] = s0, s1
        alone[k] = came
    now = (score[:, 1] >= score[:, 0]).astype(np.int8)
    for k, came in alone.items():
        label, out = int(now[k]), bytearray(len(came))
        for i in range(len(came) - 1, -1, -1):
            out[i] = label
            label = came[i] >> label & 1
        at = int(first[k]) + steps
        labels[at:at + len(came)] = np.frombuffer(out, dtype=np.int8)
        now[k] = label
    for t in range(steps - 1, -1, -1):
        live = int(np.searchsorted(-length, -t, side="left"))
        at = first[:live] + t
        labels[at] = now[:live]
        now[:live] = back[at, now[:live]]
    out: list[np.ndarray] = [labels[:0]] * len(bits)
    for k, d in enumerate(order):
        out[d] = labels[first[k]:first[k] + length[k]]
    return out


def fit_chain(texts: list[list[int]], good: list[int], rounds: int = 150, rate: float = 0.5, ridge: float = 1e-3) -> Chain:
    """Weights that raise the conditional likelihood of the labels, by gradient ascent with forward-backward sums.

    Every line of a labelled document carries the document's label (weak
    labels); documents count equally whatever their length, both classes
    count equally. All documents advance together, a line at a time.
    """
    y = np.asarray(good)
    n = np.array([len(t) for t in texts])
    steps, docs = int(n.max()), np.arange(len(texts))
    bits = np.zeros((len(texts), steps), dtype=np.int64)
    for d, t in enumerate(texts):
        bits[d, :len(t)] = t
    x = (bits[:, :, None] >> np.arange(_N) & 1).astype(float)         # document, line, feature
    live = np.arange(steps) < n[:, None]
    share = y.mean()
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)) / n / len(n)
    emit, move = np.zeros(_N), np.zeros((2, 2))
    real = np.zeros((2, 2))
    np.add.at(real, (y, y), (n - 1) * weight)
    for _ in range(rounds):
        half = x @ emit / 2
        local = np.stack([-half, half], axis=2)
        ahead, behind = np.empty_like(local), np.zeros_like(local)
        ahead[:, 0] = local[:, 0]
        for t in range(1, steps):
            ahead[:, t] = np.logaddexp.reduce(ahead[:, t - 1, :, None] + move, axis=1) + local[:, t]
        for t in range(steps - 2, -1, -1):
            on = live[:, t + 1]
            behind[on, t] = np.logaddexp.reduce(move + (local[on, t + 1] + behind[on, t + 1])[:, None, :], axis=2)
        whole = np.logaddexp.reduce(ahead[docs, n - 1], axis=1)
        p1 = np.exp(ahead[:, :, 1] + behind[:, :, 1] - whole[:, None])
        g_emit = np.einsum("dtf,dt->f", x, np.where(live, y[:, None] - p1, 0.0) * weight[:, None])
        pair = np.exp(np.where(live[:, 1:, None, None], ahead[:, :-1, :, None] + move + (local + behind)[:, 1:, None, :]
                               - whole[:, None, None, None], -np.inf))
        emit += rate * (g_emit - ridge * emit)
        move += rate * (real - np.einsum("dtij,d->ij", pair, weight) - ridge * move)
    return Chain(emit.tolist(), move.tolist())


def train_chain(docs: DataFrame, labels: DataFrame, max_docs: int = 400, max_lines: int = 40,
                text: str = "text", key: str = "doc_id") -> Chain:
    """Fit on at most ``max_docs`` labelled documents of each class, those with the smallest hash of the id.

    Both numbers bound the training sample only (its first ``max_lines`` lines
    of each document); decoding uses every line of every document. Without
    both classes the default weights stand.
    """
    known = labels.where(F.col("quality").isin(0, 1) & F.col(key).isNotNull()).groupBy(
        F.col(key).alias("l_id")).agg(F.min("quality").alias("quality"))
    chosen = None
    for q in (0, 1):
        part = known.where(F.col("quality") == q).orderBy(F.xxhash64("l_id"), "l_id").limit(max_docs)
        chosen = part if chosen is None else chosen.unionByName(part)

    def featurise(batches):
        for b in text_slices(batches, "text"):
            yield with_columns(b, ["doc_id", "quality"], bits=pa.array(
                [read_lines(t)[1][:max_lines] for t in utf8(b.column("text"))], pa.list_(pa.int32())))

    sample = (docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
              .join(F.broadcast(chosen), F.col("doc_id") == F.col("l_id")).select("doc_id", "quality", "text")
              .mapInArrow(featurise, "doc_id long, quality int, bits array<int>"))
    # rows that repeat a sampled id: one of them, whatever their number
    sample = sample.groupBy("doc_id", "quality").agg(F.min("bits").alias("bits"))
    rows = sorted((r["doc_id"], r["quality"], list(r["bits"])) for r in sample.collect())
    if len({r[1] for r in rows}) < 2:
        return Chain()
    return fit_chain([r[2] for r in rows], [r[1] for r in rows])


RESULT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, content_share double, n_lines long, n_content_lines long")


def judge_documents(docs: DataFrame, chain: Chain, min_share: float = 0.5, text: str = "text",
                    key: str = "doc_id", carry: bool = False) -> DataFrame:
    """One row per document: ``doc_id`` and ``RESULT``; with ``carry`` all its own columns and ``kept`` alone.

    A null text counts as empty and fails the base rules, as do all texts
    under 20 words; repeated rows are judged alike; rows without an id keep a
    null id; other columns are ignored; an empty table gives no rows. Texts of
    any length are read whole, one at a time.
    """
    src = docs if carry else docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    name = text if carry else "text"
    verdict = "__kept"
    schema = T.StructType([*src.schema.fields, T.StructField(verdict, T.BooleanType())]) if carry else f"doc_id long, {RESULT}"
    keep = src.columns if carry else ["doc_id"]

    def run(batches):
        for b in text_slices(batches, name):
            read = [read_lines(t) for t in utf8(b.column(name))]
            labels = viterbi([r[1] for r in read], chain)
            base, share, kept, lines, content = [], [], [], [], []
            for (numbers, _, counts), lab in zip(read, labels):
                n = numbers[0]
                failed = n < MIN_WORDS or 100 * numbers[4] > MAX_REPEAT_PERCENT * n
                part = float(np.dot(lab, counts) / n) if n else 0.0
                base.append(failed)
                share.append(part)
                kept.append(not failed and part >= min_share)
                lines.append(len(lab))
                content.append(int(lab.sum()))
            if carry:
                yield with_columns(b, keep, **{verdict: pa.array(kept, pa.bool_())})
                continue
            cols = [pa.array([r[0][i] for r in read], pa.int64()) for i in range(5)]
            yield with_columns(b, keep, **dict(zip(
                ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), cols)),
                base_failed=pa.array(base, pa.bool_()), kept=pa.array(kept, pa.bool_()),
                content_share=pa.array(share, pa.float64()), n_lines=pa.array(lines, pa.int64()),
                n_content_lines=pa.array(content, pa.int64()))

    out = src.mapInArrow(run, schema)
    return out.where(verdict).drop(verdict) if carry else out
