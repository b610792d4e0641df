"""License scan: base phrases, and an exact set-similarity join of text blocks with notice templates.

A block is a line, or a window of the whole text's words, across line ends: a
run as long as the template's text, at every place. A template matches a block
if the block's word set holds at least ``threshold`` of the template's word
set. The join is exact: the words of each template are ordered by their
frequency in the whole corpus, rarest first, and a block is compared only if it has a word of the template's prefix (a match must share
one), has enough words (length filter), and, from the place of its first
shared prefix word on, can still reach the threshold (positional filter); a
text's windows are walked only for templates that the whole text's words meet.
The templates are a small table (``notices``, or one's own within
``MAX_TEMPLATES``) that every task holds with its inverted index of prefix words.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retention.llm.batches import text_slices, utf8, with_columns
from retention.llm.notices import FULL, PHRASES, TEMPLATES

__all__ = ["FULL", "PHRASES", "TEMPLATES", "scan_licenses", "templates_of"]

_OTHER = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
#: one table: A-Z to lower case, every other ASCII character that is no word character to a space
_TABLE = bytes(c + 32 if 65 <= c <= 90 else 32 if c in _OTHER else c for c in range(256))
_LINES = bytes(10 if c == 10 else _TABLE[c] for c in range(256))


#: bytes of a template table, at most: every task holds it
MAX_TEMPLATES = 4 << 20


def templates_of(table: DataFrame, label: str = "label", text: str = "text") -> tuple[tuple[str, str], ...]:
    """Templates from a table (label, text); rows without a label or without a word are left out, more than ``MAX_TEMPLATES`` bytes raise."""
    rows = table.select(F.col(label).cast("string").alias("label"), F.col(text).cast("string").alias("text")).na.drop().distinct()
    if (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) > MAX_TEMPLATES:
        raise ValueError(f"templates of more than {MAX_TEMPLATES} bytes")
    return tuple(sorted((r["label"], r["text"]) for r in rows.collect() if r["text"].encode().translate(_TABLE).split()))


def template_words(templates=TEMPLATES) -> list[tuple[str, frozenset[bytes]]]:
    return [(label, frozenset(text.encode().translate(_TABLE).split())) for label, text in templates]


def word_frequencies(docs: DataFrame, vocabulary: set[bytes], text: str = "text") -> dict[bytes, int]:
    """In how many documents of the whole table each word of the small vocabulary stands."""
    def count(batches):
        total = dict.fromkeys(vocabulary, 0)
        for b in text_slices(batches, "text"):
            for t in utf8(b.column("text")):
                for w in vocabulary.intersection(t.translate(_TABLE).split()):
                    total[w] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())],
                                         names=["word", "n"])

    rows = (docs.select(F.col(text).alias("text")).mapInArrow(count, "word binary, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).collect())     # one row per template word
    return dict.fromkeys(vocabulary, 0) | {bytes(r["word"]): r["n"] for r in rows}


class TemplateIndex:
    """Templates with their words rarest first, and an inverted index of their prefix words."""

    def __init__(self, templates: list[tuple[str, frozenset[bytes]]], frequency: dict[bytes, int], threshold: float):
        self.sets, self.need, self.index = templates, [], {}
        for k, (_, words) in enumerate(templates):
            ordered = sorted(words, key=lambda w: (frequency[w], w))
            need = max(1, math.ceil(threshold * len(words) - 1e-9))
            self.need.append(need)
            for place, w in enumerate(ordered[:len(words) - need + 1]):
                self.index.setdefault(w, []).append((k, place))
        self.prefix = set(self.index)
        #: templates whose threshold the words of another template meet: held less, they are that other notice
        self.shadow = [{j for j, (_, other) in enumerate(templates) if j != k and len(words & other) >= self.need[k]}
                       for k, (_, words) in enumerate(templates)]

    def match(self, block: set[bytes]) -> list[tuple[int, float]]:
        """(template, containment) of every template that the block meets."""
        first: dict[int, int] = {}
        for w in self.prefix & block:
            for k, place in self.index[w]:
                first[k] = min(place, first.get(k, place))
        out = []
        for k, place in first.items():
            words = self.sets[k][1]
            if len(block) < self.need[k] or len(words) - place < self.need[k]:
                continue
            shared = len(words & block)
            if shared >= self.need[k]:
                out.append((k, shared / len(words)))
        return out


def notice_places(words: list[bytes], template: frozenset[bytes], need: int, length: int) -> list[tuple[int, int, int]]:
    """(first, last, shared) of the windows of ``length`` words that share ``need`` words or more with the template.

    First and last are the shared words' own places. Of windows that overlap
    the one that shares most counts, of these the shortest. One pass: a left
    word that stands again further on adds nothing to any later window.
    """
    at = [i for i, w in enumerate(words) if w in template]
    inside: Counter = Counter()
    found, left = [], 0
    for right, last in enumerate(at):
        inside[words[last]] += 1
        while inside[words[at[left]]] > 1 or last - at[left] >= length:
            inside[words[at[left]]] -= 1
            if not inside[words[at[left]]]:
                del inside[words[at[left]]]
            left += 1
        if len(inside) >= need:
            found.append((-len(inside), last - at[left], at[left], last))
    firsts: list[int] = []
    out: list[tuple[int, int, int]] = []
    for shared, _, first, last in sorted(found):
        i = bisect_right(firsts, last)      # places lie apart: the one before decides
        if not i or out[i - 1][1] < first:
            firsts.insert(i, first)
            out.insert(i, (first, last, -shared))
    return out


def phrase_places(joined: bytes, phrase: bytes) -> list[int]:
    """Word numbers at which the phrase's words stand in a row. ``joined`` is the words with a space around each."""
    out, number, last, at = [], 0, 0, joined.find(phrase)
    while at >= 0:
        number += joined.count(b" ", last, at)      # on from the place before: one pass, however many places
        out.append(number)
        last, at = at, joined.find(phrase, at + 1)
    return out


RESULT = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, n_blocks long")


def scan_licenses(docs: DataFrame, threshold: float = 0.85, templates=TEMPLATES, phrases=PHRASES,
                  text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id`` and ``RESULT``.

    ``n_blocks`` counts all pairs of a line and a template that match, and the
    matching windows over line ends that touch no matching line, each place
    once. Every match gives its template's label, but for one that stands at
    the same words as a better match of a template whose own words would meet
    its threshold (notices of one family differ in a word). ``score`` is the
    largest containment that met the threshold (0 without one). A
    null text counts as empty (no words, empty labels, null places); repeated
    rows and null ids keep their rows; other columns are ignored; an empty
    table gives no rows. Every whole text is read.
    """
    sets = template_words(templates)
    index = TemplateIndex(sets, word_frequencies(docs, set().union(*(s for _, s in sets)), text), threshold)
    lengths = [len(text.encode().translate(_TABLE).split()) for _, text in templates]
    wanted = [(b" " + b" ".join(p.encode().translate(_TABLE).split()) + b" ", label) for p, label in phrases]

    def scan(t: bytes) -> tuple:
        low = t.translate(_LINES)
        words = low.split()
        have = set(words)
        places, base, found, score, blocks = [], set(), set(), 0.0, 0
        if any(have.issuperset(p.split()) for p, _ in wanted):
            joined = b" " + b" ".join(words) + b" "
            for p, label in wanted:
                if at := phrase_places(joined, p):
                    places += at
                    base.add(label)
        if index.prefix & have and (candidates := index.match(have)):
            lines = [line.split() for line in low.split(b"\n")]
            starts, at = [], 0
            for line in lines:
                starts.append(at)
                at += len(line)
            notices = {k: notice_places(words, sets[k][1], index.need[k], lengths[k]) for k, _ in candidates}
            matches: dict[int, list[tuple[int, int, float]]] = {k: [] for k in notices}     # first word, last word, containment
            hit: set[tuple[int, int]] = set()
            for n, line in enumerate(lines):
                for k, part in index.match(set(line)) if line else ():
                    hit.add((n, k))
                    blocks += 1
                    matches[k].append((starts[n], starts[n] + len(line) - 1, part))
            for k, at_places in notices.items():
                whole, matches[k] = matches[k], []
                for first, last, shared in at_places:
                    matches[k].append((first, last, shared / len(sets[k][1])))
                    over = range(bisect_right(starts, first) - 1, bisect_right(starts, last))
                    blocks += not any((n, k) in hit for n in over)
                firsts, lasts = [p[0] for p in at_places], [p[1] for p in at_places]
                for first, last, part in whole:     # a line counts as a whole where no window stands in it or holds it
                    near = at_places[bisect_left(lasts, first):bisect_right(firsts, last)]
                    if not any(first <= f and l <= last or f <= first and last <= l for f, l, _ in near):
                        matches[k].append((first, last, part))
                matches[k].sort()       # by first word, and so by last word too
            bounds = {k: ([m[0] for m in own], [m[1] for m in own]) for k, own in matches.items()}

            def beaten(k: int, first: int, last: int, part: float) -> bool:
                return any(p > part for j in index.shadow[k].intersection(matches)
                           for _, _, p in matches[j][bisect_left(bounds[j][1], first):bisect_right(bounds[j][0], last)])

            for k, own in matches.items():
                score = max([score, *(part for _, _, part in own)])
                if any(not beaten(k, *m) for m in own):
                    found.add(sets[k][0])
        return (len(words), len(places), min(places, default=None), max(places, default=None),
                ",".join(sorted(base)), ",".join(sorted(base | found)), score, blocks)

    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.int64()]
    names = [c.split()[0] for c in RESULT.split(", ")]

    def run(batches):
        for b in text_slices(batches, "text"):
            rows = [scan(t) for t in utf8(b.column("text"))]
            yield with_columns(b, ["doc_id"], **{n: pa.array([r[i] for r in rows], types[i]) for i, n in enumerate(names)})

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id long, {RESULT}")
