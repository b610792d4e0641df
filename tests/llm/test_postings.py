"""The inverted index and its search against plain loops over the words."""

import hashlib
import random
import re

import pytest
from pyspark.sql import types as T

from retention.llm import postings
from retention.llm.common import Scratch

SF = "/root/testdata/sf0.001"
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     *(T.StructField(n, T.StringType()) for n in ("uid", "item_id", "words", "spans", "n_words"))])
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()),
                      *(T.StructField(n, T.StringType()) for n in ("doc_id", "item", "block"))])


def words(text):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=10):
    wins = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[k:k + window]), set()).add("" if i is None else str(i))
    lengths = {len(x) for x in wins}
    out = []
    for i, t in docs:
        w, hit, met = words(t), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if own := wins.get(tuple(w[k:k + n])):
                    hit.update(range(k, k + n))
                    met |= own
        ids = ",".join(sorted(met))
        out.append((i, len(w), len(hit), len(met), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def tables(spark, kind):
    if kind == "given":
        return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    rnd = random.Random(5)
    few = [f"w{i}" for i in range(6)] + ["École", "日本", "Is"]
    some = [" ".join(rnd.choice(few) for _ in range(rnd.randint(3, 25))) for _ in range(30)]
    docs = [(1, None), (2, ""), (3, " .,!\n"), (4, "one"), (None, some[0]), (None, None), (5, some[1]), (5, some[1]), (5, "w1 w1")]
    docs += [(10 + i, (", " if i % 2 else " x ").join(rnd.sample(some, 4))) for i in range(20)]
    docs += [(90, " ".join(rnd.choice(few) for _ in range(9000))), (91, "same " * 4000), (92, "y" * 5000 + " w1 w2 " + "z" * 5000)]
    items = [(i, t.upper() if i % 3 else t) for i, t in enumerate(some)] + [(7, "one"), (7, "w1 w1"), (None, some[1]), (40, None), (41, ""), (42, "-"),
             (43, "same " * 30), (44, "not there at all"), (45, "w2 " * 9), (46, some[3]), (46, some[3]), (47, "y" * 5000 + " W1 w2"),
             (48, " ".join(["q" * 300] * 12 + ["w1"] * 30)), (49, docs[-3][1])]
    if kind == "no items":
        items = []
    if kind == "no documents":
        docs = []
    return (spark.createDataFrame([(*d, "x", "x", "x", "x", "x") for d in docs], DOCS).repartition(3),
            spark.createDataFrame([(*i, "x", "x", "x") for i in items], ITEMS).repartition(2))


@pytest.mark.parametrize("kind", ["given", "odd", "no items", "no documents"])
def test_decontaminate(spark, kind):
    docs, items = tables(spark, kind)
    want = brute(docs.select("doc_id", "text").collect(), items.select("item_id", "text").collect())
    for size in ({}, {"segment_bytes": 2000, "block_bytes": 3000}):       # texts and items cut into pieces, several blocks
        got = postings.decontaminate(docs, items, **size).collect()
        assert sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got), key=str) == want
        assert all(r.n_hit == sum(s.b - s.a + 1 for s in r.spans or ()) and r.n_items == len(r["items"] or ()) for r in got)


@pytest.mark.parametrize("size", [1 << 22, 2000])
def test_near(spark, size):
    """Every word of a window at most 12 words from its rarest one, whatever the order."""
    rnd = random.Random(11)
    docs = [(i, " ".join(rnd.choice("abcdefghijklmnopqrst") for _ in range(n))) for i, n in enumerate([5, 60, 300, 2000, 3])]
    items = [(0, "a b c"), (1, "q r s t"), (2, "a a b"), (3, "e f g h i j"), (4, "none a b")]
    total = {}
    for _, t in docs:
        for w in t.split():
            total[w] = total.get(w, 0) + 1
    want = {}
    for i, t in docs:
        have, hit, met = t.split(), set(), set()
        for k, item in items:
            win = item.split()
            if any(w not in total for w in win):
                continue
            j = min(range(len(win)), key=lambda x: (total[win[x]], x))
            for at in (p for p, w in enumerate(have) if w == win[j]):
                low, high = max(0, at - 12), min(len(have) - 1, at + 12)
                places = [at if x == j else next((p for p in range(low, high + 1) if have[p] == w), None) for x, w in enumerate(win)]
                if None not in places:
                    hit.update(range(min(places), max(places) + 1))
                    met.add(str(k))
        want[i] = (len(hit), ",".join(sorted(met)))
    got = postings.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"),
                                 spark.createDataFrame(items, "item_id long, text string"), within=12, segment_bytes=size)
    assert {r.doc_id: (r.n_hit, ",".join(r["items"] or ())) for r in got.collect()} == want


def test_index_is_whole(spark):
    """The lists of all segments together hold every word of every text at its place."""
    import numpy as np
    docs, _ = tables(spark, "odd")
    index = postings.build_index(docs, Scratch(spark, "t"), segment_bytes=3000).collect()
    text = {}
    for row in index:
        counts = np.frombuffer(row["counts"], dtype=np.int32)
        places = np.frombuffer(row["places"], dtype=np.int32)
        at = 0
        for term, n in zip(row["terms"].split(), counts.tolist()):
            for p in places[at:at + n].tolist():
                piece = max(i for i, b in enumerate(row["base"]) if b <= p)
                text.setdefault(row["uid"][piece], {})[row["first"][piece] + p - row["base"][piece]] = term.decode()
            at += n
    ids = {d.uid: (d.doc_id, d.n_words) for row in index for d in row["docs"]}
    got = sorted(((i, [text[u][k] for k in range(n)] if n else []) for u, (i, n) in ids.items()), key=str)
    assert got == sorted(((r.doc_id, words(r.text)) for r in docs.collect()), key=str)
