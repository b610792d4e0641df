"""Alignment against plain loops over the bytes, with the two tokenizer libraries as the source of ids."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import types as T

from retention.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       *(T.StructField(n, T.StringType()) for n in ("slots", "n_a", "a_ids"))])


def tables(spark, kind):
    if kind == "given":
        return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rnd = random.Random(9)
    chars = "ab e. ,\n\t'1é日▁\U0001f600\x00<| ́ﬁ "
    texts = [None, "", " ", "  ", "a", "a", "<|endoftext|> <s> </s> <unk> <0x41>", "▁a", "x" * 70_000, " " * 3000 + "x", "don't  stop\n\n\n",
             "日本語の文", "Ünïcödé ﬁne", "tail "] + ["".join(rnd.choice(chars) for _ in range(rnd.randint(1, 60))) for _ in range(60)]
    rows = [(None if i % 7 == 5 else i // 2, t, "x", "x", "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows if kind == "odd" else [], SCHEMA).repartition(3)


def brute(texts):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer, decoders
    a_lib, b_lib = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a_lib.encode_special_tokens = True
    back = {c: b for b, c in zip(range(256), [None] * 256)}
    back = {}
    n = 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            back[chr(b)] = b
        else:
            back[chr(256 + n)] = b
            n += 1
    assert decoders.ByteLevel().decode(["Ġa"]) == " a" and back["Ġ"] == 32
    docs, links = [], []
    for t in texts:
        a = a_lib.encode(" " + t, add_special_tokens=False) if t else None
        ta = [(i, bytes(back[c] for c in s)) for i, s in zip(a.ids, a.tokens)] if t else []
        tb = []
        for i in b_lib.encode(t) if t else []:
            p = b_lib.id_to_piece(i)
            tb.append((i, bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode()))
        if not t or not b"".join(x for _, x in ta) == (" " + t).encode() == b"".join(x for _, x in tb):
            docs.append(([], [], []))
            links.append([])
            continue
        ends = []
        for side in (ta, tb):
            at, out = 0, {}
            for i, x in side:
                at += len(x)
                out[at] = i
            ends.append(out)
        common = sorted(set(ends[0]) & set(ends[1]))
        links.append([(ends[0][e], ends[1][e]) for e in common])
        groups, low = [], 0
        for e in common:
            groups.append(([i for p, i in ends[0].items() if low < p <= e], [i for p, i in ends[1].items() if low < p <= e]))
            low = e
        docs.append(([i for i, _ in ta], [i for i, _ in tb], groups))
    count = Counter(p for x in links for p in x)
    top = {}
    for (_, b), k in count.items():
        top[b] = max(top.get(b, 0), k)
    out = []
    for (a, b, groups), own in zip(docs, links):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((len(a), len(b), len(groups), len(own), sum(count[p] == top[p[1]] for p in own), sum(count[p] for p in own),
                    hashlib.sha256(text.encode()).hexdigest() if a else "", sum(len(x) * len(y) for x, y in groups)))
    return out


@pytest.mark.parametrize("kind", ["given", "odd", "empty"])
def test_align(spark, kind):
    docs = tables(spark, kind)
    rows = docs.select("doc_id", "text").collect()
    want = sorted(((r.doc_id, *x) for r, x in zip(rows, brute([r.text for r in rows]))), key=str)
    got = alignment.align_documents(docs, A, B).collect()
    assert sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256, r.n_shared)
                   for r in got), key=str) == want


def test_links(spark):
    """Overlaps are all pairs of tokens with bytes in common, and together cover each byte once."""
    docs = tables(spark, "odd").where("length(text) < 5000")
    v = alignment.Aligner(A, B)
    text = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None and r.doc_id % 2}
    rows = alignment.align_documents(docs.where("doc_id % 2 = 1"), A, B, with_links=True).collect()
    assert rows
    for r in rows:
        spans = []
        for ids, side in ((r.a_ids, v.a), (r.b_ids, v.b)):
            ends = np.cumsum([len(side.bytes[i]) for i in ids]).tolist()
            spans.append(list(zip([0, *ends], ends)))
        want = {(i, j): min(y, z) - max(x, w) for i, (x, y) in enumerate(spans[0]) for j, (w, z) in enumerate(spans[1]) if min(y, z) > max(x, w)}
        assert {(o.a, o.b): o.n_bytes for o in r.overlaps} == want and len(r.overlaps) == len(want)
        if r.a_ids:
            assert sum(want.values()) == spans[0][-1][1]
    assert any(r.a_ids for r in rows) and text


def test_products():
    """Row products and group products against dense ones, in one run and in many."""
    rng = np.random.default_rng(4)
    def rows(m):
        i, j = np.nonzero(m)
        return alignment.Rows(np.concatenate([[0], np.cumsum((m != 0).sum(1))]), j, m[i, j], m.shape[1])
    for _ in range(20):
        a, b = (rng.integers(0, 4, s) * (rng.random(s) < 0.4) for s in ((17, 11), (11, 13)))
        for most in (1, 7, 1 << 20):
            out = np.zeros((17, 13), dtype=int)
            for first, p in alignment.products(rows(a), rows(b), most):
                for i in range(len(p)):
                    out[first + i, p.indices[p.indptr[i]:p.indptr[i + 1]]] += p.values[p.indptr[i]:p.indptr[i + 1]]
            assert (out == a @ b).all()
        t = rows(a).transposed()
        assert (np.repeat(np.arange(len(t)), np.diff(t.indptr)) == np.nonzero(a.T)[0]).all() and (t.indices == np.nonzero(a.T)[1]).all()
    v = alignment.Aligner(A, B)
    x = v.align(["the plain text of it, don't".encode(), b"", "école 日本".encode()])
    pairs = {(first + i, j) for first, p in x.shared_groups() for i in range(len(p)) for j in p.indices[p.indptr[i]:p.indptr[i + 1]].tolist()}
    assert pairs == {(i, j) for i, g in enumerate(x.group_a) for j, h in enumerate(x.group_b) if g == h}
    assert len(pairs) == x.shared_counts().sum()


def test_shared_links_come_from_the_group_product(spark, monkeypatch):
    """``n_shared`` sums the rows of the group product: in runs of any size it stays, and a product of twice the values doubles it."""
    texts = ["the plain text of it, don't".encode(), b"", "école 日本 ".encode() * 40]
    v = alignment.Aligner(A, B)
    x = v.align(texts)
    want = [sum(g == h for g in x.group_a[i:j].tolist() for h in x.group_b[k:m].tolist())
            for i, j, k, m in zip(x.cuts_a, x.cuts_a[1:], x.cuts_b, x.cuts_b[1:])]
    assert x.by_text(x.shared_counts(), x.cuts_a).tolist() == want and v.align([b""]).shared_counts().tolist() == []
    plain = alignment.products
    monkeypatch.setattr(alignment, "products", lambda a, b: plain(a, b, 7))
    assert x.by_text(x.shared_counts(), x.cuts_a).tolist() == want
    monkeypatch.setattr(alignment, "products", lambda a, b: ((i, alignment.Rows(p.indptr, p.indices, 2 * p.values, p.width)) for i, p in plain(a, b)))
    assert x.by_text(x.shared_counts(), x.cuts_a).tolist() == [2 * n for n in want]


def test_encoders_agree():
    """The faster encoder gives the library's ids; long blank runs go to the library."""
    v = alignment.ByteLevel(A)
    assert v.fast is not None
    texts = [f"a{chr(c)}b {chr(c)}1{chr(c)} {chr(c)}{chr(c)} '{chr(c)}s\n{chr(c)}" for c in range(0x20, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    texts += ["x" + " " * 1_000_000 + "y", "\n" * 5000, "don't we'll  I'M"]
    assert v.encode(texts) == [e.ids for e in v.slow.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
