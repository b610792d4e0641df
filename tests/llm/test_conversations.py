"""Conversation repair against a plain search over whole audit strings."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import types as T

from retention.llm import conversations as C

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                       T.StructField("text", T.StringType()), *(T.StructField(n, T.StringType()) for n in ("part", "k", "copies", "digest"))])


def tables(spark, kind):
    if kind == "given":
        return spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rnd = random.Random(3)
    rows = []
    for conv in [None, *range(40)]:
        for i in range(rnd.choice([0, 1, 2, 3, 5, 9, 30])):
            turn = None if rnd.random() < 0.1 else rnd.choice([i, i, i + 3])
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "unit"])
            text = rnd.choice([None, "", " \n", "Fine.", "Fine.", "no end", "odd?!", " ", f"say {i}.", "what? then "])
            rows.append((conv, turn, role, text, "x", "x", "x", "x"))
    rows += [(99, i % 50, ["user", "assistant"][i % 2], f"n {i % 70}" + "." * (i % 3 > 0), "x", "x", "x", "x") for i in range(900)]
    rows += [(98, 4, "user", "the same.", "x", "x", "x", "x")] * 300 + [(97, i, "user", "z" * 3000 + ".", "x", "x", "x", "x") for i in range(9)]
    rnd.shuffle(rows)
    return spark.createDataFrame(rows if kind == "odd" else [], SCHEMA).repartition(4)


def damaged(conv, rows):
    """Rows (turn, role, text) in order after damage."""
    out = []
    for turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(f"{r[1]}\0{r[2]}".encode()).digest()))


def brute(conv, given):
    rows = damaged(conv, given)
    faults, seen = [], set()
    for _, role, text in rows:
        bare = re.sub("[\x20\x09-\x0D]", "", text)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    # state by the initials so far; whole strings are kept and compared
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    at = {"": (0, "", ())}

    def better(table, state, cost, audit, lines):
        if state is not None and (state not in table or (cost, audit) < table[state][:2]):
            table[state] = (cost, audit, lines)
            return True

    def insert(table):
        todo = list(table)
        while todo:
            state = todo.pop()
            cost, audit, lines = table[state]
            for role in ("user", "assistant"):
                to = step.get((state, role[0]))
                if better(table, to, cost + 3, audit + "I", (*lines, role + ":")):
                    todo.append(to)

    insert(at)
    for (_, role, text), fault in zip(rows, faults):
        new = {}
        for state, (cost, audit, lines) in at.items():
            better(new, state, cost + 4, audit + "D", lines)
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                better(new, step.get((state, role[:1])), cost + more, audit + "K", (*lines, f"{role}:{text}"))
                for other in ("user", "assistant"):
                    better(new, step.get((state, other[0])), cost + 3 + more, audit + "R", (*lines, f"{other}:{text}"))
        insert(new)
        at = new
    cost, audit, lines = min(at[s] for s in ("", "a") if s in at)
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [x[1][:1] + y[1][:1] for x, y in itertools.pairwise(rows)]
    return (conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


@pytest.mark.parametrize("kind", ["given", "odd", "empty"])
def test_repair(spark, kind):
    rows = tables(spark, kind)
    by = {}
    for r in rows.select("conv_id", "turn", "role", "text").collect():
        by.setdefault(r.conv_id, []).append(tuple(r)[1:])
    want = sorted((brute(c, x) for c, x in by.items()), key=str)
    for size in ({}, {"block_rows": 3}, {"block_rows": 50, "block_bytes": 400}):
        got = C.repair_conversations(C.damage(rows), **size)
        assert got.columns == ["conv_id", *(n.split()[0] for n in C.RESULT.split(", "))]
        assert sorted(map(tuple, got.collect()), key=str) == want


def test_every_edit_tried():
    """Small conversations, with all audits of at most two inserts between rows enumerated."""
    rnd = random.Random(8)
    legal = re.compile("(s?(ua)+)?")
    for _ in range(60):
        n = rnd.randint(0, 3)
        rows = [(i, rnd.choice(["system", "user", "assistant", "tool"]), rnd.choice(["a.", "a", "b", ""]), rnd.choice([1, 1, 2])) for i in range(n)]
        flat = [(t, r, x) for t, r, x, k in rows for _ in range(k)]
        seen, options = set(), []
        for _, role, text in flat:
            must = not text or (role, text) in seen
            seen.add((role, text))
            cut = 3 * (text[-1:] not in ".!?")
            options.append([("D", "", 4)] + [] if must else [("D", "", 4), ("K", role[0], cut), ("R", "u", 3 + cut), ("R", "a", 3 + cut)])
        gaps = [[("I" * k, "".join(p), 3 * k) for k in range(3) for p in itertools.product("ua", repeat=k)]] * (len(flat) + 1)
        best = None
        for picks in itertools.product(*options):
            for fill in itertools.product(*gaps[:len(flat) + 1]) if len(flat) < 3 else [()]:
                if not fill:
                    break
                edits = [x for pair in itertools.zip_longest(fill, picks) for x in pair if x]
                if legal.fullmatch("".join(e[1] for e in edits)):
                    found = (sum(e[2] for e in edits), "".join(e[0] for e in edits))
                    best = min(best or found, found)
        if best is not None:
            got = C.finished([(t, r, x, k, (r, x)) for t, r, x, k in rows])
            assert (got["cost"], got["audit"]) == best


def test_order_of_audits(monkeypatch):
    """The search over hashed ancestors gives the order of the strings, also where every hash collides."""
    for modulus in (C._MODULUS, 1, 7):
        monkeypatch.setattr(C, "_MODULUS", modulus)
        rnd = random.Random(modulus)
        nodes = [(C.Edit(), "")]
        for _ in range(400):
            node, s = rnd.choice(nodes[-40:])
            letters = "".join(rnd.choice("DK") for _ in range(rnd.randint(1, 6)))
            nodes.append((node.then(letters), s + letters))
        assert all(n.audit() == s for n, s in nodes)
        for (x, s), (y, t) in (rnd.sample(nodes, 2) for _ in range(3000)):
            order = C.compare(x, y)
            assert (order > 0) - (order < 0) == (s > t) - (s < t)
