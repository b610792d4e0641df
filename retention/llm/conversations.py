"""Conversation structure repair: cheapest edits to a legal order of roles, with an audit of the edits.

Legal role initials are ``(s?(ua)+)?``, an automaton of four states. A row
steps from state to state by Keep, Rerole or Delete, with Inserts before it;
dynamic programming keeps the cheapest audit for each state. Audits share
their prefixes: an edit is a node linked to the one before, with its
ancestors 1, 2, 4, ... edits back and a rolling hash of the whole prefix. Equal
costs are decided by the ASCII order of the audits: a search over the
ancestors finds the longest common prefix by its hashes, and the prefixes are
verified letter by letter up to a node that both share.

Rows that must be deleted take no node: every audit holds the same D there,
and inserts come as late as they can (D sorts before I). An insert comes
directly before the row that it serves, so each letter but I consumes a row,
and of two audits of the same rows neither is a prefix of the other.

Rows are range-partitioned by conversation and place. A conversation inside
one partition is finished there. One that crosses partitions, or is longer
than a block, goes on as blocks: a block's outcome for each pair of states is
a small matrix, these are folded in order, and each block is then replayed
between the states that the fold chose.
"""

from __future__ import annotations

import hashlib
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retention.llm.common import Scratch, shuffle_partitions

START, SYSTEM, USER, ASSISTANT = range(4)
#: the one role that an insert or a rerole can give in each state, and the state after it
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
_LEGAL = {"su", "ua", "au"}
_CLOSE = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
_SPACES = " \t\n\v\f\r"
_MODULUS, _BASE = (1 << 61) - 1, 911_382_323


class Edit:
    """A node: the last edit of an audit. ``up[i]`` is the node 2**i edits before."""

    __slots__ = ("letter", "depth", "hash", "up")

    def __init__(self, parent: Edit | None = None, letter: str = ""):
        self.letter, self.up = letter, []
        if parent is None:
            self.depth = self.hash = 0
            return
        self.depth, self.hash = parent.depth + 1, (parent.hash * _BASE + ord(letter)) % _MODULUS
        node, i = parent, 0
        while True:
            self.up.append(node)
            if i >= len(node.up):
                break
            node, i = node.up[i], i + 1

    def then(self, letters: str) -> Edit:
        node = self
        for c in letters:
            node = Edit(node, c)
        return node

    def at(self, depth: int) -> Edit:
        node = self
        while node.depth > depth:
            node = node.up[(node.depth - depth).bit_length() - 1]
        return node

    def audit(self) -> str:
        out, node = [], self
        while node.up:
            out.append(node.letter)
            node = node.up[0]
        return "".join(reversed(out))


def first_difference(x: Edit, y: Edit) -> tuple[Edit, Edit] | None:
    """Verifies two prefixes of one length: the nodes of their first different letter, None if they are equal."""
    found = None
    while x is not y:
        if x.letter != y.letter:
            found = (x, y)
        x, y = (x.up[0], y.up[0]) if x.up else (y, y)
    return found


def compare(x: Edit, y: Edit) -> int:
    """ASCII order of two audits: below, at or above 0."""
    depth = min(x.depth, y.depth)
    a, b = x.at(depth), y.at(depth)
    if a.hash == b.hash:
        if (found := first_difference(a, b)) is None:
            return x.depth - y.depth
    else:
        for i in range(len(a.up) - 1, -1, -1):      # the longest common prefix ends right before a and b then
            if i < len(a.up) and a.up[i].hash != b.up[i].hash:
                a, b = a.up[i], b.up[i]
        found = first_difference(a.up[0], b.up[0]) or (a, b)    # equal hashes of different prefixes: the first difference counts
    return ord(found[0].letter) - ord(found[1].letter)


def _steps(initial: str, truncated: bool) -> dict[tuple[int, int], tuple[int, str]]:
    """(state before, state after) -> (cost, edits) of one row, its cheapest and then ASCII-least."""
    out: dict[tuple[int, int], tuple[int, str]] = {}
    for p in range(4):
        options = [(DELETE, "D", p)]
        q, cost, letters = p, 0, ""
        for _ in range(3):
            if (q, initial) in _KEPT:
                options.append((cost + TRUNCATED * truncated, letters + "K", _KEPT[q, initial]))
            options.append((cost + REROLE + TRUNCATED * truncated, letters + "R", _NEXT[q]))
            q, cost, letters = _NEXT[q], cost + INSERT, letters + "I"
        for cost, letters, t in options:
            out[p, t] = min(out.get((p, t), (cost, letters)), (cost, letters))
    return out


_STEPS = {(c, cut): [(p, t, *x) for (p, t), x in sorted(_steps(c, cut).items())] for c in "sua?" for cut in (False, True)}


def walk(kinds: list[tuple[str, bool]], start: int) -> dict[int, tuple[int, Edit]]:
    """From ``start`` over rows (role initial, truncated): state -> (cost, audit) of the cheapest, ASCII-least edits."""
    at = {start: (0, Edit())}
    for kind in kinds:
        best: dict[int, tuple[int, Edit, str]] = {}
        for p, t, cost, letters in _STEPS[kind]:
            if p in at:
                so_far, node = at[p]
                held = best.get(t)
                if held is None or so_far + cost < held[0] or so_far + cost == held[0] and compare(node, held[1]) < 0:
                    best[t] = (so_far + cost, node, letters)
        at = {t: (cost, node.then(letters)) for t, (cost, node, letters) in best.items()}
    return at


def closed(ends: dict[int, tuple[int, Edit]]) -> tuple[int, int]:
    """(state, total cost) of the best audit that the end's inserts make legal."""
    best = None
    for p, (cost, node) in ends.items():
        cost += INSERT * len(_CLOSE[p])
        if best is None or cost < best[1] or cost == best[1] and compare(node, ends[best[0]][1]) < 0:
            best = (p, cost)
    return best


class Block:
    """Consecutive rows (turn, role, text, copies, digest) of a conversation; ``seen`` are digests of earlier blocks."""

    def __init__(self, rows: list[tuple], seen=()):
        self.rows, seen = rows, set(seen)
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.forced, self.kinds, turns, before = [], [], [], None
        for turn, role, text, n, digest in rows:
            bare = text.rstrip(_SPACES)
            again = digest in seen
            seen.add(digest)
            if not bare:
                self.blank += n
            else:
                self.duplicate += n - (not again)
                if not again and bare[-1] not in ".!?":
                    self.truncated += 1
            must = not bare or again
            self.forced.append(must)
            if not must:
                self.kinds.append((role[:1] if role[:1] in ("s", "u", "a") else "?", bare[-1] not in ".!?"))
            self.illegal += n - 1 + (before is not None and before + role[:1] not in _LEGAL)
            before = role[:1]
            if turn is not None:
                turns.append(turn)
        self.deletes = DELETE * (sum(r[3] for r in rows) - len(self.kinds))
        self.ends = [rows[0][1][:1], before] if rows else [None, None]
        self.turns = [turns[0], turns[-1], len(set(turns))] if turns else [None, None, 0]

    def replay(self, node: Edit, start: int, close: str) -> tuple[str, list[str]]:
        """The audit with the rows that had to go, and the repaired rows."""
        letters, state, audit, lines = iter(node.audit()), start, [], []

        def insert():
            nonlocal state
            state = _NEXT[state]
            lines.append(_ROLE[state] + ":")

        for (_, role, text, n, _), must in zip(self.rows, self.forced):
            if not must:
                while (c := next(letters)) == "I":
                    audit.append(c)
                    insert()
                audit.append(c)
                if c == "K":
                    state = _KEPT[state, role[:1]]
                    lines.append(f"{role}:{text}")
                elif c == "R":
                    state = _NEXT[state]
                    lines.append(f"{_ROLE[state]}:{text}")
            audit.append("D" * (n if must else n - 1))
        for c in close:
            audit.append(c)
            insert()
        return "".join(audit), lines


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


TOTALS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
RESULT = TOTALS + ", audit string, repaired_sha256 string"
_TOTALS = [c.split()[0] for c in TOTALS.split(", ")]
_PACKED = "array<struct<turn: long, role: string, text: string, copies: long, digest: binary>>"
_PACKED_TYPE = pa.list_(pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("copies", pa.int64()),
                                   ("digest", pa.binary())]))
_RESULT_TYPES = [*((n, pa.int64()) for n in _TOTALS), ("audit", pa.string()), ("repaired_sha256", pa.string())]


def _gaps(low, high, distinct) -> int:
    return 0 if low is None else high - low + 1 - distinct


def finished(rows: list[tuple]) -> dict:
    """The result of a conversation that is whole in one block."""
    b = Block(rows)
    ends = walk(b.kinds, START)
    end, cost = closed(ends)
    audit, lines = b.replay(ends[end][1], START, _CLOSE[end])
    return {"gaps": _gaps(*b.turns), "blank": b.blank, "duplicate": b.duplicate, "truncated": b.truncated, "illegal": b.illegal,
            "cost": cost + b.deletes, "audit": audit, "repaired_sha256": _sha("\n".join(lines).encode())}


def damage(rows: DataFrame, key: str = "conv_id") -> DataFrame:
    """``rows`` (conversation, turn, role, text) with the deterministic damage of the test query, and ``copies`` of each.

    By crc32(``conversation:turn``) % 20: 0 drops the row (no copies), 1
    empties the text, 2 removes its ``.!?``, 3 repeats the row, 4 makes it the
    user's. A null in any column is one space there.
    """
    blank = F.lit(" ")
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    kind = F.crc32(F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), blank) for c in (key, "turn")))) % 20
    return rows.select(
        F.col(key), F.col("turn").cast("long").alias("turn"), F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"))


def repair_conversations(rows: DataFrame, key: str = "conv_id", block_rows: int = 4096, block_bytes: int = 1 << 20) -> DataFrame:
    """``conv_id`` and ``RESULT``, one row per conversation of ``rows`` (conversation, ``turn``, ``role``, ``text``, ``copies``).

    A row's fault is the first of blank, duplicate (role and text of an earlier
    row), truncated (the text's last character that is no white space is not
    one of ``.!?``). Rows come by turn, nulls first; rows of one turn by role
    and then by digest of role and text, equal rows next to each other.
    ``copies`` counts a row (0: it only names its conversation). A null role
    or text is one space, a null conversation is one like any other; other columns are
    ignored; an empty table gives no rows. A conversation without rows has
    zeros, an empty audit and the digest of the empty string.

    The audit is as long as its conversation's rows, so one value of it is in
    one task; so is the running SHA-256 over a conversation, block after block.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark, "conversations")
    kind = rows.schema[key].dataType.simpleString()
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    order = ["conv_id", "turn", "role", "digest", "salt"]
    placed = rows.select(
        F.col(key).alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
        F.col("copies").cast("long").alias("copies"), F.unhex(F.sha2(F.concat_ws("\x00", role, text), 256)).alias("digest"),
        F.monotonically_increasing_id().alias("salt"))      # equal rows may lie in several ranges
    placed = (placed.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
              .drop("salt").withColumn("part", F.spark_partition_id()))

    def gather(batches):
        conv, buffer, size, number, split, part, out = _NONE, [], 0, 0, True, None, []

        def flush(whole: bool) -> None:
            nonlocal buffer, size, number
            row = {"conv_id": conv, "part": part, "k": number, "packed": None if whole else buffer}
            number += 1
            out.append(row | (finished([tuple(r.values()) for r in buffer]) if whole else {}))
            buffer, size = [], 0

        schema = None
        for b in batches:
            schema = pa.schema([("conv_id", b.schema.field("conv_id").type), ("part", pa.int32()), ("k", pa.int64()),
                                ("packed", _PACKED_TYPE), *_RESULT_TYPES])
            for r in b.to_pylist():
                part = r["part"]
                if conv is _NONE or r["conv_id"] != conv:
                    if conv is not _NONE:
                        flush(whole=not split)
                        split = False
                    conv = r["conv_id"]
                if r["copies"]:
                    buffer.append({n: r[n] for n in ("turn", "role", "text", "copies", "digest")})
                    size += len(r["text"])
                    if len(buffer) >= block_rows or size >= block_bytes:
                        flush(whole=False)
                        split = True
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
                out.clear()
        if conv is not _NONE:       # the last conversation may go on in the next range
            flush(whole=False)
            yield pa.RecordBatch.from_pylist(out, schema)

    result = ", ".join(f"{n.split()[0]} {n.split()[1]}" for n in RESULT.split(", "))
    done = scratch.store(placed.mapInArrow(gather, f"conv_id {kind}, part int, k long, packed {_PACKED}, {result}"), "ranges")
    whole = done.where("packed is null").select("conv_id", *[n for n, _ in _RESULT_TYPES])
    return whole.unionByName(_split_conversations(done.where("packed is not null").select("conv_id", "part", "k", "packed"), scratch, kind))


_NONE = object()


def _split_conversations(packed: DataFrame, scratch: Scratch, kind: str) -> DataFrame:
    """The result of conversations that lie in several blocks (``part``, ``k``)."""
    spots = packed.select("conv_id", "part", "k", F.explode(F.array_distinct(F.transform("packed", lambda x: x["digest"]))).alias("digest"))
    again = scratch.store(spots.groupBy("conv_id", "digest").agg(F.min(F.struct("part", "k")).alias("first"), F.count("*").alias("n"))
                          .where("n > 1").select(F.col("conv_id").alias("c"), F.col("digest").alias("d"), "first"), "again")
    seen = scratch.store(
        spots.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")))
        .where(F.struct("part", "k") > F.col("first")).groupBy(F.col("part").alias("p"), F.col("k").alias("b"))
        .agg(F.collect_list("digest").alias("seen")), "seen")      # as many as the block has rows at most
    blocks = scratch.store(packed.join(seen, (F.col("part") == F.col("p")) & (F.col("k") == F.col("b")), "left").drop("p", "b"), "blocks")

    def block_of(r) -> Block:
        return Block([tuple(x.values()) for x in r["packed"]], r["seen"] or ())

    def solve(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                x = block_of(r)
                cost, rank = [-1] * 16, [-1] * 16
                for s in range(4):
                    ends = walk(x.kinds, s)
                    for i, t in enumerate(sorted(ends, key=cmp_to_key(lambda y, z: compare(ends[y][1], ends[z][1])))):
                        cost[4 * s + t], rank[4 * s + t] = ends[t][0], i
                out.append({"conv_id": r["conv_id"], "part": r["part"], "k": r["k"], "cost": cost, "rank": rank, "ends": x.ends, "turns": x.turns,
                            "counts": [x.blank, x.duplicate, x.truncated, x.illegal, x.deletes]})
            yield pa.RecordBatch.from_pylist(out, pa.schema([
                b.schema.field("conv_id"), ("part", pa.int32()), ("k", pa.int64()), *((n, pa.list_(pa.int64())) for n in ("cost", "rank", "turns", "counts")),
                ("ends", pa.list_(pa.string()))]))

    solved = blocks.mapInArrow(solve, f"conv_id {kind}, part int, k long, cost array<long>, rank array<long>, turns array<long>, "
                                      "counts array<long>, ends array<string>")

    def fold(batches):
        """Block after block: the cheapest cost of each state, the audits' order, and the state that each came from."""
        conv, chain, out, schema = _NONE, [], [], None
        cost = order = counts = turns = last = None

        def close() -> None:
            ends = [t for t in range(4) if cost[t] is not None]
            end = min(ends, key=lambda t: (cost[t] + INSERT * len(_CLOSE[t]), order[t]))
            total = dict(zip(_TOTALS, [_gaps(*turns), *counts[:4], cost[end] + INSERT * len(_CLOSE[end]) + counts[4]]))
            close_with, state = True, end
            for part, k, back in reversed(chain):
                out.append({"conv_id": conv, "part": part, "k": k, "begin": back[state], "end": state, "last": close_with,
                            **(total if close_with else {})})
                close_with, state = False, back[state]

        for b in batches:
            schema = pa.schema([b.schema.field("conv_id"), ("part", pa.int32()), ("k", pa.int64()), ("begin", pa.int32()), ("end", pa.int32()),
                                ("last", pa.bool_()), *_RESULT_TYPES[:6]])
            for r in b.to_pylist():
                if conv is _NONE or r["conv_id"] != conv:
                    if conv is not _NONE:
                        close()
                    conv, chain, cost, order = r["conv_id"], [], [0, None, None, None], [0, 0, 0, 0]
                    counts, turns, last = [0] * 5, [None, None, 0], None
                best = {}
                for p in range(4):
                    for t in range(4):
                        c = r["cost"][4 * p + t]
                        if cost[p] is not None and c >= 0:
                            best[t] = min(best.get(t, (cost[p] + c, order[p], p)), (cost[p] + c, order[p], p))
                back = [best[t][2] if t in best else None for t in range(4)]
                place = {t: i for i, t in enumerate(sorted(best, key=lambda t: (best[t][1], r["rank"][4 * back[t] + t])))}
                cost, order = [best[t][0] if t in best else None for t in range(4)], [place.get(t, 0) for t in range(4)]
                chain.append((r["part"], r["k"], back))
                counts = [x + y for x, y in zip(counts, r["counts"])]
                if r["ends"][0] is not None:
                    counts[3] += last is not None and last + r["ends"][0] not in _LEGAL
                    last = r["ends"][1]
                if r["turns"][0] is not None:
                    low, high, n = r["turns"]
                    turns = [low if turns[0] is None else turns[0], high, turns[2] + n - (turns[1] == low)]
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
                out.clear()
        if conv is not _NONE:
            close()
            yield pa.RecordBatch.from_pylist(out, schema)

    parts = shuffle_partitions(packed.sparkSession)
    folded = scratch.store(
        solved.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "part", "k").mapInArrow(
            fold, f"conv_id {kind}, part int, k long, begin int, end int, last boolean, {TOTALS}")
        .withColumnsRenamed({"part": "p", "k": "b", "conv_id": "c"}), "folded")
    chosen = blocks.join(folded, (F.col("part") == F.col("p")) & (F.col("k") == F.col("b"))).drop("p", "b", "c")

    def replay(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                x = block_of(r)
                node = walk(x.kinds, r["begin"])[r["end"]][1]
                audit, lines = x.replay(node, r["begin"], _CLOSE[r["end"]] if r["last"] else "")
                out.append({n: r[n] for n in ("conv_id", "part", "k", "last", *_TOTALS)}
                           | {"piece": audit, "lines": "\n".join(lines).encode() if lines else None})
            yield pa.RecordBatch.from_pylist(out, pa.schema([
                b.schema.field("conv_id"), ("part", pa.int32()), ("k", pa.int64()), ("last", pa.bool_()), *_RESULT_TYPES[:6],
                ("piece", pa.string()), ("lines", pa.binary())]))

    replayed = chosen.mapInArrow(replay, f"conv_id {kind}, part int, k long, last boolean, {TOTALS}, piece string, lines binary")

    def join(batches):
        audit, digest, empty = [], hashlib.sha256(), True
        for b in batches:
            out = []
            for r in b.to_pylist():
                audit.append(r["piece"])
                if r["lines"] is not None:
                    digest.update(r["lines"] if empty else b"\n" + r["lines"])
                    empty = False
                if r["last"]:
                    out.append({n: r[n] for n in ("conv_id", *_TOTALS)} | {"audit": "".join(audit), "repaired_sha256": digest.hexdigest()})
                    audit, digest, empty = [], hashlib.sha256(), True
            yield pa.RecordBatch.from_pylist(out, pa.schema([b.schema.field("conv_id"), *_RESULT_TYPES]))

    return replayed.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "part", "k").mapInArrow(join, f"conv_id {kind}, {RESULT}")


def repair_sql() -> str:
    """DuckDB SQL for the rows of ``repair_conversations(damage(conversations))``: whole audits, row after row, in a recursive query.

    ``step`` lists, for each state, the letters of one row's edits with their cost, the rows put in before it and the
    state after; a conversation's next row keeps, for each state, the cheapest and then ASCII-least audit.
    """
    step = []
    for p in range(4):
        q, cost, letters, put = p, 0, "", []
        step.append(f"({p}, NULL, 'D', {DELETE}, '', NULL, {p}, true)")
        for _ in range(3):
            before = "".join(r + r":\n" for r in put).replace(r"\n", "\n")
            step += [f"({p}, '{c}', '{letters}K', {cost}, '{before}', NULL, {t}, false)" for (s, c), t in _KEPT.items() if s == q]
            step.append(f"({p}, NULL, '{letters}R', {cost + REROLE}, '{before}', '{_ROLE[_NEXT[q]]}', {_NEXT[q]}, false)")
            q, cost, letters = _NEXT[q], cost + INSERT, letters + "I"
            put.append(_ROLE[q])
    close = [f"({p}, '{x}', {INSERT * len(x)}, '{''.join(r + ':' + chr(10) for r in ('user', 'assistant')[2 - len(x):])}')" for p, x in _CLOSE.items()]
    space = r"[ \t\n\x0B\f\r]"
    return rf"""
        WITH RECURSIVE
        tab AS (SELECT list(c ORDER BY b) AS t FROM (SELECT b, list_reduce(list_prepend(b, range(8)),
                lambda c, k: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)) AS c FROM range(256) r(b))),
        given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                  coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
        kinds AS (SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(k, ''), lambda x: CAST(ascii(x) AS BIGINT))),
                  lambda c, b: xor(c >> 8, tab.t[CAST(xor(c, b) & 255 AS BIGINT) + 1])), 4294967295) % 20 AS kind FROM given, tab),
        harm AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                 CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                 unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM kinds),
        placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(role || chr(0) || text), copy) AS i,
                   regexp_replace(text, '{space}+$', '') AS bare FROM harm),
        seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
                 lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed),
        rows AS (SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault
                 FROM seen),
        step(p, keep, letters, cost, put, rerole, t, gone) AS (VALUES {', '.join(step)}),
        walk AS (SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS state, 0::BIGINT AS cost, '' AS audit, '' AS lines FROM conversations
                 UNION ALL
                 SELECT conv_id, i, t, best.cost, best.audit, best.lines FROM (
                     SELECT w.conv_id, r.i, s.t, min(struct_pack(
                         cost := w.cost + s.cost + CASE WHEN r.fault = 'truncated' AND NOT s.gone THEN {TRUNCATED} ELSE 0 END,
                         audit := w.audit || s.letters,
                         lines := w.lines || CASE WHEN s.gone THEN '' ELSE s.put || coalesce(s.rerole, r.role) || ':' || r.text || chr(10) END)) AS best
                     FROM walk w JOIN rows r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1
                     JOIN step s ON s.p = w.state AND (s.keep IS NULL OR s.keep = left(r.role, 1)) AND (s.gone OR coalesce(r.fault, '') NOT IN ('blank', 'duplicate'))
                     GROUP BY w.conv_id, r.i, s.t)),
        shut(state, letters, cost, put) AS (VALUES {', '.join(close)}),
        total AS (SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
                  count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
                  count(*) FILTER (before || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM rows GROUP BY conv_id),
        done AS (SELECT w.conv_id, min(struct_pack(cost := w.cost + s.cost, audit := w.audit || s.letters, lines := w.lines || s.put)) AS best
                 FROM walk w JOIN shut s USING (state) LEFT JOIN total t ON t.conv_id IS NOT DISTINCT FROM w.conv_id
                 WHERE w.i = coalesce(t.n, 0) GROUP BY w.conv_id)
        SELECT d.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
               coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, best.cost::BIGINT AS cost, best.audit AS audit,
               sha256(CASE WHEN best.lines = '' THEN '' ELSE left(best.lines, length(best.lines) - 1) END) AS repaired_sha256
        FROM done d LEFT JOIN total t ON t.conv_id IS NOT DISTINCT FROM d.conv_id"""
