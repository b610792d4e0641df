"""Exact quantiles (linear interpolation, pandas' rule) without holding a
group in one task, in two scans of the rows.

For each group and probability p the values at 0-based ranks
r0 = floor(p (n - 1)) and r1 = min(r0 + 1, n - 1) are needed.

1. The first scan keeps a mergeable rank summary per group
   (``percentile_approx``, rank error 1 / accuracy) and so brackets each rank
   between two values.
2. The second scan counts exactly how many rows lie below, at and between the
   brackets' ends, and stores the values strictly inside brackets with their
   counts: a few rows in ten thousand, ties once. A rank at an end is that value.
3. What is left works on the stored values alone. A bracket that holds more
   than ``max_bracket`` rows is narrowed by counting: proposals come from the
   sketch, or, where the last one took away less than half of the rows, are
   the lower half of the bracket's doubles, so each round shrinks it, at the
   latest to a single value. The values of the final brackets are ranked with
   a window partitioned by (group, bracket).

Brackets live in a small local table (one row per group, at most
``max_groups`` groups, a larger number raises) that is broadcast-joined to the
rows; every pass is a groupBy with map-side partial aggregation, and only
per-group scalars reach the driver.
"""

from __future__ import annotations

import math
import struct
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retention.session import materialize

SEP = "\u0001"


def _key_of(row, keys: list[str]) -> str:
    return SEP.join("" if row[k] is None else str(row[k]) for k in keys)


def _attach(data: DataFrame, keys: list[str], key_types: dict, entries: list[dict], extra: dict) -> DataFrame:
    """Rows of ``data`` paired with each bracket of their group that holds
    their value. ``entries`` are dicts with the key values, ``_pi``, ``_blo``,
    ``_bhi`` and the ``extra`` columns (name -> SQL type)."""
    spark = data.sparkSession
    cols = [(f"_k{i}", key_types[k]) for i, k in enumerate(keys)] + [
        ("_pi", "int"), ("_blo", "double"), ("_bhi", "double")] + list(extra.items())
    schema = ", ".join(f"{n} {t}" for n, t in cols)
    rows = [tuple([e["keys"][i] for i in range(len(keys))] + [e["_pi"], e["_blo"], e["_bhi"]]
                  + [e.get(n) for n in extra]) for e in entries]
    inside = (F.col("_v") >= F.col("_blo")) & (F.col("_v") <= F.col("_bhi"))
    if keys:
        table = spark.createDataFrame(rows, schema)
        cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
        joined = data.join(F.broadcast(table), cond, "inner")
    else:
        # a single group: the brackets are a few literal structs, exploded per row
        structs = [F.struct(*[F.lit(r[j]).cast(t).alias(n) for j, (n, t) in enumerate(cols)]) for r in rows]
        joined = data.select("*", F.explode(F.array(*structs)).alias("_b")).select(
            *data.columns, *[F.col(f"_b.{n}").alias(n) for n, _ in cols])
    return joined.filter(inside).drop(*[f"_k{i}" for i in range(len(keys))])


def sketch(value: str, probs: list[float], accuracy: int = 10000) -> list[Column]:
    """Aggregates of the first scan: ``_n``, ``_lo``, ``_hi`` and ``_q``, the values around each probability.

    ``percentile_approx`` keeps a mergeable summary whose rank error is 1 /
    ``accuracy`` of the rows; the probabilities asked for lie three times that
    on either side. For callers that aggregate anyway.
    """
    v = F.col(value).cast("double")
    v = F.when(~F.isnan(v), v)
    return [F.count(v).alias("_n"), F.min(v).alias("_lo"), F.max(v).alias("_hi"),
            F.percentile_approx(v, _around(probs, accuracy), accuracy).alias("_q")]


def _around(probs: list[float], accuracy: int) -> list[float]:
    return sorted({min(1.0, max(0.0, p + side * 3.0 / accuracy)) for p in probs for side in (-1, 1)})


def group_bounds(data: DataFrame, keys: list[str], max_groups: int, value: str = "_v", probs: list[float] = (0.5,),
                 accuracy: int = 10000) -> list:
    """``sketch`` per group, as local rows; raises on more than ``max_groups``."""
    rows = data.groupBy(*keys).agg(*sketch(value, list(probs), accuracy)).limit(max_groups + 1).collect()
    if len(rows) > max_groups:
        raise ValueError(f"more than {max_groups} groups: use an approximate quantile per group")
    return rows


def _values(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    v = F.col(value).cast("double")
    return df.select(*keys, v.alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float],
                    max_bracket: int = 1_000_000, accuracy: int = 10000, max_groups: int = 100_000,
                    base: list | None = None) -> dict:
    """Return {group key string: [q(p) for p in probs]} for non-empty groups.

    ``df`` holds ``keys`` and a numeric ``value`` column; NULL and NaN are ignored.
    Group key strings join ``str`` of the key values with U+0001.
    ``base`` may carry per-group rows (mappings with the key columns and the
    columns of ``sketch`` for the same ``probs`` and ``accuracy``) that the caller already aggregated,
    saving the first scan.
    """
    data = _values(df, keys, value)
    key_types = {f.name: f.dataType.simpleString() for f in data.schema.fields if f.name in keys}
    if base is None:
        base = group_bounds(data, keys, max_groups, "_v", probs, accuracy)
    asked = _around(probs, accuracy)
    places, groups, brackets = {}, {}, {}
    for r in base:
        n = r["_n"]
        if not n:
            continue
        g = _key_of(r, keys)
        groups[g] = tuple(r[k] for k in keys)
        for p in probs:
            at = p * (n - 1)
            r0 = int(math.floor(at))
            places.setdefault(g, []).append((r0, min(r0 + 1, n - 1), at - r0))
            low, high = (min(1.0, max(0.0, p + side * 3.0 / accuracy)) for side in (-1, 1))
            brackets.setdefault(g, []).append((float(r["_lo"]) if low <= 0 else r["_q"][asked.index(low)],
                                               float(r["_hi"]) if high >= 1 else r["_q"][asked.index(high)]))
    wanted = {g: sorted({r for r0, r1, _ in of for r in (r0, r1)}) for g, of in places.items()}
    found: dict = {}
    while wanted:       # once, but for a sketch that exceeds its stated error threefold
        wanted, brackets = _select(data, keys, key_types, groups, brackets, wanted, found, max_bracket, accuracy)
    return {g: [found[(g, r0)] + (found[(g, r1)] - found[(g, r0)]) * frac if frac else found[(g, r0)]
                for r0, r1, frac in triples] for g, triples in places.items()}


def _select(data: DataFrame, keys: list[str], key_types: dict, groups: dict, brackets: dict, wanted: dict, found: dict,
            max_bracket: int, accuracy: int) -> tuple[dict, dict]:
    """One scan: counts the rows between all bracket ends and stores the values strictly inside brackets.

    A row's place is the number of ends below it plus the number of ends at
    or below it: odd at an end, even in a gap between two. Rows are summed by
    (group, place, value inside a bracket) in their own task first, so ties
    and rows outside are one row a task. Puts the values of the ranks into ``found``;
    returns the ranks that lie outside the brackets, with brackets that hold them.
    """
    spark = data.sparkSession
    ends, inner = {}, {}
    for g in wanted:
        union: list[list[float]] = []
        for lo, hi in sorted(brackets[g]):
            if union and lo <= union[-1][1]:
                union[-1][1] = max(union[-1][1], hi)
            else:
                union.append([lo, hi])
        ends[g] = sorted({x for lo, hi in union for x in (lo, hi)})
        inner[g] = [2 * i for i in range(1, len(ends[g])) if any(lo <= ends[g][i - 1] and ends[g][i] <= hi for lo, hi in union)]
    width = max(map(len, ends.values()))
    names = [f"_e{i}" for i in range(width)]
    rows = [(*groups[g], *(ends[g] + [math.nan] * (width - len(ends[g]))), inner[g]) for g in wanted]    # no value is at or above a NaN
    if keys:
        schema = ", ".join([f"_k{i} {key_types[k]}" for i, k in enumerate(keys)] + [f"{n} double" for n in names] + ["_inner array<int>"])
        on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
        placed = data.join(F.broadcast(spark.createDataFrame(rows, schema)), on)     # a row per group
    else:
        placed = data.select("*", *[F.lit(x).alias(n) for n, x in zip(names, rows[0])],
                             F.lit(rows[0][-1]).cast("array<int>").alias("_inner"))
    place = F.expr(" + ".join(f"(CASE WHEN {n} < _v THEN 1 ELSE 0 END) + (CASE WHEN {n} <= _v THEN 1 ELSE 0 END)" for n in names))
    counted = placed.select(*keys, "_v", place.alias("_place"), "_inner").groupBy(
        *keys, "_place", F.when(F.array_contains("_inner", F.col("_place")), F.col("_v")).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    counted = materialize(counted, "brackets")
    sums: dict = {}
    for r in counted.groupBy(*keys, "_place").agg(F.sum("_c").alias("_c")).collect():       # as many as there are ends, twice
        sums.setdefault(_key_of(r, keys), {})[r["_place"]] = r["_c"]
    state, missed, wider = {}, {}, {}
    for g, ranks in wanted.items():
        below = 0
        for at, n in sorted(sums[g].items()):
            for rank in (r for r in ranks if below <= r < below + n):
                if at % 2:
                    found[(g, rank)] = ends[g][at // 2]
                    continue
                gap = (ends[g][at // 2 - 1] if at else -math.inf, ends[g][at // 2] if at // 2 < len(ends[g]) else math.inf)
                if at in inner[g]:
                    state[(g, rank)] = {"keys": groups[g], "lo": math.nextafter(gap[0], math.inf), "hi": math.nextafter(gap[1], -math.inf),
                                        "below": below, "m": n, "halve": False}
                else:
                    missed.setdefault(g, []).append(rank)
                    wider.setdefault(g, []).append(gap)
            below += n
    inside = counted.where("_v is not null")
    while open_ := {k: s for k, s in state.items() if s["m"] > max_bracket and s["lo"] < s["hi"]}:
        _narrow(inside, keys, key_types, open_, accuracy)
    found |= _rank(inside, keys, key_types, state)
    return missed, wider


def _ordinal(x: float) -> int:
    """Integers in the order of the doubles."""
    bits = struct.unpack("<q", struct.pack("<d", x + 0.0))[0]
    return bits if bits >= 0 else -(bits & 0x7FFFFFFFFFFFFFFF)


def _double(i: int) -> float:
    x = struct.unpack("<d", struct.pack("<q", abs(i)))[0]
    return x if i >= 0 else -x


def _numbered(states: dict) -> tuple[dict, dict]:
    """A number per different bracket of a group, and {(group, number): ranks}."""
    number, ranks = {}, {}
    for (g, rank), s in states.items():
        of_group = number.setdefault(g, {})
        i = of_group.setdefault((s["lo"], s["hi"]), len(of_group))
        ranks.setdefault((g, i), []).append(rank)
    return number, ranks


def _narrow(data: DataFrame, keys: list[str], key_types: dict, open_: dict, accuracy: int) -> None:
    """One round: every open bracket becomes strictly narrower and keeps its rank."""
    eps = 3.0 / accuracy  # three times the sketch's rank error
    proposal = {k: (s["lo"], _double((_ordinal(s["lo"]) + _ordinal(s["hi"])) // 2)) for k, s in open_.items()}
    sketched = {k: s for k, s in open_.items() if not s["halve"]}
    if sketched:
        around = {k: ((k[1] - s["below"]) / (s["m"] - 1) - eps, (k[1] - s["below"]) / (s["m"] - 1) + eps)
                  for k, s in sketched.items()}
        probs = sorted({min(1.0, max(0.0, x)) for ab in around.values() for x in ab})
        _, ranks = _numbered(sketched)
        entries = [{"keys": sketched[(g, of[0])]["keys"], "_pi": i, "_blo": sketched[(g, of[0])]["lo"],
                    "_bhi": sketched[(g, of[0])]["hi"]} for (g, i), of in ranks.items()]
        rows = _attach(data, keys, key_types, entries, {})
        for r in rows.groupBy(*keys, "_pi").agg(F.percentile_approx("_v", probs, accuracy).alias("_q")).collect():      # of the values, not the rows
            g = _key_of(r, keys)
            for rank in ranks[(g, r["_pi"])]:
                s, (a, b) = sketched[(g, rank)], around[(g, rank)]
                lo = r["_q"][probs.index(a)] if a > 0.0 else s["lo"]
                hi = r["_q"][probs.index(b)] if b < 1.0 else s["hi"]
                if (lo, hi) != (s["lo"], s["hi"]):
                    proposal[(g, rank)] = (lo, hi)
    order = list(open_)
    entries = [{"keys": open_[k]["keys"], "_pi": i, "_blo": open_[k]["lo"], "_bhi": open_[k]["hi"],
                "_nlo": proposal[k][0], "_nhi": proposal[k][1]} for i, k in enumerate(order)]
    rows = _attach(data, keys, key_types, entries, {"_nlo": "double", "_nhi": "double"})
    counts = rows.groupBy(*keys, "_pi").agg(
        F.sum(F.when(F.col("_v") < F.col("_nlo"), F.col("_c")).otherwise(0)).alias("_b"),
        F.sum(F.when((F.col("_v") >= F.col("_nlo")) & (F.col("_v") <= F.col("_nhi")), F.col("_c")).otherwise(0)).alias("_m")).collect()
    for r in counts:
        k = order[r["_pi"]]
        s, (lo, hi) = open_[k], proposal[k]
        before, rank = s["m"], k[1] - s["below"]
        if rank < r["_b"]:
            s["hi"], s["m"] = math.nextafter(lo, -math.inf), r["_b"]
        elif rank < r["_b"] + r["_m"]:
            s["lo"], s["hi"], s["below"], s["m"] = lo, hi, s["below"] + r["_b"], r["_m"]
        else:
            s["lo"], s["below"], s["m"] = math.nextafter(hi, math.inf), s["below"] + r["_b"] + r["_m"], before - r["_b"] - r["_m"]
        s["halve"] = not s["halve"] and 2 * s["m"] > before


def _rank(data: DataFrame, keys: list[str], key_types: dict, state: dict) -> dict:
    """{(group, rank): value}; a bracket with lo = hi is its value, the others' rows are ranked."""
    out = {k: s["lo"] for k, s in state.items() if s["lo"] == s["hi"]}
    rest = {k: s for k, s in state.items() if s["lo"] < s["hi"]}
    if not rest:
        return out
    _, ranks = _numbered(rest)
    entries = [{"keys": rest[(g, of[0])]["keys"], "_pi": i, "_blo": rest[(g, of[0])]["lo"],
                "_bhi": rest[(g, of[0])]["hi"], "_below": rest[(g, of[0])]["below"], "_ranks": sorted(of)}
               for (g, i), of in ranks.items()]
    extra = {"_below": "bigint", "_ranks": "array<bigint>"}
    rows = _attach(data, keys, key_types, entries, extra)
    # bracket columns are constant per (group, bracket): carried, not grouped on
    freq = rows.groupBy(*keys, "_pi", "_v").agg(F.sum("_c").alias("_c"),
                                                *[F.first(e).alias(e) for e in extra])
    w = Window.partitionBy(*keys, "_pi").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = freq.withColumn("_end", F.col("_below") + F.sum("_c").over(w))
    hit = F.filter("_ranks", lambda rank: (rank >= F.col("_end") - F.col("_c")) & (rank < F.col("_end")))
    for r in ranked.select(*keys, "_v", F.explode(hit).alias("_rank")).collect():
        out[(_key_of(r, keys), r["_rank"])] = r["_v"]
    return out


def quantile_table(df: DataFrame, keys: list[str], value: str, probs: list[float], names: list[str],
                   max_groups: int = 100_000, **kw) -> DataFrame:
    """``exact_quantiles`` as a small DataFrame (one row per group)."""
    base = group_bounds(_values(df, keys, value), keys, max_groups, "_v", probs, kw.get("accuracy", 10000))
    res = exact_quantiles(df, keys, value, probs, base=base, **kw)
    key_types = {f.name: f.dataType.simpleString() for f in df.schema.fields if f.name in keys}
    rows = [tuple(r[k] for k in keys) + tuple(res[_key_of(r, keys)]) for r in base if r["_n"]]
    schema = ", ".join([f"`{k}` {key_types[k]}" for k in keys] + [f"`{n}` double" for n in names])
    return df.sparkSession.createDataFrame(rows, schema)
