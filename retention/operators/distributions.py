"""Distribution summaries (D1-D5, A13): the data behind the reference's plots,
returned as plot-ready tables instead of figures.

Global bounds (min/max, quantiles) are computed by one aggregation pass and
brought to the driver as a handful of scalars; the per-row work then uses
them as literals, so no row-level cross join and no global window is needed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retention.functions.scalars import round_half_up
from retention.operators.quantiles import SEP, exact_quantiles, sketch


def class_share(df: DataFrame, label: str = "churn", key: str = "id") -> DataFrame:
    """A13 + X10 (D5 data): companies per class, share in percent and bar label.

    The window for the total runs over the aggregated classes (one row per
    class), not over the input rows.
    """
    counts = df.groupBy(label).agg(F.count(F.col(key)).alias("companies"))
    total = F.sum("companies").over(Window.partitionBy())
    share = F.try_divide(F.col("companies") * F.lit(100.0), total)
    out = counts.select(label, "companies", share.alias("share"))
    label_value = round_half_up(F.col("share"), 1)
    return out.select(label, "companies", "share", F.when(label_value != 0, label_value).alias("share_label"))


def class_share_wide(df: DataFrame, label: str = "churn", key: str = "id",
                     classes: tuple = (0, 1)) -> DataFrame:
    """The one-row transpose of the class shares (columns per class)."""
    shares = class_share(df, label, key)
    return shares.groupBy().pivot(label, list(classes)).agg(F.first("share")).select(
        *[F.col(f"`{c}`").alias(f"share_{c}") for c in classes])


def _bounds(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    row = df.agg(*[F.min(c).alias(f"lo_{i}") for i, c in enumerate(cols)],
                 *[F.max(c).alias(f"hi_{i}") for i, c in enumerate(cols)]).first()
    out = {}
    for i, c in enumerate(cols):
        lo, hi = row[f"lo_{i}"], row[f"hi_{i}"]
        if lo is not None and lo == hi:  # numpy: a degenerate range becomes [v - 0.5, v + 0.5]
            lo, hi = lo - 0.5, hi + 0.5
        out[c] = (lo, hi)
    return out


def _lookup(mapping: dict[str, float], key: Column) -> Column:
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v).cast("double")]
    return F.element_at(F.create_map(*items), key)


def histogram(df: DataFrame, cols: list[str], bins: int = 50, by: str | None = None) -> DataFrame:
    """Equal-width histogram of several columns with shared edges.

    Edges span [min, max] of each column over all rows (both classes); the last
    bin is closed. Bin = least(bins - 1, floor((v - lo) * bins / (hi - lo))).
    Output is sparse: (column_name, [by,] bin, count, bin_lo, bin_hi), non-empty bins.
    """
    bounds = _bounds(df, cols)
    cols = [c for c in cols if bounds[c][0] is not None]
    keep = [by] if by else []
    long = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        keep, cols, "column_name", "value").filter(F.col("value").isNotNull())
    lo = _lookup({c: b[0] for c, b in bounds.items() if b[0] is not None}, F.col("column_name"))
    hi = _lookup({c: b[1] for c, b in bounds.items() if b[0] is not None}, F.col("column_name"))
    nb = F.lit(float(bins))
    bin_expr = F.least(F.lit(bins - 1), F.floor((F.col("value") - lo) * nb / (hi - lo)).cast("int"))
    counts = (long.select("column_name", *keep, bin_expr.alias("bin"))
              .groupBy("column_name", *keep, "bin").agg(F.count(F.lit(1)).alias("count")))
    width = (hi - lo) / nb
    return counts.select("column_name", *keep, "bin", "count",
                         (lo + F.col("bin") * width).alias("bin_lo"),
                         (lo + (F.col("bin") + 1) * width).alias("bin_hi"))


def _quartile_stats(df: DataFrame, cols: list[str], by: str | None, exact: bool, accuracy: int, max_groups: int):
    """Unpivoted rows and the per-(column, class) statistics as local rows
    (one row per group: n, min, max, q1, median, q3)."""
    keep = [by] if by else []
    long = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        keep, cols, "column_name", "value").filter(F.col("value").isNotNull())
    base = [F.count(F.lit(1)).alias("n"), F.min("value").alias("min"), F.max("value").alias("max")]
    names = ["column_name", *keep, "n", "min", "max", "q1", "median", "q3"]

    def collected(groups):
        rows = groups.limit(max_groups + 1).collect()
        if len(rows) > max_groups:
            raise ValueError(f"more than {max_groups} (column, class) groups: not a box plot")
        return rows

    if exact:
        rows = collected(long.groupBy("column_name", *keep).agg(*base, *sketch("value", [0.25, 0.5, 0.75], accuracy)))
        qs = exact_quantiles(long, ["column_name", *keep], "value", [0.25, 0.5, 0.75], accuracy=accuracy, base=rows)
        keys = ["column_name", *keep]
        out = []
        for r in rows:
            q = qs.get(SEP.join("" if r[k] is None else str(r[k]) for k in keys), [None, None, None])
            out.append({**{k: r[k] for k in keys}, "n": r["n"], "min": r["min"], "max": r["max"],
                        "q1": q[0], "median": q[1], "q3": q[2]})
        return long, out
    q = F.percentile_approx(F.col("value"), [0.25, 0.5, 0.75], accuracy)
    stats = long.groupBy("column_name", *keep).agg(q.alias("_q"), *base).select(
        "*", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"), F.col("_q")[2].alias("q3"))
    return long, [r.asDict() for r in collected(stats.select(*names))]


def box_stats(df: DataFrame, cols: list[str], by: str | None = "churn", whisker: float = 1.5,
              exact: bool = True, accuracy: int = 10000, max_groups: int = 100_000) -> DataFrame:
    """Box-plot statistics of each column per class.

    Pass 1: n, min and max per (column, class); then the exact quartiles
    (``quantiles.exact_quantiles``, reusing pass 1); pass 2: whiskers (the most
    extreme values inside [q1 - 1.5 iqr, q3 + 1.5 iqr]) and the outlier count.

    The statistics have one row per (column, class) and are held as local rows
    (more than ``max_groups`` raise), so they are broadcast to the
    rows: joining on a handful of keys with a shuffle would send each group to
    one task. Pass 2 then aggregates with map-side partials like any groupBy.
    """
    keep = [by] if by else []
    long, rows = _quartile_stats(df, cols, by, exact, accuracy, max_groups)
    spark = df.sparkSession
    by_type = dict(df.dtypes).get(by, "string") if by else None
    names = ["column_name", *keep, "n", "min", "q1", "median", "q3", "max"]
    types = ["string"] + ([by_type] if by else []) + ["bigint"] + ["double"] * 5
    fence_rows = []
    for r in rows:
        iqr = None if r["q1"] is None else r["q3"] - r["q1"]
        fence_rows.append(tuple(r[c] for c in names)
                          + ((None, None) if iqr is None else (r["q1"] - whisker * iqr, r["q3"] + whisker * iqr)))
    schema = ", ".join([f"`_s_{n}` {t}" for n, t in zip(names, types)] + ["_lo double", "_hi double"])
    fences = F.broadcast(spark.createDataFrame(fence_rows, schema))
    cond = F.col("column_name") == F.col("_s_column_name")
    for k in keep:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_s_{k}"))
    v = F.col("value")
    inside = (v >= F.col("_lo")) & (v <= F.col("_hi"))
    return long.join(fences, cond, "inner").groupBy("column_name", *keep).agg(
        *[F.first(f"_s_{c}").alias(c) for c in ["n", "min", "q1", "median", "q3", "max"]],
        F.min(F.when(inside, v)).alias("whisker_low"),
        F.max(F.when(inside, v)).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"))


#: moments a cell of the density keeps
_KDE_TERMS = 14


def density(df: DataFrame, col: str, max_bins: int = 50, grid: int = 200, cut: float = 3.0,
            exact: bool = True, accuracy: int = 10000) -> tuple[DataFrame, DataFrame]:
    """Density histogram (Freedman-Diaconis bin count, capped) and a
    Gaussian kernel density estimate (Scott's bandwidth) on a fixed grid.

    Returns (hist, kde). The KDE sums the kernel over cells of half a bandwidth
    instead of over values. With t and s the distances of a point and of a
    value from the cell's centre, in bandwidths,
    ``exp(-(t - s)**2 / 2) = exp(-t**2 / 2) * exp(-s**2 / 2) * sum((t * s)**k / k!)``,
    so a cell needs only its moments ``sum(exp(-s**2 / 2) * s**k)``, which add
    up map-side in one aggregation. As |s| <= 1/4, the terms left out
    after ``_KDE_TERMS`` are below 1e-14 of one value's own peak at any t. A cell then meets
    the points within nine bandwidths (beyond, the kernel is below 1e-17).
    Both are empty without values.
    """
    v = df.select(F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    aggs = [F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"),
            F.stddev_samp("v").alias("sd")]
    aggs += sketch("v", [0.25, 0.75], accuracy) if exact else [F.percentile_approx("v", [0.25, 0.75], accuracy).alias("q")]
    s = v.agg(*aggs).first()
    n, lo, hi, sd = s["n"], s["lo"], s["hi"], s["sd"]
    if not n:
        spark = df.sparkSession
        return (spark.createDataFrame([], "bin int, count bigint, density double, bin_lo double, bin_hi double"),
                spark.createDataFrame([], "point int, x double, density double"))
    quart = exact_quantiles(v, [], "v", [0.25, 0.75], accuracy=accuracy, base=[s])[""] if exact else s["q"]
    iqr = quart[1] - quart[0]
    width_fd = 2.0 * iqr * n ** (-1.0 / 3.0)
    if width_fd > 0 and hi > lo:
        nbins = min(max_bins, max(1, int(math.ceil((hi - lo) / width_fd))))
    else:
        nbins = 1
    blo, bhi = (lo - 0.5, hi + 0.5) if hi == lo else (lo, hi)
    width = (bhi - blo) / nbins
    bin_expr = F.least(F.lit(nbins - 1),
                       F.floor((F.col("v") - F.lit(blo)) * F.lit(float(nbins)) / F.lit(bhi - blo)).cast("int"))
    hist = (v.select(bin_expr.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
            .select("bin", "count",
                    (F.col("count") / F.lit(n * width)).alias("density"),
                    (F.lit(blo) + F.col("bin") * F.lit(width)).alias("bin_lo"),
                    (F.lit(blo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_hi")))
    bw = (sd if sd else 0.0) * n ** (-0.2)
    if not bw:
        kde = hist.limit(0).select(F.lit(0).alias("point"), F.lit(0.0).alias("x"), F.lit(0.0).alias("density"))
        return hist, kde
    g_lo, g_hi = lo - cut * bw, hi + cut * bw
    step = (g_hi - g_lo) / (grid - 1)
    cell = bw / 2.0
    number = F.floor((F.col("v") - F.lit(lo)) / F.lit(cell))
    centre = F.lit(lo) + (F.col("cell") + 0.5) * F.lit(cell)
    power = F.exp(F.lit(-0.5) * F.col("s") * F.col("s"))
    moments = []
    for k in range(_KDE_TERMS):
        moments.append(F.sum(power).alias(f"m{k}"))
        power = power * F.col("s")
    cells = (v.select("v", number.alias("cell")).select("cell", ((F.col("v") - centre) / F.lit(bw)).alias("s"))
             .groupBy("cell").agg(*moments))
    reach = 9.25 * bw
    first = F.greatest(F.lit(0), F.ceil((centre - F.lit(reach + g_lo)) / F.lit(step)))
    last = F.least(F.lit(grid - 1), F.floor((centre + F.lit(reach - g_lo)) / F.lit(step)))
    met = cells.withColumns({"_first": first.cast("int"), "_last": last.cast("int")}).where("_first <= _last").select(
        "*", F.explode(F.sequence("_first", "_last")).alias("point"))
    x = F.lit(g_lo) + F.col("point") * F.lit(step)
    t = (x - centre) / F.lit(bw)
    series = F.col(f"m{_KDE_TERMS - 1}")
    for k in range(_KDE_TERMS - 1, 0, -1):
        series = series * F.col("t") / F.lit(float(k)) + F.col(f"m{k - 1}")
    sums = met.withColumn("t", t).groupBy("point").agg(F.sum(F.exp(F.lit(-0.5) * F.col("t") * F.col("t")) * series).alias("_s"))
    norm = 1.0 / (n * bw * math.sqrt(2.0 * math.pi))
    points = df.sparkSession.range(grid).select(F.col("id").cast("int").alias("point"))
    kde = points.join(sums, "point", "left").select("point", x.alias("x"), (F.coalesce("_s", F.lit(0.0)) * F.lit(norm)).alias("density"))
    return hist, kde
