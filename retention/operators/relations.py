"""Relations between columns: churn rate by dimension (A14), Pearson
correlation matrix in long form (A15) and the correlated-pairs listing (D6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rate_by(df: DataFrame, dim: str, label: str = "churn", descending: bool = True) -> DataFrame:
    """A14 (+ O1): mean label per value of ``dim``, ordered by rate with a tie-break."""
    out = df.groupBy(dim).agg(F.avg(F.col(label).cast("double")).alias(label))
    order = F.desc(label) if descending else F.asc(label)
    return out.orderBy(order, F.col(dim))


def correlation(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pairwise-complete Pearson correlation, long form (col_a, col_b, corr).

    Without NULLs the JVM Gramian path is used (``_correlation_dense``).
    Every path reads ``df`` more than once: pass a stored table (e.g.
    ``session.materialize``) when ``df`` is expensive to recompute.
    With NULLs, two passes, each spread over all partitions:

    1. per-column means, minima and maxima (3k aggregates); means are shifts so the sums below are
       sums of deviations (no cancellation for large-valued columns);
    2. ``mapInPandas``: every partition turns its rows into a (rows x k)
       matrix and emits, per column pair a <= b (two small integers), the count
       of rows where both are non-null, the masked sums, minima and maxima of
       each side, the masked sums of squares and the sum of products --
       k*(k+1)/2 small rows per partition. Spark merges them per pair
       (map-side partials, one exchange of that many rows per task).

    corr = cov / sqrt(var_a * var_b) over the pair's common rows; a pair with a
    side that is constant on the common rows gives NULL (pandas NaN). NaN
    counts as NULL. Both orders and the diagonal are returned. No pair of
    input rows is ever formed.
    """
    cols = list(cols)
    k = len(cols)
    x = df.select(*[F.nullif(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))).alias(f"c{i}") for i, c in enumerate(cols)])
    first = x.agg(F.count(F.lit(1)).alias("n"),
                  *[F.avg(f"c{i}").alias(f"m{i}") for i in range(k)],
                  *[F.count(f"c{i}").alias(f"nn{i}") for i in range(k)],
                  *[F.min(f"c{i}").alias(f"lo{i}") for i in range(k)],
                  *[F.max(f"c{i}").alias(f"hi{i}") for i in range(k)]).first()
    shift = [float(first[f"m{i}"]) if first[f"m{i}"] is not None else 0.0 for i in range(k)]
    # a column with a single distinct value has zero variance: its pairs are NULL
    constant = [c for i, c in enumerate(cols) if first[f"lo{i}"] is None or first[f"lo{i}"] == first[f"hi{i}"]]
    names = list(cols)
    if first["n"] and all(first[f"nn{i}"] == first["n"] for i in range(k)):
        return _correlation_dense(x, names, constant)

    def comoments(batches):
        import numpy as np
        import pandas as pd
        n, sa, saa, sab = (np.zeros((k, k)) for _ in range(4))       # [i, j]: column i on the rows where j is there too
        lo, hi = np.full((k, k), np.inf), np.full((k, k), -np.inf)
        for pdf in batches:
            a = pdf.to_numpy(dtype="float64", na_value=np.nan) - np.asarray(shift)
            there = ~np.isnan(a)
            m = there.astype("float64")
            a0 = np.where(there, a, 0.0)
            n += m.T @ m
            sa += a0.T @ m
            saa += (a0 * a0).T @ m
            sab += a0.T @ a0
            for j in range(k):
                rows = a[there[:, j]]
                lo[:, j] = np.fmin(lo[:, j], np.fmin.reduce(rows, axis=0, initial=np.inf))
                hi[:, j] = np.fmax(hi[:, j], np.fmax.reduce(rows, axis=0, initial=-np.inf))
        i, j = np.nonzero(np.triu(n > 0))
        yield pd.DataFrame({
            "a": i.astype("int32"), "b": j.astype("int32"), "n": n[i, j], "sab": sab[i, j],
            "sa": sa[i, j], "saa": saa[i, j], "loa": lo[i, j], "hia": hi[i, j],
            "sb": sa[j, i], "sbb": saa[j, i], "lob": lo[j, i], "hib": hi[j, i],
        })

    sums, lows, highs = ("n", "sab", "sa", "saa", "sb", "sbb"), ("loa", "lob"), ("hia", "hib")
    schema = "a int, b int, n double, sab double, sa double, saa double, loa double, hia double, sb double, sbb double, lob double, hib double"
    tot = x.mapInPandas(comoments, schema).groupBy("a", "b").agg(
        *[F.sum(c).alias(c) for c in sums], *[F.min(c).alias(c) for c in lows], *[F.max(c).alias(c) for c in highs])
    n = F.col("n")
    ma, mb = F.col("sa") / n, F.col("sb") / n
    prod = (F.col("saa") / n - ma * ma) * (F.col("sbb") / n - mb * mb)
    varies = (F.col("loa") < F.col("hia")) & (F.col("lob") < F.col("hib"))
    tot = tot.select("a", "b", F.when(varies & (prod > 0), (F.col("sab") / n - ma * mb) / F.sqrt(prod)).alias("corr"))
    # every pair of columns, k * k rows known from the schema; pairs without a common row have no correlation
    pairs = x.sparkSession.createDataFrame(
        [(p, q, min(i, j), max(i, j)) for i, p in enumerate(names) for j, q in enumerate(names)],
        "col_a string, col_b string, a int, b int")
    return pairs.join(tot, ["a", "b"], "left").select("col_a", "col_b", "corr")


def _correlation_dense(x: DataFrame, names: list[str], constant: list[str]) -> DataFrame:
    """No NULLs in any column: pairwise masks are not needed, so the JVM
    path of ``pyspark.ml.stat.Correlation`` applies -- one ``treeAggregate``
    of the mean-centred Gramian (k*(k+1)/2 sums per task), no Python workers.
    The k x k result (bounded by the column count) becomes the long table."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    k = len(names)
    vec = VectorAssembler(inputCols=[f"c{i}" for i in range(k)], outputCol="_f").transform(x).select("_f")
    mat = Correlation.corr(vec, "_f", "pearson").head()[0].toArray()
    const = set(constant)
    rows = []
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            v = float(mat[i][j])
            rows.append((a, b, None if (a in const or b in const or v != v) else v))
    return x.sparkSession.createDataFrame(rows, "col_a string, col_b string, corr double")


def correlated_pairs(corr_long: DataFrame, threshold: float = 0.9) -> DataFrame:
    """D6 helper: pairs (a < b) whose |corr| >= threshold, strongest first --
    the candidates a user drops by eye from the heatmap."""
    return (corr_long.filter((F.col("col_a") < F.col("col_b")) & (F.abs("corr") >= F.lit(threshold)))
            .orderBy(F.desc(F.abs("corr")), "col_a", "col_b"))
