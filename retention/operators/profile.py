"""Tabular profile (P1-P8): info, shape, describe, null counts, value counts,
frequency of frequencies and ordered previews.

Every profile is one aggregation pass whose result is returned as a small
long-form DataFrame (one row per column), never printed or collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retention.operators.quantiles import exact_quantiles, sketch

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in exclude]


def _long(df: DataFrame, structs: list) -> DataFrame:
    """Aggregate to one row holding an array of per-column structs, then explode."""
    return df.agg(F.array(*structs).alias("_p")).select(F.inline("_p"))


def info(df: DataFrame) -> DataFrame:
    """P1 ``df.info()``: (position, column, dtype, non_null)."""
    structs = [
        F.struct(F.lit(i).alias("position"), F.lit(name).alias("column_name"), F.lit(dtype).alias("dtype"),
                 F.count(F.col(f"`{name}`")).alias("non_null"))
        for i, (name, dtype) in enumerate(df.dtypes)
    ]
    return _long(df, structs)


def shape(df: DataFrame) -> DataFrame:
    """P2 ``df.shape`` as a one-row table (rows, columns)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.lit(len(df.columns)).alias("n_columns"))


def describe(df: DataFrame, cols: list[str] | None = None, exact: bool = True,
             accuracy: int = 10000) -> DataFrame:
    """P3 ``df.describe()``: count, mean, std (sample), min, quartiles, max per column.

    The table is unpivoted to (column, value) and grouped by column, so columns
    are spread over tasks and every aggregate is merged from map-side partials.
    ``exact=True`` interpolates quartiles linearly (pandas' rule) with the
    distributed selection of ``quantiles.exact_quantiles`` (no column is ever
    held in one task); ``exact=False`` uses the bounded-memory sketch of
    ``percentile_approx`` (rank error 1/accuracy) in the same single pass.
    """
    cols = cols or numeric_columns(df)
    long = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in cols]).unpivot(
        [], cols, "column_name", "value")
    base = [F.count("value").alias("count"), F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max")]
    names = ["column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max"]
    if exact:
        # one scan for the moments and the rank sketch (one row per column, kept on the driver), one for the quartiles
        rows = long.groupBy("column_name").agg(*base, *sketch("value", [0.25, 0.5, 0.75], accuracy)).collect()
        qs = exact_quantiles(long, ["column_name"], "value", [0.25, 0.5, 0.75], accuracy=accuracy, base=rows)
        out = []
        for r in rows:
            q = qs.get(r["column_name"], [None, None, None])
            out.append((r["column_name"], r["count"], r["mean"], r["std"], r["min"], q[0], q[1], q[2], r["max"]))
        schema = ("column_name string, count bigint, mean double, std double, min double, p25 double, "
                  "p50 double, p75 double, max double")
        return df.sparkSession.createDataFrame(out, schema)
    q = F.percentile_approx(F.col("value"), [0.25, 0.5, 0.75], accuracy)
    stats = long.groupBy("column_name").agg(*base, q.alias("_q")).select(
        "*", F.col("_q")[0].alias("p25"), F.col("_q")[1].alias("p50"), F.col("_q")[2].alias("p75"))
    return stats.select(*names)


def null_counts(df: DataFrame) -> DataFrame:
    """P4 + P5: (column, null_count, null_pct) in one pass."""
    n = F.count(F.lit(1))
    structs = []
    for i, name in enumerate(df.columns):
        nulls = F.count_if(F.col(f"`{name}`").isNull())
        structs.append(F.struct(
            F.lit(i).alias("position"), F.lit(name).alias("column_name"), nulls.alias("null_count"),
            F.try_divide(nulls * F.lit(100.0), n).alias("null_pct")))
    return _long(df, structs)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """P6 ``s.value_counts()``: NULLs excluded, (value, count) sorted desc."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.col(col)))


def freq_of_freq(df: DataFrame, key: str = "id") -> DataFrame:
    """P7 ``s.value_counts().value_counts()``: how many keys have n rows."""
    per_key = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return per_key.groupBy("n_rows").agg(F.count(F.lit(1)).alias("n_keys")).orderBy(F.desc("n_keys"), "n_rows")


def preview(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """P8 ``head(n)`` with an explicit order (Spark rows have no file order).

    Planned as a per-partition top-n and a merge of n rows per task.
    """
    return df.orderBy(*order_by).limit(n)
