"""Categorical encoding (E1-E3): a fitted one-hot encoder to named 0/1 columns.

``fit`` finds the sorted level list with one distinct aggregation (the level
list is small: it becomes the output schema; ``fit_sparse`` also takes long
ones); ``transform`` is a single
projection, so it works on any table, including streams.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.feature import OneHotEncoder, StringIndexerModel
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retention.operators.ranks import numbered
from retention.session import materialize


@dataclass
class OneHotLevels:
    column: str
    prefix: str
    levels: list = field(default_factory=list)
    drop_levels: tuple = ()

    @property
    def output_columns(self) -> list[str]:
        return [f"{self.prefix}_{v}" for v in self.levels if v not in self.drop_levels]

    def transform(self, df: DataFrame, keep_source: bool = False) -> DataFrame:
        """One 0/1 column per kept level; NULL or unseen values give all zeros.
        The source column is removed (as ``get_dummies`` does) unless ``keep_source``."""
        src = F.col(f"`{self.column}`")
        dummies = [F.coalesce((src == F.lit(v)).cast("int"), F.lit(0)).alias(f"{self.prefix}_{v}")
                   for v in self.levels if v not in self.drop_levels]
        rest = [F.col(f"`{c}`") for c in df.columns if keep_source or c != self.column]
        return df.select(*rest, *dummies)


@dataclass
class SparseLevels:
    """The same encoding as one sparse vector column, for columns of many levels.

    ``prefix`` names the vector; its entries carry the names of the 0/1
    columns (``{prefix}_{level}`` once assembled), in the same order. A forest
    takes it as a feature like any other column.
    """

    levels: OneHotLevels

    def transform(self, df: DataFrame, keep_source: bool = False) -> DataFrame:
        """A vector with a one at the row's level; NULL, unseen and dropped levels give all zeros."""
        column, prefix = self.levels.column, self.levels.prefix
        kept = [v for v in self.levels.levels if v not in self.levels.drop_levels]
        if not kept:
            raise ValueError(f"{column} has no level to encode")
        # what is no label is indexed behind the last one, and that category is the one that the encoder drops
        indexer = StringIndexerModel.from_labels(kept, inputCol=column, outputCol="_index", handleInvalid="keep")
        encoder = OneHotEncoder(inputCols=["_index"], outputCols=["_vector"], dropLast=True)
        indexed = indexer.transform(df)
        rows = encoder.fit(indexed).transform(indexed)      # the number of categories is in the index's metadata: nothing is read
        rest = [F.col(f"`{c}`") for c in df.columns if keep_source or c != column]
        return rows.select(*rest, F.col("_vector").alias(prefix, metadata=rows.schema["_vector"].metadata))

    def names(self) -> DataFrame:
        """``entry, level`` of the vector's entries."""
        kept = [(i, v) for i, v in enumerate(v for v in self.levels.levels if v not in self.levels.drop_levels)]
        return SparkSession.getActiveSession().createDataFrame(kept, "entry int, level string")


@dataclass
class StoredLevels:
    """``SparseLevels`` for more levels than a schema can name: they are a stored table (``_level``, ``entry``, ``_vector``)
    that rows are joined with, in the same order; the vector's entries have no names but those of ``names``."""

    column: str
    prefix: str
    table: DataFrame
    size: int

    def transform(self, df: DataFrame, keep_source: bool = False) -> DataFrame:
        """A vector with a one at the row's level; NULL, unseen and dropped levels give all zeros."""
        zero = df.sparkSession.createDataFrame([(Vectors.sparse(self.size, [], []),)], T.StructType([T.StructField("zero", VectorUDT())]))
        rest = [F.col(f"`{c}`") for c in df.columns if keep_source or c != self.column]
        rows = df.join(self.table.select("_level", "_vector"), F.col(f"`{self.column}`") == F.col("_level"), "left")
        return rows.select(*rest, F.coalesce("_vector", zero.scalar()).alias(self.prefix))

    def names(self) -> DataFrame:
        """``entry, level`` of the vector's entries."""
        return self.table.select("entry", F.col("_level").alias("level"))


def entry_sums(df: DataFrame, vector: str) -> DataFrame:
    """``entry, total`` over a column of vectors; an entry that no sparse vector holds has no row.

    The entries that are held are summed by their number, with partial sums
    before the exchange: no task has a buffer of the vector's size.
    """
    v = F.unwrap_udt(vector)
    kind = "array<struct<entry: int, value: double>>"
    held = F.when(v["type"] == 0, F.arrays_zip(v["indices"], v["values"]).cast(kind)).otherwise(
        F.transform(v["values"], lambda x, i: F.struct(i, x)).cast(kind))
    return df.select(F.inline(held)).groupBy("entry").agg(F.sum("value").alias("total"))


def level_counts(df: DataFrame, column: str) -> DataFrame:
    """The non-null levels of ``column`` and the rows ``n`` that hold each."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def fit_one_hot(df: DataFrame, column: str, prefix: str | None = None, drop_levels=(),
                min_count: int = 0, max_levels: int = 10000) -> OneHotLevels:
    """E1 + E3: sorted non-null levels of ``column``; levels listed in
    ``drop_levels`` or seen fewer than ``min_count`` times get no column.

    Fails loudly if the column has more than ``max_levels`` levels (a one-hot
    schema that wide is a modelling error, not something to truncate).
    """
    rows = level_counts(df, column).orderBy(column).limit(max_levels + 1).collect()
    if len(rows) > max_levels:
        raise ValueError(f"{column} has more than {max_levels} levels")
    levels = [r[column] for r in rows]
    rare = tuple(r[column] for r in rows if r["n"] < min_count)
    return OneHotLevels(column=column, prefix=prefix or column, levels=levels,
                        drop_levels=tuple(drop_levels) + rare)


def fit_one_hot_many(df: DataFrame, specs: list[tuple], min_count: int = 0,
                     max_levels: int = 10000) -> list[OneHotLevels]:
    """E1 for several string columns in one aggregation pass.

    ``specs`` are (column, prefix, drop_levels) triples; the result keeps their
    order. Levels are counted per (column, level) with map-side partials.
    """
    cols = [c for c, _, _ in specs]
    long = (df.select(*[F.col(c) for c in cols]).unpivot([], cols, "_col", "_level")
            .filter(F.col("_level").isNotNull()))
    counts = long.groupBy("_col", "_level").agg(F.count(F.lit(1)).alias("n"))
    rows = counts.limit(len(cols) * max_levels + 1).collect()
    out = []
    for c, prefix, drop in specs:
        mine = sorted((r["_level"], r["n"]) for r in rows if r["_col"] == c)
        if len(mine) > max_levels:
            raise ValueError(f"{c} has more than {max_levels} levels")
        rare = tuple(v for v, n in mine if n < min_count)
        out.append(OneHotLevels(column=c, prefix=prefix, levels=[v for v, _ in mine],
                                drop_levels=tuple(drop) + rare))
    return out


def one_hot(df: DataFrame, column: str, prefix: str | None = None, drop_levels=(), min_count: int = 0) -> DataFrame:
    """``pd.get_dummies(df, columns=[column], prefix=prefix)`` + drop of listed levels."""
    return fit_one_hot(df, column, prefix, drop_levels, min_count).transform(df)


def fit_sparse(df: DataFrame, column: str, prefix: str | None = None, drop_levels=(), min_count: int = 0,
               max_named: int = 100_000) -> SparseLevels | StoredLevels:
    """``fit_one_hot`` for levels in the thousands and more; the schema keeps one column.

    Up to ``max_named`` levels are held by the driver and named in the
    vector's metadata. More are numbered in a stored table, without names in
    the schema and without a bound.
    """
    counts = materialize(level_counts(df, column), "levels")
    if counts.count() <= max_named:
        rows = counts.orderBy(column).collect()
        rare = tuple(r[column] for r in rows if r["n"] < min_count)
        return SparseLevels(OneHotLevels(column=column, prefix=prefix or column, levels=[r[column] for r in rows],
                                         drop_levels=tuple(drop_levels) + rare))
    kept = counts.where((F.col("n") >= min_count) & ~F.col(f"`{column}`").isin(*drop_levels)).select(F.col(f"`{column}`").alias("_level"))
    size = kept.count()
    if not size:
        raise ValueError(f"{column} has no level to encode")
    vector = F.udf(lambda i: Vectors.sparse(size, [i], [1.0]), VectorUDT())
    entry = F.col("entry").cast("int")
    table = materialize(numbered(kept, ["_level"], name="entry").select("_level", entry.alias("entry"), vector(entry).alias("_vector")), "sparse-levels")
    return StoredLevels(column, prefix or column, table, size)


def bool_columns_to_int(df: DataFrame) -> DataFrame:
    """C8 + X9: every boolean column cast to int, others untouched."""
    return df.select(*[F.col(f"`{f.name}`").cast("int").alias(f.name) if isinstance(f.dataType, T.BooleanType)
                       else F.col(f"`{f.name}`") for f in df.schema.fields])
