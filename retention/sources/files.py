"""File sources and sinks.

CSV columns are taken by name with the types of an explicit schema; only the
types of further columns are found by a pass over the data. Dates are parsed
with a bad-value policy; null tokens that a CSV reader accepts only one at a
time are normalised after the read; NaN is turned into NULL so aggregates
skip it. ``load_csv`` counts and lists every value that no type takes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from retention.session import stored_path
from retention.sources.schemas import CLIENT_DATE_COLUMNS, CLIENT_SCHEMA, FLAGS, PRICE_SCHEMA

# Strings read as missing (pandas' default set, minus the word MISSING, which
# the reference keeps as a category level) -- fixed values.
NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
               "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def parse_date(c: Column, fmt: str | None = "yyyy-MM-dd") -> Column:
    """String -> date; NULL where it does not parse."""
    return F.try_to_date(c, fmt) if fmt else F.try_to_date(c)


def parse_dates(df: DataFrame, cols: list[str], fmt: str | None = "yyyy-MM-dd") -> DataFrame:
    """X1/X2 on columns of a table; a value that does not parse becomes NULL instead of failing the job."""
    return df.withColumns({c: parse_date(F.col(c), fmt) for c in cols})


# ---------------------------------------------------------------- types of columns that no schema names
_WHOLE = r"^[+-]?[0-9]+$"
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_LONG, _DOUBLE, _DATE_BIT, _STRING = 1, 2, 4, 8


def _value(c: str) -> Column:
    """The raw string of a column, NULL for a null token."""
    col = F.col(f"`{c}`")
    return F.when(~col.isin(NULL_TOKENS), col)


def _kind(c: Column) -> Column:
    """A value's place in the lattice of types, as a bit; NULL has none."""
    return (F.when(c.isNull(), 0)
            .when(c.rlike(_WHOLE) & c.try_cast("bigint").isNotNull(), _LONG)
            .when(c.rlike(_NUMBER), _DOUBLE)
            .when(c.rlike(_DATE) & parse_date(c).isNotNull(), _DATE_BIT)
            .otherwise(_STRING))


def infer_types(raw: DataFrame, cols: list[str]) -> dict[str, T.DataType]:
    """The narrowest type that holds every value of each string column.

    Types form a lattice, long < double < string and date < string; a column's
    type is the join over its values. That is one aggregation of bits with
    map-side merges, so the whole column counts, wherever its odd values lie.
    A column without any value is a double, as pandas reads it.
    """
    if not cols:
        return {}
    seen = raw.agg(*[F.bit_or(_kind(_value(c))).alias(c) for c in cols]).first()
    def join(bits: int) -> T.DataType:
        if bits in (0, _DOUBLE, _LONG | _DOUBLE):
            return T.DoubleType()
        return {_LONG: T.LongType(), _DATE_BIT: T.DateType()}.get(bits, T.StringType())
    return {c: join(seen[c] or 0) for c in cols}


def _typed(value: Column, kind: T.DataType, fmt: str | None = "yyyy-MM-dd") -> Column:
    """A raw string as its type. A whole number may be written as a decimal (``1.0``)."""
    if isinstance(kind, T.DateType):
        return parse_date(value, fmt)
    if isinstance(kind, (T.IntegerType, T.LongType)):
        decimal = value.try_cast("double")
        whole = F.when(value.rlike(_NUMBER) & (decimal == F.rint(decimal)) & (F.abs(decimal) < 2.0 ** 53), decimal)
        return F.coalesce(value.try_cast(kind), whole.cast("bigint").try_cast(kind))
    if isinstance(kind, T.StringType):
        return value
    typed = value.try_cast(kind)
    return F.when(~F.isnan(typed), typed) if isinstance(kind, (T.DoubleType, T.FloatType)) else typed


# ---------------------------------------------------------------- CSV sources
def _raw_csv(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    raw = spark.read.option("header", True).csv(path)
    if lacking := [n for n in names if n not in raw.columns]:
        raise ValueError(f"{path} lacks the columns {lacking}")
    return raw


def read_csv(spark: SparkSession, path: str, schema: T.StructType, row_order: str | None = None) -> DataFrame:
    """Header CSV, columns taken by name and cast to the schema's types.

    Columns may stand in any order; others follow the schema's own, each with
    the type that ``infer_types`` finds; a missing one raises. ``row_order``
    names a column to add that sorts as the rows stand in the files: path,
    offset of the block in the file, place within the block (Spark reads
    blocks in any order).
    """
    names = [f.name for f in schema.fields]
    raw = _raw_csv(spark, path, names)
    further = infer_types(raw, [c for c in raw.columns if c not in names])
    place = F.struct("_metadata.file_path", "_metadata.file_block_start",
                     F.monotonically_increasing_id().alias("line"))
    return raw.select(*[_typed(_value(f.name), f.dataType).alias(f.name) for f in schema.fields],
                      *[_typed(_value(c), t).alias(c) for c, t in further.items()],
                      *([place.alias(row_order)] if row_order else []))


def read_client_csv(spark: SparkSession, path: str) -> DataFrame:
    return parse_dates(read_csv(spark, path, CLIENT_SCHEMA), CLIENT_DATE_COLUMNS)


def read_price_csv(spark: SparkSession, path: str, row_order: str | None = None) -> DataFrame:
    return parse_dates(read_csv(spark, path, PRICE_SCHEMA, row_order), ["price_date"])


def _reading_session(spark: SparkSession) -> SparkSession:
    """A session of the same application with the same settings. An ``Observation`` leaves its session with a
    part that cannot be serialized, and scoring a model serializes its session."""
    other = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if spark.conf.isModifiable(k):
            other.conf.set(k, v)
    return other


@dataclass
class LoadedCsv:
    """S1 + S4: a CSV input read once and stored typed.

    ``rejected`` counts, per column, the values that no type took (they are
    NULL in ``rows``) and flags of unknown value; ``rejects`` lists them as
    (file, line, column, value).
    """

    rows: DataFrame
    rejected: dict[str, int]
    rejects: DataFrame


def load_csv(spark: SparkSession, path: str, schema: T.StructType, dates: Sequence[str] = (),
             flags: dict[str, tuple[str, ...]] | None = None, fmt: str | None = "yyyy-MM-dd", row_order: str | None = None) -> LoadedCsv:
    """Reads, types and stores a header CSV; no value becomes NULL uncounted.

    One pass infers the types of further columns (left out where the schema
    names all). The next reads, casts and writes; an ``Observation`` on it
    counts, and each stored row carries its own rejected values, so the list
    of rejects is read from the stored table. ``line`` is the record's number in its
    file, the header being 1; records lie in blocks of the file, and the
    records of the blocks before are summed from the stored places.
    """
    names, flags = [f.name for f in schema.fields], flags or {}
    raw = _raw_csv(_reading_session(spark), path, names)
    further = infer_types(raw, [c for c in raw.columns if c not in names])
    kinds = {f.name: T.DateType() if f.name in dates else f.dataType for f in schema.fields} | further
    typed = {c: _typed(_value(c), t, fmt) for c, t in kinds.items()}
    # a NaN by any other spelling is missing, not rejected; a flag keeps its string, which the recode makes NULL
    bad = {c: ~_value(c).isin(*flags[c]) if c in flags else
           _value(c).isNotNull() & ~F.coalesce(F.isnan(_value(c).try_cast("double")), F.lit(False)) & t.isNull()
           for c, t in typed.items() if c in flags or not isinstance(kinds[c], T.StringType)}
    listed = [F.when(b, F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("value"))) for c, b in bad.items()]
    rows = raw.select(
        *[t.alias(c) for c, t in typed.items()],
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
        (F.filter(F.array(*listed), lambda x: x.isNotNull()) if listed else F.lit(None)).cast(
            "array<struct<column: string, value: string>>").alias("_rejects"))
    seen = Observation()
    counts = [F.count_if(F.array_contains(F.col("_rejects.column"), c)).alias(c) for c in bad]
    stored = stored_path(spark, "csv")
    rows.observe(seen, F.count(F.lit(1)).alias("_rows"), *counts).write.parquet(stored)
    got, stored = seen.get, spark.read.parquet(stored)
    blocks = stored.groupBy("_file", "_block").agg(F.min("_line").alias("_first"), F.count("*").alias("_n"))   # a row per block
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    shift = blocks.select(F.col("_file").alias("file"), F.col("_block").alias("_b"),
                          (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 2).alias("_shift"))
    wrong = stored.where(F.size("_rejects") > 0).select("_file", "_block", "_line", F.inline("_rejects"))
    rejects = wrong.join(shift, (F.col("_file") == F.col("file")) & (F.col("_block") == F.col("_b"))).select(
        "file", (F.col("_line") + F.col("_shift")).alias("line"), "column", "value")
    place = F.struct(F.col("_file").alias("file_path"), F.col("_block").alias("file_block_start"), F.col("_line").alias("line"))
    return LoadedCsv(stored.select(*typed, *([place.alias(row_order)] if row_order else [])), {c: int(got[c]) for c in bad}, rejects)


def load_client_csv(spark: SparkSession, path: str) -> LoadedCsv:
    return load_csv(spark, path, CLIENT_SCHEMA, CLIENT_DATE_COLUMNS, {"has_gas": FLAGS})


def load_price_csv(spark: SparkSession, path: str, row_order: str | None = None) -> LoadedCsv:
    return load_csv(spark, path, PRICE_SCHEMA, ["price_date"], row_order=row_order)


# ---------------------------------------------------------------- sinks
def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """Header CSV directory of parts; no row-index column is written."""
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Typed stage boundary between jobs (Parquet keeps dates and doubles)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_scored(scored: DataFrame, path: str) -> None:
    """Id, the feature columns that ``scored`` carries, churn (label), prediction and class-1 probability."""
    own = ("id", "label", "prediction", "churn_probability")
    write_table(scored.select(
        "id", *[F.col(f"`{c}`") for c in scored.columns if c not in own], F.col("label").cast("int").alias("churn"),
        F.col("prediction").cast("int").alias("prediction"), "churn_probability"), path)
