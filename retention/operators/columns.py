"""Projection and schema edits (C1-C12) as single projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _missing(df: DataFrame, cols) -> list[str]:
    have = set(df.columns)
    return [c for c in cols if c not in have]


def select_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Column subset; raises on an unknown name."""
    miss = _missing(df, cols)
    if miss:
        raise KeyError(f"unknown columns: {miss}")
    return df.select(*[F.col(f"`{c}`") for c in cols])


def rename_positional(df: DataFrame, names: list[str]) -> DataFrame:
    """``df.columns = [...]``."""
    if len(names) != len(df.columns):
        raise ValueError("length mismatch")
    return df.toDF(*names)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """``df.rename(columns=mapping)``; names not present are ignored (as pandas)."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """C4: drop; unlike Spark's silent ``drop`` an absent name raises (as pandas)."""
    miss = _missing(df, cols)
    if miss:
        raise KeyError(f"cannot drop unknown columns: {miss}")
    return df.drop(*cols)


def move_last(df: DataFrame, col: str) -> DataFrame:
    """Move one column to the end (``pop`` + re-add)."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != col], F.col(f"`{col}`"))


def set_constant(df: DataFrame, cols: list[str], value: float = 0.0) -> DataFrame:
    """``df[cols] = value``."""
    return df.withColumns({c: F.lit(value) for c in cols})


def columns_of_type(df: DataFrame, dtype=T.BooleanType) -> list[str]:
    """``select_dtypes``."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, dtype)]


def apply_to_columns(df: DataFrame, cols: list[str], fn) -> DataFrame:
    """One expression applied over a list of columns in one projection."""
    return df.withColumns({c: fn(F.col(f"`{c}`")) for c in cols})
