"""Registry of named queries and their SQL oracles.

Each query is ``(spark, sf_dir) -> DataFrame``. Double columns of every result
are rounded with ``r6`` so that an independent SQL engine computing the same
numbers (in another summation order) yields identical values; the oracle text
applies the same formula to the same columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retention.functions.scalars import r6

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, Callable[[], str]] = {}


def register(name: str, oracle: Callable[[], str] | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def finish(df: DataFrame) -> DataFrame:
    """Round every double column with r6 (keeps names and order)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            cols.append(r6(f"`{f.name}`").alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def r6_sql(x: str) -> str:
    return f"(floor((floor(({x}) * 1e9 + 0.5) / 1e9) * 1000000.0 + 0.5) / 1000000.0)"


def q(name: str) -> str:
    """Quote an identifier for DuckDB."""
    return '"' + name.replace('"', '""') + '"'


def round_outer(body: str, doubles: list[str]) -> str:
    """Wrap a SELECT so the listed double columns are rounded like ``finish``."""
    if not doubles:
        return body
    repl = ", ".join(f"{r6_sql(q(c))} AS {q(c)}" for c in doubles)
    return f"SELECT * REPLACE ({repl}) FROM ({body}) _t"
