"""Subscriber-attrition analytics on Spark.

Loads client records and per-client price history, profiles them, builds
price features in few shuffles, encodes dates, flags and categories,
summarises distributions and correlations as plot-ready tables, and trains,
tunes, scores and evaluates random forests with ``pyspark.ml``.

Every operator is a function ``DataFrame -> DataFrame`` built from native
column expressions, so Catalyst keeps filter pushdown, column pruning and
partial aggregation.
"""

from retention.session import build_session, checkpoint_dir, materialize
from retention.config import Params

__all__ = ["build_session", "checkpoint_dir", "materialize", "Params"]
