"""Registered queries of the file sources and sinks: the mapped tables through CSV files and back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from retention.config import DEFAULT
from retention.operators import profile as PR
from retention.plans.model_queries import _base_forest, _test_rows_sql, premodel_sql_body
from retention.plans.registry import finish, register, round_outer
from retention.plans.table_queries import ACCOUNT_DOUBLES, ACCOUNT_DTYPES
from retention.session import stored_path
from retention.sources import files as S
from retention.sources.schemas import FLAGS
from retention.sources.views import account_view, read_table, with_views

ACCOUNT_COLUMNS = [c for c, _ in ACCOUNT_DTYPES]


def _through_csv(spark, df, name: str) -> str:
    path = stored_path(spark, name)
    S.write_csv(df, path)
    return path


@register("csv_round_trip", lambda: with_views(round_outer(f"SELECT {', '.join(ACCOUNT_COLUMNS)} FROM account", ACCOUNT_DOUBLES)))
def q_csv_round_trip(spark, d):
    """The client table written as CSV, labels and counts as decimals, and loaded with its types."""
    client = account_view(spark, d)
    text = client.withColumns({c: F.col(c).cast("double") for c in ("churn", "num_years_antig")}).select(
        *[F.col(c).cast("string").alias(c) for c in reversed(ACCOUNT_COLUMNS)])
    rows = S.load_client_csv(spark, _through_csv(spark, text, "client-csv")).rows
    return finish(rows.select(*[F.col(c).cast(dict(client.dtypes)[c]).alias(c) for c in ACCOUNT_COLUMNS]))


# Damage done to the written strings; every third, fifth, ... client of the whole table.
_DAMAGE = {"cons_12m": ("id % 3 = 0", "'1,234.5'"), "churn": ("id % 5 = 0", "'0.5'"), "date_end": ("id % 7 = 0", "'2015-13-01'"),
           "has_gas": ("id % 11 = 0", "'yes'"), "pow_max": ("id % 13 = 0", "'NaN'")}


@register("csv_rejects", lambda: with_views(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {when}) AS n_rejected, count(*) FILTER (WHERE {when}) AS n_listed, "
    f"coalesce(sum(id) FILTER (WHERE {when}), 0)::BIGINT AS id_sum FROM account" if c != "pow_max" else
    f"SELECT '{c}' AS column_name, 0::BIGINT AS n_rejected, 0::BIGINT AS n_listed, coalesce(sum(id) FILTER (WHERE {when}), 0)::BIGINT AS id_sum FROM account"
    for c, (when, _) in _DAMAGE.items())))
def q_csv_rejects(spark, d):
    """Values that no type takes, counted by the loading read and listed; ``id_sum`` is over the ids whose value became
    NULL (or is no flag), so a missing value (NaN) is in it without being a reject."""
    client = account_view(spark, d)
    text = client.select(*[(F.expr(f"CASE WHEN {_DAMAGE[c][0]} THEN {_DAMAGE[c][1]} ELSE CAST({c} AS STRING) END") if c in _DAMAGE
                            else F.col(c).cast("string")).alias(c) for c in ACCOUNT_COLUMNS])
    loaded = S.load_client_csv(spark, _through_csv(spark, text, "damaged-csv"))
    listed = loaded.rejects.groupBy("column").count()
    gone = loaded.rows.agg(*[F.coalesce(F.sum(F.when(F.col(c).isNull() if c != "has_gas" else ~F.col(c).isin(*FLAGS), F.col("id").cast("long"))),
                                        F.lit(0)).alias(c) for c in _DAMAGE]).unpivot([], list(_DAMAGE), "column_name", "id_sum")
    counted = spark.createDataFrame([(c, loaded.rejected[c]) for c in _DAMAGE], "c string, n_rejected long")
    return (counted.join(listed, F.col("c") == F.col("column"), "left").join(gone, F.col("c") == F.col("column_name"))
            .select("column_name", "n_rejected", F.coalesce("count", F.lit(0)).alias("n_listed"), "id_sum"))


_FURTHER = ["l_quantity", "l_extendedprice", "l_linenumber"]


@register("csv_further_types", lambda: round_outer(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{kind}' AS dtype, count({c}) AS count, avg({c}) AS mean, min({c}) AS min, max({c}) AS max FROM lineitem"
    for c, kind in zip(_FURTHER, ("double", "double", "bigint"))), ["mean"]))
def q_csv_further_types(spark, d):
    """Columns that no schema names get the narrowest type that holds all their values, and are described."""
    rows = read_table(spark, d, "lineitem", ["l_orderkey", *_FURTHER, "l_shipdate", "l_returnflag"])
    path = _through_csv(spark, rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns]), "lines-csv")
    schema = T.StructType([T.StructField("l_orderkey", T.LongType())])
    loaded = S.load_csv(spark, path, schema).rows
    kinds = spark.createDataFrame(loaded.dtypes, "c string, dtype string")
    return finish(PR.describe(loaded, [c for c in PR.numeric_columns(loaded) if c != "l_orderkey"], exact=False).join(
        kinds, F.col("c") == F.col("column_name")).select("column_name", "dtype", "count", "mean", "min", "max"))


@register("scored_round_trip", lambda: with_views(
    f"SELECT id, CAST(label AS INTEGER) AS churn, true AS is_class, true AS is_probability "
    f"FROM ({_test_rows_sql(premodel_sql_body(), DEFAULT.test_share_rf)}) s"))
def q_scored_round_trip(spark, d):
    """The scored test rows as the typed sink and, from it, as CSV with another separator; read back from that."""
    typed, text = stored_path(spark, "scored"), stored_path(spark, "scored-csv")
    S.write_scored(_base_forest(spark, d)["scored"], typed)
    S.write_csv(spark.read.parquet(typed), text, sep=";")
    back = spark.read.option("header", True).option("sep", ";").schema(spark.read.parquet(typed).schema).csv(text)
    return back.select("id", "churn", F.col("prediction").isin(0, 1).alias("is_class"),
                       F.col("churn_probability").between(0.0, 1.0).alias("is_probability"))
