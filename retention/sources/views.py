"""Mapping of the driver's star-schema test tables onto the two logical inputs.

``price``   = lineitem x orders, one row per line item, keyed by the customer.
``account`` = customer x nation x region with order/line aggregates, one row
per customer.

Each view is given twice: as a DataFrame plan (used by the library) and as a
SQL text (used only by the DuckDB oracle). Column choices are fixed values of
the mapping and must stay identical in both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retention.config import DEFAULT, Params

# Tie-break columns giving a total order of price rows inside one id and date.
PRICE_TIEBREAK = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def read_table(spark: SparkSession, sf_dir: str, name: str, cols: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def price_view(spark: SparkSession, sf_dir: str, with_tiebreak: bool = False) -> DataFrame:
    """Price history: id, price_date + six prices (+ tie-break columns)."""
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     "l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    joined = li.join(orders, li.l_orderkey == orders.o_orderkey, "inner")
    cols = [
        F.col("o_custkey").alias("id"),
        F.trunc(F.col("o_orderdate").cast("date"), "month").alias("price_date"),
        F.col("l_discount").alias("price_off_peak_var"),
        F.col("l_tax").alias("price_peak_var"),
        (F.col("l_discount") * F.col("l_tax")).alias("price_mid_peak_var"),
        F.col("l_extendedprice").alias("price_off_peak_fix"),
        F.col("l_quantity").alias("price_peak_fix"),
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("price_mid_peak_fix"),
    ]
    if with_tiebreak:
        cols += [F.col(c) for c in PRICE_TIEBREAK]
    return joined.select(*cols)


def account_view(spark: SparkSession, sf_dir: str, params: Params = DEFAULT,
                 first_clients: int | None = None) -> DataFrame:
    """Client table: one row per customer, 25 logical columns.

    Line items are pre-aggregated per order before the join to orders (the
    per-order aggregate and the orders scan share the order-key exchange),
    then orders are aggregated per customer, so no count-distinct is needed.
    ``first_clients`` keeps only that many clients, those of the smallest ids
    (a preview), before anything is aggregated.
    """
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"])
    if first_clients is not None:
        cust = cust.orderBy("c_custkey").limit(first_clients)
        orders = orders.join(cust.select("c_custkey"), orders.o_custkey == cust.c_custkey, "left_semi")
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"])
    if first_clients is not None:
        li = li.join(orders.select("o_orderkey"), li.l_orderkey == orders.o_orderkey, "left_semi")

    per_order = li.groupBy("l_orderkey").agg(
        F.sum("l_extendedprice").alias("ext"),
        F.sum(F.col("l_extendedprice") * F.col("l_tax")).alias("ext_tax"),
        F.sum(F.col("l_extendedprice") * F.col("l_discount")).alias("ext_disc"),
        F.sum(F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("net"),
        F.sum("l_discount").alias("disc_sum"),
        F.count("l_discount").alias("disc_n"),
        F.count("l_extendedprice").alias("ext_n"),
        F.min("l_discount").alias("disc_min"),
        F.max("l_discount").alias("disc_max"),
        F.max("l_tax").alias("tax_max"),
        F.max("l_quantity").alias("qty_max"),
        F.min("l_shipdate").alias("ship_min"),
        F.max("l_shipdate").alias("ship_max"),
    )
    o = orders.join(per_order, orders.o_orderkey == per_order.l_orderkey, "left")
    last_month = F.col("o_orderdate") >= F.lit(params.last_month_from).cast("timestamp_ntz")
    year_cut = F.col("o_orderdate") >= F.lit(params.year_from).cast("timestamp_ntz")
    per_cust = o.groupBy("o_custkey").agg(
        F.sum("ext").alias("s_ext"),
        F.sum(F.when(last_month, F.col("ext"))).alias("s_ext_last"),
        F.sum(F.when(last_month, F.col("ext_disc"))).alias("s_ext_disc_last"),
        F.sum("ext_tax").alias("s_ext_tax"),
        F.sum("net").alias("s_net"),
        F.sum("ext_n").alias("n_ext"),
        F.sum("disc_sum").alias("s_disc"),
        F.sum("disc_n").alias("n_disc"),
        F.min("disc_min").alias("disc_min"),
        F.max("disc_max").alias("disc_max"),
        F.max("tax_max").alias("tax_max"),
        F.max("qty_max").alias("qty_max"),
        F.min("ship_min").alias("ship_min"),
        F.max("ship_max").alias("ship_max"),
        F.sum("o_totalprice").alias("s_total"),
        F.sum(F.when(year_cut, F.col("o_totalprice"))).alias("s_total_year"),
        F.avg("o_totalprice").alias("avg_total"),
        F.count("o_orderkey").alias("n_orders"),
        F.min("o_orderdate").alias("first_order"),
        F.max("o_orderdate").alias("last_order"),
    )
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey, "inner")
    base = cust.join(geo, cust.c_nationkey == geo.n_nationkey, "inner")
    acct = base.join(per_cust, base.c_custkey == per_cust.o_custkey, "left")

    def z(c: str):
        return F.expr(f"coalesce({c}, 0.0D)")

    return acct.select(
        F.col("c_custkey").alias("id"),
        F.col("c_mktsegment").alias("channel_sales"),
        z("s_ext").alias("cons_12m"),
        z("s_ext_tax").alias("cons_gas_12m"),
        z("s_ext_last").alias("cons_last_month"),
        F.col("first_order").cast("date").alias("date_activ"),
        F.col("last_order").cast("date").alias("date_end"),
        F.col("ship_min").cast("date").alias("date_modif_prod"),
        F.col("ship_max").cast("date").alias("date_renewal"),
        z("s_total").alias("forecast_cons_12m"),
        z("s_total_year").alias("forecast_cons_year"),
        z("try_divide(s_disc, n_disc)").alias("forecast_discount_energy"),
        z("avg_total").alias("forecast_meter_rent_12m"),
        z("disc_min").alias("forecast_price_energy_off_peak"),
        z("disc_max").alias("forecast_price_energy_peak"),
        z("tax_max").alias("forecast_price_pow_off_peak"),
        F.when(F.pmod(F.col("c_custkey"), F.lit(5)) == 0, F.lit("t")).otherwise(F.lit("f")).alias("has_gas"),
        z("s_ext_disc_last").alias("imp_cons"),
        z("try_divide(s_ext, n_ext)").alias("margin_gross_pow_ele"),
        z("try_divide(s_net, n_ext)").alias("margin_net_pow_ele"),
        F.coalesce(F.col("n_orders"), F.lit(0)).cast("bigint").alias("nb_prod_act"),
        F.coalesce(F.year("last_order") - F.year("first_order"), F.lit(0)).cast("int").alias("num_years_antig"),
        F.col("r_name").alias("origin_up"),
        z("qty_max").alias("pow_max"),
        F.when(F.col("c_acctbal") < 0, F.lit(1)).otherwise(F.lit(0)).cast("int").alias("churn"),
    )


# --------------------------------------------------------------------------
# SQL twins for the oracle (DuckDB dialect, tables registered as views).
# --------------------------------------------------------------------------

PRICE_SQL = """
SELECT o.o_custkey AS id,
       CAST(date_trunc('month', o.o_orderdate) AS DATE) AS price_date,
       l.l_discount AS price_off_peak_var,
       l.l_tax AS price_peak_var,
       l.l_discount * l.l_tax AS price_mid_peak_var,
       l.l_extendedprice AS price_off_peak_fix,
       l.l_quantity AS price_peak_fix,
       CASE WHEN l.l_quantity <> 0 THEN l.l_extendedprice / l.l_quantity END AS price_mid_peak_fix,
       l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""


def account_sql(params: Params = DEFAULT) -> str:
    z = lambda x: f"coalesce({x}, 0.0)"
    lm = f"o.o_orderdate >= TIMESTAMP '{params.last_month_from}'"
    yr = f"o.o_orderdate >= TIMESTAMP '{params.year_from}'"
    return f"""
SELECT c.c_custkey AS id,
       c.c_mktsegment AS channel_sales,
       {z('sum(l.l_extendedprice)')} AS cons_12m,
       {z('sum(l.l_extendedprice * l.l_tax)')} AS cons_gas_12m,
       {z(f"sum(l.l_extendedprice) FILTER (WHERE {lm})")} AS cons_last_month,
       CAST(min(o.o_orderdate) AS DATE) AS date_activ,
       CAST(max(o.o_orderdate) AS DATE) AS date_end,
       CAST(min(l.l_shipdate) AS DATE) AS date_modif_prod,
       CAST(max(l.l_shipdate) AS DATE) AS date_renewal,
       {z('sum(o.o_totalprice) FILTER (WHERE l.rn = 1 OR l.rn IS NULL)')} AS forecast_cons_12m,
       {z(f"sum(o.o_totalprice) FILTER ((l.rn = 1 OR l.rn IS NULL) AND {yr})")} AS forecast_cons_year,
       {z('avg(l.l_discount)')} AS forecast_discount_energy,
       {z('avg(o.o_totalprice) FILTER (WHERE l.rn = 1 OR l.rn IS NULL)')} AS forecast_meter_rent_12m,
       {z('min(l.l_discount)')} AS forecast_price_energy_off_peak,
       {z('max(l.l_discount)')} AS forecast_price_energy_peak,
       {z('max(l.l_tax)')} AS forecast_price_pow_off_peak,
       CASE WHEN c.c_custkey % 5 = 0 THEN 't' ELSE 'f' END AS has_gas,
       {z(f"sum(l.l_extendedprice * l.l_discount) FILTER (WHERE {lm})")} AS imp_cons,
       {z('avg(l.l_extendedprice)')} AS margin_gross_pow_ele,
       {z('avg(l.l_extendedprice * (1.0 - l.l_discount))')} AS margin_net_pow_ele,
       CAST(count(DISTINCT o.o_orderkey) AS BIGINT) AS nb_prod_act,
       CAST(coalesce(year(max(o.o_orderdate)) - year(min(o.o_orderdate)), 0) AS INTEGER) AS num_years_antig,
       r.r_name AS origin_up,
       {z('max(l.l_quantity)')} AS pow_max,
       CAST(CASE WHEN c.c_acctbal < 0 THEN 1 ELSE 0 END AS INTEGER) AS churn
FROM customer c
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN orders o ON o.o_custkey = c.c_custkey
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn
           FROM lineitem) l ON l.l_orderkey = o.o_orderkey
GROUP BY c.c_custkey, c.c_mktsegment, r.r_name, c.c_acctbal
"""


def with_views(body: str, params: Params = DEFAULT) -> str:
    """Prefix an oracle query with the ``price`` and ``account`` CTEs."""
    return f"WITH price AS ({PRICE_SQL}), account AS ({account_sql(params)}) {body}"
