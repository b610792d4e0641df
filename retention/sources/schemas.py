"""Logical schemas of the two input tables (explicit, no inference)."""

from pyspark.sql import types as T

# Column names and types of the two inputs -- fixed values.
PRICE_COLUMNS = [
    "price_off_peak_var", "price_peak_var", "price_mid_peak_var",
    "price_off_peak_fix", "price_peak_fix", "price_mid_peak_fix",
]

CLIENT_DATE_COLUMNS = ["date_activ", "date_end", "date_modif_prod", "date_renewal"]

# Values of a flag column -- fixed values.
FLAGS = ("t", "f")

CLIENT_SCHEMA = T.StructType(
    [T.StructField("id", T.StringType(), True),
     T.StructField("channel_sales", T.StringType(), True)]
    + [T.StructField(c, T.DoubleType(), True) for c in
       ["cons_12m", "cons_gas_12m", "cons_last_month"]]
    + [T.StructField(c, T.StringType(), True) for c in CLIENT_DATE_COLUMNS]
    + [T.StructField(c, T.DoubleType(), True) for c in
       ["forecast_cons_12m", "forecast_cons_year", "forecast_discount_energy",
        "forecast_meter_rent_12m", "forecast_price_energy_off_peak",
        "forecast_price_energy_peak", "forecast_price_pow_off_peak"]]
    + [T.StructField("has_gas", T.StringType(), True)]
    + [T.StructField(c, T.DoubleType(), True) for c in
       ["imp_cons", "margin_gross_pow_ele", "margin_net_pow_ele", "nb_prod_act"]]
    + [T.StructField("num_years_antig", T.IntegerType(), True),
       T.StructField("origin_up", T.StringType(), True),
       T.StructField("pow_max", T.DoubleType(), True),
       T.StructField("churn", T.IntegerType(), True)]
)

PRICE_SCHEMA = T.StructType(
    [T.StructField("id", T.StringType(), True),
     T.StructField("price_date", T.StringType(), True)]
    + [T.StructField(c, T.DoubleType(), True) for c in PRICE_COLUMNS]
)
