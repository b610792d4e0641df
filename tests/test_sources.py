"""CSV with explicit schema, null tokens, bad dates, sinks."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retention.functions.scalars import r6
from retention.sources import files as S


def test_price_csv_tokens_and_dates(spark):
    d = tempfile.mkdtemp(prefix="retention-csv-")
    path = os.path.join(d, "price.csv")
    with open(path, "w") as f:
        f.write("id,price_date,price_off_peak_var,price_peak_var,price_mid_peak_var,"
                "price_off_peak_fix,price_peak_fix,price_mid_peak_fix\n")
        f.write("a,2015-01-01,0.1,NA,,40.5,null,NaN\n")
        f.write("MISSING,not-a-date,0.2,0.0,0.0,41.0,0.0,0.0\n")
    df = S.read_price_csv(spark, path)
    rows = {r["id"]: r for r in df.collect()}
    assert rows["a"]["price_date"] == dt.date(2015, 1, 1)
    assert rows["a"]["price_peak_var"] is None and rows["a"]["price_mid_peak_var"] is None
    assert rows["a"]["price_mid_peak_fix"] is None  # NaN -> NULL
    assert rows["MISSING"]["price_date"] is None  # bad date -> NULL, counted below
    loaded = S.load_price_csv(spark, path)
    assert loaded.rejected == {c: int(c == "price_date") for c in S.PRICE_SCHEMA.fieldNames()[1:]}
    out = os.path.join(d, "out")
    S.write_csv(df, out)
    back = spark.read.option("header", True).csv(out)
    assert back.count() == 2 and "_c0" not in back.columns  # no index column written


def test_write_table_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="retention-pq-")
    df = spark.createDataFrame([(1, dt.date(2015, 1, 1), 2.5)], "id int, price_date date, v double")
    S.write_table(df, d + "/t", partition_by=["price_date"])
    back = spark.read.parquet(d + "/t")
    assert back.schema["v"].dataType.typeName() == "double" and back.count() == 1


def test_csv_columns_by_name(spark):
    d = tempfile.mkdtemp(prefix="retention-csv-")
    path = os.path.join(d, "price.csv")
    names = ["note", "price_peak_fix", "price_date", "id", "price_off_peak_var", "price_peak_var", "price_mid_peak_var",
             "price_off_peak_fix", "price_mid_peak_fix"]
    with open(path, "w") as f:
        f.write(",".join(names) + "\n" + "x,5.5,2015-01-01,a,0.1,0.2,0.3,0.4,0.5\n")
    row = S.read_price_csv(spark, path).first()
    assert (row["id"], row["price_peak_fix"], row["price_off_peak_var"], row["note"]) == ("a", 5.5, 0.1, "x")
    with open(path, "w") as f:
        f.write("id,price_date\na,2015-01-01\n")
    with pytest.raises(ValueError):
        S.read_price_csv(spark, path)


def test_rounding_of_large_values(spark):
    df = spark.createDataFrame([(1e13,), (9.3e15,), (-2.5e20,), (-0.0000005,), (0.0,), (2.0000005,)], "x double")
    got = [(r.a, r.b) for r in df.select(r6("x").alias("a"), r6(F.col("x")).alias("b")).collect()]
    assert got[:3] == [(1e13, 1e13), (9.3e15, 9.3e15), (-2.5e20, -2.5e20)] and got[4] == (0.0, 0.0)
    assert all(a == b for a, b in got)


def _csv(name, text):
    path = os.path.join(tempfile.mkdtemp(prefix="retention-csv-"), name)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_types_of_further_columns(spark):
    """Every value counts, also one that comes last and in another file; the join of the lattice is the type."""
    names = ["id", "whole", "mixed", "late", "text", "day", "nothing", "day_or_number", "huge", "zeros"]
    rows = [["a", "1", "1", "5", "x", "2015-01-31", "", "2015-01-31", "9" * 30, "007"],
            ["b", "-2", "2.5", "6", "1", "NA", "null", "3", "1", "+1"],
            ["c", "NA", "1e3", "7", "2", "2016-02-29", "", "NA", "2", "0"]]
    d = tempfile.mkdtemp(prefix="retention-csv-")
    for i, part in enumerate((rows * 400, [["z", "5", "1", "late", "y", "2015-02-28", "", "", "", "0"]])):
        with open(os.path.join(d, f"{i}.csv"), "w") as f:
            f.write("\n".join(",".join(r) for r in [names, *part]) + "\n")
    schema = T.StructType([T.StructField("id", T.StringType())])
    want = ["bigint", "double", "string", "string", "date", "double", "string", "double", "bigint"]
    for df in (S.read_csv(spark, d, schema), S.load_csv(spark, d, schema).rows):
        assert [t for _, t in df.dtypes] == ["string", *want] and df.columns == names
        got = {r["id"]: r for r in df.collect()}
        assert got["b"]["mixed"] == 2.5 and got["c"]["mixed"] == 1000.0 and got["z"]["late"] == "late" and got["a"]["late"] == "5"
        assert got["a"]["day"] == dt.date(2015, 1, 31) and got["b"]["day"] is None and got["a"]["zeros"] == 7
    empty = S.load_csv(spark, _csv("e.csv", "id,more\n"), schema)
    assert empty.rows.dtypes == [("id", "string"), ("more", "double")] and not empty.rows.count() and empty.rejected == {"more": 0}


def test_rejects_are_counted_and_listed(spark):
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("v", T.DoubleType()),
                           T.StructField("d", T.StringType()), T.StructField("flag", T.StringType())])
    rows = ["a,1.0,2.5,2015-01-01,t", "b,6.5,\"1,234.5\",2015-13-01,x", "c,99999999999,NaN,NA,f", "d,-3.0, nan ,2015-02-30,", "e,abc,1e400,,T",
            "f,1e2,inf,2015-01-01,t"]
    d = os.path.dirname(_csv("one.csv", "\n".join(["id,n,v,d,flag", *rows * 300]) + "\n"))
    with open(os.path.join(d, "two.csv"), "w") as f:
        f.write("\n".join(["id,n,v,d,flag", *rows[:2]]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")        # several blocks a file
    try:
        loaded = S.load_csv(spark, d, schema, ["d"], {"flag": ("t", "f")}, row_order="row_order")
        stored = {r["id"]: r for r in loaded.rows.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(stored[i]["n"], stored[i]["v"]) for i in "abd"] == [(1, 2.5), (None, None), (-3, None)] and stored["f"]["n"] == 100
    assert stored["c"]["n"] is None and stored["b"]["flag"] == "x"
    assert loaded.rejected == {"n": 300 * 3 + 1, "v": 301, "d": 300 * 2 + 1, "flag": 300 * 2 + 1}
    want = []
    for name, body in (("one.csv", rows * 300), ("two.csv", rows[:2])):
        for line, r in enumerate(body, 2):
            want += [(name, line, *x) for x in {"b": [("n", "6.5"), ("v", "1,234.5"), ("d", "2015-13-01"), ("flag", "x")], "c": [("n", "99999999999")],
                                                "d": [("d", "2015-02-30")], "e": [("n", "abc"), ("flag", "T")]}.get(r[0], [])]
    got = sorted((os.path.basename(r["file"]), r["line"], r["column"], r["value"]) for r in loaded.rejects.collect())
    assert got == sorted(want)
    ordered = [r["id"] for r in loaded.rows.orderBy("row_order").collect()]
    assert ordered == [r[0] for r in rows] * 300 + ["a", "b"]
