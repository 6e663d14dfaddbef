"""Values bound inside an expression."""

from __future__ import annotations

from pyspark.sql import functions as F

from sleevework.functions.core import blank_to_null, let


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_value_is_worked_out_once_inside_a_lambda(spark):
    rows = spark.createDataFrame([(["a", "", None],)], "t array<string>")
    found = rows.select(F.transform("t", lambda t: blank_to_null(F.regexp_extract(t, "(.*)", 1))).alias("t"))
    assert plan(found).count("regexp_extract(") == 1
    assert found.collect()[0]["t"] == ["a", None, None]
    nested = rows.select(F.transform("t", lambda t: let(F.struct(t.alias("t"), F.length(t).alias("n")), lambda x: F.concat(x["t"], x["n"].cast("string")))).alias("t"))
    assert nested.collect()[0]["t"] == ["a1", "0", None]
