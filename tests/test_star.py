"""Amounts that the views of the test tables make from doubles."""
import math

from pyspark.sql import functions as F

from coverloom.catalog.star import _cents, _decimal

DOUBLES = [0.0, -0.0, None, 0.01, 0.1, 0.29, 1.005, 2.675, -2.675, 0.1 + 0.02, 0.07 + 0.01, 123456.78, -99999.99, 0.005, 0.015, 0.0049999, 1e-9, 3.14159, 999.9999,
           math.nextafter(0.29, 1), math.nextafter(1234.56, 0), 33.333333333]


def test_doubles_become_the_decimals_of_a_cast(spark):
    wide = [9_999_999_999.99, 1e10, 123456789012.34, -98765432109.875]
    df = spark.createDataFrame([(x,) for x in DOUBLES + wide], "x double")
    for kind in ("decimal(18,2)", "decimal(18,4)"):
        assert df.filter(~_decimal("x", kind).eqNullSafe(F.col("x").cast(kind))).count() == 0
    narrow = df.filter("x is null or abs(x) < 1e9")
    for by in (1, 10, 100, 10_000):
        assert narrow.filter(~_cents("x", by).eqNullSafe((F.col("x").cast("decimal(18,2)") * by).cast("decimal(14,0)"))).count() == 0
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),)], "x double")
    tried = odd.filter(F.abs("x") < 1)  # ANSI casts of these fail, before as now
    assert tried.select(_decimal("x", "decimal(18,2)")).count() == 0


def test_numbers_with_two_decimals_are_not_read_from_their_text(spark):
    plan = spark.range(1).select(F.col("id").cast("double").alias("x")).select(_decimal("x", "decimal(18,2)").alias("y"))._jdf.queryExecution().optimizedPlan().toString()
    assert "rint" in plan.lower()
