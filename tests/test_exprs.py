from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from coverloom.functions import schemas as S
from coverloom.functions.exprs import (
    below, cents, differs, digest, dot_to_blank, has_content, is_open, key, least_strict, number, percent, unless, valid_date, ymd,
)


def one(spark, expr, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or ["id"]).select(expr).first()[0]


def test_ymd_equals_parsed_text(spark):
    odd = spark.createDataFrame(
        [(y, m, d) for y in (0, 1, -5, 2023, 2024, 1900, 2000, 20231, None) for m in (0, 1, 2, 4, 12, 13, 123, -1, None)
         for d in (0, 1, 28, 29, 30, 31, 32, 311, -2, None)], "y int, m int, d int")
    text = valid_date(key(("y", 4), ("m", 2), ("d", 2)))
    assert odd.filter(~text.eqNullSafe(ymd("y", "m", "d"))).count() == 0
    assert odd.filter(text.isNotNull()).count() > 50


def test_dates(spark):
    df = spark.createDataFrame([(2023, 2, 31), (0, 0, 0), (0, 1, 1), (None, 1, 1), (2024, 2, 29), (2023, 5, 7)], "y int, m int, d int")
    assert [r[0] for r in df.select(ymd("y", "m", "d")).collect()] == [None, None, None, None, date(2024, 2, 29), date(2023, 5, 7)]


def test_keys_pad_cut_and_keep_null(spark):
    df = spark.createDataFrame([(7, 123), (123, 5), (None, 5)], "a int, b int")
    assert [r[0] for r in df.select(key(("a", 2), ("b", 5))).collect()] == ["0700123", "1200005", None]


def test_least_is_strict(spark):
    a, none = F.lit("2020-01-01").cast("date"), F.lit(None).cast("date")
    assert one(spark, least_strict(a, none)) is None
    assert one(spark, least_strict(a, F.lit("2019-01-01").cast("date"))) == date(2019, 1, 1)


def test_missing_modes(spark):
    df = spark.createDataFrame([(None, None), ("S", 0), ("N", 3)], "t string, n int")
    assert df.filter(differs("t", "S", "sas")).count() == 2 and df.filter(differs("t", "S", "sql")).count() == 1
    assert df.filter(below("n", 1, "sas")).count() == 2 and df.filter(below("n", 1, "sql")).count() == 1
    p = (F.col("t") == "S") & F.col("n").isin(0, 1)
    assert df.filter(unless(p, "sas")).count() == 2 and df.filter(unless(p, "sql")).count() == 1


def test_exact_cents(spark):
    assert one(spark, cents("v"), v=Decimal("123456789012345")) == Decimal("1234567890123.45000")
    assert one(spark, cents("v", 38, 2), v=Decimal("-7")) == Decimal("-0.07")


def test_small_helpers(spark):
    assert one(spark, dot_to_blank(F.lit(" . "))) == "" and one(spark, dot_to_blank(F.lit(" A1 "))) == "A1"
    assert one(spark, has_content(F.lit(" . ."))) is False and one(spark, has_content(F.lit(" 0."))) is True
    assert one(spark, number(F.lit("12"))) == 12 and one(spark, number(F.lit("x"))) is None
    assert one(spark, percent(F.lit(1), F.lit(0))) is None and one(spark, percent(F.lit(1), F.lit(4))) == 25.0
    assert one(spark, is_open(F.lit(datetime(5999, 1, 1)))) is True


def test_digest_collides_only_without_separator(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, "abc")], "x string, y string")
    assert df.select(digest(["x", "y"])).distinct().count() == 1
    assert df.select(digest(["x", "y"], "\u001f")).distinct().count() == 3


def test_contracts_have_the_documented_widths():
    widths = {"RECEIPT_STATES": 33, "STAFFED_STATES": 35, "FINAL_STATES": 36, "TRANSACTIONS": 53, "COVERAGES": 17, "CHANGED_IMAGES": 14,
              "GROUP_IMAGES": 16, "IMAGES": 18, "EXPOSURE": 69}
    assert {n: len(getattr(S, n)) for n in widths} == widths
    assert len(S.EXTRACTS) == 17
    assert len(S.EXPOSURE) - len(S.UNDIGESTED) == 60


def test_shape_fills_typed_nulls(spark):
    out = S.shape(spark.range(1).select(F.lit(5).alias("b")), S.schema("a:date b:decimal(9,2) c:string"), c=F.lit("x"))
    assert out.dtypes == [("a", "date"), ("b", "decimal(9,2)"), ("c", "string")]
    assert out.first() == (None, Decimal("5.00"), "x")
