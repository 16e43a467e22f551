import math

from pyspark.sql import functions as F

from tillroll.functions import (full_name, margin_pct, money_round, month_trunc,
                                safe_divide, standardise_domain, try_cast_to)
from tillroll import schemas


def test_money_round_is_half_up_via_decimal(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-1.005,), (None,), (float("nan"),)], "x double")
    got = [r[0] for r in df.select(money_round("x")).collect()]
    assert got[:3] == [1.01, 2.68, -1.01]
    assert got[3] is None and got[4] is None  # NaN casts to NULL, no error


def test_money_round_scale_one(spark):
    df = spark.createDataFrame([(2.25,), (2.35,)], "x double")
    assert [r[0] for r in df.select(money_round("x", 1)).collect()] == [2.3, 2.4]


def test_safe_divide_zero_is_null_not_error(spark):
    df = spark.createDataFrame([(10.0, 0.0), (10.0, 4.0), (None, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(safe_divide("a", "b")).collect()] == [None, 2.5, None]


def test_margin_pct_zero_price(spark):
    df = spark.createDataFrame([(0.0, 1.0), (10.0, 6.0)], "p double, c double")
    assert [r[0] for r in df.select(margin_pct("p", "c")).collect()] == [None, 40.0]


def test_standardise_domain_null_to_default(spark):
    df = spark.createDataFrame([("gold",), ("platinum",), (None,)], "t string")
    got = [r[0] for r in df.select(standardise_domain("t", ["standard", "silver", "gold"], "standard")).collect()]
    assert got == ["gold", "standard", "standard"]


def test_full_name_all_null_is_empty(spark):
    df = spark.createDataFrame([("A", "B"), ("A", None), (None, None)], "f string, l string")
    assert [r[0] for r in df.select(full_name("f", "l")).collect()] == ["A B", "A", ""]


def test_month_trunc_returns_date(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2001-03-31 23:59:59.999999' AS t")
    out = df.select(month_trunc("t").alias("m"))
    assert out.schema["m"].dataType.typeName() == "date"
    assert str(out.first()["m"]) == "2001-03-01"


def test_try_cast_to_matches_names_case_insensitively(spark):
    df = spark.createDataFrame([("7", "x", "1.5")], "ITEM_ID string, junk string, Unit_Price string")
    out = try_cast_to(df, schemas.ORDER_ITEMS)
    row = out.first()
    assert out.columns == schemas.ORDER_ITEMS.fieldNames()
    assert row["item_id"] == 7 and row["unit_price"] == 1.5 and row["quantity"] is None


def test_try_cast_bad_value_is_null(spark):
    df = spark.createDataFrame([("abc",)], "quantity string")
    assert try_cast_to(df, schemas.ORDER_ITEMS).first()["quantity"] is None
