from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from merchantry.functions import (
    code_label,
    concat_text,
    decode_yyyymmdd,
    growth_percentage,
    truncated_ratio,
    int_avg,
    int_div,
    is_undecodable,
    text_length,
    years_between,
)


def value(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    "a, b, quotient", [(7, 2, 3), (-7, 2, -3), (7, -2, -3), (6, 3, 2), (None, 2, None)]
)
def test_int_div_truncates_toward_zero(spark, a, b, quotient):
    assert value(spark, int_div(F.lit(a).cast("int"), F.lit(b))) == quotient


def test_int_avg_truncates_and_skips_nulls(spark):
    df = spark.createDataFrame([(10,), (11,), (None,)], "x int")
    assert df.agg(int_avg(F.col("x"))).first()[0] == 10
    assert df.where("x > 99").agg(int_avg(F.col("x"))).first()[0] is None
    negative = spark.createDataFrame([(-10,), (-11,)], "x int")
    assert negative.agg(int_avg(F.col("x"))).first()[0] == -10


def test_int_avg_over_a_window(spark):
    df = spark.createDataFrame([(1, 10), (2, 11), (3, 20)], "k int, x int")
    running = df.select("k", int_avg(F.col("x"), W.orderBy("k")).alias("m")).orderBy("k")
    assert [r.m for r in running.collect()] == [10, 10, 13]


@pytest.mark.parametrize(
    "current, previous, percent",
    [
        (150, 100, "50.00"),
        (1, 3, "-66.67"),
        (79_990, 80_000, "-0.01"),
        (799_000, 800_000, "-0.13"),
        (801_000, 800_000, "0.13"),
        (5, 0, None),
        (5, None, None),
        (-50, -100, "-50.00"),
    ],
)
def test_growth_rounds_half_away_from_zero(spark, current, previous, percent):
    column = growth_percentage(F.lit(current).cast("bigint"), F.lit(previous).cast("bigint"))
    assert value(spark, column) == (None if percent is None else Decimal(percent))


def test_concat_text_takes_null_as_empty(spark):
    assert value(spark, concat_text(F.lit(None), F.lit(" "), F.lit(None))) == " "
    assert value(spark, concat_text(F.lit("Ann"), F.lit(" "), F.lit(None))) == "Ann "


def test_text_length_ignores_trailing_spaces(spark):
    assert value(spark, text_length(F.lit(" ab  "))) == 3


@pytest.mark.parametrize(
    "number, day",
    [
        (20101229, date(2010, 12, 29)),
        (20120229, date(2012, 2, 29)),
        (20110229, None),
        (20101350, None),
        (20100010, None),
        (20100100, None),
        (20100132, None),
        (99991231, date(9999, 12, 31)),
        (99999999, None),
        (0, None),
        (32154, None),
        (201012290, None),
        (-2010122, None),
        (None, None),
    ],
)
def test_decode_yyyymmdd(spark, number, day):
    assert value(spark, decode_yyyymmdd(F.lit(number).cast("int"))) == day


def test_every_day_of_many_years_decodes(spark):
    days = spark.sql("SELECT explode(sequence(DATE'1890-01-01', DATE'2110-12-31')) AS d")
    numbers = days.withColumn("n", F.date_format("d", "yyyyMMdd").cast("int"))
    assert numbers.where(~decode_yyyymmdd(F.col("n")).eqNullSafe(F.col("d"))).count() == 0
    fakes = spark.range(20000000, 20010000).withColumn("n", F.col("id").cast("int"))
    wrong = fakes.where(
        ~decode_yyyymmdd(F.col("n")).eqNullSafe(
            F.try_to_date(F.col("n").cast("string"), "yyyyMMdd")
        )
    )
    assert wrong.count() == 0


@pytest.mark.parametrize(
    "number, flagged",
    [(20101350, True), (-2010122, True), (20101229, False), (0, False), (123, False), (None, False)],
)
def test_undecodable_has_the_length_of_a_date(spark, number, flagged):
    assert value(spark, is_undecodable(F.lit(number).cast("int"))) is flagged


def test_years_between_counts_boundaries(spark):
    first, last = F.lit("2010-12-31").cast("date"), F.lit("2011-01-01").cast("date")
    assert value(spark, years_between(first, last)) == 1
    assert value(spark, years_between(last, last)) == 0


def test_code_label(spark):
    labels = {"F": "Female", "FEMALE": "Female", "M": "Male"}
    codes = spark.createDataFrame([("F",), ("FEMALE",), ("M",), ("x",), (None,)], "c string")
    found = codes.select(code_label(F.col("c"), labels)).collect()
    assert [r[0] for r in found] == ["Female", "Female", "Male", "n/a", "n/a"]


def test_ratios_are_cut_and_not_rounded(spark):
    two, three = (F.lit(n).cast("bigint") for n in (2, 3))
    assert int(spark.range(1).select(truncated_ratio(two, three, 13)).first()[0]) == 6666666666666


def test_a_quotient_just_under_a_half_is_rounded_down(spark):
    # 0.00499999999999999...95 percent.
    column = growth_percentage(F.lit(10**18 + 49_999_999_999_999).cast("bigint"), F.lit(10**18).cast("bigint"))
    assert str(spark.range(1).select(column).first()[0]) == "0.00"
