"""Typing, text and date functions on literal rows."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderloom.functions import dates, text, typing


def column(df, expression):
    return [r[0] for r in df.select(expression).collect()]


def test_scores_from_text(spark):
    df = spark.createDataFrame([("abc",), ("4",), ("4.7",), (" 3 ",), ("",), (None,)], "s string")
    assert column(df, typing.whole_number(df, "s")) == [None, 4, 4, 3, None, None]


def test_amounts_from_text(spark):
    df = spark.createDataFrame([("n/a",), ("1.5",), ("",), ("1e3",)], "s string")
    assert column(df, typing.amount(df, "s")) == [None, 1.5, None, 1000.0]


def test_exact_amounts(spark):
    df = spark.createDataFrame([(0.1,), (12.345,), (2e16,), (1e25,), (None,)], "v double")
    expected = [Decimal("0.1"), Decimal("12.345"), Decimal(2 * 10**16), Decimal(10**25), None]
    assert column(df, typing.exact(F.col("v"))) == expected
    assert column(df, typing.exact(F.col("v"), 2))[1] == Decimal("12.35")


@pytest.mark.parametrize("value", [1e33, float("inf")])
def test_an_amount_that_does_not_fit_is_an_error(spark, value):
    df = spark.createDataFrame([(value,)], "v double")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|infinite"):
        df.select(typing.exact(F.col("v"))).collect()


def test_amounts_times_counts(spark):
    df = spark.createDataFrame([(0.125, 10**18), (3.001, 7)], "v double, n bigint")
    assert column(df, typing.times(typing.exact(F.col("v")), F.col("n"))) == [Decimal(125 * 10**15), Decimal("21.007")]


def test_timestamps_from_text(spark):
    df = spark.createDataFrame([("2018-01-02 03:04:05",), ("bad",), (None,)], "t string")
    assert column(df, typing.timestamp(df, "t").cast("string")) == ["2018-01-02 03:04:05", None, None]


def test_timestamp_column_is_kept(spark):
    df = spark.sql("select timestamp_ntz'2018-01-02 03:04:05' as t")
    assert df.select(typing.timestamp(df, "t").alias("t")).dtypes == [("t", "timestamp_ntz")]


@pytest.mark.parametrize(
    "raw, expected",
    [("\t SHIPPED \n", "shipped"), (" Created ", "created"), ("\x1cUn Available\x1f", "un available"),
     ("", ""), (None, None)],
)
def test_strip_lower(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "s string")
    assert column(df, text.strip_lower(F.col("s"))) == [expected]


def test_every_white_space_character_is_stripped(spark):
    """As Python's ``strip`` does, for all characters of the basic plane."""
    characters = [chr(i) for i in range(1, 0x10000) if not 0xD800 <= i <= 0xDFFF]
    df = spark.createDataFrame([(c, f"{c}{c}x{c}x{c}") for c in characters], "c string, s string")
    got = df.where(text.strip_lower(F.col("s")) == F.lower(F.concat(F.lit("x"), "c", F.lit("x")))).collect()
    assert {r["c"] for r in got} == {c for c in characters if not c.strip()}


def test_null_tokens(spark):
    df = spark.createDataFrame([("NA",), ("",), ("null",), ("nA",), ("x",)], "s string")
    assert column(df, text.null_if_token(F.col("s"))) == [None, None, None, "nA", "x"]


def test_delay_counts_calendar_days(spark):
    df = spark.sql(
        """select timestamp'2017-01-05 00:00:01' as d, timestamp'2017-01-03 23:59:59' as e
           union all select null, timestamp'2017-01-03 00:00:00'"""
    )
    assert column(df, dates.days_late("d", "e")) == [2, None]


def test_month_start_and_back(spark):
    df = spark.sql("select timestamp'2017-01-31 10:00:00' as t union all select null")
    months = df.select(dates.month_start("t").cast("string").alias("m"))
    assert column(months, F.col("m")) == ["2017-01-01 00:00:00", None]
    assert column(months, dates.month_from_text("m").cast("string")) == ["2017-01-01 00:00:00", None]


def test_canonical_text_accepts_one_format(spark):
    df = spark.createDataFrame(
        [("2017-10-02 10:56:33",), ("02/10/2017",), ("2017-10-02",), ("2017-13-02 10:56:33",),
         ("2017-02-29 10:56:33",), ("2017-10-02 24:00:00",), (" 2017-10-02 10:56:33",), (None,)],
        "t string",
    )
    assert column(df, dates.canonical_text("t")) == ["2017-10-02 10:56:33"] + [None] * 7


def test_canonical_text_of_timestamps(spark):
    df = spark.sql("select timestamp'2017-10-02 10:56:33' as t")
    assert column(df, dates.canonical_text("t")) == ["2017-10-02 10:56:33"]


def test_datetime_is_utc(spark):
    assert spark.sql("select timestamp'2017-01-01 00:00:00' as t").first()[0].replace(tzinfo=None) == datetime(2017, 1, 1)
