import datetime as dt

import pytest
from pyspark.sql import functions as F

from closeworks.functions import exprs as x


def one(spark, column):
    return spark.range(1).select(column.alias("v")).collect()[0].v


@pytest.mark.parametrize(
    "period, months, expected",
    [("1997-06", 1, "1997-05"), ("1998-01", 1, "1997-12"), ("2000-03", 12, "1999-03"), (None, 1, None)],
)
def test_prior_period(spark, period, months, expected):
    assert one(spark, x.prior_period(F.lit(period).cast("string"), months)) == expected


def test_a_text_that_is_no_period_gives_null(spark):
    assert one(spark, x.period_start(F.lit("soon"))) is None


@pytest.mark.parametrize(
    "day, expected",
    [("2024-03-01", "2024-02"), ("2024-03-09", "2024-02"), ("2024-03-10", "2024-03"), ("2024-01-05", "2023-12")],
)
def test_closing_period(spark, day, expected):
    assert one(spark, x.closing_period(F.lit(day))) == expected


def test_phase_deadline(spark):
    start = F.lit(dt.datetime(2024, 1, 31, 12)).cast("timestamp_ntz")
    assert one(spark, x.phase_deadline(start, F.lit(2), {1: 24, 2: 48})) == dt.datetime(2024, 2, 2, 12)


@pytest.mark.parametrize(
    "code, expected",
    [
        ("4000", "Revenue"),
        ("5100", "COGS"),
        ("6400", "OpEx"),
        ("7000", "Other Income/Expense"),
        ("8100", "Tax"),
        ("9999", "Other"),
        (None, "Other"),
    ],
)
def test_account_category(spark, code, expected):
    assert one(spark, x.account_category(F.lit(code).cast("string"))) == expected


@pytest.mark.parametrize(
    "failed, checked, expected", [(0, 7, "0.00"), (1, 3, "33.33"), (2, 3, "66.67"), (1, 8, "12.50"), (5, 5, "100.00"), (0, 0, "0.00")]
)
def test_percent_text(spark, failed, checked, expected):
    assert one(spark, x.percent_text(F.lit(failed).cast("bigint"), F.lit(checked).cast("bigint"))) == expected


def test_sums_do_not_depend_on_row_order(frame):
    amounts = [(0.1,), (0.2,), (1e9,), (-1e9,), (0.7,)]
    a = frame("v double", *amounts).agg(x.total("v").alias("s")).collect()[0].s
    b = frame("v double", *reversed(amounts)).agg(x.total("v").alias("s")).collect()[0].s
    assert a == b == 1.0


def test_percentages_of_zero(spark):
    zero, part = F.lit(0.0), F.lit(3.0)
    assert one(spark, x.percent_of(part, zero)) is None
    assert one(spark, x.percent_or_zero(part, zero)) == 0.0
    assert one(spark, x.percent_or_zero(part, F.lit(-2.0))) == 150.0
    assert one(spark, x.margin_percent(part, F.lit(-2.0))) == -150.0


def test_mean_skips_null_and_has_no_value_without_rows(frame):
    df = frame("v double", (1.0,), (None,), (2.0,))
    assert df.agg(x.mean("v").alias("m")).collect()[0].m == 1.5
    assert df.filter("v > 5").agg(x.mean("v").alias("m")).collect()[0].m is None


def test_newest_period_without_rows_is_empty(frame):
    df = frame("closure_period string, v int", ("2024-01", 1), ("2024-02", 2))
    assert [r.v for r in x.newest_period(df).collect()] == [2]
    assert x.newest_period(df.filter("v > 9")).collect() == []


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_sums_have_no_small_limit(spark, frame, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = frame("k int, x double", (1, 1e15), (1, 1.0), (2, float("nan")), (2, 2.5), (3, float("inf")), (4, -1e18), (4, 0.25))
        got = {r.k: r.s for r in df.groupBy("k").agg(x.total("x").alias("s")).collect()}
        assert got == {1: 1e15 + 1, 2: 2.5, 3: None, 4: -1e18 + 0.25}
        with pytest.raises(Exception, match="out of range"):
            frame("x double", (1e300,)).agg(x.total("x")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
