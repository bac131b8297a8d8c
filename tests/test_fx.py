import datetime as dt
import decimal
import random
import statistics

import pytest
from conftest import rows
from pyspark.sql import functions as F

from closeworks.functions import ranks
from closeworks.operators import fx, metrics
from closeworks.sources import tables

RAW = "load_id string, currency string, rate double, rate_date date, source string, loaded_at timestamp"
D = dt.date
T = dt.datetime


def raw_rows(*items):
    """(currency, rate, day, minute, load id)"""
    return [(i, c, r, D(2024, 1, d), "ECB", T(2024, 1, d, 8, m)) for c, r, d, m, i in items]


def brute_force(data, order):
    """Prior rate by sorting each currency in plain Python."""
    out = {}
    for currency in {r["currency"] for r in data}:
        line = sorted((r for r in data if r["currency"] == currency), key=lambda r: [r[c] for c in order])
        for before, row in zip([None, *line], line):
            out[row["id"]] = before["rate"] if before else None
    return out


@pytest.mark.parametrize("slices", [1, 3, 16, 1024])
def test_prior_rate_equals_brute_force_whatever_the_slices(spark, slices):
    rng = random.Random(7)
    data = [
        {
            "id": i,
            # A third of all rows in one currency; some without a currency.
            "currency": "EUR" if i % 3 == 0 else rng.choice(["GBP", "SGD", None, ""]),
            "rate": None if rng.random() < 0.1 else rng.choice([0.0, 0.9, 1.0, 1.1]),
            "rate_date": D(2024, 1, rng.randint(1, 4)),
        }
        for i in rng.sample(range(1000), 300)
    ]
    df = spark.createDataFrame(data, "id bigint, currency string, rate double, rate_date date").repartition(7)
    got = fx.with_prior_rate(df, ("rate_date", "id"), slices)
    assert {r.id: r.prior_rate for r in got.collect()} == brute_force(data, ("rate_date", "id"))


def test_prior_rate_by_load_time_and_id(spark):
    rng = random.Random(3)
    data = [
        {
            "id": i,
            "currency": rng.choice("AB"),
            "rate": rng.random(),
            "rate_date": D(2024, 1, rng.randint(1, 2)),
            "loaded_at": T(2024, 1, 3, 1, rng.randint(0, 3), rng.randint(0, 1)),
            "load_id": f"{i:03d}",
        }
        for i in range(200)
    ]
    ddl = "id int, currency string, rate double, rate_date date, loaded_at timestamp, load_id string"
    got = fx.with_prior_rate(spark.createDataFrame(data, ddl))
    assert {r.id: r.prior_rate for r in got.collect()} == brute_force(data, fx.RATE_ORDER)


def test_unknown_days_come_first(frame):
    df = frame("id bigint, currency string, rate double, rate_date date", (1, "A", 2.0, D(2024, 1, 1)), (2, "A", 1.0, None))
    got = {r.id: r.prior_rate for r in fx.with_prior_rate(df, ("rate_date", "id")).collect()}
    assert got == {1: 1.0, 2: None}


ORDER_TYPES = {
    "bigint": lambda i: i,
    "decimal(20,0)": decimal.Decimal,
    "double": lambda i: i / 4,
    "string": lambda i: f"load-{i:05d}",
    "date": lambda i: D(2024, 1, 1) + dt.timedelta(days=i),
    "timestamp": lambda i: T(2024, 3, 10, 0, 0, tzinfo=dt.timezone.utc) + dt.timedelta(minutes=10 * i),
    "timestamp_ntz": lambda i: T(2024, 3, 10, 0, 0) + dt.timedelta(minutes=10 * i),
}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("kind", sorted(ORDER_TYPES))
def test_any_order_type_on_one_hot_day(spark, kind, zone):
    """A whole load on one day with one load time: rows are told apart by the last order column alone."""
    rng = random.Random(5)
    places = list(range(240))
    rng.shuffle(places)
    data = [(p, rng.choice("AAB"), rng.random(), D(2024, 3, 10), T(2024, 3, 11), ORDER_TYPES[kind](p)) for p in places]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        ddl = f"id bigint, currency string, rate double, rate_date date, loaded_at timestamp, load_id {kind}"
        got = fx.with_prior_rate(spark.createDataFrame(data, ddl).repartition(5), slices=30)
        found = {r.id: r.prior_rate for r in got.select("id", "prior_rate").collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    names = ("id", "currency", "rate")
    assert found == brute_force([dict(zip(names, r)) for r in data], ("id",))


def test_a_hot_day_is_split_by_rows(spark):
    df = spark.range(4000).selectExpr(
        "id", "'A' AS currency", "cast(id AS double) AS rate", "date'2024-01-01' AS rate_date", "1 AS loaded_at", "1 AS load_id"
    )
    plan = fx.with_prior_rate(df, ("rate_date", "loaded_at", "id"), 64)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 1 and all("_slice" in w.split("windowspecdefinition")[1] for w in windows)
    key = F.struct(F.col("rate_date"), F.col("loaded_at"), F.col("id"))
    cuts = df.filter("id % 64 = 5").agg(F.sort_array(F.collect_set(key)).alias("c")).scalar()
    sizes = df.withColumn("cuts", cuts).groupBy(ranks.place(key, F.col("cuts"), 64).alias("s")).count().collect()
    assert max(r["count"] for r in sizes) <= 70 and len(sizes) == 64


def test_slices_grow_with_the_rates(spark, monkeypatch):
    """About as many slices as the rows fill, whether all rows are seen or their number is told by the hashes."""
    df = spark.range(6000).selectExpr("'A' AS currency", "cast(id AS double) AS rate", "id", "xxhash64(id) AS _hash")
    for n, most in ((200, 500), (2000, 500), (6000, 500), (6000, 40)):
        rows_ = df.filter(F.col("id") < n)
        cuts = ranks.sampled_keys(rows_, F.struct("id"), F.col("_hash"), most, 50)
        found = len(rows_.limit(1).select(cuts.alias("c")).collect()[0].c)
        assert abs(found - min(n / 50, most)) <= 0.25 * n / 50


def test_equal_rates_of_one_load_are_split(spark):
    """All rates of a currency on one day and in one load; the rows are told apart by their other columns."""
    df = spark.range(3000).selectExpr("id", "'A' AS currency", "1.5D AS rate", "date'2024-01-01' AS rate_date", "1 AS loaded_at", "1 AS load_id")
    got = fx.with_prior_rate(df, slices=32)
    assert sorted((r.prior_rate for r in got.collect()), key=repr) == [1.5] * 2999 + [None]
    hashed = df.withColumn("_hash", F.xxhash64(*df.columns))
    key = F.struct("currency", "rate_date", "_hash")
    cuts = ranks.sampled_keys(hashed, key, F.col("_hash"), 32)
    sizes = hashed.withColumn("c", cuts).groupBy(ranks.place(key, F.col("c"), 32).alias("s")).count().collect()
    assert len(sizes) >= 32 and sum(r["count"] for r in sizes) == 3000


def test_rates_are_shuffled_and_sorted_once(spark):
    from test_plans import nodes

    raw = spark.createDataFrame(raw_rows(*[("EUR", float(i), 1 + i % 28, i % 60, f"l{i}") for i in range(300)]), RAW)
    df = fx.with_prior_rate(raw)
    df.collect()
    found = [n.getClass().getSimpleName() for n in nodes(df)]
    assert found.count("SortExec") == 1 and found.count("WindowExec") == 1
    assert not [x for x in found if "Join" in x or x == "SortAggregateExec"]


def test_variance_and_validation(frame):
    data = raw_rows(
        ("EUR", 100.0, 1, 0, "a"),
        ("EUR", 105.0, 2, 0, "b"),  # exactly 5 %: still valid
        ("EUR", 120.0, 3, 0, "c"),  # too far
        ("EUR", None, 4, 0, "d"),
        ("EUR", 121.0, 5, 0, "e"),  # prior rate missing: variance 0
        ("GBP", 0.0, 1, 0, "f"),
        ("GBP", 0.8, 2, 0, "g"),  # prior rate zero: no variance
        ("QQQ", 1.0, 1, 0, "h"),
        (None, 1.0, 1, 0, "i"),
    )
    df = fx.process_fx(frame(RAW, *data), "2024-01")
    got = {r.load_id: (r.is_validated, r.validation_notes) for r in df.collect()}
    assert got == {
        "a": (True, None),
        "b": (True, None),
        "c": (False, "Variance exceeds 5.0%"),
        "d": (False, "Missing rate"),
        "e": (True, None),
        "f": (False, "Invalid rate"),
        "g": (False, None),
        "h": (False, "Invalid currency"),
        "i": (False, None),
    }
    variance = {r.load_id: r.variance_from_prior for r in df.collect()}
    assert variance["a"] == 0.0 and variance["e"] == 0.0 and variance["g"] is None and variance["d"] is None
    assert {r.closure_period for r in df.collect()} == {"2024-01"}


def test_ties_on_a_day_follow_the_load_order(frame):
    raw = frame(RAW, *raw_rows(("GBP", 0.72, 5, 1, "b"), ("GBP", 0.79, 5, 0, "a"), ("GBP", 0.78, 4, 9, "c")))
    assert rows(fx.dedup_rates(raw), "rate_date", "rate") == [(D(2024, 1, 4), 0.78), (D(2024, 1, 5), 0.72)]
    prior = {r.load_id: r.prior_rate for r in fx.with_prior_rate(raw).collect()}
    assert prior == {"c": None, "a": 0.78, "b": 0.79}


def test_latest_rate_is_the_last_valid_one_not_the_highest(frame):
    valid = fx.process_fx(
        frame(RAW, *raw_rows(("EUR", 1.02, 1, 0, "a"), ("EUR", 1.00, 2, 0, "b"), ("EUR", 2.0, 3, 0, "c"))), "2024-01"
    )
    assert rows(fx.latest_rates(valid, "2024-01")) == [("EUR", 1.00)]
    assert rows(fx.latest_rates(valid, "2023-12")) == []


def test_rates_without_their_order_are_an_error(frame):
    stored = frame(
        "currency string, rate double, rate_date date, is_validated boolean, closure_period string",
        ("EUR", 0.9, D(2024, 1, 1), True, "2024-01"),
    )
    with pytest.raises(ValueError, match="load_id"):
        fx.latest_rates(stored, "2024-01")
    assert rows(fx.latest_rates(stored, "2024-01", ("rate_date",))) == [("EUR", 0.9)]


def test_latest_rate_is_the_same_after_storing(frame, spark, tmp_path):
    raw = frame(RAW, *raw_rows(("EUR", 0.92, 1, 0, "a"), ("EUR", 0.90, 1, 1, "b"), ("GBP", 0.8, 1, 0, "c")))
    checked = fx.process_fx(raw, "2024-01")
    tables.replace_periods(tables.stamp(checked, "exchange_rates", "2024-02-01 00:00:00"), str(tmp_path), "exchange_rates")
    stored = tables.read_table(spark, str(tmp_path), "exchange_rates")
    assert rows(fx.latest_rates(stored, "2024-01")) == rows(fx.latest_rates(checked, "2024-01")) == [("EUR", 0.90), ("GBP", 0.8)]


def test_conversion(frame):
    rates = frame("currency string, exchange_rate double", ("EUR", 0.5), ("GBP", 0.0))
    lines = frame(
        "currency string, amount double",
        ("USD", 10.0), ("EUR", 10.0), ("GBP", 10.0), ("JPY", 10.0), (None, 10.0), ("EUR", None),
    )
    got = fx.to_usd(lines, "amount", "currency", rates)
    assert rows(got, "currency", "usd_amount") == sorted(
        [("USD", 10.0), ("EUR", 20.0), ("GBP", None), ("JPY", None), (None, None), ("EUR", None)], key=repr
    )
    assert rows(fx.missing_fx(got), "currency") == [("JPY",)]


def test_monthly_rates(frame):
    daily = frame(
        "currency string, forecast_date date, forecast_rate double",
        ("EUR", D(2024, 2, 1), 0.8), ("EUR", D(2024, 2, 20), 1.0), ("SGD", D(2024, 2, 1), 2.0),
        ("XXX", D(2024, 2, 1), 1e-11), ("XXX", D(2024, 2, 2), 3e-11),
    )
    monthly = fx.monthly_rates(daily)
    assert rows(monthly) == [("EUR", "2024-02", 0.9), ("SGD", "2024-02", 2.0), ("XXX", "2024-02", 2e-11)]
    lines = frame(
        "currency string, forecast_period string, amount double",
        ("EUR", "2024-02", 9.0), ("EUR", "2024-03", 9.0), ("USD", "2024-03", 9.0),
    )
    expected = [("EUR", "2024-02", 10.0), ("EUR", "2024-03", None), ("USD", "2024-03", 9.0)]
    assert rows(fx.to_usd_monthly(lines, "amount", monthly), "currency", "forecast_period", "usd_amount") == expected


def test_recent_rates(frame):
    df = frame(
        "currency string, rate_date date, rate double, variance_from_prior double, is_validated boolean, validation_notes string",
        ("EUR", D(2024, 1, 24), 1.0, 0.0, True, None), ("EUR", D(2024, 1, 23), 1.0, 0.0, True, None),
    )
    assert rows(fx.recent_rates(df, "2024-01-31"), "rate_date") == [(D(2024, 1, 24),)]


def test_outliers_are_strictly_beyond_the_threshold(frame):
    df = frame("variance_from_prior double", (5.0,), (5.1,), (-5.1,), (None,))
    assert fx.fx_outliers(df).agg(F.count("*")).collect()[0][0] == 2


def test_standard_deviation_of_rates_is_not_rounded(frame):
    """Rates that differ from the ninth digit on, against the standard library."""
    rates = [0.0067 + i * 3e-10 for i in range(20)]
    raw = frame("currency string, rate double, rate_date date", *[("JPY", r, dt.date(2024, 1, 1)) for r in rates], ("EUR", 1.1, None))
    found = {r.currency: r.stddev_rate for r in metrics.raw_fx_stats(raw).collect()}
    assert found["JPY"] == pytest.approx(statistics.stdev(rates), rel=1e-6)
    assert found["EUR"] is None
