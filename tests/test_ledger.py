import pytest
from conftest import rows
from pyspark.sql import functions as F

from closeworks.operators import ledger

LEDGER = (
    "bu_code string, account_code string, account_description string, local_currency string, local_amount double, "
    "period string, cost_center string"
)
CUTS = (
    "cut_number int, bu_code string, account_code string, adjustment_type string, adjustment_amount double, "
    "currency string, description string, period string"
)
SEGMENTS = (
    "bu_code string, account_code string, segment_type string, segment_value string, amount double, currency string, "
    "period string"
)
FORECASTS = (
    "bu_code string, account_code string, forecast_period string, forecast_amount double, currency string, "
    "forecast_type string, version string"
)
P = "2024-01"


@pytest.fixture
def rates(frame):
    return frame("currency string, exchange_rate double", ("EUR", 0.5), ("SGD", 2.0))


@pytest.fixture
def lines(frame):
    return frame(
        LEDGER,
        ("NA", "4000", "Sales", "USD", 10.0, P, "c"),
        ("EMEA", "5000", None, "EUR", -10.0, P, "c"),
        ("INVALID", "9999", None, "EUR", 1.0, P, "c"),
        (None, None, None, "BRL", None, None, None),
        ("LATAM", "4000", "Sales", "BRL", 1.0, P, "c"),
        ("NA", "4000", "Sales", None, 1.0, P, "c"),
    )


def test_ledger_rules(lines, rates):
    got = ledger.process_ledger(lines, rates)
    issues = {(r.bu_code, r.local_currency): (r.is_validated, r.validation_issues) for r in got.collect()}
    assert issues == {
        ("NA", "USD"): (True, []),
        ("EMEA", "EUR"): (True, []),
        ("INVALID", "EUR"): (False, ["Invalid BU code"]),
        (None, "BRL"): (
            False,
            ["Missing BU code", "Missing account code", "Missing amount", "Missing FX rate", "Missing period"],
        ),
        ("LATAM", "BRL"): (False, ["Missing FX rate"]),
        # Three-valued logic: an unknown currency is neither base currency nor missing a rate.
        ("NA", None): (True, []),
    }
    assert {(r.bu_code, r.usd_amount) for r in got.collect()} >= {("NA", 10.0), ("EMEA", -20.0), ("LATAM", None)}


def test_valid_means_no_issue_and_no_row_is_lost(lines, rates):
    got = ledger.process_ledger(lines, rates)
    assert got.count() == lines.count()
    assert got.filter(F.col("is_validated") != (F.size("validation_issues") == 0)).count() == 0


def test_one_period_is_filtered_and_carried(lines, rates):
    assert {r.closure_period for r in ledger.process_ledger(lines, rates, P).collect()} == {P}
    assert ledger.process_ledger(lines, rates, "2023-12").count() == 0


def test_cuts(frame, rates):
    got = ledger.process_cuts(
        frame(
            CUTS,
            (1, "NA", "4000", "a", 5.0, "USD", "d", P),
            (3, "NA", "4000", "a", 5.0, "USD", "d", P),
            (None, "NA", "4000", "a", 5.0, "USD", "d", P),
            (2, "NOPE", "4000", "a", 5.0, "USD", "d", P),
            (2, "EMEA", None, "a", 5.0, "EUR", "d", P),
            (2, "EMEA", "4000", "a", None, "EUR", "d", P),
            (2, "EMEA", "4000", "a", 5.0, "JPY", "d", P),
            (2, "EMEA", "4000", "a", 5.0, "EUR", "d", P),
        ),
        rates,
        approved_at="2024-02-03 00:00:00",
    )
    assert [r.is_validated for r in got.collect()] == [True, False, False, False, False, False, False, True]
    assert [(r.approved_by is None) == (not r.is_validated) for r in got.collect()] == [True] * 8
    assert [(r.approved_at is None) == (not r.is_validated) for r in got.collect()] == [True] * 8


def test_segments(frame, rates):
    raw = frame(
        SEGMENTS,
        ("NA", "4000", "Product", "Hardware", 4.0, "USD", P),
        ("NA", "4000", "Product", "Software", 4.0, "USD", P),
        ("NA", "4000", "Geography", "North", 4.0, "USD", P),
        ("NA", "4000", "Unknown", "x", 4.0, "USD", P),
        ("NA", "4000", "Customer", None, 4.0, "USD", P),
        ("EMEA", "4000", "Product", "a", 4.0, "EUR", P),
        ("EMEA", "4000", "Geography", "b", 4.0, "EUR", P),
        ("EMEA", "4000", "Customer", "c", 4.0, "EUR", P),
        ("EMEA", "4000", "Channel", "d", 4.0, "EUR", P),
    )
    done = ledger.process_segments(raw, rates)
    assert [r.is_validated for r in done.collect()] == [True, True, True, False, False, True, True, True, True]
    pivot = rows(ledger.segment_pivot(done))
    assert pivot == [
        (P, "EMEA", "4000", "a", "b", "c", "d"),
        (P, "NA", "4000", "Hardware", "North", None, None),
    ]
    complete = {r.bu_code: r for r in ledger.segment_completeness(raw).collect()}
    assert complete["EMEA"].is_complete and complete["EMEA"].segments_missing == []
    # Complete counts types, whichever they are; the missing list says which required one lacks.
    assert complete["NA"].is_complete and complete["NA"].segments_missing == ["Channel"]
    assert complete["NA"].segments_present == ["Customer", "Geography", "Product", "Unknown"]


@pytest.fixture
def forecasts(frame):
    return frame(
        FORECASTS,
        ("NA", "4000", "2023-12", 10.0, "USD", "R", "v1.0"),
        ("NA", "4000", "2024-01", 10.0, "USD", "R", "v1.0"),
        ("NA", "4000", "2024-02", 100.0, "USD", "R", "v1.0"),
        ("NA", "4000", "2024-02", 50.0, "USD", "R", "v2.0"),
        ("NA", "4000", "2024-02", 60.0, "USD", "R", "v2.0"),
        ("NA", "4000", None, 10.0, "USD", "R", "v1.0"),
        ("EMEA", "4000", "2024-02", 10.0, "EUR", "R", "v1.0"),
        ("EMEA", "4000", "2024-03", 10.0, "EUR", "R", "v1.0"),
    )


def test_forecasts_of_one_close(frame, forecasts):
    monthly = frame("currency string, forecast_month string, forecast_rate double", ("EUR", "2024-02", 0.5))
    got = ledger.process_forecasts(forecasts, monthly, P)
    assert [r.is_validated for r in got.collect()] == [False, True, True, True, True, False, True, False]
    assert {r.closure_period for r in got.collect()} == {P}
    assert {r.variance_from_prior for r in got.collect()} == {0.0}
    assert rows(ledger.past_forecasts(forecasts, P), "forecast_period") == [("2023-12",)]
    own = ledger.process_forecasts(forecasts, monthly)
    assert [r.is_validated for r in own.collect()] == [True, True, True, True, True, False, True, False]
    assert [r.closure_period for r in own.collect()] == [r.forecast_period for r in own.collect()]


def test_forecast_versions(frame, forecasts):
    got = ledger.forecast_version_variance(forecasts).filter("bu_code = 'NA' AND forecast_period = '2024-02'")
    assert rows(got, "version", "version_amount", "variance_from_prior") == [
        ("v1.0", 100.0, 0.0),
        ("v2.0", 110.0, 10.0),
    ]
    monthly = frame("currency string, forecast_month string, forecast_rate double", ("EUR", "2024-02", 0.5))
    lines = ledger.process_forecasts(forecasts, monthly, P, version_variance=True)
    assert lines.count() == forecasts.count()
    assert [r.variance_from_prior for r in lines.filter("version = 'v2.0'").collect()] == [10.0, 10.0]
    assert [r.variance_from_prior for r in lines.filter("forecast_period IS NULL").collect()] == [0.0]


def test_bu_lookups(frame):
    got = ledger.bu_currency(frame("bu_code string", ("EMEA",), ("NOPE",), (None,)))
    assert rows(got, "bu_code", "bu_currency", "bu_exists") == sorted(
        [("EMEA", "EUR", True), ("NOPE", "USD", False), (None, "USD", False)], key=repr
    )


def test_versions_follow_their_numbers(frame):
    df = frame(
        "bu_code string, account_code string, forecast_period string, forecast_type string, version string, forecast_amount double",
        *[("B", "4000", "2024-01", "T", v, a) for v, a in (("v10.0", 400.0), ("v9.0", 200.0), ("v2.1", 100.0), ("v1", 50.0))],
    )
    got = {r.version: r.prior_version_amount for r in ledger.forecast_version_variance(df).collect()}
    assert got == {"v1": None, "v2.1": 50.0, "v9.0": 100.0, "v10.0": 200.0}
