import pytest
from conftest import rows

from closeworks.config import DEFAULT_CONFIG
from closeworks.operators import metrics, publish

LEDGER = (
    "closure_period string, bu_code string, bu_name string, account_code string, account_description string, "
    "local_currency string, usd_amount double, is_validated boolean"
)
CUTS = "closure_period string, bu_code string, account_code string, usd_amount double, is_validated boolean"
SEGMENTS = (
    "closure_period string, bu_code string, account_code string, segment_type string, segment_value string, "
    "is_validated boolean"
)
FORECASTS = "forecast_period string, bu_code string, account_code string, usd_amount double, is_validated boolean"
DEC, JAN, FEB = "2023-12", "2024-01", "2024-02"


@pytest.fixture
def ledger(frame):
    return frame(
        LEDGER,
        (DEC, "NA", "North America", "4000", "Sales", "USD", 100.0, True),
        (JAN, "NA", "North America", "4000", "Sales", "USD", 100.0, True),
        (JAN, "NA", "North America", "4000", "Sales", "EUR", 50.0, True),
        (JAN, "NA", "North America", "4000", "Resale", "USD", 7.0, True),
        (JAN, "NA", "North America", "4000", "Sales", "USD", 999.0, False),
        (JAN, "NA", "North America", "5000", "Cost", "USD", -60.0, True),
        (JAN, "EMEA", "Europe, Middle East, Africa", "4000", "Sales", "EUR", 0.0, True),
        (FEB, "NA", "North America", "4000", "Sales", "USD", 300.0, True),
        (FEB, "EMEA", "Europe, Middle East, Africa", "4000", "Sales", "EUR", 5.0, True),
        (FEB, "NA", "North America", "6000", "Rent", "USD", -20.0, True),
    )


@pytest.fixture
def cuts(frame):
    return frame(
        CUTS,
        (JAN, "NA", "4000", 10.0, True),
        (JAN, "NA", "4000", -4.0, True),
        (JAN, "NA", "4000", 500.0, False),
        (JAN, "APAC", "4000", 9.0, True),
    )


@pytest.fixture
def segments(frame):
    return frame(
        SEGMENTS,
        (JAN, "NA", "4000", "Product", "Software", True),
        (JAN, "NA", "4000", "Product", "Hardware", True),
        (JAN, "NA", "4000", "Channel", "Online", True),
        (JAN, "NA", "4000", "Customer", "SMB", False),
    )


@pytest.fixture
def forecasts(frame):
    return frame(FORECASTS, (JAN, "NA", "4000", 200.0, True), (JAN, "NA", "4000", 3.0, False))


@pytest.fixture
def final(ledger, cuts, segments, forecasts):
    return publish.final_results(ledger, cuts, segments, forecasts)


def test_preliminary_results(ledger):
    got = publish.preliminary_results(ledger)
    found = {(r.closure_period, r.bu_code, r.account_code, r.account_description): r for r in got.collect()}
    assert len(found) == got.count() == 8
    sales = found[JAN, "NA", "4000", "Sales"]
    assert (sales.preliminary_amount, sales.currency, sales.account_category) == (150.0, "EUR", "Revenue")
    # January compares with December of the year before.
    assert (sales.prior_period_amount, sales.variance_amount, sales.variance_percent) == (100.0, 50.0, 50.0)
    # Two descriptions in one account: the larger amount of the prior period counts.
    assert found[FEB, "NA", "4000", "Sales"].prior_period_amount == 150.0
    # No prior period, and a prior amount of zero.
    first = found[DEC, "NA", "4000", "Sales"]
    assert (first.prior_period_amount, first.variance_amount, first.variance_percent) == (0.0, 0.0, 0.0)
    zero = found[FEB, "EMEA", "4000", "Sales"]
    assert (zero.prior_period_amount, zero.variance_amount, zero.variance_percent) == (0.0, 5.0, 0.0)
    assert {r.version for r in found.values()} == {1}


def test_one_month_against_published_results_equals_the_history(ledger):
    history = publish.preliminary_results(ledger)
    published = history.filter(f"closure_period < '{FEB}'")
    month = publish.preliminary_results(ledger, FEB, published)
    assert rows(month) == rows(history.filter(f"closure_period = '{FEB}'"))


def test_versions(frame, ledger):
    published = publish.preliminary_results(ledger.filter(f"closure_period = '{JAN}' AND account_code = '4000'"))
    again = publish.preliminary_results(ledger, JAN, published)
    assert {r.version for r in again.collect()} == {2}
    both = published.unionByName(again)
    assert {r.version for r in publish.latest_version(both).collect()} == {2}
    assert rows(publish.next_version(frame("closure_period string", (JAN,), (FEB,)), both)) == [(JAN, 3), (FEB, 1)]
    # The prior amount comes from the latest version only: the account sums differ between versions here.
    wrong = again.withColumn("preliminary_amount", again.preliminary_amount + 1000).withColumn("version", again.version - 1)
    later = publish.preliminary_results(ledger, FEB, again.unionByName(wrong))
    assert {r.prior_period_amount for r in later.filter("bu_code = 'NA' AND account_code = '4000'").collect()} == {150.0}


def test_no_row_is_gained_or_lost_by_the_joins(ledger, final):
    groups = ledger.filter("is_validated").select("closure_period", "bu_code", "account_code").distinct()
    assert final.count() == groups.count()


def test_final_results(final):
    found = {(r.closure_period, r.bu_code, r.account_code): r for r in final.collect()}
    row = found[JAN, "NA", "4000"]
    assert (row.preliminary_amount, row.adjustments_amount, row.final_amount) == (157.0, 6.0, 163.0)
    assert row.account_description == "Resale" and row.region == "Americas"
    assert (row.segment_product, row.segment_geography) == ("Hardware", "Unallocated")
    assert (row.segment_customer, row.segment_channel) == ("Unallocated", "Online")
    assert (row.forecast_amount, row.forecast_variance) == (200.0, -37.0)
    assert (row.prior_period_amount, row.yoy_variance, row.yoy_variance_percent) == (100.0, 63.0, 63.0)
    # Without a forecast the amount stays NULL and the variance is 0.
    other = found[JAN, "NA", "5000"]
    assert other.forecast_amount is None and other.forecast_variance == 0.0 and other.adjustments_amount == 0.0
    assert found[FEB, "NA", "4000"].prior_period_amount == 163.0
    assert all(r.final_amount == r.preliminary_amount + r.adjustments_amount for r in found.values())


def test_a_gap_in_the_history_is_no_prior_period(ledger, cuts, segments, forecasts):
    gap = ledger.filter(f"closure_period <> '{JAN}'")
    got = publish.final_results(gap, cuts, segments, forecasts)
    assert {r.prior_period_amount for r in got.collect()} == {0.0}
    two_back = publish.final_results(gap, cuts, segments, forecasts, months_back=2)
    row = two_back.filter(f"closure_period = '{FEB}' AND account_code = '4000' AND bu_code = 'NA'").collect()[0]
    assert row.prior_period_amount == 100.0


def test_one_month_of_final_results_against_the_published_ones(ledger, cuts, segments, forecasts, final):
    published = final.filter(f"closure_period < '{FEB}'")
    month = publish.final_results(ledger, cuts, segments, forecasts, FEB, published)
    assert rows(month) == rows(final.filter(f"closure_period = '{FEB}'"))


def test_kpis(frame, final):
    targets = frame("metric_name string, bu_code string, target_value double", ("Total Revenue", "ALL", 200.0))
    kpis = publish.kpi_metrics(final, JAN, targets)
    found = {(r.metric_name, r.bu_code): r for r in kpis.collect()}
    assert len(found) == 3 + len(DEFAULT_CONFIG.business_units)
    assert found["Total Revenue", "ALL"].metric_value == 163.0
    assert found["Total Revenue", "ALL"].variance_from_target == -37.0
    assert found["Gross Margin %", "ALL"].metric_value == (163.0 - 60.0) / 163.0 * 100
    assert found["Revenue", "LATAM"].metric_value == 0.0 and found["Revenue", "LATAM"].target_value is None
    assert [r.scope for r in publish.kpi_listing(kpis).limit(3).collect()] == ["Global"] * 3


def test_summaries_add_up(final):
    by_bu = publish.final_by_bu(final)
    assert sum(r.final_amount for r in by_bu.collect()) == sum(r.final_amount for r in final.collect())
    statement = metrics.financial_summary(final, JAN).collect()[0]
    assert (statement.total_revenue, statement.total_cogs, statement.gross_profit) == (163.0, 60.0, 103.0)
    no_revenue = metrics.exec_summary(final.filter("account_category = 'COGS'"), JAN).collect()[0]
    assert no_revenue.gross_margin_pct == 0.0
    assert metrics.financial_summary(final.filter("account_category = 'COGS'"), JAN).collect()[0].gross_margin_pct is None


def test_margins_differ_when_signs_mix(frame):
    """Metrics add absolute costs, KPIs take the absolute value of the sum."""
    results = frame(
        "closure_period string, bu_code string, account_category string, final_amount double, is_final boolean",
        (JAN, "NA", "Revenue", 100.0, True), (JAN, "NA", "COGS", -30.0, True), (JAN, "NA", "COGS", 10.0, True),
    )
    assert metrics.financial_summary(results).collect()[0].total_cogs == 40.0
    margin = publish.kpi_metrics(results).filter("metric_name = 'Gross Margin %'").collect()[0].metric_value
    assert margin == 80.0


def test_top_variances_needs_material_changes_and_breaks_ties(frame):
    ddl = (
        "closure_period string, bu_code string, bu_name string, account_code string, account_description string, "
        "account_category string, preliminary_amount double, prior_period_amount double, variance_amount double, "
        "variance_percent double, version int"
    )
    data = [(JAN, f"B{i:02d}", "n", "4000", "d", "Revenue", 0.0, 0.0, 20000.0, 0.0, 1) for i in range(30)]
    data.append((JAN, "B99", "n", "4000", "d", "Revenue", 0.0, 0.0, 10000.0, 0.0, 1))
    data.append((JAN, "B98", "top", "4000", "d", "Revenue", 0.0, 0.0, -30000.0, 0.0, 1))
    got = publish.top_variances(frame(ddl, *data), JAN).collect()
    assert len(got) == 20 and got[0].bu_name == "top"


@pytest.mark.parametrize("share, rating", [(4.9, "Excellent"), (-10.0, "Good"), (15.0, "Fair"), (15.1, "Poor")])
def test_accuracy_bands(frame, share, rating):
    results = frame(
        "closure_period string, bu_name string, account_category string, final_amount double, forecast_amount double, "
        "forecast_variance double, is_final boolean",
        (JAN, "n", "Revenue", 100.0 + share, 100.0, share, True),
    )
    assert metrics.forecast_accuracy(results).collect()[0].accuracy_rating == rating
