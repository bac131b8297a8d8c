import pytest
from conftest import rows

from closeworks.config import DEFAULT_CONFIG
from closeworks.operators import controls, quality

JAN, FEB = "2024-01", "2024-02"
LEDGER = (
    "closure_period string, bu_code string, bu_name string, account_code string, usd_amount double, is_validated boolean"
)
CUTS = "closure_period string, cut_number int, bu_code string, usd_amount double, is_validated boolean"
SEGMENTS = (
    "closure_period string, bu_code string, segment_type string, usd_amount double, is_validated boolean"
)
FORECASTS = "closure_period string, bu_code string, forecast_period string, is_validated boolean"


@pytest.fixture
def ledger(frame):
    return frame(
        LEDGER,
        (JAN, "NA", "North America", "4000", 100.0, True),
        (JAN, "NA", "North America", "5000", -500.0, True),
        (JAN, "EMEA", "Europe, Middle East, Africa", "4000", 50.0, True),
        (JAN, "APAC", "Asia Pacific", "4000", 50.0, False),
        (FEB, "APAC", "Asia Pacific", "4000", 50.0, True),
        (None, "LATAM", "Latin America", "4000", 50.0, False),
    )


@pytest.fixture
def segments(frame):
    return frame(
        SEGMENTS,
        *[(JAN, "NA", t, -88.0, True) for t in DEFAULT_CONFIG.segment_types],
        (JAN, "EMEA", "Product", 0.5, True),
        (JAN, "EMEA", "Product", 0.5, True),
        (JAN, "EMEA", "Unknown", 0.5, False),
    )


@pytest.fixture
def forecasts(frame):
    return frame(
        FORECASTS, (JAN, "NA", "2024-02", True), (JAN, "NA", "2024-03", True), (JAN, "NA", "2024-03", True),
        (JAN, "EMEA", "2024-02", False),
    )


def test_missing_units(ledger, forecasts):
    assert rows(controls.bu_missing(ledger), "closure_period", "bu_code") == [
        (JAN, "APAC"), (JAN, "LATAM"), (FEB, "EMEA"), (FEB, "LATAM"), (FEB, "NA"),
    ]
    # Periods of the ledger, submissions of the forecasts: February has none at all.
    missing = rows(controls.bu_missing(forecasts, ledger), "closure_period", "bu_code")
    assert len([m for m in missing if m[0] == FEB]) == 4
    assert [m[1] for m in missing if m[0] == JAN] == ["APAC", "EMEA", "LATAM"]


def test_coverage(segments, forecasts):
    found = {r.bu_code: r for r in controls.segment_coverage(segments).collect()}
    assert found["NA"].segments_present == 4 and found["NA"].segments_missing == []
    assert found["EMEA"].segment_types == ["Product"]
    assert found["EMEA"].segments_missing == ["Channel", "Customer", "Geography"]
    assert rows(controls.forecast_coverage(forecasts)) == [(JAN, "NA", 2, 3)]


def test_cuts(frame):
    cuts = frame(
        CUTS,
        (JAN, 1, "NA", 100000.0, True),
        (JAN, 1, "NA", -100000.01, True),
        (JAN, 2, "NA", 100001.0, False),
        (FEB, 1, "NA", 1.0, True),
        (FEB, 2, "NA", 200000.0, True),
        ("2024-03", 2, "NA", 1.0, True),
    )
    assert rows(controls.cut_completeness(cuts), "closure_period", "cut_status") == [
        (JAN, "Only 1st cut received"), (FEB, "Both cuts received"), ("2024-03", "No cuts received"),
    ]
    assert rows(controls.large_adjustments(cuts)) == [(JAN, 1), (FEB, 1), ("2024-03", 0)]


def test_reconciliation_uses_the_absolute_total(ledger, segments):
    """The ledger total is negative here (-350): a signed share would always pass."""
    found = {r.closure_period: r for r in controls.recon_prelim_segment(ledger, segments).collect()}
    assert (found[JAN].total_prelim, found[JAN].total_segment, found[JAN].result) == (-350.0, -351.0, "PASS")
    assert found[FEB].total_segment is None and found[FEB].result == "FAIL"
    off = segments.withColumn("usd_amount", segments.usd_amount * 2)
    assert controls.recon_prelim_segment(ledger, off, JAN).collect()[0].result == "FAIL"


def test_review_summary_does_not_multiply_amounts(ledger, segments, forecasts):
    found = {r.bu_code: r for r in controls.review_summary(ledger, segments, forecasts, JAN).collect()}
    assert found["NA"].preliminary_total == -400.0
    assert (found["NA"].accounts, found["NA"].segments_present, found["NA"].forecast_periods) == (2, 4, 2)
    assert (found["EMEA"].segments_present, found["EMEA"].forecast_periods) == (2, 1)


def test_dataset_completeness(frame, ledger, segments, forecasts):
    cuts = frame(CUTS, (JAN, 1, "NA", 1.0, True), (JAN, 2, "NA", 1.0, True), (JAN, 3, "NA", 1.0, False))
    found = {(r.closure_period, r.dataset): r for r in controls.dataset_completeness(ledger, cuts, segments, forecasts).collect()}
    assert found[JAN, "Accounting Cuts"].passed and found[JAN, "Preliminary Close"].actual == 2
    assert not found[FEB, "Accounting Cuts"].passed and found[FEB, "Accounting Cuts"].actual == 0


def test_alerts(frame, ledger, segments, forecasts):
    rates = frame(
        "closure_period string, variance_from_prior double, is_validated boolean", (JAN, 9.0, False), (JAN, 1.0, True)
    )
    summary = frame(
        "closure_period string, total_revenue double, gross_margin_pct double, operating_margin_pct double",
        (JAN, 1234567.891, 12.5, 7.0),
    )
    found = controls.alerts(rates, ledger, segments, forecasts, summary).collect()
    text = {(r.closure_period, r.phase, r.message): r.recipient for r in found}
    assert text[JAN, 1, "Found 1 exchange rates exceeding variance threshold"] == "finance.ops@company.com"
    assert text[JAN, 1, "Preliminary close file missing from Latin America"] == "latam.finance@company.com"
    assert text[JAN, 3, "Incomplete segment data from Europe, Middle East, Africa"] == "emea.finance@company.com"
    assert text[JAN, 3, "Missing forecast data from Asia Pacific"] == "apac.finance@company.com"
    done = [r for r in found if r.phase == 5]
    assert len(done) == 1 and done[0].severity == "INFO" and "$1,234,567.89" in done[0].message
    assert not [r for r in found if "exceeding" in r.message and r.closure_period != JAN]


def test_signoffs(frame, ledger):
    cuts = frame(CUTS, (JAN, 1, "NA", 200000.0, True), (FEB, 1, "NA", 2.0, True))
    found = rows(controls.signoff_requests(ledger, cuts), "closure_period", "approval_type", "required_approver")
    assert len(found) == 2 * (3 + 4) + 1
    assert (JAN, "LARGE_ADJUSTMENT_REVIEW", "Controller") in found
    assert (FEB, "BU_SIGNOFF", "Asia Pacific CFO") in found


def test_approve_pending(frame):
    approvals = frame(
        "approval_id int, closure_period string, approval_type string, status string, approved_at timestamp, comments string",
        (1, JAN, "BU_SIGNOFF", "PENDING", None, "c"),
        (2, JAN, "OTHER", "PENDING", None, "c"),
        (3, FEB, "BU_SIGNOFF", "PENDING", None, "c"),
        (4, JAN, "BU_SIGNOFF", None, None, "c"),
    )
    found = {r.approval_id: r for r in controls.approve_pending(approvals, "2024-02-05 10:00:00", JAN).collect()}
    assert found[1].status == "APPROVED" and found[1].comments == "c - Auto-approved for demo"
    assert found[1].approved_at is not None
    assert [found[i].status for i in (2, 3, 4)] == ["PENDING", "PENDING", None]
    assert [found[i].approved_at for i in (2, 3, 4)] == [None] * 3


# --- quality ------------------------------------------------------------------


@pytest.mark.parametrize("failed, result", [(0, "PASSED"), (1, "PASSED"), (2, "WARNING"), (4, "WARNING"), (5, "FAILED")])
def test_scorecard_bands(spark, failed, result):
    df = spark.range(100).selectExpr(f"id >= {failed} AS is_validated", f"'{JAN}' AS closure_period")
    row = quality.scorecard(df, quality.SCORECARDS["accounting_cuts"]).collect()[0]
    assert (row.check_result, row.records_failed) == (result, failed)
    assert row.details == f"Processed accounting cuts with {failed}.00% failure rate"


def test_fx_scorecard_has_wider_bands(spark):
    df = spark.range(100).selectExpr("id >= 4 AS is_validated", f"'{JAN}' AS closure_period")
    assert quality.scorecard(df, quality.SCORECARDS["exchange_rates"]).collect()[0].check_result == "PASSED"


def test_rules(frame):
    ledger = frame(
        "period string, bu_code string, account_code string, local_amount double",
        (JAN, "NA", "4000", 5.0), (JAN, "NA", "5000", -5.0), (JAN, "EMEA", None, 1.0), (JAN, "X", "4000", None),
    )
    found = {(r.rule, r.column_name): (r.checked, r.failed) for r in quality.dq_rules_ledger(ledger).collect()}
    assert found["no_nulls", "account_code"] == (4, 1)
    assert found["valid_bu", "bu_code"] == (4, 1)
    assert found["balance_check", "local_amount"] == (3, 1)


def test_segment_rule(frame):
    types = DEFAULT_CONFIG.segment_types
    df = frame(
        "bu_code string, account_code string, segment_type string, amount double",
        *[("NA", "1", t, 1.0) for t in types],
        *[("NA", "2", t, 1.0) for t in types[:3]],
        ("NA", "2", "Unknown", 1.0),
        ("NA", "3", None, 1.0),
    )
    found = {r.rule: (r.checked, r.failed) for r in quality.dq_rules_segments(df).collect() if r.rule != "no_nulls"}
    assert found["segment_completeness"] == (3, 2)


def test_reconciliation_rule(frame):
    cuts = frame(
        "cut_number int, account_code string, adjustment_amount double, closure_period string, bu_code string, usd_amount double",
        (1, "4000", 1.0, JAN, "NA", 1.0), (1, "4000", 1.0, JAN, "EMEA", 1.1), (4, "4000", 1.0, FEB, "NA", 1.0),
    )
    ledger = frame("closure_period string, bu_code string, usd_amount double", (JAN, "NA", -100.0), (JAN, "EMEA", 100.0))
    found = {r.rule: (r.checked, r.failed) for r in quality.dq_rules_cuts(cuts, ledger).collect() if r.rule != "no_nulls"}
    assert found == {"valid_cut_number": (3, 1), "reconciliation": (3, 2)}


def test_null_profile_and_domain(frame):
    df = frame("a string, b int", ("x", 1), (None, None), ("y", None))
    assert rows(quality.null_profile(df, ["a", "b"])) == [("a", 3, 1), ("b", 3, 2)]
    assert rows(quality.domain_violations(df, "a", ["x"])) == [("y", 1)]
    assert quality.non_positive(frame("r double", (0.0,), (-1.0,), (None,), (2.0,)), "r").count() == 2
    assert rows(quality.preview(df, 1, "b", "a")) == [(None, None)]


def test_reports_on_checks(frame):
    dq = frame(
        "closure_period string, phase int, table_name string, check_name string, check_result string, "
        "records_checked bigint, records_failed bigint, failure_rate double, details string",
        (JAN, 1, "t", "c", "FAILED", 8, 1, 0.125, "d"),
        (JAN, 1, "u", "c", "PASSED", 8, 0, 0.0, "d"),
        (JAN, 3, "v", "c", "WARNING", 100, 3, 0.03, "d"),
    )
    assert {r.critical_failures for r in quality.dq_summary(dq, JAN, 1).collect()} == {1}
    assert [r.table_name for r in quality.dq_issues(dq).collect()] == ["t", "v"]
    assert [r.failure_rate_pct for r in quality.dq_dashboard(dq).collect()] == [12.5, 0.0, 3.0]
