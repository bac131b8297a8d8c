import datetime as dt

import pytest
from conftest import rows

from closeworks.operators import metrics, tasklog
from closeworks.plans import views

JAN, FEB = "2024-01", "2024-02"
T = dt.datetime
FINAL = (
    "closure_period string, bu_code string, bu_name string, region string, account_code string, account_description string, "
    "account_category string, segment_product string, segment_geography string, segment_customer string, "
    "segment_channel string, final_amount double, forecast_amount double, forecast_variance double, "
    "prior_period_amount double, yoy_variance double, yoy_variance_percent double, is_final boolean"
)


def final_row(period, bu, account, category, amount, forecast=None, prior=0.0, is_final=True, product="P"):
    yoy = amount - prior if prior else 0.0
    share = yoy / abs(prior) * 100 if prior else 0.0
    gap = amount - forecast if forecast is not None else 0.0
    return (
        period, bu, bu, "R", account, "d", category, product, "G", "C", "H",
        amount, forecast, gap, prior, yoy, share, is_final,
    )


@pytest.fixture
def tables(frame):
    return {
        "final_results": frame(
            FINAL,
            final_row(JAN, "NA", "4000", "Revenue", 100.0),
            final_row(FEB, "NA", "4000", "Revenue", 120000.0, 100000.0, 80000.0),
            final_row(FEB, "NA", "5000", "COGS", -30000.0, 0.0, -10000.0),
            final_row(FEB, "NA", "5100", "COGS", 10000.0, product="Q"),
            final_row(FEB, "NA", "6000", "OpEx", -1.0, is_final=False),
            final_row("2024-03", "NA", "4000", "Revenue", 1.0, is_final=False),
        )
    }


def test_newest_period_counts_unpublished_rows_as_the_reports_do(tables):
    """The newest period is taken over all rows; here it holds no final row, so the view is empty."""
    assert views.v_final_segmented(tables).count() == 0


@pytest.fixture
def until_feb(tables):
    return {"final_results": tables["final_results"].filter("closure_period < '2024-03'")}


def test_segmented(until_feb):
    got = views.v_final_segmented(until_feb)
    assert rows(got, "account_category", "segment_product", "final_amount") == [
        ("COGS", "P", -30000.0), ("COGS", "Q", 10000.0), ("Revenue", "P", 120000.0),
    ]


def test_forecast_against_actual(until_feb):
    got = {r.account_category: r for r in views.v_forecast_vs_actual(until_feb).collect()}
    assert got["Revenue"].variance_percent == 20.0 and got["Revenue"].accuracy_rating == "Significant Variance"
    # A forecast of zero has no percentage: 0, and the last band.
    assert got["COGS"].variance_percent == 0.0 and got["COGS"].accuracy_rating == "Significant Variance"


def test_trends_use_the_absolute_sum(tables):
    got = {(r.closure_period, r.bu_name): r for r in views.v_trends(tables).collect()}
    assert got[FEB, "NA"].cogs == 20000.0 and got[FEB, "NA"].gross_profit == 100000.0
    assert got[FEB, "NA"].period_date == dt.date(2024, 2, 1) and got[FEB, "NA"].opex == 0.0
    assert ("2024-03", "NA") not in got


def test_variance_analysis(until_feb):
    got = views.v_variance_analysis(until_feb).collect()
    assert [(r.account_category, r.variance_amount, r.variance_severity) for r in got] == [
        ("Revenue", 40000.0, "High"), ("COGS", -20000.0, "Extreme"),
    ]


@pytest.mark.parametrize(
    "target, variance, status",
    [
        (100.0, 5.0, "On Target"),
        (100.0, -10.0, "Minor Miss"),
        (100.0, 10.1, "Significant Miss"),
        (0.0, 1.0, "Significant Miss"),
        (None, None, "No Target"),
    ],
)
def test_kpi_status(frame, target, variance, status):
    kpis = frame(
        "closure_period string, metric_name string, metric_category string, metric_value double, target_value double, "
        "variance_from_target double, bu_code string, region string",
        (JAN, "m", "c", 1.005, target, variance, "ALL", "Global"),
    )
    row = views.v_kpi_dashboard({"kpi_metrics": kpis}).collect()[0]
    assert row.performance_status == status and row.business_unit == "Global"


def test_closure_status(frame):
    ddl = (
        "closure_id string, closure_period string, current_phase int, phase_status string, started_at timestamp, "
        "expected_completion timestamp, actual_completion timestamp, notes string"
    )
    status = frame(
        ddl,
        ("a", JAN, 5, "COMPLETED", T(2024, 2, 9), None, T(2024, 2, 9), "n"),
        ("b", FEB, 1, "INITIALIZED", T(2024, 3, 1), T(2024, 3, 8), None, "n"),
        ("c", FEB, 9, "INITIALIZED", T(2024, 3, 2), T(2024, 3, 8), None, "n"),
    )
    row = views.v_closure_status({"closure_status": status}, "2024-03-09").collect()[0]
    assert (row.current_phase, row.phase_name, row.status, row.days_elapsed) == (9, "Unknown", "Overdue", 7)
    row = views.v_closure_status({"closure_status": status}, "2024-03-05").collect()[0]
    assert row.status == "In Progress"
    assert metrics.cycle_status(status, JAN, "2024-03-05").collect()[0].status == "COMPLETED"
    assert metrics.cycle_status(status, FEB, "2024-03-05").collect()[0].phase_name is None
    assert [r.closure_period for r in metrics.recent_periods(status, 1).collect()] == [FEB]
    assert [r.closure_id for r in metrics.newest_statuses(status, 2).collect()] == ["c", "b"]


def test_submissions(frame):
    status = frame("closure_period string", (JAN,), (FEB,))
    rows_of = "closure_period string, bu_code string"
    tables = {
        "closure_status": status,
        "bu_preliminary_close": frame(rows_of, (FEB, "NA"), (FEB, "EMEA"), (JAN, "APAC")),
        "segmented_files": frame(rows_of, (FEB, "NA"), (FEB, "LATAM")),
        "forecast_files": frame(rows_of, (FEB, "NA")),
    }
    got = {r.bu_code: r.overall_status for r in views.v_bu_submission(tables).collect()}
    assert got == {"NA": "Complete", "EMEA": "Partial", "APAC": "Pending", "LATAM": "Pending"}


def test_top_adjustments(frame):
    ddl = (
        "closure_period string, bu_code string, account_code string, adjustment_type string, cut_number int, "
        "usd_amount double, description string, is_validated boolean"
    )
    cuts = frame(
        ddl,
        *[(FEB, "NA", "4000", "t", 1, float(i), f"d{i}", True) for i in range(25)],
        (FEB, "NA", "4000", "t", 1, -99.0, "low", True),
        (FEB, "NA", "4000", "t", 1, 500.0, "invalid", False),
        (JAN, "NA", "4000", "t", 1, 900.0, "old", True),
    )
    got = views.v_top_adjustments({"accounting_cuts": cuts}).collect()
    assert len(got) == 20 and (got[0].description, got[0].adjustment_amount, got[0].signed_amount) == ("low", 99.0, -99.0)


def test_rate_levels(frame):
    rates = frame(
        "currency string, rate_date date, rate double, variance_from_prior double, is_validated boolean, "
        "validation_notes string, source string, closure_period string",
        *[("EUR", dt.date(2024, 1, 10), 1.0, v, True, None, "s", JAN) for v in (5.1, -5.0, 2.0, None)],
        ("EUR", dt.date(2023, 12, 1), 1.0, 9.0, True, None, "s", JAN),
    )
    got = views.v_fx_monitor({"exchange_rates": rates}, "2024-01-31")
    assert rows(got, "variance_from_prior", "variance_level") == sorted(
        [(5.1, "High Variance"), (-5.0, "Medium Variance"), (2.0, "Normal"), (None, "Normal")], key=repr
    )


def test_all_views_can_be_registered(spark):
    from closeworks import schemas

    empty = {name: spark.createDataFrame([], schemas.schema(name)) for name in schemas.LAYER}
    views.register_all(empty, "2024-01-31")
    for name in views.ALL_VIEWS:
        expected = 4 if name == "v_bu_submission" else 0
        assert spark.table(name).count() == expected


# --- task log -------------------------------------------------------------------

LOG = (
    "log_id string, agent_id string, agent_name string, closure_period string, phase int, task_name string, status string, "
    "started_at timestamp, duration_seconds double, records_processed bigint, error_message string"
)


@pytest.fixture
def log(frame):
    return frame(
        LOG,
        ("1", "a", "A", JAN, 1, "t", "COMPLETED", T(2024, 1, 1, 1), 60.0, 10, None),
        ("2", "a", "A", JAN, 1, "t", "FAILED", T(2024, 1, 1, 2), 100000.0, 0, "boom"),
        ("3", "a", "A", JAN, 0, "t", "RUNNING", T(2024, 1, 1, 3), None, 5, None),
        ("4", "b", "B", JAN, 2, "t", "COMPLETED", T(2024, 1, 2, 3), 120.0, 5, None),
    )


def test_task_reports(log):
    assert rows(tasklog.task_performance(log), "agent_name", "executions", "success_rate", "max_duration_min") == [
        ("A", 3, 33.33, 1666.67), ("B", 1, 100.0, 2.0),
    ]
    assert rows(tasklog.phase_progress(log), "phase", "phase_name", "completion_pct") == [
        (0, None, 0.0), (1, "Data Gathering - Exchange Rates", 50.0), (2, "Adjustments", 100.0),
    ]
    assert rows(tasklog.failed_tasks(log), "error_message") == [("boom",)]
    assert [r.started_at.hour for r in tasklog.task_timeline(log, n=2).collect()] == [3, 3]
    stats = tasklog.overall_stats(log).collect()[0]
    assert (stats.total_agents, stats.total_tasks, stats.success_rate, stats.health) == (2, 4, 50.0, "Issues Detected")


def test_overall_stats_without_tasks(log):
    stats = tasklog.overall_stats(log, "1999-01").collect()[0]
    assert (stats.total_agents, stats.total_tasks, stats.success_rate) == (0, 0, None)


def test_daily_performance(log):
    got = {r.agent_id: r for r in tasklog.task_daily_performance(log).collect()}
    # The running task of phase 0 has no SLA; of the two others one took longer than a day.
    assert (got["a"].error_rate, got["a"].sla_compliance_rate, got["a"].tasks_failed) == (1 / 3, 0.5, 1)
    assert got["b"].sla_compliance_rate == 1.0 and got["b"].metric_date == dt.date(2024, 1, 2)


def test_activity_icons(log):
    got = views.v_task_activity({"agent_execution_logs": log}).collect()
    assert [(r.status, r.status_icon) for r in got][:2] == [("COMPLETED", "✅"), ("RUNNING", "🔄")]


def test_notifications(frame):
    df = frame(
        "notification_id int, closure_period string, phase int, severity string, message string, recipient string, "
        "sent_at timestamp, acknowledged_at timestamp",
        (1, JAN, 1, "INFO", "m", "r", T(2024, 1, 1), None), (2, JAN, 1, "INFO", "m", "r", T(2024, 1, 2), T(2024, 1, 3)),
    )
    assert [r.status for r in tasklog.notification_status(df).collect()] == ["Acknowledged", "Pending"]
