"""The twelve dashboard views, as functions from tables to a frame.

``tables`` maps table names (``closeworks.schemas``) to frames. Views of the newest
period find it by a scalar subquery, which Spark runs first and turns into a filter. A frame ``periods``
with the closure periods tells it more cheaply than a result that is still to be computed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closeworks.config import DEFAULT_CONFIG, CloseConfig, bu_dim
from closeworks.functions.exprs import (
    banded,
    category_rank,
    decode,
    newest_period,
    percent_of,
    percent_or_zero,
    period_start,
    phase_name,
    total,
    total_when,
    margin_percent,
)
from closeworks.operators import metrics, publish

Tables = dict[str, DataFrame]

# Icons shown beside plain labels.
RESULT_ICON = {"PASSED": "✅", "WARNING": "⚠️"}
TASK_ICON = {"COMPLETED": "✅", "RUNNING": "🔄", "FAILED": "❌"}


def v_closure_status(tables: Tables, as_of: str) -> DataFrame:
    """Newest status row of the newest period."""
    status = newest_period(tables["closure_status"])
    return (
        status.orderBy(F.desc("started_at"), F.desc("closure_id"))
        .limit(1)
        .select(
            "closure_period",
            "current_phase",
            phase_name("current_phase", "Unknown").alias("phase_name"),
            "phase_status",
            "started_at",
            "expected_completion",
            "actual_completion",
            metrics.cycle_state(as_of, ("Completed", "Overdue", "In Progress")).alias("status"),
            metrics.days_elapsed(as_of).alias("days_elapsed"),
            "notes",
        )
    )


def v_fx_monitor(tables: Tables, as_of: str, days: int = 30) -> DataFrame:
    moved = F.abs("variance_from_prior")
    return (
        tables["exchange_rates"]
        .filter(F.col("rate_date") >= F.date_sub(F.lit(as_of).cast("date"), days))
        .orderBy(F.desc("rate_date"), moved.desc(), "currency")
        .select(
            "currency",
            "rate_date",
            "rate",
            "variance_from_prior",
            "is_validated",
            "validation_notes",
            banded(moved, ((5, "High Variance"), (2, "Medium Variance")), "Normal").alias("variance_level"),
            "source",
            "closure_period",
        )
    )


def v_bu_submission(tables: Tables, as_of: str | None = None, cfg: CloseConfig = DEFAULT_CONFIG) -> DataFrame:
    """Which files each configured unit has delivered for the newest period."""
    status = tables["closure_status"]
    wanted = {"preliminary": "bu_preliminary_close", "segmented": "segmented_files", "forecast": "forecast_files"}
    delivered = None
    for kind, name in wanted.items():
        rows = (
            newest_period(tables[name], status)
            .filter(F.col("bu_code").isin(cfg.bu_codes))
            .select("bu_code", F.lit(kind).alias("_kind"))
            .distinct()
        )
        delivered = rows if delivered is None else delivered.unionByName(rows)
    flags = delivered.groupBy("bu_code").agg(
        *[F.max(F.col("_kind") == kind).alias(f"{kind}_submitted") for kind in wanted]
    )
    units = bu_dim(status.sparkSession, cfg).select("bu_code", "bu_name")
    has = {kind: F.coalesce(f"{kind}_submitted", F.lit(False)) for kind in wanted}
    # Both sides have at most one row per configured unit.
    return (
        units.join(F.broadcast(flags), "bu_code", "left")
        .select(
            "bu_code",
            "bu_name",
            *[c.alias(f"{kind}_submitted") for kind, c in has.items()],
            F.when(has["preliminary"] & has["segmented"] & has["forecast"], "Complete")
            .when(has["preliminary"], "Partial")
            .otherwise("Pending")
            .alias("overall_status"),
        )
        .orderBy("overall_status", "bu_code")
    )


def v_top_adjustments(tables: Tables, as_of: str | None = None, k: int = 20) -> DataFrame:
    """Largest valid adjustments of the newest period. Ties are broken by all shown columns."""
    size = F.abs("usd_amount")
    shown = ["bu_code", "account_code", "adjustment_type", "cut_number", "usd_amount", "description"]
    extra = [c for c in ("approved_by", "approved_at") if c in tables["accounting_cuts"].columns]
    return (
        newest_period(tables["accounting_cuts"])
        .filter(F.col("is_validated"))
        .orderBy(size.desc(), *shown)
        .limit(k)
        .select(
            "bu_code",
            "account_code",
            "adjustment_type",
            "cut_number",
            size.alias("adjustment_amount"),
            F.col("usd_amount").alias("signed_amount"),
            "description",
            *extra,
            "closure_period",
        )
    )


def v_prelim_summary(tables: Tables, as_of: str | None = None) -> DataFrame:
    """Newest period of the preliminary results, latest version, in report order."""
    return (
        publish.latest_version(newest_period(tables["preliminary_results"], tables.get("periods")))
        .groupBy("closure_period", "bu_name", "account_category")
        .agg(
            total("preliminary_amount").alias("total_amount"),
            total("prior_period_amount").alias("prior_period"),
            total("variance_amount").alias("variance"),
            F.count("*").alias("account_count"),
        )
        .withColumn("variance_percent", percent_or_zero(F.col("variance"), F.col("prior_period")))
        .orderBy("bu_name", category_rank(), "account_category")
    )


def _final(tables: Tables) -> DataFrame:
    return tables["final_results"].filter(F.col("is_final"))


def _newest_final(tables: Tables) -> DataFrame:
    results = tables["final_results"]
    return newest_period(results.filter(F.col("is_final")), tables.get("periods", results))


def v_final_segmented(tables: Tables, as_of: str | None = None) -> DataFrame:
    return (
        _newest_final(tables)
        .groupBy(
            "closure_period",
            "bu_name",
            "region",
            "account_category",
            "segment_product",
            "segment_geography",
            "segment_customer",
            "segment_channel",
        )
        .agg(
            total("final_amount").alias("final_amount"),
            total("forecast_amount").alias("forecast_amount"),
            total("forecast_variance").alias("vs_forecast"),
            total("prior_period_amount").alias("prior_year"),
            total("yoy_variance").alias("yoy_variance"),
        )
        .withColumn("yoy_variance_percent", percent_or_zero(F.col("yoy_variance"), F.col("prior_year")))
    )


def v_forecast_vs_actual(tables: Tables, as_of: str | None = None) -> DataFrame:
    bands = ((5, "On Target"), (10, "Minor Variance"))
    return (
        _newest_final(tables)
        .filter(F.col("forecast_amount").isNotNull())
        .groupBy("bu_name", "account_category", "segment_product")
        .agg(*metrics.forecast_sums())
        .select(
            "bu_name",
            "account_category",
            "segment_product",
            F.col("actual").alias("actual_amount"),
            F.col("forecast").alias("forecast_amount"),
            "variance",
            percent_or_zero(F.col("variance"), F.col("forecast")).alias("variance_percent"),
            metrics.forecast_rating(bands, "Significant Variance").alias("accuracy_rating"),
        )
        .orderBy(F.abs("variance").desc(), "bu_name", "account_category", "segment_product")
    )


def _kpi_status() -> Column:
    miss = F.abs(percent_of(F.col("variance_from_target"), F.col("target_value")))
    return F.when(F.col("target_value").isNull(), "No Target").otherwise(
        banded(miss, ((5, "On Target"), (10, "Minor Miss")), "Significant Miss", strict=False)
    )


def v_kpi_dashboard(tables: Tables, as_of: str | None = None) -> DataFrame:
    return (
        newest_period(tables["kpi_metrics"], tables.get("periods"))
        .orderBy(*publish.kpi_order(), "metric_category", "metric_name")
        .select(
            "closure_period",
            "metric_name",
            "metric_category",
            publish.kpi_scope().alias("business_unit"),
            "region",
            F.round("metric_value", 2).alias("metric_value"),
            F.round("target_value", 2).alias("target_value"),
            F.round("variance_from_target", 2).alias("variance_from_target"),
            _kpi_status().alias("performance_status"),
        )
    )


def v_dq_dashboard(tables: Tables, as_of: str | None = None) -> DataFrame:
    dq = tables["data_quality_checks"]
    timed = ["checked_at"] if "checked_at" in dq.columns else []
    return (
        newest_period(dq)
        .orderBy("phase", *[F.desc(c) for c in timed], "table_name")
        .select(
            "closure_period",
            "phase",
            phase_name("phase", "Unknown").alias("phase_name"),
            "table_name",
            "check_name",
            "check_result",
            "records_checked",
            "records_failed",
            F.round(F.col("failure_rate") * 100, 2).alias("failure_rate_percent"),
            decode("check_result", RESULT_ICON, "❌").alias("status_icon"),
            "details",
            *timed,
        )
    )


def v_task_activity(tables: Tables, as_of: str | None = None, n: int = 50) -> DataFrame:
    """Newest task-log entries of the newest period."""
    log = tables["agent_execution_logs"]
    timed = ["completed_at"] if "completed_at" in log.columns else []
    return (
        newest_period(log)
        .orderBy(F.desc("started_at"), F.desc("log_id"))
        .limit(n)
        .select(
            "agent_name",
            "phase",
            "task_name",
            "status",
            "started_at",
            *timed,
            F.round("duration_seconds", 2).alias("duration_seconds"),
            "records_processed",
            decode("status", TASK_ICON, "⏸️").alias("status_icon"),
            "error_message",
            "closure_period",
        )
    )


def v_trends(tables: Tables, as_of: str | None = None) -> DataFrame:
    """Income statement per period and unit. Costs are the absolute value of the sum."""
    category, amount = F.col("account_category"), F.col("final_amount")
    profit = F.col("revenue") - F.col("cogs")
    return (
        _final(tables)
        .groupBy("closure_period", "bu_name")
        .agg(
            total_when(category == "Revenue", amount).alias("revenue"),
            F.abs(total_when(category == "COGS", amount)).alias("cogs"),
            F.abs(total_when(category == "OpEx", amount)).alias("opex"),
        )
        .withColumns(
            {
                "period_date": period_start("closure_period"),
                "gross_profit": profit,
                "gross_margin_pct": margin_percent(profit, F.col("revenue")),
            }
        )
        .orderBy(F.desc("closure_period"), "bu_name")
    )


def v_variance_analysis(
    tables: Tables, as_of: str | None = None, k: int = 50, cfg: CloseConfig = DEFAULT_CONFIG
) -> DataFrame:
    """Largest material changes of the newest period against its prior period."""
    severity = banded(F.abs("yoy_variance_percent"), ((50, "Extreme"), (20, "High"), (10, "Medium")), "Normal")
    return (
        _newest_final(tables)
        .filter(F.abs("yoy_variance") > cfg.material_variance)
        .orderBy(F.abs("yoy_variance").desc(), "bu_code", "account_code")
        .limit(k)
        .select(
            "bu_name",
            "account_description",
            "account_category",
            "segment_product",
            F.col("final_amount").alias("current_period"),
            F.col("prior_period_amount").alias("prior_period"),
            F.col("yoy_variance").alias("variance_amount"),
            F.col("yoy_variance_percent").alias("variance_percent"),
            severity.alias("variance_severity"),
            "closure_period",
        )
    )


ALL_VIEWS = {
    "v_closure_status": v_closure_status,
    "v_fx_monitor": v_fx_monitor,
    "v_bu_submission": v_bu_submission,
    "v_top_adjustments": v_top_adjustments,
    "v_prelim_summary": v_prelim_summary,
    "v_final_segmented": v_final_segmented,
    "v_forecast_vs_actual": v_forecast_vs_actual,
    "v_kpi_dashboard": v_kpi_dashboard,
    "v_dq_dashboard": v_dq_dashboard,
    "v_task_activity": v_task_activity,
    "v_trends": v_trends,
    "v_variance_analysis": v_variance_analysis,
}


def register_all(tables: Tables, as_of: str) -> None:
    """Register every view as a temporary view under its name."""
    for name, view in ALL_VIEWS.items():
        view(tables, as_of).createOrReplaceTempView(name)
