"""Named queries: every operator applied to the driver tables.

Queries run over all periods, so they read whole tables; the reports that are
defined for one period or for the newest period keep that definition.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from closeworks.config import bu_dim
from closeworks.functions.exprs import account_category, closing_period, phase_deadline, prior_period
from closeworks.operators import controls, fx, ledger, metrics, publish, quality, tasklog
from closeworks.plans import views
from closeworks.plans.close import Close, RawTables
from closeworks.sources.driver_views import CONFIG, FX_AS_OF, FX_ORDER, PERIOD, STATUS_AS_OF, DriverViews

Query = Callable[[SparkSession, str], DataFrame]

APPROVED_AT = "1997-07-10 00:00:00"


class Tables:
    """The close over one directory of driver tables. Frames are built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.source = DriverViews(spark, sf_dir)
        self.raw = RawTables(self.source.raw_table)
        self.close = Close(self.raw, PERIOD, None, CONFIG, FX_ORDER)

    @functools.cached_property
    def periods(self) -> DataFrame:
        """The periods that have results: those of valid ledger rows, before any shuffle."""
        return controls.valid_rows(self.close.ledger).select("closure_period")

    @functools.cached_property
    def newest_close(self) -> Close:
        """The close of the newest period and the one before it. The rows of others are left out of the scans."""
        since = self.periods.agg(F.max("closure_period").alias("p")).select(prior_period("p")).scalar()
        column = {
            "bu_preliminary_close_raw": "period",
            "accounting_cuts_raw": "period",
            "segmented_files_raw": "period",
            "forecast_files_raw": "forecast_period",
        }

        def recent(name: str) -> DataFrame:
            df = self.source.raw_table(name)
            return df.filter(F.col(column[name]) >= since) if name in column else df

        return Close(RawTables(recent), PERIOD, None, CONFIG, FX_ORDER)

    def newest(self, **tables: DataFrame) -> dict[str, DataFrame]:
        return {**tables, "periods": self.periods}

    @property
    def forecasts_of_period(self) -> DataFrame:
        """All forecasts, judged as of the close of ``PERIOD``."""
        return ledger.process_forecasts(self.raw.forecasts, self.raw.forecast_fx, PERIOD, CONFIG)

    @property
    def first_publication(self) -> DataFrame:
        """Preliminary results of the lines that were closed first: version 1 where they exist."""
        early = self.raw.ledger.filter(F.col("l_linestatus") == "F")
        return publish.preliminary_results(ledger.process_ledger(early, self.close.latest_rates, None, CONFIG))


def _issues_text(c: str) -> Column:
    return F.array_join(F.sort_array(c), "; ").alias(c)


def _without(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)


# --- dimensions and joins ------------------------------------------------------


def q_bu_dim(t: Tables) -> DataFrame:
    """Configured units with the number of their ledger lines."""
    lines = t.raw.ledger.groupBy("bu_code").agg(F.count("*").alias("ledger_lines"))
    known = lines.filter(F.col("bu_code").isin(CONFIG.bu_codes))
    return bu_dim(t.spark, CONFIG).join(F.broadcast(known), "bu_code", "left")


def q_join_bu_dim(t: Tables) -> DataFrame:
    named = ledger.bu_names(t.raw.ledger, CONFIG)
    return named.groupBy("bu_code", "bu_name").agg(F.count("*").alias("records"))


def q_convert_ledger(t: Tables) -> DataFrame:
    return t.close.ledger.select(
        "period", "bu_code", "account_code", "local_currency", "local_amount", "exchange_rate", "usd_amount"
    )


def q_convert_cuts(t: Tables) -> DataFrame:
    return t.close.cuts.select(
        "period", "bu_code", "account_code", "currency", "adjustment_amount", "exchange_rate", "usd_amount"
    )


def q_convert_forecast(t: Tables) -> DataFrame:
    return ledger.convert_forecasts(t.raw.forecasts, t.raw.forecast_fx, CONFIG).select(
        "bu_code", "account_code", "forecast_period", "currency", "forecast_amount", "exchange_rate", "usd_amount"
    )


def q_missing_fx(t: Tables) -> DataFrame:
    """Rows without a rate, per dataset and currency."""
    c = t.close
    parts = (
        ("bu_preliminary_close", c.ledger, "local_currency"),
        ("accounting_cuts", c.cuts, "currency"),
        ("segmented_files", c.segments, "currency"),
        ("forecast_files", c.forecasts, "currency"),
    )
    out = None
    for name, df, currency in parts:
        rows = (
            fx.missing_fx(df, currency, CONFIG)
            .groupBy(F.col(currency).alias("currency"))
            .agg(F.count("*").alias("records"))
            .select(F.lit(name).alias("dataset"), "currency", "records")
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def q_bu_currency(t: Tables) -> DataFrame:
    looked_up = ledger.bu_currency(t.raw.ledger.select("bu_code"), CONFIG)
    return looked_up.groupBy("bu_code", "bu_currency", "bu_exists").agg(F.count("*").alias("records"))


def q_closing_period(t: Tables) -> DataFrame:
    """Status rows per day they started and period that is closed on that day."""
    days = t.source.closure_status().groupBy(F.col("started_at").cast("date").alias("day")).agg(F.count("*").alias("records"))
    return days.select("day", closing_period("day").alias("closing_period"), "records")


def q_phase_deadline(t: Tables) -> DataFrame:
    deadline = phase_deadline("started_at", "current_phase", CONFIG.phase_sla_hours)
    return t.source.closure_status().select("closure_id", "current_phase", "started_at", deadline.alias("deadline"))


def q_final_published(t: Tables) -> DataFrame:
    """The close of one period, with the prior period from results that are published already."""
    published = t.close.final_results.filter(F.col("closure_period") < PERIOD)
    return Close(t.raw, PERIOD, PERIOD, CONFIG, FX_ORDER, published_final=published).final_results


# --- rates ---------------------------------------------------------------------


def q_fx_variance(t: Tables) -> DataFrame:
    return fx.fx_variance(t.raw.exchange_rates, FX_ORDER).select(
        "event_id", "currency", "rate_date", "rate", "prior_rate", "variance_from_prior"
    )


def q_fx_variance_by_load(t: Tables) -> DataFrame:
    """Prior rates in the order of a landed file: day, load time, load id as text."""
    return fx.fx_variance(t.raw.exchange_rates, fx.RATE_ORDER).select(
        "event_id", "currency", "rate_date", "rate", "prior_rate", "variance_from_prior"
    )


def q_fx_outliers(t: Tables) -> DataFrame:
    return fx.fx_outliers(fx.fx_variance(t.raw.exchange_rates, FX_ORDER)).select(
        "event_id", "currency", "rate_date", "rate", "prior_rate", "variance_from_prior"
    )


def q_fx_dedup(t: Tables) -> DataFrame:
    return fx.dedup_rates(t.raw.exchange_rates, FX_ORDER)


def q_fx_monitor(t: Tables) -> DataFrame:
    return views.v_fx_monitor({"exchange_rates": t.close.exchange_rates}, FX_AS_OF)


# --- datasets ------------------------------------------------------------------


def q_ledger_processed(t: Tables) -> DataFrame:
    return t.close.ledger.withColumn("validation_issues", F.array_join("validation_issues", "; "))


def q_cuts_processed(t: Tables) -> DataFrame:
    cuts = ledger.process_cuts(t.raw.cuts, t.close.latest_rates, None, CONFIG, approved_at=APPROVED_AT)
    return cuts.withColumn("approved_at", F.col("approved_at").cast("timestamp_ntz"))


def q_forecasts_processed(t: Tables) -> DataFrame:
    return ledger.process_forecasts(
        t.raw.forecasts, t.raw.forecast_fx, PERIOD, CONFIG, version_variance=True
    )


def q_forecast_past(t: Tables) -> DataFrame:
    return (
        ledger.past_forecasts(t.raw.forecasts, PERIOD)
        .groupBy("forecast_period")
        .agg(F.count("*").alias("past_forecasts"))
    )


def q_account_category(t: Tables) -> DataFrame:
    return t.raw.ledger.groupBy("account_code", account_category().alias("account_category")).agg(
        F.count("*").alias("records")
    )


def q_segment_completeness(t: Tables) -> DataFrame:
    return ledger.segment_completeness(t.raw.segments, CONFIG).select(
        "bu_code",
        "account_code",
        "segment_count",
        _issues_text("segments_present"),
        "is_complete",
        _issues_text("segments_missing"),
    )


def q_period_prior(t: Tables) -> DataFrame:
    return (
        t.raw.ledger.groupBy("period")
        .agg(F.count("*").alias("records"))
        .select(
            "period",
            prior_period("period").alias("prior_period"),
            prior_period("period", 12).alias("prior_year_period"),
            "records",
        )
    )


# --- quality -------------------------------------------------------------------


def q_null_profile(t: Tables) -> DataFrame:
    profiles = (
        ("exchange_rates_raw", t.raw.exchange_rates, ["currency", "rate", "rate_date"]),
        ("bu_preliminary_close_raw", t.raw.ledger, ["bu_code", "account_code", "local_amount", "period"]),
        ("accounting_cuts_raw", t.raw.cuts, ["cut_number", "bu_code", "account_code", "adjustment_amount"]),
        (
            "segmented_files_raw",
            t.raw.segments,
            ["bu_code", "account_code", "segment_type", "segment_value", "amount"],
        ),
        (
            "forecast_files_raw",
            t.raw.forecasts,
            ["bu_code", "account_code", "forecast_period", "forecast_amount"],
        ),
    )
    out = None
    for name, df, columns in profiles:
        rows = quality.null_profile(df, columns).select(F.lit(name).alias("table_name"), "*")
        out = rows if out is None else out.unionByName(rows)
    return out


def q_domain_violations(t: Tables) -> DataFrame:
    checks = (
        ("exchange_rates_raw", t.raw.exchange_rates, "currency", list(CONFIG.currencies)),
        ("bu_preliminary_close_raw", t.raw.ledger, "bu_code", CONFIG.bu_codes),
        ("accounting_cuts_raw", t.raw.cuts, "cut_number", list(CONFIG.valid_cuts)),
        ("segmented_files_raw", t.raw.segments, "segment_type", list(CONFIG.segment_types)),
        ("forecast_files_raw", t.raw.forecasts, "bu_code", CONFIG.bu_codes),
    )
    out = None
    for name, df, column, allowed in checks:
        rows = quality.domain_violations(df, column, allowed).select(
            F.lit(name).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.col("offending_value").cast("string").alias("offending_value"),
            "records",
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def q_ledger_issues(t: Tables) -> DataFrame:
    """How often each combination of issues occurs."""
    return t.close.ledger.groupBy(F.array_join("validation_issues", "; ").alias("validation_issues")).agg(
        F.count("*").alias("records")
    )


def q_validation_summary(t: Tables) -> DataFrame:
    out = None
    for name, df in t.close.datasets.items():
        rows = quality.validation_summary(df).select(F.lit(name).alias("dataset"), "is_validated", "records")
        out = rows if out is None else out.unionByName(rows)
    return out


def q_preview_invalid(t: Tables) -> DataFrame:
    """Sample of 20 invalid ledger rows; the order uses all shown columns."""
    invalid = t.close.ledger.filter(~F.col("is_validated")).select(
        "bu_code",
        "account_code",
        "local_amount",
        "period",
        F.array_join("validation_issues", "; ").alias("validation_issues"),
    )
    order = [F.asc_nulls_first(c) for c in invalid.columns]
    return quality.preview(invalid, 20, *order)


def q_dq_rules_fx(t: Tables) -> DataFrame:
    return quality.dq_rules_fx(fx.fx_variance(t.raw.exchange_rates, FX_ORDER), CONFIG)


# --- publishing ------------------------------------------------------------------


def q_prelim_next_version(t: Tables) -> DataFrame:
    every_period = t.raw.ledger.select(F.col("period").alias("closure_period"))
    return publish.next_version(every_period, t.first_publication)


def q_prelim_republished(t: Tables) -> DataFrame:
    """Second publication over the first: prior amounts from the first, next version numbers."""
    return publish.preliminary_results(t.close.ledger, None, t.first_publication)


def q_prelim_latest_version(t: Tables) -> DataFrame:
    """Latest version per period of two publications; a later one replaces the whole period."""
    both = t.first_publication.unionByName(q_prelim_republished(t))
    return (
        publish.latest_version(both)
        .groupBy("closure_period", "version")
        .agg(F.count("*").alias("results"))
    )


def q_segment_pivot(t: Tables) -> DataFrame:
    return ledger.segment_pivot(t.close.segments, CONFIG)


def q_alerts(t: Tables) -> DataFrame:
    c = t.close
    return controls.alerts(c.exchange_rates, c.ledger, c.segments, c.forecasts, c.executive_summary, CONFIG)


def q_approvals_approve(t: Tables) -> DataFrame:
    approved = controls.approve_pending(t.source.approvals(), APPROVED_AT)
    return approved.withColumn("approved_at", F.col("approved_at").cast("timestamp_ntz"))


def q_segment_coverage(t: Tables) -> DataFrame:
    return controls.segment_coverage(t.close.segments, cfg=CONFIG).select(
        "closure_period", "bu_code", "segments_present", _issues_text("segment_types"), _issues_text("segments_missing")
    )


def q_dataset_counts(t: Tables) -> DataFrame:
    c = t.close
    return metrics.dataset_counts(
        {**c.datasets, "preliminary_results": c.preliminary_results, "final_results": c.final_results}
    )


def _period_tables(t: Tables) -> dict[str, DataFrame]:
    c = t.close
    return {
        "closure_status": t.source.closure_status(),
        "bu_preliminary_close": c.ledger,
        "segmented_files": c.segments,
        "forecast_files": c.forecasts,
    }


def _of_ledger(f: Callable[..., DataFrame], *args, **kwargs) -> Callable[[Tables], DataFrame]:
    return lambda t: f(t.close.ledger, *args, **kwargs)


def _of_cuts(f: Callable[..., DataFrame], *args, **kwargs) -> Callable[[Tables], DataFrame]:
    return lambda t: f(t.close.cuts, *args, **kwargs)


def _of_segments(f: Callable[..., DataFrame], *args, **kwargs) -> Callable[[Tables], DataFrame]:
    return lambda t: f(t.close.segments, *args, **kwargs)


def _of_prelim(f: Callable[..., DataFrame], *args, **kwargs) -> Callable[[Tables], DataFrame]:
    return lambda t: f(t.close.preliminary_results, *args, **kwargs)


def _of_final(f: Callable[..., DataFrame], *args, **kwargs) -> Callable[[Tables], DataFrame]:
    return lambda t: f(t.close.final_results, *args, **kwargs)


def _of_dq(f: Callable[..., DataFrame], *args, **kwargs) -> Callable[[Tables], DataFrame]:
    return lambda t: f(t.close.data_quality_checks, *args, **kwargs)


def _of_log(f: Callable[..., DataFrame], *args, **kwargs) -> Callable[[Tables], DataFrame]:
    return lambda t: f(t.source.task_log(), *args, **kwargs)


BUILDERS: dict[str, Callable[[Tables], DataFrame]] = {
    # dimensions, joins, conversion
    "bu_dim": q_bu_dim,
    "join_bu_dim": q_join_bu_dim,
    "bu_currency": q_bu_currency,
    "convert_ledger": q_convert_ledger,
    "convert_cuts": q_convert_cuts,
    "convert_forecast": q_convert_forecast,
    "missing_fx": q_missing_fx,
    "account_category": q_account_category,
    "period_prior": q_period_prior,
    "closing_period": q_closing_period,
    "phase_deadline": q_phase_deadline,
    # rates
    "fx_variance": q_fx_variance,
    "fx_variance_by_load": q_fx_variance_by_load,
    "fx_outliers": q_fx_outliers,
    "fx_processed": lambda t: t.close.exchange_rates,
    "fx_dedup": q_fx_dedup,
    "fx_latest": lambda t: t.close.latest_rates,
    "fx_monthly_avg": lambda t: fx.monthly_rates(t.raw.forecast_fx),
    "fx_recent": lambda t: fx.recent_rates(t.close.exchange_rates, FX_AS_OF),
    "fx_outlier_count": lambda t: controls.fx_outlier_count(t.close.exchange_rates, CONFIG),
    # processed datasets
    "ledger_processed": q_ledger_processed,
    "cuts_processed": q_cuts_processed,
    "segments_processed": lambda t: t.close.segments,
    "forecasts_processed": q_forecasts_processed,
    "forecast_version_variance": lambda t: ledger.forecast_version_variance(t.raw.forecasts),
    "forecast_past": q_forecast_past,
    "segment_completeness": q_segment_completeness,
    "segment_pivot": q_segment_pivot,
    "adjustments_by_account": _of_cuts(publish.adjustments_by_account),
    # quality
    "null_profile": q_null_profile,
    "domain_violations": q_domain_violations,
    "preview_invalid": q_preview_invalid,
    "ledger_issues": q_ledger_issues,
    "validation_summary": q_validation_summary,
    "dq_rules_fx": q_dq_rules_fx,
    "dq_rules_ledger": lambda t: quality.dq_rules_ledger(t.raw.ledger, CONFIG),
    "dq_rules_cuts": lambda t: quality.dq_rules_cuts(t.close.cuts, t.close.ledger, CONFIG),
    "dq_rules_segments": lambda t: quality.dq_rules_segments(t.raw.segments, CONFIG),
    "dq_rules_forecast": lambda t: quality.dq_rules_forecast(t.raw.forecasts, PERIOD),
    "dq_scorecard": lambda t: t.close.data_quality_checks,
    "dq_summary": _of_dq(quality.dq_summary, phase=3),
    "dq_dashboard": _of_dq(quality.dq_dashboard),
    "dq_issues": _of_dq(quality.dq_issues),
    "audit_quality": _of_dq(quality.audit_quality),
    # controls
    "bu_submitted": _of_ledger(controls.bu_submitted),
    "bu_missing": _of_ledger(controls.bu_missing, cfg=CONFIG),
    "forecast_coverage": lambda t: controls.forecast_coverage(t.forecasts_of_period),
    "large_adjustments": _of_cuts(controls.large_adjustments, cfg=CONFIG),
    "recon_totals": lambda t: controls.recon_totals(t.close.ledger, t.close.cuts),
    "cut_counts": _of_cuts(controls.cut_counts),
    "cut_completeness": _of_cuts(controls.cut_completeness),
    "segment_coverage": q_segment_coverage,
    "review_summary": lambda t: controls.review_summary(
        t.close.ledger, t.close.segments, t.forecasts_of_period
    ),
    "dataset_completeness": lambda t: controls.dataset_completeness(
        t.close.ledger, t.close.cuts, t.close.segments, t.close.forecasts, cfg=CONFIG
    ),
    "recon_prelim_segment": lambda t: controls.recon_prelim_segment(t.close.ledger, t.close.segments, cfg=CONFIG),
    "alerts": q_alerts,
    "signoff_requests": lambda t: controls.signoff_requests(t.close.ledger, t.close.cuts, CONFIG),
    "approvals_pending": lambda t: controls.approvals_pending(t.source.approvals()),
    "approvals_approve": q_approvals_approve,
    # publishing
    "prelim_results": lambda t: t.close.preliminary_results,
    "prelim_next_version": q_prelim_next_version,
    "prelim_republished": q_prelim_republished,
    "prelim_latest_version": q_prelim_latest_version,
    "prelim_category_summary": _of_prelim(publish.prelim_category_summary),
    "prelim_by_bu": _of_prelim(publish.prelim_by_bu),
    "top_variances": _of_prelim(publish.top_variances, PERIOD, cfg=CONFIG),
    "final_results": lambda t: t.close.final_results,
    "final_published": q_final_published,
    "final_by_bu": _of_final(publish.final_by_bu),
    "final_listing": _of_final(publish.final_listing),
    "kpi_metrics": lambda t: t.close.kpi_metrics,
    "kpi_listing": lambda t: publish.kpi_listing(t.close.kpi_metrics),
    # dataset reports
    "ledger_by_bu": _of_ledger(metrics.ledger_by_bu),
    "cuts_summary": _of_cuts(metrics.cuts_summary),
    "cuts_by_bu": _of_cuts(metrics.cuts_by_bu),
    "segments_by_type": _of_segments(metrics.segments_by_type),
    "segments_by_bu": _of_segments(metrics.segments_by_bu),
    "forecast_by_bu": lambda t: metrics.forecast_by_bu(t.forecasts_of_period),
    "forecast_trend": lambda t: metrics.forecast_trend(t.forecasts_of_period),
    "data_completeness": lambda t: metrics.data_completeness(t.close.datasets),
    "dataset_counts": q_dataset_counts,
    # financial metrics
    "financial_summary": _of_final(metrics.financial_summary),
    "exec_summary": lambda t: t.close.executive_summary,
    "bu_revenue": _of_final(metrics.bu_revenue),
    "product_performance": _of_final(metrics.product_performance),
    "forecast_accuracy": _of_final(metrics.forecast_accuracy),
    "yoy_comparison": _of_final(metrics.yoy_comparison),
    # cycle status
    "recent_periods": lambda t: metrics.recent_periods(t.source.closure_status()),
    "cycle_status": lambda t: metrics.cycle_status(t.source.closure_status(), PERIOD, STATUS_AS_OF),
    "status_history": lambda t: metrics.status_history(t.source.closure_status(), STATUS_AS_OF),
    "newest_statuses": lambda t: metrics.newest_statuses(t.source.closure_status()),
    # task log
    "task_summary": _of_log(tasklog.task_summary),
    "task_timeline": _of_log(tasklog.task_timeline),
    "newest_tasks": _of_log(tasklog.newest_tasks),
    "task_performance": _of_log(tasklog.task_performance),
    "failed_tasks": _of_log(tasklog.failed_tasks),
    "phase_progress": _of_log(tasklog.phase_progress),
    "overall_stats": _of_log(tasklog.overall_stats),
    "audit_activity": _of_log(tasklog.audit_activity),
    "task_daily_performance": _of_log(tasklog.task_daily_performance, CONFIG),
    "notification_status": lambda t: tasklog.notification_status(t.source.notifications()),
    # raw landing reports
    # Engines add doubles in different orders; the digest rounds what the operator does not.
    "raw_fx_stats": lambda t: metrics.raw_fx_stats(t.raw.exchange_rates).withColumn("stddev_rate", F.round("stddev_rate", 8)),
    "raw_ledger_by_bu": lambda t: metrics.raw_ledger_by_bu(t.raw.ledger, CONFIG.bu_codes),
    "raw_ledger_by_category": lambda t: metrics.raw_ledger_by_category(t.raw.ledger, CONFIG.bu_codes),
    "raw_cuts_by_cut": lambda t: metrics.raw_cuts_by_cut(t.raw.cuts),
    "raw_cuts_by_bu": lambda t: metrics.raw_cuts_by_bu(t.raw.cuts),
    "raw_cuts_by_type": lambda t: metrics.raw_cuts_by_type(t.raw.cuts),
    "raw_segments_by_type": lambda t: metrics.raw_segments_by_type(t.raw.segments),
    "raw_segments_by_bu": lambda t: metrics.raw_segments_by_bu(t.raw.segments),
    "raw_segments_by_product": lambda t: metrics.raw_segments_by_product(t.raw.segments),
    "raw_forecast_by_bu": lambda t: metrics.raw_forecast_by_bu(t.raw.forecasts),
    "raw_forecast_trend": lambda t: metrics.raw_forecast_trend(t.raw.forecasts),
    "raw_forecast_fx_summary": lambda t: metrics.raw_forecast_fx_summary(t.raw.forecast_fx),
    "preview_raw_rates": lambda t: metrics.raw_recent_rates(t.raw.exchange_rates, FX_AS_OF),
    "preview_raw_ledger": lambda t: metrics.raw_preview(
        t.raw.ledger,
        ["bu_code", "account_code", "account_description", "local_currency", "local_amount", "period", "cost_center"],
    ),
    "preview_raw_cuts": lambda t: metrics.raw_preview(
        t.raw.cuts,
        [
            "cut_number", "bu_code", "account_code", "adjustment_type", "adjustment_amount", "currency",
            "description", "period",
        ],
    ),
    "preview_raw_segments": lambda t: metrics.raw_preview(
        t.raw.segments,
        ["bu_code", "account_code", "segment_type", "segment_value", "amount", "currency", "period"],
        n=100,
    ),
    "preview_raw_forecasts": lambda t: metrics.raw_preview(
        t.raw.forecasts,
        [
            "bu_code", "account_code", "forecast_period", "forecast_amount", "currency", "forecast_type", "version",
        ],
    ),
    "preview_raw_forecast_fx": lambda t: metrics.raw_preview(
        t.raw.forecast_fx, ["currency", "forecast_month", "forecast_rate", "source"], first=["forecast_month"]
    ),
    # dashboard views
    "v_closure_status": lambda t: views.v_closure_status({"closure_status": t.source.closure_status()}, STATUS_AS_OF),
    "v_fx_monitor": q_fx_monitor,
    "v_bu_submission": lambda t: views.v_bu_submission(_period_tables(t), cfg=CONFIG),
    "v_top_adjustments": lambda t: _without(
        views.v_top_adjustments({"accounting_cuts": t.close.cuts}), "approved_at"
    ),
    "v_prelim_summary": lambda t: views.v_prelim_summary(t.newest(preliminary_results=t.newest_close.preliminary_results)),
    "v_final_segmented": lambda t: views.v_final_segmented(t.newest(final_results=t.newest_close.final_results)),
    "v_forecast_vs_actual": lambda t: views.v_forecast_vs_actual(t.newest(final_results=t.newest_close.final_results)),
    "v_kpi_dashboard": lambda t: views.v_kpi_dashboard(t.newest(kpi_metrics=t.newest_close.kpi_metrics)),
    "v_dq_dashboard": lambda t: views.v_dq_dashboard({"data_quality_checks": t.close.data_quality_checks}),
    "v_task_activity": lambda t: views.v_task_activity({"agent_execution_logs": t.source.task_log()}),
    "v_trends": lambda t: views.v_trends({"final_results": t.close.final_results}),
    "v_variance_analysis": lambda t: views.v_variance_analysis(
        t.newest(final_results=t.newest_close.final_results), cfg=CONFIG
    ),
}


@functools.lru_cache(maxsize=4)
def tables_of(spark: SparkSession, sf_dir: str) -> Tables:
    """One close per session and directory. It holds plans only, no data, so queries share their building."""
    return Tables(spark, sf_dir)


def _query(build: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(tables_of(spark, sf_dir))


def all_queries() -> dict[str, Query]:
    return {name: _query(build) for name, build in BUILDERS.items()}

