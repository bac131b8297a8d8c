"""Close-control checks: who has submitted, what reconciles, what needs a review.

Checks that compare a period with the configured units start from the periods in
the data and expand each by the (fixed) list of units; there is no cross join.
All checks cover every period at once unless a period is given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closeworks.config import DEFAULT_CONFIG, CloseConfig, bu_dim
from closeworks.functions.exprs import amount_of, has_all, in_period, total, unit_sum
from closeworks.operators.lookup import join_dimension


def valid_rows(df: DataFrame, period: str | None = None) -> DataFrame:
    return in_period(df.filter(F.col("is_validated")), period)


def with_every_bu(periods: DataFrame, cfg: CloseConfig = DEFAULT_CONFIG) -> DataFrame:
    """Each row of ``periods`` once per configured business unit."""
    units = F.array(
        *[
            F.struct(
                F.lit(b.code).alias("bu_code"),
                F.lit(b.name).alias("bu_name"),
                F.lit(b.region).alias("region"),
                F.lit(b.contact).alias("contact"),
            )
            for b in cfg.business_units
        ]
    )
    return periods.select("*", F.inline(units))


def _periods(df: DataFrame, period: str | None = None) -> DataFrame:
    return in_period(df.select("closure_period").filter(F.col("closure_period").isNotNull()), period).distinct()


def bu_missing(
    df: DataFrame, periods: DataFrame | None = None, cfg: CloseConfig = DEFAULT_CONFIG
) -> DataFrame:
    """Units without a valid row in ``df``, for each of its periods (or for those in ``periods``).

    One pass: per period, the configured units seen in valid rows. The list cannot
    grow beyond the configuration.
    """
    seen = F.when(F.col("is_validated") & F.col("bu_code").isin(cfg.bu_codes), F.col("bu_code"))
    submitted = (
        df.filter(F.col("closure_period").isNotNull())
        .select("closure_period", seen.alias("_seen"))
        .distinct()
        .groupBy("closure_period")
        .agg(F.collect_list("_seen").alias("_submitted"))
    )
    if periods is not None:
        submitted = _periods(periods).join(submitted, "closure_period", "left")
    known = F.coalesce("_submitted", F.array().cast("array<string>"))
    return with_every_bu(submitted, cfg).filter(~F.array_contains(known, F.col("bu_code"))).drop("_submitted")


def bu_submitted(df: DataFrame, period: str | None = None) -> DataFrame:
    return valid_rows(df, period).select("closure_period", "bu_code").distinct()


def fx_outlier_count(rates: DataFrame, cfg: CloseConfig = DEFAULT_CONFIG) -> DataFrame:
    """Rates beyond the variance threshold that are not validated, per period; 0 where there are none."""
    beyond = (F.abs("variance_from_prior") > cfg.fx_variance_threshold) & ~F.col("is_validated")
    return rates.groupBy("closure_period").agg(F.count_if(beyond).alias("outliers"))


def forecast_coverage(forecasts: DataFrame, period: str | None = None) -> DataFrame:
    """Periods and rows forecast by each unit."""
    by_period = (
        valid_rows(forecasts, period)
        .groupBy("closure_period", "bu_code", "forecast_period")
        .agg(F.count("*").alias("_rows"))
    )
    return by_period.groupBy("closure_period", "bu_code").agg(
        F.count("forecast_period").alias("periods_forecasted"), F.sum("_rows").alias("forecast_records")
    )


def large_adjustments(
    cuts: DataFrame, period: str | None = None, cfg: CloseConfig = DEFAULT_CONFIG
) -> DataFrame:
    """Valid adjustments above the review limit, per period; 0 where there are none."""
    large = F.col("is_validated") & (F.abs("usd_amount") > cfg.large_adjustment)
    return in_period(cuts, period).groupBy("closure_period").agg(F.count_if(large).alias("adjustments"))


def recon_totals(ledger: DataFrame, cuts: DataFrame, period: str | None = None) -> DataFrame:
    """Ledger total beside adjustments total, per period."""

    def side(df: DataFrame, prelim: Column, adj: Column) -> DataFrame:
        sums = valid_rows(df, period).groupBy("closure_period").agg(total("usd_amount").alias("_total"))
        return sums.select("closure_period", prelim.alias("prelim_total"), adj.alias("adj_total"))

    none = F.lit(None).cast("double")
    both = side(ledger, F.col("_total"), none).unionByName(side(cuts, none, F.col("_total")))
    return both.groupBy("closure_period").agg(
        F.max("prelim_total").alias("prelim_total"), F.max("adj_total").alias("adj_total")
    )


def cut_counts(cuts: DataFrame, period: str | None = None) -> DataFrame:
    return valid_rows(cuts, period).groupBy("closure_period", "cut_number").agg(F.count("*").alias("records"))


def cut_completeness(cuts: DataFrame, period: str | None = None) -> DataFrame:
    """Which cuts of a period have arrived. Periods with invalid rows only count as having none."""
    valid = F.col("is_validated")
    return (
        in_period(cuts, period)
        .groupBy("closure_period")
        .agg(
            F.count_if(valid & (F.col("cut_number") == 1)).alias("first_cut_rows"),
            F.count_if(valid & (F.col("cut_number") == 2)).alias("second_cut_rows"),
        )
        .withColumn(
            "cut_status",
            F.when((F.col("first_cut_rows") > 0) & (F.col("second_cut_rows") > 0), "Both cuts received")
            .when(F.col("first_cut_rows") > 0, "Only 1st cut received")
            .otherwise("No cuts received"),
        )
    )


def segment_coverage(
    segments: DataFrame, period: str | None = None, cfg: CloseConfig = DEFAULT_CONFIG
) -> DataFrame:
    """Segment types delivered by each unit, and the ones it lacks.

    Valid rows hold configured types only, so the collected list has at most that many entries.
    """
    return (
        valid_rows(segments, period)
        .select("closure_period", "bu_code", "segment_type")
        .distinct()
        .groupBy("closure_period", "bu_code")
        .agg(F.sort_array(F.collect_list("segment_type")).alias("segment_types"))
        .withColumns(
            {
                "segments_present": F.size("segment_types"),
                "segments_missing": has_all(F.col("segment_types"), cfg.segment_types),
            }
        )
    )


def review_summary(
    ledger: DataFrame, segments: DataFrame, forecasts: DataFrame, period: str | None = None
) -> DataFrame:
    """Per unit: accounts, ledger total, segment types, forecast periods.

    Each dataset is aggregated to the unit before the join, so the join cannot multiply amounts.
    """
    key = ["closure_period", "bu_code"]
    accounts = (
        valid_rows(ledger, period)
        .groupBy(*key, "bu_name", "account_code")
        .agg(unit_sum("usd_amount").alias("_amount"))
        .groupBy(*key, "bu_name")
        .agg(F.count("account_code").alias("accounts"), amount_of(F.sum("_amount")).alias("preliminary_total"))
    )

    def distinct_per_bu(df: DataFrame, column: str, name: str) -> DataFrame:
        values = in_period(df, period).select(*key, column).distinct()
        return values.groupBy(*key).agg(F.count(column).alias(name))

    zero = F.lit(0).cast("bigint")
    return (
        accounts.join(distinct_per_bu(segments, "segment_type", "segments_present"), key, "left")
        .join(distinct_per_bu(forecasts, "forecast_period", "forecast_periods"), key, "left")
        .select(
            *key,
            "bu_name",
            "accounts",
            "preliminary_total",
            F.coalesce("segments_present", zero).alias("segments_present"),
            F.coalesce("forecast_periods", zero).alias("forecast_periods"),
        )
    )


def dataset_completeness(
    ledger: DataFrame,
    cuts: DataFrame,
    segments: DataFrame,
    forecasts: DataFrame,
    period: str | None = None,
    cfg: CloseConfig = DEFAULT_CONFIG,
) -> DataFrame:
    """Per period and dataset: distinct units (or cuts) delivered against the expected number."""
    units = len(cfg.business_units)
    wanted = [
        ("Preliminary Close", ledger, "bu_code", units),
        ("Accounting Cuts", cuts, "cut_number", len(cfg.valid_cuts)),
        ("Segmented Files", segments, "bu_code", units),
        ("Forecast Files", forecasts, "bu_code", units),
    ]
    found = None
    for name, df, column, _ in wanted:
        values = (
            valid_rows(df, period)
            .select("closure_period", F.lit(name).alias("dataset"), F.col(column).cast("string").alias("_value"))
            .distinct()
        )
        found = values if found is None else found.unionByName(values)
    counts = found.groupBy("closure_period").agg(
        *[F.count_if(F.col("dataset") == name).alias(f"_n{i}") for i, (name, *_) in enumerate(wanted)]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("dataset"),
                F.col(f"_n{i}").alias("actual"),
                F.lit(expected).cast("bigint").alias("expected"),
                (F.col(f"_n{i}") == expected).alias("passed"),
            )
            for i, (name, _, _, expected) in enumerate(wanted)
        ]
    )
    return counts.select("closure_period", F.inline(rows))


def recon_prelim_segment(
    ledger: DataFrame, segments: DataFrame, period: str | None = None, cfg: CloseConfig = DEFAULT_CONFIG
) -> DataFrame:
    """Ledger total of the reconciled accounts against the segment total, per period.

    The difference is measured against the absolute ledger total. A period without a
    ledger total cannot pass.
    """
    booked = (
        valid_rows(ledger, period)
        .filter(F.col("account_code").isin(list(cfg.reconciled_accounts)))
        .groupBy("closure_period")
        .agg(total("usd_amount").alias("total_prelim"))
    )
    split = valid_rows(segments, period).groupBy("closure_period").agg(total("usd_amount").alias("total_segment"))
    variance = F.abs(F.col("total_prelim") - F.col("total_segment"))
    share = F.try_divide(variance, F.abs("total_prelim"))
    return booked.join(split, "closure_period", "full").select(
        "closure_period",
        F.lit("Preliminary vs Segmented").alias("reconciliation_type"),
        "total_prelim",
        "total_segment",
        variance.alias("variance"),
        F.when(share < cfg.reconciliation_tolerance, "PASS").otherwise("FAIL").alias("result"),
    )


# --- alerts -----------------------------------------------------------------


def _alert(df: DataFrame, phase: int, severity: str, message: Column, recipient: Column) -> DataFrame:
    return df.select(
        "closure_period",
        F.lit(phase).alias("phase"),
        F.lit(severity).alias("severity"),
        message.alias("message"),
        recipient.alias("recipient"),
    )


def fx_alerts(rates: DataFrame, cfg: CloseConfig = DEFAULT_CONFIG) -> DataFrame:
    text = F.concat(
        F.lit("Found "), F.col("outliers").cast("string"), F.lit(" exchange rates exceeding variance threshold")
    )
    return _alert(fx_outlier_count(rates, cfg).filter(F.col("outliers") > 0), 1, "WARNING", text, F.lit(cfg.operations_contact))


def missing_ledger_alerts(ledger: DataFrame, cfg: CloseConfig = DEFAULT_CONFIG) -> DataFrame:
    text = F.concat(F.lit("Preliminary close file missing from "), F.col("bu_name"))
    return _alert(bu_missing(ledger, cfg=cfg), 1, "WARNING", text, F.col("contact"))


def incomplete_segment_alerts(segments: DataFrame, cfg: CloseConfig = DEFAULT_CONFIG) -> DataFrame:
    """Units that delivered some but not all segment types."""
    lacking = segment_coverage(segments, cfg=cfg).filter(F.size("segments_missing") > 0)
    names = bu_dim(segments.sparkSession, cfg).select("bu_code", "bu_name", "contact")
    named = join_dimension(lacking, names, "bu_code")
    text = F.concat(F.lit("Incomplete segment data from "), F.col("bu_name"))
    return _alert(named, 3, "WARNING", text, F.col("contact"))


def missing_forecast_alerts(
    forecasts: DataFrame, periods: DataFrame, cfg: CloseConfig = DEFAULT_CONFIG
) -> DataFrame:
    text = F.concat(F.lit("Missing forecast data from "), F.col("bu_name"))
    return _alert(bu_missing(forecasts, periods, cfg), 3, "WARNING", text, F.col("contact"))


def completion_alerts(summary: DataFrame, cfg: CloseConfig = DEFAULT_CONFIG) -> DataFrame:
    """One message per closed period, from ``metrics.exec_summary``."""

    def percent(c: str) -> Column:
        return F.concat(F.format_number(F.col(c), 2), F.lit("%"))

    text = F.concat(
        F.lit("Financial closure for "),
        F.col("closure_period"),
        F.lit(" is complete.\n\nKey Metrics:\n- Total Revenue: $"),
        F.format_number("total_revenue", 2),
        F.lit("\n- Gross Margin: "),
        percent("gross_margin_pct"),
        F.lit("\n- Operating Margin: "),
        percent("operating_margin_pct"),
        F.lit("\n\nFinal results are available in the reporting dashboards."),
    )
    return _alert(summary, 5, "INFO", text, F.lit(cfg.operations_contact))


def alerts(
    rates: DataFrame,
    ledger: DataFrame,
    segments: DataFrame,
    forecasts: DataFrame,
    summary: DataFrame,
    cfg: CloseConfig = DEFAULT_CONFIG,
) -> DataFrame:
    """All alerts of all periods. Nothing is sent; rows go to the notifications table."""
    return (
        fx_alerts(rates, cfg)
        .unionByName(missing_ledger_alerts(ledger, cfg))
        .unionByName(incomplete_segment_alerts(segments, cfg))
        .unionByName(missing_forecast_alerts(forecasts, ledger, cfg))
        .unionByName(completion_alerts(summary, cfg))
    )


# --- sign-offs --------------------------------------------------------------


def signoff_requests(ledger: DataFrame, cuts: DataFrame, cfg: CloseConfig = DEFAULT_CONFIG) -> DataFrame:
    """Requests a period needs: review meetings, one sign-off per unit, a review of large adjustments."""


    def request(phase: int, kind: str, approver: Column, status: str, comments: Column) -> list[Column]:
        return [
            F.lit(phase).alias("phase"),
            F.lit(kind).alias("approval_type"),
            approver.alias("required_approver"),
            F.lit(status).alias("status"),
            comments.alias("comments"),
        ]

    teams = F.lit("FP&A + Tech Teams")
    scheduled = "{} - auto-scheduled by agent".format
    regular = [
        (2, "PRELIMINARY_REVIEW_MEETING", teams, "SCHEDULED", scheduled("Preliminary results review")),
        (4, "SEGMENTED_CLOSE_REVIEW", teams, "SCHEDULED", scheduled("Segmented close review")),
        (4, "FORECAST_REVIEW", teams, "SCHEDULED", scheduled("Forecast review")),
        *[
            (4, "BU_SIGNOFF", F.lit(f"{b.name} CFO"), "PENDING", f"Final data sign-off required from {b.name}")
            for b in cfg.business_units
        ],
    ]
    structs = [F.struct(*request(p, k, who, status, F.lit(text))) for p, k, who, status, text in regular]
    per_period = _periods(ledger).select("closure_period", F.inline(F.array(*structs)))
    review = F.concat(F.col("adjustments").cast("string"), F.lit(" adjustments >$100K require approval"))
    large = large_adjustments(cuts, cfg=cfg).filter(F.col("adjustments") > 0).select(
        "closure_period", *request(2, "LARGE_ADJUSTMENT_REVIEW", F.lit("Controller"), "PENDING", review)
    )
    return per_period.unionByName(large)


def pending_condition(period: str | None = None, approval_type: str = "BU_SIGNOFF") -> Column:
    condition = (F.col("approval_type") == approval_type) & (F.col("status") == "PENDING")
    return condition if period is None else condition & (F.col("closure_period") == period)


def approvals_pending(approvals: DataFrame, period: str | None = None, approval_type: str = "BU_SIGNOFF") -> DataFrame:
    return approvals.filter(pending_condition(period, approval_type)).select(
        "closure_period", "approval_type", "required_approver", "status"
    )


def approve_pending(
    approvals: DataFrame,
    at: str,
    period: str | None = None,
    approval_type: str = "BU_SIGNOFF",
    note: str = " - Auto-approved for demo",
) -> DataFrame:
    """All approvals, with the pending ones of a type approved at ``at`` and their comment extended."""
    hit = F.coalesce(pending_condition(period, approval_type), F.lit(False))
    approved_at = F.col("approved_at") if "approved_at" in approvals.columns else F.lit(None).cast("timestamp")
    return approvals.withColumns(
        {
            "status": F.when(hit, "APPROVED").otherwise(F.col("status")),
            "approved_at": F.when(hit, F.lit(at).cast("timestamp")).otherwise(approved_at),
            "comments": F.when(hit, F.concat("comments", F.lit(note))).otherwise(F.col("comments")),
        }
    )
