"""Financial metrics over final results, dataset summaries and cycle status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closeworks.functions.exprs import (
    RATE,
    account_category,
    amount_of,
    banded,
    category_rank,
    in_period,
    margin_percent,
    mean,
    percent_of,
    percent_or_zero,
    phase_name,
    total,
    total_when,
    unit_sum,
)
from closeworks.operators.controls import valid_rows


def _final(results: DataFrame, period: str | None) -> DataFrame:
    return in_period(results.filter(F.col("is_final")), period)


def _income_sums(with_opex: bool) -> list[Column]:
    """Revenue as it is, costs as sums of absolute amounts."""
    category, amount = F.col("account_category"), F.col("final_amount")
    sums = [
        total_when(category == "Revenue", amount).alias("revenue"),
        total_when(category == "COGS", F.abs(amount)).alias("cogs"),
    ]
    return sums + ([total_when(category == "OpEx", F.abs(amount)).alias("opex")] if with_opex else [])


def _gross() -> dict[str, Column]:
    profit = F.col("revenue") - F.col("cogs")
    return {"gross_profit": profit, "gross_margin_pct": margin_percent(profit, F.col("revenue"))}


def _operating() -> dict[str, Column]:
    income = F.col("revenue") - F.col("cogs") - F.col("opex")
    return {"operating_income": income, "operating_margin_pct": margin_percent(income, F.col("revenue"))}


def financial_summary(results: DataFrame, period: str | None = None) -> DataFrame:
    """Income statement of each period; margins are NULL without revenue."""
    return (
        _final(results, period)
        .groupBy("closure_period")
        .agg(*_income_sums(with_opex=True))
        .withColumns({**_gross(), **_operating()})
        .withColumnsRenamed({"revenue": "total_revenue", "cogs": "total_cogs", "opex": "total_opex"})
    )


def exec_summary(results: DataFrame, period: str | None = None) -> DataFrame:
    """Income statement with coverage; margins are 0 without revenue."""
    profit = F.col("total_revenue") - F.col("total_cogs")
    income = profit - F.col("total_opex")
    zero = F.lit(0.0)
    return (
        _final(results, period)
        .groupBy("closure_period")
        .agg(
            *_income_sums(with_opex=True),
            F.countDistinct("bu_code").alias("bu_count"),
            F.count("*").alias("total_records"),
        )
        .withColumnsRenamed({"revenue": "total_revenue", "cogs": "total_cogs", "opex": "total_opex"})
        .withColumns(
            {
                "gross_profit": profit,
                "gross_margin_pct": F.coalesce(margin_percent(profit, F.col("total_revenue")), zero),
                "operating_income": income,
                "operating_margin_pct": F.coalesce(margin_percent(income, F.col("total_revenue")), zero),
            }
        )
    )


def bu_revenue(results: DataFrame, period: str | None = None) -> DataFrame:
    return (
        _final(results, period)
        .groupBy("closure_period", "bu_name", "region")
        .agg(*_income_sums(with_opex=False))
        .withColumns(_gross())
        .orderBy("closure_period", F.desc("revenue"), "bu_name")
    )


def product_performance(results: DataFrame, period: str | None = None) -> DataFrame:
    return (
        _final(results, period)
        .filter(F.col("segment_product") != "Unallocated")
        .groupBy("closure_period", "segment_product")
        .agg(*_income_sums(with_opex=False))
        .withColumns(_gross())
        .orderBy("closure_period", F.desc("revenue"), "segment_product")
    )


# Accuracy bands, in percent of the forecast.
METRIC_ACCURACY = ((5, "Excellent"), (10, "Good"), (15, "Fair"))


def forecast_sums() -> list[Column]:
    return [
        total("final_amount").alias("actual"),
        total("forecast_amount").alias("forecast"),
        total("forecast_variance").alias("variance"),
    ]


def forecast_rating(bands: tuple, otherwise: str) -> Column:
    """Band of the absolute variance percent; a zero forecast falls into the last band."""
    return banded(F.abs(percent_of(F.col("variance"), F.col("forecast"))), bands, otherwise, strict=False)


def forecast_accuracy(results: DataFrame, period: str | None = None) -> DataFrame:
    return (
        _final(results, period)
        .filter(F.col("forecast_amount").isNotNull())
        .groupBy("closure_period", "bu_name", "account_category")
        .agg(*forecast_sums())
        .withColumns(
            {
                "variance_pct": percent_or_zero(F.col("variance"), F.col("forecast")),
                "accuracy_rating": forecast_rating(METRIC_ACCURACY, "Poor"),
            }
        )
        .orderBy("closure_period", "bu_name", "account_category")
    )


def yoy_comparison(results: DataFrame, period: str | None = None) -> DataFrame:
    """By category, in report order (``category_rank``)."""
    return (
        _final(results, period)
        .groupBy("closure_period", "account_category")
        .agg(
            total("final_amount").alias("current_period"),
            total("prior_period_amount").alias("prior_period"),
            total("yoy_variance").alias("variance"),
        )
        .withColumns(
            {
                "variance_pct": percent_or_zero(F.col("variance"), F.col("prior_period")),
                "category_rank": category_rank(),
            }
        )
        .orderBy("closure_period", "category_rank", "account_category")
    )


# --- datasets ---------------------------------------------------------------

# Dataset titles in reports.
DATASET_TITLES = {
    "exchange_rates": "Exchange Rates",
    "bu_preliminary_close": "Preliminary Close",
    "accounting_cuts": "Accounting Cuts",
    "segmented_files": "Segmented Files",
    "forecast_files": "Forecast Files",
}


def data_completeness(datasets: dict[str, DataFrame], period: str | None = None) -> DataFrame:
    """Valid rows of every dataset in every period; a dataset without any is Missing.

    Each dataset is reduced to one row per period before the union.
    """
    names = list(datasets)
    counted = None
    for name in names:
        rows = (
            in_period(datasets[name], period)
            .groupBy("closure_period")
            .agg(F.count_if("is_validated").alias("_valid"))
            .select("closure_period", F.lit(name).alias("_name"), "_valid")
        )
        counted = rows if counted is None else counted.unionByName(rows)
    wide = (
        counted.filter(F.col("closure_period").isNotNull())
        .groupBy("closure_period")
        .agg(*[F.sum(F.when(F.col("_name") == n, F.col("_valid")).otherwise(0)).alias(n) for n in names])
    )
    rows = F.array(
        *[F.struct(F.lit(DATASET_TITLES[n]).alias("dataset"), F.col(n).alias("record_count")) for n in names]
    )
    return wide.select("closure_period", F.inline(rows)).withColumn(
        "status", F.when(F.col("record_count") > 0, "Complete").otherwise("Missing")
    )


def dataset_counts(datasets: dict[str, DataFrame], final_only: tuple[str, ...] = ("final_results",)) -> DataFrame:
    """Rows per dataset and period; of final results only the final ones."""
    out = None
    for name, df in datasets.items():
        scoped = df.filter(F.col("is_final")) if name in final_only else df
        rows = scoped.groupBy("closure_period").agg(F.count("*").alias("records"))
        rows = rows.select(F.lit(name).alias("dataset"), "closure_period", "records")
        out = rows if out is None else out.unionByName(rows)
    return out


def ledger_by_bu(ledger: DataFrame, period: str | None = None) -> DataFrame:
    return (
        in_period(ledger, period)
        .groupBy("bu_code", "bu_name", "local_currency")
        .agg(
            F.count("*").alias("record_count"),
            total("local_amount").alias("total_local"),
            total("usd_amount").alias("total_usd"),
            F.count_if("is_validated").alias("valid_records"),
            F.count_if(~F.col("is_validated")).alias("invalid_records"),
        )
        .orderBy("bu_code", "local_currency")
    )


def cuts_summary(cuts: DataFrame, period: str | None = None) -> DataFrame:
    """Per cut: rows, total, average, distinct units and types, valid rows.

    Rows are combined per (cut, bu, type) first, so the distinct counts run over the
    few combinations instead of expanding every row once per distinct column.
    """
    combos = (
        in_period(cuts, period)
        .groupBy("cut_number", "bu_code", "adjustment_type")
        .agg(
            F.count("*").alias("_rows"),
            F.count("usd_amount").alias("_amounts"),
            unit_sum("usd_amount").alias("_sum"),
            F.count_if("is_validated").alias("_valid"),
        )
    )
    return (
        combos.groupBy("cut_number")
        .agg(
            F.sum("_rows").alias("adjustment_count"),
            amount_of(F.sum("_sum")).alias("total_usd_adjustments"),
            F.try_divide(amount_of(F.sum("_sum")), F.sum("_amounts")).alias("avg_usd_adjustment"),
            F.countDistinct("bu_code").alias("bu_count"),
            F.countDistinct("adjustment_type").alias("adjustment_types"),
            F.sum("_valid").alias("valid_count"),
        )
        .orderBy("cut_number")
    )


def cuts_by_bu(cuts: DataFrame, period: str | None = None) -> DataFrame:
    by_type = (
        valid_rows(cuts, period)
        .groupBy("bu_code", "cut_number", "adjustment_type")
        .agg(F.count("*").alias("_rows"), unit_sum("usd_amount").alias("_sum"))
    )
    return (
        by_type.groupBy("bu_code", "cut_number")
        .agg(
            F.sum("_rows").alias("adjustment_count"),
            amount_of(F.sum("_sum")).alias("total_usd_adjustments"),
            F.count("adjustment_type").alias("adjustment_types"),
        )
        .orderBy("bu_code", "cut_number")
    )


def segments_by_type(segments: DataFrame, period: str | None = None) -> DataFrame:
    by_value = (
        valid_rows(segments, period)
        .groupBy("segment_type", "segment_value")
        .agg(
            F.count("*").alias("_rows"),
            F.count("usd_amount").alias("_amounts"),
            unit_sum("usd_amount").alias("_sum"),
        )
    )
    return (
        by_value.groupBy("segment_type")
        .agg(
            F.sum("_rows").alias("record_count"),
            F.count("segment_value").alias("unique_values"),
            amount_of(F.sum("_sum")).alias("total_usd"),
            F.try_divide(amount_of(F.sum("_sum")), F.sum("_amounts")).alias("avg_usd"),
        )
        .orderBy("segment_type")
    )


def segments_by_bu(segments: DataFrame, period: str | None = None) -> DataFrame:
    combos = (
        valid_rows(segments, period)
        .groupBy("bu_code", "segment_type", "account_code")
        .agg(F.count("*").alias("_rows"), unit_sum("usd_amount").alias("_sum"))
    )
    return (
        combos.groupBy("bu_code")
        .agg(
            F.sum("_rows").alias("record_count"),
            F.countDistinct("segment_type").alias("segment_types"),
            F.countDistinct("account_code").alias("accounts"),
            amount_of(F.sum("_sum")).alias("total_usd"),
        )
        .orderBy("bu_code")
    )


def _forecast_by_bu(forecasts: DataFrame, amount: str, alias: str) -> DataFrame:
    combos = forecasts.groupBy("bu_code", "currency", "forecast_period", "account_code").agg(
        F.count("*").alias("_rows"), unit_sum(amount).alias("_sum")
    )
    return (
        combos.groupBy("bu_code", "currency")
        .agg(
            F.sum("_rows").alias("forecast_count"),
            F.countDistinct("forecast_period").alias("periods"),
            F.countDistinct("account_code").alias("accounts"),
            amount_of(F.sum("_sum")).alias(alias),
        )
        .orderBy("bu_code", "currency")
    )


def forecast_by_bu(forecasts: DataFrame, period: str | None = None) -> DataFrame:
    return _forecast_by_bu(valid_rows(forecasts, period), "usd_amount", "total_forecast_usd")


def forecast_trend(forecasts: DataFrame, period: str | None = None) -> DataFrame:
    amount = F.col("usd_amount")
    return (
        valid_rows(forecasts, period)
        .groupBy("forecast_period")
        .agg(
            total_when(amount > 0, amount).alias("revenue_forecast"),
            total_when(amount < 0, amount).alias("cost_forecast"),
            total("usd_amount").alias("net_forecast"),
        )
        .orderBy("forecast_period")
    )


# --- raw landing reports ----------------------------------------------------


def raw_fx_stats(raw: DataFrame) -> DataFrame:
    return (
        raw.groupBy("currency")
        .agg(
            F.count("*").alias("record_count"),
            F.min("rate").alias("min_rate"),
            F.max("rate").alias("max_rate"),
            mean("rate", RATE).alias("avg_rate"),
            F.stddev_samp("rate").alias("stddev_rate"),
            F.min("rate_date").alias("earliest_date"),
            F.max("rate_date").alias("latest_date"),
        )
        .orderBy("currency")
    )


def raw_ledger_by_bu(raw: DataFrame, bu_codes: list[str]) -> DataFrame:
    combos = (
        raw.filter(F.col("bu_code").isin(bu_codes))
        .groupBy("bu_code", "local_currency", "account_code", "cost_center")
        .agg(
            F.count("*").alias("_rows"),
            F.count("local_amount").alias("_amounts"),
            unit_sum("local_amount").alias("_sum"),
        )
    )
    return (
        combos.groupBy("bu_code", "local_currency")
        .agg(
            F.sum("_rows").alias("record_count"),
            amount_of(F.sum("_sum")).alias("total_amount"),
            F.try_divide(amount_of(F.sum("_sum")), F.sum("_amounts")).alias("avg_amount"),
            F.countDistinct("account_code").alias("unique_accounts"),
            F.countDistinct("cost_center").alias("unique_cost_centers"),
        )
        .orderBy("bu_code", "local_currency")
    )


def raw_ledger_by_category(raw: DataFrame, bu_codes: list[str]) -> DataFrame:
    category = account_category(other="Unknown")
    return (
        raw.filter(F.col("bu_code").isin(bu_codes))
        .groupBy(category.alias("category"))
        .agg(F.count("*").alias("record_count"), total("local_amount").alias("total_amount"))
        .orderBy("category")
    )


def raw_cuts_by_cut(raw: DataFrame) -> DataFrame:
    combos = raw.groupBy("cut_number", "bu_code", "adjustment_type").agg(
        F.count("*").alias("_rows"),
        F.count("adjustment_amount").alias("_amounts"),
        unit_sum("adjustment_amount").alias("_sum"),
    )
    return (
        combos.groupBy("cut_number")
        .agg(
            F.sum("_rows").alias("adjustment_count"),
            amount_of(F.sum("_sum")).alias("total_adjustments"),
            F.try_divide(amount_of(F.sum("_sum")), F.sum("_amounts")).alias("avg_adjustment"),
            F.countDistinct("bu_code").alias("bu_count"),
            F.countDistinct("adjustment_type").alias("adjustment_types"),
        )
        .orderBy("cut_number")
    )


def raw_cuts_by_bu(raw: DataFrame) -> DataFrame:
    return (
        raw.groupBy("bu_code", "cut_number", "currency")
        .agg(
            F.count("*").alias("adjustment_count"),
            total("adjustment_amount").alias("total_adjustments"),
            mean("adjustment_amount").alias("avg_adjustment"),
        )
        .orderBy("bu_code", "cut_number", "currency")
    )


def raw_cuts_by_type(raw: DataFrame) -> DataFrame:
    return (
        raw.groupBy("adjustment_type", "cut_number")
        .agg(F.count("*").alias("records"), total("adjustment_amount").alias("total_amount"))
        .orderBy("adjustment_type", "cut_number")
    )


def raw_segments_by_type(raw: DataFrame) -> DataFrame:
    combos = raw.groupBy("segment_type", "segment_value", "bu_code").agg(
        F.count("*").alias("_rows"), unit_sum("amount").alias("_sum")
    )
    return (
        combos.groupBy("segment_type")
        .agg(
            F.sum("_rows").alias("record_count"),
            F.countDistinct("segment_value").alias("unique_values"),
            amount_of(F.sum("_sum")).alias("total_amount"),
            F.countDistinct("bu_code").alias("bu_count"),
        )
        .orderBy("segment_type")
    )


def raw_segments_by_bu(raw: DataFrame) -> DataFrame:
    by_type = raw.groupBy("bu_code", "currency", "segment_type").agg(
        F.count("*").alias("_rows"), unit_sum("amount").alias("_sum")
    )
    return (
        by_type.groupBy("bu_code", "currency")
        .agg(
            F.sum("_rows").alias("record_count"),
            F.count("segment_type").alias("segment_types"),
            amount_of(F.sum("_sum")).alias("total_amount"),
        )
        .orderBy("bu_code", "currency")
    )


def raw_segments_by_product(raw: DataFrame) -> DataFrame:
    return (
        raw.filter(F.col("segment_type") == "Product")
        .groupBy(F.col("segment_value").alias("product"))
        .agg(
            F.count("*").alias("record_count"),
            total("amount").alias("total_amount"),
            mean("amount").alias("avg_amount"),
        )
        .orderBy(F.desc("total_amount"), "product")
    )


def raw_forecast_by_bu(raw: DataFrame) -> DataFrame:
    return _forecast_by_bu(raw, "forecast_amount", "total_forecast")


def raw_forecast_trend(raw: DataFrame) -> DataFrame:
    amount = F.col("forecast_amount")
    return (
        raw.groupBy("forecast_period")
        .agg(
            total_when(amount > 0, amount).alias("total_revenue"),
            total_when(amount < 0, amount).alias("total_costs"),
            total("forecast_amount").alias("net_income"),
        )
        .orderBy("forecast_period")
    )


def raw_forecast_fx_summary(raw: DataFrame) -> DataFrame:
    """Per currency. Combined per date first: dates may be text, and Spark sorts for a minimum of text."""
    date = "forecast_month" if "forecast_month" in raw.columns else "forecast_date"
    by_date = raw.groupBy("currency", date).agg(
        F.count("*").alias("_rows"),
        F.count("forecast_rate").alias("_rates"),
        F.min("forecast_rate").alias("_min"),
        F.max("forecast_rate").alias("_max"),
        unit_sum("forecast_rate", RATE).alias("_sum"),
    )
    return (
        by_date.groupBy("currency")
        .agg(
            F.sum("_rows").alias("forecast_count"),
            F.min("_min").alias("min_rate"),
            F.max("_max").alias("max_rate"),
            F.try_divide(amount_of(F.sum("_sum"), RATE), F.sum("_rates")).alias("avg_rate"),
            F.min(date).alias("first_date"),
            F.max(date).alias("last_date"),
        )
        .orderBy("currency")
    )


def raw_preview(
    raw: DataFrame, columns: list[str], n: int = 50, newest: str | None = None, first: list[str] | None = None
) -> DataFrame:
    """Some landed rows: newest by a date, or in the order of ``first``; ties follow the other columns."""
    lead = [F.desc(newest)] if newest else []
    rest = [c for c in dict.fromkeys([*(first or []), *columns]) if c != newest]
    return raw.select(*columns).orderBy(*lead, *[F.asc_nulls_first(c) for c in rest]).limit(n)


def raw_recent_rates(raw: DataFrame, as_of: str, days: int = 7, n: int = 50) -> DataFrame:
    recent = raw.filter(F.col("rate_date") >= F.date_sub(F.lit(as_of).cast("date"), days))
    columns = ["currency", "rate_date", "rate", "source", "loaded_at"]
    return raw_preview(recent, columns, n, newest="rate_date", first=["currency"])


# --- cycle status -----------------------------------------------------------


def recent_periods(status: DataFrame, n: int = 6) -> DataFrame:
    return status.select("closure_period").distinct().orderBy(F.desc("closure_period")).limit(n)


def cycle_state(as_of: str, labels: tuple[str, str, str] = ("COMPLETED", "OVERDUE", "IN_PROGRESS")) -> Column:
    """Completed, overdue or in progress as of a point in time."""
    done, late, running = labels
    return (
        F.when(F.col("actual_completion").isNotNull(), done)
        .when(F.col("expected_completion").cast("timestamp") < F.lit(as_of).cast("timestamp"), late)
        .otherwise(running)
    )


def days_elapsed(as_of: str) -> Column:
    """Days from start to completion, or to ``as_of`` while the cycle runs."""
    end = F.coalesce(F.col("actual_completion").cast("date"), F.lit(as_of).cast("date"))
    return F.datediff(end, F.col("started_at").cast("date"))


def _newest_first(status: DataFrame) -> list[Column]:
    return [F.desc("started_at"), F.desc("closure_id")]


def cycle_status(status: DataFrame, period: str, as_of: str) -> DataFrame:
    """Newest status row of a period."""
    return (
        in_period(status, period)
        .orderBy(*_newest_first(status))
        .limit(1)
        .select(
            "closure_period",
            "current_phase",
            phase_name("current_phase").alias("phase_name"),
            "phase_status",
            "started_at",
            "expected_completion",
            "actual_completion",
            days_elapsed(as_of).alias("days_elapsed"),
            cycle_state(as_of).alias("status"),
        )
    )


def status_history(status: DataFrame, as_of: str, period: str | None = None) -> DataFrame:
    return (
        in_period(status, period)
        .orderBy(F.desc("closure_period"), *_newest_first(status))
        .select(
            "closure_period",
            "current_phase",
            "phase_status",
            "started_at",
            "actual_completion",
            days_elapsed(as_of).alias("days_elapsed"),
            "notes",
        )
    )


def newest_statuses(status: DataFrame, n: int = 5) -> DataFrame:
    return status.orderBy(*_newest_first(status)).limit(n)
