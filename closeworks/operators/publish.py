"""Preliminary and final results, KPIs and their first reports.

Results are keyed by closure period, so one plan covers one month (the inputs are
filtered, the prior month comes from the published table) or the whole history (the
prior month comes from the same plan).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from closeworks.config import DEFAULT_CONFIG, CloseConfig, bu_dim
from closeworks.functions.exprs import (
    account_category,
    amount_of,
    in_period,
    margin_percent,
    mean,
    percent_of,
    percent_or_zero,
    period_shift,
    period_start,
    total,
    unit_sum,
)
from closeworks.operators.controls import valid_rows
from closeworks.operators.ledger import segment_pivot
from closeworks.operators.lookup import join_dimension

KEY = ["closure_period", "bu_code", "account_code"]

# --- versions ---------------------------------------------------------------


def _highest_versions(published: DataFrame) -> DataFrame:
    return published.groupBy("closure_period").agg(F.max("version").alias("_highest"))


def _next_version() -> Column:
    return (F.coalesce("_highest", F.lit(0)) + 1).cast("int").alias("version")


def next_version(periods: DataFrame, published: DataFrame) -> DataFrame:
    """Version a new publication of each period gets: one above the highest published, else 1."""
    wanted = periods.select("closure_period").distinct()
    return wanted.join(_highest_versions(published), "closure_period", "left").select(
        "closure_period", _next_version()
    )


def latest_version(results: DataFrame) -> DataFrame:
    """Rows of the highest version of each period."""
    highest = results.groupBy("closure_period").agg(F.max("version").alias("version"))
    return results.join(highest, ["closure_period", "version"], "left_semi")


# --- prior period -----------------------------------------------------------


def prior_amounts(results: DataFrame, amount: str, months_back: int = 1) -> DataFrame:
    """Amount per (bu, account) under the period that compares with it, as ``prior_period_amount``.

    Keyed by the later period: the row of 1997-05 is found under 1997-06.
    """
    later = F.coalesce(period_shift("closure_period", months_back), F.lit(""))
    return (
        results.groupBy(*KEY)
        .agg(F.max(amount).alias("prior_period_amount"))
        .withColumn("closure_period", later)
    )


def with_prior_in_place(results: DataFrame, amount: str, months_back: int = 1) -> DataFrame:
    """Add ``prior_period_amount`` from the same frame, which has one row per (period, bu, account).

    A window per (bu, account) holds one row per period, and its frame is exactly the
    month ``months_back`` earlier, so a gap in the history gives NULL.
    """
    start = period_start("closure_period")
    months = (F.year(start) * 12 + F.month(start)).alias("_month")
    frame = Window.partitionBy("bu_code", "account_code").orderBy(months).rangeBetween(-months_back, -months_back)
    return results.withColumn("prior_period_amount", F.max(amount).over(frame))


def _difference(amount: str, base: str) -> Column:
    return F.when(F.col(base).isNotNull(), F.col(amount) - F.col(base))


def _zero(c: str | Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def _keyed(rows: DataFrame) -> DataFrame:
    """State that the key is not NULL, as it is in every valid ledger row.

    A join on the key would add this condition to one side only. With both sides equal up
    to their first shuffle, Spark runs that part once, so the ledger is read once.
    """
    return rows.filter(" AND ".join(f"{k} IS NOT NULL" for k in KEY))


# --- balances ---------------------------------------------------------------

#: What a balance is kept for. The currency is a part of it, so that the first one can be named.
BALANCE = [*KEY, "bu_name", "account_description", "local_currency"]


def account_balances(ledger: DataFrame, period: str | None = None, more: tuple[str, ...] = ()) -> DataFrame:
    """Sums of the valid ledger in whole units, ``_amount``, with the number of lines, per ``BALANCE`` and ``more``.

    Sums of parts can be added up in any order: balances of loads together are those of all their lines.
    """
    return (
        _keyed(valid_rows(ledger, period))
        .groupBy(*BALANCE, *more)
        .agg(unit_sum("usd_amount").cast("decimal(38,0)").alias("_amount"), F.count("*").alias("_lines"))
    )


# --- preliminary results ----------------------------------------------------


def preliminary_results(
    ledger: DataFrame,
    period: str | None = None,
    published: DataFrame | None = None,
    months_back: int = 1,
) -> DataFrame:
    """Account balances of the valid ledger with the change against the prior period.

    ``published`` is the table of earlier results: it supplies prior amounts (latest
    version of each period) and the next version number. Without it prior amounts come
    from the earlier periods of this plan (none, if it is about one period), and the
    version is 1.
    """
    # The currency is a grouping key at first and a minimum only over the few groups left: a
    # minimum of text on the lines themselves would make Spark sort them.
    by_currency = (
        _keyed(valid_rows(ledger, period))
        .groupBy(*BALANCE)
        .agg(unit_sum("usd_amount").alias("_amount"))
    )
    return preliminary_of_balances(by_currency, published, months_back)


def preliminary_of_balances(
    balances: DataFrame, published: DataFrame | None = None, months_back: int = 1
) -> DataFrame:
    """``preliminary_results`` from balances instead of lines; a balance may come in several rows."""
    current = balances.groupBy(*KEY, "bu_name", "account_description").agg(
        amount_of(F.sum("_amount")).alias("preliminary_amount"), F.min("local_currency").alias("currency")
    )
    if published is None:
        prior = prior_amounts(current, "preliminary_amount", months_back)
        joined = current.join(prior, KEY, "left").withColumn("version", F.lit(1))
    else:
        prior = prior_amounts(latest_version(published), "preliminary_amount", months_back)
        joined = (
            current.join(prior, KEY, "left")
            .join(_highest_versions(published), "closure_period", "left")
            .withColumn("version", _next_version())
        )
    variance = _difference("preliminary_amount", "prior_period_amount")
    return joined.select(
        "closure_period",
        "bu_code",
        "bu_name",
        "account_code",
        "account_description",
        account_category().alias("account_category"),
        "preliminary_amount",
        "currency",
        F.col("preliminary_amount").alias("usd_amount"),
        _zero("prior_period_amount").alias("prior_period_amount"),
        _zero(variance).alias("variance_amount"),
        _zero(percent_of(variance, F.col("prior_period_amount"))).alias("variance_percent"),
        "version",
    )


def prelim_category_summary(results: DataFrame, period: str | None = None) -> DataFrame:
    return (
        in_period(results, period)
        .groupBy("closure_period", "account_category")
        .agg(
            total("preliminary_amount").alias("total_amount"),
            mean("variance_percent").alias("avg_variance_pct"),
        )
    )


def prelim_by_bu(results: DataFrame, period: str | None = None) -> DataFrame:
    """Latest version by unit and category."""
    sums = (
        latest_version(in_period(results, period))
        .groupBy("closure_period", "bu_name", "account_category")
        .agg(
            total("preliminary_amount").alias("total_amount"),
            total("prior_period_amount").alias("total_prior"),
            total("variance_amount").alias("total_variance"),
        )
    )
    return sums.withColumn(
        "variance_pct", percent_or_zero(F.col("total_variance"), F.col("total_prior"))
    ).orderBy("closure_period", "bu_name", "account_category")


def top_variances(
    results: DataFrame, period: str, k: int = 20, cfg: CloseConfig = DEFAULT_CONFIG
) -> DataFrame:
    """The ``k`` largest material changes of a period, ties broken by unit and account."""
    return (
        latest_version(in_period(results, period))
        .filter(F.abs("variance_amount") > cfg.material_variance)
        .orderBy(F.abs("variance_amount").desc(), "bu_code", "account_code", "account_description")
        .limit(k)
        .select(
            "bu_name",
            "account_description",
            "account_category",
            "preliminary_amount",
            "prior_period_amount",
            "variance_amount",
            "variance_percent",
        )
    )


# --- final results ----------------------------------------------------------


def adjustments_by_account(cuts: DataFrame, period: str | None = None) -> DataFrame:
    return valid_rows(cuts, period).groupBy(*KEY).agg(total("usd_amount").alias("adjustments_amount"))


def forecast_by_account(forecasts: DataFrame, period: str | None = None) -> DataFrame:
    """Forecast for a period, whichever close it was validated in."""
    return (
        in_period(forecasts.filter(F.col("is_validated")), period, "forecast_period")
        .groupBy(F.col("forecast_period").alias("closure_period"), "bu_code", "account_code")
        .agg(total("usd_amount").alias("forecast_amount"))
    )


def final_results(
    ledger: DataFrame,
    cuts: DataFrame,
    segments: DataFrame,
    forecasts: DataFrame,
    period: str | None = None,
    published: DataFrame | None = None,
    months_back: int = 1,
    cfg: CloseConfig = DEFAULT_CONFIG,
    approved_by: str = "system",
    balances: DataFrame | None = None,
) -> DataFrame:
    """Ledger plus adjustments per (period, bu, account), with segments, forecast and prior period.

    Every side is aggregated to the key first; the joins then see a few rows per
    period, cannot multiply amounts, and all use the same partitioning. ``published``
    holds earlier final results; without it the prior period comes from this plan. With ``balances``
    (see ``account_balances``) the lines of the ledger are not read.
    """
    by_description = (
        in_period(balances, period)
        if balances is not None
        else valid_rows(ledger, period)
        .groupBy(*KEY, "bu_name", "account_description")
        .agg(unit_sum("usd_amount").alias("_amount"))
    )
    accounts = by_description.groupBy(*KEY).agg(
        amount_of(F.sum("_amount")).alias("preliminary_amount"),
        F.min("bu_name").alias("bu_name"),
        F.min("account_description").alias("_description"),
    )
    combined = (
        accounts.join(adjustments_by_account(cuts, period), KEY, "left")
        .join(segment_pivot(in_period(segments, period), cfg), KEY, "left")
        .join(forecast_by_account(forecasts, period), KEY, "left")
        .withColumn("final_amount", _zero("preliminary_amount") + _zero("adjustments_amount"))
    )
    if published is None:
        combined = with_prior_in_place(combined, "final_amount", months_back)
    else:
        prior = prior_amounts(published.filter(F.col("is_final")), "final_amount", months_back)
        combined = combined.join(prior, KEY, "left")
    # One description per account and period, whichever unit it comes from. A window of one
    # account and period holds one row per unit.
    one_account = Window.partitionBy("closure_period", "account_code")
    combined = combined.withColumn("account_description", F.min("_description").over(one_account))
    regions = bu_dim(ledger.sparkSession, cfg).select("bu_code", "region")
    yoy = _difference("final_amount", "prior_period_amount")
    segment_columns = [f"segment_{t.lower()}" for t in cfg.segment_types]
    return join_dimension(combined, regions, "bu_code").select(
        "closure_period",
        "bu_code",
        "bu_name",
        "region",
        "account_code",
        "account_description",
        account_category().alias("account_category"),
        *[F.coalesce(c, F.lit("Unallocated")).alias(c) for c in segment_columns],
        _zero("preliminary_amount").alias("preliminary_amount"),
        _zero("adjustments_amount").alias("adjustments_amount"),
        "final_amount",
        F.lit(cfg.base_currency).alias("currency"),
        F.col("final_amount").alias("usd_amount"),
        "forecast_amount",
        _zero(_difference("final_amount", "forecast_amount")).alias("forecast_variance"),
        _zero("prior_period_amount").alias("prior_period_amount"),
        _zero(yoy).alias("yoy_variance"),
        _zero(percent_of(yoy, F.col("prior_period_amount"))).alias("yoy_variance_percent"),
        F.lit(True).alias("is_final"),
        F.lit(approved_by).alias("approved_by"),
    )


def final_by_bu(results: DataFrame, period: str | None = None) -> DataFrame:
    return (
        in_period(results, period)
        .groupBy("closure_period", "bu_name", "account_category")
        .agg(
            total("preliminary_amount").alias("preliminary"),
            total("adjustments_amount").alias("adjustments"),
            total("final_amount").alias("final_amount"),
            total("forecast_amount").alias("forecast"),
            total("forecast_variance").alias("vs_forecast"),
            total("prior_period_amount").alias("prior_period"),
            total("yoy_variance").alias("yoy_variance"),
        )
        .orderBy("closure_period", "bu_name", "account_category")
    )


def final_listing(results: DataFrame, period: str | None = None) -> DataFrame:
    return in_period(results.filter(F.col("is_final")), period).orderBy(
        "bu_name", "account_category", "closure_period", "account_code"
    )


# --- KPIs -------------------------------------------------------------------


def kpi_metrics(
    results: DataFrame,
    period: str | None = None,
    targets: DataFrame | None = None,
    cfg: CloseConfig = DEFAULT_CONFIG,
) -> DataFrame:
    """Company KPIs and revenue per unit, for every period of the results.

    Margins use the absolute value of the summed costs. ``targets`` may give
    (metric_name, bu_code, target_value).
    """
    is_revenue = F.col("account_category") == "Revenue"

    def sum_of(condition: Column) -> Column:
        return _zero(total(F.when(condition, F.col("final_amount"))))

    sums = (
        in_period(results, period)
        .groupBy("closure_period")
        .agg(
            sum_of(is_revenue).alias("_revenue"),
            F.abs(sum_of(F.col("account_category") == "COGS")).alias("_cogs"),
            F.abs(sum_of(F.col("account_category") == "OpEx")).alias("_opex"),
            # A configured unit without results still gets its row, with revenue 0.
            *[
                sum_of(is_revenue & (F.col("bu_code") == b.code)).alias(f"_bu{i}")
                for i, b in enumerate(cfg.business_units)
            ],
        )
    )
    revenue, cogs, opex = F.col("_revenue"), F.col("_cogs"), F.col("_opex")

    def kpi(name: str, kind: str, value: Column, bu: str = "ALL", region: str = "Global") -> Column:
        return F.struct(
            F.lit(name).alias("metric_name"),
            F.lit(kind).alias("metric_category"),
            value.alias("metric_value"),
            F.lit(bu).alias("bu_code"),
            F.lit(region).alias("region"),
        )

    kpis = sums.select(
        "closure_period",
        F.inline(
            F.array(
                kpi("Total Revenue", "Revenue", revenue),
                kpi("Gross Margin %", "Profitability", _zero(margin_percent(revenue - cogs, revenue))),
                kpi("Operating Margin %", "Profitability", _zero(margin_percent(revenue - cogs - opex, revenue))),
                *[
                    kpi("Revenue", "Revenue", F.col(f"_bu{i}"), b.code, b.region)
                    for i, b in enumerate(cfg.business_units)
                ],
            )
        ),
    )
    if targets is None:
        kpis = kpis.withColumn("target_value", F.lit(None).cast("double"))
    else:
        kpis = kpis.join(targets.select("metric_name", "bu_code", "target_value"), ["metric_name", "bu_code"], "left")
    return kpis.select(
        "closure_period",
        "metric_name",
        "metric_category",
        "metric_value",
        "target_value",
        (F.col("metric_value") - F.col("target_value")).alias("variance_from_target"),
        "bu_code",
        "region",
    )


def kpi_order() -> list[Column]:
    """Company figures first, then by unit."""
    return [F.when(F.col("bu_code") == "ALL", 0).otherwise(1), F.col("bu_code")]


def kpi_scope() -> Column:
    return F.when(F.col("bu_code") == "ALL", "Global").otherwise(F.col("bu_code"))


def kpi_listing(kpis: DataFrame, period: str | None = None) -> DataFrame:
    return (
        in_period(kpis, period)
        .orderBy("closure_period", *kpi_order(), "metric_name")
        .select(
            "closure_period",
            "metric_name",
            kpi_scope().alias("scope"),
            "metric_category",
            F.round("metric_value", 2).alias("value"),
            F.round("target_value", 2).alias("target"),
            F.round("variance_from_target", 2).alias("variance"),
        )
    )

