"""Processing of the four business-unit datasets: ledger, cuts, segments, forecasts.

Each ``process_*`` is a projection over the raw table: the joins are to broadcast
sides only, so rows are neither shuffled nor multiplied. Row ids and processing
times are added when a table is written (``closeworks.sources.tables.stamp``), which
keeps results comparable between runs.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from closeworks.config import DEFAULT_CONFIG, CloseConfig, bu_dim
from closeworks.functions.exprs import falsy_null, has_all, in_period, percent_of, total
from closeworks.operators.fx import missing_fx_condition, monthly_rates, to_usd, to_usd_monthly
from closeworks.operators.lookup import join_dimension


def bu_names(df: DataFrame, cfg: CloseConfig = DEFAULT_CONFIG) -> DataFrame:
    """Business-unit names; NULL for an unknown unit."""
    return join_dimension(df, bu_dim(df.sparkSession, cfg).select("bu_code", "bu_name"), "bu_code")


def bu_currency(df: DataFrame, cfg: CloseConfig = DEFAULT_CONFIG) -> DataFrame:
    """Add the unit's own currency (base currency for an unknown unit) and whether the unit exists."""
    joined = join_dimension(df, bu_dim(df.sparkSession, cfg).select("bu_code", "bu_currency"), "bu_code")
    return joined.withColumns(
        {
            "bu_exists": F.col("bu_currency").isNotNull(),
            "bu_currency": F.coalesce("bu_currency", F.lit(cfg.base_currency)),
        }
    )


# --- ledger -----------------------------------------------------------------


def issue_list(rules: list[tuple[str, Column]]) -> Column:
    """Texts of the rules that hold, as an array without NULLs or repeats."""
    return F.array_compact(F.array_distinct(F.array(*[F.when(cond, text) for text, cond in rules])))


def ledger_rules(cfg: CloseConfig = DEFAULT_CONFIG) -> list[tuple[str, Column]]:
    return [
        ("Missing BU code", F.col("bu_code").isNull()),
        ("Invalid BU code", ~F.col("bu_code").isin(cfg.bu_codes)),
        ("Missing account code", F.col("account_code").isNull()),
        ("Missing amount", F.col("local_amount").isNull()),
        ("Missing FX rate", missing_fx_condition("local_currency", cfg)),
        ("Missing period", F.col("period").isNull()),
    ]


def process_ledger(
    raw: DataFrame,
    rates: DataFrame,
    period: str | None = None,
    cfg: CloseConfig = DEFAULT_CONFIG,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Raw ledger to validated ledger in base currency; a row is valid when no rule holds. ``keep``: further raw columns.

    That is the same as an empty issue list, but as a plain condition it needs no array
    and parts of it reach the scan.
    """
    rules = ledger_rules(cfg)
    valid = functools.reduce(operator.and_, [~falsy_null(broken) for _, broken in rules])
    return to_usd(
        bu_names(in_period(raw, period, "period"), cfg), "local_amount", "local_currency", rates, cfg
    ).select(
        "bu_code",
        "bu_name",
        "account_code",
        "account_description",
        "local_currency",
        "local_amount",
        "usd_amount",
        "exchange_rate",
        "period",
        "cost_center",
        valid.alias("is_validated"),
        issue_list(rules).alias("validation_issues"),
        F.col("period").alias("closure_period"),
        *keep,
    )


# --- accounting cuts --------------------------------------------------------


def _known_bu(cfg: CloseConfig) -> Column:
    return F.col("bu_code").isin(cfg.bu_codes)


def _has_rate(currency: str, cfg: CloseConfig) -> Column:
    return (F.col(currency) == cfg.base_currency) | F.col("exchange_rate").isNotNull()


def process_cuts(
    raw: DataFrame,
    rates: DataFrame,
    period: str | None = None,
    cfg: CloseConfig = DEFAULT_CONFIG,
    approved_at: str | None = None,
) -> DataFrame:
    """Raw adjustments to validated ones; valid rows carry the automatic approval."""
    converted = to_usd(in_period(raw, period, "period"), "adjustment_amount", "currency", rates, cfg)
    valid = falsy_null(
        F.col("cut_number").isin(list(cfg.valid_cuts))
        & _known_bu(cfg)
        & F.col("account_code").isNotNull()
        & F.col("adjustment_amount").isNotNull()
        & _has_rate("currency", cfg)
    )
    checked = converted.withColumn("is_validated", valid)
    approval_time = F.lit(approved_at).cast("timestamp") if approved_at else F.current_timestamp()
    return checked.select(
        "cut_number",
        "bu_code",
        "account_code",
        "adjustment_type",
        "adjustment_amount",
        "currency",
        "usd_amount",
        "exchange_rate",
        "description",
        "period",
        F.when(F.col("is_validated"), "system_auto_approved").alias("approved_by"),
        F.when(F.col("is_validated"), approval_time).alias("approved_at"),
        "is_validated",
        F.col("period").alias("closure_period"),
    )


# --- segments ---------------------------------------------------------------


def process_segments(
    raw: DataFrame, rates: DataFrame, period: str | None = None, cfg: CloseConfig = DEFAULT_CONFIG
) -> DataFrame:
    converted = to_usd(in_period(raw, period, "period"), "amount", "currency", rates, cfg)
    valid = falsy_null(
        _known_bu(cfg)
        & F.col("account_code").isNotNull()
        & F.col("segment_type").isin(list(cfg.segment_types))
        & F.col("segment_value").isNotNull()
        & F.col("amount").isNotNull()
        & _has_rate("currency", cfg)
    )
    return converted.select(
        "bu_code",
        "account_code",
        "segment_type",
        "segment_value",
        "amount",
        "currency",
        "usd_amount",
        "exchange_rate",
        "period",
        valid.alias("is_validated"),
        F.col("period").alias("closure_period"),
    )


def segment_completeness(segments: DataFrame, cfg: CloseConfig = DEFAULT_CONFIG) -> DataFrame:
    """Per (bu, account): how many segment types there are, which, and which required ones lack.

    ``is_complete`` compares the number of types with the number required;
    ``segments_missing`` names the required ones that are not there.

    Repeats are removed before anything is collected: what reaches one group is the
    list of its distinct types, not its rows.
    """
    required = cfg.segment_types
    types = segments.select("bu_code", "account_code", "segment_type").distinct()
    return (
        types.groupBy("bu_code", "account_code")
        .agg(
            F.count("segment_type").alias("segment_count"),
            F.sort_array(F.collect_list("segment_type")).alias("segments_present"),
        )
        .withColumns(
            {
                "is_complete": F.col("segment_count") == len(required),
                "segments_missing": has_all(F.col("segments_present"), required),
            }
        )
    )


def segment_pivot(segments: DataFrame, cfg: CloseConfig = DEFAULT_CONFIG) -> DataFrame:
    """One row per (period, bu, account) with one column per segment type, e.g. ``segment_product``.

    Of several values the smallest is taken, so the result does not depend on row order.
    The rows are reduced to distinct values by hashing first; the minimum of text, for
    which Spark sorts, then sees those few only. There is no join per type.

    A plain ``distinct`` would not stay in the plan: Spark drops it below a minimum, which
    repeats do not change, and would sort all rows. The filter on the count, true for every
    group, keeps the hash aggregate.
    """
    key = ["closure_period", "bu_code", "account_code"]
    valid = segments.filter("is_validated")
    values = valid.groupBy(*key, "segment_type", "segment_value").agg(F.count("*").alias("_rows")).filter("_rows > 0")
    return values.groupBy(*key).agg(
        *[
            F.min(F.when(F.col("segment_type") == t, F.col("segment_value"))).alias(f"segment_{t.lower()}")
            for t in cfg.segment_types
        ]
    )


# --- forecasts --------------------------------------------------------------


def version_numbers(version: str) -> Column:
    """The numbers in a version, in order, so that v10 comes after v9."""
    return F.transform(F.regexp_extract_all(version, F.lit(r"(\d+)")), lambda x: x.cast("decimal(38,0)"))


def forecast_version_variance(forecasts: DataFrame, amount: str = "forecast_amount") -> DataFrame:
    """Change in percent of each forecast version against the one before it.

    One row per (bu, account, period, type, version); 0 for the first version. Versions are in
    the order of their numbers, those with equal numbers in the order of their text. The
    window runs over totals per version, never over forecast lines.
    """
    line = ["bu_code", "account_code", "forecast_period", "forecast_type"]
    prior = F.lag("version_amount").over(Window.partitionBy(*line).orderBy(version_numbers("version"), "version"))
    return (
        forecasts.groupBy(*line, "version")
        .agg(total(amount).alias("version_amount"))
        .withColumn("prior_version_amount", prior)
        .withColumn(
            "variance_from_prior",
            F.when(
                F.col("prior_version_amount").isNotNull(),
                percent_of(F.col("version_amount") - F.col("prior_version_amount"), F.col("prior_version_amount")),
            ).otherwise(F.lit(0.0)),
        )
    )


def past_forecasts(raw: DataFrame, period: str) -> DataFrame:
    """Forecasts for periods before the one being closed."""
    return raw.filter(F.col("forecast_period") < period)


def convert_forecasts(raw: DataFrame, fx_forecast: DataFrame, cfg: CloseConfig = DEFAULT_CONFIG) -> DataFrame:
    return to_usd_monthly(raw, "forecast_amount", monthly_rates(fx_forecast), cfg)


def process_forecasts(
    raw: DataFrame,
    fx_forecast: DataFrame,
    period: str | None = None,
    cfg: CloseConfig = DEFAULT_CONFIG,
    version_variance: bool = False,
) -> DataFrame:
    """Raw forecasts to validated forecasts in base currency.

    With a ``period`` every row is judged as of that close: it must not lie in the
    past. Without one each row is judged in the close of its own period, which is
    the close that compares it with actual results.

    ``variance_from_prior`` is 0 unless ``version_variance`` asks for the comparison
    with the previous version of the same line.
    """
    converted = convert_forecasts(raw, fx_forecast, cfg)
    due = F.lit(period) if period else F.col("forecast_period")
    valid = falsy_null(
        _known_bu(cfg)
        & F.col("account_code").isNotNull()
        & F.col("forecast_period").isNotNull()
        & (F.col("forecast_period") >= due)
        & F.col("forecast_amount").isNotNull()
        & _has_rate("currency", cfg)
    )
    if version_variance:
        converted = _with_version_variance(converted)
    else:
        converted = converted.withColumn("variance_from_prior", F.lit(0.0))
    return converted.select(
        "bu_code",
        "account_code",
        "forecast_period",
        "forecast_amount",
        "currency",
        "usd_amount",
        "exchange_rate",
        "forecast_type",
        "version",
        valid.alias("is_validated"),
        "variance_from_prior",
        due.alias("closure_period"),
    )


def _with_version_variance(forecasts: DataFrame) -> DataFrame:
    """Attach the variance of its version to each forecast line. Lines without a full key get 0."""
    line = ["bu_code", "account_code", "forecast_period", "forecast_type", "version"]
    variance = forecast_version_variance(forecasts).select(*line, "variance_from_prior")
    return forecasts.join(variance, line, "left").withColumn(
        "variance_from_prior",
        F.when(F.concat(*[F.col(c) for c in line]).isNull(), F.lit(0.0)).otherwise(F.col("variance_from_prior")),
    )
