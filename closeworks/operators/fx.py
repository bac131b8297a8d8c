"""Exchange rates: variance to the prior rate, validation, latest and monthly rates, conversion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from closeworks.config import DEFAULT_CONFIG, CloseConfig
from closeworks.functions.exprs import RATE, falsy_null, in_period, mean
from closeworks.functions.ranks import place, sampled_keys

# Load order of rates. The last entries only break ties inside one day.
RATE_ORDER = ("rate_date", "loaded_at", "load_id")

# Rates of a slice, about, and the most slices that the rates of all currencies are cut into; see ``with_prior_rate``.
SLICE_ROWS = 100_000
MOST_SLICES = 16_384


def order_key(columns: Sequence[str]) -> Column:
    """One comparable value for an order. A single column stays plain, so aggregates on it hash."""
    return F.col(columns[0]) if len(columns) == 1 else F.struct(*columns)


def with_prior_rate(raw: DataFrame, order: Sequence[str] = RATE_ORDER, slices: int | None = None) -> DataFrame:
    """Add ``prior_rate``: the rate before this one in the same currency.

    There are few currencies, and one may hold a third of all rows, so a window
    per currency would put that third into one task. Instead all rows are cut into slices
    along (currency, order, rate, hash of the row). The cuts are keys of the data, spread evenly
    over its ranks whatever the types are and however many rows a currency or a day has; their number grows
    with the rows, up to ``MOST_SLICES``, or is ``slices``. Only rows that are equal in all columns stay together.

    A slice ends with the row it is cut at. Inside of a slice a window gives the prior row, and the first row of a
    currency in a slice follows the row at the cut before it, whose rate the cut holds, or no row if that one
    is of another currency. So rates are shuffled and sorted once, and nothing is joined. Rows with equal
    order follow each other in the order of their rates.
    """
    # No NULL in the currency: rows with an unknown currency form a line too. Unknown days come first.
    line = F.coalesce(F.concat(F.lit("="), "currency"), F.lit(""))
    sliced = raw.withColumns({"_currency": line, "_hash": F.xxhash64(*raw.columns)})
    key = F.struct("_currency", *order, F.col("rate").alias("_rate"), "_hash")
    most = slices or MOST_SLICES
    sliced = sliced.withColumn("_cuts", sampled_keys(sliced, key, F.col("_hash"), most, None if slices else SLICE_ROWS))
    sliced = sliced.withColumn("_slice", place(key, F.col("_cuts"), most))
    cut = F.get(F.col("_cuts"), F.col("_slice") - 1)
    carried = F.when(cut["_currency"] == F.col("_currency"), cut["_rate"])
    sliced = sliced.withColumn("_carried", carried).drop("_cuts")

    # A struct around the rate tells "no prior row" (NULL) from "prior row without a rate".
    in_slice = Window.partitionBy("_currency", "_slice").orderBy(*order, "rate", "_hash")
    return (
        sliced.withColumn("_prior", F.lag(F.struct("rate")).over(in_slice))
        .withColumn("prior_rate", F.when(F.col("_prior").isNotNull(), F.col("_prior.rate")).otherwise(F.col("_carried")))
        .select(*raw.columns, "prior_rate")
    )


def fx_variance(raw: DataFrame, order: Sequence[str] = RATE_ORDER) -> DataFrame:
    """Add ``prior_rate`` and ``variance_from_prior`` in percent; 0 when there is no prior rate."""
    change = F.try_divide(F.col("rate") - F.col("prior_rate"), F.col("prior_rate")) * F.lit(100.0)
    return with_prior_rate(raw, order).withColumn(
        "variance_from_prior", F.when(F.col("prior_rate").isNotNull(), change).otherwise(F.lit(0.0))
    )


def fx_outliers(rates: DataFrame, threshold: float = DEFAULT_CONFIG.fx_variance_threshold) -> DataFrame:
    """Rates that moved by more than ``threshold`` percent."""
    return rates.filter(F.abs("variance_from_prior") > threshold)


def validate_fx(rates: DataFrame, cfg: CloseConfig = DEFAULT_CONFIG) -> DataFrame:
    """Add ``is_validated`` and ``validation_notes`` (the first rule that fails)."""
    known = F.col("currency").isin(list(cfg.currencies))
    moved = F.abs("variance_from_prior")
    limit = cfg.fx_variance_threshold
    return rates.withColumns(
        {
            "is_validated": falsy_null(known & (F.col("rate") > 0) & F.col("rate").isNotNull() & (moved <= limit)),
            "validation_notes": F.when(~known, "Invalid currency")
            .when(F.col("rate") <= 0, "Invalid rate")
            .when(F.col("rate").isNull(), "Missing rate")
            .when(moved > limit, f"Variance exceeds {limit}%"),
        }
    )


def process_fx(
    raw: DataFrame,
    period: str,
    cfg: CloseConfig = DEFAULT_CONFIG,
    order: Sequence[str] = RATE_ORDER,
) -> DataFrame:
    """Raw rates to validated rates of one closure period.

    The order columns stay in the result, so that the latest rate can be chosen by the same order.
    """
    checked = validate_fx(fx_variance(raw, order), cfg)
    extra = [c for c in order if c != "rate_date"]
    return checked.select(
        "currency",
        "rate",
        "rate_date",
        "source",
        "variance_from_prior",
        "is_validated",
        "validation_notes",
        F.lit(period).alias("closure_period"),
        *extra,
    )


def dedup_rates(raw: DataFrame, order: Sequence[str] = RATE_ORDER) -> DataFrame:
    """One rate per (currency, day): the one loaded last."""
    rest = list(order[1:]) or ["rate"]
    return raw.groupBy("currency", order[0]).agg(F.max_by("rate", order_key(rest)).alias("rate"))


def latest_rates(rates: DataFrame, period: str | None = None, order: Sequence[str] = RATE_ORDER) -> DataFrame:
    """Latest validated rate per currency, as ``exchange_rate``.

    First the closing rate of each day, then the last day: both steps combine on
    the map side, so a hot currency sends one row per task.
    """
    valid = in_period(rates.filter("is_validated"), period)
    missing = [c for c in order if c not in rates.columns]
    if missing:
        raise ValueError(f"the order of rates needs the columns {missing}")
    daily = dedup_rates(valid, order)
    return daily.groupBy("currency").agg(F.max_by("rate", order[0]).alias("exchange_rate"))


def monthly_rates(fx_forecast: DataFrame) -> DataFrame:
    """Average forecast rate per currency and month (``forecast_date``, or a given ``forecast_month``)."""
    if "forecast_month" in fx_forecast.columns:
        month = F.col("forecast_month")
    else:
        month = F.date_format("forecast_date", "yyyy-MM")
    return (
        fx_forecast.groupBy("currency", month.alias("forecast_period"))
        .agg(mean("forecast_rate", RATE).alias("exchange_rate"))
    )


def _usd(df: DataFrame, amount: str, currency: str, cfg: CloseConfig) -> DataFrame:
    rate = F.col("exchange_rate")
    return df.withColumn(
        "usd_amount",
        F.when(F.col(currency) == cfg.base_currency, F.col(amount))
        .when(rate.isNotNull(), F.try_divide(F.col(amount), rate)),
    )


def to_usd(
    df: DataFrame, amount: str, currency: str, rates: DataFrame, cfg: CloseConfig = DEFAULT_CONFIG
) -> DataFrame:
    """Add ``exchange_rate`` and ``usd_amount`` from one rate per currency.

    Only configured currencies can hold a validated rate, so the broadcast side
    has at most ``len(cfg.currencies)`` rows whatever the size of the rate table.
    """
    side = rates.filter(F.col("currency").isin(list(cfg.currencies))).select(
        F.col("currency").alias(currency), "exchange_rate"
    )
    return _usd(df.join(F.broadcast(side), currency, "left"), amount, currency, cfg)


def to_usd_monthly(
    df: DataFrame, amount: str, rates: DataFrame, cfg: CloseConfig = DEFAULT_CONFIG
) -> DataFrame:
    """Add ``exchange_rate`` and ``usd_amount`` from one rate per (currency, forecast_period).

    Forecast rates are not checked against the configured currencies, so the number
    of rate rows depends on data. Spark chooses the join when the query runs, by the size it has then.
    """
    return _usd(df.join(rates, ["currency", "forecast_period"], "left"), amount, "currency", cfg)


def missing_fx_condition(currency: str, cfg: CloseConfig = DEFAULT_CONFIG) -> Column:
    return (F.col(currency) != cfg.base_currency) & F.col("exchange_rate").isNull()


def missing_fx(converted: DataFrame, currency: str = "currency", cfg: CloseConfig = DEFAULT_CONFIG) -> DataFrame:
    """Converted rows that need a rate and found none."""
    return converted.filter(missing_fx_condition(currency, cfg))


def recent_rates(rates: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Rates of the last ``days`` days up to ``as_of``, newest first."""
    return (
        rates.filter(F.col("rate_date") >= F.date_sub(F.lit(as_of).cast("date"), days))
        .select("currency", "rate_date", "rate", "variance_from_prior", "is_validated", "validation_notes")
        .orderBy(F.desc("rate_date"), "currency")
    )
