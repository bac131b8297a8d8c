"""Data-quality operators: null profiles, declared rules, scorecards and their reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from closeworks.config import DEFAULT_CONFIG, CloseConfig
from closeworks.functions.exprs import in_period, percent_text, total, unit_sum

# --- profiles ---------------------------------------------------------------


def null_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows and NULLs per column, from one pass."""
    counts = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(columns)]
    )
    return _as_rows(
        counts,
        [{"column_name": F.lit(c), "records": F.col("_rows"), "nulls": F.col(f"_n{i}")} for i, c in enumerate(columns)],
    )


def non_positive(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) <= 0)


def domain_violations(df: DataFrame, column: str, allowed: list) -> DataFrame:
    """Offending values and how often each occurs. NULL is no violation of the domain."""
    return (
        df.filter(~F.col(column).isin(allowed))
        .groupBy(F.col(column).alias("offending_value"))
        .agg(F.count("*").alias("records"))
    )


def preview(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """First ``n`` rows in the given order, which must be total for a repeatable result."""
    return df.orderBy(*order).limit(n)


def validation_summary(df: DataFrame) -> DataFrame:
    """Valid and invalid rows."""
    return df.groupBy("is_validated").agg(F.count("*").alias("records"))


def _as_rows(one_row: DataFrame, rows: list[dict[str, Column]], keep: tuple[str, ...] = ()) -> DataFrame:
    """Turn columns of each row into several rows (a narrow step, no shuffle)."""
    structs = [F.struct(*[v.alias(k) for k, v in row.items()]) for row in rows]
    return one_row.select(*keep, F.inline(F.array(*structs)))


# --- declared rules ---------------------------------------------------------


@dataclass(frozen=True)
class RowRule:
    """A rule on single rows; ``failed`` is true on a row that breaks it."""

    rule: str
    column: str
    failed: Column


def run_rules(df: DataFrame, rules: list[RowRule]) -> DataFrame:
    """(rule, column_name, checked, failed) for all rules from one aggregate."""
    counts = df.agg(
        F.count("*").alias("_checked"), *[F.count_if(r.failed).alias(f"_f{i}") for i, r in enumerate(rules)]
    )
    return _as_rows(
        counts,
        [
            {
                "rule": F.lit(r.rule),
                "column_name": F.lit(r.column),
                "checked": F.col("_checked"),
                "failed": F.col(f"_f{i}"),
            }
            for i, r in enumerate(rules)
        ],
    )


def _no_nulls(*columns: str) -> list[RowRule]:
    return [RowRule("no_nulls", c, F.col(c).isNull()) for c in columns]


def _group_rule(groups: DataFrame, rule: str, column: str, failed: Column) -> DataFrame:
    return groups.agg(F.count("*").alias("checked"), F.count_if(failed).alias("failed")).select(
        F.lit(rule).alias("rule"), F.lit(column).alias("column_name"), "checked", "failed"
    )


def dq_rules_fx(rates: DataFrame, cfg: CloseConfig = DEFAULT_CONFIG) -> DataFrame:
    return run_rules(
        rates,
        [
            *_no_nulls("currency", "rate", "rate_date"),
            RowRule("positive_values", "rate", F.col("rate") <= 0),
            RowRule(
                "variance_check", "variance_from_prior", F.abs("variance_from_prior") > cfg.fx_variance_threshold
            ),
        ],
    )


def balance_check(ledger: DataFrame) -> DataFrame:
    """A book (period, bu) is out of balance when its debits and credits differ."""
    books = ledger.groupBy("period", "bu_code").agg(unit_sum("local_amount").alias("_net"))
    return _group_rule(books, "balance_check", "local_amount", F.col("_net") != 0)


def dq_rules_ledger(ledger: DataFrame, cfg: CloseConfig = DEFAULT_CONFIG) -> DataFrame:
    rows = run_rules(
        ledger,
        [
            *_no_nulls("bu_code", "account_code", "local_amount", "period"),
            RowRule("valid_bu", "bu_code", ~F.col("bu_code").isin(cfg.bu_codes)),
        ],
    )
    return rows.unionByName(balance_check(ledger))


def reconciliation(cuts: DataFrame, ledger: DataFrame, tolerance: float) -> DataFrame:
    """A book (period, bu) fails when its adjustments exceed ``tolerance`` of its ledger total."""
    key = ["closure_period", "bu_code"]
    amounts = (
        cuts.groupBy(*key)
        .agg(total("usd_amount").alias("_adjusted"))
        .join(ledger.groupBy(*key).agg(total("usd_amount").alias("_booked")), key, "left")
    )
    over = F.abs("_adjusted") > F.abs(F.coalesce("_booked", F.lit(0.0))) * F.lit(tolerance)
    return _group_rule(amounts, "reconciliation", "usd_amount", over)


def dq_rules_cuts(cuts: DataFrame, ledger: DataFrame, cfg: CloseConfig = DEFAULT_CONFIG) -> DataFrame:
    rows = run_rules(
        cuts,
        [
            *_no_nulls("cut_number", "account_code", "adjustment_amount"),
            RowRule("valid_cut_number", "cut_number", ~F.col("cut_number").isin(list(cfg.valid_cuts))),
        ],
    )
    return rows.unionByName(reconciliation(cuts, ledger, cfg.reconciliation_tolerance))


def dq_rules_segments(segments: DataFrame, cfg: CloseConfig = DEFAULT_CONFIG) -> DataFrame:
    rows = run_rules(segments, _no_nulls("bu_code", "segment_type", "amount"))
    present = segments.groupBy("bu_code", "account_code").agg(
        *[F.max(F.col("segment_type") == t).alias(f"_has{i}") for i, t in enumerate(cfg.segment_types)]
    )
    lacks_one = ~F.coalesce(
        F.array_min(F.array(*[F.coalesce(f"_has{i}", F.lit(False)) for i in range(len(cfg.segment_types))])),
        F.lit(False),
    )
    return rows.unionByName(_group_rule(present, "segment_completeness", "segment_type", lacks_one))


def dq_rules_forecast(forecasts: DataFrame, period: str) -> DataFrame:
    return run_rules(
        forecasts,
        [
            *_no_nulls("bu_code", "forecast_period", "forecast_amount"),
            RowRule("future_dates_only", "forecast_period", F.col("forecast_period") < period),
        ],
    )


# --- scorecards -------------------------------------------------------------


@dataclass(frozen=True)
class Scorecard:
    """How one dataset is scored; the rate must stay below ``warn`` to pass and below ``fail`` to warn."""

    table_name: str
    phase: int
    check_name: str
    subject: str
    warn: float = 0.02
    fail: float = 0.05


# Check names, phases and result bands.
SCORECARDS = {
    "exchange_rates": Scorecard("exchange_rates", 1, "Exchange Rate Processing", "exchange rates", 0.05, 0.10),
    "bu_preliminary_close": Scorecard(
        "bu_preliminary_close", 1, "Preliminary Close Processing", "preliminary close"
    ),
    "accounting_cuts": Scorecard("accounting_cuts", 2, "Accounting Cuts Processing", "accounting cuts"),
    "segmented_files": Scorecard("segmented_files", 3, "Segmented Files Processing", "segmented files"),
    "forecast_files": Scorecard("forecast_files", 3, "Forecast Files Processing", "forecast files"),
}


def counted(df: DataFrame) -> DataFrame:
    """Rows of each closure period and those among them that are not valid."""
    return df.groupBy("closure_period").agg(
        F.count("*").alias("records_checked"), F.count_if(~F.col("is_validated")).alias("records_failed")
    )


def scorecard(df: DataFrame, card: Scorecard) -> DataFrame:
    """One row per closure period: checked, failed, failure rate, result, text."""
    return scored(counted(df), card)


def scored(counts: DataFrame, card: Scorecard) -> DataFrame:
    """Scorecards of ``closure_period, records_checked, records_failed``, wherever these were counted."""
    rate = F.try_divide(F.col("records_failed"), F.col("records_checked"))
    return (
        counts.withColumn("failure_rate", rate)
        .select(
            "closure_period",
            F.lit(card.phase).alias("phase"),
            F.lit(card.table_name).alias("table_name"),
            F.lit("validation").alias("check_type"),
            F.lit(card.check_name).alias("check_name"),
            F.when(F.col("failure_rate") < card.warn, "PASSED")
            .when(F.col("failure_rate") < card.fail, "WARNING")
            .otherwise("FAILED")
            .alias("check_result"),
            "records_checked",
            "records_failed",
            "failure_rate",
            F.concat(
                F.lit(f"Processed {card.subject} with "),
                percent_text(F.col("records_failed"), F.col("records_checked")),
                F.lit("% failure rate"),
            ).alias("details"),
        )
    )


def dq_scorecard(datasets: dict[str, DataFrame]) -> DataFrame:
    """Scorecards of all given datasets: one scan and one aggregate each."""
    cards = [scorecard(df, SCORECARDS[name]) for name, df in datasets.items()]
    out = cards[0]
    for card in cards[1:]:
        out = out.unionByName(card)
    return out


# --- reports over the checks ------------------------------------------------


def _failure_percent() -> Column:
    return F.round(F.col("failure_rate") * 100, 2)


def dq_summary(dq: DataFrame, period: str | None = None, phase: int | None = None) -> DataFrame:
    """Checks of a phase with the number of critical (FAILED) ones among them."""
    scoped = in_period(dq, period)
    if phase is not None:
        scoped = scoped.filter(F.col("phase") == phase)
    # A period has one row per dataset and check, so this window stays tiny.
    critical = F.count_if(F.col("check_result") == "FAILED").over(Window.partitionBy("closure_period"))
    return scoped.withColumn("critical_failures", critical).select(
        "closure_period",
        "phase",
        "table_name",
        "check_result",
        "records_checked",
        "records_failed",
        _failure_percent().alias("failure_rate_pct"),
        "critical_failures",
    )


def dq_dashboard(dq: DataFrame, period: str | None = None) -> DataFrame:
    order = ["closure_period", "phase", *([F.desc("checked_at")] if "checked_at" in dq.columns else ["table_name"])]
    shown = ["checked_at"] if "checked_at" in dq.columns else []
    return (
        in_period(dq, period)
        .select(
            "closure_period",
            "phase",
            "table_name",
            "check_name",
            "check_result",
            "records_checked",
            "records_failed",
            _failure_percent().alias("failure_rate_pct"),
            *shown,
        )
        .orderBy(*order)
    )


def dq_issues(dq: DataFrame, period: str | None = None) -> DataFrame:
    """Checks that did not pass, worst first inside a phase."""
    return (
        in_period(dq, period)
        .filter(F.col("check_result").isin("WARNING", "FAILED"))
        .orderBy("phase", F.desc("failure_rate"), "closure_period", "table_name")
        .select(
            "closure_period",
            "phase",
            "table_name",
            "check_name",
            "check_result",
            "records_failed",
            _failure_percent().alias("failure_rate_pct"),
            "details",
        )
    )


def audit_quality(dq: DataFrame, period: str | None = None) -> DataFrame:
    """Quality section of the audit report."""
    return (
        in_period(dq, period)
        .orderBy("phase", "closure_period", "table_name")
        .select(
            "closure_period",
            "phase",
            "table_name",
            "check_result",
            "records_checked",
            "records_failed",
            _failure_percent().alias("failure_rate_pct"),
        )
    )
